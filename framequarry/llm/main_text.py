"""Op 1: main text of pages by site style trees.

The pages of a host are merged into one tree whose nodes are element paths. A node's importance follows from entropies
over the host's pages: how much its presentation (the sequence of its children) and its content (its blocks of text)
differ from page to page; pages with one content count once. What a host repeats is unimportant, and such branches are
cut from each page, unless they hold an article or most of the page's text, beside those whose element, role or class
says that they are no article text. An article element raises the importance of what it holds before any page is seen,
and no more; this prior fades with the number of pages, of which two are enough.
"""

from __future__ import annotations

import re
from collections import Counter
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..session import stage
from .page_tree import Article, Element, walk
from .registry import batch, map_batches, query, read, renamed
from .url_filter import host

#: A node that several pages of its host have is cut below this importance.
IMPORTANCE = 0.65
#: Share of a node's own presentation in its importance; the rest is that of the text below it.
PRESENTATION_SHARE = 0.1
#: Importance before any page is seen: of what stands inside an article element, and of what stands outside, on pages
#: without one and on pages whose articles hold most of the text. It weighs as much as so many pages.
INSIDE, OUTSIDE, BESIDE, PRIOR_PAGES = 1.0, 0.8, 0.5, 2
#: A single block of text is cut below this importance, unless less than this share of the page's text would be left.
BLOCK_IMPORTANCE, LEAST_LEFT = 0.3, 0.25

#: A marked element that holds more than this share of the text, or the largest article, is no branch to cut.
MOST_TEXT = 0.75

# Elements, roles and words in class names and ids that mark what is not the article.
NOISE_ELEMENTS = set("nav footer aside button select dialog template svg canvas object audio video menu search datalist".split())
NOISE_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
NOISE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promoted promotion banner nav navbar navigation navi menu "
    "breadcrumb breadcrumbs sidebar aside footer cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe "
    "subscription signup login register share sharing social related recommended recommendations comment comments commentlist disqus reply replies "
    "respond widget widgets toolbar pagination pager masthead copyright legal disclaimer skip search form".split()
)
HEADER_WORDS = {"header", "topbar"}
ARTICLE_ELEMENTS = ("article", "main")
KEPT_ELEMENTS = {"html", "body", "article", "main", "h1", "h2", "h3", "h4", "h5", "h6"}
PROSE_ELEMENTS = KEPT_ELEMENTS | {"p", "blockquote", "pre"}
_WORD = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def is_article(name: str, attrs: dict[str, str]) -> bool:
    return name in ARTICLE_ELEMENTS or attrs.get("role") in ARTICLE_ELEMENTS or attrs.get("itemprop") == "articleBody"


def noise_mark(name: str, attrs: dict[str, str], inside: bool) -> str:
    """Whether an element is surely no article text ("hidden"), or calls itself so by a word that may mean anything ("marked").

    An article is marked by whole class names only, other elements by the words in them; headings and the page's frame by none.
    """
    if name in ("html", "body"):
        return ""
    if name in NOISE_ELEMENTS or attrs.get("role") in NOISE_ROLES or "hidden" in attrs or attrs.get("aria-hidden") == "true" or _HIDDEN.search(attrs.get("style", "")):
        return "hidden"
    if name == "header" or name == "form":
        return "marked" if name == "form" or not inside else ""
    if name in KEPT_ELEMENTS and name != "article":
        return ""
    said = f"{attrs.get('class', '')} {attrs.get('id', '')}".lower()
    words = set(said.split()) if name == "article" else set(_WORD.findall(said))
    return "marked" if words & NOISE_WORDS or words & HEADER_WORDS and not inside else ""


def _short(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


class Block(NamedTuple):
    """A block of text, the path of its node, and that of the outermost article around it, else empty."""

    text: str
    path: str
    article: str


class Page(NamedTuple):
    """What one walk over a page finds: its places in the style tree in order, their sequences of children, its distinct
    blocks (the place and the hash of each), and the blocks that may be article text with their places and articles."""

    paths: list[str]
    styles: list[int | None]
    places: list[int]
    keys: list[int]
    blocks: list[Block]


def read_page(page: str) -> Page:
    children: dict[str, list[str]] = {}
    nodes: set[str] = set()
    texts: set[tuple[str, int]] = set()
    shown: list[tuple[str, Element]] = []
    articles: dict[int, Article] = {}
    for event, element, more in walk(page, noise_mark, is_article):
        if event == "text":
            texts.add((element.path, block_key(element.path, more)))
            if not element.hidden:
                shown.append((more, element))
        elif event == "article":
            articles[element.article[1]] = more
        else:
            nodes.add(element.path)
            below = children.setdefault(more.path, [])
            if not below or below[-1] != element.path:
                below.append(element.path)
    paths = sorted(nodes | {path for path, _ in texts} | set(children))
    at = {path: i for i, path in enumerate(paths)}
    found = sorted((at[path], key) for path, key in texts)
    styles = [_short("".join(children[path])) if path in children else None for path in paths]

    held, sizes = Counter(), Counter()
    for text, element in shown:
        for mark in element.marks:
            held[mark] += len(text)
        if element.article and not articles[element.article[1]].marked:
            sizes[element.article[1]] += len(text)
    total = sum(len(text) for text, _ in shown)
    kept = {mark for mark, size in held.items() if size > MOST_TEXT * total}
    if sizes:
        kept |= set(articles[max(sizes, key=sizes.get)].marks)
    blocks = [Block(text, e.path, e.article[0] if e.article else "") for text, e in shown if kept.issuperset(e.marks)]
    return Page(paths, styles, [i for i, _ in found], [key for _, key in found], blocks)


def block_key(path: str, text: str) -> int:
    return _short(f"{path}\n{text}")


def layout_of(paths: list[str]) -> int:
    return _short("\n".join(paths))


def judged_layouts(pages: DataFrame) -> DataFrame:
    """(host, layout, cut, sure, repeated): what the host's style tree says of each layout, from read pages.

    `cut` are the unimportant nodes, `sure` those whose own text is important also beside an article, and `repeated` the
    keys of the blocks that the host repeats; paragraphs share one node, so blocks are judged one by one.

    A layout is a set of node paths. Pages of a host that are alike in nodes, sequences of children and blocks count once.
    Features are counted per host and path by partial aggregation, so the pages of one host meet nowhere, and a page is
    given the verdicts on its own nodes only.
    """
    once = stage(pages.where("layout is not null").select("host", "layout", "digest", "paths", "styles", "places", "keys").dropDuplicates(["host", "digest"]), "features")

    def feature(path, kind, value):
        return F.struct(path.alias("path"), F.lit(kind).alias("kind"), value.alias("feature"))

    found = F.concat(
        F.transform("paths", lambda path: feature(path, "page", F.lit(0).cast("long"))),
        F.transform("paths", lambda path, i: feature(path, "style", F.get("styles", i))),
        F.transform("keys", lambda block, i: feature(F.get("paths", F.get("places", i)), "text", block)),
    )
    counted = once.select("host", F.explode(found).alias("f")).select("host", "f.*").where("feature is not null").groupBy("host", "path", "kind", "feature").agg(F.count("*").alias("n"))
    counted = stage(counted, "counted")
    text, style = F.col("kind") == "text", F.col("kind") == "style"
    # A feature on n of m pages, once each, has entropy log n / log m; a style has the share n / m of the pages.
    nodes = counted.groupBy("host", "path").agg(
        F.max(F.when(F.col("kind") == "page", F.col("n"))).alias("m"),
        F.sum(F.when(text, F.log(F.col("n")))).alias("text_logs"), F.count(F.when(text, 1)).alias("texts"),
        F.sum(F.when(style, F.col("n"))).alias("styled"), F.sum(F.when(style, F.col("n") * F.log(F.col("n")))).alias("style_logs"),
    )
    nodes = stage(nodes, "nodes").withColumn("inside", F.col("path").rlike("/(article|main)([.#][^/]*)?(/|$)"))
    parts = F.split("path", "/")
    upward = F.transform(F.sequence(F.lit(2), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    below = (
        nodes.where("texts > 0 and path <> ''").select("host", F.explode(upward).alias("path"), "text_logs", "texts")
        .groupBy("host", "path").agg(F.sum("text_logs").alias("logs"), F.sum("texts").alias("blocks"))
    )
    most = F.log(F.greatest("m", F.lit(2)))
    content = 1 - F.col("logs") / F.col("blocks") / most
    presentation = F.when(F.col("styled") > 0, (F.log("styled") - F.col("style_logs") / F.col("styled")) / most).otherwise(0.0)
    importance = PRESENTATION_SHARE * presentation + (1 - PRESENTATION_SHARE) * content
    def smoothed(value, inside, outside):
        before = F.when(F.col("inside"), inside).otherwise(outside)
        return (F.col("m") * value + PRIOR_PAGES * before) / (F.col("m") + PRIOR_PAGES)

    judged = nodes.where("m > 1")
    # Paragraphs, headings and the page's frame are no branches of a template; their blocks are judged instead.
    prose = F.regexp_extract("path", "([^/.#]+)[^/]*$", 1).isin(sorted(PROSE_ELEMENTS))
    cut = judged.join(below, ["host", "path"]).where((smoothed(importance, INSIDE, OUTSIDE) < IMPORTANCE) & ~prose).select("host", "path", F.lit(True).alias("is_cut"))
    own = 1 - F.col("text_logs") / F.col("texts") / most
    sure = judged.where((F.col("texts") > 0) & (smoothed(own, INSIDE, BESIDE) >= IMPORTANCE) & ~F.col("inside")).select("host", "path", F.lit(True).alias("is_sure"))
    # Few blocks of a path pass: their number grows with a low power of the number of pages.
    spread = 1 - F.log("n") / most
    repeated = (
        counted.where("kind = 'text' and n > 1").join(judged.select("host", "path", "m", "inside"), ["host", "path"])
        .where(smoothed(spread, INSIDE, BESIDE) < BLOCK_IMPORTANCE).groupBy("host", "path").agg(F.collect_list("feature").alias("keys"))
    )
    said = cut.join(sure, ["host", "path"], "full").join(repeated, ["host", "path"], "full")
    layouts = once.select("host", "layout", "paths").dropDuplicates(["host", "layout"]).select("host", "layout", F.explode("paths").alias("path"))
    return layouts.join(said, ["host", "path"]).groupBy("host", "layout").agg(
        F.collect_list(F.when(F.col("is_cut"), F.col("path"))).alias("cut"), F.collect_list(F.when(F.col("is_sure"), F.col("path"))).alias("sure"),
        F.flatten(F.collect_list("keys")).alias("repeated"),
    )


def _at_or_below(path: str, node: str) -> bool:
    return path == node or path.startswith(node + "/")


def _size(blocks: list[Block]) -> int:
    return sum(len(b.text) for b in blocks)


def main_blocks(blocks: list[Block], cut: list[str], sure: set[str], repeated: set[int]) -> list[str]:
    """The blocks that are left without the cut nodes and the repeated blocks.

    A node that holds an article, or most of the page's text that is not repeated, is not cut; repeated blocks stay where
    little else would be left, as on near copies. Beside articles that hold most of the text, only blocks of sure nodes stay.
    """
    new = [b for b in blocks if block_key(b.path, b.text) not in repeated] if repeated else blocks
    if _size(new) < LEAST_LEFT * _size(blocks):
        new = blocks
    prose = _size(new)
    for node in cut:
        held = [b for b in new if _at_or_below(b.path, node)]
        if any(b.article and _at_or_below(b.article, node) for b in held) or 2 * _size(held) > prose:
            continue
        new = [b for b in new if not _at_or_below(b.path, node)]
    if 2 * _size([b for b in new if b.article]) > _size(new):
        new = [b for b in new if b.article or b.path in sure]
    return [b.text for b in new]


def extract_main_text(df: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """One row per row of `df`: page_id, url, text (blocks joined by \\n) and n_chars (its code points).

    Pages are grouped by the URL's host; pages without a host are a group. A null or empty page has an empty text, as has
    one without text outside the cut branches. Broken markup is read as far as it goes. Repeated rows stay; pages of a
    host with one content count once. Extra columns are not read; an empty table gives no rows.
    """
    pages = renamed(df, page_id=id_column, url=url_column, html=html_column).withColumn("host", host(F.col("url")))
    kind = dict(pages.dtypes)["page_id"].replace("bigint", "long")
    schema = f"page_id {kind}, url string, text string, n_chars long"
    parsed = (
        f"page_id {kind}, url string, host string, layout long, digest long, paths array<string>, styles array<long>, places array<int>, keys array<long>, "
        "texts array<string>, nodes array<string>, articles array<string>"
    )

    def parse(part):
        rows = []
        for page in part.column("html").to_pylist():
            found = read_page(page) if page else None
            if found:
                features = found[:4]
                rows.append((layout_of(found.paths), _short(repr(features)), *features, *([b[i] for b in found.blocks] for i in range(3))))
            else:
                rows.append((None, None, *([] for _ in range(7))))
        yield batch(parsed, *(part.column(c) for c in ("page_id", "url", "host")), *[list(c) for c in zip(*rows)])

    # A page is walked once; its features are counted, and its blocks judged, from what is kept.
    read = stage(map_batches(pages, parse, parsed), "pages")
    layouts = stage(judged_layouts(read), "layouts")

    def extract(part):
        found = []
        names = ("texts", "nodes", "articles", "cut", "sure", "repeated")
        for texts, paths, articles, cut, sure, repeated in zip(*(part.column(c).to_pylist() for c in names)):
            blocks = [Block(*b) for b in zip(texts, paths, articles)]
            found.append("\n".join(main_blocks(blocks, sorted(cut or []), set(sure or []), set(repeated or []))))
        yield batch(schema, part.column("page_id"), part.column("url"), pa.array(found, pa.string()), [len(t) for t in found])

    blocks = read.select("page_id", "url", "host", "layout", "texts", "nodes", "articles")
    return map_batches(blocks.join(layouts, ["host", "layout"], "left").drop("host", "layout"), extract, schema)


@query("op1_main_text")
def op1_main_text(spark, sf_dir):
    return extract_main_text(read(spark, sf_dir, "pages"))
