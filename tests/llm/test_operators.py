"""The corpus operators against brute force on small fixtures, with nulls, empty texts, ties and clashing columns."""

import hashlib
import html
import math
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from framequarry.llm import (
    components, decontaminate, jaccard_join, language, line_dedup, main_text, pieces, quality, sentence_spans, toxicity, url_filter, words as W,
)
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, node int, key string"


def sentence(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdefghij"), rng.integers(2, 7))) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def rows():
    base = [[sentence(100 * i + j, 12) for j in range(9)] for i in range(8)]
    texts = ["\n".join(b) for b in base]
    texts += [texts[0], texts[1] + " tail words here.", texts[2].upper(), "\n".join(base[3][:6] + base[4][3:]), None, "", " \n\t", "one two", "one two", "ONE two"]
    texts += ["na " * 40, "Ünï çødé " * 9, "\n".join(base[5][2:] * 2)]
    found = [(i, t, i, "k") for i, t in enumerate(texts)]
    return found + [(3, texts[3], 0, "again"), (None, texts[6], 0, "no id"), (None, None, 0, "nothing")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i : i + 5]) for i in range(len(w) - 4)])


def test_jaccard_components(spark, rows, docs):
    sets = [shingles(r[1]) for r in rows]
    part = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                part = [part[j] if p == part[i] else p for p in part]
    lowest = {p: min([r[0] for r, q in zip(rows, part) if q == p and r[0] is not None], default=None) for p in part}
    want = sorted(((r[0], len(s), lowest[p] if s else r[0]) for r, s, p in zip(rows, sets, part)), key=str)
    assert sorted(map(tuple, jaccard_join.jaccard_components(docs).collect()), key=str) == want
    assert jaccard_join.jaccard_components(empty(spark)).count() == 0


def test_many_near_copies_in_blocks(spark, monkeypatch):
    """Chains of near copies come out whole also when tiles are cut into many blocks."""
    monkeypatch.setattr(jaccard_join, "TILE_NODES", 4)
    monkeypatch.setattr(jaccard_join, "NEAREST", 1)
    words = sentence(1, 80).split()
    chain = [(i, " ".join(words[: 80 - 2 * i] + [f"x{i}{j}" for j in range(2 * i)])) for i in range(12)]
    got = dict(jaccard_join.jaccard_components(spark.createDataFrame(chain, "doc_id long, text string")).select("doc_id", "component_id").collect())
    sets = [shingles(t) for _, t in chain]
    part = list(range(12))
    for i in range(12):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                part = [part[j] if p == part[i] else p for p in part]
    assert got == {i: min(k for k in range(12) if part[k] == part[i]) for i in range(12)}


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3)]
    got = dict(components.components(spark.createDataFrame(edges, "src long, dst long"), "src", "dst").collect())
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}


def test_contamination(spark, rows, docs):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    whole = rows[0][1].split()
    items = [(10, " ".join(whole[3:30])), (9, " ".join(whole[40:53])), (8, "one, TWO"), (7, None), (6, "..."), (None, " ".join(rows[5][1].split()[:14])),
             (5, " ".join(whole[20:32])), (4, " ".join(whole[60:72] + ["other"])), (10, "twice named item with few words")]
    want = []
    for doc_id, text, *_ in rows:
        w, hit, names = words(text), set(), set()
        for name, item in items:
            v = words(item)
            n = min(13, len(v))
            wins = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if v else set()
            for i in range(len(w) - n + 1):
                if n and tuple(w[i : i + n]) in wins:
                    hit |= set(range(i, i + n))
                    names |= {str(name)} if name is not None else set()
        want.append((doc_id, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), 0 < len(hit) and 20 * len(hit) >= len(w)))
    got = decontaminate.contamination(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    nothing = decontaminate.contamination(docs, spark.createDataFrame([], "item_id long, text string"))
    assert nothing.where("n_hit > 0").count() == 0 and nothing.count() == len(rows)


def test_repeated_lines(spark, rows, docs):
    def reduced():
        seen, order = set(), sorted({(r[0], r[1]) for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0] or 0))
        out = {}
        for doc in order:
            lines = doc[1].split("\n")
            filled = [(i, x.strip(" \t\r")) for i, x in enumerate(lines) if x.strip(" \t\r")]
            gone = set()
            for a, b, c in zip(filled, filled[1:], filled[2:]):
                window = (a[1], b[1], c[1])
                if window in seen:
                    gone |= set(range(a[0], c[0] + 1))
                seen.add(window)
            out[doc] = "\n".join(x for i, x in enumerate(lines) if i not in gone) if gone else doc[1]
        return out

    want = reduced()
    got = line_dedup.drop_repeated_lines(docs)
    assert got.columns == ["doc_id", "text", "node", "key", "n_lines_removed"]
    keyed = {(r.node, r.key): r for r in got.collect()}
    for r in rows:
        assert keyed[(r[2], r[3])].text == (want[(r[0], r[1])] if r[1] is not None else None)
    assert line_dedup.drop_repeated_lines(empty(spark)).count() == 0


def test_line_dedup_is_native(docs):
    plan = line_dedup.drop_repeated_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoopJoin", plan)


def test_repeated_sentences(spark, rows, docs):
    got = sentence_spans.drop_repeated_spans(docs).collect()
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert len(got) == len(rows)
    for i in range(6):
        assert by_id[i].text == rows[i][1]  # first places stay, byte for byte
    assert by_id[8].text == "" and by_id[9].text.strip() == "tail words here."
    assert by_id[11].text == "" and by_id[12].text is None and by_id[13].text == "" and by_id[15].text == "one two"
    assert by_id[6].text == ""  # the row without an id comes first
    none = [r.text for r in got if r.doc_id is None]
    assert sorted(none, key=str) == sorted([None, rows[6][1]], key=str)
    spans = Counter()
    for text in [r.text for r in got if r.doc_id != 3] + [by_id[3].text]:
        lines = (text or "").split("\n")
        spans.update({tuple(lines[i : i + 3]) for i in range(len(lines) - 2) if all(len(x.split()) >= 8 for x in lines[i : i + 3])})
    assert not spans or max(spans.values()) == 1
    assert sentence_spans.drop_repeated_spans(empty(spark)).count() == 0


def test_quality(spark, rows, docs):
    trusted = spark.createDataFrame([(i,) for i in range(6)] + [(None,), (2,)], "doc_id long")
    known = {0, 1, 2, 3, 4, 5}

    def buckets(text):
        chunk = next(W.texts(pa.array([text or ""])))
        return quality.ngram_buckets(W.words(chunk, W.PLAIN))[0].tolist()

    raw, target = Counter(), Counter()
    for r in rows:
        raw.update(buckets(r[1]))
        if r[0] in known:
            target.update(buckets(r[1]))
    ratio = lambda b: math.log((target[b] + 1) / (target.total() + quality.BUCKETS)) - math.log((raw[b] + 1) / (raw.total() + quality.BUCKETS))
    want = []
    for doc_id, text, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        places = defaultdict(list)
        for i in range(len(w) - 7):
            places[tuple(w[i : i + 8])].append(i)
        repeat = {j for at in places.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
        seen, dup = set(), 0
        for line in (text or "").split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                dup += line in seen
                seen.add(line)
        failed = len(w) < 20 or 100 * len(repeat) > 30 * len(w)
        b = buckets(text)
        score = sum(map(ratio, b)) / len(b) if b else 0.0
        want.append((doc_id, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(repeat), failed, round(score, 9), not failed and score >= quality.THRESHOLD))
    got = quality.judge_quality(docs, trusted).withColumn("score", F.round("score", 9))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert quality.judge_quality(empty(spark), trusted).count() == 0


def test_code_lengths():
    """The table look-ups give the same bits as walking down the contexts byte by byte."""
    learned = ["abcabcabd abca", "xyz xyzzy abc xyz é"]
    grams = [Counter() for _ in learned]
    for n, text in zip(grams, learned):
        n.update(W.np.unique(language.grams(next(W.texts(pa.array([text]))))).tolist() and language.grams(next(W.texts(pa.array([text])))).tolist())
    lang = np.concatenate([np.full(len(n), i) for i, n in enumerate(grams)])
    trees = language.build_trees(["a", "x"], lang, np.concatenate([np.array(list(n)) for n in grams]), np.concatenate([np.array(list(n.values())) for n in grams]))
    text = "abc xyq é ABD!"
    got = language.code_lengths(next(W.texts(pa.array([text, ""]))), trees)
    for k, n in enumerate(grams):
        follow = [defaultdict(Counter) for _ in range(4)]
        for gram, count in n.items():
            data = int(gram).to_bytes(4, "big")
            for order in range(4):
                follow[order][data[3 - order : 3]][data[3]] += count
        bits = 0.0
        for gram in language.grams(next(W.texts(pa.array([text])))).tolist():
            data = gram.to_bytes(4, "big")
            for order in (3, 2, 1, 0):
                seen = follow[order][data[3 - order : 3]]
                total, kinds = seen.total(), len(seen)
                if seen[data[3]] > 0:
                    bits -= math.log2(seen[data[3]] / (total + kinds))
                    break
                seen.pop(data[3], None)
                if total:
                    bits -= math.log2(kinds / (total + kinds))
            else:
                bits += 8
        assert got[0, k] == pytest.approx(bits, rel=1e-4)
    assert got[1].tolist() == [0, 0]


def test_language_on_held_out(spark):
    from framequarry.llm.queries import QUERIES

    got = QUERIES["op2_language_id"](spark, "/root/testdata/sf0.01").where("held_out").join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), "doc_id")
    right = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right >= 0.97


def test_language_edge_cases(spark, docs, rows):
    trees = language.fit_trees(docs.select("text", F.lit("l").alias("lang")))
    got = language.identify_language(spark.createDataFrame([(1, None), (2, ""), (3, "123 !?"), (4, "abc"), (4, "abc"), (None, "日本")], "doc_id long, text string"), trees)
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0), (4, "l", 1.0), (4, "l", 1.0), (None, "l", 1.0)], key=str)
    assert language.fit_trees(empty(spark).select("text", F.lit("l").alias("lang"))) is None
    assert {r.lang_pred for r in language.identify_language(docs, None).collect()} == {"und"}


def test_pieces_round_trip(spark, docs, rows):
    got = pieces.encode_texts(docs, pieces.row_key(F.col("doc_id")))
    assert got.where("not lossless").count() == 0
    back = pieces.decode_texts(got)
    assert sorted(map(tuple, back.collect()), key=str) == sorted([(r[0], r[1]) for r in rows], key=str)
    again = pieces.encode_texts(docs.repartition(5), pieces.row_key(F.col("doc_id")))
    assert sorted(map(str, again.collect())) == sorted(map(str, got.collect()))
    other = pieces.encode_texts(docs, pieces.row_key(F.col("doc_id")), seed=1)
    assert sorted(map(str, other.collect())) != sorted(map(str, got.collect()))


def test_sampled_paths_have_their_probabilities():
    """Draws for a short word against all its segmentations, weighted as the lattice says."""
    words = pieces.vocabulary(pieces.VOCABULARY)
    weight = {}
    for size, (_, ids, weights) in words.by_size.items():
        weight.update({words.spelled[i]: w for i, w in zip(ids, weights)})
    word = b" then"
    paths = {(): 0}

    def walk(at, path, total):
        if at == len(word):
            found[path] = math.exp(total)
        for end in range(at + 1, len(word) + 1):
            if word[at:end] in weight:
                walk(end, (*path, word[at:end]), total + pieces.ALPHA * weight[word[at:end]])

    found: dict = {}
    walk(0, (), 0.0)
    total = sum(found.values())
    n = 40_000
    sampler = pieces.Sampler(words, pieces.ALPHA, 0)
    drawn = Counter()
    for chunk in W.texts(pa.array([word.decode()] * n)):
        ids, bounds = sampler.encode(chunk, np.arange(chunk.first, chunk.first + chunk.n))
        drawn.update(tuple(words.spelled[i] for i in ids[a:b]) for a, b in zip(bounds, bounds[1:]))
    assert set(drawn) <= set(found) and paths
    for path, value in found.items():
        share = value / total
        assert abs(drawn[path] / n - share) < 5 * math.sqrt(share * (1 - share) / n) + 1e-3


def test_toxicity(spark):
    rng = np.random.default_rng(3)
    plain = [sentence(i, 30) for i in range(300)]
    bad = [bool(rng.random() < 0.3) for _ in plain]
    texts = [t[:-1] + " grumble grumbling." if b else t for t, b in zip(plain, bad)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (900, None), (901, ""), (902, "grumbles here"), (5, texts[5])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 if i % 7 else None, int(b)) for i, b in enumerate(bad) if i % 2] + [(None, 0, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.classify(docs, labels).collect()
    assert len(got) == len(rows)
    wrong = [r.doc_id for r in got if r.doc_id is not None and r.doc_id < 300 and r.rejected != bad[r.doc_id]]
    assert not wrong
    named = {r.doc_id: r.rejected for r in got}
    assert not named[900] and not named[901] and named[902]
    assert not any(r.rejected for r in toxicity.classify(docs, labels.limit(0)).collect())
    assert toxicity.classify(docs.limit(0), labels).count() == 0


URLS = [
    (1, "http://a.net/x"), (2, "https://A.Example.NET/en/1?q#f"), (3, "http://example.net/en"), (4, "http://www.example.com/de/1"), (5, "http://example.com/en/"),
    (6, "http://x.org/fr/2"), (7, "http://y.com/start"), (8, "http://z.com/"), (9, "http://w.com/"), (10, None), (11, "no scheme"), (12, "http://net"), (13, "http://y.com/start#part"),
]


def test_urls(spark):
    pages = spark.createDataFrame([(*u, "t") for u in URLS], "page_id long, url string, rule string")
    edges = spark.createDataFrame(
        [("http://y.com/start", "http://a.net/x"), ("http://z.com/", "http://b.net/"), ("http://z.com/", "http://x.org/fr/2"), ("http://w.com/", "http://v.com/")], "src string, dst string",
    )
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.filter_urls(pages, edges, url_filter.rules_frame(spark, url_filter.RULES)).collect()}
    assert got == {
        1: ("net/", "block"), 2: ("example.net/en/", "allow"), 3: ("net/", "block"), 4: ("example.com/de/", "block"), 5: (None, "allow"), 6: ("org/fr/", "allow"),
        7: (None, "block"), 8: (None, "allow"), 9: (None, "allow"), 10: (None, "allow"), 11: (None, "allow"), 12: (None, "allow"), 13: (None, "block"),
    }


def test_links_of_pages(spark):
    page = """<html><head><LINK href='/c?a=1&amp;b=2' rel="canonical"><meta http-equiv=refresh content="0; url=//h.net/r"></head>"""
    rows = spark.createDataFrame([("http://S.com/p#x", page), ("http://s.com/q", None), (None, page)], "url string, html string")
    assert sorted(map(tuple, url_filter.alias_edges(rows).collect())) == [("http://s.com/p", "http://h.net/r"), ("http://s.com/p", "http://s.com/c?a=1&b=2")]


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body class=x><!-- c --><header><h1>Site</h1></header>
<nav><ul><li><a href="/a">Menu<li>Two</ul></nav><div class="cookie-notice">Cookies!</div><main><article><h1>Title &amp; more</h1><p><b>First  one.<br><p>Second&nbsp;a &lt; b
line</p><aside>Side</aside><form><label>Mail</label></form><div class="comments"><p>Reader says</p></div></article></main><footer>&copy; me"""


def test_main_text(spark):
    rows = [(1, "http://h.com/1", PAGE), (2, "http://h.com/2", None), (3, None, ""), (4, "u", "plain text <3"), (5, "http://h.com/5", "<div><p>a</p>b</div><script>x")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, host string")
    got = {r.page_id: (r.text, r.n_chars) for r in main_text.extract_main_text(pages).collect()}
    first = "Title & more\nFirst one.\nSecond a < b line"
    assert got == {1: (first, len(first)), 2: ("", 0), 3: ("", 0), 4: ("plain text <3", 13), 5: ("a\nb", 3)}
    assert main_text.extract_main_text(pages.limit(0)).count() == 0


def test_what_a_host_repeats_is_cut(spark):
    """Unmarked boxes that all pages of a host share are found by their entropy; texts that differ stay."""
    pages = [(i, f"http://h.com/{i}", f"<body><div class=box><p>Same words {i % 2}</p></div><div class=text><p>{sentence(i, 9)}</p></div></body>") for i in range(40)]
    got = main_text.extract_main_text(spark.createDataFrame(pages, "page_id long, url string, html string"))
    assert {r.page_id: r.text for r in got.collect()} == {i: sentence(i, 9) for i in range(40)}


def test_main_text_of_the_pages(spark):
    from framequarry.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    got = {r.page_id: r.text for r in QUERIES["op1_main_text"](spark, folder).collect()}
    for page_id, page in duckdb.sql(f"SELECT page_id, html FROM '{folder}/pages.parquet'").fetchall():
        article = page[page.index("<article>") : page.index("</article>")]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", article)]
        assert got[page_id] == "\n".join(b for b in blocks if b)


def test_copied_articles_stay(spark):
    """Articles that stand several times on a host are kept whole, with an article element inside the wrapper and without."""
    for inner in ("{}", "<article>{}</article>"):
        pages = []
        for i in range(60):
            story = "".join(f"<p>{sentence(1000 + 10 * (i // 5) + j, 9)}</p>" for j in range(3))
            date = f"<span>{i}</span>" if i % 2 else ""
            pages.append((i, f"http://h.com/{i}", f"<body><div class=box><p>Same</p></div><div class=content>{inner.format(story)}</div>{date}</body>"))
        got = main_text.extract_main_text(spark.createDataFrame(pages, "page_id long, url string, html string"))
        for r in got.collect():
            lines = r.text.split("\n")
            assert lines[:3] == [sentence(1000 + 10 * (r.page_id // 5) + j, 9) for j in range(3)]
            assert "Same" not in lines


def test_the_tree_judges_inside_articles(spark):
    """Boxes and paragraphs that a host repeats inside its articles go; main text beside a short article stays."""
    pages = []
    for i in range(40):
        story = "".join(f"<p>{sentence(5000 + 10 * i + j, 9)}</p>" for j in range(3))
        pages.append((i, f"http://h.com/{i}", f"<body><article><h1>{sentence(9000 + i, 4)}</h1><div class=box>Buy now</div><p>All rights kept</p>{story}</article></body>"))
        pages.append((100 + i, f"http://t.com/{i}", f"<body><article>Read more {i}</article><div class=text>{story}</div></body>"))
    got = {r.page_id: r.text.split("\n") for r in main_text.extract_main_text(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    for i in range(40):
        story = [sentence(5000 + 10 * i + j, 9) for j in range(3)]
        assert got[i] == [sentence(9000 + i, 4), *story]
        assert got[100 + i][-3:] == story


def test_small_hosts_and_rare_layouts_are_judged(spark):
    """A box that three pages share is found on a host of three pages, and in a layout that few of a host's pages have."""
    page = "<body><div class=first><p>{}</p></div>{}</body>"
    box = "<div class=extra><p>Same words</p></div>"
    pages = [(i, f"http://few.com/{i}", page.format(sentence(i, 30), box)) for i in range(3)]
    pages += [(10 + i, f"http://many.com/{i}", page.format(sentence(i, 30), box if i < 3 else "")) for i in range(400)]
    got = main_text.extract_main_text(spark.createDataFrame(pages, "page_id long, url string, html string"))
    assert {r.page_id: r.text for r in got.collect()} == {n: sentence(n if n < 10 else n - 10, 30) for n, _, _ in pages}


def test_jaccard_links(spark, rows, docs):
    """Every link counts, also those within a component and those of copies."""
    words = sentence(1, 80).split()
    chain = [(100 + i, " ".join(words[: 80 - 2 * (i // 2)] + [f"x{i // 2}{j}" for j in range(2 * (i // 2))])) for i in range(24)]
    found = [(r[0], r[1]) for r in rows] + chain
    sets = [shingles(t) for _, t in found]
    want = sorted(((d, len(s), sum(1 for j, o in enumerate(sets) if j != i and s and o and 100 * len(s & o) >= 75 * len(s | o))) for i, ((d, _), s) in enumerate(zip(found, sets))), key=str)
    frame = spark.createDataFrame(found, "doc_id long, text string").repartition(3)
    got = jaccard_join.jaccard_links(frame)
    assert sorted(map(tuple, got.select("doc_id", "n_shingles", "n_links").collect()), key=str) == want
    parts = got.drop("n_links")
    assert sorted(map(str, parts.collect())) == sorted(map(str, jaccard_join.jaccard_components(frame).collect()))
    assert max(n for _, _, n in want) > 4 and jaccard_join.jaccard_links(empty(spark)).count() == 0


def test_all_links_of_a_page(spark):
    """All tags count, and relative targets are resolved against the page's place."""
    base = "http://s.com/a/b/c?q=1#f"
    want = {
        "page2.html": "/a/b/page2.html", "../x": "/a/x", "./y?z#t": "/a/b/y?z", "?a=1&amp;b=2": "/a/b/c?a=1&b=2", "../../../up": "/up", "/r/../s": "/s", "..": "/a/",
        "/plain": "/plain", "#g": "/a/b/c?q=1", "mailto:me": None, "../..": "/", ".": "/a/b/",
    }
    page = "".join(f'<link rel=canonical href="{t}">' for t in want) + '<meta http-equiv=refresh content="0;url=one"><meta http-equiv=refresh content="0;url=two">'
    edges = url_filter.alias_edges(spark.createDataFrame([(base, page), ("http://t.com", '<link rel=canonical href="z"><link rel=canonical href="?k">')], "url string, html string"))
    got = sorted(map(tuple, edges.collect()))
    here = [("http://s.com/a/b/c?q=1", f"http://s.com{t}") for t in [*want.values(), "/a/b/one", "/a/b/two"] if t]
    assert got == sorted([*here, ("http://t.com", "http://t.com/z"), ("http://t.com", "http://t.com/?k")])


def test_urls_as_in_sql(spark):
    """Query and SQL agree on pages with several links, from the root and with hosts."""
    two = '<link rel=canonical href="/en/1"><link rel="canonical" href="http://blocked.net/x"><meta http-equiv="refresh" content="0; url=//q.com/">'
    rows = [(1, "http://p.com/a", two), (2, "http://p.com/en/1", ""), (3, "http://q.com/", None), (4, "http://blocked.net/x", ""), (5, "http://free.com/", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = url_filter.filter_urls(pages, url_filter.alias_edges(pages), url_filter.rules_frame(spark, url_filter.RULES))
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    assert sorted(map(tuple, got.collect())) == sorted(con.execute(url_filter.URLS_SQL).fetchall())
    assert [r.verdict for r in got.orderBy("page_id").collect()] == ["block"] * 4 + ["allow"]


def test_small_language_keeps_its_contexts(spark):
    """A language beside a much larger one with many contexts is scored by all of its n-grams."""
    rng = np.random.default_rng(5)
    large = np.unique(rng.integers(97, 123, (300_000, 4)).astype(np.uint32) @ np.array([1 << 24, 1 << 16, 1 << 8, 1], np.uint32))
    large = np.concatenate([large, np.unique(rng.integers(194, 224, (60_000, 4)).astype(np.uint32) @ np.array([1 << 24, 1 << 16, 1 << 8, 1], np.uint32))])
    small = np.unique(language.grams(next(W.texts(pa.array(["Ünï çødé 123 x"])))))
    gram, lang = np.concatenate([large, small]), np.concatenate([np.zeros(len(large), int), np.ones(len(small), int)])
    n = np.where(lang == 0, 1000, 1)
    chunk = next(W.texts(pa.array(["Ünï çødé"])))
    both = language.code_lengths(chunk, language.build_trees(["a", "b"], lang, gram, n))
    alone = language.code_lengths(chunk, language.build_trees(["b"], np.zeros(len(small), int), small, np.ones(len(small), int)))
    assert both[0, 1] == pytest.approx(alone[0, 0], rel=1e-4)
    docs = spark.createDataFrame([("".join(chr(0x4E00 + int(c)) for c in rng.integers(0, 20_000, 3000)), "z") for _ in range(40)], "text string, lang string")
    assert language.gram_counts(docs).count() > 60_000
