"""A page's element tree as far as text extraction needs it: blocks of text with the elements around them."""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import xxhash

# Element names of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: An opening element closes an open one of these kinds, unless one of the bounds stands between them.
CLOSES = {
    "li": ("li", {"ul", "ol", "menu"}), "dt": ("dt dd", {"dl"}), "dd": ("dt dd", {"dl"}), "tr": ("tr td th", {"table"}), "td": ("td th", {"table", "tr"}),
    "th": ("td th", {"table", "tr"}), "option": ("option", {"select"}), "tbody": ("thead tbody tr td th", {"table"}),
}
_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_ATTRIBUTE = re.compile(r"""[\s/]*([^\s=/>]+)(?:\s*=\s*)?""")
_BARE = re.compile(r"[^\s>]*")
_NUMBER = re.compile(r"\d+")

#: Elements deeper than this share the place of the one at this depth in the style tree, so that places stay short.
MOST_DEPTH = 48
#: Longer labels of elements are hashed.
LONGEST_LABEL = 80
#: Marked elements around one another that a block is told of.
MOST_MARKS = 16


class Element(NamedTuple):
    """An open element and what follows from the elements around it."""

    name: str
    path: str  # its place in the style tree: names, classes and ids from the root
    depth: int
    hidden: bool  # in a branch that says itself that it is no article text
    marks: tuple[int, ...]  # numbers of the marked elements around it, itself included
    article: tuple[str, int] | None  # place and number of the outermost article around it


class Article(NamedTuple):
    """An article element: whether it is marked itself, and the marked elements around it."""

    marked: bool
    marks: tuple[int, ...]


def label(name: str, attrs: dict[str, str]) -> str:
    """An element's place among its siblings in the style tree; numbers in classes and ids are left out."""
    shown = " ".join(sorted(set(attrs.get("class", "").split())))
    mark = attrs.get("id", "")
    found = name + (f".{_NUMBER.sub('', shown)}" if shown else "") + (f"#{_NUMBER.sub('', mark)}" if mark else "")
    found = found.replace("/", "|")
    return found if len(found) <= LONGEST_LABEL else f"{name}.{xxhash.xxh3_64_hexdigest(found)}"


class _Tag:
    """The tag that begins at a `<`, if one does: its name, whether it closes, its attributes, and where it ends.

    The page is read once from left to right; a quote without a partner does not make it look for one again and again.
    """

    def __init__(self, page: str):
        self.page, self.last = page, {quote: page.rfind(quote) for quote in "\"'"}

    def read(self, at: int) -> tuple[str, bool, dict[str, str], int] | None:
        page, closing = self.page, self.page.startswith("/", at + 1)
        found = _NAME.match(page, at + 1 + closing)
        if not found:
            return None
        name, attrs, at = found[0].lower(), {}, found.end()
        while True:
            found = _ATTRIBUTE.match(page, at)
            if not found:
                end = page.find(">", at)
                return name, closing, attrs, end + 1 if end >= 0 else len(page)
            at, key, value = found.end(), found[1].lower(), ""
            if "=" in found[0][found.end(1) - found.start() :]:
                quote = page[at : at + 1]
                if quote in self.last and quote and self.last[quote] > at:
                    end = page.index(quote, at + 1)
                    value, at = page[at + 1 : end], end + 1
                else:
                    bare = _BARE.match(page, at)
                    value, at = bare[0].strip("\"'"), bare.end()
            attrs.setdefault(key, html.unescape(value))


def walk(
    page: str, mark: Callable[[str, dict[str, str], bool], str], is_article: Callable[[str, dict[str, str]], bool],
) -> Iterator[tuple[str, Element, str | Article | Element]]:
    """("open", element, parent), ("article", element, Article) and ("text", element, block) in page order, in linear time.

    A block is what stands between two block-level tags, references decoded and white space turned into single blanks.
    `mark` says of an element, and whether it is inside an article, that it is "hidden", "marked" or "". The head is passed over.
    """
    root = Element("", "", 0, False, (), None)
    stack: list[Element] = [root]
    places: dict[str, list[int]] = {}  # of each name, where it stands in the stack
    pieces: list[str] = []
    tag = _Tag(page)
    at, marked, articles, head = 0, 0, 0, 0  # head: the stack's size with the head in it

    def block() -> str:
        text = " ".join(html.unescape("".join(pieces)).split()) if pieces else ""
        pieces.clear()
        return text

    def cut(size: int) -> None:
        nonlocal head
        while len(stack) > size:
            places[stack.pop().name].pop()
        if head > size:
            head = 0

    def nearest(names) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=0)

    while True:
        start = page.find("<", at)
        text = page[at:start] if start >= 0 else page[at:]
        if text and not head:
            pieces.append(text)
        if start < 0:
            break
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = end + 3 if end >= 0 else len(page)
            continue
        if page.startswith(("<!", "<?"), start):
            end = page.find(">", start)
            at = end + 1 if end >= 0 else len(page)
            continue
        found = tag.read(start)
        if not found:
            if not head:
                pieces.append("<")
            at = start + 1
            continue
        name, closing, attrs, at = found
        if name in BLOCK and not head and (text := block()):
            yield "text", stack[-1], text
        if name == "br" and not head:
            pieces.append(" ")
        if closing:
            if places.get(name):
                size = places[name][-1]
                if not head and any(e.name in BLOCK for e in stack[size:]) and (text := block()):
                    yield "text", stack[-1], text
                cut(size)
            continue
        if name in BLOCK and places.get("p") and not any(b > places["p"][0] for b in places.get("button", ())[-1:]):
            cut(places["p"][0])
        elif name in CLOSES:
            ends, bounds = CLOSES[name]
            if (size := nearest(ends.split())) > nearest(bounds):
                cut(size)
        if name in VOID:
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\b", re.I).search(page, at)
            at = end.start() if end else len(page)
            if end:
                close = page.find(">", at)
                at = close + 1 if close >= 0 else len(page)
            continue
        parent = stack[-1]
        said = mark(name, attrs, parent.article is not None)
        marks = parent.marks
        if said == "marked" and len(marks) < MOST_MARKS:
            marked += 1
            marks = (*marks, marked)
        article = parent.article
        path = f"{parent.path}/{label(name, attrs)}" if parent.depth < MOST_DEPTH else parent.path
        begins = article is None and is_article(name, attrs)
        if begins:
            articles += 1
            article = (path, articles)
        element = Element(name, path, parent.depth + 1, parent.hidden or said == "hidden", marks, article)
        places.setdefault(name, []).append(len(stack))
        stack.append(element)
        if name == "head" and not head:
            head = len(stack)
        if not head:
            if begins:
                yield "article", element, Article(said == "marked", parent.marks)
            yield "open", element, parent
    if text := block():
        yield "text", stack[-1], text
