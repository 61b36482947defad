"""The page walker and the words in class names: linear time, and no article lost by a name."""

import math
import re
import time
from collections import Counter

import numpy as np
import pytest
from framequarry.llm import main_text

BODY = "<p>The first paragraph of a story that is long enough to be one.</p><p>The second paragraph of the same story, longer than the first.</p>"
LINES = ["The first paragraph of a story that is long enough to be one.", "The second paragraph of the same story, longer than the first."]


def texts(page):
    return [b.text for b in main_text.read_page(page).blocks]


@pytest.mark.parametrize("page, want", [
    (f'<body><main class="page header-less"><h1>T</h1>{BODY}</main></body>', ["T", *LINES]),
    (f'<body><article><h1 class="post-header">Title</h1>{BODY}</article></body>', ["Title", *LINES]),
    (f'<body><article class="post share-on">{BODY}</article><p>beside</p></body>', [*LINES, "beside"]),
    (f'<body><div class="form-free legal">{BODY}</div></body>', LINES),
    (f'<body><form action="/">{BODY}</form></body>', LINES),
    (f'<body><div class="sidebar-page"><article>{BODY}</article></div><div class="related"><article>Teaser</article></div></body>', LINES),
    (f'<body><div id=content>{BODY}</div><div class="comments"><article class="comment">I like it</article></div><div class="cookie-notice">ok?</div></body>', LINES),
    (f"<body><header>Site</header><nav>Menu</nav>{BODY}<aside>x</aside><footer>c</footer><div hidden>h</div><div style='display: none'>d</div></body>", LINES),
])
def test_words_are_no_sentence(page, want):
    assert texts(page) == want


@pytest.mark.parametrize("page, want", [
    ("a <b c", ["a"]), ("1 < 2 <> 3", ["1 < 2 <> 3"]), ("<p a='x>y'>t", ["t"]), ('<p a="x>t</p>', ["t"]), ("<p a=>t", ["t"]), ("<p / b=c/>t", ["t"]),
    ("<!-- x", []), ("x<!d>y<?p?>z", ["xyz"]), ("<ul><li>a<li>b<ul><li>c</ul></ul>", ["a", "b", "c"]), ("<p>a<div>b</div>c", ["a", "b", "c"]),
    ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]), ("</p></div>x", ["x"]), ("<title>t</title><script>s</script>x", ["x"]), ("<head><p>x</head>y", ["y"]),
])
def test_broken_markup(page, want):
    assert texts(page) == want


@pytest.mark.parametrize("piece", ["<div>", '<a "x', "<a b='", "<li>", "<p><b>", "<div class=ad>", "<", "<!--", "</p>", "<td a=\"", "<span id=x1>y", "&amp;"])
def test_a_megabyte_of_anything(piece):
    page = piece * (1_000_000 // len(piece)) + "end"
    began = time.process_time()
    found = main_text.read_page(page)
    assert time.process_time() - began < 15 and sum(map(len, found.paths)) < 200_000


def test_one_walk_serves_features_and_blocks(spark):
    page = f"<body><article>{BODY}</article></body>"
    rows = [(1, "http://h.com/1", page), (1, "http://h.com/1", page), (None, None, page), (2, "x", None), (3, "http://h.com/2", "<div>" * 30_000 + "deep")]
    got = main_text.extract_main_text(spark.createDataFrame([(*r, 5, "y") for r in rows], "page_id long, url string, html string, layout int, texts string")).collect()
    assert sorted((r.page_id or 0, r.text) for r in got) == [(0, "\n".join(LINES)), (1, "\n".join(LINES)), (1, "\n".join(LINES)), (2, ""), (3, "deep")]


def brute(pages):
    """{page_id: text} by the style tree's formulas, with plain counters per host."""
    hosts, out = {}, {}
    for page_id, host, page in pages:
        hosts.setdefault(host, []).append((page_id, main_text.read_page(page)))
    for own in hosts.values():
        once = {repr(p[:4]): p for _, p in own}.values()
        m, style, text = Counter(), Counter(), Counter()
        for p in once:
            m.update(p.paths)
            style.update((path, s) for path, s in zip(p.paths, p.styles) if s is not None)
            text.update((p.paths[i], key) for i, key in zip(p.places, p.keys))
        inside = {path: bool(re.search(r"/(article|main)([.#][^/]*)?(/|$)", path)) for path in m}

        def smoothed(path, value, inner, outer):
            return (m[path] * value + main_text.PRIOR_PAGES * (inner if inside[path] else outer)) / (m[path] + main_text.PRIOR_PAGES)

        logs, texts, below, blocks = Counter(), Counter(), Counter(), Counter()
        for (path, _), n in text.items():
            logs[path] += math.log(n)
            texts[path] += 1
            parts = path.split("/")
            for i in range(2, len(parts) + 1):
                below["/".join(parts[:i])] += math.log(n)
                blocks["/".join(parts[:i])] += 1
        cut, sure, repeated = set(), set(), set()
        for path in m:
            if m[path] < 2:
                continue
            most = math.log(max(m[path], 2))
            counts = [n for (q, _), n in style.items() if q == path]
            spread = (math.log(sum(counts)) - sum(n * math.log(n) for n in counts) / sum(counts)) / most if counts else 0.0
            if blocks[path] and re.search(r"([^/.#]+)[^/]*$", path)[1] not in main_text.PROSE_ELEMENTS:
                content = 1 - below[path] / blocks[path] / most
                worth = main_text.PRESENTATION_SHARE * spread + (1 - main_text.PRESENTATION_SHARE) * content
                if smoothed(path, worth, main_text.INSIDE, main_text.OUTSIDE) < main_text.IMPORTANCE:
                    cut.add(path)
            if texts[path] and not inside[path] and smoothed(path, 1 - logs[path] / texts[path] / most, main_text.INSIDE, main_text.BESIDE) >= main_text.IMPORTANCE:
                sure.add(path)
            for (q, key), n in text.items():
                if q == path and n > 1 and smoothed(path, 1 - math.log(n) / most, main_text.INSIDE, main_text.BESIDE) < main_text.BLOCK_IMPORTANCE:
                    repeated.add(key)
        for page_id, p in own:
            here = set(p.paths)
            out[page_id] = "\n".join(main_text.main_blocks(p.blocks, sorted(cut & here), sure & here, repeated))
    return out


def test_hosts_on_which_the_tree_decides(spark):
    """Random templates with unmarked boxes: every page as by brute force, and the boxes gone that whole hosts repeat."""
    rng = np.random.default_rng(4)

    def words(n):
        return " ".join(f"w{rng.integers(0, 3000)}" for _ in range(n))

    pages, decided = [], 0
    for h in range(6):
        boxes = [f"<div class=k{k}><p>{words(6)}</p><span>{words(3)}</span></div>" for k in range(4)]
        line = f"<p>{words(7)}</p>"
        for i in range(int(rng.integers(2, 30))):
            story = "".join(f"<p>{words(15)}</p>" for _ in range(rng.integers(1, 5)))
            story = f"<article>{line if rng.random() < 0.8 else ''}{story}{boxes[3] if h % 2 else ''}</article>" if h % 3 else f"<div class=text>{story}</div>"
            shown = [b for b in boxes[:3] if rng.random() < 0.85]
            pages.append((len(pages), f"h{h}.com", f"<body>{''.join(shown[:1])}{story}{''.join(shown[1:])}</body>"))
    pages += [(1000 + i, "h1.com", pages[-1][2]) for i in range(3)]
    want = brute(pages)
    df = spark.createDataFrame([(i, f"http://{host}/{i}", page) for i, host, page in pages], "page_id long, url string, html string").repartition(3)
    assert {r.page_id: r.text for r in main_text.extract_main_text(df).collect()} == want
    for i, _, page in pages:
        decided += want[i] != "\n".join(b.text for b in main_text.read_page(page).blocks)
    assert decided > 0.6 * len(pages)
