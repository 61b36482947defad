"""Links of pages for the URL filter: what is a link and what is none, and the query's SQL on the same pages."""

import html

import duckdb
import pytest
from framequarry.llm import url_filter
from pyspark.sql import functions as F

BAD = "http://bad.net/x"
PAGES = [
    ("comment", f'<!-- <link rel="canonical" href="{BAD}"> --><p>x</p>', []),
    ("script", f"<script>var s = '<link rel=\"canonical\" href=\"{BAD}\">';</script>", []),
    ("tokens", f'<link rel="alternate canonical" href="{BAD}">', [BAD]),
    ("data", f'<link rel="canonical" data-href="{BAD}" href="http://good.org/">', ["http://good.org/"]),
    ("based", '<base href="http://bad.net/dir/"><link rel="canonical" href="page">', ["http://bad.net/dir/page"]),
    ("numeric", '<link rel=canonical href="http:&#47;&#x2F;bad.net&#47x">', [BAD]),
    ("comment in script", f'<script>"<!--"</script><link rel=canonical href={BAD}>', [BAD]),
    ("script in comment", f"<!-- <script> --><link rel=CANONICAL href='{BAD}'>", [BAD]),
    ("style and text", f'<style>/* <link rel=canonical href="{BAD}"> */</style><textarea><link rel=canonical href="{BAD}"></textarea><title><link rel=canonical href="{BAD}"></title>', []),
    ("open comment", f'x<!-- <link rel=canonical href="{BAD}">', []),
    ("other rel", f'<link rel="canonical-like" href="{BAD}"><link rel="stylesheet" href="{BAD}">', []),
    ("twice told", f'<link rel=canonical href="{BAD}" href="http://good.org/">', [BAD]),
    ("inside a value", f'<link title="rel=canonical href={BAD}" rel=next href="/n">', []),
    ("refresh", f'<meta content="5; URL={BAD}" http-equiv="Refresh">', [BAD]),
    ("quoted refresh", "<meta http-equiv=refresh content=\"0;url='http://bad.net/x'\">", [BAD]),
    ("no target", '<meta http-equiv="refresh" content="30"><link rel=canonical><link rel=canonical href="">', []),
    ("other meta", f'<meta name="refresh" content="0;url={BAD}">', []),
    ("ampersands", '<link rel=canonical href="/a?b=1&amp;c=2&amp;amp;d=&lt;">', ["http://s.com/a?b=1&c=2&amp;d=<"]),
    ("dots", '<link rel=canonical href="../../up/./x/..">', ["http://s.com/up/"]),
    ("query only", '<link rel=canonical href="?q">', ["http://s.com/d/p?q"]),
    ("scheme", '<link rel=canonical href="//Other.com/Y#frag">', ["http://other.com/Y"]),
    ("relative base", '<base href="/b/c"><link rel=canonical href="z">', ["http://s.com/b/z"]),
    ("base without", '<base target="_top"><link rel=canonical href="z">', ["http://s.com/d/z"]),
    ("mail", '<link rel=canonical href="mailto:a@b">', []),
    ("wide", '<link rel=canonical href="/&#x1F600;&#0;&#55296;&#xe9;">', ["http://s.com/\U0001f600\ufffd\ufffd\u00e9"]),
    ("null", None, []),
    ("empty", "", []),
]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"http://s.com/d/p?{i}" if name != "query only" else "http://s.com/d/p?x", text) for i, (name, text, _) in enumerate(PAGES)]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_links(pages):
    found = {}
    for r in url_filter.alias_edges(pages.withColumn("url", F.concat("url", F.lit("#"), "page_id"))).collect():
        found.setdefault(r.src, []).append(r.dst)
    for i, (name, _, want) in enumerate(PAGES):
        own = "http://s.com/d/p?x" if name == "query only" else f"http://s.com/d/p?{i}"
        assert found.get(own, []) == want, name


def test_query_and_sql_agree(spark, pages, tmp_path):
    named = pages.withColumn("url", F.concat(F.lit("http://h"), "page_id", F.lit(".com/d/p"))).coalesce(1)
    named.write.parquet(str(tmp_path / "pages.parquet"))
    got = url_filter.filter_urls(named, url_filter.alias_edges(named), url_filter.rules_frame(spark, url_filter.RULES))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    rows = sorted(map(tuple, got.collect()))
    assert rows == sorted(con.execute(url_filter.URLS_SQL).fetchall())
    blocked = {PAGES[r[0]][0] for r in rows if r[4] == "block"}
    assert blocked == {name for name, _, want in PAGES if any("bad.net" in w for w in want)}


def test_references(spark):
    texts = ["", "a&b", "&amp;&#65;&#x41;&lt;&GT;", "&#47;&unknown;&amp", "&#1114112;&#x110000;", "&amp;#65;", "&quot;&apos;"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1).select(url_filter.decoded(F.col("t"))).collect()]
    assert got == [html.unescape(t).replace("&unknown;", "&unknown;") if "GT" not in t else "&AA<>" for t in texts]
