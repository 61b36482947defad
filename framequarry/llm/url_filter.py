"""Op 5: judge URLs by host and path rules, and pass decisions on to the URLs they redirect to or name as canonical.

DataFrame operations only. URLs tied by redirect and canonical-link edges form components; a component with a blocked
URL blocks its URLs that have no rule of their own, unless one of its URLs is allowed by a rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import small_frame
from .components import components
from .registry import let, query, read, renamed

#: The rules of the query: action, host, path.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rules_frame(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return small_frame(spark, rules, "action string, rule_host string, rule_path string")


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def node(url: Column) -> Column:
    """The URL without its fragment and with scheme and host in lower case; null where there is no scheme."""
    plain = F.regexp_extract(url, "^[^#]*", 0)
    at = F.instr(plain, "://")
    rest = F.substring(plain, at + 3, F.length(plain))
    size = F.length(F.regexp_extract(rest, "^[^/?]*", 0))
    return F.when(
        at > 0, F.concat(F.translate(F.substring(plain, F.lit(1), at + 2 + size), _UPPER, _LOWER), F.substring(rest, size + 1, F.length(rest))),
    )


# Fixed patterns, the same in the query's SQL: what holds no tags, the tags that link, an attribute with its value, a
# character reference, and the target of a refresh.
_NO_TAGS = r"(?is)<!--.*?(?:-->|\z)" + "".join(rf"|<{e}\b.*?(?:</{e}\b[^>]*>|\z)" for e in ("script", "style", "textarea", "title"))
_TAG = r"(?is)<(?:link|meta|base)[\s/][^>]*>"
_ATTRIBUTE = r"""(?is)([^\s=/"'<>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?"""
_REFERENCE = r"(?i)&(#x[0-9a-f]{1,6}|#[0-9]{1,7}|amp|lt|gt|quot|apos);?"
_REFRESH = r"""(?is)^[\s0-9.]*[;,]?\s*url\s*=\s*["']?([^"']*)"""
_NAMED = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}


def _character(reference: Column) -> Column:
    """What a reference, without its `&` and `;`, stands for."""
    code = F.when(reference.rlike("(?i)^#x"), F.conv(F.substring(reference, 3, 9), 16, 10)).when(reference.startswith("#"), F.substring(reference, 2, 9)).cast("bigint")
    known = (code > 0) & (code <= 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    wide = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    found = F.when(code.isNull(), None).when(known, wide).otherwise("\ufffd")
    for name, character in _NAMED.items():
        found = F.when(F.lower(reference) == name, character).otherwise(found)
    return found


def decoded(text: Column) -> Column:
    """The text with its character references resolved, each once."""
    parts = F.struct(F.split(text, _REFERENCE, -1).alias("plain"), F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(1)).alias("coded"))
    return F.when(F.instr(text, "&") == 0, text).otherwise(let(parts, lambda p: F.array_join(
        F.zip_with(p["plain"], p["coded"], lambda plain, coded: F.concat(plain, F.coalesce(_character(coded), F.lit("")))), "",
    )))


def _attributes(tag: Column) -> Column:
    """href, rel, http-equiv and content of a tag; of repeated ones the first."""
    body = F.regexp_replace(tag, "^<[A-Za-z]+", "")
    names, values = (F.regexp_extract_all(body, F.lit(_ATTRIBUTE), F.lit(group)) for group in (1, 2))
    found = F.zip_with(names, values, lambda name, value: F.struct(F.lower(name).alias("name"), value.alias("value")))

    def value(pairs: Column, name: str) -> Column:
        first = F.get(F.filter(pairs, lambda p: p["name"] == name), 0)["value"]
        plain = F.when(first.rlike("^[\"']"), F.regexp_replace(first, "(?s)^.(.*).$", "$1")).otherwise(first)
        return F.coalesce(F.trim(decoded(plain)), F.lit(""))

    return let(found, lambda pairs: F.struct(*[value(pairs, name).alias(name.replace("-", "_")) for name in ("href", "rel", "http-equiv", "content")]))


def link_targets(pages: DataFrame) -> DataFrame:
    """(url, base, target) of all that pages (url, html) name as their canonical URL and redirect to; `base` as the page says, or null.

    Comments, scripts, styles and texts hold no links. Attribute names are whole, `rel` is a list of tokens, and
    character references are resolved.
    """
    marked = pages.where(F.col("html").rlike("(?i)canonical|refresh")).select("url", F.regexp_extract_all(F.regexp_replace("html", _NO_TAGS, " "), F.lit(_TAG), F.lit(0)).alias("tags"))
    kinds = F.transform("tags", lambda tag: F.struct(F.lower(F.regexp_extract(tag, "^<([A-Za-z]+)", 1)).alias("kind"), _attributes(tag).alias("a")))

    def of(found: Column) -> Column:
        canonical = F.filter(found, lambda t: (t["kind"] == "link") & F.array_contains(F.split(F.lower(t["a"]["rel"]), r"\s+"), "canonical"))
        refresh = F.filter(found, lambda t: (t["kind"] == "meta") & (F.lower(t["a"]["http_equiv"]) == "refresh"))
        targets = F.concat(F.transform(canonical, lambda t: t["a"]["href"]), F.transform(refresh, lambda t: F.trim(F.regexp_extract(t["a"]["content"], _REFRESH, 1))))
        base = F.get(F.filter(found, lambda t: (t["kind"] == "base") & (t["a"]["href"] != "")), 0)["a"]["href"]
        return F.struct(base.alias("base"), F.filter(targets, lambda t: t != "").alias("targets"))

    return marked.select("url", let(kinds, of).alias("found")).select("url", "found.base", F.explode("found.targets").alias("target"))


def _without_dots(place: Column) -> Column:
    """A path from the root without its `.` and `..` segments; `..` takes the segment before it away."""
    segments = F.slice(F.split(place, "/"), 2, F.size(F.split(place, "/")))
    last = F.element_at(segments, -1)
    kept = F.aggregate(
        segments, F.array().cast("array<string>"),
        lambda kept, s: F.when(s == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0)))).when(s == ".", kept).otherwise(F.concat(kept, F.array(s))),
    )
    return F.concat(F.lit("/"), F.array_join(kept, "/"), F.when(last.isin(".", "..") & (F.size(kept) > 0), "/").otherwise(""))


def resolved(base: Column, target: Column) -> Column:
    """`target` as an absolute URL, seen from the page `base`; null for schemes without `//`, and without a base host."""
    return let(F.struct(base.alias("base"), target.alias("target")), lambda x: _resolved(x["base"], x["target"]))


def _resolved(base: Column, target: Column) -> Column:
    root = F.concat(F.regexp_extract(base, "^(.*?)://", 1), F.lit("://"), host(base))
    place = F.when(path(base) == "", "/").otherwise(path(base))
    # The target's path, and its query and fragment.
    own, rest = F.regexp_extract(target, "^[^?#]*", 0), F.regexp_extract(target, "^[^?#]*(.*)$", 1)
    query_of_base = F.regexp_extract(base, "^[^?#]*(\\?[^#]*)?", 1)
    return (
        F.when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.startswith("//"), F.concat(F.regexp_extract(base, "^(.*?)://", 1), F.lit(":"), target))
        .when((F.instr(base, "://") == 0) | target.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), None)
        .when(own.startswith("/"), F.concat(root, F.when(own.rlike("/\\.\\.?(/|$)"), _without_dots(own)).otherwise(own), rest))
        .when(target.startswith("#"), F.concat(root, path(base), query_of_base))
        .when(own == "", F.concat(root, place, rest))
        .otherwise(F.concat(root, _without_dots(F.concat(F.regexp_extract(place, "^(.*/)", 1), own)), rest))
    )


def alias_edges(pages: DataFrame) -> DataFrame:
    """(src, dst) nodes of every canonical link and redirect of pages (url, html)."""
    ends = link_targets(pages)
    base = F.coalesce(resolved(F.col("url"), F.col("base")), F.col("url"))
    return ends.select("url", "target", base.alias("base")).select(
        node(F.col("url")).alias("src"), let(resolved(F.col("base"), F.col("target")), node).alias("dst"),
    ).where("src is not null and dst is not null")


def judged(places: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, action) of those (host, path) that a rule fits; the longest rule wins, allow among equals.

    A rule is looked up by the host and its parent domains, so a long list costs an equi-join, not a comparison of each.
    """
    labels = F.split("host", "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fits = (
        places.distinct().select("host", "path", F.explode(suffixes).alias("rule_host")).join(rules, "rule_host")
        .where(F.startswith(F.col("path"), F.col("rule_path"))).withColumn("rule", F.concat("rule_host", "rule_path"))
    )
    best = F.struct(F.length("rule").alias("size"), (F.col("action") == "allow").alias("allow"), F.col("rule"), F.col("action"))
    return fits.groupBy("host", "path").agg(F.max(best).alias("best")).select("host", "path", "best.rule", "best.action")


def filter_urls(df: DataFrame, edges: DataFrame, rules: DataFrame, id_column: str = "page_id", url_column: str = "url") -> DataFrame:
    """One row per row of `df`: page_id, host, path, rule, verdict.

    `edges` (src, dst) holds nodes as `node` makes them, `rules` (action, rule_host, rule_path). A URL that a rule fits
    has the rule's action. Any other is blocked when its component holds a blocked URL and no allowed one, else allowed.
    A null URL, or one without `://`, has empty host and path, no rule and no edges, and is allowed. Repeated rows stay.
    Extra columns are not read; empty tables of pages, edges or rules are fine.
    """
    urls = renamed(df, page_id=id_column, url=url_column).select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), node(F.col("url")).alias("node"))
    parts = components(edges, "src", "dst").select(F.col("node").alias("alias"), "component")
    aliases = parts.select("component", host(F.col("alias")).alias("host"), path(F.col("alias")).alias("path"))
    named = judged(urls.select("host", "path").union(aliases.select("host", "path")).where("host <> ''"), rules)
    told = aliases.join(named, ["host", "path"]).groupBy("component").agg(
        F.max(F.col("action") == "block").alias("blocked"), F.max(F.col("action") == "allow").alias("allowed"),
    ).where("blocked and not allowed").select("component", F.lit("block").alias("passed_on"))
    passed = parts.join(told, "component").select("alias", "passed_on")
    return (
        urls.join(named, ["host", "path"], "left").join(passed, F.col("node") == F.col("alias"), "left")
        .select("page_id", "host", "path", "rule", F.coalesce("action", "passed_on", F.lit("allow")).alias("verdict"))
    )


_PLACE = """CASE WHEN instr({0}, '://') > 0 THEN substr({0}, instr({0}, '://') + 3) ELSE '' END"""
_HOST = "translate(regexp_extract(coalesce(" + _PLACE + ", ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = "regexp_extract(coalesce(" + _PLACE + ", ''), '^[^/?#]*([^?#]*)', 1)"
_NODE = (
    "CASE WHEN instr(regexp_extract({0}, '^[^#]*'), '://') > 0 THEN lower(regexp_extract({0}, '^[^#]*?://')) || " + _HOST
    + " || regexp_extract(regexp_extract({0}, '^[^#]*'), '^.*?://[^/?]*(.*)$', 1) END"
)
_Q = {name: value.replace("'", "''") for name, value in (("no_tags", _NO_TAGS), ("tag", _TAG), ("attribute", _ATTRIBUTE), ("reference", _REFERENCE), ("refresh", _REFRESH))}


def _decoded_sql(text: str) -> str:
    code = "CASE WHEN regexp_matches(r, '(?i)^#x') THEN CAST(('0x' || substr(r, 3)) AS BIGINT) WHEN starts_with(r, '#') THEN CAST(substr(r, 2) AS BIGINT) END"
    named = " ".join(f"WHEN lower(r) = '{name}' THEN '{value.replace(chr(39), chr(39) * 2)}'" for name, value in _NAMED.items())
    character = f"CASE {named} WHEN {code} BETWEEN 1 AND 1114111 AND NOT {code} BETWEEN 55296 AND 57343 THEN chr(CAST({code} AS INTEGER)) ELSE chr(65533) END"
    plain, coded = f"string_split_regex({text}, '{_Q['reference']}')", f"regexp_extract_all({text}, '{_Q['reference']}', 1)"
    return f"array_to_string(list_transform(list_zip({plain}, list_transform({coded}, lambda r: {character})), lambda z: z[1] || coalesce(z[2], '')), '')"


def _attribute_sql(name: str) -> str:
    first = f"list_filter(list_zip(list_transform(regexp_extract_all(body, '{_Q['attribute']}', 1), lambda x: lower(x)), regexp_extract_all(body, '{_Q['attribute']}', 2)), lambda p: p[1] = '{name}')[1][2]"
    plain = f"(CASE WHEN regexp_matches({first}, '^[\"'']') THEN regexp_extract({first}, '(?s)^.(.*).$', 1) ELSE {first} END)"
    return f"coalesce(trim({_decoded_sql(plain)}), '')"


def _dots_sql(place: str) -> str:
    segments = f"list_slice(string_split({place}, '/'), 2, NULL)"
    kept = (
        f"list_reduce(list_prepend(CAST([] AS VARCHAR[]), list_transform({segments}, lambda s: [s])), "
        "lambda a, b: CASE WHEN b[1] = '..' THEN list_slice(a, 1, len(a) - 1) WHEN b[1] = '.' THEN a ELSE list_concat(a, b) END)"
    )
    return f"('/' || array_to_string({kept}, '/') || CASE WHEN {segments}[-1] IN ('.', '..') AND len({kept}) > 0 THEN '/' ELSE '' END)"


def _resolved_sql(base: str, target: str) -> str:
    scheme = f"regexp_extract({base}, '^(.*?)://', 1)"
    root, path_of = f"{scheme} || '://' || {_HOST.format(base)}", _PATH.format(base)
    place = f"CASE WHEN {path_of} = '' THEN '/' ELSE {path_of} END"
    own, rest = f"regexp_extract({target}, '^[^?#]*')", f"regexp_extract({target}, '^[^?#]*(.*)$', 1)"
    return f"""CASE WHEN regexp_matches({target}, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN {target} WHEN starts_with({target}, '//') THEN {scheme} || ':' || {target}
    WHEN instr({base}, '://') = 0 OR regexp_matches({target}, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
    WHEN starts_with({own}, '/') THEN {root} || CASE WHEN regexp_matches({own}, '/\\.\\.?(/|$)') THEN {_dots_sql(own)} ELSE {own} END || {rest}
    WHEN starts_with({target}, '#') THEN {root} || {path_of} || regexp_extract({base}, '^[^?#]*(\\?[^#]*)?', 1)
    WHEN {own} = '' THEN {root} || {place} || {rest} ELSE {root} || {_dots_sql(f"(regexp_extract({place}, '^(.*/)', 1) || {own})")} || {rest} END"""


URLS_SQL = f"""
WITH RECURSIVE marked AS (
  SELECT row_number() OVER () AS page, url, regexp_extract_all(regexp_replace(html, '{_Q['no_tags']}', ' ', 'g'), '{_Q['tag']}') AS tags FROM pages WHERE regexp_matches(html, '(?i)canonical|refresh')
), tags AS (SELECT page, url, i, tags[i] AS tag, regexp_replace(tags[i], '^<[A-Za-z]+', '') AS body FROM (SELECT *, unnest(range(1, len(tags) + 1)) AS i FROM marked)
), told AS (
  SELECT page, url, i, lower(regexp_extract(tag, '^<([A-Za-z]+)', 1)) AS kind, {_attribute_sql('href')} AS href, {_attribute_sql('rel')} AS rel,
    {_attribute_sql('http-equiv')} AS equiv, {_attribute_sql('content')} AS content FROM tags
), bases AS (SELECT page, arg_min(href, i) AS base FROM told WHERE kind = 'base' AND href <> '' GROUP BY page
), targets AS (
  SELECT page, url, href AS t FROM told WHERE kind = 'link' AND list_contains(string_split_regex(lower(rel), '\\s+'), 'canonical')
  UNION ALL SELECT page, url, trim(regexp_extract(content, '{_Q['refresh']}', 1)) FROM told WHERE kind = 'meta' AND lower(equiv) = 'refresh'
), based AS (SELECT url, t, coalesce({_resolved_sql('url', 'base')}, url) AS base FROM targets LEFT JOIN bases USING (page) WHERE t <> ''
), ends AS (SELECT url, {_resolved_sql('base', 't')} AS t FROM based
), edges AS (SELECT {_NODE.format("url")} AS a, {_NODE.format("t")} AS b FROM ends
), pairs AS (SELECT a, b FROM edges WHERE a <> b UNION SELECT b, a FROM edges WHERE a <> b
), reach AS (SELECT a, a AS r FROM pairs UNION SELECT p.a, reach.r FROM reach JOIN pairs p ON p.b = reach.a
), parts AS (SELECT a, min(r) AS c FROM reach GROUP BY a
), rules(action, h, p) AS (VALUES {", ".join(str(r) for r in RULES)}
), urls AS (SELECT page_id, {_HOST.format("url")} AS host, {_PATH.format("url")} AS path, {_NODE.format("url")} AS node FROM pages
), places AS (SELECT DISTINCT host, path FROM urls UNION SELECT {_HOST.format("a")}, {_PATH.format("a")} FROM parts
), named AS (
  SELECT host, path, h || p AS rule, action FROM places JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  QUALIFY row_number() OVER (PARTITION BY host, path ORDER BY length(h || p) DESC, action) = 1
), spread AS (
  SELECT c, bool_or(action = 'block') AND NOT bool_or(action = 'allow') AS bad FROM parts JOIN named ON host = {_HOST.format("a")} AND path = {_PATH.format("a")} GROUP BY c
)
SELECT page_id, host, path, rule, CASE WHEN action IS NOT NULL THEN action WHEN bad THEN 'block' ELSE 'allow' END AS verdict
FROM urls LEFT JOIN named USING (host, path) LEFT JOIN parts ON node = a LEFT JOIN spread USING (c)
"""


@query("op5_url_filter", URLS_SQL)
def op5_url_filter(spark, sf_dir):
    pages = read(spark, sf_dir, "pages", "page_id", "url", "html")
    return filter_urls(pages, alias_edges(pages), rules_frame(spark, RULES))
