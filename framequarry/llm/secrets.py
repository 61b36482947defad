"""Op 12: find secrets in texts, with DataFrame operations only.

Three fixed patterns find what names itself or has a telling shape. What they find is also the labelled sample of random
strings; the other long tokens of the corpus whose digits end their parts are that of ordinary identifiers. A first-order Markov model of characters
is counted over all of either sample, and a token whose characters are far likelier under the first is a secret too.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..session import stage
from .registry import let, query, read, renamed

# The patterns by kind, the group that holds the secret, and its least length.
BASE = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]{16,}", 0, 16),
}
#: What the models judge: whole tokens of so many characters that hold no part of a span of the fixed patterns.
TOKEN_CHARACTERS = 16
TOKEN = rf"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{{{TOKEN_CHARACTERS},}}"
#: Tokens without such a place are labelled as ordinary identifiers: digits end a part of a name, and are few.
UNLIKE_NAMES = "[0-9][A-Za-z]|[0-9]{5}"
#: A token is a secret when its characters are e**NATS times as likely in random strings as in identifiers.
NATS = 12.0
#: Pairs that a character's own share counts for in the probability of a transition to it.
BACKED_OFF = 8
#: Characters of tokens lie between these codes.
_LOW, _CODES = 43, 80
#: Running sums are built in pieces of this size, so that their cost does not grow with the square of the number of spans.
_PIECE = 256


def _sums(xs: Column) -> Column:
    zero = F.array(F.lit(0).cast("long"))
    return F.slice(F.aggregate(xs, zero, lambda done, x: F.concat(done, F.array(F.element_at(done, -1) + x))), 2, F.size(xs))


def running_sums(xs: Column) -> Column:
    """The sum of each element and all before it, of an array of longs."""

    def joined(pieces: Column) -> Column:
        totals = F.transform(pieces, lambda p: F.aggregate(p, F.lit(0).cast("long"), lambda a, b: a + b))
        return let(_sums(totals), lambda ends: F.flatten(F.transform(
            pieces, lambda p, i: let(F.when(i == 0, F.lit(0)).otherwise(F.get(ends, i - 1)).cast("long"), lambda before: F.transform(_sums(p), lambda x: x + before)),
        )))

    starts = F.sequence(F.lit(1), F.greatest(F.size(xs), F.lit(1)), F.lit(_PIECE))
    return let(F.transform(starts, lambda at: F.slice(xs, at, _PIECE)), joined)


_SPANS = "array<struct<start:bigint,end:bigint,value:string>>"


def located(text: Column, pattern: str, group: int = 0, least: int = 1) -> Column:
    """start, end (code points, exclusive) and value of the leftmost matches that do not overlap; value is the given group.

    Matches whose value has fewer than `least` characters take their place in the text, but are left out.
    """

    def spans(found: Column) -> Column:
        sizes = F.zip_with(found["gaps"], found["whole"], lambda gap, match: F.struct(F.length(gap).alias("gap"), F.coalesce(F.length(match), F.lit(0)).alias("size")))

        def placed(s: Column) -> Column:
            return let(running_sums(F.transform(s, lambda x: (x["gap"] + x["size"]).cast("long"))), lambda ends: F.transform(
                found["values"], lambda value, i: F.struct((F.get(ends, i) - F.get(s, i)["size"]).alias("start"), F.get(ends, i).alias("end"), value.alias("value")),
            ))

        return let(sizes, placed)

    values = [F.regexp_extract_all(text, F.lit(pattern), F.lit(g)) for g in (0, group)]
    found = F.struct(F.split(text, pattern, -1).alias("gaps"), values[0].alias("whole"), values[1].alias("values"))
    kept = F.filter(let(found, spans), lambda s: F.length(s["value"]) >= least)
    return F.when(text.rlike(pattern), kept.cast(_SPANS)).otherwise(F.array().cast(_SPANS))


def blanked(text: Column, pattern: str, group: int, least: int) -> Column:
    """The text with blanks in place of those matches, as many as they have characters, so that places stay."""

    def joined(found: Column) -> Column:
        return F.array_join(F.zip_with(found["gaps"], F.zip_with(found["whole"], found["values"], lambda whole, value: F.struct(whole.alias("whole"), value.alias("value"))), lambda gap, m: F.concat(
            gap, F.when(F.length(m["value"]) >= least, F.repeat(F.lit(" "), F.length(m["whole"]))).otherwise(F.coalesce(m["whole"], F.lit(""))),
        )), "")

    values = [F.regexp_extract_all(text, F.lit(pattern), F.lit(g)) for g in (0, group)]
    found = F.struct(F.split(text, pattern, -1).alias("gaps"), values[0].alias("whole"), values[1].alias("values"))
    return F.when(text.rlike(pattern), let(found, joined)).otherwise(text)


def pair_codes(value: Column) -> Column:
    """One number per pair of neighbouring characters; characters outside the tokens' alphabet take part in no pair."""
    codes = F.transform(F.split(value, ""), lambda c: F.ascii(c) - _LOW)
    return let(codes, lambda c: F.filter(
        F.zip_with(F.slice(c, 1, F.greatest(F.size(c) - 1, F.lit(0))), F.slice(c, 2, F.size(c)), lambda a, b: F.when(a.between(0, _CODES - 1) & b.between(0, _CODES - 1), a * _CODES + b)),
        lambda code: code.isNotNull(),
    ))


def train_models(random: DataFrame, ordinary: DataFrame) -> list[float]:
    """The log ratio of each pair of characters, of values (value) of random strings over those of ordinary identifiers.

    A transition's probability counts its pair beside the character's own share of the sample, which weighs as much as
    BACKED_OFF pairs; that share is smoothed by one count, so that an empty sample is the uniform model. At most one row
    per pair of the alphabet and model comes to the driver.
    """
    labelled = random.select("value", F.lit(1).alias("random")).unionByName(ordinary.select("value", F.lit(0).alias("random")))
    counts = labelled.select("random", F.explode(pair_codes(F.col("value"))).alias("code")).groupBy("random", "code").count()
    seen = np.zeros((2, _CODES, _CODES))
    for r in counts.collect():
        seen[r["random"], r["code"] // _CODES, r["code"] % _CODES] = r["count"]
    share = (seen.sum(axis=1) + 1) / (seen.sum(axis=(1, 2)) + _CODES)[:, None]
    chance = (seen + BACKED_OFF * share[:, None, :]) / (seen.sum(axis=2) + BACKED_OFF)[:, :, None]
    return np.log(chance[1] / chance[0]).ravel().tolist()


def log_ratio(value: Column, ratios: Sequence[float]) -> Column:
    """How much likelier a token's characters are in random strings than in identifiers, as a logarithm."""
    table = F.split(F.lit(",".join(f"{x:.9g}" for x in ratios)), ",").cast("array<double>")
    return F.aggregate(pair_codes(value), F.lit(0.0), lambda total, code: total + F.get(table, code))


def find_secrets(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", nats: float = NATS) -> DataFrame:
    """One row per row of `df`: doc_id, spans (kind, start, end, value, score), by start, then kind.

    Kinds are `assign`, `access`, `hex` (in this order among spans with one start, score null) and `markov`. Places are
    code points of the whole text, the end exclusive; an assignment's span begins with its keyword, its value is what is
    assigned. Spans of one kind do not overlap, and `markov` spans overlap no other; fixed patterns may overlap. A null
    or empty text has no spans. The models are learnt from all of `df`; without a span of the fixed patterns, random
    strings are taken to be uniform. Rows are judged alone, so null ids and repeated rows are nothing special. Extra
    columns are not read. An empty table gives no rows.
    """
    own = renamed(df, doc_id=id_column, text=text_column).withColumn("text", F.coalesce("text", F.lit("")))
    spans = own.select("doc_id", *[located(F.col("text"), *rule).alias(kind) for kind, rule in BASE.items()], F.col("text").alias("rest"))
    for rule in BASE.values():
        spans = spans.withColumn("rest", blanked(F.col("rest"), *rule))
    found = stage(spans.select("doc_id", *BASE, located(F.col("rest"), TOKEN).alias("tokens")), "spans")
    random = found.select(F.explode(F.concat(*BASE)).alias("s")).select("s.value")
    ordinary = found.select(F.explode("tokens").alias("s")).select("s.value").where(~F.col("value").rlike(UNLIKE_NAMES))
    ratios = train_models(random, ordinary)

    def shaped(kind: str, rank: int, score: Callable[[Column], Column]) -> Callable[[Column], Column]:
        return lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), s["end"].alias("end"), s["value"].alias("value"), score(s).alias("score"))

    fixed = [F.transform(kind, shaped(kind, rank, lambda s: F.lit(None).cast("double"))) for rank, kind in enumerate(BASE)]
    judged = F.filter(F.transform("tokens", shaped("markov", len(BASE), lambda s: log_ratio(s["value"], ratios))), lambda s: s["score"] >= nats)
    every = F.array_sort(F.concat(*fixed, judged))
    return found.select("doc_id", F.transform(every, lambda s: F.struct(*[s[c].alias(c) for c in ("kind", "start", "end", "value", "score")])).alias("spans"))


def _of(kind: str) -> Callable[[Column], Column]:
    return lambda s: s["kind"] == kind


def _shown(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _text(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _placed_sql(name: str, source: str, text: str, pattern: str, group: int) -> str:
    """What stands between the matches of each text (p), the matches (f), and their values (v)."""
    found = f"regexp_extract_all({text}, {_text(pattern)}"
    return f"{name} AS (SELECT rid, string_split_regex({text}, {_text(pattern)}) AS p, {found}) AS f, {found}, {group}) AS v FROM {source} WHERE regexp_matches({text}, {_text(pattern)}))"


def _spans_sql(kind: str, rank: int, source: str, least: int) -> str:
    start = "list_sum(list_transform(p[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(f[1:i - 1], lambda x: len(x))), 0)"
    return (
        f"SELECT rid, {rank} AS rank, '{kind}' AS kind, CAST({start} AS BIGINT) AS lo, CAST({start} + len(f[i]) AS BIGINT) AS hi, v[i] AS value "
        f"FROM (SELECT *, unnest(range(1, len(f) + 1)) AS i FROM {source}) WHERE len(v[i]) >= {least}"
    )


def _blanked_sql(name: str, before: str, source: str, least: int) -> str:
    match = f"CASE WHEN i > len(f) THEN '' WHEN len(v[i]) >= {least} THEN repeat(' ', len(f[i])) ELSE f[i] END"
    joined = f"array_to_string(list_transform(range(1, len(p) + 1), lambda i: p[i] || {match}), '')"
    return f"{name} AS (SELECT rid, CASE WHEN p IS NULL THEN t ELSE {joined} END AS t FROM {before} LEFT JOIN {source} USING (rid))"


def _secrets_sql() -> str:
    parts, texts = ["docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents)"], "docs"
    for kind, (pattern, group, least) in BASE.items():
        parts.append(_placed_sql(kind, "docs", "t", pattern, group))
        # What one kind leaves is looked through for the next, on its own text.
        parts += [_placed_sql(f"{kind}_rest", texts, "t", pattern, group), _blanked_sql(f"without_{kind}", texts, f"{kind}_rest", least)]
        texts = f"without_{kind}"
    # Runs of the tokens' characters are whole without a look behind.
    parts.append(_placed_sql("token", texts, "t", TOKEN.partition(")")[2], 0))
    base = " UNION ALL ".join(_spans_sql(kind, rank, kind, least) for rank, (kind, (_, _, least)) in enumerate(BASE.items()))
    codes = f"range(1, len(value)) q(i)) WHERE a BETWEEN 0 AND {_CODES - 1} AND b BETWEEN 0 AND {_CODES - 1}"
    pair = f"ord(substr(value, i, 1)) - {_LOW} AS a, ord(substr(value, i + 1, 1)) - {_LOW} AS b"
    return f"""WITH {", ".join(parts)}
, base AS ({base}), tokens AS ({_spans_sql("markov", len(BASE), "token", 1)})
, samples AS (SELECT 1 AS label, value FROM base UNION ALL SELECT 0, value FROM tokens WHERE NOT regexp_matches(value, '{UNLIKE_NAMES}'))
, seen AS (SELECT label, a, b, count(*) AS n FROM (SELECT label, {pair} FROM samples, {codes} GROUP BY ALL)
, grid AS (SELECT label, a, b FROM range(2) x(label), range({_CODES}) y(a), range({_CODES}) z(b))
, totals AS (SELECT label, sum(n) AS n FROM seen GROUP BY label), firsts AS (SELECT label, a, sum(n) AS n FROM seen GROUP BY ALL), seconds AS (SELECT label, b, sum(n) AS n FROM seen GROUP BY ALL)
, chances AS (
  SELECT label, a, b, (coalesce(s.n, 0) + {BACKED_OFF} * (coalesce(v.n, 0) + 1) / (coalesce(t.n, 0) + {_CODES})) / (coalesce(u.n, 0) + {BACKED_OFF}) AS chance
  FROM grid LEFT JOIN seen s USING (label, a, b) LEFT JOIN totals t USING (label) LEFT JOIN firsts u USING (label, a) LEFT JOIN seconds v USING (label, b))
, ratios AS (SELECT x.a, x.b, ln(x.chance / y.chance) AS ratio FROM chances x JOIN chances y USING (a, b) WHERE x.label = 1 AND y.label = 0)
, scored AS (SELECT rid, rank, kind, lo, hi, value FROM (SELECT *, {pair} FROM tokens, {codes.replace(') WHERE', ') x JOIN ratios USING (a, b) WHERE')} GROUP BY ALL HAVING sum(ratio) >= {NATS})
, every AS (SELECT * FROM base UNION ALL SELECT * FROM scored)
, shown AS (
  SELECT rid, {", ".join(f"count(*) FILTER (WHERE kind = '{kind}') AS n_{kind}" for kind in BASE)},
    string_agg(kind || ':' || lo || ':' || hi, ',' ORDER BY lo, rank) FILTER (WHERE kind <> 'markov') AS base, string_agg(kind || ':' || lo || ':' || hi, ',' ORDER BY lo, rank) AS spans
  FROM every GROUP BY rid)
SELECT doc_id, {", ".join(f"coalesce(n_{kind}, 0) AS n_{kind}" for kind in BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM docs LEFT JOIN shown USING (rid)"""


@query("op12_secret_scan", _secrets_sql())
def op12_secret_scan(spark, sf_dir):
    found = find_secrets(read(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select(
        "doc_id", *[F.size(F.filter("spans", _of(kind))).cast("long").alias(f"n_{kind}") for kind in BASE],
        F.sha2(_shown(F.filter("spans", lambda s: s["kind"] != "markov")).cast("binary"), 256).alias("base_sha256"), _shown(F.col("spans")).alias("spans"),
    )
