"""Timestamp expressions; every result is an instant in UTC."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from .text import stripped

# The keys of a session's metadata that may hold its start, best first.
START_KEYS = ("captured_at", "started_at", "start_time", "start", "date")

# Date, hour, minute, second, fraction, offset sign and parts; separators all present or all absent.
_MOMENT = (
    r"(?s)^(\d{4})(-?)(\d{2})\2(\d{2})"
    r"(?:.(\d{2})(?:(:?)(\d{2})(?:\6(\d{2})(?:[.,](\d+))?)?)?"
    r"(?:([+-])(\d{2})(?::?(\d{2})(?::?(\d{2}))?)?)?)?$"
)
_PARTS = "$1-$3-$4|$5|$7|$8|$9|$10|$11|$12|$13"
_WEEK = r"(?s)^(\d{4})(-?)W(\d{2})(?:\2([1-7]))?(?!\d)(.*)$"


def epoch_time(seconds: Column | int) -> Column:
    return F.timestamp_seconds(seconds if isinstance(seconds, Column) else F.lit(seconds))


def _week_to_calendar(text: Column, week: Column) -> Column:
    """`text` with its leading ISO week date (year, week, day and rest in `week`, else NULL) replaced by the calendar date.

    An impossible week stays unparsable.
    """
    year = F.get(week, F.lit(0)).cast("int")
    fourth = F.make_date(year, F.lit(1), F.lit(4))
    monday = F.date_add(fourth, (F.get(week, F.lit(1)).cast("int") - 1) * 7 - F.weekday(fourth))
    exists = (F.year(F.date_add(monday, 3)) == year) & (F.get(week, F.lit(1)) != "00")
    day = F.date_add(monday, F.coalesce(F.nullif(F.get(week, F.lit(2)), F.lit("")).cast("int") - 1, F.lit(0)))
    return F.when(week.isNull(), text).when(exists, F.concat(day.cast("string"), F.get(week, F.lit(3))))


def _instant(parts: Column) -> Column:
    def part(n: int) -> Column:
        return F.coalesce(F.nullif(F.get(parts, F.lit(n)), F.lit("")), F.lit("00"))

    fraction = F.substring(F.rpad(F.get(parts, F.lit(4)), 6, "0"), 1, 6)
    clock = F.concat(
        part(0), F.lit(" "), part(1), F.lit(":"), part(2), F.lit(":"), part(3), F.lit("."), fraction, F.lit("+00:00")
    )
    local = F.try_to_timestamp(clock, F.lit("yyyy-MM-dd HH:mm:ss.SSSSSSxxx"))
    offset = part(6).cast("bigint") * 3600 + part(7).cast("bigint") * 60 + part(8).cast("bigint")
    signed = F.when(part(5) == "-", -offset).otherwise(offset)
    return F.when(offset < 86400, F.timestamp_micros(F.unix_micros(local) - signed * 1_000_000))


def with_iso_times(df: DataFrame, **texts: Column) -> DataFrame:
    """`df` with an instant per name, read from ISO 8601 text: basic or extended, date only or with time, offset or UTC; else NULL.

    What a step needs several times is a column of the projection before it, so it is worked out once per row and all
    steps stay in generated code; a function over arrays would leave it.
    """
    steps = [
        lambda name: F.replace(stripped(texts[name]), F.lit("Z"), F.lit("+00:00")),
        lambda name: F.when(F.col(f"_{name}_0").rlike(_WEEK), F.split(F.regexp_replace(f"_{name}_0", _WEEK, "$1|$3|$4|$5"), r"\|", 4)),
        lambda name: _week_to_calendar(F.col(f"_{name}_0"), F.col(f"_{name}_1")),
        lambda name: F.when(F.col(f"_{name}_2").rlike(_MOMENT), F.split(F.regexp_replace(f"_{name}_2", _MOMENT, _PARTS), r"\|")),
    ]
    found = df
    for number, step in enumerate(steps):
        found = found.withColumns({f"_{name}_{number}": step(name) for name in texts})
    kept = [c for c in df.columns if c not in texts]
    return found.select(*[F.col(f"`{c}`") for c in kept], *[_instant(F.col(f"_{name}_{len(steps) - 1}")).alias(name) for name in texts])


def session_time(session_id: Column) -> Column:
    """Time in a session name, before the first `__`: `20260314T0830Z` or `20260314T083015Z`."""
    prefix = F.substring_index(session_id, "__", 1)
    # The guard keeps the parser from taking other offsets than the literal Z.
    minutes = F.when(prefix.rlike(r"^\d{8}T\d{4}Z$"), prefix)
    seconds = F.when(prefix.rlike(r"^\d{8}T\d{6}Z$"), prefix)
    return F.coalesce(
        F.try_to_timestamp(minutes, F.lit("yyyyMMdd'T'HHmmX")),
        F.try_to_timestamp(seconds, F.lit("yyyyMMdd'T'HHmmssX")),
    )


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of `value`, with `value` worked out once however often `body` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _iso_time(text: Column) -> Column:
    """The steps of `with_iso_times` on an element of an array."""

    def moment(plain: Column) -> Column:
        week = F.split(F.regexp_replace(plain, _WEEK, "$1|$3|$4|$5"), r"\|", 4)
        return F.when(plain.rlike(_WEEK), _bound(week, lambda w: _week_to_calendar(plain, w))).otherwise(plain)

    def instant(m: Column) -> Column:
        return F.when(m.rlike(_MOMENT), _bound(F.split(F.regexp_replace(m, _MOMENT, _PARTS), r"\|"), _instant))

    return _bound(_bound(F.replace(stripped(text), F.lit("Z"), F.lit("+00:00")), moment), instant)


def with_metadata_time(df: DataFrame, name: str, meta: Column) -> DataFrame:
    """`df` with the first usable start time in a session's metadata text; NULL for bad JSON or a non-object.

    The keys' texts are gone through as an array. As projections for all keys at once the steps stand in generated code,
    but in a method too large for the JVM to compile: measured on 1.2 million rows, that takes twice the time.
    """

    def text_at(document: Column, key: str) -> Column:
        kind = F.schema_of_variant(F.try_variant_get(document, f"$.{key}", "variant"))
        return F.when(kind == "STRING", F.try_variant_get(document, f"$.{key}", "string"))

    texts = _bound(F.try_parse_json(meta), lambda doc: F.array(*[text_at(doc, key) for key in START_KEYS]))
    return df.withColumn(name, F.get(F.filter(F.transform(texts, _iso_time), lambda t: t.isNotNull()), F.lit(0)))


def with_captured_at(df: DataFrame, name: str, meta: Column, session_id: Column) -> DataFrame:
    """`df` with the start of its session: from the metadata text, or else from the session's name."""
    timed = with_metadata_time(df.withColumn("_session", session_id), "_from_metadata", meta)
    return timed.withColumn(name, F.coalesce("_from_metadata", session_time(F.col("_session")))).drop("_from_metadata", "_session")


def notes_text(source_url: Column, notes: Column) -> Column:
    joined = F.concat_ws(" | ", F.nullif(source_url, F.lit("")), F.nullif(notes, F.lit("")))
    return F.nullif(joined, F.lit(""))
