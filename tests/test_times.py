import json
import re
from datetime import datetime, timezone

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from framequarry.functions import times as TM


def micros(spark, values, expression):
    df = spark.createDataFrame([(v,) for v in values], "s string").coalesce(1)
    return [r[0] for r in df.select(F.unix_micros(expression(F.col("s")))).collect()]


def iso_micros(spark, values):
    df = spark.createDataFrame([(v, v) for v in values], "at string, s string").coalesce(1)
    return [r.us for r in TM.with_iso_times(df, at=F.col("s")).select("s", F.unix_micros("at").alias("us")).collect()]


def python_micros(text):
    try:
        moment = datetime.fromisoformat(text.strip().replace("Z", "+00:00"))
    except ValueError:
        return None
    moment = moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
    gap = moment - datetime(1970, 1, 1, tzinfo=timezone.utc)
    return (gap.days * 86400 + gap.seconds) * 1_000_000 + gap.microseconds


SPELLINGS = [
    "2026-03-14", "20260314", "2026-03-14T08:30", "2026-03-14 08:30:15", "20260314T083015", "20260314T0830", "2026-03-14T08",
    "2026-03-14T08:30:15.1", "2026-03-14T08:30:15,123456789", "2026-03-14T08:30:15Z", "2026-03-14T08:30:15+05:30", "2026-03-14T08:30:15-0300",
    "2026-03-14T08:30:15+05", "2026-W11-6", "2026W116", "2026-W11", "2026-W53-1", "2020-W53-7", "2026-W00-1", "2025-W01-1T10:00", " 2026-03-14T08:30Z ",
    "2026", "2026-03", "2026-13-01", "2026-02-30", "2026-03-14T25:00", "2026-03-14T08:61", "2026-0314", "202603-14", "2026-03-14T08:3015", "2026-03-14T0830:15",
    "14.03.2026", "", "now", "2026-03-14T08:30:15+24:00", "2026-03-14T", "2026-03-14T08:30:15.", "1999-12-31T23:59:59.999999-23:59", "2024-02-29x10:00",
]


def test_spellings_like_python(spark):
    got = iso_micros(spark, SPELLINGS)
    assert dict(zip(SPELLINGS, got)) == {s: python_micros(s) for s in SPELLINGS}


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(moments=st.lists(st.datetimes(datetime(1971, 1, 1), datetime(2100, 1, 1), timezones=st.none() | st.just(timezone.utc)), min_size=1, max_size=40))
def test_iso_round_trip(spark, moments):
    texts = [m.isoformat() for m in moments]
    assert iso_micros(spark, texts) == [python_micros(t) for t in texts]


def test_session_names(spark):
    names = ["20260314T0830Z__usr_a1b2c3__01", "20260314T083015Z__u__02", "nodate__x", "20260314T0830__u", "20260314T0830Z", "20261314T0830Z__u", ""]
    utc = lambda *a: int(datetime(*a, tzinfo=timezone.utc).timestamp() * 1_000_000)
    want = [utc(2026, 3, 14, 8, 30), utc(2026, 3, 14, 8, 30, 15), None, None, utc(2026, 3, 14, 8, 30), None, None]
    assert micros(spark, names, TM.session_time) == want


def test_metadata(spark):
    cases = [
        (json.dumps({"captured_at": "2026-03-14T08:30:00Z", "date": "2020-01-01"}), "2026-03-14T08:30:00"),
        (json.dumps({"captured_at": "soon", "started_at": None, "start_time": 20260101, "start": "2026-01-02"}), "2026-01-02"),
        (json.dumps({"date": ["2026-01-02"]}), None), (json.dumps({}), None), ("[]", None), ('"2026-01-02"', None), ("{bad", None), ("", None), (None, None),
    ]
    df = spark.createDataFrame([(c[0],) for c in cases], "s string").coalesce(1)
    got = [r[0] for r in TM.with_metadata_time(df, "at", F.col("s")).select(F.unix_micros("at")).collect()]
    assert got == [python_micros(c[1]) if c[1] else None for c in cases]


def test_captured_at_falls_back_to_the_name(spark):
    df = spark.createDataFrame([("{bad", "20260314T0830Z__u"), ('{"date": "2026-01-02"}', "20260314T0830Z__u"), (None, "x")], "m string, s string")
    timed = TM.with_captured_at(df, "at", F.col("m"), F.col("s"))
    assert timed.columns == ["m", "s", "at"]
    got = [r[0] for r in timed.select(F.unix_micros("at")).collect()]
    assert got == [python_micros("2026-03-14T08:30"), python_micros("2026-01-02"), None]


def test_all_steps_stand_in_generated_code(spark, tmp_path):
    spark.createDataFrame([("x", "y")], "m string, s string").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = TM.with_iso_times(df, at=F.col("m"), other=F.col("s"))._jdf.queryExecution().executedPlan().toString()
    projects = [line for line in plan.splitlines() if "Project" in line]
    assert len(projects) > 2 and all(re.search(r"\*\(\d+\) Project", line) for line in projects)
    assert "lambda" not in plan
