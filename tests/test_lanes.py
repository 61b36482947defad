import json
import math

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from framequarry.functions import lanes as LN

FEW = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def parsed(spark, texts, parse):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").coalesce(1)
    rows = parse(df, "text").orderBy("i").collect()
    lanes = [None if r.lanes is None else [[(p.x, p.y) for p in lane] for lane in r.lanes] for r in rows]
    return lanes, [r.label_error for r in rows]


def text_model(text):
    lanes = []
    for line in text.splitlines():
        tokens = line.split()
        if len(tokens) >= 4:
            values = [float(t) for t in tokens]
            lanes.append(list(zip(values[::2], values[1::2])))
    return lanes


TOKENS = st.sampled_from(["1", "-2.5", "3e1", "0.5", "1.5", "bad", "7"])
LINES = st.lists(st.tuples(st.lists(TOKENS, max_size=7), st.sampled_from(["\n", "\r\n", "\r", "\x0b", " "])), max_size=4)


@FEW
@given(labels=st.lists(LINES, min_size=1, max_size=30))
def test_text_labels(spark, labels):
    texts = ["".join(" ".join(tokens) + end for tokens, end in lines) for lines in labels]
    lanes, errors = parsed(spark, texts, LN.parse_text_lanes)
    for text, got, error in zip(texts, lanes, errors):
        try:
            assert (got, error) == (text_model(text), None)
        except ValueError:
            assert got is None and error


def json_model(text):
    return [lane for lane in ([(float(p["x"]), float(p["y"])) for p in lane] for lane in json.loads(text).get("Lines", [])) if lane]


JSON_LABELS = [
    '{"Lines": [[{"x": "1.5", "y": 2}, {"x": 3e2, "y": " 4 "}], [], [{"y": "-1", "x": 0, "z": 5}]]}', '{"Lines": []}', "{}", '{"lines": 5}',
    '{"Lines": null}', '{"Lines": [[{"x": 1}]]}', '{"Lines": [[{"x": 1, "y": null}]]}', '{"Lines": [[{"x": 1, "y": "b"}]]}', '{"Lines": [5]}',
    '{"Lines": [[7]]}', '{"Lines": "ab"}', "[]", "", "{", '"x"', '{"Lines": [null]}',
]


def test_json_labels(spark):
    lanes, errors = parsed(spark, JSON_LABELS, LN.parse_json_lanes)
    for text, got, error in zip(JSON_LABELS, lanes, errors):
        try:
            assert (got, error) == (json_model(text), None), text
        except (ValueError, TypeError, KeyError, AttributeError):
            assert got is None and error, text


def test_no_label_is_not_an_empty_label(spark):
    for parse in (LN.parse_text_lanes, LN.parse_json_lanes):
        lanes, errors = parsed(spark, [None], parse)
        assert lanes == [None] and errors == [None]
    assert parsed(spark, ["", "\n"], LN.parse_text_lanes) == ([[], []], [None, None])


def test_rounding_is_half_to_even(spark):
    values = [0.5, 1.5, 2.5, -0.5, -1.5, 2.4999, 1e12 + 0.5, math.inf, -math.inf, math.nan]
    df = spark.createDataFrame([(v,) for v in values], "v double").coalesce(1)
    got = [r[0] for r in df.select(LN.whole(F.col("v"))).collect()]
    assert got == [round(v) if math.isfinite(v) else None for v in values]


@FEW
@given(labels=st.lists(st.lists(st.lists(st.tuples(st.integers(-5000, 5000), st.integers(-5000, 5000)), min_size=1, max_size=5), max_size=4), min_size=1, max_size=20))
def test_label_file_text(spark, labels):
    rows = [(i, [[{"x": x, "y": y} for x, y in lane] for lane in lanes]) for i, lanes in enumerate(labels)]
    df = spark.createDataFrame(rows, "i int, lanes array<array<struct<x:bigint,y:bigint>>>").coalesce(1)
    got = [r[0] for r in df.orderBy("i").select(LN.label_text(F.col("lanes"), F.lit(1700000000))).collect()]
    for text, (_, lanes) in zip(got, rows):
        # The points written one lane per line, after the time stamp.
        body = ",\n".join(json.dumps(lane) for lane in lanes)
        assert text == '{"timestamp": 1700000000,\n"Lines": [\n' + body + "\n]}"
        assert json.loads(text) == {"timestamp": 1700000000, "Lines": lanes}


def test_report_without_size_or_points(spark):
    df = spark.createDataFrame([([], 10), ([[{"x": 1, "y": 2}]], None), ([[{"x": 0, "y": 10}]], 10), ([[{"x": 0, "y": 11}]], 10)], "l array<array<struct<x:bigint,y:bigint>>>, s bigint").coalesce(1)
    got = [r[0] for r in df.select(LN.lane_report(F.col("l"), F.col("s"), F.col("s")).in_bounds).collect()]
    assert got == [None, None, True, False]


def test_geometry(spark):
    straight = [{"x": float(i), "y": 2.0 * i} for i in range(5)]
    bent = [{"x": float(i), "y": float(i * i)} for i in range(5)]
    rows = [([straight],), ([straight, bent],), ([],), ([straight[:2]],), (None,)]
    df = spark.createDataFrame(rows, "l array<array<struct<x:double,y:double>>>").coalesce(1)
    assert [r[0] for r in df.select(LN.road_geometry(F.col("l"))).collect()] == ["straight", "curve", "unknown", "unknown", "unknown"]


def test_of_repeated_keys_the_last_counts(spark):
    texts = ['{"Lines": [[{"x": 1, "y": 2}]], "Lines": [[{"x": 5, "x": 7, "y": 6}]]}', '{"a": 1, "a": 2}']
    lanes, errors = parsed(spark, texts, LN.parse_json_lanes)
    assert errors == [None, None] and lanes == [json_model(t) for t in texts] and lanes[0][0][0][0] == 7
