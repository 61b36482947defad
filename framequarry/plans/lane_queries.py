"""Queries over lane labels made from the embedding values (64 numbers per row, as half units)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import lanes as LN
from .registry import query, table

EPOCH = 1700000000

# The same values in SQL: three lanes of 10, 7 and 13 points starting at value 1, 24 and 39.
_HALVES = """v AS (SELECT vec_id, label,
  list_transform(embedding, lambda e: round_even(CAST(e AS DOUBLE) * 2000, 0) / 2) AS h FROM embeddings),
pts AS (SELECT v.vec_id, v.label, l.lane_no, g.point_no, h[l.first + 2 * g.point_no] AS x, h[l.first + 2 * g.point_no + 1] AS y
  FROM v, (VALUES (0, 1, 10), (1, 24, 7), (2, 39, 13)) l(lane_no, first, n), generate_series(0, 12) g(point_no)
  WHERE g.point_no < l.n),
whole AS (SELECT *, CAST(round_even(x, 0) AS BIGINT) AS xi, CAST(round_even(y, 0) AS BIGINT) AS yi FROM pts)"""


def _halves(spark, sf):
    halves = F.transform("embedding", lambda e: F.rint(e.cast("double") * 2000) / 2)
    return table(spark, sf, "embeddings").select("vec_id", "label", halves.alias("h"))


def _text_labels(spark, sf, bad_label: int):
    """Text labels: a short line to drop, an odd number of values, a blank line; one label class has a bad number."""

    def line(first: int, count: int):
        return F.array_join(F.transform(F.slice("h", first, count), lambda x: x.cast("string")), " ")

    third = F.when(F.col("label") == bad_label, F.concat(line(24, 15), F.lit(" 1.5f"))).otherwise(line(24, 15))
    text = F.concat_ws("\r\n", F.concat(F.lit("  "), line(1, 20)), line(21, 3), third, F.lit(""), line(39, 26))
    return LN.parse_text_lanes(_halves(spark, sf).withColumn("text", text), "text")


def _exploded(df):
    return LN.exploded_points(df, ["vec_id"], "rounded").select("vec_id", "lane_no", "point_no", "p.x", "p.y")


@query("lanes_from_text", f"""
WITH {_HALVES}
SELECT vec_id, CAST(lane_no AS INTEGER) AS lane_no, CAST(point_no AS INTEGER) AS point_no, xi AS x, yi AS y FROM whole WHERE label <> 3""")
def lanes_from_text(spark, sf):
    parsed = _text_labels(spark, sf, bad_label=3)
    return _exploded(parsed.withColumn("rounded", LN.whole_lanes(F.col("lanes"))))


@query("label_parse_status", """
SELECT vec_id, CASE WHEN label = 3 THEN 'error' ELSE 'ok' END AS status, CASE WHEN label <> 3 THEN 3 END AS n_lanes FROM embeddings""")
def label_parse_status(spark, sf):
    parsed = _text_labels(spark, sf, bad_label=3)
    return parsed.select(
        "vec_id", F.when(F.col("label_error").isNull(), "ok").otherwise("error").alias("status"),
        F.when(F.col("lanes").isNotNull(), F.size("lanes")).alias("n_lanes"),
    )


def _json_labels(spark, sf):
    """JSON labels: coordinates as text or numbers, an empty lane, and by class a missing key or bad content."""

    def lane(first: int, count: int, kind: str):
        return F.transform(
            F.sequence(F.lit(0), F.lit(count - 1)),
            lambda i: F.struct(
                F.get("h", F.lit(first - 1) + i * 2).cast(kind).alias("x"), F.get("h", F.lit(first) + i * 2).cast(kind).alias("y")
            ),
        )

    def lines(kind: str):
        none = F.slice(lane(1, 1, kind), 1, 0)
        return F.to_json(F.struct(F.array(lane(1, 10, kind), none, lane(24, 7, kind), lane(39, 13, kind)).alias("Lines")))

    label = F.col("label")
    text = (
        F.when(label == 0, '{"frame": 7}').when(label == 1, '{"Lines": [[{"x": "1", "y": 2}, {"x": 3}]]}')
        .when(label == 2, '{"Lines": [[').when(label == 3, '[{"Lines": []}]').when(label == 4, '{"Lines": null}')
        .when(label == 5, lines("string")).otherwise(lines("double"))
    )
    return LN.parse_json_lanes(_halves(spark, sf).withColumn("text", text), "text")


@query("lanes_from_json", f"""
WITH {_HALVES}
SELECT vec_id, CAST(lane_no AS INTEGER) AS lane_no, CAST(point_no AS INTEGER) AS point_no, xi AS x, yi AS y FROM whole WHERE label >= 5""")
def lanes_from_json(spark, sf):
    return _exploded(_json_labels(spark, sf).withColumn("rounded", LN.whole_lanes(F.col("lanes"))))


@query("json_label_status", """
SELECT vec_id, CASE WHEN label BETWEEN 1 AND 4 THEN 'error' ELSE 'ok' END AS status,
       CASE WHEN label = 0 THEN 0 WHEN label >= 5 THEN 3 END AS n_lanes FROM embeddings""")
def json_label_status(spark, sf):
    return _json_labels(spark, sf).select(
        "vec_id", F.when(F.col("label_error").isNull(), "ok").otherwise("error").alias("status"),
        F.when(F.col("lanes").isNotNull(), F.size("lanes")).alias("n_lanes"),
    )


def _report(spark, sf):
    parsed = _text_labels(spark, sf, bad_label=-1)
    side = F.when(F.col("label") % 2 == 0, F.lit(300).cast("bigint"))
    rounded = parsed.withColumn("rounded", LN.whole_lanes(F.col("lanes")))
    return rounded.select("vec_id", "label", LN.lane_report(F.col("rounded"), side, side).alias("r"))


@query("lane_report", f"""
WITH {_HALVES}
SELECT vec_id, CAST(count(DISTINCT lane_no) AS BIGINT) AS n_lanes, CAST(count(*) AS BIGINT) AS n_points,
       min(xi) AS min_x, max(xi) AS max_x, min(yi) AS min_y, max(yi) AS max_y, '10,7,13' AS points_per_lane,
       CASE WHEN any_value(label) % 2 = 0 THEN min(xi) >= 0 AND max(xi) <= 300 AND min(yi) >= 0 AND max(yi) <= 300 END AS in_bounds
FROM whole GROUP BY vec_id""")
def lane_report(spark, sf):
    return _report(spark, sf).select(
        "vec_id", "r.n_lanes", "r.n_points", "r.min_x", "r.max_x", "r.min_y", "r.max_y",
        F.array_join(F.transform("r.points_per_lane", lambda n: n.cast("string")), ",").alias("points_per_lane"),
        "r.in_bounds",
    )


@query("lane_report_rollup", f"""
WITH {_HALVES},
r AS (SELECT vec_id, label, count(DISTINCT lane_no) AS n_lanes, count(*) AS n_points, min(xi) AS min_x, max(xi) AS max_x,
        CASE WHEN label % 2 = 0 THEN min(xi) >= 0 AND max(xi) <= 300 AND min(yi) >= 0 AND max(yi) <= 300 END AS in_bounds
      FROM whole GROUP BY vec_id, label)
SELECT label, count(*) AS images, CAST(sum(n_lanes) AS BIGINT) AS lanes, CAST(sum(n_points) AS BIGINT) AS points,
       min(min_x) AS min_x, max(max_x) AS max_x, count(*) FILTER (WHERE NOT in_bounds) AS out_of_bounds
FROM r GROUP BY label""")
def lane_report_rollup(spark, sf):
    return _report(spark, sf).groupBy("label").agg(
        F.count("*").alias("images"), F.sum("r.n_lanes").alias("lanes"), F.sum("r.n_points").alias("points"),
        F.min("r.min_x").alias("min_x"), F.max("r.max_x").alias("max_x"),
        F.count_if(~F.col("r.in_bounds")).alias("out_of_bounds"),
    )


@query("lane_rounding_errors", f"""
WITH {_HALVES}
SELECT vec_id, CAST(lane_no AS INTEGER) AS lane_no, CAST(point_no AS INTEGER) AS point_no, x, y, xi AS x_int, yi AS y_int, xi - x AS dx, yi - y AS dy FROM whole""")
def lane_rounding_errors(spark, sf):
    parsed = _text_labels(spark, sf, bad_label=-1).withColumn("rounded", LN.whole_lanes(F.col("lanes")))
    return LN.point_errors(parsed, ["vec_id"], "lanes", "rounded")


@query("label_files", f"""
WITH {_HALVES},
lane AS (SELECT vec_id, lane_no, '[' || string_agg('{{"x": ' || xi || ', "y": ' || yi || '}}', ', ' ORDER BY point_no) || ']' AS row FROM whole GROUP BY vec_id, lane_no),
body AS (SELECT vec_id, '{{"timestamp": {EPOCH},' || chr(10) || '"Lines": [' || chr(10) || string_agg(row, ',' || chr(10) ORDER BY lane_no) || chr(10) || ']}}' AS body
         FROM lane GROUP BY vec_id)
SELECT vec_id, md5(body) AS digest, CAST(length(body) AS INTEGER) AS n_chars FROM body""")
def label_files(spark, sf):
    parsed = _text_labels(spark, sf, bad_label=-1)
    body = LN.label_text(LN.whole_lanes(F.col("lanes")), F.lit(EPOCH))
    return parsed.select("vec_id", body.alias("body")).select("vec_id", F.md5("body").alias("digest"), F.length("body").alias("n_chars"))


@query("lane_bends", f"""
WITH {_HALVES},
ends AS (SELECT vec_id, lane_no, arg_min(x, point_no) AS x0, arg_min(y, point_no) AS y0, arg_max(x, point_no) AS x1, arg_max(y, point_no) AS y1
         FROM pts GROUP BY vec_id, lane_no),
bend AS (SELECT vec_id, lane_no,
           max(abs((x1 - x0) * (y - y0) - (y1 - y0) * (x - x0))) / ((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)) AS bend
         FROM pts JOIN ends USING (vec_id, lane_no) WHERE x1 <> x0 OR y1 <> y0 GROUP BY vec_id, lane_no, x0, x1, y0, y1)
SELECT vec_id, round(max(bend), 6) AS bend, CASE WHEN max(bend) > 1.0 THEN 'curve' ELSE 'straight' END AS road_geometry FROM bend GROUP BY vec_id""")
def lane_bends(spark, sf):
    parsed = _text_labels(spark, sf, bad_label=-1)
    return parsed.select(
        "vec_id", F.round(F.array_max(F.transform("lanes", LN.bend)), 6).alias("bend"),
        LN.road_geometry(F.col("lanes"), threshold=1.0).alias("road_geometry"),
    )
