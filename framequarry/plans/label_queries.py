"""Queries over label responses and detections."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import boxes as B
from ..operators import detections as D
from ..operators import labelling as LB
from ..sources.taxonomy import SCENE_TAXONOMY, taxonomy_frame
from .registry import query, table

# What the events below answer, and what validation makes of it.
_RESPONSE_SQL = """r AS (SELECT event_id, event_type, value,
  CASE WHEN event_id % 7 = 0 THEN 'not JSON' WHEN event_id % 7 = 1 THEN 'not an object' WHEN event_id % 7 = 2 THEN 'missing' END AS problem,
  CASE event_type WHEN 'click' THEN 'clear' WHEN 'view' THEN 'RAIN' WHEN 'error' THEN NULL WHEN 'signup' THEN NULL ELSE 'rain' END AS weather,
  CASE WHEN value > 50 THEN 'highway' ELSE 'moon' END AS scene FROM events)"""


def _responses(spark, sf):
    """Label responses made from events: some malformed, some with wrong case, type or value."""
    kind, turn = F.col("event_type"), F.col("event_id") % 7
    weather = (
        F.when(kind == "click", '"weather": "clear", ').when(kind == "view", '"weather": "RAIN", ')
        .when(kind == "error", "").when(kind == "signup", '"weather": 5, ').otherwise('"weather": "rain", ')
    )
    scene = F.when(F.col("value") > 50, '"scene": "highway"').otherwise('"scene": "moon"')
    whole = F.concat(F.lit("{"), weather, scene, F.lit(', "timeofday": "night"}'))
    text = F.when(turn == 0, F.concat(F.lit("Sure: "), whole)).when(turn == 1, F.concat(F.lit("["), whole, F.lit("]"))).when(turn != 2, whole)
    return table(spark, sf, "events").select("event_id", text.alias("response"))


@query("label_responses", f"""
WITH {_RESPONSE_SQL}
SELECT event_id, CASE WHEN problem IS NULL THEN 'ok' ELSE 'error' END AS status, 'response: ' || problem AS error,
       CASE WHEN problem IS NULL THEN CASE WHEN weather IN ('clear', 'rain') THEN weather ELSE 'unknown' END END AS weather,
       CASE WHEN problem IS NULL THEN CASE WHEN scene = 'highway' THEN scene ELSE 'unknown' END END AS scene,
       CASE WHEN problem IS NULL THEN 'night' END AS timeofday,
       CASE WHEN problem IS NULL THEN 'unknown' END AS road_geometry
FROM r""")
def label_responses(spark, sf):
    return LB.read_responses(_responses(spark, sf)).select(
        "event_id", "status", "error", "weather", "scene", "timeofday", "road_geometry"
    )


@query("taxonomy_values", """
SELECT event_id, CASE WHEN event_type IN ('click', 'view', 'error') THEN event_type ELSE 'unknown' END AS event_type FROM events""")
def taxonomy_values(spark, sf):
    from ..functions.labels import in_taxonomy

    return table(spark, sf, "events").select(
        "event_id", in_taxonomy(F.col("event_type"), ["click", "view", "error", "unknown"]).alias("event_type")
    )


_TAXONOMY_SQL = ", ".join(f"('{name}', '{value}', {i})" for name, values in SCENE_TAXONOMY.items() for i, value in enumerate(values))


@query("taxonomy_rows", f"""
WITH {_RESPONSE_SQL}, u AS (SELECT * FROM r WHERE problem IS NULL),
said AS (SELECT 'weather' AS field, CASE WHEN weather IN ('clear', 'rain') THEN weather ELSE 'unknown' END AS value FROM u
  UNION ALL SELECT 'scene', CASE WHEN scene = 'highway' THEN scene ELSE 'unknown' END FROM u
  UNION ALL SELECT 'timeofday', 'night' FROM u UNION ALL SELECT 'road_geometry', 'unknown' FROM u)
SELECT t.field, t.value, t.ord, count(said.value) AS rows FROM (VALUES {_TAXONOMY_SQL}) t(field, value, ord) LEFT JOIN said USING (field, value) GROUP BY ALL""")
def taxonomy_rows(spark, sf):
    """Every value of the taxonomy with the number of responses that gave it."""
    usable = LB.read_responses(_responses(spark, sf)).filter("status = 'ok'")
    given = F.explode(F.array(*[F.struct(F.lit(name).alias("field"), F.col(name).alias("value")) for name in SCENE_TAXONOMY]))
    said = usable.select(given.alias("given")).select("given.*").groupBy("field", "value").agg(F.count("*").alias("rows"))
    return taxonomy_frame(spark).join(said, ["field", "value"], "left").select("field", "value", "ord", F.coalesce("rows", F.lit(0)).alias("rows"))


@query("taxonomy_conformance", f"""
WITH {_RESPONSE_SQL}, u AS (SELECT * FROM r WHERE problem IS NULL)
SELECT 'weather' AS field, count(*) AS responses, count(weather) AS given, count(*) FILTER (WHERE weather IN ('clear', 'rain')) AS allowed FROM u
UNION ALL SELECT 'scene', count(*), count(*), count(*) FILTER (WHERE scene = 'highway') FROM u
UNION ALL SELECT 'timeofday', count(*), count(*), count(*) FROM u
UNION ALL SELECT 'road_geometry', count(*), 0, 0 FROM u""")
def taxonomy_conformance(spark, sf):
    return LB.conformance(_responses(spark, sf))


@query("classification_rows", f"""
WITH {_RESPONSE_SQL}
SELECT 'e/' || event_id AS image_id, CASE WHEN weather IN ('clear', 'rain') THEN weather ELSE 'unknown' END AS weather,
       CASE WHEN scene = 'highway' THEN scene ELSE 'unknown' END AS scene, 'night' AS timeofday, 'unknown' AS road_geometry,
       'model-1' AS model, CAST(NULL AS VARCHAR) AS scores, CAST(1700000000 AS BIGINT) AS classified_s, true AS same_time
FROM r WHERE problem IS NULL""")
def classification_rows(spark, sf):
    from ..functions.times import epoch_time

    named = _responses(spark, sf).withColumn("image_id", F.concat(F.lit("e/"), F.col("event_id").cast("string")))
    rows = LB.label_rows(LB.read_responses(named), "model-1", epoch_time(1700000000))
    return rows.select(
        "image_id", "weather", "scene", "timeofday", "road_geometry", "model", "scores",
        F.unix_seconds("classified_at").alias("classified_s"), (F.col("classified_at") == F.col("geometry_at")).alias("same_time"),
    )


def _detections(spark, sf):
    """Line items as detections: return flag and status give the class, discount the confidence."""
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    name = (
        F.when((flag == "A") & (status == "F"), "Human Face").when(flag == "A", "license-plate")
        .when((flag == "N") & (status == "F"), "LICENCE").when(flag == "N", "number_plate")
        .when(status == "F", "car").otherwise("")
    )
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("image_id"), F.col("l_linenumber").alias("box_no"), F.col("l_partkey").alias("part"),
        name.alias("class_name"), F.round(F.col("l_discount") * 2, 2).alias("conf"),
        (F.col("l_quantity") * 2.5 - 20).alias("x1"), (F.col("l_tax") * 1000 - 10).alias("y1"),
        (F.col("l_quantity") * 3.5 - 30).alias("x2"), (F.col("l_extendedprice") / 500 - 30).alias("y2"),
    )


_DETECTION_SQL = """d AS (SELECT l_orderkey AS image_id, l_linenumber AS box_no, l_partkey AS part, round(l_discount * 2, 2) AS conf,
  CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'face' WHEN l_returnflag IN ('A', 'N') THEN 'plate' END AS kind,
  l_quantity * 2.5 - 20 AS x1, l_tax * 1000 - 10 AS y1, l_quantity * 3.5 - 30 AS x2, l_extendedprice / 500 - 30 AS y2 FROM lineitem)"""


@query("detection_kinds", f"WITH {_DETECTION_SQL} SELECT image_id, box_no, part, conf, kind FROM d WHERE conf >= 0.1 AND kind IS NOT NULL")
def detection_kinds(spark, sf):
    return D.kept_detections(_detections(spark, sf)).select("image_id", "box_no", "part", "conf", "kind")


@query("clamped_boxes", f"""
WITH {_DETECTION_SQL},
c AS (SELECT image_id, box_no, part, greatest(0, CAST(round_even(x1, 0) AS BIGINT)) AS x1, greatest(0, CAST(round_even(y1, 0) AS BIGINT)) AS y1,
             least(100, CAST(round_even(x2, 0) AS BIGINT)) AS x2, least(80, CAST(round_even(y2, 0) AS BIGINT)) AS y2 FROM d)
SELECT * FROM c WHERE x2 > x1 AND y2 > y1""")
def clamped_boxes(spark, sf):
    boxes = D.pixel_boxes(_detections(spark, sf), F.lit(100), F.lit(80))
    return boxes.select("image_id", "box_no", "part", "x1", "y1", "x2", "y2")


@query("blur_kernels", "SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_size + 1 ELSE p_size END AS kernel FROM part")
def blur_kernels(spark, sf):
    return table(spark, sf, "part").select("p_partkey", B.odd_kernel(F.col("p_size")).alias("kernel"))


@query("redaction_counts", f"""
WITH {_DETECTION_SQL},
k AS (SELECT * FROM d WHERE conf >= 0.1 AND kind IS NOT NULL)
SELECT o_orderkey AS image_id, count(*) FILTER (WHERE kind = 'face') AS faces, count(*) FILTER (WHERE kind = 'plate') AS plates
FROM orders LEFT JOIN k ON o_orderkey = image_id GROUP BY o_orderkey""")
def redaction_counts(spark, sf):
    images = table(spark, sf, "orders").select(F.col("o_orderkey").alias("image_id"))
    return D.redaction_counts(images, D.kept_detections(_detections(spark, sf)))
