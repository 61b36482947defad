"""Lane labels: parsing, normalising, serialising and measuring them with array expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .text import lines, number, word_number, words

# Fixed value: a text line with fewer numbers than this (two points) is no lane.
MIN_LANE_VALUES = 4


def _pairs(values: Column) -> Column:
    """[x1, y1, x2, y2, ...] to points; an odd last value is left over."""
    last = F.floor(F.size(values) / 2).cast("int") - 1
    return F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.struct(F.get(values, i * 2).alias("x"), F.get(values, i * 2 + 1).alias("y")),
    )


def parse_text_lanes(df: DataFrame, text: str, lanes: str = "lanes", error: str = "label_error") -> DataFrame:
    """Add lanes from `x y x y ...` lines. NULL text gives NULL lanes; a bad number fails the whole label."""
    kept = F.filter(F.transform(lines(F.col(text)), words), lambda w: F.size(w) >= MIN_LANE_VALUES)
    numbers = F.transform(kept, lambda w: F.transform(w, word_number))
    bad = F.exists(F.col("_numbers"), lambda ns: F.exists(ns, lambda n: n.isNull()))
    return (
        df.withColumn("_numbers", numbers)
        .withColumn(error, F.when(bad, F.lit("label: not a number")))
        .withColumn(lanes, F.when(F.col(error).isNull(), F.transform("_numbers", _pairs)))
        .drop("_numbers")
    )


def parse_json_lanes(df: DataFrame, text: str, lanes: str = "lanes", error: str = "label_error") -> DataFrame:
    """Add lanes from `{"Lines": [[{"x", "y"}]]}` text; coordinates may be numbers or strings.

    No `Lines` key means no lanes; empty lanes are dropped; anything malformed fails the label.
    """
    document = F.try_parse_json(F.col(text))
    raw = F.try_variant_get(F.col("_lines"), "$", "array<array<struct<x:string,y:string>>>")
    points = F.transform(
        raw,
        lambda lane: F.transform(lane, lambda p: F.struct(number(p.x).alias("x"), number(p.y).alias("y"))),
    )
    bad_point = F.exists(
        F.col("_points"),
        lambda lane: lane.isNull() | F.coalesce(F.exists(lane, lambda p: p.x.isNull() | p.y.isNull()), F.lit(False)),
    )
    problem = (
        F.when(F.col(text).isNull(), F.lit(None))
        .when(F.col("_doc").isNull(), F.lit("label: not JSON"))
        .when(F.try_variant_get(F.col("_doc"), "$", "map<string,variant>").isNull(), F.lit("label: not an object"))
        .when(F.col("_lines").isNotNull() & F.col("_points").isNull(), F.lit("label: malformed Lines"))
        .when(bad_point, F.lit("label: not a number"))
    )
    full = F.filter(F.coalesce(F.col("_points"), F.array()), lambda lane: F.size(lane) > 0)
    return (
        df.withColumn("_doc", document)
        .withColumn("_lines", F.try_variant_get(F.col("_doc"), "$.Lines", "variant"))
        .withColumn("_points", points)
        .withColumn(error, problem)
        .withColumn(lanes, F.when(F.col(text).isNotNull() & F.col(error).isNull(), full))
        .drop("_doc", "_lines", "_points")
    )


def whole(value: Column) -> Column:
    """Round half to even; NULL for a value that is not finite."""
    return F.rint(value).try_cast("bigint")


def whole_lanes(lanes: Column) -> Column:
    return F.transform(
        lanes,
        lambda lane: F.transform(lane, lambda p: F.struct(whole(p.x).alias("x"), whole(p.y).alias("y"))),
    )


def has_gap(rounded: Column) -> Column:
    """True where a coordinate could not be rounded."""
    return F.exists(rounded, lambda lane: F.exists(lane, lambda p: p.x.isNull() | p.y.isNull()))


def label_text(rounded: Column, epoch: Column) -> Column:
    """Label file: the time stamp first, then one lane per line."""

    def point(p: Column) -> Column:
        return F.format_string('{"x": %d, "y": %d}', p.x, p.y)

    rows = F.transform(rounded, lambda lane: F.concat(F.lit("["), F.array_join(F.transform(lane, point), ", "), F.lit("]")))
    return F.concat(
        F.lit('{"timestamp": '), epoch.cast("string"), F.lit(',\n"Lines": [\n'),
        F.array_join(rows, ",\n"), F.lit("\n]}"),
    )


def lane_report(rounded: Column, width: Column, height: Column) -> Column:
    """Lanes, points per lane, extent and, where the size is known, whether every point lies inside."""
    xs = F.flatten(F.transform(rounded, lambda lane: F.transform(lane, lambda p: p.x)))
    ys = F.flatten(F.transform(rounded, lambda lane: F.transform(lane, lambda p: p.y)))
    inside = (F.array_min(xs) >= 0) & (F.array_max(xs) <= width) & (F.array_min(ys) >= 0) & (F.array_max(ys) <= height)
    sized = (F.size(xs) > 0) & (F.coalesce(width, F.lit(0)) > 0) & (F.coalesce(height, F.lit(0)) > 0)
    return F.struct(
        F.size(rounded).cast("bigint").alias("n_lanes"),
        F.transform(rounded, F.size).alias("points_per_lane"),
        F.size(xs).cast("bigint").alias("n_points"),
        F.array_min(xs).alias("min_x"), F.array_max(xs).alias("max_x"),
        F.array_min(ys).alias("min_y"), F.array_max(ys).alias("max_y"),
        F.when(sized, inside).alias("in_bounds"),
    )


def exploded_points(df: DataFrame, keys: list[str], lanes: str) -> DataFrame:
    """One row per point: keys, lane_no, point_no and the point `p`.

    The outer form is used and empty rows are dropped afterwards: the inner form makes the optimizer
    infer a filter on the array and push it down, which parses every label several times.
    """
    rows = df.select(*keys, F.posexplode_outer(lanes).alias("lane_no", "lane"))
    points = rows.select(*keys, "lane_no", F.posexplode_outer("lane").alias("point_no", "p"))
    return points.filter(F.col("point_no").isNotNull())


def point_errors(df: DataFrame, keys: list[str], lanes: str, rounded: str) -> DataFrame:
    """One row per point: parsed and rounded coordinates and what the rounding moved."""
    pairs = F.zip_with(
        lanes, rounded, lambda old, new: F.zip_with(old, new, lambda o, r: F.struct(o.alias("o"), r.alias("r")))
    )
    points = exploded_points(df.select(*keys, pairs.alias("_pairs")), keys, "_pairs")
    return points.select(
        *keys, "lane_no", "point_no",
        F.col("p.o.x").alias("x"), F.col("p.o.y").alias("y"),
        F.col("p.r.x").alias("x_int"), F.col("p.r.y").alias("y_int"),
        (F.col("p.r.x") - F.col("p.o.x")).alias("dx"), (F.col("p.r.y") - F.col("p.o.y")).alias("dy"),
    )


def bend(lane: Column) -> Column:
    """Largest distance of a lane's points from its chord, as a share of the chord (0 for a straight lane)."""
    first, last = F.get(lane, F.lit(0)), F.element_at(lane, -1)
    dx, dy = last.x - first.x, last.y - first.y
    squared = dx * dx + dy * dy
    # Twice the area between chord and point is the distance times the chord.
    areas = F.array_max(F.transform(lane, lambda p: F.abs(dx * (p.y - first.y) - dy * (p.x - first.x))))
    return F.when((F.size(lane) >= 3) & (squared > 0), areas / squared)


def road_geometry(lanes: Column, threshold: float = 0.05) -> Column:
    """`curve` when any lane bends by more than `threshold`, `unknown` without a measurable lane."""
    most = F.array_max(F.transform(lanes, bend))
    return F.when(most > threshold, "curve").when(most.isNotNull(), "straight").otherwise("unknown")
