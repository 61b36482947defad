from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from framequarry.operators import manifests as M
from framequarry.operators import tables as TB
from framequarry.schemas import IMAGES, TableSpec, align

SPEC = TableSpec("t", T.StructType([T.StructField(n, T.StringType()) for n in ("k", "a", "b")]), ("k",), ("a",))
KEYS_ONLY = TableSpec("k", T.StructType([T.StructField("k", T.StringType())]), ("k",))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def frame(spark, values, schema="k string, a string, b string"):
    return spark.createDataFrame(values, schema).coalesce(1)


ROWS = st.lists(st.tuples(st.sampled_from("pqrstu"), st.sampled_from("xyz"), st.none()), max_size=8, unique_by=lambda r: r[0])


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(first=ROWS, second=ROWS)
def test_upsert_is_idempotent_and_keeps_keys(spark, tmp_path_factory, first, second):
    table = TB.CatalogueTable(spark, str(tmp_path_factory.mktemp("t")), SPEC)
    assert table.upsert(frame(spark, first)) == len(first)
    table.upsert(frame(spark, second))
    once = rows(table.read())
    table.upsert(frame(spark, second))
    assert rows(table.read()) == once
    assert once == sorted({**{r[0]: r for r in first}, **{r[0]: r for r in second}}.values(), key=str)


def test_absent_columns_become_null(spark, tmp_path):
    table = TB.CatalogueTable(spark, str(tmp_path), SPEC)
    table.upsert(frame(spark, [("p", "1", "2")]))
    table.upsert(frame(spark, [("p", "9", "ignored")], "k string, a string, extra string"))
    assert rows(table.read()) == [("p", "9", None)]


def test_no_rows_no_write(spark, tmp_path):
    table = TB.CatalogueTable(spark, str(tmp_path / "t"), SPEC)
    assert table.upsert(frame(spark, [])) == 0
    assert not (tmp_path / "t").exists() and table.read().count() == 0


def test_null_keys_are_always_added(spark, tmp_path):
    table = TB.CatalogueTable(spark, str(tmp_path), SPEC)
    for _ in range(2):
        table.upsert(frame(spark, [(None, "1", None), (None, "1", None), ("p", "1", None)]))
    assert rows(table.read()) == sorted([("p", "1", None)] + [(None, "1", None)] * 4, key=str)


def test_key_only_table(spark, tmp_path):
    table = TB.CatalogueTable(spark, str(tmp_path), KEYS_ONLY)
    table.upsert(frame(spark, [("p",), ("q",)], "k string"))
    table.upsert(frame(spark, [("q",), ("r",)], "k string"))
    assert rows(table.read()) == [("p",), ("q",), ("r",)]


def files(table):
    """{partition folder: names of its files}."""
    found = {}
    for p in Path(table.path).rglob("*.parquet"):
        found.setdefault(p.parent.name, set()).add(p.name)
    return found


def test_new_keys_rewrite_no_file(spark, tmp_path):
    table = TB.CatalogueTable(spark, str(tmp_path), SPEC)

    def new(lo, hi):
        return spark.range(lo, hi).selectExpr("'n' || id AS k", "'1' AS a", "'2' AS b")

    table.upsert(new(0, 500))
    first = files(table)
    assert table.upsert(new(500, 700)) == 200
    after = files(table)
    assert all(first[part] < after[part] for part in first) and table.read().count() == 700
    table.upsert(frame(spark, [("n3", "9", None), ("n900", "9", None)]))
    again = files(table)
    replaced = [part for part in after if not after[part] <= again[part]]
    assert len(replaced) == 1 and not after[replaced[0]] & again[replaced[0]]
    assert table.read().count() == 701 and table.read().filter("k = 'n3'").first().a == "9"


def day(spark, values):
    return frame(spark, values, "image_id string, width long, day string").withColumn("ingested_at", F.to_timestamp("day"))


def test_rows_move_between_dates(spark, tmp_path):
    table = TB.CatalogueTable(spark, str(tmp_path), IMAGES)
    table.upsert(day(spark, [("a", 1, "2024-01-01"), ("b", 1, "2024-01-02"), ("c", 1, "2024-01-02"), ("d", 1, "2024-01-03"), ("e", 1, None)]))
    before = files(table)
    assert before.keys() == {f"ingested_date={d}" for d in ("2024-01-01", "2024-01-02", "2024-01-03", "__HIVE_DEFAULT_PARTITION__")}
    # a and e leave their dates empty, b leaves c behind; the third day is not opened.
    table.upsert(day(spark, [("a", 2, "2024-01-04"), ("b", 2, "2024-01-04"), ("e", 2, "2024-01-02")]))
    after = files(table)
    assert after.keys() == {f"ingested_date=2024-01-0{d}" for d in (2, 3, 4)} and after["ingested_date=2024-01-03"] == before["ingested_date=2024-01-03"]
    got = {(r.image_id, r.width, str(r.ingested_date)) for r in table.scan().collect()}
    assert got == {("a", 2, "2024-01-04"), ("b", 2, "2024-01-04"), ("c", 1, "2024-01-02"), ("d", 1, "2024-01-03"), ("e", 2, "2024-01-02")}
    table.upsert(day(spark, [("d", 3, None)]))
    assert {r.image_id: r.width for r in table.read().collect()} == {"a": 2, "b": 2, "c": 1, "d": 3, "e": 2}
    assert "ingested_date=2024-01-03" not in files(table)


def test_a_run_that_dies_between_its_writes_is_mended_by_its_repeat(spark, tmp_path, monkeypatch):
    table = TB.CatalogueTable(spark, str(tmp_path), IMAGES)
    table.upsert(day(spark, [("a", 1, "2024-01-01"), ("b", 1, "2024-01-01")]))
    write = TB.CatalogueTable._write

    def dies(self, rows, mode):
        if mode == "overwrite":
            raise KeyboardInterrupt
        write(self, rows, mode)

    monkeypatch.setattr(TB.CatalogueTable, "_write", dies)
    with pytest.raises(KeyboardInterrupt):
        table.upsert(day(spark, [("a", 2, "2024-01-02")]))
    assert {r.image_id for r in table.read().collect()} == {"a", "b"}
    monkeypatch.undo()
    table.upsert(day(spark, [("a", 2, "2024-01-02")]))
    assert sorted((r.image_id, r.width) for r in table.read().collect()) == [("a", 2), ("b", 1)]


def test_one_row_per_key_in_a_batch(spark, tmp_path):
    table = TB.CatalogueTable(spark, str(tmp_path), SPEC)
    source = frame(spark, [("p", "z", "1"), ("p", "a", "2"), ("q", "b", "3")])
    assert table.upsert(source, order=[F.col("a")]) == 2
    assert rows(table.read()) == [("p", "a", "2"), ("q", "b", "3")]
    assert rows(TB.key_collisions(source, ["k"])) == [("p", 2)]


def test_dedup_of_a_hot_key_shuffles_one_row_per_task(spark):
    """One key holds nearly all rows; the partial aggregate runs before the exchange."""
    hot = spark.range(0, 20000, 1, 4).select(F.lit("p").alias("k"), F.col("id").cast("string").alias("a"), F.lit(None).cast("string").alias("b"))
    first = TB.dedup(hot, ["k"], [F.col("a").cast("bigint").alias("n") * -1])
    assert rows(first) == [("p", "19999", None)]
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan


def test_align_types_and_order(spark):
    df = spark.createDataFrame([(5, "i1")], "width int, image_id string")
    out = align(df, IMAGES.schema)
    assert out.schema.names == IMAGES.schema.names and out.first().width == 5 and out.first().split is None


def test_manifests_survive_a_run_that_dies_between_the_renames(spark, tmp_path, monkeypatch):
    root, names = str(tmp_path), ["val/val.txt"]

    def write(*paths):
        old = M.read_manifests(spark, root, names)
        new = spark.createDataFrame([(names[0], p) for p in paths], "txt_rel string, path string")
        return M.write_manifests(M.merged_lines(new, old, names), old, root).first().changed

    def lines():
        return sorted(r.path for r in M.read_manifests(spark, root, names).collect())

    assert write("b", "a") and lines() == ["a", "b"]
    written = {p.name for p in (tmp_path / "val/val.txt").iterdir()}
    assert not write("a") and {p.name for p in (tmp_path / "val/val.txt").iterdir()} == written
    # Dies after the old lines were put aside.
    (tmp_path / "val/val.txt").rename(tmp_path / f"val/val.txt{M.REPLACED}1")
    assert lines() == ["a", "b"]
    assert write("c") and lines() == ["a", "b", "c"]
    assert [p.name for p in (tmp_path / "val").iterdir()] == ["val.txt"]
    # Dies before what was replaced is deleted.
    monkeypatch.setattr(M, "_left_behind", lambda *_: [])
    assert write("d")
    monkeypatch.undo()
    assert lines() == ["a", "b", "c", "d"] and not write("d")
