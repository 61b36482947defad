"""Plans and skew: what the physical plan must and must not contain, and hot groups against brute force."""

from datetime import datetime

from pyspark.sql import functions as F

from framequarry.operators import pending as PD
from framequarry.operators.bloom import Bloom
from framequarry.operators import sequences as S
from framequarry.operators.tables import CatalogueTable
from framequarry.functions.times import epoch_time
from framequarry.plans import relation_queries as RQ
from framequarry.plans.registry import table
from framequarry.schemas import USER_IMAGES_PRIVACY
from framequarry.session import OBJECTS_PER_TASK, spread
from framequarry.sources.sessions import with_session_start

SF = "/root/testdata/sf0.001"
AS_OF = datetime(2024, 1, 31)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df):
    return [line for line in plan(df).splitlines() if "FileScan" in line]


def test_pending_work_is_an_anti_join_on_pruned_columns(spark):
    df = RQ.pending_targets(spark, SF)
    assert "LeftAnti" in plan(df)
    reads = " ".join(scans(df))
    assert "ReadSchema: struct<doc_id:bigint>" in reads and "text" not in reads and "n_chars" not in reads


def test_source_filter_reaches_the_scan(spark):
    for query in (RQ.pending_in_source, RQ.pending_in_dataset):
        reads = " ".join(scans(query(spark, SF)))
        assert "EqualTo(source,src7)" in reads


def test_redo_window_reaches_the_scan(spark, tmp_path):
    audit = CatalogueTable(spark, str(tmp_path), USER_IMAGES_PRIVACY)
    for day in range(4):
        audit.upsert(spark.createDataFrame([("ab"[day // 3],)], "image_id string").withColumn("processed_at", epoch_time(1700000000 - day * 86400 * 3)))
        audit.upsert(spark.createDataFrame([(f"d{day}",)], "image_id string").withColumn("processed_at", epoch_time(1700000000 - day * 86400 * 3)))
    df = PD.unprocessed(spark.createDataFrame([("a",)], "image_id string"), audit.scan(), epoch_time(1700000000))
    reads = " ".join(scans(df))
    assert "al(processed_at,2023-11-12 22:13:20.0)" in reads and "ReadSchema: struct<image_id:string,processed_at:timestamp>" in reads
    # Only the day with the window's rows is opened, of the four that the table has.
    assert "(processed_date#" in reads.partition("PartitionFilters")[2] and ">= 2023-11-12)" in reads
    recent = audit.scan().filter((F.col("processed_date") >= F.to_date(epoch_time(1700000000) - F.expr(PD.REDO_AFTER))))
    assert len({r.f.rpartition("/")[0] for r in recent.select(F.col("_metadata.file_path").alias("f")).collect()}) == 1
    assert PD.unprocessed(spark.createDataFrame([("d0",)], "image_id string"), audit.scan(), epoch_time(1700000000)).count() == 0
    assert PD.unprocessed(spark.createDataFrame([("d0",)], "image_id string"), audit.scan(), epoch_time(1700000000 + 48 * 3600 + 1)).count() == 1


def test_event_window_reaches_the_scan(spark):
    assert "al(ts,2024-01-29 00:00:00.0)" in " ".join(scans(RQ.pending_window(spark, SF)))


def test_positions_in_one_very_long_sequence(spark):
    """One sequence holds nearly all frames, with sparse numbers: no window goes over frames, only over ranges of them."""
    frames = spark.range(0, 30000, 1, 4).select(
        F.when(F.col("id") % 100 == 0, F.lit("small")).otherwise("hot").alias("s"), (F.col("id") * 3_000_000 + F.col("id") % 2).alias("n")
    )
    got = S.frame_positions(frames, "s", "n", "n")
    order = {"hot": [], "small": []}
    for i in range(30000):
        order["small" if i % 100 == 0 else "hot"].append(i * 3_000_000 + i % 2)
    want = {(s, n, k + 1) for s, ns in order.items() for k, n in enumerate(ns)}
    assert {(r.s, r.n, r.position) for r in got.collect()} == want
    windows = [line for line in plan(got).splitlines() if "windowspecdefinition" in line]
    assert windows and all("sum(_n" in line for line in windows)


def test_negative_and_equal_frame_numbers(spark):
    rows = [("a", -5, "x"), ("a", -5, "y"), ("a", 0, "z"), ("a", 9000, "w")]
    df = spark.createDataFrame(rows, "s string, n long, t string")
    got = {r.t: r.position for r in S.frame_positions(df, "s", "n", "t").collect()}
    assert got == {"x": 1, "y": 2, "z": 3, "w": 4}


def test_labels_of_a_hot_session(spark):
    frames = spark.range(0, 20000, 1, 4).select(F.when(F.col("id") % 50 == 0, F.col("id").cast("string")).otherwise("hot").alias("s"), F.col("id").alias("n"))
    labelled = frames.withColumn("label", F.when(F.col("n") % 7 == 3, F.col("n").cast("string")))
    chosen = S.propagate(frames, labelled, "s", [F.col("n")], ["label"])
    assert chosen.count() == 20000
    assert {r.label for r in chosen.filter("s = 'hot'").collect()} == {"3"}
    assert "partial_min_by" in plan(S.representatives(labelled, "s", [F.col("n")]))


def test_hot_session_lookup_is_split(spark):
    """Adaptive execution splits the partition of a session that holds most frames."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "12",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        frames = spark.range(0, 60000, 1, 8).select(
            F.lit("u").alias("user_id"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.md5(F.col("id").cast("string"))).alias("session_id"), F.md5((-F.col("id")).cast("string")).alias("image_id")
        )
        sessions = frames.select("user_id", "session_id").distinct().withColumn("captured_at", F.lit(1))
        joined = with_session_start(frames, sessions)
        assert len(joined.collect()) == 60000
        assert "skew=true" in plan(joined) or "isSkew" in plan(joined) or "(skew" in plan(joined)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_images_without_a_user_skip_the_join(spark):
    images = spark.createDataFrame([("a", None), ("b", None), ("c", "u"), ("d", "v")], "image_id string, user_id string")
    identity = spark.createDataFrame([("u", 1), ("v", None)], "user_id string, revoked_at int")
    df = PD.without_revoked(images, identity)
    assert sorted(r.image_id for r in df.collect()) == ["a", "b", "d"] and df.columns == images.columns


def test_images_are_read_once_for_withdrawn_users(spark, tmp_path):
    path = str(tmp_path / "images")
    users = F.when(F.col("id") % 3 > 0, F.concat(F.lit("u"), (F.col("id") % 1000).cast("string")))
    spark.range(0, 30000, 1, 4).select(F.col("id").cast("string").alias("image_id"), users.alias("user_id")).write.parquet(path)
    images = spark.read.parquet(path)
    identity = spark.range(200).select(F.concat(F.lit("u"), (F.col("id") * 7).cast("string")).alias("user_id"), F.when(F.col("id") % 2 == 0, F.lit(AS_OF)).alias("revoked_at"))
    gone = {f"u{i * 7}" for i in range(0, 200, 2)}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for limit in (before, "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            df = PD.without_revoked(images, identity)
            assert "LeftAnti" in plan(df) and len([line for line in scans(df) if "image_id" in line]) == 1
            assert ("Exchange hashpartitioning(_owner" in plan(df)) == (limit == "-1")
            got = {r.image_id for r in df.collect()}
            assert got == {str(i) for i in range(30000) if i % 3 == 0 or f"u{i % 1000}" not in gone}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_bloom_filter_rejects_most_and_no_key_wrongly(spark):
    held = spark.range(0, 5000).select(F.col("id").cast("string").alias("k"))
    bloom = Bloom(held.unionByName(spark.createDataFrame([(None,)], "k string")), "k")
    told = spark.range(0, 50000).select(F.col("id"), bloom.may_hold(F.col("id").cast("string")).alias("may"))
    assert told.filter("id < 5000 and not may").count() == 0 and told.filter("id >= 5000 and may").count() < 45000 * 0.05
    assert not spark.createDataFrame([(None,)], "k string").select(bloom.may_hold(F.col("k"))).first()[0]
    assert not spark.range(1).select(Bloom(held.limit(0), "k").may_hold(F.lit("x"))).first()[0]


def test_object_tasks_follow_the_number_of_rows(spark):
    df = spark.range(10).select(F.col("id").cast("string").alias("k"))
    sizes = {rows: spread(df, rows, "k").rdd.getNumPartitions() for rows in (0, 10, 1000, 1_000_000)}
    assert sizes[0] == sizes[10] == 1 and sizes[1000] == 8 and sizes[1_000_000] == -(-1_000_000 // OBJECTS_PER_TASK)


def test_responses_are_parsed_once(spark):
    from framequarry.operators.labelling import read_responses

    df = read_responses(table(spark, SF, "events").select(F.col("props").alias("response")))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("parseJson(") == 1
