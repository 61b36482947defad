import sys

from pyspark import cloudpickle

from conftest import write
from framequarry.plans.ingest import ingest
from framequarry.plans.labelling import label_images
from framequarry.streaming.descriptors import FAILED_CLASSIFY, FAILED_INGEST, OK, SKIPPED, counts_of, read_log, run_dataset, watch_descriptors

# Stand-in models travel with the job, as executors cannot import test files.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

EPOCH = 1700000000


def labeller(prompt, schema):
    return lambda data: '{"weather": "fog"}'


def test_outcomes():
    def fail(name):
        raise ValueError("x")

    good = {"num_images": 2, "failed": 0}
    assert run_dataset("a", lambda d: good, lambda d: {"classified": 2}) == (OK, None, {"num_images": 2, "failed": 0, "classified": 2})
    assert run_dataset("a", fail, lambda d: {})[:2] == (FAILED_INGEST, "ValueError: x")
    assert run_dataset("a", lambda d: {"failed": 3}, lambda d: {})[:2] == (FAILED_INGEST, "3 samples failed")
    assert run_dataset("a", lambda d: good, fail) == (FAILED_CLASSIFY, "ValueError: x", good)
    assert run_dataset("a", lambda d: good, lambda d: {"failed": 1})[0] == FAILED_CLASSIFY
    assert run_dataset(None, fail, fail)[0] == SKIPPED and run_dataset("", fail, fail)[0] == SKIPPED


def test_descriptor_stream_end_to_end(spark, lake, tmp_path):
    write(lake.raw_public, {
        "_descriptors/default.yml": "adapter: ''", "_descriptors/a.yml": "adapter: culane", "_descriptors/broken.yml": "adapter: kitti", "_descriptors/hollow.yml": "",
        "a/list/train.txt": "d/1.jpg", "a/d/1.jpg": "x", "a/d/1.lines.txt": "1 2 3 4",
    })

    def run_ingest(name):
        return counts_of(ingest(spark, lake, name, EPOCH).summary)

    def run_label(name):
        return counts_of(label_images(spark, lake, labeller, "m", EPOCH, "public", "culane").summary)

    def start(checkpoint="checkpoint"):
        query = watch_descriptors(spark, lake.descriptors_root, str(tmp_path / checkpoint), str(tmp_path / "log"), run_ingest, run_label, clock=lambda: EPOCH)
        query.awaitTermination()
        return sorted(((r.dataset, r.outcome, (r.counts or {}).get("num_images"), (r.counts or {}).get("classified")) for r in read_log(spark, str(tmp_path / "log")).filter(f"at = timestamp_seconds({EPOCH})").collect()), key=str)

    first = [("a", OK, 1, 1), ("broken", FAILED_INGEST, None, None), ("hollow", FAILED_INGEST, None, None)]
    assert start() == first
    assert start() == first
    write(lake.raw_public, {"_descriptors/a2.yml": "adapter: culane", "a2/list/val.txt": "e/2.jpg", "a2/e/2.jpg": "y", "a2/e/2.lines.txt": "1 2 3 4"})
    assert start() == sorted([("a", OK, 1, 1), ("a2", OK, 1, 1), *first[1:]], key=str)
    # Uploads of known names, one with other bytes and one still empty, each start a run; the rest does not.
    write(lake.raw_public, {"_descriptors/a.yml": "adapter: culane\nversion: 2", "_descriptors/hollow.yml": ""})
    again = sorted([*first, ("a2", OK, 1, 1), ("a", OK, 1, 0), first[2]], key=str)
    assert sorted(start(), key=str) == again
    assert sorted(start(), key=str) == again
    # A stream with a new checkpoint runs all descriptors again and leaves the older logs.
    assert sorted(start("other"), key=str) == sorted([*again, ("a", OK, 1, 0), ("a2", OK, 1, 0), *first[1:]], key=str)
    # A manual rerun of a dataset is the same function.
    assert run_dataset("a", run_ingest, run_label)[2]["reused"] == 1


def test_a_late_row_does_not_replace_a_later_one(spark, tmp_path):
    from pyspark.sql import functions as F, types as T

    from framequarry.operators.tables import CatalogueTable
    from framequarry.schemas import TableSpec
    from framequarry.streaming.upserts import upsert_stream

    spec = TableSpec("latest", T.StructType([T.StructField("user_id", T.LongType()), T.StructField("event_id", T.LongType())]), ("user_id",))
    latest = CatalogueTable(spark, str(tmp_path / "table"), spec)
    for number, rows in enumerate([[(1, 9), (2, 4)], [(1, 3), (2, 5)]]):
        spark.createDataFrame(rows, spec.schema).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(spec.schema).parquet(str(tmp_path / "in"))
        upsert_stream(stream, latest, str(tmp_path / "checkpoint"), order=[-F.col("event_id")]).awaitTermination()
    assert sorted(map(tuple, latest.read().collect())) == [(1, 9), (2, 5)]


def test_a_repeated_batch_runs_only_what_it_has_not_logged(spark, lake, tmp_path):
    import pytest

    write(lake.raw_public, {f"_descriptors/{n}.yml": "adapter: x" for n in "abc"})
    ran, broken = [], [True]

    def run_ingest(name):
        ran.append(name)
        return {"num_images": 1}

    def clock():
        if ran[-1] == "c" and broken.pop():
            raise RuntimeError("the driver dies before it logs")
        return EPOCH

    def start():
        watch_descriptors(spark, lake.descriptors_root, str(tmp_path / "checkpoint"), str(tmp_path / "log"), run_ingest, lambda name: {}, clock).awaitTermination(60)

    with pytest.raises(Exception, match="dies before"):
        start()
    broken[:] = [False]
    start()
    assert ran == ["a", "b", "c", "c"] and sorted(r.dataset for r in read_log(spark, str(tmp_path / "log")).collect()) == ["a", "b", "c"]
