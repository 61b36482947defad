import json
import sys

from pyspark import cloudpickle
from pyspark.sql import functions as F

from conftest import write
from framequarry.functions import labels as L
from framequarry.operators.tables import CatalogueTable
from framequarry.plans.labelling import label_images
from framequarry.schemas import CLASSIFICATIONS, IMAGES
from framequarry.sources.taxonomy import SCENE_TAXONOMY

# Stand-in models travel with the job, as executors cannot import test files.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

EPOCH = 1700000000


def model(data: bytes) -> str:
    if data == b"boom":
        raise RuntimeError("quota")
    return data.decode()


def labeller(prompt, schema):
    return model


def catalogue(spark, lake, contents):
    write(lake.public, {name: text for name, text in contents.items() if text is not None})
    rows = [(name, "public", "x" if name < "m" else "y", f"{lake.public}/{name}") for name in contents]
    CatalogueTable(spark, lake.table_path("images"), IMAGES).upsert(spark.createDataFrame(rows, "image_id string, source string, dataset string, gcs_uri string"))


ANSWERS = {
    "a": json.dumps({"weather": "rain", "scene": "city", "timeofday": "day", "road_geometry": "curve"}), "b": json.dumps({"weather": "RAIN", "scene": 5}),
    "c": "{}", "d": "no json", "e": "[1]", "f": None, "g": "boom", "n": json.dumps({"weather": "snow"}),
}


def done(spark, lake):
    rows = CatalogueTable(spark, lake.table_path("classifications"), CLASSIFICATIONS).read().collect()
    return {r.image_id: (r.weather, r.scene, r.timeofday, r.road_geometry) for r in rows}


def test_run_and_rerun(spark, lake):
    catalogue(spark, lake, ANSWERS)
    run = label_images(spark, lake, labeller, "m1", EPOCH, "public", "x", slices=2)
    assert tuple(run.summary.first()) == (7, 3, 4, 1)
    errors = {r.image_id: r.error for r in run.outcome.filter("status = 'error'").collect()}
    assert errors["d"] == "response: not JSON" and errors["e"] == "response: not an object"
    assert "FileNotFound" in errors["f"] and errors["g"] == "RuntimeError: quota"
    unknown = ("unknown",) * 4
    assert done(spark, lake) == {"a": ("rain", "city", "day", "curve"), "b": unknown, "c": unknown}
    row = CatalogueTable(spark, lake.table_path("classifications"), CLASSIFICATIONS).read().filter("image_id = 'a'").first()
    assert row.model == "m1" and row.scores is None and row.classified_at == row.geometry_at

    again = label_images(spark, lake, labeller, "m1", EPOCH, "public", "x")
    assert tuple(again.summary.first())[:3] == (4, 0, 4)
    everything = label_images(spark, lake, labeller, "m1", EPOCH, "public", "")
    assert tuple(everything.summary.first())[:3] == (5, 1, 4) and done(spark, lake)["n"][0] == "snow"
    assert label_images(spark, lake, labeller, "m1", EPOCH, "user").summary.first().candidates == 0


def test_dry_run_and_limit(spark, lake):
    catalogue(spark, lake, ANSWERS)
    run = label_images(spark, lake, labeller, "m1", EPOCH, "public", dry_run=True, limit=2, tasks=1)
    row = run.summary.first()
    assert row.candidates == 2 and row.classified <= row.candidates and done(spark, lake) == {}
    assert sorted(r.image_id for r in run.outcome.collect()) == ["a", "b"]


def test_response_schema():
    body = L.json_response_schema(SCENE_TAXONOMY)
    assert body["required"] == list(SCENE_TAXONOMY) and body["properties"]["scene"] == {"type": "string", "enum": SCENE_TAXONOMY["scene"]}


def test_values_outside_the_taxonomy(spark):
    df = spark.createDataFrame([("rain",), ("Rain",), (" rain",), ("",), (None,), ("unknown",)], "v string").coalesce(1)
    got = [r[0] for r in df.select(L.in_taxonomy(F.col("v"), SCENE_TAXONOMY["weather"])).collect()]
    assert got == ["rain"] + ["unknown"] * 5


def echo(prompt, schema):
    """Answers what it was asked; at most two calls at a time."""
    import threading

    free = threading.Semaphore(2)

    def label(data):
        assert free.acquire(blocking=False)
        try:
            return json.dumps({"prompt": prompt, "scene": schema["properties"]["scene"]["enum"]})
        finally:
            free.release()

    return label


def test_labeller_gets_prompt_and_schema(spark, tmp_path):
    from framequarry.operators.labelling import label_objects

    write(tmp_path, {str(i): "x" for i in range(40)})
    named = spark.range(40).selectExpr(f"'{tmp_path}/' || id AS uri").coalesce(1)
    said = label_objects(named, "uri", echo, {"scene": ["city", "unknown"]}, "One of {scene}.", in_flight=2).collect()
    assert {(r.response, r.error) for r in said} == {(json.dumps({"prompt": "One of ['city', 'unknown'].", "scene": ["city", "unknown"]}), None)}


def test_a_slow_call_holds_up_no_other():
    """One slow call among fast ones: the others go on, over batches too, at most `limit` run at a time, answers stand in row order."""
    import threading
    import time

    import pyarrow as pa

    from framequarry.operators.calls import OPEN_BATCHES, windowed

    lock, running, peak, ended = threading.Lock(), 0, 0, []

    def call(x):
        nonlocal running, peak
        with lock:
            running += 1
            peak = max(peak, running)
        time.sleep(0.6 if x == 5 else 0.002)
        with lock:
            running -= 1
            ended.append(x)
        return 10 * x

    batches = [pa.RecordBatch.from_pydict({"x": list(range(lo, lo + 20))}) for lo in range(0, 120, 20)]
    got = [(b.column("x").to_pylist(), answers) for b, answers in windowed(iter([*batches, batches[0].slice(0, 0)]), "x", call, 4)]
    assert [x for xs, _ in got for x in xs] == list(range(120)) and all(answers == [10 * x for x in xs] for xs, answers in got)
    assert peak == 4 and sorted(ended) == list(range(120))
    # Whatever may be open beside the slow call's batch was done before it ended.
    assert ended.index(5) >= 20 * OPEN_BATCHES - 1
    assert list(windowed(iter([]), "x", call, 4)) == []


def test_calls_under_way_end_before_an_error_goes_on():
    import threading
    import time

    import pytest
    import pyarrow as pa

    from framequarry.operators.calls import windowed

    ended = threading.Semaphore(0)

    def call(x):
        time.sleep(0.05)
        ended.release()

    def source():
        yield pa.RecordBatch.from_pydict({"x": [1, 2, 3]})
        raise RuntimeError("the list cannot be read")

    with pytest.raises(RuntimeError):
        list(windowed(source(), "x", call, 8))
    assert all(ended.acquire(blocking=False) for _ in range(3))


def test_progress_is_told_slice_by_slice(spark, lake):
    catalogue(spark, lake, ANSWERS)
    told, written = [], []

    def progress(counts):
        told.append(counts)
        written.append(len(done(spark, lake)))

    run = label_images(spark, lake, labeller, "m1", EPOCH, "public", "", slices=4, progress=progress)
    # Counts are there while the run goes on: a slice's are told before its rows are in the table.
    assert [c["slices"] for c in told] == [1, 2, 3, 4] and written[0] == 0 and all(w <= c["ok"] for w, c in zip(written, told))
    assert all(a["candidates"] <= b["candidates"] for a, b in zip(told, told[1:]))
    row = run.summary.first()
    assert (told[-1]["candidates"], told[-1]["ok"], told[-1]["failed"]) == (row.candidates, row.classified, row.failed) == (8, 4, 4)
