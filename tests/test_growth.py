"""What the object jobs cost by object: threads, folders, blur matrices, and tasks by the number of rows."""

import os
import threading
import time

import pytest
from conftest import write
from pyarrow import fs
from pyspark.sql import functions as F

from framequarry.config import Layout
from framequarry.operators import redact as R
from framequarry.operators.object_io import write_objects
from framequarry.plans import file_queries as Q
from framequarry.sources.requests import IN_A_ROW, SLOW, Requests
from framequarry.sources.store import Store


def test_quick_requests_need_no_threads_and_slow_ones_get_them():
    seen = []

    def quick(x):
        seen.append(threading.get_ident())
        return -x

    def slow(x):
        time.sleep(2 * SLOW)
        return quick(x)

    with Requests(4) as requests:
        assert requests.map(quick, list(range(100))) == [-x for x in range(100)] and set(seen) == {threading.get_ident()}
        seen.clear()
        assert requests.map(slow, list(range(60))) == [-x for x in range(60)]
        own = seen.count(threading.get_ident())
        assert own == IN_A_ROW and len(set(seen)) > 2
        assert requests.at_once(quick, [1, 2]) == [] and requests.map(quick, []) == []


def test_writes_to_a_slow_store_are_whole(spark, tmp_path):
    """Rows that turn out slow in the middle of a batch go on by threads: none is lost, none is written twice."""
    rows = [(f"{tmp_path}/o/{i}", str(i)) for i in range(600)] + [(None, "x"), (f"{tmp_path}/o/none", None)]
    df = spark.createDataFrame(rows, "u string, d string").coalesce(1)
    whole = Store.write

    def late(self, uri, data):
        time.sleep(0.02)
        whole(self, uri, data)

    Store.write = late
    try:
        got = write_objects(df, "u", "d").collect()
    finally:
        Store.write = whole
    assert [(r.u, r.d, r.write_error) for r in got] == [(u, d, None) for u, d in rows]
    assert {p.name: p.read_text() for p in (tmp_path / "o").iterdir()} == {str(i): str(i) for i in range(600)}


def test_a_folder_is_made_once(tmp_path):
    made = []

    class Asked(fs.LocalFileSystem):
        def create_dir(self, path, *, recursive=True):
            made.append(path)
            super().create_dir(path, recursive=recursive)

    store = Store()
    store._opened["file"] = Asked()
    for i in range(5):
        store.write(f"{tmp_path}/a/b/{i}", b"x")
        store.copy(f"{tmp_path}/a/b/{i}", f"{tmp_path}/c/{i}")
    assert made == [f"{tmp_path}/a/b", f"{tmp_path}/c"]
    assert sorted(p.name for p in (tmp_path / "c").iterdir()) == list("01234")
    with pytest.raises(FileNotFoundError):
        store.copy(f"{tmp_path}/gone", f"{tmp_path}/c/x")
    assert len(list((tmp_path / "c").iterdir())) == 5


def test_blur_matrices_and_kinds_are_made_once(monkeypatch):
    codec, made, asked = R.pixmap_codec(), [], []
    data = codec.encode(__import__("numpy").arange(8 * 4 * 3, dtype="uint8").reshape(4, 8, 3))
    boxes = [("Face", 0.9, 0, 0, 2, 2), ("plate", 0.9, 2, 0, 5, 3), ("car", 0.9, 0, 0, 8, 4), (None, 0.9, 0, 0, 8, 4)]

    def matrix(size, kernel, whole=R._blur_matrix):
        made.append(size)
        return whole(size, kernel)

    def kind(name, whole=R.kind_of):
        asked.append(name)
        return whole(name)

    monkeypatch.setattr(R, "_MATRICES", R.Kept(matrix))
    monkeypatch.setattr(R, "_KINDS", R.Kept(kind))
    done = R.redact_batch([data] * 50, lambda pictures: [boxes] * len(pictures), codec, 0.1, 31)
    assert {(r["faces"], r["plates"], r["error"]) for r in done} == {(1, 1, None)} and len({r["clean"] for r in done}) == 1
    assert sorted(made) == [2, 3] and asked == ["Face", "plate", "car", None]
    kept = R.Kept(lambda x: x)
    assert [kept[i,] for i in range(3 * R.KEPT)] == list(range(3 * R.KEPT)) and len(kept) <= R.KEPT


@pytest.fixture
def folder(spark, tmp_path):
    docs = spark.range(900).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"),
        F.element_at(F.array(*map(F.lit, ("en", "de", "fr", "es"))), (F.col("id") % 4 + 1).cast("int")).alias("lang"),
        F.concat(F.lit("src"), (F.col("id") % 3).cast("string")).alias("source"), F.lit(9).cast("long").alias("n_chars"),
    )
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    told = docs.filter("doc_id % 3 = 1").select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    told.coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_a_sorted_list_is_written_by_several_tasks(spark, folder, tmp_path):
    layout = Layout(*[f"{tmp_path}/{n}" for n in ("raw-public", "public", "raw-user", "user", "tables")])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        Q._list_dataset(spark, folder, layout, "roads", place="nested")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = sorted((tmp_path / "raw-public/roads/list/list/train.txt").glob("part-*"))
    ids = [[int(line.split("/")[-2].split(".")[0]) for line in p.read_text().splitlines() if line.strip()] for p in parts]
    english = range(0, 900, 4)
    assert [i for part in ids for i in part] == [i for i in english if i % 3 == 1] + [i for i in english if i % 3 != 1]
    assert sum(bool(part) for part in ids) > 1


def test_named_objects_are_dealt_out_by_rows(spark, tmp_path):
    write(tmp_path / "o", {str(i): str(i) for i in range(300)})
    named = spark.range(300).select(F.concat(F.lit(f"{tmp_path}/o/"), F.col("id").cast("string")).alias("uri")).coalesce(1)
    read = Q._read(named, "uri")
    assert read.rdd.getNumPartitions() > 1
    assert sorted(int(r.content) for r in read.collect()) == list(range(300))


def test_only_the_columns_in_use_become_python_rows():
    import pyarrow as pa

    from framequarry.operators.object_io import _worker

    seen = []
    batch = pa.RecordBatch.from_pydict({"u": ["a", None], "d": [b"1", b"2"], "other": [1, 2]})
    got = list(_worker(lambda store, row: seen.append(row), 1, "u", "d", "u")(iter([batch])))
    assert seen == [{"u": "a", "d": b"1"}, {"u": None, "d": b"2"}]
    assert [r for part in got for r in part.to_pylist()] == [{**r, "write_error": None} for r in batch.to_pylist()]


def test_a_task_takes_enough_objects_to_pay_for_its_workers(spark):
    from framequarry.session import spread

    assert [spread(spark.range(1), rows, "id").rdd.getNumPartitions() for rows in (64, 20_000, 80_000)] == [1, 8, 10]


def test_the_first_entry_is_cut_out_of_one_line(spark, tmp_path):
    from framequarry.sources.formats import _lines, first_entry

    text = " \n\t \x85 \r\n/a/1.jpg x\x0b/a/2.jpg  /a/3.jpg 1\r\x1c\n/a/4.jpg　y\n"
    write(tmp_path, {"none.txt": "\n \n", "list.txt": text})
    uris = [f"{tmp_path}/{n}.txt" for n in ("none", "list")]
    expected = [line for line in text.splitlines() if line.strip()]
    assert [r.line for r in _lines(spark, uris[1]).orderBy("place").collect()] == expected and len(expected) == 4
    entry = first_entry(spark, uris)
    assert entry.first().rel_path == "a/1.jpg" and first_entry(spark, uris[:1]).first().rel_path is None
    # The pattern for an entry is applied to the line that came first, not to all of them.
    assert "min_by(line" in entry._jdf.queryExecution().optimizedPlan().toString()


def test_written_data_ends_in_the_task(spark, tmp_path):
    rows = [(f"{tmp_path}/o/{i}", "x" * i, i) for i in range(5)] + [(None, "y", 5), (f"{tmp_path}/o/none", None, 6)]
    got = write_objects(spark.createDataFrame(rows, "u string, d string, n int"), "u", "d", without=("d",))
    assert got.columns == ["u", "n", "write_error"]
    assert sorted((r.n, r.u, r.write_error) for r in got.collect()) == [(n, u, None) for u, _, n in rows]
    assert {p.name: len(p.read_text()) for p in (tmp_path / "o").iterdir()} == {str(i): i for i in range(5)}


def test_local_objects_need_no_stream_and_no_random_number_each(tmp_path, monkeypatch):
    from framequarry.sources import store as S

    put, seen, short = os.write, [], [True]

    def drawn():
        raise AssertionError("a name was drawn")

    def some(handle, data):
        seen.append(len(data))
        return put(handle, data[:7] if short[0] else data)

    store = Store()
    monkeypatch.setattr(S.uuid, "uuid4", drawn)
    monkeypatch.setattr(S.os, "write", some)
    monkeypatch.setattr(S, "LOCAL_CHUNK", 20)
    a, b, empty = (f"{tmp_path}/new/{n}" for n in ("a", "b", "empty"))
    store.write(a, bytes(range(50)))
    store.copy(a, b)
    store.write(empty, b"")
    store.copy(empty, a)
    assert store.read(b) == bytes(range(50)) and store.read(a) == store.read(empty) == b"" and max(seen) == 50 and len(seen) > 10
    for source, error in ((f"{tmp_path}/gone", FileNotFoundError), (f"{tmp_path}/new", IsADirectoryError)):
        with pytest.raises(error):
            store.copy(source, f"{tmp_path}/new/c")

    def full(handle, data):
        raise PermissionError("full")

    monkeypatch.setattr(S.os, "write", full)
    with pytest.raises(PermissionError):
        store.write(b, b"other")
    # A write that fails leaves the old object and nothing beside it.
    assert sorted(p.name for p in (tmp_path / "new").iterdir()) == ["a", "b", "empty"] and store.read(b) == bytes(range(50))
    monkeypatch.undo()
    assert Store()._own != store._own


def test_an_entry_is_cut_at_a_space_and_a_word_is_stripped_once(spark):
    from framequarry.functions import lanes as LN, paths as P

    spaces = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    values = ["", " ", "/", "//a/b  c", "a", "😀/x y", " \x1f//é"] + [f"{s}{s}//a{s}/b{s}" for s in spaces] + spaces
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)] + [(len(values), None)], "i int, v string").coalesce(1)
    entry = df.select(P.list_entry("v").alias("e"))
    assert [r.e for r in entry.collect()] == [(v.split() or [""])[0].lstrip("/") for v in values] + [None]
    assert "regexp_extract" not in entry._jdf.queryExecution().optimizedPlan().toString()
    lanes = LN.parse_text_lanes(spark.createDataFrame([(f"{s}1.5{s} 2_0 3{s}4\n",) for s in spaces if len(f"a{s}".splitlines()[0]) > 1], "t string"), "t")
    assert {str(r.lanes) for r in lanes.collect()} == {"[[Row(x=1.5, y=20.0), Row(x=3.0, y=4.0)]]"}
    # Tokens are cut at spaces, so none is left to strip.
    assert "regexp_replace" not in lanes._jdf.queryExecution().optimizedPlan().toString()


def test_a_raw_tree_goes_when_no_run_reads_it_and_staged_tables_go_with_their_run(spark, folder, tmp_path, monkeypatch):
    from framequarry.plans import stream_queries as S

    told = spark.range(900).filter("id % 3 = 1").select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), (F.col("id") % 2).cast("int").alias("toxic"))
    told.write.mode("overwrite").parquet(f"{folder}/labels.parquet")
    there, lakes, whole = [], [], S._list_dataset

    def names(root):
        return sorted(n for n in os.listdir(root) if n != "_descriptors") if os.path.exists(root) else []

    def staged():
        return {n for n in os.listdir(spark.conf.get("spark.checkpoint.dir")) if n.startswith(("ingest", "labelling", "listing", "manifest", "upsert", "removed"))}

    def listed(spark, sf, layout, *rest, **more):
        there.append((names(layout.raw_public), names(layout.public)))
        lakes.append(layout)
        return whole(spark, sf, layout, *rest, **more)

    monkeypatch.setattr(S, "_list_dataset", listed)
    before = staged()
    rows = sorted(map(tuple, S.stream_run_log(spark, folder).collect()), key=str)
    failed = [(n, "FAILED_INGEST", None, None, None) for n in ("gone", "hollow")]
    done = [("set2", "OK", 300, 300, 0), ("set3", "OK", 300, 0, 0), ("set3", "OK", 300, 300, 0)]
    assert rows == [*failed, ("set1", "FAILED_INGEST", 150, None, 150), *done]
    # One raw tree at a time, and every placed image and label stays.
    assert there == [([], []), ([], ["set1"]), ([], ["set1", "set2"])]
    assert names(lakes[0].raw_public) == ["set3"]
    placed = [sum(n.endswith((".jpg", ".lines.json")) for _, _, found in os.walk(f"{lakes[0].public}/{name}") for n in found) for name in ("set1", "set2", "set3")]
    assert placed == [300, 600, 600]
    assert staged() <= before


def test_removed_objects(spark, tmp_path):
    from framequarry.operators.object_io import remove_objects

    write(tmp_path, {"set1/a/1": "x", "set1/2": "y", "set10/3": "z", "set1.txt": "w", "folder/4": "v"})
    rows = [(f"{tmp_path}/set1/2",), (f"{tmp_path}/set1/gone",), (None,), (f"{tmp_path}/folder",)]
    errors = {r.u: r.write_error for r in remove_objects(spark.createDataFrame(rows, "u string"), "u").collect()}
    assert [errors[u] is None for (u,) in rows] == [True, True, True, False]
    Q.remove_tree(spark, f"{tmp_path}/set1")
    Q.remove_tree(spark, f"{tmp_path}/set1")
    assert sorted(str(p.relative_to(tmp_path)) for p in tmp_path.rglob("*") if p.is_file()) == ["folder/4", "set1.txt", "set10/3"]
    assert not (tmp_path / "set1").exists()


def test_staged_tables_go_with_the_work_they_are_for(spark):
    from framequarry.session import stage, staged_within

    def file_of(df):
        return df.inputFiles()[0].removeprefix("file://")

    kept = stage(spark.range(3), "kept")
    with pytest.raises(ValueError), staged_within(spark):
        outer = file_of(stage(spark.range(3), "outer"))
        with staged_within(spark):
            inner = file_of(stage(spark.range(3), "inner"))
        assert os.path.exists(outer) and not os.path.exists(inner)
        others = []
        thread = threading.Thread(target=lambda: others.append(stage(spark.range(4), "other")))
        thread.start()
        thread.join()
        raise ValueError
    after = stage(spark.range(5), "after")
    assert not os.path.exists(outer) and [df.count() for df in (kept, *others, after)] == [3, 4, 5]
