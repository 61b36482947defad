import json
import os

import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from conftest import write
from framequarry.operators.object_io import copy_objects, write_objects
from framequarry.sources import descriptors as DS
from framequarry.sources import listing as LS
from framequarry.sources.formats import find_format, json_samples, list_samples
from framequarry.sources.objects import list_objects, read_objects
from framequarry.sources.store import Store
from framequarry.sources.taxonomy import SCENE_TAXONOMY, parse_taxonomy, prompt_text, taxonomy_frame


def names(df, root):
    return sorted(r.path[len(str(root)) + 1:] for r in df.collect())


def test_listing_is_by_text_prefix_and_keeps_empty_files(spark, tmp_path):
    write(tmp_path, {"images/a/1.jpg": "x", "images2/2.jpg": "", "im.txt": "yy", "other/3.jpg": "z"})
    assert names(list_objects(spark, f"{tmp_path}/images"), tmp_path) == ["images/a/1.jpg", "images2/2.jpg"]
    assert names(list_objects(spark, f"{tmp_path}/"), tmp_path) == ["im.txt", "images/a/1.jpg", "images2/2.jpg", "other/3.jpg"]
    assert list_objects(spark, f"{tmp_path}/missing/x").count() == 0
    assert names(list_objects(spark, f"{tmp_path}/other/", f"{tmp_path}/images/"), tmp_path) == ["images/a/1.jpg", "other/3.jpg"]
    sizes = {r.path.rsplit("/", 1)[-1]: (r.length, r.modificationTime is not None) for r in list_objects(spark, f"{tmp_path}/i").collect()}
    assert sizes == {"1.jpg": (1, True), "2.jpg": (0, True), "im.txt": (2, True)}


def test_reads_tell_missing_from_empty(spark, tmp_path):
    write(tmp_path, {"a b#?.txt": "é", "empty": "", "bad": b"\xff\xfe\xff"})
    uris = [f"{tmp_path}/{n}" for n in ("a b#?.txt", "empty", "gone", "bad")] + [None, f"file://{tmp_path}/empty"]
    df = spark.createDataFrame([(u,) for u in uris], "u string").coalesce(1)
    text = [(r.content, r.found, r.read_error is not None) for r in read_objects(df, "u", as_text=True).collect()]
    assert text == [("é", True, False), ("", True, False), (None, False, False), (None, False, True), (None, False, False), ("", True, False)]
    assert [r.content for r in read_objects(df, "u").collect()][:2] == ["é".encode(), b""]


def test_writes_and_copies_report_per_row(spark, tmp_path):
    write(tmp_path, {"file": "in the way"})
    df = spark.createDataFrame([(f"{tmp_path}/o/1", "x"), (f"{tmp_path}/o/2", None), (None, "y"), (f"{tmp_path}/file/below", "z")], "u string, d string").coalesce(1)
    errors = [r.write_error for r in write_objects(df, "u", "d").collect()]
    assert errors[:3] == [None, None, None] and errors[3]
    assert (tmp_path / "o/1").read_text() == "x" and not (tmp_path / "o/2").exists()
    plan = spark.createDataFrame([(f"{tmp_path}/o/1", f"{tmp_path}/c/1"), (f"{tmp_path}/gone", f"{tmp_path}/c/2")], "s string, t string").coalesce(1)
    errors = [r.write_error for r in copy_objects(plan, "s", "t").collect()]
    assert errors[0] is None and "FileNotFound" in errors[1]
    assert (tmp_path / "c/1").read_text() == "x" and not (tmp_path / "c/2").exists()


def test_large_objects_are_copied_in_chunks(tmp_path):
    data = bytes(range(256)) * 80_000
    write(tmp_path, {"big": data})
    Store().copy(f"{tmp_path}/big", f"{tmp_path}/copy")
    assert (tmp_path / "copy").read_bytes() == data


def test_failed_write_leaves_nothing(tmp_path):
    write(tmp_path, {"o/old": "old"})
    for name in ("new", "old"):
        with pytest.raises(RuntimeError), Store()._target(f"{tmp_path}/o/{name}") as out:
            out.write(b"half")
            raise RuntimeError
    assert [p.name for p in (tmp_path / "o").iterdir()] == ["old"] and (tmp_path / "o/old").read_text() == "old"


def test_descriptors(spark, tmp_path):
    write(tmp_path, {
        "default.yml": "adapter: ''", "a.yml": "adapter: [", "b.yml": "dataset: x", "c.yml": "", "notes.txt": "adapter: x",
        "d.yml": "adapter: culane\nversion: 2018\nlicense: ''\noptions: {overwrite: 1, list_dir: my/list}", "e.yml": "- 1",
        "f.yml": "adapter: culane\noptions:\nimage_ext: .png",
    })
    found = {r.run_dataset: r for r in DS.scan_descriptors(spark, str(tmp_path)).collect()}
    assert sorted(found) == ["a", "b", "c", "d", "e", "f"]
    assert all(found[n].error for n in "abce")
    d, f = found["d"], found["f"]
    assert (d.version, d.license, d.overwrite, d.skip_missing_labels, d.ingest_unlabeled, d.image_ext, d.list_dir) == ("2018", None, True, True, False, ".jpg", "my/list")
    assert (f.image_ext, f.overwrite, f.version) == (".png", False, None)
    assert DS.first_valid(DS.scan_descriptors(spark, str(tmp_path))).first().run_dataset == "d"
    with pytest.raises(ValueError, match="FileNotFound"):
        DS.read_descriptor(spark, str(tmp_path), "gone")
    with pytest.raises(ValueError, match="adapter"):
        DS.read_descriptor(spark, str(tmp_path), "b")


def test_unknown_format_names_the_known_ones():
    with pytest.raises(ValueError, match="culane, curvelanes"):
        find_format("kitti")


def samples(spark, root, files, options="", read=list_samples, splits=None, adapter="culane"):
    write(root / "raw", files)
    write(root / "d", {"x.yml": f"adapter: {adapter}\n{options}"})
    df = read(spark, DS.read_descriptor(spark, str(root / "d"), "x"), str(root / "raw"), splits)
    base = len(str(root / "raw")) + 1
    return sorted((r.split, r.category, r.rel_path, r.src_image_uri[base:], r.label_uri[base:]) for r in df.collect())


def test_list_format_standard_layout(spark, tmp_path):
    got = samples(spark, tmp_path, {
        "list/train.txt": "/d1/c.MP4/1.jpg /seg/1.png 1 1\r\n\r\nd1/c.MP4/2.jpg\n", "list/val.txt": " d2/3.jpg ",
        "list/test_split/test1_crowd.txt": "d2/4.jpg\n", "list/test_split/test0_normal.txt": "d2/3.jpg\nd2/4.jpg\n", "list/test.txt": "never.jpg",
        "list/test_split/readme.md": "no", "d1/c.MP4/1.jpg": "", "d1/c.MP4/1.lines.txt": "",
    })
    assert len(got) == 6 and set(got) == {
        ("train", None, "d1/c.MP4/1.jpg", "d1/c.MP4/1.jpg", "d1/c.MP4/1.lines.txt"),
        ("train", None, "d1/c.MP4/2.jpg", "d1/c.MP4/2.jpg", "d1/c.MP4/2.lines.txt"),
        ("val", None, "d2/3.jpg", "d2/3.jpg", "d2/3.lines.txt"),
        ("test", "normal", "d2/3.jpg", "d2/3.jpg", "d2/3.lines.txt"), ("test", "normal", "d2/4.jpg", "d2/4.jpg", "d2/4.lines.txt"),
        ("test", "crowd", "d2/4.jpg", "d2/4.jpg", "d2/4.lines.txt"),
    }


def test_list_format_nested_lists_images_and_labels(spark, tmp_path):
    got = samples(spark, tmp_path, {"list/list/test.txt": "d1/a/1.jpg\n", "list/list/train.txt": "d1/a/2.jpg", "d1/d1/a/2.jpg": "", "d1/d1/a/2.lines.txt": ""})
    assert got == [("test", None, "d1/a/1.jpg", "d1/d1/a/1.jpg", "d1/d1/a/1.lines.txt"), ("train", None, "d1/a/2.jpg", "d1/d1/a/2.jpg", "d1/d1/a/2.lines.txt")]


def test_list_format_label_folder(spark, tmp_path):
    files = {"list/train.txt": "d1/a/2.jpg", "d1/a/2.jpg": "", "annotations_new/d1/a/2.lines.txt": ""}
    assert samples(spark, tmp_path / "found", files)[0][4] == "annotations_new/d1/a/2.lines.txt"
    assert samples(spark, tmp_path / "forced", files, "options: {label_dir: other/dir}")[0][4] == "other/dir/d1/a/2.lines.txt"
    assert samples(spark, tmp_path / "lists", {"my/train.txt": "q.jpg"}, "options: {list_dir: my}") == [("train", None, "q.jpg", "q.jpg", "q.lines.txt")]


def test_list_format_without_lists_or_images(spark, tmp_path):
    assert samples(spark, tmp_path, {"readme": ""}) == []


def test_list_format_split_restriction(spark, tmp_path):
    files = {"list/train.txt": "a.jpg", "list/val.txt": "b.jpg", "list/test.txt": "c.jpg"}
    assert [r[0] for r in samples(spark, tmp_path, files, splits={"val", "test"})] == ["test", "val"]


def test_json_format(spark, tmp_path):
    files = {
        "train/train.txt": "images/a b/1.jpg\n/images/2.jpg\n\nother/3.jpg\n", "valid/valid.txt": "images/2.jpg", "test/images/t/9.jpg": "", "test/images/t/8.JPG": "",
        "test/images2/7.jpg": "", "test/labels/t/9.lines.json": "",
    }
    listed = [
        ("train", None, "2.jpg", "train/images/2.jpg", "train/labels/2.lines.json"),
        ("train", None, "a b/1.jpg", "train/images/a b/1.jpg", "train/labels/a b/1.lines.json"),
        ("train", None, "other/3.jpg", "train/other/3.jpg", "train/labels/other/3.lines.json"),
        ("val", None, "2.jpg", "valid/images/2.jpg", "valid/labels/2.lines.json"),
    ]
    assert samples(spark, tmp_path / "a", files, read=json_samples, adapter="curvelanes") == listed
    unlisted = [
        ("test", None, "images2/7.jpg", "test/images2/7.jpg", "test/labels/images2/7.lines.json"),
        ("test", None, "t/9.jpg", "test/images/t/9.jpg", "test/labels/t/9.lines.json"),
    ]
    everything = samples(spark, tmp_path / "b", files, "options: {ingest_unlabeled: true}", read=json_samples, adapter="curvelanes")
    assert everything == unlisted + listed
    assert samples(spark, tmp_path / "c", files, read=json_samples, adapter="curvelanes", splits={"val"}) == listed[-1:]


def test_taxonomy(spark):
    prompt, fields = parse_taxonomy("prompt: pick {a} or {b}\nfields:\n  a: [x, y]\n  b: [z, unknown]\n")
    assert prompt == "pick ['x', 'y'] or ['z', 'unknown']" and fields == {"a": ["x", "y"], "b": ["z", "unknown"]}
    assert prompt_text("{weather}", SCENE_TAXONOMY) == "['clear', 'cloudy', 'rain', 'snow', 'fog', 'unknown']"
    rows = taxonomy_frame(spark).filter(F.col("field") == "timeofday").orderBy("ord").collect()
    assert [(r.value, r.ord) for r in rows] == [("day", 0), ("night", 1), ("dawn_dusk", 2), ("unknown", 3)]


def test_transient_store_errors_are_tried_again():
    from framequarry.sources.store import patiently

    def failing(times, error):
        left = [error] * times

        def request():
            if left:
                raise left.pop()
            return "done"

        return request, left

    request, left = failing(2, OSError("reset by peer"))
    assert patiently(request, (0, 0)) == "done"
    request, left = failing(9, OSError("reset by peer"))
    with pytest.raises(OSError):
        patiently(request, (0, 0))
    assert len(left) == 6
    request, left = failing(9, FileNotFoundError("x"))
    with pytest.raises(FileNotFoundError):
        patiently(request, (0, 0))
    assert len(left) == 8


class _Counting(fs.FileSystemHandler):
    """A store with a copy of its own (or without one) that counts how often objects are opened for reading."""

    def __init__(self, copies=True):
        self.local, self.copies, self.opened = fs.LocalFileSystem(), copies, 0

    def __eq__(self, other):
        return self is other

    def __getattr__(self, name):
        return getattr(self.local, name)

    def copy_file(self, src, dest):
        if not self.copies:
            raise NotImplementedError("no copy")
        self.local.copy_file(src, dest)

    def open_input_stream(self, path):
        self.opened += 1
        return self.local.open_input_stream(path)

    def get_type_name(self):
        return "counting"

    get_file_info = lambda self, paths: self.local.get_file_info(paths)
    get_file_info_selector = lambda self, selector: self.local.get_file_info(selector)
    normalize_path = lambda self, path: path


for _name in ("create_dir", "delete_dir", "delete_dir_contents", "delete_root_dir_contents", "delete_file", "move", "open_input_file", "open_output_stream", "open_append_stream"):
    setattr(_Counting, _name, lambda self, *args, _n=_name, **more: getattr(self.local, _n)(*args, **more))
_Counting.__abstractmethods__ = frozenset()


def test_one_store_copies_by_itself(tmp_path):
    write(tmp_path, {"a": "x" * 100, "b": "old"})
    handler = _Counting()
    store = Store()
    store._opened["file"] = fs.PyFileSystem(handler)
    store.copy(f"{tmp_path}/a", f"{tmp_path}/b")
    assert (tmp_path / "b").read_text() == "x" * 100 and handler.opened == 0
    # Another store, or one without a copy, is read in chunks.
    without = _Counting(copies=False)
    store._opened["file"] = fs.PyFileSystem(without)
    store.copy(f"{tmp_path}/a", f"{tmp_path}/c")
    assert (tmp_path / "c").read_text() == "x" * 100 and without.opened == 1
    other = _Counting()
    store.locate = lambda uri: (fs.PyFileSystem(handler if uri.endswith("a") else other), uri)
    store.copy(f"{tmp_path}/a", f"{tmp_path}/d")
    assert (tmp_path / "d").read_text() == "x" * 100 and (handler.opened, other.opened) == (1, 0)


def test_local_copies_are_whole_or_absent(tmp_path):
    write(tmp_path, {"a": "x"})
    store = Store()
    store.copy(f"{tmp_path}/a", f"{tmp_path}/deep/b")
    assert (tmp_path / "deep/b").read_text() == "x" and [p.name for p in (tmp_path / "deep").iterdir()] == ["b"]
    with pytest.raises(FileNotFoundError):
        store.copy(f"{tmp_path}/missing", f"{tmp_path}/deep/c")
    assert [p.name for p in (tmp_path / "deep").iterdir()] == ["b"]


def test_a_flat_folder_is_listed_by_several_tasks(spark, tmp_path, monkeypatch):
    """200,000 entries in one folder: several partitions share them, each entry once, and nobody makes a list of them."""
    (tmp_path / "deep/flat").mkdir(parents=True)
    for i in range(200_000):
        os.close(os.open(tmp_path / f"deep/flat/frame_{i:06d}.jpg", os.O_CREAT))
    for i in range(0, 200_000, 1000):
        (tmp_path / f"deep/flat/frame_{i:06d}.jpg").write_bytes(b"x")
    (tmp_path / "deep/flat/sub").mkdir()
    (tmp_path / "deep/flat/sub/last").write_bytes(b"yy")

    held = []
    whole = Store.entries

    def counted(self, *args, **more):
        held.append(0)
        place = len(held) - 1
        for entry in whole(self, *args, **more):
            held[place] += 1
            yield entry

    monkeypatch.setattr(Store, "entries", counted)
    parts = LS.ObjectsReader([f"{tmp_path}/deep/"], 12).partitions()
    assert len(parts) == LS.SHARES and max(held) <= LS.LOOKED_AT + 1
    monkeypatch.undo()
    found = spark.read.format("objects").option("prefixes", json.dumps([f"{tmp_path}/deep/"])).option("partitions", "12").load()
    per_task = found.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n")).collect()
    assert len(per_task) == LS.SHARES and max(r.n for r in per_task) < 15_000
    total = found.agg(F.count("*"), F.count_distinct("path"), F.sum("length")).first()
    assert tuple(total) == (200_001, 200_001, 202)


def test_a_tree_is_cut_at_its_folders(spark, tmp_path):
    write(tmp_path, {f"d{i % 7}/e{i % 3}/f{i}": "x" for i in range(60)} | {"top": "", "d0/file": "y"})
    for wanted in (1, 5, 1000):
        parts = LS.ObjectsReader([f"{tmp_path}/"], wanted).partitions()
        got = [r for part in parts for b in LS.ObjectsReader([], 1).read(part) for r in b.to_pylist()]
        assert sorted(r["path"] for r in got) == sorted(str(p) for p in tmp_path.rglob("*") if p.is_file())
        assert len(parts) >= min(wanted, 23)
    assert LS.ObjectsReader([f"{tmp_path}/none/x"], 4).partitions() and list(LS.ObjectsReader([], 1).read(LS.Part(""))) == []
