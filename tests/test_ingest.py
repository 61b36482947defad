from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import tree, write
from framequarry.operators.tables import CatalogueTable, key_collisions
from framequarry.plans.ingest import ingest
from framequarry.schemas import IMAGES, SOURCE_DATASETS

EPOCH = 1700000000


def list_dataset(lake, options=""):
    write(lake.raw_public, {
        "_descriptors/set1.yml": f"dataset: roads\nversion: 2018\nlicense: research\nadapter: culane\nsource_url: http://x\nnotes: n\n{options}",
        "set1/list/train.txt": "/d1/c/1.jpg /s.png\nd1/c/2.jpg\nd1/c/3.jpg\n",
        "set1/list/val.txt": "d2/1.jpg\n",
        "set1/list/test_split/test0_normal.txt": "d3/1.jpg\n",
        "set1/list/test_split/test1_night.txt": "d3/1.jpg\n",
        "set1/d1/c/1.jpg": "one", "set1/d1/c/1.lines.txt": "1.5 2.5 3 4 5\r\n1 2 3\n10 20 30 40\n",
        "set1/d1/c/2.jpg": "two", "set1/d1/c/2.lines.txt": "",
        "set1/d1/c/3.jpg": "three",
        "set1/d2/1.jpg": "four", "set1/d2/1.lines.txt": "1 2 x 4",
        "set1/d3/1.jpg": "five", "set1/d3/1.lines.txt": "0.5 0.5 1 1",
    })


def table(spark, lake, spec):
    return CatalogueTable(spark, lake.table_path(spec.name), spec).read()


def summary(run):
    row = run.summary.first()
    return (row.num_images, row.written, row.reused, row.unlabeled, row.skipped_no_label, row.failed, row.splits, row.exit_code)


def manifest(lake, name):
    parts = sorted((n, c) for n, c in tree(f"{lake.public}/{name}").items())
    return b"".join(c for _, c in parts).decode()


def test_list_dataset(spark, lake):
    list_dataset(lake)
    run = ingest(spark, lake, "set1", EPOCH)
    assert summary(run) == (4, 4, 0, 0, 1, 1, ["test", "train"], 1)
    errors = {r.rel_path: r.error for r in run.outcome.filter("status = 'error'").collect()}
    assert errors == {"d2/1.jpg": "label: not a number"}

    files = tree(lake.public)
    assert files["set1/train/images/d1/c/1.jpg"] == b"one" and files["set1/test/night/images/d3/1.jpg"] == b"five"
    assert files["set1/train/label/d1/c/1.lines.json"].decode() == (
        '{"timestamp": 1700000000,\n"Lines": [\n[{"x": 2, "y": 2}, {"x": 3, "y": 4}],\n[{"x": 10, "y": 20}, {"x": 30, "y": 40}]\n]}'
    )
    assert files["set1/train/label/d1/c/2.lines.json"].decode() == '{"timestamp": 1700000000,\n"Lines": [\n\n]}'
    assert not any("c/3" in n or "/val/" in n for n in files)
    assert manifest(lake, "set1/train/train.txt") == "train/images/d1/c/1.jpg\ntrain/images/d1/c/2.jpg\n"
    assert manifest(lake, "set1/test/night/night.txt") == "test/night/images/d3/1.jpg\n"

    rows = {r.image_id: r for r in table(spark, lake, IMAGES).collect()}
    # One image of two categories has one key: the first output path wins.
    assert sorted(rows) == ["roads/d1/c/1", "roads/d1/c/2", "roads/d3/1"]
    one = rows["roads/d1/c/1"]
    assert (one.source, one.dataset, one.split, one.width, one.height, one.frame_id, one.sequence_id, one.user_id, one.captured_at) == (
        "public", "roads", "train", 1640, 590, "1", "d1/c", None, None)
    assert rows["roads/d3/1"].gcs_uri == f"{lake.public}/set1/test/night/images/d3/1.jpg"
    ok = run.outcome.filter("status = 'ok'")
    assert [tuple(r) for r in key_collisions(ok, ["image_id"]).collect()] == [("roads/d3/1", 2)]

    version = table(spark, lake, SOURCE_DATASETS).withColumn("at", F.unix_seconds("normalized_at")).collect()
    assert [(v.dataset, v.version, v.license, v.num_images, v.gcs_prefix, v.notes, v.at) for v in version] == [
        ("set1", "2018", "research", 4, f"{lake.public}/set1", "http://x | n", EPOCH)]


def test_rerun_changes_nothing_but_the_time(spark, lake):
    list_dataset(lake)
    ingest(spark, lake, "set1", EPOCH)
    files, rows = tree(lake.public), table(spark, lake, IMAGES).drop("ingested_at").orderBy("image_id").collect()
    run = ingest(spark, lake, "set1", EPOCH + 60)
    assert summary(run) == (4, 0, 4, 0, 1, 1, ["test", "train"], 1)
    assert tree(lake.public) == files
    again = table(spark, lake, IMAGES)
    assert again.drop("ingested_at").orderBy("image_id").collect() == rows
    assert {r[0] for r in again.select(F.unix_seconds("ingested_at")).collect()} == {EPOCH + 60}


def test_lost_label_is_made_good(spark, lake):
    list_dataset(lake)
    ingest(spark, lake, "set1", EPOCH)
    from pathlib import Path

    label = Path(lake.public) / "set1/train/label/d1/c/1.lines.json"
    text = label.read_bytes()
    label.unlink()
    ingest(spark, lake, "set1", EPOCH)
    assert label.read_bytes() == text


def test_manifest_keeps_old_lines(spark, lake):
    list_dataset(lake)
    write(lake.public, {"set1/train/train.txt": "train/images/old.jpg\n\n"})
    ingest(spark, lake, "set1", EPOCH)
    assert manifest(lake, "set1/train/train.txt") == "train/images/d1/c/1.jpg\ntrain/images/d1/c/2.jpg\ntrain/images/old.jpg\n"


def test_overwrite_replaces_all(spark, lake):
    list_dataset(lake, "options: {overwrite: true}")
    write(lake.public, {"set1/train/train.txt": "train/images/old.jpg\n", "set1/train/images/d1/c/1.jpg": "stale"})
    run = ingest(spark, lake, "set1", EPOCH)
    assert summary(run)[:3] == (4, 4, 0)
    assert tree(lake.public)["set1/train/images/d1/c/1.jpg"] == b"one"
    assert manifest(lake, "set1/train/train.txt") == "train/images/d1/c/1.jpg\ntrain/images/d1/c/2.jpg\n"


def test_missing_labels_fail_or_are_taken(spark, lake):
    list_dataset(lake, "options: {skip_missing_labels: false}")
    run = ingest(spark, lake, "set1", EPOCH, dry_run=True)
    errors = {r.rel_path: r.error for r in run.outcome.filter("status = 'error'").collect()}
    assert errors == {"d2/1.jpg": "label: not a number", "d1/c/3.jpg": "image without label"}
    list_dataset(lake, "options: {ingest_unlabeled: true}")
    assert summary(ingest(spark, lake, "set1", EPOCH)) == (5, 5, 0, 1, 0, 1, ["test", "train"], 1)
    assert "set1/train/images/d1/c/3.jpg" in tree(lake.public)


def test_dry_run_writes_nothing(spark, lake):
    list_dataset(lake)
    run = ingest(spark, lake, "set1", EPOCH, dry_run=True, limit=5)
    assert summary(run)[0] <= 5 and run.outcome.count() == 5
    from pathlib import Path

    assert not Path(lake.public).exists() and not Path(lake.tables).exists()


def test_image_that_cannot_be_copied_fails_its_row(spark, lake):
    list_dataset(lake)
    from pathlib import Path

    (Path(lake.raw_public) / "set1/d1/c/1.jpg").unlink()
    # The layout probe looks for the first listed image, so a missing one must not change the others.
    run = ingest(spark, lake, "set1", EPOCH)
    assert summary(run)[:6] == (3, 3, 0, 0, 1, 2)
    assert "FileNotFound" in run.outcome.filter("rel_path = 'd1/c/1.jpg'").first().error


def test_json_dataset(spark, lake):
    write(lake.raw_public, {
        "_descriptors/curves.yml": "adapter: curvelanes\noptions: {ingest_unlabeled: true}",
        "curves/train/train.txt": "images/a/1.jpg\nimages/b c/2.jpg\n", "curves/valid/valid.txt": "images/a/1.jpg\n",
        "curves/train/images/a/1.jpg": "t1", "curves/train/images/b c/2.jpg": "t2", "curves/valid/images/a/1.jpg": "v1", "curves/test/images/z.jpg": "z",
        "curves/train/labels/a/1.lines.json": '{"Lines": [[{"x": "0.5", "y": "1.5"}], []]}', "curves/train/labels/b c/2.lines.json": "{bad",
        "curves/valid/labels/a/1.lines.json": "{}",
    })
    run = ingest(spark, lake, "curves", EPOCH)
    assert summary(run) == (3, 3, 0, 1, 0, 1, ["test", "train", "val"], 1)
    files = tree(lake.public)
    assert files["curves/train/label/a/1.lines.json"].decode() == '{"timestamp": 1700000000,\n"Lines": [\n[{"x": 0, "y": 2}]\n]}'
    assert files["curves/val/images/a/1.jpg"] == b"v1" and "curves/test/label/z.lines.json" not in files
    rows = {r.image_id: (r.split, r.width) for r in table(spark, lake, IMAGES).collect()}
    # The key has no split, so train and val collide and train comes first.
    assert rows == {"curvelanes/a/1": ("train", None), "curvelanes/z": ("test", None)}
    assert [v.version for v in table(spark, lake, SOURCE_DATASETS).collect()] == [""]


def test_unusable_descriptors_raise(spark, lake):
    write(lake.raw_public, {"_descriptors/a.yml": "dataset: a", "_descriptors/b.yml": "adapter: kitti"})
    for name, message in (("a", "adapter"), ("b", "unknown adapter"), ("c", "FileNotFound")):
        with pytest.raises(ValueError, match=message):
            ingest(spark, lake, name, EPOCH)


def test_nothing_usable_writes_no_rows(spark, lake):
    write(lake.raw_public, {"_descriptors/a.yml": "adapter: culane", "a/list/train.txt": "x.jpg"})
    assert summary(ingest(spark, lake, "a", EPOCH)) == (0, 0, 0, 0, 1, 0, [], 0)
    from pathlib import Path

    assert not Path(lake.tables).exists()


def test_an_unchanged_rerun_reads_no_old_line(spark, lake, monkeypatch):
    from framequarry.operators import manifests as M

    list_dataset(lake)
    ingest(spark, lake, "set1", EPOCH)
    name = "set1/train/train.txt"
    before = {p.name: p.stat().st_mtime_ns for p in Path(lake.public, name).iterdir()}
    asked, reads = [], M.read_manifests
    monkeypatch.setattr(M, "read_manifests", lambda spark, root, names: asked.append(names) or reads(spark, root, names))
    ingest(spark, lake, "set1", EPOCH + 1)
    assert asked == [] and {p.name: p.stat().st_mtime_ns for p in Path(lake.public, name).iterdir()} == before
    # A manifest that somebody else changed, or whose fingerprint is gone, is read again.
    write(lake.public, {f"{name}/part-other.txt": "train/images/other.jpg\n"})
    ingest(spark, lake, "set1", EPOCH + 2)
    assert asked == [["train/train.txt"]] and "train/images/other.jpg" in manifest(lake, name)
    ingest(spark, lake, "set1", EPOCH + 3)
    assert len(asked) == 1
    next(Path(lake.public, "set1/train").glob(".train.txt.fingerprint")).unlink()
    ingest(spark, lake, "set1", EPOCH + 4)
    assert asked[1:] == [["train/train.txt"]] and "train/images/other.jpg" in manifest(lake, name)


def test_fingerprints_know_no_order_and_every_line(spark):
    from framequarry.operators import manifests as M

    def of(rows, parts=1):
        return M.fingerprints(spark.createDataFrame(rows, "txt_rel string, path string").repartition(parts))

    rows = [("a", f"p{i}") for i in range(500)] + [("b", "p1")]
    assert of(rows) == of(rows[::-1], 7) and of(rows).keys() == {"a", "b"}
    assert of(rows)["a"] != of(rows[1:])["a"] != of([("a", "x"), *rows[1:]])["a"] and of(rows)["b"] == of([("b", "p1")])["b"]
    assert of([]) == {}


def test_a_list_that_cannot_be_read_aborts_but_records(spark, lake):
    write(lake.raw_public, {
        "_descriptors/c.yml": "adapter: curvelanes\noptions: {ingest_unlabeled: true}", "c/train/train.txt": b"images/\xff.jpg\n", "c/valid/valid.txt": "images/1.jpg\n",
        "c/valid/images/1.jpg": "x", "c/train/images/2.jpg": "y",
    })
    run = ingest(spark, lake, "c", EPOCH)
    row = run.summary.first()
    assert (row.num_images, row.failed, row.aborted, row.exit_code) == (1, 0, True, 1) and list(run.unreadable) == [f"{lake.raw_public}/c/train/train.txt"]
    write(lake.raw_public, {"c/train/train.txt": "images/2.jpg\n"})
    row = ingest(spark, lake, "c", EPOCH).summary.first()
    assert (row.num_images, row.reused, row.aborted, row.exit_code) == (2, 1, False, 0)
