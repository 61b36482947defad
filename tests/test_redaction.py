import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from conftest import tree, write
from framequarry.functions.boxes import detection_kind
from framequarry.operators.redact import blurred, gaussian_blur, pixmap_codec, redact_batch, redact_contents, sure_boxes
from framequarry.operators.tables import CatalogueTable
from framequarry.plans.redaction import redact_user_images
from framequarry.schemas import IMAGES, USER_IMAGES_PRIVACY

# Stand-in models travel with the job, as executors cannot import test files.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

EPOCH, HOUR = 1700000000, 3600
CODEC = pixmap_codec()


def picture(height=20, width=24, seed=0):
    return np.random.default_rng(seed).integers(0, 255, (height, width, 3), dtype=np.uint8)


def face_detector():
    """One face in every picture, plus things to ignore."""
    return lambda pictures: [[("face", 0.9, 2.0, 2.0, 12.0, 12.0), ("car", 0.9, 0, 0, 24, 20), ("plate", 0.05, 0, 0, 24, 20)] for _ in pictures]


def broken_detector():
    def detect(pictures):
        raise RuntimeError("no model")

    return detect


def test_kinds(spark):
    cases = {"face": "face", "human face": "face", "license-plate": "plate", "number_plate": "plate", "LICENCE": "plate", "car": None, "": None, None: None}
    df = spark.createDataFrame([(c,) for c in cases], "c string").coalesce(1)
    assert [r[0] for r in df.select(detection_kind(F.col("c"))).collect()] == list(cases.values())
    for name, kind in cases.items():
        counts, boxes = sure_boxes([(name, 0.5, 1, 2, 3, 4), (name, 0.05, 0, 0, 9, 9)], 0.1)
        assert counts == {"face": int(kind == "face"), "plate": int(kind == "plate")} and boxes == [(1, 2, 3, 4)] * (kind is not None)
    assert sure_boxes([], 0.1) == ({"face": 0, "plate": 0}, [])


def test_blur_against_brute_force():
    region, kernel, reach = picture(9, 6), 5, 2
    sigma = 0.3 * ((kernel - 1) * 0.5 - 1) + 0.8
    weights = np.array([[np.exp(-(dy * dy + dx * dx) / (2 * sigma * sigma)) for dx in range(-reach, reach + 1)] for dy in range(-reach, reach + 1)])
    weights /= weights.sum()

    def mirrored(i, n):
        while not 0 <= i < n:
            i = -i if i < 0 else 2 * (n - 1) - i
        return i

    want = np.zeros(region.shape)
    for y in range(9):
        for x in range(6):
            for dy in range(-reach, reach + 1):
                for dx in range(-reach, reach + 1):
                    want[y, x] += weights[dy + reach, dx + reach] * region[mirrored(y + dy, 9), mirrored(x + dx, 6)]
    assert np.abs(gaussian_blur(region, kernel).astype(float) - want).max() <= 0.5 + 1e-9


def test_blur_changes_only_the_box():
    img = picture(100, 100)
    out = blurred(img, [(10, 10, 40, 40)], 31)
    assert out.shape == img.shape and out is not img
    outside = np.ones((100, 100), bool)
    outside[10:40, 10:40] = False
    assert (out[outside] == img[outside]).all() and (out[~outside] != img[~outside]).any()
    assert (blurred(img, [(10, 10, 40, 40)], 30) == out).all()


@pytest.mark.parametrize("box", [(-50, -50, -1, 5), (200, 0, 300, 5), (5, 5, 5, 9), (6, 6, 5, 9)])
def test_empty_boxes_change_nothing(box):
    assert (blurred(picture(), [box]) == picture()).all()


@pytest.mark.parametrize("box", [(0, 0, 1, 20), (3, 3, 4, 4), (-5, -5, 100, 100)])
def test_thin_and_oversize_boxes(box):
    assert blurred(picture(), [box]).shape == picture().shape


def test_codec():
    img = picture()
    assert (CODEC.decode(CODEC.encode(img)) == img).all()
    assert CODEC.decode(b"junk") is None and CODEC.decode(CODEC.encode(img)[:-1]) is None and CODEC.decode(b"") is None


def test_batch_results():
    good = CODEC.encode(picture())
    results = redact_batch([good, b"junk", None], face_detector(), CODEC, 0.1, 31)
    assert [r["error"] for r in results] == [None, "image: not readable", "image: not readable"]
    assert (results[0]["faces"], results[0]["plates"], results[0]["width"], results[0]["height"]) == (1, 0, 24, 20)
    assert (CODEC.decode(results[0]["clean"]) == blurred(picture(), [(2, 2, 12, 12)])).all()
    failed = redact_batch([good, b"junk"], broken_detector(), CODEC, 0.1, 31)
    assert failed[0]["error"].startswith("detector") and failed[1]["error"] == "image: not readable"
    # Counted before clamping: a box outside the picture still counts.
    outside = redact_batch([good], lambda ps: [[("plate", 0.5, -9, -9, -1, -1)]], CODEC, 0.1, 31)
    assert outside[0]["plates"] == 1 and outside[0]["clean"] == good


def test_contents_in_a_column(spark):
    rows = [(i, CODEC.encode(picture(seed=i)) if i % 5 else b"junk") for i in range(40)]
    df = spark.createDataFrame(rows, "i long, data binary")
    got = {r.i: r for r in redact_contents(df, "data", face_detector, CODEC, batch=3).collect()}
    for i, data in rows:
        assert (got[i].error is None) == (i % 5 != 0)
        if i % 5:
            assert (CODEC.decode(bytes(got[i].clean)) == blurred(picture(seed=i), [(2, 2, 12, 12)])).all()


def user_tree(lake):
    write(lake.raw_user, {
        "usr_a/20260314T0830Z__usr_a__01/images/1.jpg": CODEC.encode(picture()), "usr_a/20260314T0830Z__usr_a__01/images/2.PNG": CODEC.encode(picture(8, 8)),
        "usr_a/20260314T0830Z__usr_a__01/lines/1.lines.json": '{"a": 1}', "usr_a/20260314T0830Z__usr_a__01/images/note.txt": "no image",
        "usr_b/s2/images/1.jpeg": CODEC.encode(picture()), "usr_b/s2/meta.json": '{"captured_at": "x", "start": "2026-01-02T03:04:05+01:00"}',
        "usr_b/s2/images/9.jpg": "broken", "usr_b/s2/other.jpg": "outside",
    })


def tables(spark, lake):
    return [CatalogueTable(spark, lake.table_path(s.name), s).read() for s in (USER_IMAGES_PRIVACY, IMAGES)]


def test_run(spark, lake):
    user_tree(lake)
    run = redact_user_images(spark, lake, face_detector, CODEC, "d-v1", EPOCH, slices=2)
    row = run.summary.first()
    assert (row.candidates, row.processed, row.anonymized, row.faces_blurred, row.plates_blurred, row.failed, row.exit_code) == (4, 4, 3, 3, 0, 1, 1)
    clean = tree(lake.clean_user)
    assert sorted(clean) == sorted([
        "usr_a/20260314T0830Z__usr_a__01/images/1.jpg", "usr_a/20260314T0830Z__usr_a__01/images/2.PNG",
        "usr_a/20260314T0830Z__usr_a__01/lines/1.lines.json", "usr_b/s2/images/1.jpeg"])
    assert clean["usr_a/20260314T0830Z__usr_a__01/lines/1.lines.json"] == b'{"a": 1}'
    assert (CODEC.decode(clean["usr_b/s2/images/1.jpeg"]) == blurred(picture(), [(2, 2, 12, 12)])).all()
    audit, images = tables(spark, lake)
    assert {r.image_id: (r.faces_blurred, r.model_version) for r in audit.collect()} == {
        "user/usr_a/20260314T0830Z__usr_a__01/images/1": (1, "d-v1"), "user/usr_a/20260314T0830Z__usr_a__01/images/2": (1, "d-v1"), "user/usr_b/s2/images/1": (1, "d-v1")}
    times = {r.frame_id + r.user_id: (r.t, r.sequence_id, r.source, r.dataset, r.split, r.width) for r in images.withColumn("t", F.date_format("captured_at", "yyyy-MM-dd HH:mm:ss")).collect()}
    assert times == {
        "1usr_a": ("2026-03-14 08:30:00", "20260314T0830Z__usr_a__01", "user", "user", None, 24),
        "2usr_a": ("2026-03-14 08:30:00", "20260314T0830Z__usr_a__01", "user", "user", None, 8),
        "1usr_b": ("2026-01-02 02:04:05", "s2", "user", "user", None, 24)}


def test_reruns(spark, lake):
    user_tree(lake)
    redact_user_images(spark, lake, face_detector, CODEC, "d-v1", EPOCH)
    before = [sorted(map(str, t.collect())) for t in tables(spark, lake)]
    again = redact_user_images(spark, lake, face_detector, CODEC, "d-v1", EPOCH + 48 * HOUR).summary.first()
    assert (again.candidates, again.failed) == (1, 1)
    assert [sorted(map(str, t.collect())) for t in tables(spark, lake)] == before
    assert redact_user_images(spark, lake, face_detector, CODEC, "d-v1", EPOCH + 48 * HOUR + 1).summary.first().candidates == 4


def test_dry_run_and_limit(spark, lake):
    user_tree(lake)
    run = redact_user_images(spark, lake, face_detector, CODEC, "d-v1", EPOCH, dry_run=True, limit=2).summary.first()
    assert run.candidates == 2 and run.anonymized <= run.processed == 2
    assert tree(lake.clean_user) == {} and tree(lake.tables) == {}


def test_failing_model_fails_rows_not_the_run(spark, lake):
    user_tree(lake)
    run = redact_user_images(spark, lake, broken_detector, CODEC, "d-v1", EPOCH)
    row = run.summary.first()
    assert (row.candidates, row.anonymized, row.failed) == (4, 0, 4)
    assert tree(lake.tables) == {}


def test_a_failing_picture_costs_its_own_row():
    import numpy as np

    from framequarry.operators.redact import Codec, pixmap_codec, redact_batch

    plain = pixmap_codec()
    data = plain.encode(np.zeros((4, 4, 3), np.uint8))
    boxes = iter([[("face", 0.9, float("nan"), 0, 2, 2)], [("face", 0.9, 0, 0, 2, 2)], []])
    found = redact_batch([data, data, OSError("no route"), data], lambda ps: [next(boxes) for _ in ps], plain, 0.1, 3)
    assert found[0]["error"].startswith("redaction:") and found[1]["error"] is None and found[1]["faces"] == 1
    assert "no route" in found[2]["error"] and found[3]["error"] is None
    short = redact_batch([data, data], lambda ps: [[]], plain, 0.1, 3)
    assert all(r["error"] == "detector: 1 answers for 2 pictures" for r in short)
    wrong = redact_batch([data], lambda ps: [[]], Codec(plain.decode, lambda p: "text"), 0.1, 3)
    assert "not bytes" in wrong[0]["error"]


def test_progress_of_a_redaction(spark, lake):
    user_tree(lake)
    told = []
    row = redact_user_images(spark, lake, face_detector, CODEC, "d-v1", EPOCH, slices=3, progress=told.append).summary.first()
    assert len(told) == 3 and (told[-1]["candidates"], told[-1]["ok"], told[-1]["failed"]) == (row.candidates, row.anonymized, row.failed)
