import posixpath

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from framequarry.functions import paths as P
from framequarry.functions.text import number, words

PATHS = st.lists(st.text(alphabet="ab./_ é1", min_size=1, max_size=12), min_size=1, max_size=60)
FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def columns(spark, values, *expressions):
    df = spark.createDataFrame([(v,) for v in values], "p string").coalesce(1)
    return [tuple(r) for r in df.select(*expressions).collect()]


@FEW
@given(values=PATHS)
def test_stem_and_base_like_posixpath(spark, values):
    got = columns(spark, values, P.stem("p"), P.basename("p"), P.frame_id("p"))
    want = [(posixpath.splitext(v)[0], posixpath.basename(v), posixpath.splitext(posixpath.basename(v))[0]) for v in values]
    assert got == want


@FEW
@given(values=PATHS)
def test_sequence_like_dirname(spark, values):
    relative = [v.lstrip("/") or "x" for v in values]
    assert [r[0] for r in columns(spark, relative, P.sequence_id("p"))] == [posixpath.dirname(v) for v in relative]


@FEW
@given(values=PATHS)
def test_user_paths(spark, values):
    root = "gs://raw"
    uris = [f"{root}/{v}" for v in values] + [f"{root}/u/s/images/x/images/{v}" for v in values]
    got = columns(spark, uris, P.path_user(P.below("p", root)), P.path_session(P.below("p", root)),
                  P.path_frame(P.below("p", root)), P.lines_uri("p"), P.swap_root("p", root, "gs://clean"))
    for uri, row in zip(uris, got):
        head, _, tail = uri[len(root) + 1:].partition("/images/")
        user, _, session = head.partition("/")
        frame = posixpath.splitext(posixpath.basename(tail))[0]
        lines = posixpath.splitext(uri.replace("/images/", "/lines/", 1))[0] + ".lines.json"
        assert row == (user, session, frame, lines, "gs://clean" + uri[len(root):])


def test_uri_split(spark):
    uris = ["gs://b/a/c", "gs://b", "gs://b/", "gs:///a", "s3://b/a", "b/a", "gs://b/a//c"]
    got = columns(spark, uris, P.uri_bucket("p"), P.uri_object("p"))
    assert got == [("b", "a/c"), ("b", ""), ("b", ""), (None, None), (None, None), (None, None), ("b", "a//c")]


def test_categories_and_events(spark):
    lists = ["l/test0_normal.txt", "l/night.txt", "l/test1_.txt", "l/a_b_c.txt"]
    assert [r[0] for r in columns(spark, lists, P.category_name("p"))] == ["normal", "night", "test1_", "b_c"]
    names = ["_descriptors/culane.yml", "x.v2.yml", "_descriptors/.yml", "_descriptors/"]
    assert [r[0] for r in columns(spark, names, P.event_dataset("p"))] == ["culane", "x", None, None]


def test_list_entries(spark):
    lines = ["  //a/b.jpg /c 1", "x", "\t /y.jpg\tz", "a b"]
    assert [r[0] for r in columns(spark, lines, P.list_entry("p"))] == [s.split()[0].lstrip("/") for s in lines]


@FEW
@given(values=st.lists(st.text(alphabet="a \t\x0b\x1c\x85\xa0 　", max_size=10), min_size=1, max_size=40))
def test_words_like_split(spark, values):
    assert [r[0] for r in columns(spark, values, words(F.col("p")))] == [v.split() for v in values]


def test_numbers_like_float(spark):
    texts = ["1", "-1.5", "+.5", "5.", "1e3", "1E-2", "1_000", " 2 ", "inf", "-Infinity", "1f", "1d", "0x1", "1__0", "_1", "", ".", "e5", "1e", "1,5", "abc", "1e999"]

    def value(text):
        try:
            return float(text)
        except ValueError:
            return None

    assert [r[0] for r in columns(spark, texts, number(F.col("p")))] == [value(t) for t in texts]


def test_is_user_image(spark):
    uris = ["gs://b/u/s/images/1.jpg", "gs://b/u/s/images/1.JPEG", "gs://b/u/s/images/1.png", "gs://b/u/s/images/1.txt", "gs://b/images.jpg", "gs://b/u/s/image/1.jpg"]
    assert [r[0] for r in columns(spark, uris, P.is_user_image("p"))] == [True, True, True, False, False, False]
