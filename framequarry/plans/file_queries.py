"""Queries over objects. The trees are written by Spark from the tables, one object per row, into the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..config import Layout
from ..functions import paths as P
from ..operators import pending as PD
from ..operators.object_io import copy_objects, label_carry_over, remove_objects, write_objects
from ..plans.ingest import ingest
from ..plans.labelling import label_images
from ..plans.redaction import raw_frames, redact_user_images
from ..operators.redact import pixmap_codec, redact_contents
from ..operators.tables import CatalogueTable
from ..schemas import CLASSIFICATIONS, IMAGES, SOURCE_DATASETS, USER_IMAGES_PRIVACY
from ..session import shared_dir, small_frame, spread, stage, staged_within
from ..sources.descriptors import first_valid, read_descriptor, scan_descriptors
from ..sources.formats import LABEL_PLACES, json_samples, list_samples
from ..sources.objects import list_objects, read_objects, user_images
from ..sources.sessions import session_starts, with_session_start
from .registry import query, table

EPOCH = 1700000000


def put(objects: DataFrame, rows: int | None = None) -> None:
    """Write (uri, data) rows and fail loudly. Small ones are dealt out by their number, given in `rows`."""
    objects = objects.select("uri", "data")
    written = write_objects(objects if rows is None else spread(objects, rows, "uri"), "uri", "data", without=("data",))
    _carry_out(written, "put")


def remove_tree(spark, root: str) -> None:
    """Remove a tree that is read no more: its objects by tasks sized by rows, as it was written, then its folders."""
    with staged_within(spark):
        found = list_objects(spark, f"{root}/").select("path")
        _carry_out(remove_objects(spread(found, found.count(), "path"), "path"), "removed")
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def _carry_out(acted: DataFrame, purpose: str) -> None:
    failed = stage(acted.filter("write_error IS NOT NULL"), purpose)
    if not failed.isEmpty():
        raise OSError(failed.first().write_error)


def _id():
    return F.col("doc_id").cast("string")


def _uri(root: str, *names):
    return F.concat_ws("/", F.lit(root), *names)


def _document_tree(spark, sf, root: str) -> DataFrame:
    """Documents as text objects; of every seven ids one is an empty object, and one is not written."""
    docs = table(spark, sf, "documents").select(
        "doc_id", "lang", _uri(root, "lang", "source", F.concat(_id(), F.lit(".txt"))).alias("uri"),
        F.when(F.col("doc_id") % 7 != 3, F.col("text")).otherwise("").alias("data"),
    )
    put(docs.filter("doc_id % 7 <> 5"))
    return docs


def _names(docs: DataFrame) -> DataFrame:
    return spread(docs.select("doc_id", "uri"), docs.count(), "doc_id")


def _read(named: DataFrame, uri: str) -> DataFrame:
    """Contents of the objects that rows of a table or a listing name, read by tasks sized by rows."""
    return read_objects(spread(named, named.count(), uri), uri)


@query("object_listing", """
SELECT lang || '/' || source || '/' || doc_id || '.txt' AS name, CASE doc_id % 7 WHEN 3 THEN 0 ELSE CAST(strlen(text) AS BIGINT) END AS length
FROM documents WHERE lang IN ('en', 'es') AND doc_id % 7 <> 5""")
def object_listing(spark, sf):
    """Prefix `e` finds two folders, the other prefix none."""
    root = shared_dir(spark, "objects")
    _document_tree(spark, sf, root)
    found = list_objects(spark, f"{root}/e", f"{root}/nothing/here")
    return found.select(P.below("path", root).alias("name"), "length")


@query("empty_objects", "SELECT count(*) AS objects, count(*) FILTER (WHERE doc_id % 7 = 3 OR text = '') AS empty FROM documents WHERE doc_id % 7 <> 5")
def empty_objects(spark, sf):
    root = shared_dir(spark, "objects")
    _document_tree(spark, sf, root)
    return list_objects(spark, f"{root}/").agg(F.count("*").alias("objects"), F.count_if(F.col("length") == 0).alias("empty"))


@query("image_listing", """
SELECT source || '/s/images/' || doc_id || CASE lang WHEN 'en' THEN '.jpg' WHEN 'de' THEN '.PNG' ELSE '.Jpeg' END AS name FROM documents WHERE lang IN ('en', 'de', 'fr')""")
def image_listing(spark, sf):
    """Images by folder and suffix; Spanish documents are notes or lie outside an image folder."""
    root = shared_dir(spark, "objects")
    lang = F.col("lang")
    suffix = F.when(lang == "en", ".jpg").when(lang == "de", ".PNG").when(lang == "fr", ".Jpeg").otherwise(F.when(F.col("doc_id") % 2 == 0, ".txt").otherwise(".jpg"))
    folder = F.when((lang == "es") & (F.col("doc_id") % 2 == 1), "s/imagery").otherwise("s/images")
    put(table(spark, sf, "documents").select(_uri(root, "source", folder, F.concat(_id(), suffix)).alias("uri"), _id().alias("data")))
    return user_images(list_objects(spark, f"{root}/")).select(P.below("path", root).alias("name"))


@query("binary_reads", """
SELECT doc_id, doc_id % 7 <> 5 AS found, CASE doc_id % 7 WHEN 5 THEN NULL WHEN 3 THEN md5('') ELSE md5(text) END AS digest, CAST(NULL AS VARCHAR) AS read_error FROM documents""")
def binary_reads(spark, sf):
    docs = _names(_document_tree(spark, sf, shared_dir(spark, "objects")))
    return read_objects(docs, "uri").select("doc_id", "found", F.md5("content").alias("digest"), "read_error")


@query("text_reads", """
SELECT doc_id, doc_id % 7 <> 5 AS found, CASE doc_id % 7 WHEN 5 THEN NULL WHEN 3 THEN 0 ELSE CAST(length(text) AS INTEGER) END AS n_chars FROM documents""")
def text_reads(spark, sf):
    docs = _names(_document_tree(spark, sf, shared_dir(spark, "objects")))
    return read_objects(docs, "uri", as_text=True).select("doc_id", "found", F.length("content").alias("n_chars"))


@query("object_copies", """
SELECT doc_id, doc_id % 7 = 5 AS failed, CASE doc_id % 7 WHEN 5 THEN NULL WHEN 3 THEN md5('') ELSE md5(text) END AS digest FROM documents""")
def object_copies(spark, sf):
    """Every object copied to a second tree and read back; a missing source fails its row only."""
    root = shared_dir(spark, "objects")
    docs = _names(_document_tree(spark, sf, f"{root}/a")).withColumn("copy", P.swap_root("uri", f"{root}/a", f"{root}/b"))
    copied = stage(copy_objects(docs, "uri", "copy").drop("uri"), "copies")
    return _read(copied, "copy").select("doc_id", F.col("write_error").isNotNull().alias("failed"), F.md5("content").alias("digest"))


@query("descriptor_scan", """
WITH s AS (SELECT DISTINCT source, CAST(substr(source, 4) AS INTEGER) AS n FROM documents)
SELECT source AS run_dataset, CASE n % 5 WHEN 0 THEN 'error' WHEN 1 THEN 'error' ELSE 'ok' END AS status,
       CASE WHEN n % 5 > 1 THEN 'ds-' || source END AS dataset, CASE WHEN n % 5 > 1 THEN CAST(n AS VARCHAR) END AS version,
       CASE WHEN n % 5 > 1 THEN 'culane' END AS adapter, CASE WHEN n % 5 > 1 THEN n % 5 = 2 END AS overwrite,
       CASE WHEN n % 5 > 1 THEN n % 5 <> 3 END AS skip_missing_labels, CASE WHEN n % 5 > 1 THEN false END AS ingest_unlabeled,
       CASE WHEN n % 5 > 1 THEN '.jpg' END AS image_ext, CASE WHEN n % 5 = 4 THEN 'my/lists' END AS list_dir FROM s""")
def descriptor_scan(spark, sf):
    """A descriptor per source: broken, without adapter, or with one option or another set."""
    root = shared_dir(spark, "descriptors")
    _put_descriptors(spark, sf, root)
    found = scan_descriptors(spark, root)
    return found.select(
        "run_dataset", F.when(F.col("error").isNull(), "ok").otherwise("error").alias("status"), "dataset", "version", "adapter",
        "overwrite", "skip_missing_labels", "ingest_unlabeled", "image_ext", "list_dir",
    )


def _put_descriptors(spark, sf, root: str) -> None:
    kind = F.substring("source", 4, 9).cast("int")
    option = F.when(kind % 5 == 2, "options:\n  overwrite: true\n").when(kind % 5 == 3, "options: {skip_missing_labels: false}\n").otherwise("options:\n  list_dir: my/lists\n")
    whole = F.concat(F.lit("dataset: ds-"), "source", F.lit("\nversion: "), kind.cast("string"), F.lit("\nadapter: culane\n"), option)
    text = F.when(kind % 5 == 0, "a: [1\n").when(kind % 5 == 1, "dataset: x\n").otherwise(whole)
    sources = table(spark, sf, "documents").select("source").distinct()
    put(sources.select(_uri(root, F.concat("source", F.lit(".yml"))).alias("uri"), text.alias("data")))
    put(small_frame(spark, [(f"{root}/default.yml", "adapter: ''\n")], "uri string, data string"))


@query("first_valid_descriptor", """
SELECT min(source) AS run_dataset FROM documents WHERE CAST(substr(source, 4) AS INTEGER) % 5 > 1""")
def first_valid_descriptor(spark, sf):
    root = shared_dir(spark, "descriptors")
    _put_descriptors(spark, sf, root)
    return first_valid(scan_descriptors(spark, root)).select("run_dataset")


# --- a list-file dataset: English in train, German in val, French and Spanish in two test categories ---

_REL_SQL = "'drv_' || source || '/' || lang || '.MP4/' || doc_id || '.jpg'"
_SPLIT_SQL = "CASE lang WHEN 'en' THEN 'train' WHEN 'de' THEN 'val' ELSE 'test' END"
_CATEGORY_SQL = "CASE lang WHEN 'fr' THEN 'normal' WHEN 'es' THEN 'night' END"


def _list_dataset(spark, sf, layout: Layout, dataset: str, named: str = "roads", toxic: str = "1 2 three 4", twice: bool = False, place: str | None = None) -> None:
    """Lists, image folders and splits are found by probing; the label folder is named, as the first listed
    image need not have a label. Images are the documents' texts, nested under their driver; labels go by the labels table: broken
    (toxic), empty (quality 0), lanes (quality 1), none (not in the table). With `twice`, val lists the train images too.
    With a `place` the labels lie there, the first listed image has one, and the descriptor does not say where."""
    root = f"{layout.raw_public}/{dataset}"
    docs = table(spark, sf, "documents").select(
        "*", F.concat(F.lit("drv_"), "source").alias("driver"),
        F.concat(F.lit("drv_"), "source", F.lit("/"), "lang", F.lit(".MP4/"), _id(), F.lit(".jpg")).alias("rel"),
    )
    put(docs.select(_uri(root, "driver", "rel").alias("uri"), F.col("text").alias("data")))
    lanes = F.format_string("%d.5 %d 3.5 -0.5 9\r\n1 2 3\n10 20 %d.5 40\n", F.col("n_chars"), F.col("doc_id"), F.col("doc_id"))
    label = F.when(F.col("toxic") == 1, toxic).when(F.col("quality") == 0, "").otherwise(lanes)
    told = table(spark, sf, "labels")
    put(docs.join(told, "doc_id").select(P.native_label_uri(F.lit(root), "rel", F.lit(place or "annotations_new")).alias("uri"), label.alias("data")), told.count())
    if place:
        # Sorted into ranges, whose parts in name order are the list.
        docs = docs.select("doc_id", "lang", "rel").join(told.select("doc_id", F.lit(0).alias("last")), "doc_id", "left").orderBy(F.coalesce("last", F.lit(1)), "doc_id")
    lists = f"{root}/list/list"
    line = F.concat(F.lit("/"), "rel", F.lit(" /seg.png 1 0"))
    for lang, name in (("en", "train.txt"), ("de", "val.txt"), ("fr", "test_split/test0_normal.txt"), ("es", "test_split/night.txt")):
        listed = F.col("lang").isin("en", "de") if twice and lang == "de" else F.col("lang") == lang
        docs.filter(listed).select(F.explode(F.array(line, F.lit("  "))).alias("value")).write.text(f"{lists}/{name}")
    if place:
        _put_descriptor(spark, layout, dataset, f"dataset: {named}\nadapter: culane\n")
    else:
        _list_descriptor(spark, layout, dataset, named)


def _list_descriptor(spark, layout: Layout, dataset: str, named: str) -> None:
    _put_descriptor(spark, layout, dataset, f"dataset: {named}\nversion: 2.0\nlicense: research\nadapter: culane\nsource_url: http://x\noptions: {{label_dir: annotations_new}}\n")


def _put_descriptor(spark, layout: Layout, dataset: str, text: str) -> None:
    put(small_frame(spark, [(f"{layout.descriptors_root}/{dataset}.yml", text)], "uri string, data string"))


def _layout(spark) -> Layout:
    base = shared_dir(spark, "lake")
    return Layout(*[f"{base}/{n}" for n in ("raw-public", "public", "raw-user", "user", "tables")])


@query("list_samples", f"""
SELECT 'roads' AS dataset, {_SPLIT_SQL} AS split, {_CATEGORY_SQL} AS category, {_REL_SQL} AS rel_path,
       'drv_' || source || '/' || {_REL_SQL} AS image_path, 'annotations_new/drv_' || source || '/' || lang || '.MP4/' || doc_id || '.lines.txt' AS label_path,
       CAST(1640 AS BIGINT) AS width, 'roads/drv_' || source || '/' || lang || '.MP4/' || doc_id AS image_id, CAST(doc_id AS VARCHAR) AS frame_id,
       'drv_' || source || '/' || lang || '.MP4' AS sequence_id
FROM documents""")
def list_sample_scan(spark, sf):
    layout = _layout(spark)
    _list_dataset(spark, sf, layout, "roads")
    return _sample_columns(list_samples(spark, read_descriptor(spark, layout.descriptors_root, "roads"), f"{layout.raw_public}/roads"), f"{layout.raw_public}/roads")


@query("list_label_places", f"""
SELECT place, CASE place WHEN 'alongside' THEN '' WHEN 'nested' THEN 'drv_' || source || '/' ELSE 'annotations_new/' END
  || 'drv_' || source || '/' || lang || '.MP4/' || doc_id || '.lines.txt' AS label_path, {_SPLIT_SQL} AS split
FROM documents, (VALUES ('alongside'), ('nested'), ('annotations_new')) p(place)""")
def list_label_places(spark, sf):
    """Where labels lie is found from the first listed image, for each of the three places."""
    frames = []
    for place in LABEL_PLACES:
        layout = _layout(spark)
        _list_dataset(spark, sf, layout, "roads", place=place)
        root = f"{layout.raw_public}/roads"
        samples = list_samples(spark, read_descriptor(spark, layout.descriptors_root, "roads"), root)
        frames.append(samples.select(F.lit(place).alias("place"), P.below("label_uri", root).alias("label_path"), "split"))
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query("list_samples_of_splits", f"SELECT {_SPLIT_SQL} AS split, {_CATEGORY_SQL} AS category, count(*) AS rows FROM documents WHERE lang <> 'en' GROUP BY ALL")
def list_samples_of_splits(spark, sf):
    layout = _layout(spark)
    _list_dataset(spark, sf, layout, "roads")
    descriptor = read_descriptor(spark, layout.descriptors_root, "roads")
    samples = list_samples(spark, descriptor, f"{layout.raw_public}/roads", {"val", "test"})
    return samples.groupBy("split", "category").agg(F.count("*").alias("rows"))


def _sample_columns(samples: DataFrame, root: str) -> DataFrame:
    return samples.select(
        "dataset", "split", "category", "rel_path", P.below("src_image_uri", root).alias("image_path"),
        P.below("label_uri", root).alias("label_path"), "width", "image_id", "frame_id", "sequence_id",
    )


def _json_dataset(spark, sf, layout: Layout, dataset: str, options: str) -> None:
    """English in train, German in valid (both listed), French in test without a list; Spanish is no image."""
    root = f"{layout.raw_public}/{dataset}"
    folder = F.when(F.col("lang") == "en", "train").when(F.col("lang") == "de", "valid").otherwise("test")
    name = F.concat("source", F.lit(" a/"), _id(), F.when(F.col("lang") == "es", ".JPG").otherwise(".jpg"))
    docs = table(spark, sf, "documents").select("doc_id", "lang", "n_chars", folder.alias("folder"), F.concat(F.lit("images/"), name).alias("native"))
    put(docs.select(_uri(root, "folder", "native").alias("uri"), F.col("n_chars").cast("string").alias("data")), docs.count())
    lane = F.concat(F.lit('[{"x": "'), F.col("n_chars").cast("string"), F.lit('.5", "y": "2.5"}, {"x": 3, "y": 4.75}]'))
    bad = F.concat(F.lit('{"Lines": [[{"x": '), _id(), F.lit("}]]}"))
    body = F.when(F.col("toxic") == 1, bad).when(F.col("quality") == 0, '{"Lines": []}').otherwise(F.concat(F.lit('{"Lines": [[], '), lane, F.lit("]}")))
    told = table(spark, sf, "labels")
    put(docs.join(told, "doc_id").select(_uri(root, "folder", P.json_label_path("native")).alias("uri"), body.alias("data")), told.count())
    for lang, where in (("en", "train"), ("de", "valid")):
        docs.filter(F.col("lang") == lang).select(F.concat(F.lit("/"), "native", F.lit(" ")).alias("value")).write.text(f"{root}/{where}/{where}.txt")
    _put_descriptor(spark, layout, dataset, f"adapter: curvelanes\n{options}")


_JSON_SPLIT_SQL = "CASE lang WHEN 'en' THEN 'train' WHEN 'de' THEN 'val' ELSE 'test' END"
_JSON_FOLDER_SQL = "CASE lang WHEN 'en' THEN 'train' WHEN 'de' THEN 'valid' ELSE 'test' END"


@query("json_samples", f"""
SELECT 'curvelanes' AS dataset, {_JSON_SPLIT_SQL} AS split, CAST(NULL AS VARCHAR) AS category, source || ' a/' || doc_id || '.jpg' AS rel_path,
       {_JSON_FOLDER_SQL} || '/images/' || source || ' a/' || doc_id || '.jpg' AS image_path,
       {_JSON_FOLDER_SQL} || '/labels/' || source || ' a/' || doc_id || '.lines.json' AS label_path,
       CAST(NULL AS BIGINT) AS width, 'curvelanes/' || source || ' a/' || doc_id AS image_id, CAST(doc_id AS VARCHAR) AS frame_id, source || ' a' AS sequence_id
FROM documents WHERE lang <> 'es'""")
def json_sample_scan(spark, sf):
    layout = _layout(spark)
    _json_dataset(spark, sf, layout, "curves", "options: {ingest_unlabeled: true}\n")
    root = f"{layout.raw_public}/curves"
    return _sample_columns(json_samples(spark, read_descriptor(spark, layout.descriptors_root, "curves"), root), root)


# --- whole jobs ---

_ROADS_SQL = f"""r AS (SELECT d.*, {_REL_SQL} AS rel, {_SPLIT_SQL} AS split, {_CATEGORY_SQL} AS category, l.doc_id IS NOT NULL AS has_label, quality, toxic,
  {_SPLIT_SQL} || coalesce('/' || {_CATEGORY_SQL}, '') AS leaf FROM documents d LEFT JOIN labels l USING (doc_id))"""


@query("ingest_catalogue", f"""
WITH {_ROADS_SQL}
SELECT 'roads/drv_' || source || '/' || lang || '.MP4/' || doc_id AS image_id, 'public' AS source, 'roads' AS dataset, 'set1/' || leaf || '/images/' || rel AS gcs_name,
       CAST(1640 AS BIGINT) AS width, CAST(590 AS BIGINT) AS height, CAST(doc_id AS VARCHAR) AS frame_id, 'drv_' || source || '/' || lang || '.MP4' AS sequence_id,
       split, CAST({EPOCH} AS BIGINT) AS ingested_s, md5(text) AS digest
FROM r WHERE has_label AND toxic = 0""")
def ingest_catalogue(spark, sf):
    """Catalogue rows after an ingest, with the digest of the placed image."""
    layout = _layout(spark)
    _list_dataset(spark, sf, layout, "set1")
    ingest(spark, layout, "set1", EPOCH)
    rows = CatalogueTable(spark, layout.table_path(IMAGES.name), IMAGES).read()
    return _read(rows, "gcs_uri").select(
        "image_id", "source", "dataset", P.below("gcs_uri", layout.public).alias("gcs_name"), "width", "height", "frame_id", "sequence_id",
        "split", F.unix_seconds("ingested_at").alias("ingested_s"), F.md5("content").alias("digest"),
    )


@query("ingest_collisions", f"""
WITH {_ROADS_SQL}
SELECT 'roads/drv_' || source || '/' || lang || '.MP4/' || doc_id AS image_id, CAST(2 AS BIGINT) AS rows FROM r WHERE lang = 'en' AND has_label AND toxic = 0""")
def ingest_collisions(spark, sf):
    """Ids an ingest reports as used by several samples: the images that two splits list."""
    layout = _layout(spark)
    _list_dataset(spark, sf, layout, "set1", twice=True)
    return ingest(spark, layout, "set1", EPOCH, dry_run=True).collisions


@query("ingest_labels", f"""
WITH {_ROADS_SQL}
SELECT leaf || '/label/drv_' || source || '/' || lang || '.MP4/' || doc_id || '.lines.json' AS name,
  md5('{{"timestamp": {EPOCH},' || chr(10) || '"Lines": [' || chr(10) || CASE WHEN quality = 0 THEN '' ELSE
      '[{{"x": ' || (n_chars + n_chars % 2) || ', "y": ' || doc_id || '}}, {{"x": 4, "y": 0}}],' || chr(10) ||
      '[{{"x": 10, "y": 20}}, {{"x": ' || (doc_id + doc_id % 2) || ', "y": 40}}]' END || chr(10) || ']}}') AS digest
FROM r WHERE has_label AND toxic = 0""")
def ingest_labels(spark, sf):
    """Label files after an ingest; halves are rounded to the even neighbour."""
    layout = _layout(spark)
    _list_dataset(spark, sf, layout, "set1")
    ingest(spark, layout, "set1", EPOCH)
    root = f"{layout.public}/set1"
    files = list_objects(spark, f"{root}/").filter(F.endswith("path", F.lit(".lines.json"))).select("path")
    return _read(files, "path").select(P.below("path", root).alias("name"), F.md5("content").alias("digest"))


_INGEST_SUMMARY_SQL = """count(*) FILTER (WHERE has_label AND toxic = 0) AS num_images, {written} AS written, {reused} AS reused, CAST(0 AS BIGINT) AS unlabeled,
  count(*) FILTER (WHERE NOT has_label) AS skipped_no_label, count(*) FILTER (WHERE toxic = 1) AS failed, 'test,train,val' AS splits,
  CASE WHEN count(*) FILTER (WHERE toxic = 1) > 0 THEN 1 ELSE 0 END AS exit_code, false AS aborted FROM r"""
_USABLE = "count(*) FILTER (WHERE has_label AND toxic = 0)"
_NONE = "CAST(0 AS BIGINT)"


@query("ingest_runs", f"""
WITH {_ROADS_SQL}
SELECT 'dry' AS run, {_INGEST_SUMMARY_SQL.format(written=_USABLE, reused=_NONE)}
UNION ALL SELECT 'first', {_INGEST_SUMMARY_SQL.format(written=_USABLE, reused=_NONE)}
UNION ALL SELECT 'second', {_INGEST_SUMMARY_SQL.format(written=_NONE, reused=_USABLE)}""")
def ingest_runs(spark, sf):
    """Summaries of a dry run, a first run and a rerun that finds everything in place."""
    layout = _layout(spark)
    _list_dataset(spark, sf, layout, "set1")
    runs = [("dry", True), ("first", False), ("second", False)]
    frames = [ingest(spark, layout, "set1", EPOCH, dry_run=dry).summary.withColumn("run", F.lit(name)) for name, dry in runs]
    return frames[0].unionByName(frames[1]).unionByName(frames[2]).withColumn("splits", F.array_join("splits", ","))


@query("ingest_aborted", f"""
WITH {_ROADS_SQL}
SELECT 'cut' AS run, count(*) FILTER (WHERE has_label AND lang <> 'de') AS num_images, CAST(0 AS BIGINT) AS reused, 1 AS exit_code, true AS aborted,
  count(*) FILTER (WHERE has_label AND lang <> 'de') AS recorded, 'list/list/val.txt' AS unreadable FROM r
UNION ALL SELECT 'mended', count(*) FILTER (WHERE has_label), count(*) FILTER (WHERE has_label AND lang <> 'de'), 0, false,
  count(*) FILTER (WHERE has_label), '' FROM r""")
def ingest_aborted(spark, sf):
    """One list file cannot be read: the others' images are recorded and the run ends with code 1; mended, its repeat does the rest."""
    layout = _layout(spark)
    _list_dataset(spark, sf, layout, "set1", toxic="")
    root = f"{layout.raw_public}/set1"
    bad = F.unhex(F.lit("2f6aff2e6a70670a"))
    put(spark.range(1).select(F.lit(f"{root}/list/list/val.txt/part-broken.txt").alias("uri"), bad.alias("data")))
    frames = []
    for run in ("cut", "mended"):
        done = ingest(spark, layout, "set1", EPOCH)
        recorded = CatalogueTable(spark, layout.table_path(IMAGES.name), IMAGES).read().count()
        named = ",".join(sorted(uri.removeprefix(f"{root}/") for uri in done.unreadable))
        frames.append(done.summary.select(F.lit(run).alias("run"), "num_images", "reused", "exit_code", "aborted", F.lit(recorded).cast("long").alias("recorded"), F.lit(named).alias("unreadable")))
        put(spark.range(1).select(F.lit(f"{root}/list/list/val.txt/part-broken.txt").alias("uri"), F.lit("").alias("data")))
    return frames[0].unionByName(frames[1])


@query("ingest_versions", """
SELECT 'curves' AS dataset, '' AS version, CAST(NULL AS VARCHAR) AS license, count(*) AS num_images, CAST(NULL AS VARCHAR) AS notes
FROM documents d LEFT JOIN labels l USING (doc_id) WHERE lang <> 'es' AND coalesce(toxic, 0) = 0""")
def ingest_versions(spark, sf):
    """Dataset row of a native-JSON dataset, images without labels included."""
    layout = _layout(spark)
    _json_dataset(spark, sf, layout, "curves", "options: {ingest_unlabeled: true}\n")
    ingest(spark, layout, "curves", EPOCH)
    versions = CatalogueTable(spark, layout.table_path(SOURCE_DATASETS.name), SOURCE_DATASETS).read()
    return versions.select("dataset", "version", "license", "num_images", "notes")


@query("ingest_outcomes", f"""
SELECT {_JSON_SPLIT_SQL} AS split, CASE WHEN toxic = 1 THEN 'error' ELSE 'ok' END AS status, l.doc_id IS NOT NULL AS has_label, count(*) AS rows
FROM documents d LEFT JOIN labels l USING (doc_id) WHERE lang <> 'es' GROUP BY ALL""")
def ingest_outcomes(spark, sf):
    """Outcomes of a dry run over a native-JSON dataset, by split."""
    layout = _layout(spark)
    _json_dataset(spark, sf, layout, "curves", "options: {ingest_unlabeled: true}\n")
    run = ingest(spark, layout, "curves", EPOCH, dry_run=True)
    return run.outcome.groupBy("split", "status", "has_label").agg(F.count("*").alias("rows"))


@query("ingest_manifests", f"WITH {_ROADS_SQL} SELECT leaf || '/' || coalesce(category, split) || '.txt' AS txt_rel, leaf || '/images/' || rel AS path FROM r WHERE has_label AND toxic = 0")
def ingest_manifests(spark, sf):
    """Manifest lines after two runs."""
    from ..operators.manifests import read_manifests

    layout = _layout(spark)
    _list_dataset(spark, sf, layout, "set1")
    for _ in range(2):
        run = ingest(spark, layout, "set1", EPOCH)
    names = [r.txt_rel for r in run.outcome.filter("status = 'ok'").select("txt_rel").distinct().collect()]
    return read_manifests(spark, f"{layout.public}/set1", names)


# --- user images: tiny pixmaps whose pixels are the digest of the text; Spanish ones are broken ---

WIDTH, HEIGHT = 8, 4
_PIXELS_SQL = """p AS (SELECT doc_id, source, lang, substr(sha256(text) || sha256(text), 1, 96) AS body FROM documents),
c AS (SELECT p.doc_id, count(*) FILTER (WHERE substr(body, 1 + 3 * i, 1) IN ('a', 'b', 'c', 'd', 'e', 'f')) AS faces,
             count(*) FILTER (WHERE substr(body, 1 + 3 * i, 1) = '0') AS plates FROM p, generate_series(0, 7) g(i) GROUP BY p.doc_id)"""


def _pixmaps(docs: DataFrame) -> DataFrame:
    body = F.substring(F.concat(F.sha2("text", 256), F.sha2("text", 256)), 1, WIDTH * HEIGHT * 3)
    whole = F.encode(F.concat(F.lit(f"P6 {WIDTH} {HEIGHT} 255\n"), body), "UTF-8")
    return docs.withColumn("data", F.when(F.col("lang") == "es", F.encode(F.lit("no picture"), "UTF-8")).otherwise(whole))


def pixel_detector():
    """Stand-in model: in the top row, a red value that is a letter is a face, a `0` a plate, a `1` too unsure, a `2` a car."""
    names = {ord("0"): ("license-plate", 0.8), ord("1"): ("face", 0.05), ord("2"): ("car", 0.9)}

    def detect(pictures):
        found = []
        for picture in pictures:
            boxes = []
            for x, red in enumerate(picture[0, :, 2].tolist()):
                name, confidence = ("Human Face", 0.9) if red >= ord("a") else names.get(red, (None, 0.0))
                if name:
                    boxes.append((name, confidence, x - 0.5, 0.0, x + 1.5, 2.0))
            found.append(boxes)
        return found

    return detect


def _user_tree(spark, sf, layout: Layout) -> None:
    """Frames per source (user) and language (session); German frames have lane files, English sessions metadata."""
    docs = _pixmaps(table(spark, sf, "documents").select("doc_id", "source", "lang", "text"))
    session = F.when(F.col("lang") == "de", "20240102T0304Z__usr__01").when(F.col("lang") == "fr", "nodate__x").otherwise(F.col("lang"))
    docs = docs.select("*", _uri(layout.raw_user, F.concat(F.lit("usr_"), "source"), session).alias("folder"))
    rows = docs.count()
    put(docs.select(F.concat_ws("/", "folder", F.lit("images"), F.concat(_id(), F.lit(".jpg"))).alias("uri"), "data"), rows)
    put(docs.filter("lang = 'de'").select(
        F.concat_ws("/", "folder", F.lit("lines"), F.concat(_id(), F.lit(".lines.json"))).alias("uri"), F.format_string('{"frame": %d}', "doc_id").alias("data")
    ), rows)
    sessions = docs.filter("lang = 'en'").select("folder").distinct()
    put(sessions.select(F.concat("folder", F.lit("/meta.json")).alias("uri"), F.lit('{"start": "soon", "date": "2024-05-06"}').alias("data")))


_SESSION_SQL = "CASE lang WHEN 'de' THEN '20240102T0304Z__usr__01' WHEN 'fr' THEN 'nodate__x' ELSE lang END"


@query("session_starts", f"""
SELECT doc_id, CASE lang WHEN 'en' THEN epoch_us(TIMESTAMP '2024-05-06') WHEN 'de' THEN epoch_us(TIMESTAMP '2024-01-02 03:04:00') END AS captured_us FROM documents""")
def session_start_reads(spark, sf):
    layout = _layout(spark)
    _user_tree(spark, sf, layout)
    frames = raw_frames(list_objects(spark, layout.raw_user + "/"), layout)
    timed = with_session_start(frames, session_starts(frames, layout.raw_user))
    return timed.select(F.col("frame_id").cast("bigint").alias("doc_id"), F.unix_micros("captured_at").alias("captured_us"))


@query("redaction_audit", f"""
WITH {_PIXELS_SQL}
SELECT 'user/usr_' || source || '/' || {_SESSION_SQL} || '/images/' || doc_id AS image_id, faces AS faces_blurred, plates AS plates_blurred, 'pixels-v1' AS model_version,
       {EPOCH} AS processed_s FROM p JOIN c USING (doc_id) WHERE lang <> 'es'""")
def redaction_audit(spark, sf):
    """Audit rows after a redaction run recorded in three slices."""
    layout = _layout(spark)
    _user_tree(spark, sf, layout)
    redact_user_images(spark, layout, pixel_detector, pixmap_codec(), "pixels-v1", EPOCH, slices=3)
    audit = CatalogueTable(spark, layout.table_path(USER_IMAGES_PRIVACY.name), USER_IMAGES_PRIVACY).read()
    return audit.select("image_id", "faces_blurred", "plates_blurred", "model_version", F.unix_seconds("processed_at").cast("int").alias("processed_s"))


@query("redaction_catalogue", f"""
SELECT 'user/usr_' || source || '/' || {_SESSION_SQL} || '/images/' || doc_id AS image_id, 'user' AS source, 'usr_' || source || '/' || {_SESSION_SQL} || '/images/' || doc_id || '.jpg' AS name,
       CAST(8 AS BIGINT) AS width, CAST(4 AS BIGINT) AS height, 'usr_' || source AS user_id, {_SESSION_SQL} AS sequence_id, CAST(NULL AS VARCHAR) AS split,
       CASE lang WHEN 'en' THEN epoch_us(TIMESTAMP '2024-05-06') WHEN 'de' THEN epoch_us(TIMESTAMP '2024-01-02 03:04:00') END AS captured_us, true AS placed
FROM documents WHERE lang <> 'es'""")
def redaction_catalogue(spark, sf):
    """Catalogue rows after a redaction run, and whether the clean image is there."""
    layout = _layout(spark)
    _user_tree(spark, sf, layout)
    redact_user_images(spark, layout, pixel_detector, pixmap_codec(), "pixels-v1", EPOCH)
    rows = CatalogueTable(spark, layout.table_path(IMAGES.name), IMAGES).read()
    return _read(rows, "gcs_uri").select(
        "image_id", "source", P.below("gcs_uri", layout.clean_user).alias("name"), "width", "height", "user_id", "sequence_id", "split",
        F.unix_micros("captured_at").alias("captured_us"), F.col("found").alias("placed"),
    )


@query("redaction_runs", f"""
WITH {_PIXELS_SQL}, o AS (SELECT lang <> 'es' AS ok, faces, plates FROM p JOIN c USING (doc_id)),
s AS (SELECT count(*) AS n, count(*) FILTER (WHERE ok) AS good, CAST(sum(faces) FILTER (WHERE ok) AS BIGINT) AS faces, CAST(sum(plates) FILTER (WHERE ok) AS BIGINT) AS plates FROM o)
SELECT 'dry' AS run, n AS candidates, good AS anonymized, faces AS faces_blurred, plates AS plates_blurred, n - good AS failed FROM s
UNION ALL SELECT 'first', n, good, faces, plates, n - good FROM s
UNION ALL SELECT 'next day', n - good, 0, 0, 0, n - good FROM s
UNION ALL SELECT 'third day', n, good, faces, plates, n - good FROM s""")
def redaction_runs(spark, sf):
    """A dry run writes nothing; a day later only failed images are tried again; after two days all are."""
    layout = _layout(spark)
    _user_tree(spark, sf, layout)
    day = 86400
    runs = [("dry", EPOCH, True), ("first", EPOCH, False), ("next day", EPOCH + day, False), ("third day", EPOCH + 2 * day + 1, False)]
    out = None
    for name, epoch, dry in runs:
        run = redact_user_images(spark, layout, pixel_detector, pixmap_codec(), "pixels-v1", epoch, dry_run=dry)
        row = run.summary.select(F.lit(name).alias("run"), "candidates", "anonymized", "faces_blurred", "plates_blurred", "failed")
        out = row if out is None else out.unionByName(row)
    return out


@query("carried_labels", """
SELECT doc_id, md5('{"frame": ' || doc_id || '}') AS digest FROM documents WHERE lang = 'de'""")
def carried_labels(spark, sf):
    """Lane files copied unchanged to the clean tree."""
    layout = _layout(spark)
    _user_tree(spark, sf, layout)
    objects = list_objects(spark, layout.raw_user + "/")
    named = user_images(objects).select(
        P.lines_uri("path").alias("raw_lines"), P.swap_root(P.lines_uri("path"), layout.raw_user, layout.clean_user).alias("clean_lines")
    )
    plan = stage(label_carry_over(named, objects, "raw_lines", "clean_lines"), "carry-over")
    stage(copy_objects(spread(plan, plan.count(), "raw_lines"), "raw_lines", "clean_lines"), "carried")
    copies = list_objects(spark, layout.clean_user + "/").select("path")
    number = F.regexp_extract("path", r"/(\d+)\.lines\.json$", 1).cast("bigint")
    return _read(copies, "path").select(number.alias("doc_id"), F.md5("content").alias("digest"))


# Every box of the stand-in model rounds to a square of 2 x 2 pixels in the upper half (columns 2k and 2k + 1), which is
# blurred once per box. With mirrored borders the kernel's even steps weigh on a pixel itself, the odd ones on its neighbour.
_HIT = "CAST(substr(body, 1 + 6 * k + {at}, 1) IN ('0', 'a', 'b', 'c', 'd', 'e', 'f') AS INTEGER)"
_BLURRED = """SELECT doc_id, k, ch, hits,
  CASE WHEN hits >= {n} THEN round_even(a*a*p + a*b*q + a*b*r + b*b*s, 0) ELSE p END AS p, CASE WHEN hits >= {n} THEN round_even(a*b*p + a*a*q + b*b*r + a*b*s, 0) ELSE q END AS q,
  CASE WHEN hits >= {n} THEN round_even(a*b*p + b*b*q + a*a*r + a*b*s, 0) ELSE r END AS r, CASE WHEN hits >= {n} THEN round_even(b*b*p + a*b*q + a*b*r + a*a*s, 0) ELSE s END AS s"""
_BLUR_SQL = f"""w AS (SELECT sum(e) FILTER (i % 2 = 0) / sum(e) AS a, sum(e) FILTER (i % 2 <> 0) / sum(e) AS b FROM (SELECT i, exp(-i * i / 50.0) AS e FROM generate_series(-15, 15) g(i))),
raw AS (SELECT doc_id, k, ch, {_HIT.format(at=0)} + {_HIT.format(at=3)} AS hits, ascii(substr(body, 1 + 6 * k + ch, 1)) AS p, ascii(substr(body, 4 + 6 * k + ch, 1)) AS q,
  ascii(substr(body, 25 + 6 * k + ch, 1)) AS r, ascii(substr(body, 28 + 6 * k + ch, 1)) AS s FROM p, generate_series(0, 3) x(k), generate_series(0, 2) y(ch)),
one AS ({_BLURRED.format(n=1)} FROM raw, w), two AS ({_BLURRED.format(n=2)} FROM one, w),
pixels AS (SELECT doc_id, unnest([6 * k + ch, 6 * k + 3 + ch, 24 + 6 * k + ch, 27 + 6 * k + ch]) AS place, unnest([p, q, r, s]) AS v FROM two),
upper AS (SELECT doc_id, string_agg(printf('%02X', CAST(v AS BIGINT)), '' ORDER BY place) AS upper_half FROM pixels GROUP BY doc_id)"""


@query("redacted_pictures", f"""
WITH {_PIXELS_SQL}, {_BLUR_SQL}
SELECT doc_id, lang <> 'es' AS ok, CASE WHEN lang <> 'es' THEN faces END AS faces, CASE WHEN lang <> 'es' THEN plates END AS plates,
       CASE WHEN lang <> 'es' THEN upper_half END AS upper_half, CASE WHEN lang <> 'es' THEN md5(substr(body, 49, 48)) END AS lower_half FROM p JOIN c USING (doc_id) JOIN upper USING (doc_id)""")
def redacted_pictures(spark, sf):
    """Pictures redacted in a column: boxes in the upper half are blurred, the lower half holds none and comes out unchanged."""
    docs = _pixmaps(table(spark, sf, "documents").select("doc_id", "lang", "text")).select("doc_id", "data")
    done = redact_contents(docs, "data", pixel_detector, pixmap_codec())
    body = len(f"P6 {WIDTH} {HEIGHT} 255\n") + 1
    return done.select(
        "doc_id", F.col("error").isNull().alias("ok"), "faces", "plates",
        F.hex(F.substring("clean", body, 48)).alias("upper_half"), F.md5(F.substring("clean", body + 48, 48)).alias("lower_half"),
    )


@query("retention_listing", f"""
SELECT 'user/usr_' || source || '/' || {_SESSION_SQL} || '/images/' || doc_id AS image_id, 'in two days' AS seen FROM documents WHERE lang = 'es'""")
def retention_listing(spark, sf):
    """Listed raw images past their lifetime without an audit row, now (none is that old) and in two days: those that were not readable."""
    layout = _layout(spark)
    _user_tree(spark, sf, layout)
    redact_user_images(spark, layout, pixel_detector, pixmap_codec(), "pixels-v1", EPOCH)
    audit = CatalogueTable(spark, layout.table_path(USER_IMAGES_PRIVACY.name), USER_IMAGES_PRIVACY).read()
    raw = user_images(list_objects(spark, layout.raw_user + "/")).withColumn("image_id", P.user_image_id("path", layout.raw_user))
    seen = {"now": F.current_timestamp(), "in two days": F.current_timestamp() + F.expr("INTERVAL 2 DAYS")}
    now, later = (PD.expired_unprocessed(raw, audit, as_of).select("image_id", F.lit(name).alias("seen")) for name, as_of in seen.items())
    return now.unionByName(later)


def size_labeller(prompt, schema):
    """Stand-in model: labels by the number of bytes; some answers are outside the taxonomy or no JSON."""
    import json

    def label(data: bytes) -> str:
        n = len(data)
        if n % 11 == 0:
            return "I think it rains"
        weather = ("clear", "rain", "hail")[n % 3]
        return json.dumps({"weather": weather, "scene": "city" if n % 2 else None, "timeofday": "night"})

    return label


def schema_labeller(prompt, schema):
    """Stand-in model that knows the allowed values from its schema only, and names those that the prompt lists."""
    import json

    fields = {name: field["enum"] for name, field in schema["properties"].items()}

    def label(data: bytes) -> str:
        return json.dumps({name: values[len(data) % len(values)] if str(values) in prompt else "not asked" for name, values in fields.items()})

    return label


_LABELLED_SQL = f"""{_ROADS_SQL}, u AS (SELECT *, strlen(text) AS n, 'roads/drv_' || source || '/' || lang || '.MP4/' || doc_id AS image_id FROM r WHERE has_label AND toxic = 0)"""


@query("label_run_rows", f"""
WITH {_LABELLED_SQL}
SELECT image_id, CASE n % 3 WHEN 0 THEN 'clear' WHEN 1 THEN 'rain' ELSE 'unknown' END AS weather, CASE WHEN n % 2 = 1 THEN 'city' ELSE 'unknown' END AS scene,
       'night' AS timeofday, 'unknown' AS road_geometry, 'sizes-v1' AS model FROM u WHERE n % 11 <> 0""")
def label_run_rows(spark, sf):
    """Classification rows after ingest and labelling, recorded in four slices."""
    layout = _labelled_lake(spark, sf, slices=4)
    rows = CatalogueTable(spark, layout.table_path(CLASSIFICATIONS.name), CLASSIFICATIONS).read()
    return rows.select("image_id", "weather", "scene", "timeofday", "road_geometry", "model")


@query("label_prompt", f"""
WITH {_LABELLED_SQL}
SELECT image_id, (['clear', 'cloudy', 'rain', 'snow', 'fog', 'unknown'])[n % 6 + 1] AS weather,
       (['highway', 'city', 'residential', 'rural', 'tunnel', 'parking', 'unknown'])[n % 7 + 1] AS scene,
       (['day', 'night', 'dawn_dusk', 'unknown'])[n % 4 + 1] AS timeofday, (['straight', 'curve', 'unknown'])[n % 3 + 1] AS road_geometry FROM u""")
def label_prompt(spark, sf):
    """Classification rows of a labeller that takes every allowed value from the prompt and the schema it is given."""
    layout = _labelled_lake(spark, sf, schema_labeller)
    rows = CatalogueTable(spark, layout.table_path(CLASSIFICATIONS.name), CLASSIFICATIONS).read()
    return rows.select("image_id", "weather", "scene", "timeofday", "road_geometry")


def _labelled_lake(spark, sf, labeller=size_labeller, **how) -> Layout:
    layout = _layout(spark)
    _list_dataset(spark, sf, layout, "set1")
    ingest(spark, layout, "set1", EPOCH)
    label_images(spark, layout, labeller, "sizes-v1", EPOCH, "public", "roads", **how)
    return layout


@query("label_runs", f"""
WITH {_LABELLED_SQL}, s AS (SELECT count(*) AS n, count(*) FILTER (WHERE n % 11 <> 0) AS good FROM u)
SELECT 'dry' AS run, n AS candidates, good AS classified, n - good AS failed FROM s
UNION ALL SELECT 'first', n, good, n - good FROM s UNION ALL SELECT 'second', n - good, 0, n - good FROM s UNION ALL SELECT 'other', 0, 0, 0 FROM s""")
def label_runs(spark, sf):
    """Summaries of a dry run, a first run, a rerun (only failures are left) and a run for a source without images."""
    layout = _layout(spark)
    _list_dataset(spark, sf, layout, "set1")
    ingest(spark, layout, "set1", EPOCH)
    runs = [("dry", "public", True), ("first", "public", False), ("second", "public", False), ("other", "user", False)]
    out = None
    for name, source, dry in runs:
        run = label_images(spark, layout, size_labeller, "sizes-v1", EPOCH, source, "", dry_run=dry)
        row = run.summary.select(F.lit(name).alias("run"), "candidates", "classified", "failed")
        out = row if out is None else out.unionByName(row)
    return out
