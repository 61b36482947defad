"""Queries over the path, URI and time expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import Layout
from ..functions import paths as P
from ..functions import times as TM
from .registry import query, table

LAYOUT = Layout("gs://raw-public", "gs://public", "gs://raw-user", "gs://clean-user", "gs://tables")


def _object_path(url="url"):
    """Page address as an object path: without scheme."""
    return F.regexp_replace(F.col(url), "^https?://", "")


@query("path_parts", r"""
WITH p AS (SELECT page_id, regexp_replace(url, '^https?://', '') AS rel FROM pages),
s AS (SELECT page_id, rel, list_extract(string_split(rel, '/'), -1) AS base FROM p)
SELECT page_id,
       regexp_replace(rel, '^((?:.*/)?\.*[^/.][^/]*)\.[^/.]*$', '\1') AS stem,
       regexp_replace(base, '^(\.*[^.].*)\.[^.]*$', '\1') AS frame_id,
       rtrim(left(rel, length(rel) - length(base)), '/') AS sequence_id,
       'pages/' || regexp_replace(rel, '^((?:.*/)?\.*[^/.][^/]*)\.[^/.]*$', '\1') AS image_id
FROM s""")
def path_parts(spark, sf):
    rel = table(spark, sf, "pages").select("page_id", _object_path().alias("rel"))
    return rel.select(
        "page_id", P.stem("rel").alias("stem"), P.frame_id("rel").alias("frame_id"),
        P.sequence_id("rel").alias("sequence_id"), P.image_id(F.lit("pages"), "rel").alias("image_id"),
    )


@query("uri_parts", r"""
WITH u AS (SELECT page_id, replace(url, 'https://', 'gs://') AS uri FROM pages)
SELECT page_id,
       CASE WHEN uri LIKE 'gs://%' THEN split_part(substr(uri, 6), '/', 1) END AS bucket,
       CASE WHEN uri LIKE 'gs://%' THEN substr(uri, 7 + length(split_part(substr(uri, 6), '/', 1))) END AS object,
       uri LIKE 'gs://%' AS valid
FROM u""")
def uri_parts(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", F.regexp_replace("url", "^https://", "gs://").alias("uri"))
    return pages.select(
        "page_id", P.uri_bucket("uri").alias("bucket"), P.uri_object("uri").alias("object"),
        P.uri_bucket("uri").isNotNull().alias("valid"),
    )


@query("joined_paths", r"""
SELECT doc_id,
       'gs://raw/' || source || CASE WHEN lang = 'en' THEN '' ELSE '/' || lang END || '/' || CAST(doc_id AS VARCHAR) || '.jpg' AS path
FROM documents""")
def joined_paths(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select(
        "doc_id",
        P.join_path(
            F.lit("gs://raw//"), F.concat(F.lit("/"), "source", F.lit("//")),
            F.when(F.col("lang") != "en", F.concat("lang", F.lit("/"))),
            F.lit(""), F.concat(F.lit("//"), F.col("doc_id").cast("string"), F.lit(".jpg")),
        ).alias("path"),
    )


@query("user_paths", r"""
SELECT doc_id,
       'user/usr_' || source || '/' || lang || '/s/images/' || doc_id || '.v1' AS image_id,
       'gs://clean-user/usr_' || source || '/' || lang || '/s/images/' || doc_id || '.v1.JPG' AS clean_uri,
       'gs://raw-user/usr_' || source || '/' || lang || '/s/lines/' || doc_id || '.v1.lines.json' AS raw_lines,
       'gs://clean-user/usr_' || source || '/' || lang || '/s/lines/' || doc_id || '.v1.lines.json' AS clean_lines,
       'usr_' || source AS user_id, lang || '/s' AS session_id, doc_id || '.v1' AS frame_id, true AS is_image
FROM documents""")
def user_paths(spark, sf):
    docs = table(spark, sf, "documents")
    raw, clean = LAYOUT.raw_user, LAYOUT.clean_user
    uri = F.concat(F.lit(raw + "/usr_"), "source", F.lit("/"), "lang", F.lit("/s/images/"), F.col("doc_id").cast("string"), F.lit(".v1.JPG"))
    named = docs.select("doc_id", uri.alias("uri")).withColumn("rel", P.below("uri", raw))
    return named.select(
        "doc_id", P.user_image_id("uri", raw).alias("image_id"), P.swap_root("uri", raw, clean).alias("clean_uri"),
        P.lines_uri("uri").alias("raw_lines"), P.swap_root(P.lines_uri("uri"), raw, clean).alias("clean_lines"),
        P.path_user("rel").alias("user_id"), P.path_session("rel").alias("session_id"),
        P.path_frame("rel").alias("frame_id"), P.is_user_image("uri").alias("is_image"),
    )


@query("category_names", r"""
SELECT doc_id, CASE WHEN lang = 'en' THEN 'plain' WHEN lang = 'fr' THEN 'test1_' ELSE lang || '_' || source END AS category
FROM documents""")
def category_names(spark, sf):
    docs = table(spark, sf, "documents")
    name = (
        F.when(F.col("lang") == "en", "plain").when(F.col("lang") == "fr", "test1_")
        .otherwise(F.concat(F.lit("test0_"), "lang", F.lit("_"), "source"))
    )
    path = F.concat(F.lit("gs://raw/list/test_split/"), name, F.lit(".txt"))
    return docs.select("doc_id", P.category_name(path).alias("category"))


@query("event_datasets", r"""
SELECT page_id, nullif(split_part(list_extract(string_split(url, '/'), -1), '.', 1), '') AS dataset FROM pages""")
def event_datasets(spark, sf):
    return table(spark, sf, "pages").select("page_id", P.event_dataset("url").alias("dataset"))


@query("output_paths", r"""
WITH d AS (SELECT doc_id, 'a/' || source || '/' || doc_id || '.jpg' AS rel,
                  CASE lang WHEN 'en' THEN 'train' WHEN 'de' THEN 'val' ELSE 'test' END AS split,
                  CASE lang WHEN 'fr' THEN source WHEN 'es' THEN '' END AS category FROM documents),
l AS (SELECT *, CASE WHEN coalesce(category, '') = '' THEN split ELSE split || '/' || category END AS leaf FROM d)
SELECT doc_id, leaf, leaf || '/images/' || rel AS image_rel,
       leaf || '/label/' || left(rel, length(rel) - 4) || '.lines.json' AS label_rel,
       leaf || '/' || CASE WHEN coalesce(category, '') = '' THEN split ELSE category END || '.txt' AS manifest_rel
FROM l""")
def output_paths(spark, sf):
    docs = table(spark, sf, "documents").select(
        "doc_id",
        F.concat(F.lit("a/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".jpg")).alias("rel"),
        F.when(F.col("lang") == "en", "train").when(F.col("lang") == "de", "val").otherwise("test").alias("split"),
        F.when(F.col("lang") == "fr", F.col("source")).when(F.col("lang") == "es", "").alias("category"),
    )
    return docs.select(
        "doc_id", P.leaf("split", "category").alias("leaf"),
        P.image_out("split", "category", "rel").alias("image_rel"),
        P.label_out("split", "category", "rel").alias("label_rel"),
        P.manifest_out("split", "category").alias("manifest_rel"),
    )


@query("native_uris", r"""
SELECT doc_id,
       'gs://raw/ds/' || CASE WHEN lang = 'en' THEN source || '/' ELSE '' END || source || '/c/' || doc_id || '.jpg' AS image_uri,
       'gs://raw/ds/' || CASE lang WHEN 'en' THEN '' WHEN 'de' THEN source || '/' WHEN 'fr' THEN 'annotations_new/' ELSE 'labels/txt/' END
           || source || '/c/' || doc_id || '.lines.txt' AS label_uri
FROM documents""")
def native_uris(spark, sf):
    docs = table(spark, sf, "documents").select(
        "doc_id", (F.col("lang") == "en").alias("under_driver"),
        F.concat("source", F.lit("/c/"), F.col("doc_id").cast("string"), F.lit(".jpg")).alias("rel"),
        F.when(F.col("lang") == "en", "alongside").when(F.col("lang") == "de", "nested")
        .when(F.col("lang") == "fr", "annotations_new").otherwise("labels/txt/").alias("strategy"),
    )
    root = F.lit("gs://raw/ds")
    return docs.select(
        "doc_id", P.native_image_uri(root, "rel", "under_driver").alias("image_uri"),
        P.native_label_uri(root, "rel", "strategy").alias("label_uri"),
    )


@query("json_label_paths", r"""
SELECT doc_id, source || '/images/' || doc_id || '.x.jpg' AS rel_path, 'labels/' || source || '/images/' || doc_id || '.x.lines.json' AS label_path
FROM documents""")
def json_label_paths(spark, sf):
    prefix = F.when(F.col("lang") == "en", "images/").otherwise("")
    native = F.concat(prefix, "source", F.lit("/images/"), F.col("doc_id").cast("string"), F.lit(".x.jpg"))
    docs = table(spark, sf, "documents").select("doc_id", native.alias("native"))
    return docs.select("doc_id", P.without_image_dir("native").alias("rel_path"), P.json_label_path("native").alias("label_path"))


@query("configured_uris", r"""
SELECT doc_id, 'gs://raw-public/' || source AS raw_uri, 'gs://public/' || source AS public_uri,
       'gs://raw-public/_descriptors/' || source || '.yml' AS descriptor_uri,
       'project.raw_metadata.images' AS table_name, 'detector-' || lang || '-v1.2' AS model_version
FROM documents""")
def configured_uris(spark, sf):
    weights = F.concat(F.lit("/models/detector-"), "lang", F.lit("-v1.2.pt"))
    return table(spark, sf, "documents").select(
        "doc_id", LAYOUT.raw_public_uri(F.col("source")).alias("raw_uri"),
        LAYOUT.public_uri(F.col("source")).alias("public_uri"),
        LAYOUT.descriptor_uri(F.col("source")).alias("descriptor_uri"),
        F.lit(LAYOUT.table_name(LAYOUT.raw_metadata, "images")).alias("table_name"),
        P.frame_id(weights).alias("model_version"),
    )


@query("session_times", r"""
SELECT event_id,
       CASE event_id % 4 WHEN 0 THEN epoch_us(date_trunc('minute', ts)) WHEN 1 THEN epoch_us(date_trunc('second', ts)) END AS started_us
FROM events""")
def session_times(spark, sf):
    events = table(spark, sf, "events")
    kind = F.col("event_id") % 4
    name = (
        F.when(kind == 0, F.date_format("ts", "yyyyMMdd'T'HHmm'Z'"))
        .when(kind == 1, F.date_format("ts", "yyyyMMdd'T'HHmmss'Z'"))
        .when(kind == 2, F.date_format("ts", "yyyyMMdd'T'HHmmss"))
        .otherwise("nodate")
    )
    session = F.concat(name, F.lit("__usr_"), F.col("user_id").cast("string"), F.lit("__01"))
    return events.select("event_id", F.unix_micros(TM.session_time(session)).alias("started_us"))


_SHAPES = """CASE event_id % 10
         WHEN 0 THEN epoch_us(ts) WHEN 1 THEN epoch_us(date_trunc('second', ts)) - 19800000000
         WHEN 2 THEN epoch_us(date_trunc('day', ts)) WHEN 3 THEN epoch_us(date_trunc('second', ts))
         WHEN 4 THEN epoch_us(date_trunc('minute', ts)) WHEN 5 THEN epoch_us(date_trunc('hour', ts))
         WHEN 6 THEN epoch_us(date_trunc('day', ts)) WHEN 7 THEN epoch_us(date_trunc('millisecond', ts)) + 10800000000 END"""


def _shaped_time():
    """The event time in ten spellings: eight that parse, a bare year and a broken one."""
    kind = F.col("event_id") % 10
    iso_week = F.weekofyear("ts")
    # The ISO year of a date is the year of its week's Thursday.
    iso_year = F.year(F.date_add(F.date_sub(F.to_date("ts"), F.weekday("ts")), 3))
    return (
        F.when(kind == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .when(kind == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss'+05:30'"))
        .when(kind == 2, F.date_format("ts", "yyyy-MM-dd"))
        .when(kind == 3, F.date_format("ts", "yyyyMMdd'T'HHmmss"))
        .when(kind == 4, F.date_format("ts", "'  'yyyy-MM-dd'T'HH:mm' '"))
        .when(kind == 5, F.date_format("ts", "yyyyMMdd'T'HH"))
        .when(kind == 6, F.format_string("%04d-W%02d-%d", iso_year, iso_week, F.weekday("ts") + 1))
        .when(kind == 7, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss,SSS'-0300'"))
        .when(kind == 8, F.date_format("ts", "yyyy"))
        .otherwise(F.date_format("ts", "yyyy-13-dd'T'HH:mm"))
    )


@query("iso_times", f"SELECT event_id, {_SHAPES} AS at_us FROM events")
def iso_times(spark, sf):
    events = table(spark, sf, "events").withColumn("said", _shaped_time())
    return TM.with_iso_times(events, at=F.col("said")).select("event_id", F.unix_micros("at").alias("at_us"))


@query("session_metadata_times", f"""
SELECT event_id,
       CASE event_type WHEN 'click' THEN coalesce({_SHAPES}, epoch_us(date_trunc('minute', ts)))
            WHEN 'view' THEN epoch_us(date_trunc('second', ts))
            ELSE epoch_us(date_trunc('minute', ts)) END AS captured_us
FROM events""")
def session_metadata_times(spark, sf):
    """Clicks carry one good or bad spelling, views a bad first and a good second key, the rest nothing usable."""
    events = table(spark, sf, "events").withColumn("said", _shaped_time())
    second = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    meta = (
        F.when(F.col("event_type") == "click", F.to_json(F.struct("props", F.col("said").alias("start_time"))))
        .when(F.col("event_type") == "view", F.to_json(F.struct(second.alias("date"), F.lit("soon").alias("captured_at"), F.lit(20240101).alias("start"))))
        .when(F.col("event_type") == "error", F.lit("{not json"))
        .when(F.col("event_type") == "signup", F.to_json(F.array(second)))
    )
    session = F.concat(F.date_format("ts", "yyyyMMdd'T'HHmm'Z'"), F.lit("__usr__01"))
    timed = TM.with_captured_at(events.select("event_id", meta.alias("meta"), session.alias("session")), "at", F.col("meta"), F.col("session"))
    return timed.select("event_id", F.unix_micros("at").alias("captured_us"))


@query("run_times", """
SELECT event_id, epoch_us(date_trunc('second', ts)) AS at_us FROM events""")
def run_times(spark, sf):
    """Run time stamps are whole epoch seconds."""
    events = table(spark, sf, "events")
    return events.select("event_id", F.unix_micros(TM.epoch_time(F.unix_seconds("ts"))).alias("at_us"))


@query("notes_texts", """
SELECT doc_id, CASE WHEN lang = 'en' THEN 'http://' || source || ' | ' || lang WHEN lang = 'de' THEN 'http://' || source
                    WHEN lang = 'fr' THEN lang END AS notes
FROM documents""")
def notes_texts(spark, sf):
    url = F.when(F.col("lang").isin("en", "de"), F.concat(F.lit("http://"), "source")).when(F.col("lang") == "fr", "")
    notes = F.when(F.col("lang").isin("en", "fr"), F.col("lang")).when(F.col("lang") == "es", "")
    return table(spark, sf, "documents").select("doc_id", TM.notes_text(url, notes).alias("notes"))
