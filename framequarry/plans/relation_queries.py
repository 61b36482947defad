"""Queries over the relational core: pending work, upserts, outcomes, manifests, samples, sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.times import epoch_time
from ..operators import manifests as M
from ..operators import outcome as O
from ..operators import pending as PD
from ..operators import review as RV
from ..operators import rows as R
from ..operators import sequences as S
from ..operators import tables as TB
from ..schemas import IMAGES, USER_IMAGES_PRIVACY
from ..session import shared_dir
from .registry import query, table

# 2024-01-31 00:00:00 UTC, just after the last event of the smaller tables.
AS_OF = 1706659200


def _images(spark, sf):
    """Documents as catalogue rows."""
    docs = table(spark, sf, "documents")
    return docs.select(
        F.col("doc_id").cast("string").alias("image_id"), "source", F.col("lang").alias("dataset"),
        F.concat(F.lit("gs://public/"), "lang", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".jpg")).alias("gcs_uri"),
        F.col("n_chars").alias("width"), F.lit("train").alias("split"),
    )


def _classifications(spark, sf):
    labels = table(spark, sf, "labels")
    return labels.select(F.col("doc_id").cast("string").alias("image_id"), "quality", "toxic")


@query("pending_targets", """
SELECT CAST(doc_id AS VARCHAR) AS image_id, 'gs://public/' || lang || '/' || doc_id || '.jpg' AS gcs_uri FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def pending_targets(spark, sf):
    return PD.unclassified(_images(spark, sf).select("image_id", "gcs_uri"), _classifications(spark, sf))


@query("pending_counts", """
SELECT source, lang AS dataset, count(*) AS candidates FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) GROUP BY source, lang""")
def pending_counts(spark, sf):
    pending = PD.unclassified(_images(spark, sf).select("image_id", "source", "dataset"), _classifications(spark, sf))
    return pending.groupBy("source", "dataset").agg(F.count("*").alias("candidates"))


@query("pending_in_source", """
SELECT CAST(doc_id AS VARCHAR) AS image_id, lang AS dataset FROM documents d
WHERE source = 'src7' AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def pending_in_source(spark, sf):
    """All datasets of one source: the source filter is the feature and reaches the scan."""
    images = PD.in_source(_images(spark, sf).select("image_id", "source", "dataset"), "src7", "")
    return PD.unclassified(images, _classifications(spark, sf)).select("image_id", "dataset")


@query("pending_in_dataset", """
SELECT CAST(doc_id AS VARCHAR) AS image_id FROM documents d
WHERE source = 'src7' AND lang = 'en' AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def pending_in_dataset(spark, sf):
    """The same as SQL text with bound parameters."""
    return spark.sql(
        """SELECT i.image_id FROM {images} i LEFT ANTI JOIN {done} c ON i.image_id = c.image_id
           WHERE i.source = :source AND i.dataset = :dataset""",
        args={"source": "src7", "dataset": "en"}, images=_images(spark, sf), done=_classifications(spark, sf),
    )


@query("pending_first", """
SELECT CAST(doc_id AS VARCHAR) AS image_id FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) ORDER BY image_id LIMIT 25""")
def pending_first(spark, sf):
    """The limit of a smoke run: the first 25 pending images by key."""
    return PD.first_by(PD.unclassified(_images(spark, sf).select("image_id"), _classifications(spark, sf)), "image_id", 25)


@query("pending_window", """
WITH keys AS (SELECT DISTINCT user_id || '/' || event_type AS image_id FROM events)
SELECT image_id FROM keys WHERE image_id NOT IN
  (SELECT user_id || '/' || event_type FROM events WHERE ts >= TIMESTAMP '2024-01-29 00:00:00')""")
def pending_window(spark, sf):
    seen = table(spark, sf, "events").select(
        F.concat(F.col("user_id").cast("string"), F.lit("/"), "event_type").alias("image_id"), F.col("ts").alias("processed_at")
    )
    return PD.unprocessed(seen.select("image_id").distinct(), seen, epoch_time(AS_OF))


@query("pending_window_dates", """
WITH keys AS (SELECT user_id || '/' || event_type AS image_id, max(ts) AS ts FROM events GROUP BY 1)
SELECT image_id FROM keys WHERE ts < TIMESTAMP '2024-01-29 00:00:00'""")
def pending_window_dates(spark, sf):
    """The same from the stored audit, of which only the days of the window are opened; a second upsert moves half of its rows to other days."""
    audit = TB.CatalogueTable(spark, shared_dir(spark, "audit"), USER_IMAGES_PRIVACY)
    seen = table(spark, sf, "events").groupBy(F.concat(F.col("user_id").cast("string"), F.lit("/"), "event_type").alias("image_id")).agg(
        F.max("ts").alias("processed_at"), F.min("ts").alias("first"),
    )
    audit.upsert(seen.select("image_id", F.col("first").alias("processed_at")))
    audit.upsert(seen.select("image_id", "processed_at"))
    return PD.unprocessed(seen.select("image_id"), audit.scan(), epoch_time(AS_OF))


@query("retention_expired", """
SELECT event_id FROM events e WHERE ts < TIMESTAMP '2024-01-30 00:00:00'
  AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = e.event_id AND o.o_orderstatus = 'F')""")
def retention_expired(spark, sf):
    raw = table(spark, sf, "events").select(F.col("event_id").alias("image_id"), F.col("ts").alias("modificationTime"))
    audit = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("image_id"))
    return PD.expired_unprocessed(raw, audit, epoch_time(AS_OF)).select(F.col("image_id").alias("event_id"))


_UPSERTED_SQL = """
SELECT CAST(doc_id AS VARCHAR) AS image_id, source, lang AS dataset, 'gs://public/' || lang || '/' || doc_id || '.jpg' AS gcs_uri,
       n_chars AS width, CAST(NULL AS BIGINT) AS height, 'train' AS split FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
UNION ALL
SELECT CAST(doc_id AS VARCHAR), 'public', NULL, NULL, NULL, CAST(quality AS BIGINT), NULL FROM labels"""


def _label_images(spark, sf):
    return _classifications(spark, sf).select("image_id", F.lit("public").alias("source"), F.col("quality").alias("height"))


@query("upsert_overlay", _UPSERTED_SQL)
def upsert_overlay(spark, sf):
    """What an upsert leaves: matched rows replaced whole, absent columns NULL."""
    merged = TB.overlay(_images(spark, sf), _label_images(spark, sf), IMAGES)
    return merged.select("image_id", "source", "dataset", "gcs_uri", "width", "height", "split")


@query("upsert_table", _UPSERTED_SQL)
def upsert_table(spark, sf):
    """The same through a stored table, with the second upsert sent twice."""
    images = TB.CatalogueTable(spark, shared_dir(spark, "images"), IMAGES)
    images.upsert(_images(spark, sf))
    images.upsert(_label_images(spark, sf))
    images.upsert(_label_images(spark, sf))
    return images.read().select("image_id", "source", "dataset", "gcs_uri", "width", "height", "split")


@query("upsert_null_keys", """
WITH src AS (SELECT CASE WHEN role = 'system' THEN NULL ELSE CAST(conv_id AS VARCHAR) END AS image_id, role AS source, turn AS width FROM conversations),
one AS (SELECT image_id, arg_max(source, width) AS source, max(width) AS width FROM src WHERE image_id IS NOT NULL GROUP BY image_id),
nulls AS (SELECT * FROM src WHERE image_id IS NULL)
SELECT * FROM one UNION ALL SELECT * FROM nulls UNION ALL SELECT * FROM nulls""")
def upsert_null_keys(spark, sf):
    """Rows without a key match nothing: two upserts add them twice, while keyed rows stay single."""
    talk = table(spark, sf, "conversations")
    rows = talk.select(
        F.when(F.col("role") != "system", F.col("conv_id").cast("string")).alias("image_id"),
        F.col("role").alias("source"), F.col("turn").alias("width"),
    )
    images = TB.CatalogueTable(spark, shared_dir(spark, "images"), IMAGES)
    for _ in range(2):
        images.upsert(rows, order=[-F.col("width")])
    return images.read().select("image_id", "source", "width")


@query("dedup_keys", """
SELECT conv_id, turn, role, md5(text) AS digest FROM
  (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY (role <> 'assistant'), turn DESC) AS rn FROM conversations) WHERE rn = 1""")
def dedup_keys(spark, sf):
    """One row per conversation: its last answer, else its last turn."""
    talk = table(spark, sf, "conversations")
    first = TB.dedup(talk, ["conv_id"], [(F.col("role") != "assistant"), -F.col("turn")])
    return first.select("conv_id", "turn", "role", F.md5("text").alias("digest"))


@query("key_collisions", "SELECT conv_id, count(*) AS rows FROM conversations GROUP BY conv_id HAVING count(*) > 1")
def key_collisions(spark, sf):
    return TB.key_collisions(table(spark, sf, "conversations").select("conv_id"), ["conv_id"])


@query("catalogue_union", """
SELECT CAST(doc_id AS VARCHAR) AS image_id, source, 'train' AS split, CAST(NULL AS VARCHAR) AS user_id FROM documents
UNION ALL SELECT 'user/' || conv_id || '/' || turn, 'user', NULL, 'usr_' || conv_id FROM conversations""")
def catalogue_union(spark, sf):
    user = table(spark, sf, "conversations").select(
        F.concat_ws("/", F.lit("user"), "conv_id", "turn").alias("image_id"), F.lit("user").alias("source"),
        F.concat(F.lit("usr_"), F.col("conv_id").cast("string")).alias("user_id"),
    )
    return TB.catalogue_union(_images(spark, sf).select("image_id", "source", "split"), user)


@query("session_lookup", """
WITH s AS (SELECT user_id, epoch_us(min(ts)) AS captured_us FROM events GROUP BY user_id)
SELECT conv_id, turn, captured_us FROM conversations LEFT JOIN s ON conv_id = user_id""")
def session_lookup(spark, sf):
    sessions = table(spark, sf, "events").groupBy(F.col("user_id").alias("conv_id")).agg(F.min("ts").alias("captured_at"))
    frames = table(spark, sf, "conversations").select("conv_id", "turn").join(sessions, "conv_id", "left")
    return frames.select("conv_id", "turn", F.unix_micros("captured_at").alias("captured_us"))


# Documents as ingest candidates: the label row says whether there is a label and whether it is broken.
_OUTCOME_SQL = """o AS (SELECT d.doc_id, source, lang, l.doc_id IS NOT NULL AS has_label, coalesce(toxic, 0) = 1 AS bad, coalesce(quality, 0) = 1 AS exists_, n_chars FROM documents d LEFT JOIN labels l USING (doc_id)),
s AS (SELECT *, CASE WHEN bad THEN 'error' WHEN has_label OR lang = 'fr' THEN 'ok' WHEN lang <> 'de' THEN 'skipped' ELSE 'error' END AS status FROM o),
t AS (SELECT *, CASE WHEN bad THEN 'label: not a number' WHEN status = 'error' THEN 'image without label' END AS error,
        status = 'ok' AND exists_ AND lang <> 'es' AS reused, CASE WHEN n_chars % 3 = 0 THEN 'train' WHEN n_chars % 3 = 1 THEN 'val' ELSE 'test' END AS split FROM s)"""


def _outcome(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", "lang", "n_chars")
    rows = docs.join(table(spark, sf, "labels").withColumn("_known", F.lit(True)), "doc_id", "left")
    rows = rows.withColumns({
        "has_label": F.coalesce(F.col("_known"), F.lit(False)),
        "label_error": F.when(F.col("toxic") == 1, F.lit("label: not a number")),
        "split": F.when(F.col("n_chars") % 3 == 0, "train").when(F.col("n_chars") % 3 == 1, "val").otherwise("test"),
    })
    rows = O.label_status(rows, ingest_unlabeled=F.col("lang") == "fr", skip_missing=F.col("lang") != "de")
    return O.copy_action(rows, F.coalesce(F.col("quality") == 1, F.lit(False)), overwrite=F.col("lang") == "es")


@query("outcome_status", f"WITH {_OUTCOME_SQL} SELECT doc_id, status, error, reused FROM t")
def outcome_status(spark, sf):
    return _outcome(spark, sf).select("doc_id", "status", "error", "reused")


@query("failed_rows", f"WITH {_OUTCOME_SQL} SELECT doc_id, error FROM t WHERE status = 'error'")
def failed_rows(spark, sf):
    return O.split_outcome(_outcome(spark, sf))[1].select("doc_id", "error")


_SUMMARY_SQL = """count(*) FILTER (WHERE status = 'ok') AS num_images, count(*) FILTER (WHERE status = 'ok' AND NOT reused) AS written,
       count(*) FILTER (WHERE reused) AS reused, count(*) FILTER (WHERE status = 'ok' AND NOT has_label) AS unlabeled,
       count(*) FILTER (WHERE status = 'skipped') AS skipped_no_label, count(*) FILTER (WHERE status = 'error') AS failed,
       coalesce(string_agg(DISTINCT split, ',' ORDER BY split) FILTER (WHERE status = 'ok'), '') AS splits,
       CASE WHEN count(*) FILTER (WHERE status = 'error') > 0 THEN 1 ELSE 0 END AS exit_code FROM t"""


@query("ingest_summary", f"WITH {_OUTCOME_SQL} SELECT {_SUMMARY_SQL}")
def ingest_summary(spark, sf):
    return O.ingest_summary(_outcome(spark, sf)).withColumn("splits", F.array_join("splits", ","))


@query("ingest_summary_by_source", f"WITH {_OUTCOME_SQL} SELECT source, {_SUMMARY_SQL} GROUP BY source")
def ingest_summary_by_source(spark, sf):
    return O.ingest_summary(_outcome(spark, sf), "source").withColumn("splits", F.array_join("splits", ","))


@query("redaction_summary", """
WITH i AS (SELECT o_orderkey, o_orderstatus <> 'F' AS ok, count(l_orderkey) FILTER (WHERE l_returnflag = 'A') AS faces, count(l_orderkey) FILTER (WHERE l_returnflag = 'N') AS plates
           FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL)
SELECT count(*) AS candidates, count(*) AS processed, count(*) FILTER (WHERE ok) AS anonymized, CAST(sum(faces) FILTER (WHERE ok) AS BIGINT) AS faces_blurred,
       CAST(sum(plates) FILTER (WHERE ok) AS BIGINT) AS plates_blurred, count(*) FILTER (WHERE NOT ok) AS failed, 1 AS exit_code FROM i""")
def redaction_summary(spark, sf):
    from ..operators.detections import redaction_counts

    images = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("image_id"), F.when(F.col("o_orderstatus") != "F", "ok").otherwise("error").alias("status")
    )
    kind = F.when(F.col("l_returnflag") == "A", "face").when(F.col("l_returnflag") == "N", "plate")  # NULL: a class nobody asked for
    found = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("image_id"), kind.alias("kind"))
    return O.redaction_summary(redaction_counts(images, found))


@query("labelling_summary", """
SELECT count(*) AS candidates, count(*) FILTER (WHERE event_type <> 'error') AS classified, count(*) FILTER (WHERE event_type = 'error') AS failed,
       CASE WHEN count(*) FILTER (WHERE event_type = 'error') > 0 THEN 1 ELSE 0 END AS exit_code FROM events""")
def labelling_summary(spark, sf):
    status = F.when(F.col("event_type") == "error", "error").otherwise("ok")
    return O.labelling_summary(table(spark, sf, "events").select(status.alias("status")))


@query("public_rows", f"""
WITH {_OUTCOME_SQL}
SELECT lang || '/' || doc_id AS image_id, 'public' AS source, lang AS dataset, 'gs://public/' || doc_id AS gcs_uri, n_chars AS width, CAST(NULL AS BIGINT) AS height,
       CAST(doc_id AS VARCHAR) AS frame_id, source AS sequence_id, CAST(NULL AS VARCHAR) AS user_id, CAST(NULL AS BIGINT) AS captured_us,
       {AS_OF}000000 AS ingested_us, split FROM t WHERE status = 'ok'""")
def public_rows(spark, sf):
    ok, _ = O.split_outcome(_outcome(spark, sf))
    key = F.col("doc_id").cast("string")
    named = ok.select(
        F.concat_ws("/", "lang", key).alias("image_id"), F.col("lang").alias("dataset"), F.concat(F.lit("gs://public/"), key).alias("gcs_uri"),
        F.col("n_chars").alias("width"), key.alias("frame_id"), F.col("source").alias("sequence_id"), "split",
    )
    rows = R.public_rows(named, epoch_time(AS_OF))
    return rows.select(
        *[c for c in rows.columns if not c.endswith("_at")], F.unix_micros("captured_at").alias("captured_us"),
        F.unix_micros("ingested_at").alias("ingested_us"),
    )


@query("dataset_versions", f"""
WITH {_OUTCOME_SQL}
SELECT source AS dataset, CASE WHEN lang = 'en' THEN '' ELSE lang END AS version, CASE WHEN lang <> 'fr' THEN 'cc-' || lang END AS license,
       count(*) AS num_images, 'gs://public/' || source AS gcs_prefix, {AS_OF}000000 AS normalized_us, 'http://' || source || ' | as found' AS notes
FROM t WHERE status = 'ok' GROUP BY source, lang""")
def dataset_versions(spark, sf):
    ok, _ = O.split_outcome(_outcome(spark, sf))
    described = ok.select(
        F.col("source").alias("run_dataset"), F.when(F.col("lang") != "en", F.col("lang")).alias("version"),
        F.when(F.col("lang") != "fr", F.concat(F.lit("cc-"), "lang")).otherwise("").alias("license"),
        F.concat(F.lit("gs://public/"), "source").alias("gcs_prefix"), F.concat(F.lit("http://"), "source").alias("source_url"),
        F.lit("as found").alias("notes"),
    )
    rows = R.dataset_rows(described, epoch_time(AS_OF))
    return rows.withColumn("normalized_us", F.unix_micros("normalized_at")).drop("normalized_at")


def _redacted(spark, sf):
    talk = table(spark, sf, "conversations")
    return talk.select(
        F.concat_ws("/", F.lit("user"), "conv_id", "turn").alias("image_id"), F.concat_ws("/", F.lit("gs://raw"), "conv_id", "turn").alias("raw_uri"),
        F.concat_ws("/", F.lit("gs://clean"), "conv_id", "turn").alias("clean_uri"), F.length("role").cast("bigint").alias("faces"),
        F.col("turn").alias("plates"), F.lit(64).cast("bigint").alias("width"), F.lit(48).cast("bigint").alias("height"),
        F.col("turn").cast("string").alias("frame_id"), F.col("role").alias("session_id"),
        F.concat(F.lit("usr_"), F.col("conv_id").cast("string")).alias("user_id"), epoch_time(F.col("conv_id")).alias("captured_at"),
    )


@query("audit_rows", f"""
SELECT 'user/' || conv_id || '/' || turn AS image_id, 'gs://raw/' || conv_id || '/' || turn AS raw_gcs_uri, 'gs://clean/' || conv_id || '/' || turn AS clean_gcs_uri,
       CAST(length(role) AS BIGINT) AS faces_blurred, turn AS plates_blurred, {AS_OF}000000 AS processed_us, 'detector-v1' AS model_version FROM conversations""")
def audit_rows(spark, sf):
    rows = R.audit_rows(_redacted(spark, sf), epoch_time(AS_OF), "detector-v1")
    return rows.withColumn("processed_us", F.unix_micros("processed_at")).drop("processed_at")


@query("user_rows", f"""
SELECT 'user/' || conv_id || '/' || turn AS image_id, 'user' AS source, 'user' AS dataset, 'gs://clean/' || conv_id || '/' || turn AS gcs_uri,
       CAST(64 AS BIGINT) AS width, CAST(48 AS BIGINT) AS height, CAST(turn AS VARCHAR) AS frame_id, role AS sequence_id, 'usr_' || conv_id AS user_id,
       conv_id * 1000000 AS captured_us, {AS_OF}000000 AS ingested_us, CAST(NULL AS VARCHAR) AS split FROM conversations""")
def user_rows(spark, sf):
    rows = R.user_rows(_redacted(spark, sf), epoch_time(AS_OF))
    return rows.withColumns({"captured_us": F.unix_micros("captured_at"), "ingested_us": F.unix_micros("ingested_at")}).drop("captured_at", "ingested_at")


# New manifest lines are the documents; the old lines are the labelled ones, a few strangers and blank lines, and a
# manifest that no new line names.
_MANIFEST_SQL = """new AS (SELECT lang || '/' || lang || '.txt' AS txt_rel, lang || '/images/' || source || '/' || doc_id || '.jpg' AS path FROM documents),
old AS (SELECT CASE WHEN toxic = 1 AND lang = 'de' THEN 'closed/closed.txt' ELSE lang || '/' || lang || '.txt' END AS txt_rel, CASE WHEN toxic = 1 AND lang <> 'de' THEN 'gone/' || doc_id WHEN quality = 0 THEN '' ELSE lang || '/images/' || source || '/' || doc_id || '.jpg' END AS path
        FROM documents JOIN labels USING (doc_id)),
merged AS (SELECT * FROM new UNION SELECT * FROM old WHERE path <> '' AND txt_rel IN (SELECT txt_rel FROM new))"""


def _manifest_lines(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", "lang").withColumns({
        "txt_rel": F.concat("lang", F.lit("/"), "lang", F.lit(".txt")),
        "path": F.concat("lang", F.lit("/images/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".jpg")),
    })
    stray = F.concat(F.lit("gone/"), F.col("doc_id").cast("string"))
    old_path = F.when((F.col("toxic") == 1) & (F.col("lang") != "de"), stray).when(F.col("quality") == 0, "").otherwise(F.col("path"))
    old_name = F.when((F.col("toxic") == 1) & (F.col("lang") == "de"), "closed/closed.txt").otherwise(F.col("txt_rel"))
    old = docs.join(table(spark, sf, "labels"), "doc_id").select(old_name.alias("txt_rel"), old_path.alias("path"))
    return docs.select("txt_rel", "path"), old


@query("manifest_lines", f"WITH {_MANIFEST_SQL} SELECT txt_rel, path FROM merged")
def manifest_lines(spark, sf):
    new, old = _manifest_lines(spark, sf)
    return M.merged_lines(new, old, M.manifest_names(new))


@query("manifest_changes", f"""
WITH {_MANIFEST_SQL}, kept AS (SELECT DISTINCT * FROM old WHERE path <> '')
SELECT m.txt_rel, count(*) AS lines, count(*) FILTER (WHERE k.path IS NULL) AS added, CAST(0 AS BIGINT) AS removed, count(*) FILTER (WHERE k.path IS NULL) > 0 AS changed
FROM merged m LEFT JOIN kept k ON k.txt_rel = m.txt_rel AND k.path = m.path GROUP BY m.txt_rel""")
def manifest_changes(spark, sf):
    new, old = _manifest_lines(spark, sf)
    return M.manifest_changes(M.merged_lines(new, old, M.manifest_names(new)), old)


@query("manifest_files", f"""
WITH {_MANIFEST_SQL}
SELECT txt_rel, count(*) AS lines, min(path) AS first_path, max(path) AS last_path, CAST(sum(length(path)) AS BIGINT) AS n_chars FROM merged GROUP BY txt_rel""")
def manifest_files(spark, sf):
    """Manifests written as sorted parts and read back; a second write finds nothing to change."""
    root = shared_dir(spark, "manifests")
    new, old = _manifest_lines(spark, sf)
    names = M.manifest_names(new)
    M.write_manifests(M.merged_lines(new, old, names), old, root)
    written = M.read_manifests(spark, root, names)
    again = M.write_manifests(M.merged_lines(new, written, names), written, root)
    lines = M.read_manifests(spark, root, [r.txt_rel for r in again.filter(~F.col("changed")).collect()])
    return lines.groupBy("txt_rel").agg(
        F.count("*").alias("lines"), F.min("path").alias("first_path"), F.max("path").alias("last_path"),
        F.sum(F.length("path")).alias("n_chars"),
    )


@query("seeded_sample", """
SELECT CAST(doc_id AS VARCHAR) AS image_id FROM documents ORDER BY md5(CAST(doc_id AS VARCHAR) || '#7'), image_id LIMIT 40""")
def seeded_sample(spark, sf):
    return PD.seeded_sample(_images(spark, sf).select("image_id"), "image_id", 40, seed=7)


@query("review_queue", f"""
SELECT CAST(event_id AS VARCHAR) AS image_id, 'gs://clean/' || event_id || '.lines.json' AS lines_gcs_uri, 'pending' AS status, round(value / 100, 6) AS confidence,
       user_id AS num_lines, {AS_OF}000000 AS created_us, CAST(NULL AS VARCHAR) AS reviewer FROM events WHERE value / 100 < 0.4""")
def review_queue(spark, sf):
    key = F.col("event_id").cast("string")
    labels = table(spark, sf, "events").select(
        key.alias("image_id"), F.concat(F.lit("gs://clean/"), key, F.lit(".lines.json")).alias("lines_gcs_uri"),
        (F.col("value") / 100).alias("confidence"), F.col("user_id").alias("num_lines"),
    )
    queue = RV.review_queue(labels, epoch_time(AS_OF))
    return queue.select(
        "image_id", "lines_gcs_uri", "status", F.round("confidence", 6).alias("confidence"), "num_lines",
        F.unix_micros("created_at").alias("created_us"), "reviewer",
    )


@query("review_counts", """
SELECT s.status, count(e.event_id) AS rows FROM (VALUES ('pending', 'view'), ('in_review', 'click'), ('reviewed', 'purchase'), ('rejected', 'refund')) s(status, kind)
LEFT JOIN events e ON e.event_type = s.kind GROUP BY s.status""")
def review_counts(spark, sf):
    kind = F.col("event_type")
    status = F.when(kind == "view", "pending").when(kind == "click", "in_review").when(kind == "purchase", "reviewed")
    return RV.review_counts(table(spark, sf, "events").select(status.alias("status")))


@query("every_nth_frame", """
SELECT user_id, event_id, position FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS position FROM events)
WHERE (position - 1) % 5 = 0""")
def every_nth_frame(spark, sf):
    """Every fifth event of a user; event numbers have gaps within a user and span several groups."""
    return S.every_nth(table(spark, sf, "events").select("user_id", "event_id"), "user_id", "event_id", "event_id", 5)


@query("session_labels", """
WITH l AS (SELECT conv_id, arg_min(text, turn) AS said FROM conversations WHERE role = 'assistant' GROUP BY conv_id)
SELECT conv_id, turn, md5(said) AS label FROM conversations LEFT JOIN l USING (conv_id)""")
def session_labels(spark, sf):
    """Every turn gets the label of its conversation's first answer."""
    talk = table(spark, sf, "conversations")
    labelled = talk.select("conv_id", "turn", F.when(F.col("role") == "assistant", F.md5("text")).alias("label"))
    return S.propagate(talk.select("conv_id", "turn"), labelled, "conv_id", [F.col("turn")], ["label"])


@query("session_representatives", """
SELECT user_id, min(event_id) AS event_id, arg_min(event_type, event_id) AS event_type FROM events GROUP BY user_id""")
def session_representatives(spark, sf):
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type")
    return S.representatives(events, "user_id", [F.col("event_id")])


@query("revoked_users", """
SELECT o_orderkey AS image_id FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def revoked_users(spark, sf):
    identity = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"), F.when(F.col("c_acctbal") < 0, epoch_time(AS_OF)).alias("revoked_at")
    )
    images = table(spark, sf, "orders").select(F.col("o_orderkey").alias("image_id"), F.col("o_custkey").alias("user_id"))
    return PD.without_revoked(images, identity).select("image_id")


@query("pseudonyms", "SELECT c_custkey, 'usr_' || sha256('pepper' || c_name) AS user_id FROM customer")
def pseudonyms(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", PD.pseudonym(F.col("c_name"), "pepper").alias("user_id"))
