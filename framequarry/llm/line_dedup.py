"""Op 8: remove what repeats as three consecutive lines, with DataFrame operations only.

Every run of three lines that are not blank is hashed; of the places where a run stands, the first in the order of
(doc_id, text, line) stays, and the lines of all later places are merged into ranges and cut out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, Window

from .registry import column, query, read, text_key

#: Lines in a window.
WINDOW = 3


def later_windows(docs: DataFrame, window: int) -> DataFrame:
    """(doc_id, which, lo, hi) of every window that stands at an earlier place too; positions count all lines from 0."""
    filled = F.filter(
        F.transform(F.split("text", "\n"), lambda line, i: F.struct(F.btrim(line, F.lit(" \t\r")).alias("line"), i.alias("at"))),
        lambda x: x["line"] != "",
    )

    def run(i):
        at = [F.get("filled", i + j) for j in range(window)]
        lines = [x["line"] for x in at]
        return F.struct(
            F.xxhash64(*lines).alias("h1"), F.xxhash64(F.lit(window), *reversed(lines)).alias("h2"), at[0]["at"].alias("lo"), at[-1]["at"].alias("hi"),
        )

    placed = (
        docs.withColumn("filled", filled).where(F.size("filled") >= window)
        .select("doc_id", "which", F.explode(F.transform(F.sequence(F.lit(0), F.size("filled") - window), run)).alias("w")).select("doc_id", "which", "w.*")
    )
    place = F.struct("doc_id", "which", "lo")
    first = placed.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").select("h1", "h2", "first")
    return placed.join(first, ["h1", "h2"]).where(place > F.col("first")).select("doc_id", "which", "lo", "hi").distinct()


def drop_repeated_lines(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW) -> DataFrame:
    """The columns of `df` with the text reduced, and n_lines_removed.

    Lines end at \\n; blank lines are passed over in windows and go with a range that holds them. Lines are compared
    without outer blanks. A text with fewer than three lines that are not blank has no window and stays as it is, as do
    null and empty texts; a text all of whose lines go is empty, its row stays. Rows with one id and one text are one
    document and get the same result; a null id comes first in the order. An empty table gives an empty table.
    Extra columns are passed on; their names may be those used here, but an n_lines_removed of `df` is replaced.
    """
    text = column(df, text_column)
    docs = df.select(column(df, id_column).alias("doc_id"), text_key(text).alias("which"), text.alias("text"))
    within = Window.partitionBy("doc_id", "which").orderBy("lo", "hi")
    islands = (
        later_windows(docs, window)
        .withColumn("reached", F.max("hi").over(within.rowsBetween(Window.unboundedPreceding, -1)))
        .withColumn("island", F.sum(F.when(F.col("lo") <= F.col("reached") + 1, 0).otherwise(1)).over(within))
        .groupBy("doc_id", "which", "island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        .groupBy("doc_id", "which").agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("cut"))
    )
    # The text travels once, as a field of its row.
    row = df.select(F.struct(*[column(df, c) for c in df.columns]).alias("row"), column(df, id_column).alias("doc_id"), text_key(text).alias("which"))
    found = row.alias("r").join(
        islands.alias("i"), F.col("r.doc_id").eqNullSafe(F.col("i.doc_id")) & (F.col("r.which") == F.col("i.which")), "left",
    ).select("row", "cut").withColumn("text", F.col("row").getField(text_column)).withColumn("lines", F.split("text", "\n"))

    def kept(i):
        start = F.when(i == 0, F.lit(0)).otherwise(F.get("cut", i - 1)["hi"] + 1)
        end = F.when(i == F.size("cut"), F.size("lines")).otherwise(F.get("cut", i)["lo"])
        return F.slice("lines", start + 1, F.greatest(end - start, F.lit(0)))

    reduced = F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size("cut")), kept)), "\n")
    removed = F.aggregate("cut", F.lit(0), lambda n, c: n + c["hi"] - c["lo"] + 1)
    return found.select(
        *[
            F.when(F.col("cut").isNull(), F.col("text")).otherwise(reduced).alias(c) if c == text_column else F.col("row").getField(c).alias(c)
            for c in df.columns if c != "n_lines_removed"
        ],
        F.when(F.col("cut").isNull(), 0).otherwise(removed).cast("long").alias("n_lines_removed"),
    )


#: {documents}: a table or sub-query of documents.
LINES_SQL = """
WITH src AS (SELECT *, string_split(text, chr(10)) AS ls FROM {documents}
), filled AS (
  SELECT doc_id, list_filter(list_transform(range(1, len(ls) + 1), lambda i: {{'t': trim(ls[i], ' ' || chr(9) || chr(13)), 'at': i}}), lambda x: x.t <> '') AS f FROM src
), places AS (
  SELECT doc_id, f[i].at AS lo, f[i + 2].at AS hi, f[i].t || chr(10) || f[i + 1].t || chr(10) || f[i + 2].t AS w
  FROM (SELECT doc_id, f, unnest(range(1, len(f) - 1)) AS i FROM filled)
), later AS (SELECT doc_id, lo, hi FROM (SELECT *, row_number() OVER (PARTITION BY w ORDER BY doc_id, lo) AS k FROM places) WHERE k > 1
), gone AS (SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, unnest(range(lo, hi + 1)) AS p FROM later) GROUP BY doc_id
)
SELECT doc_id, CASE WHEN ps IS NULL THEN text
    ELSE coalesce(array_to_string(list_transform(list_filter(range(1, len(ls) + 1), lambda i: NOT list_contains(ps, i)), lambda i: ls[i]), chr(10)), '') END AS text,
  lang, source, n_chars, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_lines_removed
FROM src LEFT JOIN gone USING (doc_id)
"""


@query("op8_line_dedup", LINES_SQL.format(documents="documents"))
def op8_line_dedup(spark, sf_dir):
    return drop_repeated_lines(read(spark, sf_dir, "documents"))
