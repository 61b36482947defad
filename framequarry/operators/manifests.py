"""Split manifests: the sorted list of a split's image paths.

A manifest may name a third of all images, so it is never one string in one row: it is a set of
(manifest, path) rows, written as sorted text parts under a folder with the manifest's name. Reading
the folder as text, or joining the parts in name order, gives the list. Beside a manifest stands a fingerprint of the lines
that were merged into it last, whatever their order: when the same come again, none of the old lines is read.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import stage

#: Stands after the name of a manifest that is being replaced.
REPLACED = ".replaced-"


def manifest_names(new: DataFrame) -> list[str]:
    """Manifests that get lines: one per split and test category, so a handful."""
    return sorted(r.txt_rel for r in new.select("txt_rel").distinct().collect())


def merged_lines(new: DataFrame, old: DataFrame | None, names: list[str]) -> DataFrame:
    """Distinct (txt_rel, path) of the new and the old lines; blank old lines are dropped.

    Only the manifests in `names` are listed. Without `old` the manifests are replaced.
    """
    lines = new.select("txt_rel", "path")
    if old is not None:
        kept = old.filter((F.col("path") != "") & F.col("txt_rel").isin(names))
        lines = lines.unionByName(kept.select("txt_rel", "path"))
    return lines.distinct()


def fingerprints(lines: DataFrame) -> dict[str, list[str]]:
    """{manifest: number, sum and xor of the line hashes} of distinct (txt_rel, path) rows; one row per manifest comes back."""
    hashed = lines.select("txt_rel", F.xxhash64("path").alias("h"), F.xxhash64(F.lit(1), "path").alias("g"))
    # Hashes are added in halves, so that the sums of any number of lines stay exact.
    sums = [F.sum(F.shiftrightunsigned("g", 32)).cast("string"), F.sum(F.col("g").bitwiseAND(0xFFFFFFFF)).cast("string")]
    found = hashed.groupBy("txt_rel").agg(F.array(F.count("*").cast("string"), *sums, F.bit_xor("h").cast("string")).alias("print"))
    return {r.txt_rel: list(r["print"]) for r in found.collect()}


def _beside(root: str, name: str) -> str:
    folder, _, last = f"{root.rstrip('/')}/{name}".rpartition("/")
    return f"{folder}/.{last}.fingerprint"


def _parts(spark: SparkSession, target: str) -> list[list]:
    """Names, lengths and times of a manifest's files: a fingerprint holds for those it was made for."""
    fs, path = _file_system(spark, target)
    files = fs.listStatus(path) if fs.exists(path) else []
    return sorted([f.getPath().getName(), f.getLen(), f.getModificationTime()] for f in files)


def unchanged(spark: SparkSession, prints: dict[str, list[str]], root: str) -> set[str]:
    """The manifests that hold the lines with these fingerprints already, and that nobody has touched since."""
    same = set()
    for name, lines in prints.items():
        target = f"{root.rstrip('/')}/{name}"
        fs, path = _file_system(spark, _beside(root, name))
        if fs.exists(path) and not _left_behind(spark, target):
            stream = fs.open(path)
            told = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
            stream.close()
            if told == {"lines": lines, "parts": _parts(spark, target)}:
                same.add(name)
    return same


def remember(spark: SparkSession, prints: dict[str, list[str]], root: str) -> None:
    """Note the fingerprints of lines that the manifests now hold."""
    for name, lines in prints.items():
        fs, path = _file_system(spark, _beside(root, name))
        out = fs.create(path, True)
        out.write(bytearray(json.dumps({"lines": lines, "parts": _parts(spark, f"{root.rstrip('/')}/{name}")}).encode()))
        out.close()


def manifest_changes(merged: DataFrame, old: DataFrame) -> DataFrame:
    """Per manifest: its lines, how many are new or gone, and whether it must be written."""
    marked = merged.withColumn("_new", F.lit(1)).join(
        old.filter(F.col("path") != "").distinct().withColumn("_old", F.lit(1)), ["txt_rel", "path"], "full"
    )
    counts = marked.groupBy("txt_rel").agg(
        F.count("_new").alias("lines"),
        F.count_if(F.col("_old").isNull()).alias("added"),
        F.count_if(F.col("_new").isNull()).alias("removed"),
    )
    return counts.filter(F.col("lines") > 0).withColumn("changed", (F.col("added") > 0) | (F.col("removed") > 0))


def write_manifests(merged: DataFrame, old: DataFrame, root: str) -> DataFrame:
    """Write every changed manifest below `root`; returns the change report. Without a change nothing is written.

    All manifests are written by one job into a new folder and then put into place one by one. Old lines are deleted
    only when the new ones are in place, and `read_manifests` reads what is left of both, so a run that dies at any
    point loses no line; the next run that changes the manifest removes what is left.
    """
    spark = merged.sparkSession
    lines = stage(merged, "manifest-lines", "txt_rel")
    report = stage(manifest_changes(lines, old), "manifest-report")
    # One per split and test category.
    names = sorted(r.txt_rel for r in report.filter("changed").select("txt_rel").collect())
    if not names:
        return report
    root = root.rstrip("/")
    written = f"{root}/_manifests-{uuid.uuid4().hex}"
    number = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("txt_rel"))
    numbered = lines.select(number.alias("number"), "path").filter("number > 0")
    # Parts are numbered in the order of the ranges, so a manifest's parts in name order are sorted.
    numbered.repartitionByRange("number", "path").sortWithinPartitions("number", "path").write.partitionBy("number").text(written)
    for i, name in enumerate(names, 1):
        _put_in_place(spark, f"{written}/number={i}", f"{root}/{name}")
    fs, path = _file_system(spark, written)
    fs.delete(path, True)
    return report


def _file_system(spark: SparkSession, uri: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), path


def _left_behind(spark: SparkSession, target: str) -> list[str]:
    """Replaced manifests whose successor may not have come into place."""
    fs, folder = _file_system(spark, target.rpartition("/")[0])
    name = target.rpartition("/")[2]
    found = fs.listStatus(folder) if fs.exists(folder) else []
    return sorted(f"{target.rpartition('/')[0]}/{s.getPath().getName()}" for s in found if s.getPath().getName().startswith(f"{name}{REPLACED}"))


def _put_in_place(spark: SparkSession, new: str, target: str) -> None:
    fs, path = _file_system(spark, target)
    fs.mkdirs(path.getParent())
    moves = [(new, target)]
    if fs.exists(path):
        moves.insert(0, (target, f"{target}{REPLACED}{uuid.uuid4().hex}"))
    for source, to in moves:
        if not fs.rename(_file_system(spark, source)[1], _file_system(spark, to)[1]):
            raise OSError(f"{source} could not be renamed to {to}")
    for replaced in _left_behind(spark, target):
        fs.delete(_file_system(spark, replaced)[1], True)


def read_manifests(spark: SparkSession, root: str, names: list[str]) -> DataFrame:
    """Lines of the named manifests (files or folders of parts) as (txt_rel, path) rows; a missing one has none."""
    out = spark.createDataFrame([], "txt_rel string, path string")
    for name in names:
        target = f"{root.rstrip('/')}/{name}"
        fs, path = _file_system(spark, target)
        replaced = _left_behind(spark, target)
        found = [target] * fs.exists(path) + replaced
        if found:
            lines = spark.read.text(found)
            out = out.unionByName((lines.distinct() if replaced else lines).select(F.lit(name).alias("txt_rel"), F.col("value").alias("path")))
    return out
