"""Catalogue tables: keyed upsert, key de-duplication, union.

Plain Parquet takes no MERGE, so an upsert finds the partitions that hold matched keys by a join on the keys alone,
overwrites those partitions dynamically, and appends everything else. Tables are ordinary partitioned Parquet folders.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..schemas import TableSpec, align
from ..session import stage

# Fixed value: the folder Spark gives to rows whose partition value is NULL.
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _complete(keys: Sequence[str]) -> Column:
    """Whether all keys are known, as a conjunction that reaches the scan."""
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first by `order` (then by a hash of its content); rows with a NULL key are all kept.

    `min_by` is pre-aggregated in every task, so a key that fills a third of the table is shuffled as
    one row per task. The rank holds no second copy of the row.
    """
    columns = [F.col(c) for c in df.columns]
    rank = F.struct(*[o.alias(f"_o{i}") for i, o in enumerate(order)], F.xxhash64(*columns).alias("_hash"))
    best = df.filter(_complete(keys)).groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    first = best.agg(F.min_by(F.struct(*columns), rank).alias("_row")).select("_row.*")
    return first.unionByName(df.filter(~_complete(keys)))


def key_collisions(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    counts = df.filter(_complete(keys)).groupBy(*keys).agg(F.count("*").alias("rows"))
    return counts.filter(F.col("rows") > 1)


def overlay(target: DataFrame, source: DataFrame, spec: TableSpec) -> DataFrame:
    """Target after an upsert of `source`: matched rows replaced whole, columns absent from `source` NULL.

    NULL keys match nothing, so such rows are always added.
    """
    rows = align(source, spec.schema)
    kept = align(target, spec.schema).join(rows.select(*spec.key), list(spec.key), "left_anti")
    return kept.unionByName(rows)


def catalogue_union(*frames: DataFrame) -> DataFrame:
    """Rows of several frames in one; columns a frame lacks are NULL."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


class CatalogueTable:
    """A Parquet table at a folder URI that all executors share, partitioned as its spec says.

    One writer at a time: plain Parquet has no commit that two could compete for. Where tables have several writers, keep
    them with a table provider that has MERGE.
    """

    def __init__(self, spark: SparkSession, path: str, spec: TableSpec):
        self.spark, self.path, self.spec = spark, path.rstrip("/"), spec

    def _file_system(self, *names: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *names]))
        return path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), path

    def scan(self) -> DataFrame:
        """Current rows with the partition column, so that a filter on it prunes folders."""
        name, kind = self.spec.partition
        schema = T.StructType([*self.spec.schema.fields, T.StructField(name, kind)])
        fs, path = self._file_system()
        if not fs.exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path)

    def read(self) -> DataFrame:
        """Current rows."""
        return self.scan().select(*self.spec.schema.names)

    def upsert(self, rows: DataFrame, order: Sequence[Column] = ()) -> int:
        """Insert or replace rows by key; returns the number of rows sent. No rows, no write.

        Several rows with one key are reduced to the first by `order`. `rows` is passed over twice (rows with and
        without a complete key), so stage it first if it is costly. New keys only add files. What goes to other
        partitions is appended before the matched ones are overwritten, so a run that dies in between loses no row: a
        key that moved then stands in two partitions until its upsert is repeated, which every job here does.
        """
        wanted = [c for c in self.spec.schema.names if c in rows.columns]
        ranked = rows.select(*wanted, *[o.alias(f"_rank{i}") for i, o in enumerate(order)])
        single = align(dedup(ranked, self.spec.key, [F.col(f"_rank{i}") for i in range(len(order))]), self.spec.schema)
        part, _ = self.spec.partition
        source = stage(single.withColumn(part, self.spec.partition_value()), f"upsert-{self.spec.name}")
        # One row per partition that the rows go to, and below one per partition that holds one of their keys.
        sent = {r[part]: r["count"] for r in source.groupBy(part).count().collect()}
        if not sent:
            return 0
        stored, keys = self.scan(), list(self.spec.key)
        hits = stored.select(*keys, part).join(source.select(*keys), keys, "left_semi").groupBy(part).count()
        matched = {r[part]: r["count"] for r in hits.collect()}
        if not matched:
            self._write(source, "append")
            return sum(sent.values())
        here = reduce(lambda a, b: a | b, [F.col(part).eqNullSafe(F.lit(None))] * (None in matched) + [F.col(part).isin([p for p in matched if p is not None])])
        here = F.coalesce(here, F.lit(False))
        if sent.keys() - matched.keys():
            self._write(source.filter(~here), "append")
        stored = stored.filter(here)
        before = {r[part]: r["count"] for r in stored.groupBy(part).count().collect()}
        self._write(stored.join(source.select(*keys), keys, "left_anti").unionByName(source.filter(here)), "overwrite")
        # Rows move between partitions; one that got none is not overwritten and has to go.
        for value in matched.keys() - sent.keys():
            if matched[value] == before[value]:
                fs, path = self._file_system(f"{part}={_NULL_FOLDER if value is None else value}")
                fs.delete(path, True)
        return sum(sent.values())

    def _write(self, rows: DataFrame, mode: str) -> None:
        """Files of about the advisory size per partition, sorted so that scans skip row groups; a large partition is split."""
        part, _ = self.spec.partition
        even = rows.hint("rebalance", part).sortWithinPartitions(part, *self.spec.cluster)
        even.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(part).parquet(self.path)
