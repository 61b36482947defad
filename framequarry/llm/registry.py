"""Registered corpus queries and small helpers for rows and columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import use_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of (spark, folder of the tables) and, where there is one, the SQL for the same rows."""

    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(use_utc(spark), sf_dir)

        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return function

    return register


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    found = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return found.select(*columns) if columns else found


def column(df: DataFrame, name: str) -> Column:
    """Column by its exact name, also where names hold dots."""
    return df["`" + name.replace("`", "``") + "`"]


def renamed(df: DataFrame, **names: str) -> DataFrame:
    """Only the named columns, under our own names: extra columns and their names cannot clash."""
    return df.select(*[column(df, theirs).alias(ours) for ours, theirs in names.items()])


def text_key(df_text: Column) -> Column:
    """Tells rows with one id and different texts apart; rows alike in both are one document."""
    return F.xxhash64(F.coalesce(df_text, F.lit("")), df_text.isNull())


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once per row, also where `body` uses it for each element of an array."""
    return F.get(F.transform(F.array(value), body), 0)


_SIMPLE = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(),
}


def arrow_schema(ddl: str) -> pa.Schema:
    """Arrow's form of `name type, ...`, for use in tasks, where Spark's own parser is not at hand."""

    def kind(name: str) -> pa.DataType:
        return pa.list_(kind(name[6:-1])) if name.startswith("array<") else _SIMPLE[name]

    return pa.schema([pa.field(*(f(x) for f, x in zip((str, kind), part.split()))) for part in ddl.split(",")])


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """`mapInArrow` with a function of one batch."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from function(batch)

    return df.mapInArrow(run, schema)


def batch(schema: str, *columns) -> pa.RecordBatch:
    target = arrow_schema(schema)
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) and c.type == f.type else pa.array(c, f.type) for c, f in zip(columns, target)], schema=target
    )
