"""Registered queries: name, function of (spark, folder of the tables), and the checking SQL if there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, types as T

from ..session import use_utc

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(use_utc(spark), sf_dir)

        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Input table; time stamps without a zone are read as UTC, so filters on them still reach the scan."""
    path = f"{sf_dir}/{name}.parquet"
    found = spark.read.parquet(path)
    fields = [
        T.StructField(f.name, T.TimestampType() if isinstance(f.dataType, T.TimestampNTZType) else f.dataType)
        for f in found.schema.fields
    ]
    return spark.read.schema(T.StructType(fields)).parquet(path)
