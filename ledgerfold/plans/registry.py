"""Queries by name, each beside the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"two queries are named {name}")
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


#: Tables whose rows cost enough to be worth a task of their own, with their key.
HEAVY = {"documents": "doc_id", "pages": "page_id"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df, HEAVY[name]) if name in HEAVY else df


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows over all cores when the scan has fewer tasks than that: a single small file
    would otherwise keep one core busy. A scan of many splits is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df
