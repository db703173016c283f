"""Partitioned reads from, and writes to, a relational store over JDBC.

Not exercised here against a live database; tests check the options handed to Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession, url: str, table: str, key: str, bounds: tuple[int, int], n: int, **options: str
) -> DataFrame:
    """Read ``table`` in ``n`` parallel slices of ``key``; rows outside ``bounds`` are read as well."""
    low, high = bounds
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=key, lowerBound=low, upperBound=high, numPartitions=n)
        .options(**options)
        .load()
    )


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", n: int = 8, **options: str) -> None:
    """Write ``df`` to ``table`` over at most ``n`` connections at a time."""
    df.write.format("jdbc").mode(mode).options(url=url, dbtable=table, numPartitions=n).options(**options).save()
