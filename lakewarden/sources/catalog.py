"""Datasets as tables of the session's catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def register_dataset(spark: SparkSession, path: str, table: str, fmt: str = "parquet") -> DataFrame:
    """Expose the dataset at ``path`` as external table ``table`` and return it.

    Dropping the table later keeps the files. Which metastore holds the entry is the session's
    choice (``spark.sql.catalogImplementation`` and the metastore settings). The partitions of a
    partitioned dataset are entered too. An external entry of that name is replaced; a view or a
    managed table, whose files would go with it, is an error.
    """
    if spark.catalog.tableExists(table):
        kind = spark.catalog.getTable(table).tableType
        if kind != "EXTERNAL":
            raise ValueError(f"{table} exists and is {kind}, not an external table")
        spark.sql(f"DROP TABLE {table}")
    spark.catalog.createTable(table, path=path, source=fmt)
    if any(c.isPartition for c in spark.catalog.listColumns(table)):
        spark.catalog.recoverPartitions(table)
    return spark.table(table)
