"""Checks that bound what reaches the driver, a literal or a broadcast."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


HASHED_TYPES = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType,
)


def rows_at_most(df: DataFrame, limit: int) -> list[Row] | None:
    """The rows of ``df`` when there are at most ``limit`` of them, else None.

    The driver never receives more than ``limit + 1`` rows.
    """
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def unique_by(df: DataFrame, keys: list[str], what: str) -> DataFrame:
    """``df`` itself; the job fails when a key occurs twice.

    The check is a value the plan computes beside the rows, not a step they pass through: an
    aggregation between the rows and a join would keep Spark from splitting skewed partitions there.
    """
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1")
    number = repeated.agg(F.count(F.lit(1))).scalar()
    message = F.lit(f"{what}: duplicate key ({', '.join(keys)})")
    return df.filter(F.when(number > 0, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))


def keyed_by(df: DataFrame, keys: list[str], what: str) -> DataFrame:
    """``df`` itself; the job fails when a key occurs twice or is null."""
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    message = F.lit(f"{what}: null key ({', '.join(keys)})")
    return unique_by(df, keys, what).filter(F.when(missing, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))


def join_groups(
    left: DataFrame, groups: DataFrame, pairs: list[tuple[str, str]], how: str = "inner", nulls: bool = False
) -> DataFrame:
    """Join rows to the result of grouping by the very keys joined on (``nulls``: null equals null).

    One key may hold much of ``left``. Spark splits such a partition only between two plain
    shuffles, but the groups come partitioned by the keys already and get none. The hash among the
    join keys makes Spark shuffle the groups, the smaller side, once more. It is left out where equal
    values may have unequal hashes: keys of different types, fractions, collated text.
    """
    kinds = [(left.schema[a].dataType, groups.schema[b].dataType) for a, b in pairs]
    condition = F.lit(True)
    if all(a == b and (isinstance(a, HASHED_TYPES) or a == T.StringType()) for a, b in kinds):
        condition = F.xxhash64(*[left[a] for a, _ in pairs]) == F.xxhash64(*[groups[b] for _, b in pairs])
    for a, b in pairs:
        condition = condition & (left[a].eqNullSafe(groups[b]) if nulls else left[a] == groups[b])
    return left.join(groups, condition, how)


def null_safe(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    """Join condition that treats two nulls as equal."""
    condition = F.lit(True)
    for a, b in pairs:
        condition = condition & left[a].eqNullSafe(right[b])
    return condition


def local_table(spark: SparkSession, rows: Iterable[tuple], schema: str | T.StructType) -> DataFrame:
    """A table of a few rows whose size Spark knows, so that it can decide to broadcast it.

    ``spark.createDataFrame`` on a list gives an RDD of unknown size, which joins by a shuffle.
    """
    fields = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    arrow = to_arrow_schema(fields)
    arrays = [pa.array(list(c), type=f.type) for c, f in zip(columns, arrow, strict=True)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), fields)
