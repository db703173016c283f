"""The registered queries: each runs one operator over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from lakewarden.session import shared_dir

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
SQL: dict[str, str] = {}

AS_OF_ORDERS = datetime(2001, 8, 2)
AS_OF_EVENTS = datetime(2024, 1, 31)


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query, with equal SQL where there is one."""

    def register(run: Run) -> Run:
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder in the place all executors share."""
    return f"{shared_dir(spark).rstrip('/')}/{uuid.uuid4().hex}"


def events_path(sf_dir: str) -> str:
    """The events as a stream source: a pattern, which may match one file as well as a folder."""
    return f"{sf_dir}/events.[p]arquet"
