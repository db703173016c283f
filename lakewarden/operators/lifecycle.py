"""Tiering, retention and size limits of stored objects."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewarden.functions.columns import moment
from lakewarden.plans.ordered import ordered_columns
from lakewarden.plans.sizing import join_groups, unique_by

# The actions in rising severity, and the days after which each applies.
ACTIONS = ("hot", "cool", "archive", "delete")
COOL_DAYS, ARCHIVE_DAYS, DELETE_DAYS = 90, 365, 730
BASIS_COLUMNS = {"modified": "modified_at", "created": "created_at", "accessed": "last_access"}


@dataclass(frozen=True)
class LifecycleRule:
    """Days since ``basis`` (modified, created or accessed) after which objects of ``kind`` move on.

    ``kind`` is base, snapshot or version; no prefixes means all paths; a threshold of None is off.
    """

    name: str
    kind: str
    basis: str
    cool_days: int | None = COOL_DAYS
    archive_days: int | None = None
    delete_days: int | None = None
    blob_types: Sequence[str] = ("blockBlob",)
    prefix_match: Sequence[str] = ()
    enabled: bool = True


def default_rules(archive: bool = False, delete: bool = False) -> list[LifecycleRule]:
    """The default policy; archiving and deleting are off unless asked for."""
    days = {"archive_days": ARCHIVE_DAYS if archive else None, "delete_days": DELETE_DAYS if delete else None}
    return [
        LifecycleRule("base", "base", "modified", **days),
        LifecycleRule("snapshot", "snapshot", "created", **days),
        LifecycleRule("version", "version", "created", **days),
    ]


def lifecycle_rules(rules: DataFrame) -> list[LifecycleRule]:
    """The rules of a table with the columns of ``LifecycleRule``, of any length; lists may be null.

    The plan names each rule; ``lifecycle_action`` puts them into columns of a few rules each.
    """
    lists = {"blob_types", "prefix_match"}
    return [
        LifecycleRule(**{k: tuple(v or ()) if k in lists else v for k, v in row.asDict().items()}) for row in rules.collect()
    ]


# Rules put into one expression; the next ones start another column.
RULES_PER_STEP = 50


def lifecycle_action(inventory: DataFrame, rules: Sequence[LifecycleRule], as_of: datetime) -> DataFrame:
    """Add ``action``: hot, cool, archive or delete.

    ``inventory`` has ``path, blob_type, kind`` and the time columns the rules use. An object must be
    older than a threshold, strictly; of all thresholds exceeded under all enabled rules the most
    severe wins. An object never accessed counts from its modification.
    """
    active = [r for r in rules if r.enabled]
    judged = inventory.withColumn("__severity", F.lit(0))
    for first in range(0, len(active), RULES_PER_STEP):
        step = [F.col("__severity"), F.lit(0), *_severities(inventory, active[first : first + RULES_PER_STEP], as_of)]
        judged = judged.withColumn("__severity", F.greatest(*step))
    names = F.array(*[F.lit(a) for a in ACTIONS])
    return judged.select(*[F.col(c) for c in inventory.columns], F.get(names, "__severity").alias("action"))


def _severities(inventory: DataFrame, rules: Sequence[LifecycleRule], as_of: datetime) -> list[Column]:
    """Per rule, the position in ``ACTIONS`` of what it asks for."""
    severity = []
    for rule in rules:
        column = BASIS_COLUMNS[rule.basis]
        since = F.col(column)
        if rule.basis == "accessed":
            since = F.coalesce(since, F.col("modified_at"))
        applies = (F.col("kind") == rule.kind) & F.col("blob_type").isin(list(rule.blob_types))
        if rule.prefix_match:
            prefixed = F.lit(False)
            for prefix in rule.prefix_match:
                prefixed = prefixed | F.startswith(F.col("path"), F.lit(prefix))
            applies = applies & prefixed
        reached = None
        for level, days in ((3, rule.delete_days), (2, rule.archive_days), (1, rule.cool_days)):
            if days is not None:
                older = since < moment(as_of - timedelta(days=days), inventory.schema[column].dataType)
                reached = F.when(applies & older, level) if reached is None else reached.when(applies & older, level)
        if reached is not None:
            severity.append(reached.otherwise(0))
    return severity


def lifecycle_summary(actions: DataFrame) -> DataFrame:
    """Objects and bytes by container, kind and action, with subtotals.

    ``level`` is 0 for a full group, 1 for a container and kind, 3 for a container, 7 for the total.
    """
    # Only the few full groups are rolled up: a rollup of the objects would first make four rows of each.
    groups = actions.groupBy("container", "kind", "action").agg(
        F.count(F.lit(1)).alias("objects"), F.sum("bytes").alias("bytes")
    )
    return groups.rollup("container", "kind", "action").agg(
        F.grouping_id().cast("bigint").alias("level"),
        F.sum("objects").alias("objects"),
        F.sum("bytes").alias("bytes"),
    )


def last_access(access_log: DataFrame, path: str, ts: str, granularity: str = "day") -> DataFrame:
    """Last access per path, cut to the granularity: ``path, last_access``."""
    kind = access_log.schema[ts].dataType
    return (
        access_log.groupBy(F.col(path).alias("path"))
        .agg(F.max(ts).alias("__last"))
        .select("path", F.date_trunc(granularity, "__last").cast(kind).alias("last_access"))
    )


def with_last_access(inventory: DataFrame, accesses: DataFrame) -> DataFrame:
    """The inventory with each object's ``last_access``, null when there was none."""
    return inventory.join(accesses, "path", "left")


# Days kept.
RETENTION_DAYS = {"containers": 7, "vault": 7, "database_backup": 7, "logs": 120, "stream": 3}


def retention_sweep(
    df: DataFrame, policies: DataFrame, as_of: datetime, dataset: str, ts: str, deleted_at: str | None = None
) -> DataFrame:
    """Add ``disposition`` by the retention period of the row's dataset (``policies``: dataset, days).

    Rows older than the period are ``purge``, others ``keep``. With ``deleted_at`` rows not deleted
    are ``keep``; deleted ones are ``recoverable`` within the period and ``purge`` after it. A
    dataset without a policy is kept.
    """
    periods = unique_by(policies.select("dataset", "days"), ["dataset"], "policies").select(
        F.col("dataset").alias("__dataset"), F.col("days").alias("__days")
    )
    column = deleted_at or ts
    joined = df.join(periods, df[dataset] == periods["__dataset"], "left")
    cutoff = moment(as_of, df.schema[column].dataType) - F.make_interval(days=F.col("__days"))
    past = F.coalesce(F.col(column) < cutoff, F.lit(False))
    if deleted_at is None:
        disposition = F.when(past, "purge").otherwise("keep")
    else:
        disposition = (
            F.when(F.col(deleted_at).isNull() | F.col("__days").isNull(), "keep")
            .when(past, "purge")
            .otherwise("recoverable")
        )
    return joined.select(*[df[c] for c in df.columns], disposition.alias("disposition"))


# Bytes.
DATABASE_LIMIT_BYTES = 524_288_000
SERVER_LIMIT_BYTES = 5_120 * 1024 * 1024


def file_size_limits(
    inventory: DataFrame,
    limits: DataFrame,
    *,
    dataset: str,
    size: str,
    order: Sequence[str],
    rows_per_task: int | None = None,
) -> DataFrame:
    """Objects beyond their dataset's cap, in order: those after which the running total exceeds it.

    ``limits`` has ``dataset`` and ``max_bytes``. Added: ``bytes_before``, ``bytes_to_here``,
    ``max_bytes`` and ``crosses`` for the first object beyond the cap. Datasets within their cap, and
    those without one, give no row. An object of unknown size counts as empty and stays.
    """
    caps = unique_by(limits.select("dataset", "max_bytes"), ["dataset"], "limits").select(
        F.col("dataset").alias("__dataset"), "max_bytes"
    )
    totals = inventory.groupBy(F.col(dataset).alias("__dataset")).agg(F.sum(size).alias("__total"))
    over = totals.join(caps, "__dataset").filter(F.col("__total") > F.col("max_bytes"))
    affected = join_groups(inventory, over.select("__dataset", "max_bytes"), [(dataset, "__dataset")]).drop("__dataset")
    running = ordered_columns(
        affected, [dataset], list(order), sum_before={"bytes_before": size}, rows_per_task=rows_per_task
    )
    to_here = F.col("bytes_before") + F.coalesce(F.col(size), F.lit(0))
    beyond = running.withColumn("bytes_to_here", to_here).filter(F.col("bytes_to_here") > F.col("max_bytes"))
    return beyond.withColumn("crosses", F.col("bytes_before") <= F.col("max_bytes"))

