"""Cost, metrics, statistics and log enrichment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewarden.plans.ordered import one_group, ordered_columns
from lakewarden.plans.sizing import unique_by

# Fixed values.
COST_CENTER_PATTERN = "[A-Z]{5}-[0-9]{5}"
SAMPLING_PERIOD = "5 seconds"
MIN_UNITS, MAX_UNITS = 1, 20
USER_ACTIONS = ("create", "update", "delete")


def cost_by_tag(
    usage: DataFrame, tag: str, cost: str | Column, tags: str = "tags", pattern: str = COST_CENTER_PATTERN
) -> DataFrame:
    """Cost and rows per value of one tag.

    Rows without the tag are ``untagged``; values the pattern does not match as a whole are
    ``invalid``.
    """
    # A column of its own, so that the map is built and searched once per row.
    value = F.col("__value")
    bucket = (
        F.when(value.isNull() | (value == ""), "untagged")
        .when(~value.rlike(rf"\A(?:{pattern})\z"), "invalid")
        .otherwise(value)
    )
    amount = F.col(cost) if isinstance(cost, str) else cost
    return (
        usage.select(F.try_element_at(F.col(tags), F.lit(tag)).alias("__value"), amount.alias("__cost"))
        .select(bucket.alias("tag_value"), "__cost")
        .groupBy("tag_value")
        .agg(F.sum("__cost").alias("cost"), F.count(F.lit(1)).alias("rows"))
    )


def period_start(ts: str, period: str) -> Column:
    """Start of the tumbling window a time falls in."""
    return F.window(ts, period)["start"]


def resample_metrics(
    df: DataFrame, keys: Sequence[str], ts: str, value: str, seq: str, period: str = SAMPLING_PERIOD
) -> DataFrame:
    """One row per period and key: last, min, max and mean value and the number of samples.

    ``keys`` name the source instance and the metric; ``seq`` orders samples of equal time.
    """
    # A stream can close only windows it is grouped by as a whole; a batch needs their start alone.
    start = F.window(ts, period) if df.isStreaming else period_start(ts, period)
    resampled = df.groupBy(*keys, start.alias("period_start")).agg(
        F.max_by(value, F.struct(ts, seq)).alias("last_value"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
        F.avg(value).alias("mean_value"),
        F.count(value).alias("samples"),
    )
    if df.isStreaming:
        resampled = resampled.withColumn("period_start", F.col("period_start.start"))
    return resampled


def provisioning_stats(
    audit: DataFrame,
    cycle: str = "cycle_id",
    object_types: Sequence[str] = ("user", "group"),
    actions: Sequence[str] = USER_ACTIONS,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Per cycle, the number of each action on each object type, and the totals to date.

    ``audit`` has ``object_type`` and ``action``. The columns are ``<type>_<action>`` and
    ``<type>_<action>_to_date``. Counting comes first, so the running totals see one row per cycle.
    """
    pairs = {f"{t}_{a}": (F.col("object_type") == t) & (F.col("action") == a) for t in object_types for a in actions}
    per_cycle = audit.groupBy(cycle).agg(*[F.count_if(c).alias(name) for name, c in pairs.items()])
    # All cycles are one group, which is cut into stretches when it is large.
    one = per_cycle.withColumn("__all", one_group(cycle))
    before = {f"{name}_to_date": name for name in pairs}
    running = ordered_columns(one, ["__all"], [cycle], sum_before=before, rows_per_task=rows_per_task)
    return running.select(cycle, *pairs, *[(F.col(out) + F.col(name)).alias(out) for out, name in before.items()])


def run_outcomes(run_events: DataFrame, run: str = "run_id", ts: str = "ts", seq: str = "seq") -> DataFrame:
    """The outcome of each run by its latest event.

    ``run_events`` has ``end_time`` (0 while unfinished) and ``state`` with ``result_state``.
    """
    latest = run_events.groupBy(run).agg(
        F.max_by(F.struct("end_time", F.col("state.result_state").alias("result_state")), F.struct(ts, seq)).alias("l"),
        F.count(F.lit(1)).alias("polls"),
    )
    return latest.select(run, outcome(F.col("l.end_time"), F.col("l.result_state")).alias("outcome"), "polls")


def outcome(end_time: Column, result_state: Column) -> Column:
    """running, success or failed."""
    return (
        F.when(end_time.eqNullSafe(F.lit(0)), "running")
        .when(result_state.eqNullSafe(F.lit("SUCCESS")), "success")
        .otherwise("failed")
    )


def enrich_logs(logs: DataFrame, properties: DataFrame, log_key: str, property_key: str) -> DataFrame:
    """Each log row with the attributes of its cluster, nulls when the cluster is unknown."""
    attributes = unique_by(properties, [property_key], "properties")
    return logs.join(attributes, logs[log_key] == attributes[property_key], "left")


def throughput_need(
    events: DataFrame,
    ts: str,
    size: Column,
    *,
    window_seconds: int,
    unit_rate: float,
    lo: int = MIN_UNITS,
    hi: int = MAX_UNITS,
) -> DataFrame:
    """Per window: events, bytes, the throughput units needed and whether ``hi`` is not enough.

    One unit carries ``unit_rate`` bytes per second.
    """
    per_window = (
        events.select(period_start(ts, f"{window_seconds} seconds").alias("window_start"), size.alias("__bytes"))
        .groupBy("window_start")
        .agg(F.count(F.lit(1)).alias("events"), F.sum("__bytes").alias("bytes"))
    )
    wanted = F.ceil(F.col("bytes") / F.lit(float(window_seconds * unit_rate)))
    return per_window.select(
        "*",
        F.least(F.greatest(wanted, F.lit(lo)), F.lit(hi)).cast("bigint").alias("units"),
        (wanted > hi).alias("saturated"),
    )
