"""Change sets, create-or-update merges, drift, point-in-time state and versions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewarden.functions.columns import moment
from lakewarden.plans.ordered import ordered_columns
from lakewarden.plans.sizing import join_groups, keyed_by, unique_by


def sync_diff(source: DataFrame, target: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """What would make ``target`` equal ``source``: key, ``action`` and the columns' values.

    ``create`` for keys only in the source, ``delete`` for keys only in the target, ``update`` where
    any of ``cols`` differs (null equals null) and ``unchanged``. Values are the source's, or the
    target's for a delete. The job fails when a side has a key twice or a null one.
    """
    s = keyed_by(source, [key], "source").select(F.col(key).alias("__s"), F.struct(*cols).alias("__sv"))
    t = keyed_by(target, [key], "target").select(F.col(key).alias("__t"), F.struct(*cols).alias("__tv"))
    both = s.join(t, s["__s"] == t["__t"], "full")
    action = (
        F.when(F.col("__t").isNull(), "create")
        .when(F.col("__s").isNull(), "delete")
        .when(~F.col("__sv").eqNullSafe(F.col("__tv")), "update")
        .otherwise("unchanged")
    )
    gone = F.col("__s").isNull()
    return both.select(
        F.coalesce("__s", "__t").alias(key),
        action.alias("action"),
        *[F.when(gone, F.col(f"__tv.{c}")).otherwise(F.col(f"__sv.{c}")).alias(c) for c in cols],
    )


def _same_columns(target: DataFrame, source: DataFrame) -> None:
    if set(target.columns) != set(source.columns):
        raise ValueError(f"columns differ: {sorted(set(target.columns) ^ set(source.columns))}")


def upsert(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """``target`` with every row of ``source`` created, or replacing the row with the same key.

    The job fails when the source has a key twice or a null one. A small source is broadcast after Spark has
    checked its size, and then the target is not shuffled.
    """
    _same_columns(target, source)
    kept = target.join(source.select(key), key, "left_anti").select(*target.columns)
    return kept.unionByName(keyed_by(source, [key], "source"))


def insert_if_absent(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """``target`` unchanged, plus the rows of ``source`` whose key it does not have.

    The job fails when the source has a key twice or a null one. Only the source's keys found in the
    target take part in the second join, so a small source never moves the target.
    """
    _same_columns(target, source)
    there = join_groups(target.select(F.col(key).alias("__there")), source.select(F.col(key).alias("__wanted")).distinct(), [("__there", "__wanted")], "left_semi")
    new = keyed_by(source, [key], "source").join(there.distinct(), F.col(key) == F.col("__there"), "left_anti")
    return target.unionByName(new.select(*target.columns))


def apply_replacements(
    rules: DataFrame, replacements: DataFrame, name: str = "name", value: str = "value"
) -> DataFrame:
    """Set ``value`` where a replacement has exactly the row's name; other rows stay as they are."""
    new = unique_by(replacements.select(name, value), [name], "replacements").select(
        F.col(name).alias("__name"), F.col(value).alias("__value")
    )
    joined = rules.join(new, rules[name] == new["__name"], "left")
    return joined.select(
        *[F.coalesce(F.col("__value"), rules[c]).alias(c) if c == value else rules[c] for c in rules.columns]
    )


def unmatched_replacements(rules: DataFrame, replacements: DataFrame, name: str = "name") -> DataFrame:
    """Replacements no row has the name of."""
    used = rules.select(F.col(name).alias("__used")).distinct()
    return join_groups(replacements, used, [(name, "__used")], "left_anti")


def config_drift(
    docs: DataFrame, environments: Sequence[str], baseline: str, ignore: Iterable[str] = ()
) -> DataFrame:
    """Per path: each environment's value, ``missing`` environments and whether there is ``drift``.

    ``docs`` has ``env, path, value`` with one row per environment and path. Drift means that some
    environment lacks the path or differs from the baseline's value; a path the baseline alone
    lacks drifts too.
    """
    in_env = {e: F.col("env") == e for e in environments}
    per_path = (
        docs.filter(F.col("env").isin(list(environments)) & ~F.col("path").isin(list(ignore)))
        .groupBy("path")
        .agg(
            *[F.max(F.when(c, F.col("value"))).alias(e) for e, c in in_env.items()],
            *[F.max(F.when(c, F.lit(True))).alias(f"__has_{e}") for e, c in in_env.items()],
        )
    )
    missing = F.concat_ws(",", *[F.when(F.col(f"__has_{e}").isNull(), F.lit(e)) for e in environments])
    differs = missing != ""
    for e in environments:
        differs = differs | ~F.col(e).eqNullSafe(F.col(baseline))
    return per_path.select("path", *environments, missing.alias("missing"), differs.alias("drift"))


KEEP_DAYS = 7


def state_as_of(
    changes: DataFrame,
    key: str,
    ts: str,
    seq: str,
    as_of: datetime,
    *,
    now: datetime | None = None,
    keep_days: int = KEEP_DAYS,
    is_delete: Column | None = None,
) -> DataFrame:
    """The last change of each key at or before ``as_of``; keys whose last change deletes them are left out.

    Changes of equal time are ordered by ``seq``. With ``now`` given, an ``as_of`` more than
    ``keep_days`` before it is an error, because the changes needed may be gone.
    """
    if now is not None and as_of < now - timedelta(days=keep_days):
        raise ValueError(f"{as_of} is older than the {keep_days} days that changes are kept")
    if is_delete is not None:
        changes = changes.withColumn("__deletes", is_delete)
    latest = (
        changes.filter(F.col(ts) <= moment(as_of, changes.schema[ts].dataType))
        .groupBy(key)
        .agg(F.max_by(F.struct(*[c for c in changes.columns if c != key]), F.struct(ts, seq)).alias("__last"))
        .select(key, "__last.*")
    )
    if is_delete is not None:
        latest = latest.filter(~F.coalesce("__deletes", F.lit(False))).drop("__deletes")
    return latest


def version_history(
    changes: DataFrame, key: str, ts: str, seq: str, *, rows_per_task: int | None = None
) -> DataFrame:
    """Each change as a version: ``valid_from``, ``valid_to``, ``version_no`` and ``is_current``."""
    versions = ordered_columns(
        changes, [key], [ts, seq], number="version_no", following={"valid_to": ts}, rows_per_task=rows_per_task
    )
    return versions.withColumnRenamed(ts, "valid_from").withColumn("is_current", F.col("valid_to").isNull())
