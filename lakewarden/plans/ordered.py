"""Running sums, row numbers and next values per group, safe for groups of any size.

A plain window sends each group to one task. Here groups are cut into stretches of their order: a fixed share of all rows,
chosen by a hash of key and order, are the cuts, so large groups get many and small ones none. A row's stretch is the
number of its group's cuts up to it, found by halving. Rows are shuffled once, by key and stretch; each task works on its
own stretches, and the few totals per stretch are summed up beside it. How many groups there are, and how large, is never
asked: it is all one plan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakewarden.plans.sizing import null_safe

#: Rows of a stretch, about: a few times as many are very unlikely.
ROWS_PER_TASK = 5_000_000
#: Cuts per ``ROWS_PER_TASK`` rows of a group.
CUTS = 4
#: The steps of halving; a group has fewer cuts than twice the first.
HALVING = [2**i for i in reversed(range(24))]


def one_group(*columns: str) -> Column:
    """A key that all rows share, but no literal: joins on a literal are planned as nested loops."""
    return F.pmod(F.xxhash64(*columns), F.lit(1))


def _cuts_before(cuts: Column, at: Column) -> Column:
    """How many of the sorted ``cuts`` are at or before ``at``."""
    return F.aggregate(
        F.array(*map(F.lit, HALVING)),
        F.lit(0),
        lambda low, step: F.when(
            (low + step <= F.size(cuts)) & (F.try_element_at(cuts, low + step) <= at), low + step
        ).otherwise(low),
    )


def ordered_columns(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    *,
    sum_before: dict[str, str] | None = None,
    number: str | None = None,
    following: dict[str, str] | None = None,
    max_before: dict[str, str] | None = None,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Add order-dependent columns per group.

    ``sum_before`` maps an output column to the column whose sum over all earlier rows it gets,
    ``number`` names a 1-based row number, ``following`` maps an output column to the column whose
    value in the next row it gets, ``max_before`` one whose largest value in earlier rows it gets
    (null in the first). ``order`` must be a total order within a group; null keys are a
    group. ``df`` is read more than once and must give the same rows each time.
    """
    sums, nexts, tops = sum_before or {}, following or {}, max_before or {}
    share = max(1, (ROWS_PER_TASK if rows_per_task is None else rows_per_task) // CUTS)
    at = F.struct(*order)
    renamed = [f"__key_{i}" for i in range(len(keys))]
    pairs = list(zip(keys, renamed, strict=True))
    chosen = df.filter(F.pmod(F.xxhash64(*keys, *order), F.lit(share)) == 0)
    cuts = chosen.groupBy(*[F.col(k).alias(r) for k, r in pairs]).agg(F.sort_array(F.collect_list(at)).alias("__cuts"))

    def placed(rows: DataFrame, how: str) -> DataFrame:
        """Rows with their stretch; with ``inner``, only those of groups that are cut."""
        joined = rows.join(cuts, null_safe(rows, cuts, pairs), how)
        stretch = F.when(F.col("__cuts").isNull(), F.lit(0)).otherwise(_cuts_before(F.col("__cuts"), at))
        return joined.select(*[rows[c] for c in rows.columns], stretch.alias("__stretch"))

    local = _within(placed(df, "left"), [*keys, "__stretch"], order, sums, number, nexts, tops)
    needed = list(dict.fromkeys([*keys, *order, *sums.values(), *nexts.values(), *tops.values()]))
    totals = placed(df.select(*needed), "inner").groupBy(*[F.col(k).alias(r) for k, r in pairs], F.col("__stretch").alias("__at")).agg(
        F.count(F.lit(1)).alias("__count"),
        F.max(at).alias("__last"),
        *[F.sum(c).alias(f"__sum_{out}") for out, c in sums.items()],
        *[F.min_by(F.struct(c), at).alias(f"__first_{out}") for out, c in nexts.items()],
        *[F.max(c).alias(f"__max_{out}") for out, c in tops.items()],
    )
    by_stretch = Window.partitionBy(*renamed).orderBy("__at")
    earlier = by_stretch.rowsBetween(Window.unboundedPreceding, -1)
    # One row per stretch of a group that is cut.
    carried = totals.select(
        *renamed,
        "__at",
        "__last",
        F.sum("__count").over(earlier).alias("__before"),
        *[F.sum(f"__sum_{o}").over(earlier).alias(f"__carry_{o}") for o in sums],
        *[F.max(f"__max_{o}").over(earlier).alias(f"__top_{o}") for o in tops],
        *[F.lead(f"__first_{o}").over(by_stretch).getItem(c).alias(f"__next_{o}") for o, c in nexts.items()],
    )
    joined = local.join(carried, null_safe(local, carried, [*pairs, ("__stretch", "__at")]), "left")
    is_last = F.coalesce(F.struct(*[local[c] for c in order]) == carried["__last"], F.lit(False))
    none = F.lit(0)
    return joined.select(
        *[local[c] for c in df.columns],
        *[(local[o] + F.coalesce(carried[f"__carry_{o}"], none)).cast(local.schema[o].dataType).alias(o) for o in sums],
        *([(local[number] + F.coalesce(carried["__before"], none)).alias(number)] if number else []),
        *[F.when(is_last, carried[f"__next_{o}"]).otherwise(local[o]).alias(o) for o in nexts],
        # The larger one; nulls don't count.
        *[F.greatest(local[o], carried[f"__top_{o}"]).alias(o) for o in tops],
    )


def _within(df, keys, order, sums, number, nexts, tops):
    """The same columns by plain windows."""
    ordered = Window.partitionBy(*keys).orderBy(*order)
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    added = {o: F.coalesce(F.sum(c).over(earlier), F.lit(0)) for o, c in sums.items()}
    if number:
        added[number] = F.row_number().over(ordered).cast("bigint")
    added |= {o: F.lead(c).over(ordered) for o, c in nexts.items()}
    added |= {o: F.max(c).over(earlier) for o, c in tops.items()}
    return reduce(lambda d, item: d.withColumn(*item), added.items(), df)
