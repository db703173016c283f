"""Large groups, split over several tasks, against plain windows."""

import pytest
from pyspark.sql import functions as F

from lakewarden.operators.monitor import provisioning_stats
from lakewarden.plans import ordered
from lakewarden.plans.ordered import ordered_columns

WANTED = {"sum_before": {"before": "v"}, "number": "n", "following": {"next_id": "id"}, "max_before": {"top": "v"}}


def skewed(spark):
    """A third of the rows under one key, another large group under null, equal order values throughout."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 50))
    return spark.range(6000).select(key.alias("k"), (F.col("id") % 2).alias("t"), "id", (F.col("id") % 7).alias("v"))


@pytest.mark.parametrize("rows_per_task", [10, 150, 1999, 2000])
def test_split_groups_equal_plain_windows(spark, rows_per_task):
    df = skewed(spark)
    plain = ordered_columns(df, ["k"], ["t", "id"], **WANTED)
    split = ordered_columns(df, ["k"], ["t", "id"], rows_per_task=rows_per_task, **WANTED)
    assert plain.schema == split.schema
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, split.collect()))


def test_a_large_group_spans_several_tasks(spark):
    df = skewed(spark).filter("k = 'hot'")
    split = ordered_columns(df, ["k"], ["t", "id"], rows_per_task=100, **WANTED).withColumn("task", F.spark_partition_id())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert split.select("task").distinct().count() > 4
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_very_many_large_groups(spark):
    """Twenty thousand groups, every one of them cut, without a list of them."""
    df = spark.range(100_000).select((F.col("id") % 20_000).alias("k"), (-F.col("id")).alias("t"), "id", (F.col("id") % 7).alias("v"))
    plain = ordered_columns(df, ["k"], ["t"], **WANTED)
    split = ordered_columns(df, ["k"], ["t"], rows_per_task=2, **WANTED)
    names = ["k", "id", "before", "n", "next_id", "top"]
    assert split.exceptAll(plain).select(names).isEmpty() and plain.exceptAll(split).select(names).isEmpty()


def test_cuts_before(spark):
    cuts = [1, 4, 4, 9, 12, 30, 31]
    df = spark.range(-1, 40).select("id", F.array(*[F.struct(F.lit(c).cast("long").alias("id")) for c in cuts]).alias("cuts"))
    got = df.select("id", ordered._cuts_before(F.col("cuts"), F.struct("id")).alias("n")).collect()
    assert {r["id"]: r["n"] for r in got} == {i: sum(c <= i for c in cuts) for i in range(-1, 40)}


def test_planning_runs_no_job(spark, tmp_path):
    skewed(spark).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    spark.sparkContext.setJobGroup("ordered", "planning")
    try:
        result = ordered_columns(df, ["k"], ["t", "id"], **WANTED)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("ordered")
        result.collect()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # Without cuts the joins are gone from the plan that ran: one shuffle of the rows, to the windows.
    final = result._jdf.queryExecution().executedPlan().toString()
    final = final[final.index("Final Plan") : final.index("Initial Plan")]
    assert "Join" not in final


@pytest.mark.parametrize("rows_per_task", [None, 2])
def test_totals_to_date_over_many_cycles(spark, rows_per_task):
    audit = spark.range(300).select((F.col("id") % 50).alias("cycle_id"), F.lit("user").alias("object_type"), F.when(F.col("id") % 3 == 0, "create").otherwise("update").alias("action"))
    got = {r["cycle_id"]: (r["user_create"], r["user_create_to_date"], r["group_delete_to_date"]) for r in provisioning_stats(audit, rows_per_task=rows_per_task).collect()}
    own = {c: sum(i % 3 == 0 for i in range(300) if i % 50 == c) for c in range(50)}
    assert got == {c: (own[c], sum(own[d] for d in range(c + 1)), 0) for c in range(50)}
