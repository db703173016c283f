"""One key with a third of all rows or more: joins must split it, and results must not change."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from lakewarden.operators.joins import cidr_lookup, first_match, in_scope, missing_references, resolve_references
from lakewarden.operators.monitor import enrich_logs
from lakewarden.operators.text import name_collisions
from lakewarden.plans.queries.joins import ADDRESS_RANGES, FLOW_RULES, RULE_COLUMNS
from lakewarden.plans.sizing import local_table

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
}


@contextmanager
def large_tables(spark):
    """Plan as for tables too large to broadcast, and take small partitions for skewed ones."""
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def hot(spark):
    """Half the rows have key 7, the rest are spread over a thousand keys."""
    key = F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id") % 1000)
    return spark.range(0, 40_000, 1, 8).select("id", key.alias("k"))


def split_rows(spark, plain, skewed):
    """The rows, after checking that a skewed partition was split and nothing else changed."""
    want = sorted(map(tuple, plain().collect()), key=repr)
    with large_tables(spark):
        df = skewed()
        got = sorted(map(tuple, df.collect()), key=repr)
        plan = df._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in plan
    assert got == want
    return got


def test_enrichment(spark):
    properties = spark.range(1000).select(F.col("id").alias("key"), F.concat(F.lit("p"), "id").alias("name"))

    def run():
        return enrich_logs(hot(spark), properties, "k", "key")

    assert len(split_rows(spark, run, run)) == 40_000


def test_references(spark):
    lookup = spark.range(1000).select(
        F.lit("s").alias("scope"), F.col("id").cast("string").alias("key"), F.col("id").cast("string").alias("value")
    )
    df = hot(spark).select("id", F.concat(F.lit("{{secrets/s/"), "k", F.lit("}}")).alias("v"))

    def run():
        return resolve_references(df, "v", lookup)

    assert len(split_rows(spark, run, run)) == 40_000


def test_missing_and_scope(spark):
    required = hot(spark).select("id", F.col("k").alias("want"))
    registered = spark.range(0, 900).select((F.col("id") % 500).alias("have"))

    def missing():
        return missing_references(required, registered, "want", "have")

    def scope():
        return in_scope(required, registered, "want", "have")

    assert len(split_rows(spark, missing, missing)) + len(split_rows(spark, scope, scope)) == 40_000


def test_plain_values_are_spread(spark):
    lookup = spark.createDataFrame([("s", "1", "x")], "scope string, key string, value string")
    df = spark.range(0, 40_000, 1, 8).select("id", F.lit("plain").alias("v"))
    with large_tables(spark):
        assert resolve_references(df, "v", lookup).filter("resolved = 'plain' AND NOT dangling").count() == 40_000


def test_collisions(spark):
    df = hot(spark).withColumn("k", F.col("k").cast("string"))

    def run():
        return name_collisions(df, "k")

    split_rows(spark, run, run)


@pytest.mark.parametrize("limit", [1])
def test_addresses(spark, limit):
    df = hot(spark).select("id", (F.col("k") * 65_537 + 2_886_991_872).alias("ip"))
    ranges = local_table(spark, ADDRESS_RANGES, "name string, cidr string")
    split_rows(
        spark, lambda: cidr_lookup(df, "ip", ranges), lambda: cidr_lookup(df, "ip", ranges, limit=limit)
    )


def test_flows(spark):
    flows = hot(spark).select(
        "id",
        F.lit("Out").alias("direction"),
        F.lit("tcp").alias("protocol"),
        F.col("k").cast("int").alias("port"),
        F.lit("batch").alias("source"),
        F.lit("queue").alias("destination"),
    )
    rules = local_table(spark, FLOW_RULES, RULE_COLUMNS)
    got = split_rows(spark, lambda: first_match(flows, rules), lambda: first_match(flows, rules, limit=1))
    assert got is not None and first_match(flows, rules).filter("access = 'Allow'").count() == 40_000
