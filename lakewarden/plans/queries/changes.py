"""Queries over change sets and versions."""

from datetime import datetime

from pyspark.sql import functions as F

from lakewarden.functions import merge_maps
from lakewarden.operators.changes import (
    apply_replacements,
    config_drift,
    insert_if_absent,
    state_as_of,
    sync_diff,
    unmatched_replacements,
    upsert,
    version_history,
)
from lakewarden.plans.registry import query, table
from lakewarden.plans.sizing import local_table


@query(
    "sync_diff",
    """
    WITH target AS (
        SELECT c_custkey, CASE WHEN c_nationkey < 4 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal,
               CASE WHEN c_nationkey <> 20 THEN c_mktsegment END AS c_mktsegment
        FROM customer WHERE c_acctbal >= 0
        UNION ALL
        SELECT -1 - c_custkey, c_acctbal, c_mktsegment FROM customer WHERE c_mktsegment = 'FURNITURE')
    SELECT coalesce(s.c_custkey, t.c_custkey) AS c_custkey,
           CASE WHEN t.c_custkey IS NULL THEN 'create' WHEN s.c_custkey IS NULL THEN 'delete'
                WHEN s.c_acctbal IS DISTINCT FROM t.c_acctbal OR s.c_mktsegment IS DISTINCT FROM t.c_mktsegment
                THEN 'update' ELSE 'unchanged' END AS action,
           CASE WHEN s.c_custkey IS NULL THEN t.c_acctbal ELSE s.c_acctbal END AS c_acctbal,
           CASE WHEN s.c_custkey IS NULL THEN t.c_mktsegment ELSE s.c_mktsegment END AS c_mktsegment
    FROM customer s FULL JOIN target t ON s.c_custkey = t.c_custkey
    """,
)
def sync_diff_query(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    source = customers.select("c_custkey", "c_acctbal", "c_mktsegment")
    nation = F.col("c_nationkey")
    # Customers in debt are unknown to the target, two groups of nations differ there.
    changed = customers.filter("c_acctbal >= 0").select(
        "c_custkey",
        F.when(nation < 4, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        F.when(nation != 20, F.col("c_mktsegment")).alias("c_mktsegment"),
    )
    gone = source.filter("c_mktsegment = 'FURNITURE'").withColumn("c_custkey", -1 - F.col("c_custkey"))
    return sync_diff(source, changed.unionByName(gone), "c_custkey", ["c_acctbal", "c_mktsegment"])


@query(
    "upsert",
    """
    SELECT s_suppkey, s_name, s_nationkey, CASE WHEN s_acctbal < 1000 THEN s_acctbal + 100 ELSE s_acctbal END AS s_acctbal
    FROM supplier
    UNION ALL
    SELECT -1 - s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier WHERE s_nationkey < 5
    """,
)
def upsert_query(spark, sf_dir):
    target = table(spark, sf_dir, "supplier")
    updates = target.filter("s_acctbal < 1000").withColumn("s_acctbal", F.col("s_acctbal") + 100)
    creates = target.filter("s_nationkey < 5").withColumn("s_suppkey", -1 - F.col("s_suppkey"))
    return upsert(target, updates.unionByName(creates), "s_suppkey")


@query(
    "insert_if_absent",
    """
    SELECT p_partkey, CASE WHEN p_size <= 25 THEN p_name ELSE 'new' END AS p_name, p_size FROM part
    """,
)
def insert_if_absent_query(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    source = parts.withColumn("p_name", F.lit("new"))
    return insert_if_absent(parts.filter("p_size <= 25"), source, "p_partkey")


REPLACEMENTS = [("1-URGENT", "P1"), ("2-HIGH", "P2"), ("9-NONE", "P9")]


def _named(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("name"), F.col("o_orderstatus").alias("value")
    )


@query(
    "apply_replacements",
    """
    SELECT o_orderkey, o_orderpriority AS name,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'P1' WHEN '2-HIGH' THEN 'P2' ELSE o_orderstatus END AS value
    FROM orders
    """,
)
def apply_replacements_query(spark, sf_dir):
    return apply_replacements(
        _named(spark, sf_dir), local_table(spark, REPLACEMENTS, "name string, value string")
    )


@query(
    "unmatched_replacements",
    """
    SELECT name, value FROM (VALUES ('1-URGENT', 'P1'), ('2-HIGH', 'P2'), ('9-NONE', 'P9')) r(name, value)
    WHERE name NOT IN (SELECT o_orderpriority FROM orders)
    """,
)
def unmatched_replacements_query(spark, sf_dir):
    return unmatched_replacements(
        _named(spark, sf_dir), local_table(spark, REPLACEMENTS, "name string, value string")
    )


@query(
    "config_drift",
    """
    WITH docs AS (
        SELECT concat('customer.', c_custkey, '.segment') AS path, c_mktsegment AS dev,
               CASE WHEN c_nationkey <> 5 THEN c_mktsegment END AS tst,
               CASE WHEN c_acctbal < 0 THEN lower(c_mktsegment) ELSE c_mktsegment END AS prd
        FROM customer WHERE c_custkey <> 3)
    SELECT path, dev, tst, prd, CASE WHEN tst IS NULL THEN 'tst' ELSE '' END AS missing,
           tst IS NULL OR dev IS DISTINCT FROM tst OR dev IS DISTINCT FROM prd AS drift
    FROM docs
    """,
)
def config_drift_query(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    key, segment = F.col("c_custkey"), F.col("c_mktsegment")
    values = F.create_map(
        F.lit("dev"), segment,
        F.lit("tst"), F.when(F.col("c_nationkey") != 5, segment),
        F.lit("prd"), F.when(F.col("c_acctbal") < 0, F.lower(segment)).otherwise(segment),
    )
    path = F.concat(F.lit("customer."), key.cast("string"), F.lit(".segment"))
    docs = customers.select(path.alias("path"), F.explode(values).alias("env", "value")).filter("value IS NOT NULL")
    return config_drift(docs, ["dev", "tst", "prd"], "dev", ignore=["customer.3.segment"])


@query(
    "merge_maps",
    """
    WITH tags AS (
        SELECT c_custkey, 'Owner' AS tag, CASE WHEN c_acctbal >= 5000 THEN c_mktsegment ELSE 'platform' END AS value
        FROM customer
        UNION ALL SELECT c_custkey, 'Environment', 'dev' FROM customer
        UNION ALL SELECT c_custkey, 'Name', c_name FROM customer
        UNION ALL SELECT c_custkey, 'Team', cast(c_nationkey AS varchar) FROM customer WHERE c_acctbal >= 5000)
    SELECT c_custkey, tag, value FROM tags
    """,
)
def merge_maps_query(spark, sf_dir):
    defaults = F.create_map(
        F.lit("Owner"), F.lit("platform"), F.lit("Environment"), F.lit("dev"), F.lit("Name"), F.col("c_name")
    )
    # A null override keeps the default, a null map overrides nothing.
    overrides = F.when(
        F.col("c_acctbal") >= 5000,
        F.create_map(
            F.lit("Owner"), F.col("c_mktsegment"),
            F.lit("Team"), F.col("c_nationkey").cast("string"),
            F.lit("Environment"), F.lit(None).cast("string"),
        ),
    )
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.explode(merge_maps(defaults, overrides)).alias("tag", "value")
    )


@query(
    "state_as_of",
    """
    SELECT user_id, event_id, ts, event_type, value FROM events
    WHERE ts <= TIMESTAMP '2024-01-15'
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1 AND event_type <> 'error'
    """,
)
def state_as_of_query(spark, sf_dir):
    return state_as_of(
        table(spark, sf_dir, "events").drop("props"),
        "user_id",
        "ts",
        "event_id",
        datetime(2024, 1, 15),
        now=datetime(2024, 1, 20),
        is_delete=F.col("event_type") == "error",
    )


@query(
    "version_history",
    """
    SELECT event_id, user_id, event_type, ts AS valid_from, lead(ts) OVER w AS valid_to,
           row_number() OVER w AS version_no, lead(ts) OVER w IS NULL AS is_current
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
    """,
)
def version_history_query(spark, sf_dir):
    changes = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    return version_history(changes, "user_id", "ts", "event_id")
