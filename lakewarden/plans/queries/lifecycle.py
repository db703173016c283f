"""Queries over tiering, retention and size limits."""

from pyspark.sql import functions as F

from lakewarden.operators.lifecycle import (
    LifecycleRule,
    default_rules,
    file_size_limits,
    last_access,
    lifecycle_action,
    lifecycle_summary,
    retention_sweep,
    with_last_access,
)
from lakewarden.plans.registry import AS_OF_EVENTS, AS_OF_ORDERS, query, table
from lakewarden.plans.sizing import local_table

INVENTORY_SQL = """
    WITH inventory AS (
        SELECT concat('data/di00', o_custkey % 2 + 1, '/', o_orderkey) AS path,
               concat('di00', o_custkey % 2 + 1) AS container,
               CASE o_orderstatus WHEN 'F' THEN 'base' WHEN 'O' THEN 'snapshot' ELSE 'version' END AS kind,
               CASE WHEN o_orderkey % 10 = 0 THEN 'pageBlob' ELSE 'blockBlob' END AS blob_type,
               cast(floor(o_totalprice) AS bigint) AS bytes, o_orderdate AS since
        FROM orders),
    actions AS (
        SELECT *, CASE WHEN blob_type <> 'blockBlob' THEN 'hot'
                       WHEN since < TIMESTAMP '2001-08-02' - INTERVAL 730 DAY THEN 'delete'
                       WHEN since < TIMESTAMP '2001-08-02' - INTERVAL 365 DAY THEN 'archive'
                       WHEN since < TIMESTAMP '2001-08-02' - INTERVAL 90 DAY THEN 'cool'
                       ELSE 'hot' END AS action
        FROM inventory)
"""


def order_inventory(orders):
    """Orders seen as stored objects."""
    folder = (F.col("o_custkey") % 2 + 1).cast("string")
    return orders.select(
        F.concat(F.lit("data/di00"), folder, F.lit("/"), F.col("o_orderkey").cast("string")).alias("path"),
        F.concat(F.lit("di00"), folder).alias("container"),
        F.when(F.col("o_orderstatus") == "F", "base")
        .when(F.col("o_orderstatus") == "O", "snapshot")
        .otherwise("version")
        .alias("kind"),
        F.when(F.col("o_orderkey") % 10 == 0, "pageBlob").otherwise("blockBlob").alias("blob_type"),
        F.floor("o_totalprice").alias("bytes"),
        F.col("o_orderdate").alias("modified_at"),
        F.col("o_orderdate").alias("created_at"),
    )


def _actions(spark, sf_dir):
    rules = default_rules(archive=True, delete=True)
    return lifecycle_action(order_inventory(table(spark, sf_dir, "orders")), rules, AS_OF_ORDERS)


@query("lifecycle_action", INVENTORY_SQL + "SELECT path, container, kind, bytes, action FROM actions")
def lifecycle_action_query(spark, sf_dir):
    return _actions(spark, sf_dir).select("path", "container", "kind", "bytes", "action")


@query(
    "lifecycle_summary",
    INVENTORY_SQL
    + """
    SELECT container, kind, action, grouping_id(container, kind, action) AS level,
           count(*) AS objects, cast(sum(bytes) AS bigint) AS bytes
    FROM actions GROUP BY ROLLUP (container, kind, action)
    """,
)
def lifecycle_summary_query(spark, sf_dir):
    return lifecycle_summary(_actions(spark, sf_dir))


@query(
    "last_access",
    """
    SELECT concat('user/', user_id) AS path, cast(date_trunc('day', max(ts)) AS timestamp) AS last_access
    FROM events GROUP BY user_id
    """,
)
def last_access_query(spark, sf_dir):
    log = table(spark, sf_dir, "events").select(
        F.concat(F.lit("user/"), F.col("user_id").cast("string")).alias("object"), "ts"
    )
    return last_access(log, "object", "ts")


@query(
    "lifecycle_by_access",
    """
    WITH accesses AS (
        SELECT o_custkey, date_trunc('day', max(o_orderdate)) AS last_access
        FROM orders WHERE o_orderstatus <> 'F' GROUP BY o_custkey)
    SELECT concat('customer/', c_custkey) AS path, cast(last_access AS timestamp) AS last_access,
           CASE WHEN coalesce(last_access, TIMESTAMP '1995-01-01') < TIMESTAMP '2001-08-02' - INTERVAL 365 DAY
                THEN 'archive'
                WHEN coalesce(last_access, TIMESTAMP '1995-01-01') < TIMESTAMP '2001-08-02' - INTERVAL 90 DAY
                THEN 'cool' ELSE 'hot' END AS action
    FROM customer LEFT JOIN accesses ON c_custkey = o_custkey
    """,
)
def lifecycle_by_access_query(spark, sf_dir):
    def path(key):
        return F.concat(F.lit("customer/"), F.col(key).cast("string")).alias("path")

    log = table(spark, sf_dir, "orders").filter("o_orderstatus <> 'F'").select(path("o_custkey"), "o_orderdate")
    inventory = table(spark, sf_dir, "customer").select(
        path("c_custkey"),
        F.lit("base").alias("kind"),
        F.lit("blockBlob").alias("blob_type"),
        F.lit("1995-01-01").cast("timestamp_ntz").alias("modified_at"),
    )
    used = with_last_access(inventory, last_access(log, "path", "o_orderdate"))
    rules = [LifecycleRule("by access", "base", "accessed", archive_days=365)]
    return lifecycle_action(used, rules, AS_OF_ORDERS).select("path", "last_access", "action")


EVENT_PERIODS = [("click", 3), ("view", 7), ("purchase", 20), ("error", 7)]
EVENT_PERIODS_SQL = "(VALUES ('click', 3), ('view', 7), ('purchase', 20), ('error', 7)) p(dataset, days)"


def _periods(spark):
    return local_table(spark, EVENT_PERIODS, "dataset string, days int")


@query(
    "retention_sweep",
    f"""
    SELECT event_id, event_type,
           CASE WHEN ts < TIMESTAMP '2024-01-31' - to_days(days) THEN 'purge' ELSE 'keep' END AS disposition
    FROM events LEFT JOIN {EVENT_PERIODS_SQL} ON event_type = dataset
    """,
)
def retention_sweep_query(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    return retention_sweep(events, _periods(spark), AS_OF_EVENTS, "event_type", "ts").drop("ts")


@query(
    "retention_of_deleted",
    f"""
    SELECT event_id, event_type,
           CASE WHEN user_id % 3 <> 0 OR days IS NULL THEN 'keep'
                WHEN ts < TIMESTAMP '2024-01-31' - to_days(days) THEN 'purge' ELSE 'recoverable' END AS disposition
    FROM events LEFT JOIN {EVENT_PERIODS_SQL} ON event_type = dataset
    """,
)
def retention_of_deleted_query(spark, sf_dir):
    deleted = F.when(F.col("user_id") % 3 == 0, F.col("ts"))
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "ts", deleted.alias("deleted_at"))
    swept = retention_sweep(events, _periods(spark), AS_OF_EVENTS, "event_type", "ts", "deleted_at")
    return swept.select("event_id", "event_type", "disposition")


@query(
    "file_size_limits",
    """
    WITH running AS (
        SELECT doc_id, source, n_chars,
               cast(sum(n_chars) OVER (PARTITION BY source ORDER BY doc_id ROWS UNBOUNDED PRECEDING) AS bigint) AS bytes_to_here
        FROM documents WHERE source <> 'src9')
    SELECT doc_id, source, n_chars, 20000::bigint AS max_bytes, bytes_to_here - n_chars AS bytes_before, bytes_to_here,
           bytes_to_here - n_chars <= 20000 AS crosses
    FROM running WHERE bytes_to_here > 20000
    """,
)
def file_size_limits_query(spark, sf_dir):
    objects = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    limits = (
        objects.filter("source <> 'src9'")
        .select(F.col("source").alias("dataset"))
        .distinct()
        .withColumn("max_bytes", F.lit(20000).cast("bigint"))
    )
    return file_size_limits(objects, limits, dataset="source", size="n_chars", order=["doc_id"])
