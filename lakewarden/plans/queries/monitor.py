"""Queries over cost, metrics and logs."""

from pyspark.sql import functions as F

from lakewarden.operators.monitor import (
    cost_by_tag,
    enrich_logs,
    provisioning_stats,
    resample_metrics,
    run_outcomes,
    throughput_need,
)
from lakewarden.plans.registry import query, table


@query(
    "cost_by_tag",
    """
    WITH usage AS (
        SELECT CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN NULL
                    WHEN l_linenumber = 1 THEN concat('dept-', l_suppkey)
                    ELSE concat('ABCDE-', lpad(cast(l_suppkey % 50 AS varchar), 5, '0')) END AS tag,
               l_extendedprice * (1 - l_discount) AS cost
        FROM lineitem)
    SELECT CASE WHEN tag IS NULL THEN 'untagged'
                WHEN NOT regexp_full_match(tag, '[A-Z]{5}-[0-9]{5}') THEN 'invalid' ELSE tag END AS tag_value,
           round(sum(cost), 2) AS cost, count(*) AS rows
    FROM usage GROUP BY 1
    """,
)
def cost_by_tag_query(spark, sf_dir):
    center = F.when(
        F.col("l_linenumber") == 1, F.concat(F.lit("dept-"), F.col("l_suppkey").cast("string"))
    ).otherwise(F.concat(F.lit("ABCDE-"), F.lpad((F.col("l_suppkey") % 50).cast("string"), 5, "0")))
    untagged = (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O")
    creator = F.create_map(F.lit("Creator"), F.col("l_linestatus"))
    tags = F.when(untagged, creator).otherwise(
        F.create_map(F.lit("Creator"), F.col("l_linestatus"), F.lit("costCenter"), center)
    )
    usage = table(spark, sf_dir, "lineitem").select(
        tags.alias("tags"), (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("cost")
    )
    return cost_by_tag(usage, "costCenter", "cost").withColumn("cost", F.round("cost", 2))


RESAMPLED_SQL = """
    SELECT event_type, time_bucket(INTERVAL 1 HOUR, ts) AS period_start,
           arg_max(value, (ts, event_id)) AS last_value, min(value) AS min_value, max(value) AS max_value,
           round(avg(value), 4) AS mean_value, count(value) AS samples
    FROM events GROUP BY 1, 2
"""


@query("resample_metrics", RESAMPLED_SQL)
def resample_metrics_query(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    resampled = resample_metrics(events, ["event_type"], "ts", "value", "event_id", "1 hour")
    return resampled.withColumn("mean_value", F.round("mean_value", 4))


EVENT_ACTIONS = {"signup": "create", "purchase": "update", "error": "delete"}


@query(
    "provisioning_stats",
    """
    WITH audit AS (
        SELECT cast(dayofyear(ts) AS bigint) AS cycle_id,
               CASE WHEN user_id % 2 = 0 THEN 'user' ELSE 'group' END AS object_type,
               CASE event_type WHEN 'signup' THEN 'create' WHEN 'purchase' THEN 'update' WHEN 'error' THEN 'delete' END AS action
        FROM events),
    per_cycle AS (
        SELECT cycle_id,
               count(*) FILTER (object_type = 'user' AND action = 'create') AS user_create,
               count(*) FILTER (object_type = 'user' AND action = 'update') AS user_update,
               count(*) FILTER (object_type = 'user' AND action = 'delete') AS user_delete,
               count(*) FILTER (object_type = 'group' AND action = 'create') AS group_create,
               count(*) FILTER (object_type = 'group' AND action = 'update') AS group_update,
               count(*) FILTER (object_type = 'group' AND action = 'delete') AS group_delete
        FROM audit GROUP BY cycle_id)
    SELECT *,
           cast(sum(user_create) OVER w AS bigint) AS user_create_to_date,
           cast(sum(user_update) OVER w AS bigint) AS user_update_to_date,
           cast(sum(user_delete) OVER w AS bigint) AS user_delete_to_date,
           cast(sum(group_create) OVER w AS bigint) AS group_create_to_date,
           cast(sum(group_update) OVER w AS bigint) AS group_update_to_date,
           cast(sum(group_delete) OVER w AS bigint) AS group_delete_to_date
    FROM per_cycle WINDOW w AS (ORDER BY cycle_id)
    """,
)
def provisioning_stats_query(spark, sf_dir):
    action = F.lit(None).cast("string")
    for event_type, name in EVENT_ACTIONS.items():
        action = F.when(F.col("event_type") == event_type, F.lit(name)).otherwise(action)
    audit = table(spark, sf_dir, "events").select(
        F.dayofyear("ts").cast("bigint").alias("cycle_id"),
        F.when(F.col("user_id") % 2 == 0, "user").otherwise("group").alias("object_type"),
        action.alias("action"),
    )
    return provisioning_stats(audit)


RUN_OUTCOMES_SQL = """
    WITH latest AS (
        SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, count(*) AS polls
        FROM events GROUP BY user_id)
    SELECT user_id AS run_id,
           CASE WHEN event_type IN ('view', 'click') THEN 'running'
                WHEN event_type IN ('purchase', 'signup') THEN 'success' ELSE 'failed' END AS outcome, polls
    FROM latest
"""


def run_events(events):
    """Events seen as polls of a run's state."""
    open_ = F.col("event_type").isin("view", "click")
    done = F.col("event_type").isin("purchase", "signup")
    return events.select(
        F.col("user_id").alias("run_id"),
        "ts",
        F.col("event_id").alias("seq"),
        F.when(open_, F.lit(0)).otherwise(F.unix_millis(F.col("ts").cast("timestamp"))).cast("bigint").alias("end_time"),
        F.struct(
            F.when(done, F.lit("SUCCESS")).when(~open_, F.lit("FAILED")).alias("result_state")
        ).alias("state"),
    )


@query("run_outcomes", RUN_OUTCOMES_SQL)
def run_outcomes_query(spark, sf_dir):
    return run_outcomes(run_events(table(spark, sf_dir, "events")))


@query(
    "enrich_logs",
    """
    SELECT event_id, user_id, s_name, s_nationkey
    FROM events LEFT JOIN supplier ON user_id = s_suppkey
    """,
)
def enrich_logs_query(spark, sf_dir):
    logs = table(spark, sf_dir, "events").select("event_id", "user_id")
    properties = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return enrich_logs(logs, properties, "user_id", "s_suppkey").drop("s_suppkey")


@query(
    "throughput_need",
    """
    WITH per_window AS (
        SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, count(*) AS events,
               cast(sum(length(props) + 8) AS bigint) AS bytes
        FROM events GROUP BY 1)
    SELECT window_start, events, bytes,
           cast(least(greatest(ceil(bytes / 18.0), 1), 20) AS bigint) AS units, ceil(bytes / 18.0) > 20 AS saturated
    FROM per_window
    """,
)
def throughput_need_query(spark, sf_dir):
    size = F.length("props").cast("bigint") + 8
    return throughput_need(table(spark, sf_dir, "events"), "ts", size, window_seconds=3600, unit_rate=0.005)
