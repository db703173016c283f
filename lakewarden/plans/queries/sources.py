"""Queries over sources and sinks."""

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from lakewarden.operators.lifecycle import COOL_DAYS, default_rules, lifecycle_action
from lakewarden.plans.registry import events_path, query, scratch, table
from lakewarden.sources import (
    flatten_documents,
    object_inventory,
    read_event_stream,
    read_zone,
    register_dataset,
    write_parsed,
    write_zone,
)
from lakewarden.streaming import run_available

PER_STATUS = """
    SELECT o_orderstatus, count(*) AS orders, round(sum(o_totalprice), 2) AS total
    FROM orders GROUP BY o_orderstatus
"""


def _per_status(orders):
    return orders.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query("read_zone", PER_STATUS)
def read_zone_query(spark, sf_dir):
    root = scratch(spark)
    write_zone(table(spark, sf_dir, "orders"), root, "raw", "data", "orders")
    return _per_status(read_zone(spark, root, "raw", "data", "orders"))


@query(
    "write_zone",
    """
    WITH written AS (
        -- F was replaced by halves of its prices, P was there and stayed, O got its rows and one more each.
        SELECT o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN o_totalprice / 2 ELSE o_totalprice END AS price FROM orders
        UNION ALL SELECT o_orderstatus, 1 FROM orders WHERE o_orderstatus = 'O')
    SELECT o_orderstatus, count(*) AS orders, round(sum(price), 2) AS total FROM written GROUP BY o_orderstatus
    """,
)
def write_zone_query(spark, sf_dir):
    root, orders = scratch(spark), table(spark, sf_dir, "orders")
    target = (root, "work", "dp001", "orders")
    write_zone(orders, *target, partition_by=["o_orderstatus"])
    # One partition is replaced by other values, the others stay.
    halves = orders.filter("o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") / 2)
    write_zone(halves, *target, partition_by=["o_orderstatus"])
    # Something is there, so this writes nothing.
    write_zone(orders.withColumn("o_totalprice", F.lit(0.0)), *target, mode="ignore", partition_by=["o_orderstatus"])
    ones = orders.filter("o_orderstatus = 'O'").withColumn("o_totalprice", F.lit(1.0))
    write_zone(ones, *target, mode="append", partition_by=["o_orderstatus"])
    return _per_status(read_zone(spark, *target))


@query(
    "register_dataset",
    "SELECT p_brand, count(*) AS parts, max(p_size) AS max_size FROM part GROUP BY p_brand",
)
def register_dataset_query(spark, sf_dir):
    root = scratch(spark)
    write_zone(table(spark, sf_dir, "part"), root, "raw", "data", "part", partition_by=["p_brand"])
    register_dataset(spark, f"{root}/raw/data/part", "lakewarden_part")
    return spark.sql("SELECT p_brand, count(*) AS parts, max(p_size) AS max_size FROM lakewarden_part GROUP BY p_brand")


@query(
    "object_inventory",
    "SELECT concat('o_orderstatus=', o_orderstatus) AS container, 1::BIGINT AS objects FROM orders GROUP BY o_orderstatus",
)
def object_inventory_query(spark, sf_dir):
    root = scratch(spark)
    one_each = table(spark, sf_dir, "orders").repartition(8, "o_orderstatus")
    one_each.write.partitionBy("o_orderstatus").parquet(root)
    found = object_inventory(spark, root).filter(F.col("path").endswith(".parquet") & (F.col("bytes") > 0))
    return found.groupBy("container").agg(F.count(F.lit(1)).alias("objects"))


@query(
    "inventory_lifecycle",
    """
    SELECT concat('o_orderstatus=', o_orderstatus) AS container, 'base' AS kind, 'cool' AS action, 1::BIGINT AS objects
    FROM orders GROUP BY o_orderstatus
    UNION ALL SELECT '.snapshot', 'snapshot', 'delete', count(DISTINCT o_orderstatus) FROM orders
    UNION ALL SELECT '.version', 'version', 'cool', count(DISTINCT o_orderstatus) FROM orders
    """,
)
def inventory_lifecycle_query(spark, sf_dir):
    root = scratch(spark)
    one_each = table(spark, sf_dir, "orders").repartition(8, "o_orderstatus")
    # Objects of today, snapshots of an old day, and versions without a time in their names.
    for place in ("", "/.snapshot/20200101T000000", "/.version/first"):
        one_each.write.partitionBy("o_orderstatus").mode("append").parquet(root + place)
    found = object_inventory(spark, root).filter(F.col("path").endswith(".parquet") & (F.col("bytes") > 0))
    as_of = datetime.now(timezone.utc).replace(tzinfo=None) + timedelta(days=COOL_DAYS + 10)
    actions = lifecycle_action(found, default_rules(archive=True, delete=True), as_of)
    return actions.groupBy("container", "kind", "action").agg(F.count(F.lit(1)).alias("objects"))


@query(
    "flatten_documents",
    """
    SELECT event_id, 'a.0.k' AS path, json_extract_string(props, '$.k') AS value FROM events
    UNION ALL SELECT event_id, 'b\\.c.d', event_type FROM events WHERE event_id % 2 = 0
    """,
)
def flatten_documents_query(spark, sf_dir):
    more = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit(',"b.c":{"d":"'), "event_type", F.lit('"}'))).otherwise(F.lit(',"b.c":{}'))
    nested = F.concat(F.lit('{"a":['), "props", F.lit("]"), more, F.lit("}"))
    return flatten_documents(table(spark, sf_dir, "events").withColumn("nested", nested), "event_id", "nested")


@query(
    "parse_messages",
    """
    SELECT 'event' AS output, event_type AS detail, count(*) AS messages, cast(sum(user_id) AS bigint) AS users
    FROM events WHERE event_id % 20 <> 0 GROUP BY event_type
    UNION ALL
    SELECT 'rejected', CASE event_id % 60 WHEN 0 THEN 'unparsable' WHEN 20 THEN 'empty' ELSE 'no time' END, count(*), NULL
    FROM events WHERE event_id % 20 = 0 GROUP BY 2
    """,
)
def parse_messages_query(spark, sf_dir):
    root = scratch(spark)
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    good = F.to_json(F.struct("event_id", "ts", "user_id", "event_type"))
    kind = F.col("event_id") % 60
    # One message in twenty is cut off, empty, or without a time.
    bad = F.when(kind == 0, F.left(good, F.lit(20))).when(kind == 20, F.lit(None)).otherwise(F.to_json(F.struct("event_id")))
    value = F.when(F.col("event_id") % 20 == 0, bad).otherwise(good)
    messages = events.select(value.cast("binary").alias("value"), (F.col("event_id") % 4).cast("int").alias("partition"), F.col("event_id").alias("offset"))
    messages.write.parquet(f"{root}/in")
    stream = spark.readStream.schema(messages.schema).parquet(f"{root}/in")
    run_available(write_parsed(stream, events.schema, f"{root}/out", f"{root}/progress"))
    parsed, rejected = (spark.read.parquet(f"{root}/out/{name}") for name in ("events", "rejected"))
    counted = parsed.groupBy(F.lit("event").alias("output"), F.col("event_type").alias("detail")).agg(
        F.count(F.lit(1)).alias("messages"), F.sum("user_id").alias("users")
    )
    others = rejected.groupBy(F.lit("rejected").alias("output"), F.col("reason").alias("detail")).agg(
        F.count(F.lit(1)).alias("messages"), F.lit(None).cast("bigint").alias("users")
    )
    return counted.unionByName(others)


@query("read_event_stream", "SELECT event_type, count(*) AS events FROM events GROUP BY event_type")
def read_event_stream_query(spark, sf_dir):
    root, path = scratch(spark), events_path(sf_dir)
    stream = read_event_stream(spark, path, table(spark, sf_dir, "events").schema, fmt="parquet")
    run_available(
        stream.select("event_id", "event_type")
        .writeStream.format("parquet")
        .options(path=f"{root}/out", checkpointLocation=f"{root}/progress")
    )
    return spark.read.parquet(f"{root}/out").groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))
