"""Queries over lookups."""

from pyspark.sql import functions as F

from lakewarden.operators.joins import (
    assign_all,
    cidr_lookup,
    collated_join,
    first_match,
    in_scope,
    missing_references,
    resolve_references,
)
from lakewarden.plans.registry import query, table
from lakewarden.plans.sizing import local_table


@query(
    "resolve_references",
    """
    WITH refs AS (
        SELECT c_custkey,
               CASE WHEN c_mktsegment = 'BUILDING' THEN c_mktsegment
                    ELSE concat('{{secrets/nation/', c_nationkey + CASE WHEN c_acctbal < 0 THEN 100 ELSE 0 END, '}}')
               END AS setting,
               CASE WHEN c_mktsegment <> 'BUILDING'
                    THEN c_nationkey + CASE WHEN c_acctbal < 0 THEN 100 ELSE 0 END END AS key
        FROM customer)
    SELECT c_custkey, setting,
           CASE WHEN key IS NULL THEN setting ELSE n_name END AS resolved,
           key IS NOT NULL AND n_name IS NULL AS dangling
    FROM refs LEFT JOIN nation ON key = n_nationkey
    """,
)
def resolve_references_query(spark, sf_dir):
    shifted = F.col("c_nationkey") + F.when(F.col("c_acctbal") < 0, 100).otherwise(0)
    reference = F.concat(F.lit("{{secrets/nation/"), shifted.cast("string"), F.lit("}}"))
    settings = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_mktsegment")).otherwise(reference).alias("setting"),
    )
    lookup = table(spark, sf_dir, "nation").select(
        F.lit("nation").alias("scope"),
        F.col("n_nationkey").cast("string").alias("key"),
        F.col("n_name").alias("value"),
    )
    return resolve_references(settings, "setting", lookup)


@query(
    "in_scope",
    """
    SELECT c_custkey, c_nationkey FROM customer
    WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey IN (0, 2))
    """,
)
def in_scope_query(spark, sf_dir):
    assigned = table(spark, sf_dir, "nation").filter(F.col("n_regionkey").isin(0, 2))
    members = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return in_scope(members, assigned, "c_nationkey", "n_nationkey")


@query(
    "missing_references",
    """
    SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (
        SELECT 1 FROM orders WHERE o_custkey = c_custkey
        AND o_orderpriority = '1-URGENT' AND o_orderdate >= TIMESTAMP '2001-07-01')
    """,
)
def missing_references_query(spark, sf_dir):
    recent = table(spark, sf_dir, "orders").filter(
        (F.col("o_orderpriority") == "1-URGENT")
        & (F.col("o_orderdate") >= F.lit("2001-07-01").cast("timestamp_ntz"))
    )
    required = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return missing_references(required, recent, "c_custkey", "o_custkey")


@query(
    "assign_all",
    """
    WITH pairs AS (SELECT cast(s_suppkey AS varchar) AS p, 'ledger' AS r, 'user' AS role FROM supplier),
    hashed AS (SELECT *, sha256(concat(length(p), ':', p, length(r), ':', r, length(role), ':', role)) AS h FROM pairs)
    SELECT p AS "principalId", r AS "resourceId", role AS "appRoleId",
           concat_ws('-', h[1:8], h[9:12], h[13:16], h[17:20], h[21:32]) AS assignment_id
    FROM hashed
    """,
)
def assign_all_query(spark, sf_dir):
    principals = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("principalId"))
    return assign_all(principals, "ledger", "user")


# Invented ranges of four lengths that lie inside each other, from 172.20.0.0 on.
ADDRESS_RANGES = [
    ("anywhere", "0.0.0.0/0"),
    ("campus", "172.20.0.0/15"),
    ("labs", "172.20.128.0/17"),
    ("lab_a", "172.20.160.0/20"),
    ("lab_b", "172.20.200.0/22"),
    ("annex", "172.21.16.0/20"),
]


@query(
    "cidr_lookup",
    """
    WITH ips AS (SELECT event_id, 2887000000 + (user_id * 131 + event_id * 7) % 170000 AS ip FROM events),
    ranges(name, lo, prefix) AS (
        VALUES ('anywhere', 0, 0), ('campus', 2886991872, 15), ('labs', 2887024640, 17), ('lab_a', 2887032832, 20),
               ('lab_b', 2887043072, 22), ('annex', 2887061504, 20))
    SELECT event_id, ip, arg_max(name, prefix) AS range_name, cast(max(prefix) AS integer) AS range_prefix
    FROM ips JOIN ranges ON ip BETWEEN lo AND lo + (1::BIGINT << (32 - prefix)) - 1 GROUP BY event_id, ip
    """,
)
def cidr_lookup_query(spark, sf_dir):
    ip = F.lit(2_887_000_000) + (F.col("user_id") * 131 + F.col("event_id") * 7) % 170_000
    events = table(spark, sf_dir, "events").select("event_id", ip.alias("ip"))
    return cidr_lookup(events, "ip", local_table(spark, ADDRESS_RANGES, "name string, cidr string"))


RULE_COLUMNS = (
    "direction string, priority int, protocol string, port_lo int, port_hi int, "
    "source string, destination string, access string"
)
# Invented rules; null ports mean any.
FLOW_RULES = [
    ("In", 10, "tcp", 8080, 8089, "*", "web", "Allow"),
    ("In", 20, "*", None, None, "partner", "*", "Deny"),
    ("In", 30, "*", 5000, None, "web", "queue", "Allow"),
    ("Out", 5, "udp", None, 1023, "*", "*", "Deny"),
    ("Out", 15, "tcp", 7070, 7070, "batch", "store", "Allow"),
    ("Out", 25, "*", None, None, "*", "queue", "Allow"),
    ("Out", 35, "tcp", 8081, 9000, "partner", "*", "Deny"),
]
FLOW_PORTS = [8080, 7070, 514, 8085, 9001]
FLOW_DESTINATIONS = {"purchase": "store", "view": "web", "click": "queue", "error": "batch"}


def event_flows(events):
    destination = F.lit("archive")
    for event_type, label in FLOW_DESTINATIONS.items():
        destination = F.when(F.col("event_type") == event_type, F.lit(label)).otherwise(destination)
    return events.select(
        "event_id",
        F.when(F.col("event_id") % 3 == 0, "In").otherwise("Out").alias("direction"),
        F.when(F.col("user_id") % 7 == 0, "udp").otherwise("tcp").alias("protocol"),
        F.get(F.array(*[F.lit(p) for p in FLOW_PORTS]), (F.col("event_id") % 5).cast("int")).alias("port"),
        F.when(F.col("user_id") % 4 == 0, "partner").when(F.col("user_id") % 4 == 1, "web").otherwise("batch").alias("source"),
        destination.alias("destination"),
    )


@query(
    "first_match",
    """
    WITH flows AS (
        SELECT event_id,
               CASE WHEN event_id % 3 = 0 THEN 'In' ELSE 'Out' END AS direction,
               CASE WHEN user_id % 7 = 0 THEN 'udp' ELSE 'tcp' END AS protocol,
               ([8080, 7070, 514, 8085, 9001])[event_id % 5 + 1] AS port,
               CASE user_id % 4 WHEN 0 THEN 'partner' WHEN 1 THEN 'web' ELSE 'batch' END AS source,
               CASE event_type WHEN 'purchase' THEN 'store' WHEN 'view' THEN 'web' WHEN 'click' THEN 'queue'
                    WHEN 'error' THEN 'batch' ELSE 'archive' END AS destination
        FROM events),
    rules(direction, priority, protocol, port_lo, port_hi, source, destination, access) AS (
        VALUES ('In', 10, 'tcp', 8080, 8089, '*', 'web', 'Allow'),
               ('In', 20, '*', 0, 65535, 'partner', '*', 'Deny'),
               ('In', 30, '*', 5000, 65535, 'web', 'queue', 'Allow'),
               ('Out', 5, 'udp', 0, 1023, '*', '*', 'Deny'),
               ('Out', 15, 'tcp', 7070, 7070, 'batch', 'store', 'Allow'),
               ('Out', 25, '*', 0, 65535, '*', 'queue', 'Allow'),
               ('Out', 35, 'tcp', 8081, 9000, 'partner', '*', 'Deny'))
    SELECT event_id, coalesce(arg_min(access, priority), 'NoMatch') AS access, min(priority) AS matched_priority
    FROM flows f LEFT JOIN rules r
      ON f.direction = r.direction AND (r.protocol = '*' OR r.protocol = f.protocol)
     AND f.port BETWEEN r.port_lo AND r.port_hi AND (r.source = '*' OR r.source = f.source)
     AND (r.destination = '*' OR r.destination = f.destination)
    GROUP BY event_id
    """,
)
def first_match_query(spark, sf_dir):
    flows = event_flows(table(spark, sf_dir, "events"))
    rules = local_table(spark, FLOW_RULES, RULE_COLUMNS)
    return first_match(flows, rules).select("event_id", "access", "matched_priority")


@query(
    "collated_join",
    """
    WITH totals AS (
        SELECT lower(c_mktsegment) AS segment, count(*) AS customers FROM customer GROUP BY 1)
    SELECT c_custkey, segment, customers
    FROM (SELECT c_custkey, upper(c_mktsegment) AS upper_segment FROM customer)
    JOIN totals ON lower(upper_segment) = lower(segment)
    """,
)
def collated_join_query(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    totals = customers.groupBy(F.lower("c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias("customers"))
    upper = customers.select("c_custkey", F.upper("c_mktsegment").alias("upper_segment"))
    return collated_join(upper, totals, ("upper_segment", "segment")).select("c_custkey", "segment", "customers")
