"""Queries over rule checks."""

from datetime import datetime

from pyspark.sql import functions as F

from lakewarden.operators.rules import (
    Rule,
    apply_defaults,
    apply_defaults_long,
    hide_attributes,
    lease_status,
    match_rule_paths,
    only_configured,
    policy_summary,
    policy_violations,
    policy_violations_long,
    rule_allowlist,
    rule_fixed,
    rule_forbidden,
    rule_range,
    rule_regex,
    rule_required,
    rules_frame,
)
from lakewarden.plans.registry import query, table
from lakewarden.sources import flatten_documents


@query(
    "rule_fixed",
    """
    SELECT cast(o_orderkey AS varchar) AS entity_id, 'o_orderstatus' AS path, 'fixed' AS rule_type,
           'F' AS expected, o_orderstatus AS actual
    FROM orders WHERE o_orderstatus <> 'F'
    """,
)
def rule_fixed_query(spark, sf_dir):
    return rule_fixed(table(spark, sf_dir, "orders"), "o_orderkey", "o_orderstatus", "F")


@query(
    "rule_range",
    """
    SELECT cast(l_orderkey AS varchar) AS entity_id, 'l_quantity' AS path, 'range' AS rule_type,
           '1..40' AS expected, cast(l_quantity AS varchar) AS actual
    FROM lineitem WHERE l_quantity < 1 OR l_quantity > 40
    """,
)
def rule_range_query(spark, sf_dir):
    return rule_range(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_quantity", 1, 40)


@query(
    "rule_regex",
    """
    SELECT cast(p_partkey AS varchar) AS entity_id, 'p_brand' AS path, 'regex' AS rule_type,
           'Brand#[0-9]' AS expected, p_brand AS actual
    FROM part WHERE NOT regexp_full_match(p_brand, 'Brand#[0-9]')
    """,
)
def rule_regex_query(spark, sf_dir):
    return rule_regex(table(spark, sf_dir, "part"), "p_partkey", "p_brand", "Brand#[0-9]")


@query(
    "rule_allowlist",
    """
    SELECT cast(c_custkey AS varchar) AS entity_id, 'c_mktsegment' AS path, 'allowlist' AS rule_type,
           'BUILDING,MACHINERY' AS expected, c_mktsegment AS actual
    FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')
    """,
)
def rule_allowlist_query(spark, sf_dir):
    return rule_allowlist(table(spark, sf_dir, "customer"), "c_custkey", "c_mktsegment", ["BUILDING", "MACHINERY"])


@query(
    "rule_forbidden",
    """
    SELECT cast(event_id AS varchar) AS entity_id, 'k' AS path, 'forbidden' AS rule_type,
           'absent' AS expected, json_extract_string(props, '$.k') AS actual
    FROM events WHERE cast(json_extract_string(props, '$.k') AS bigint) >= 90
    """,
)
def rule_forbidden_query(spark, sf_dir):
    leaves = flatten_documents(table(spark, sf_dir, "events"), "event_id", "props")
    high = F.when(F.col("value").try_cast("bigint") >= 90, F.col("value"))
    return rule_forbidden(leaves.filter("path = 'k'").select("event_id", high.alias("k")), "event_id", "k")


def _labelled(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return docs.join(table(spark, sf_dir, "labels"), "doc_id", "left")


@query(
    "rule_required",
    """
    SELECT cast(doc_id AS varchar) AS entity_id, 'quality' AS path, 'required' AS rule_type,
           'length 1..' AS expected, cast(quality AS varchar) AS actual
    FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL
    """,
)
def rule_required_query(spark, sf_dir):
    return rule_required(_labelled(spark, sf_dir), "doc_id", "quality")


PATH_RULES = ("a.0.x", "a.*.x", "a.*.*")


@query(
    "match_rule_paths",
    """
    WITH paths AS (
        SELECT cast(o_orderkey AS varchar) AS entity_id,
               concat('a.', o_orderkey % 3, '.', CASE WHEN o_orderstatus = 'F' THEN 'x' ELSE 'y' END) AS path
        FROM orders),
    rules(rule_path, pattern, stars) AS (
        VALUES ('a.0.x', 'a[.]0[.]x', 0), ('a.*.x', 'a[.][^.]*[.]x', 1), ('a.*.*', 'a[.][^.]*[.][^.]*', 2))
    SELECT entity_id, path, rule_path
    FROM paths JOIN rules ON regexp_full_match(path, pattern)
    QUALIFY row_number() OVER (PARTITION BY entity_id, path ORDER BY stars, rule_path DESC) = 1
    """,
)
def match_rule_paths_query(spark, sf_dir):
    paths = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("entity_id"),
        F.concat(
            F.lit("a."),
            (F.col("o_orderkey") % 3).cast("string"),
            F.when(F.col("o_orderstatus") == "F", ".x").otherwise(".y"),
        ).alias("path"),
    )
    return match_rule_paths(paths, rules_frame(spark, [Rule(p, "unlimited") for p in PATH_RULES]))


@query(
    "apply_defaults",
    """
    SELECT doc_id, coalesce(quality, 0) AS quality, coalesce(toxic, 1) AS toxic
    FROM documents LEFT JOIN labels USING (doc_id)
    """,
)
def apply_defaults_query(spark, sf_dir):
    rules = [Rule("quality", "range", max_value=1, default_value="0"), Rule("toxic", "fixed", value="1")]
    return apply_defaults(_labelled(spark, sf_dir), rules)


@query(
    "apply_defaults_long",
    """
    WITH labelled AS (SELECT cast(doc_id AS varchar) AS entity_id, quality, toxic FROM documents LEFT JOIN labels USING (doc_id))
    SELECT entity_id, 'quality' AS path, coalesce(cast(quality AS varchar), '0') AS value FROM labelled
    UNION ALL SELECT entity_id, 'toxic', coalesce(cast(toxic AS varchar), '1') FROM labelled
    UNION ALL SELECT entity_id, 'reviewer', NULL FROM labelled
    """,
)
def apply_defaults_long_query(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").withColumn("entity_id", F.col("doc_id").cast("string"))
    values = F.map_from_arrays(F.array(F.lit("quality"), F.lit("toxic")), F.array("quality", "toxic").cast("array<string>"))
    long = labels.select("entity_id", F.explode(values).alias("path", "value")).filter("value IS NOT NULL")
    rules = [Rule("quality", "range", max_value=1, default_value="0"), Rule("toxic", "fixed", value="1"), Rule("reviewer", "required")]
    ids = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("entity_id"))
    return apply_defaults_long(long, rules_frame(spark, rules), ids)


ORDER_RULES = [
    Rule("o_orderstatus", "fixed", value="F"),
    Rule("o_totalprice", "range", min_value=1000, max_value=400000),
    Rule("o_orderpriority", "regex", pattern="[1-3]-.*"),
    Rule("c_mktsegment", "allowlist", values=["BUILDING", "HOUSEHOLD", "MACHINERY"]),
    Rule("c_mktsegment", "unlimited", max_length=8),
    Rule("hold", "forbidden"),
    Rule("owner", "unlimited", is_optional=False),
]
ORDER_VIOLATIONS = """
    WITH entities AS (
        SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority, c_mktsegment,
               CASE WHEN o_totalprice < 20000 THEN 'held' END AS hold,
               CASE WHEN c_acctbal >= 0 THEN c_name END AS owner
        FROM orders JOIN customer ON o_custkey = c_custkey),
    violations AS (
        SELECT o_orderkey, 'o_orderstatus' AS path, 'fixed' AS rule_type, 'F' AS expected, o_orderstatus AS actual
        FROM entities WHERE o_orderstatus <> 'F'
        UNION ALL
        SELECT o_orderkey, 'o_totalprice', 'range', '1000..400000', cast(o_totalprice AS varchar)
        FROM entities WHERE o_totalprice < 1000 OR o_totalprice > 400000
        UNION ALL
        SELECT o_orderkey, 'o_orderpriority', 'regex', '[1-3]-.*', o_orderpriority
        FROM entities WHERE NOT regexp_full_match(o_orderpriority, '[1-3]-.*')
        UNION ALL
        SELECT o_orderkey, 'c_mktsegment', 'allowlist', 'BUILDING,HOUSEHOLD,MACHINERY', c_mktsegment
        FROM entities WHERE c_mktsegment NOT IN ('BUILDING', 'HOUSEHOLD', 'MACHINERY')
        UNION ALL
        SELECT o_orderkey, 'c_mktsegment', 'length', 'length ..8', c_mktsegment FROM entities WHERE length(c_mktsegment) > 8
        UNION ALL
        SELECT o_orderkey, 'hold', 'forbidden', 'absent', hold FROM entities WHERE hold IS NOT NULL
        UNION ALL
        SELECT o_orderkey, 'owner', 'required', 'length 1..', owner FROM entities WHERE owner IS NULL OR owner = '')
"""
ORDER_VIOLATION_ROWS = (
    ORDER_VIOLATIONS
    + """
    SELECT cast(o_orderkey AS varchar) AS entity_id, path, rule_type, expected, actual FROM violations
    """
)


def _order_entities(spark, sf_dir):
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    joined = orders.join(customers, orders["o_custkey"] == customers["c_custkey"])
    return joined.select(
        "o_orderkey",
        "o_orderstatus",
        "o_totalprice",
        "o_orderpriority",
        "c_mktsegment",
        F.when(F.col("o_totalprice") < 20000, "held").alias("hold"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("owner"),
    )


@query("policy_violations", ORDER_VIOLATION_ROWS)
def policy_violations_query(spark, sf_dir):
    return policy_violations(_order_entities(spark, sf_dir), "o_orderkey", ORDER_RULES)


@query("policy_violations_long", ORDER_VIOLATION_ROWS)
def policy_violations_long_query(spark, sf_dir):
    wide = _order_entities(spark, sf_dir)
    paths = list(dict.fromkeys(r.path for r in ORDER_RULES))
    values = F.map_from_arrays(F.array(*map(F.lit, paths)), F.array(*[F.col(p).cast("string") for p in paths]))
    long = wide.select(
        F.col("o_orderkey").cast("string").alias("entity_id"), F.explode(values).alias("path", "value")
    ).filter(F.col("value").isNotNull())
    return policy_violations_long(long, rules_frame(spark, ORDER_RULES))


@query(
    "policy_summary",
    ORDER_VIOLATIONS
    + """
    , listed(path, rule_type) AS (
        VALUES ('o_orderstatus', 'fixed'), ('o_totalprice', 'range'), ('o_orderpriority', 'regex'),
               ('c_mktsegment', 'allowlist'), ('c_mktsegment', 'length'), ('hold', 'forbidden'), ('owner', 'required'),
               ('region', 'forbidden')),
    counted AS (
        SELECT path, rule_type, count(DISTINCT o_orderkey) AS violating FROM violations GROUP BY path, rule_type
        UNION ALL
        SELECT 'all', 'any', count(DISTINCT o_orderkey) FROM violations),
    every AS (SELECT path, rule_type FROM listed UNION ALL SELECT 'all', 'any')
    SELECT path, rule_type, (SELECT count(*) FROM entities) AS checked, coalesce(violating, 0) AS violating,
           round(coalesce(violating, 0) / (SELECT count(*) FROM entities), 4) AS share
    FROM every LEFT JOIN counted USING (path, rule_type)
    """,
)
def policy_summary_query(spark, sf_dir):
    entities = _order_entities(spark, sf_dir).withColumn("region", F.lit(None).cast("string"))
    rules = [*ORDER_RULES, Rule("region", "forbidden")]
    return policy_summary(policy_violations(entities, "o_orderkey", rules), entities, rules)


@query(
    "hide_attributes",
    """
    SELECT cast(p_partkey AS varchar) AS entity_id, path, value FROM (
        SELECT p_partkey, 'p_name' AS path, p_name AS value FROM part
        UNION ALL SELECT p_partkey, 'p_brand', p_brand FROM part
        UNION ALL SELECT p_partkey, 'p_size', cast(p_size AS varchar) FROM part)
    """,
)
def hide_attributes_query(spark, sf_dir):
    columns = ["p_name", "p_brand", "p_size", "p_retailprice"]
    parts = table(spark, sf_dir, "part")
    values = F.map_from_arrays(
        F.array(*[F.lit(c) for c in columns]), F.array(*[F.col(c).cast("string") for c in columns])
    )
    long = parts.select(F.col("p_partkey").cast("string").alias("entity_id"), F.explode(values).alias("path", "value"))
    rules = [Rule("p_retailprice", "unlimited", hidden=True), Rule("p_size", "range", max_value=50)]
    return hide_attributes(long, rules_frame(spark, rules))


@query(
    "lease_status",
    """
    SELECT event_id,
           CASE WHEN event_type = 'error' THEN 'missing'
                WHEN ts <= TIMESTAMP '2024-01-15 00:10:00' THEN 'expired' ELSE 'valid' END AS lease
    FROM events
    """,
)
def lease_status_query(spark, sf_dir):
    expiry = F.when(F.col("event_type") != "error", F.col("ts"))
    leases = table(spark, sf_dir, "events").select("event_id", expiry.alias("expiry"))
    return lease_status(leases, "expiry", datetime(2024, 1, 15)).drop("expiry")


@query(
    "only_configured",
    "SELECT doc_id, quality, toxic FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL AND toxic IS NOT NULL",
)
def only_configured_query(spark, sf_dir):
    return only_configured(_labelled(spark, sf_dir), ["quality", "toxic"])
