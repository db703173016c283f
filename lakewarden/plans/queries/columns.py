"""Queries over column functions, masking and expansion."""

from pyspark.sql import functions as F

from lakewarden.functions import (
    canonical_name,
    deterministic_id,
    fill_template,
    host_prefix,
    resource_id_parts,
    storage_name,
)
from lakewarden.operators.text import expand_grid, index_range, mask_values, name_collisions
from lakewarden.plans.registry import query, table


@query(
    "resource_id_parts",
    """
    WITH split AS (SELECT page_id, string_split(url, '/') AS s FROM pages)
    SELECT page_id,
           CASE WHEN len(s) >= 5 THEN s[3] ELSE 'none' END AS subscription,
           CASE WHEN len(s) >= 5 THEN s[5] ELSE 'none' END AS resource_group,
           CASE WHEN len(s) >= 5 THEN s[9] ELSE 'incorrectSegmentLength' END AS account,
           CASE WHEN len(s) >= 5 THEN s[-1] ELSE 'incorrectSegmentLength' END AS name
    FROM split
    """,
)
def resource_id_parts_query(spark, sf_dir):
    parts = resource_id_parts("url", 5, subscription="none", group="none")
    return table(spark, sf_dir, "pages").select("page_id", parts.alias("p")).select("page_id", "p.*")


@query(
    "deterministic_id",
    """
    WITH hashed AS (
        SELECT c_custkey,
               sha256(concat(length(c_custkey::VARCHAR), ':', c_custkey, length(n_name), ':', n_name,
                             CASE WHEN c_custkey % 3 = 0 THEN '-'
                                  ELSE concat(length(c_mktsegment), ':', c_mktsegment) END)) AS h
        FROM customer JOIN nation ON c_nationkey = n_nationkey)
    SELECT c_custkey, concat_ws('-', h[1:8], h[9:12], h[13:16], h[17:20], h[21:32]) AS id FROM hashed
    """,
)
def deterministic_id_query(spark, sf_dir):
    customers, nations = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    joined = customers.join(nations, customers["c_nationkey"] == nations["n_nationkey"])
    segment = F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment"))
    return joined.select("c_custkey", deterministic_id("c_custkey", "n_name", segment).alias("id"))


@query(
    "fill_template",
    """
    SELECT p_partkey,
           concat('BRAND=b-1', p_brand, ' NAME=n$1 ', p_name, ' NAME=n$1 NAMES=') AS filled
    FROM part
    """,
)
def fill_template_query(spark, sf_dir):
    text = F.concat(
        F.lit("BRAND="), F.col("p_brand"), F.lit(" NAME= "), F.col("p_name"), F.lit(" name= NAMES=")
    )
    values = {"NAME": "n$1", "BRAND": "b-1"}
    return table(spark, sf_dir, "part").select("p_partkey", fill_template(text, values).alias("filled"))


SECRETS = ["the", "then", "tion", "elle", "e."]


@query(
    "mask_values",
    r"SELECT doc_id, regexp_replace(text, 'elle|then|tion|the|e\.', '***', 'g') AS text FROM documents",
)
def mask_values_query(spark, sf_dir):
    return mask_values(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", SECRETS)


@query(
    "mask_table",
    r"""
    WITH secrets AS (
        SELECT p_name AS secret FROM part UNION SELECT c_name FROM customer UNION SELECT concat('tok', event_id) FROM events)
    -- Of the secrets that begin at one place the longest goes: all digits of a number that is an id.
    SELECT event_id, concat('***/',
               CASE WHEN event_id % 5 = 0 THEN concat('x', user_id)
                    WHEN concat('tok', user_id) IN (SELECT secret FROM secrets) THEN '***' ELSE concat('tok', user_id) END,
               ' ', event_type) AS line
    FROM events
    """,
)
def mask_table_query(spark, sf_dir):
    events, parts, customers = (table(spark, sf_dir, t) for t in ("events", "part", "customer"))
    secrets = parts.select(F.col("p_name").alias("secret")).union(customers.select("c_name"))
    secrets = secrets.union(events.select(F.concat(F.lit("tok"), "event_id")))
    second = F.when(F.col("event_id") % 5 == 0, "x").otherwise("tok")
    line = F.concat(F.lit("tok"), "event_id", F.lit("/"), second, "user_id", F.lit(" "), "event_type")
    return mask_values(events.select("event_id", line.alias("line")), "line", secrets)


@query(
    "canonical_name",
    """
    WITH named AS (SELECT p_partkey, lower(concat(p_name, '-', p_brand, '-st')) AS name FROM part)
    SELECT p_partkey, name, replace(name, '-', '') AS storage, left(name, 9) AS host FROM named
    """,
)
def canonical_name_query(spark, sf_dir):
    name = canonical_name("p_name", "p_brand", "st")
    return table(spark, sf_dir, "part").select(
        "p_partkey", name.alias("name"), storage_name(name).alias("storage"), host_prefix(name).alias("host")
    )


@query(
    "name_collisions",
    """
    WITH named AS (SELECT p_partkey, replace(lower(concat(p_name, '-', p_brand)), '-', '') AS storage FROM part)
    SELECT p_partkey, storage, count(*) OVER (PARTITION BY storage) AS sharing FROM named
    QUALIFY count(*) OVER (PARTITION BY storage) > 1
    """,
)
def name_collisions_query(spark, sf_dir):
    name = storage_name(canonical_name("p_name", "p_brand"))
    return name_collisions(table(spark, sf_dir, "part").select("p_partkey", name.alias("storage")), "storage")


@query(
    "expand_grid",
    """
    SELECT p_partkey, cast(i AS integer) AS position, words[i + 1] AS element
    FROM (SELECT p_partkey, words, unnest(range(len(words))) AS i
          FROM (SELECT p_partkey, string_split(p_name, ' ') AS words FROM part))
    """,
)
def expand_grid_query(spark, sf_dir):
    words = F.split("p_name", " ")
    return expand_grid(table(spark, sf_dir, "part").select("p_partkey", words.alias("words")), "words")


@query(
    "index_range",
    "SELECT p_partkey, cast(unnest(range(p_size % 4)) AS integer) AS index FROM part",
)
def index_range_query(spark, sf_dir):
    indexed = table(spark, sf_dir, "part").select("p_partkey", index_range(F.col("p_size") % 4).alias("indexes"))
    return expand_grid(indexed, "indexes", with_index=False, element="index")
