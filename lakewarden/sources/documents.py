"""Nested JSON documents as (path, value) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flatten_documents(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """One row (id, path, value) per leaf of each JSON document, however deep.

    Object keys and array positions are joined by dots (``init_scripts.0.store.destination``); a dot
    or backslash inside a key is preceded by a backslash. Text that is not JSON and empty containers
    give no row. Every level is one narrow step over the same rows, and nothing is shuffled. How many
    levels there are is found in one pass over the text, which gives one number.
    """
    parsed = df.filter(F.try_parse_json(json_col).isNotNull())
    depth = parsed.agg(F.max(_nesting(F.col(json_col)))).first()[0] or 0
    level = _opened(df, id_col, json_col, depth)
    leaf = F.struct(
        F.coalesce(F.col("path"), F.lit("")).alias("path"),
        F.try_variant_get("node", "$", "string").alias("value"),
        _nested().alias("empty"),
    )
    # Exploding one value keeps later filters on it from repeating the expressions.
    leaves = level.select(F.col(id_col), F.inline_outer(F.array(leaf)))
    return leaves.filter(~F.col("empty")).drop("empty")


def _nesting(text: Column) -> Column:
    """How deep the containers of JSON text are nested: brackets open at once, outside strings."""
    plain = F.replace(F.replace(text, F.lit(r"\\"), F.lit("")), F.lit(r"\""), F.lit(""))
    brackets = F.regexp_replace(F.regexp_replace(plain, '"[^"]*"', ""), r"[^\[\]{}]", "")
    steps = F.split(F.translate(brackets, "[{]}", "(())"), "")
    deepest = F.aggregate(
        steps,
        F.struct(F.lit(0).alias("open"), F.lit(0).alias("most")),
        lambda at, c: F.struct(
            (at["open"] + F.when(c == "(", 1).when(c == ")", -1).otherwise(0)).alias("open"),
            F.greatest(at["most"], at["open"] + F.when(c == "(", 1).otherwise(0)).alias("most"),
        ),
    )
    return deepest["most"]


def _nested() -> Column:
    kind = F.schema_of_variant("node")
    return kind.like("OBJECT<%") | kind.like("ARRAY<%")


def _opened(df: DataFrame, id_col: str, json_col: str, depth: int) -> DataFrame:
    """Rows (id, path, node) with ``depth`` levels of containers opened."""
    spark = df.sparkSession
    level = df.select(
        F.col(id_col),
        F.lit(None).cast("string").alias("path"),
        F.try_parse_json(json_col).alias("node"),
    ).filter(F.col("node").isNotNull())
    for _ in range(depth):
        # A leaf passes through as one row without key and position.
        level = spark.sql(
            rf"""
            SELECT l.`{id_col}`,
                   CASE WHEN c.pos IS NULL THEN l.path
                        ELSE concat_ws('.', l.path, coalesce(
                            replace(replace(c.key, r'\', r'\\'), '.', r'\.'), cast(c.pos AS string))) END AS path,
                   CASE WHEN c.pos IS NULL THEN l.node ELSE c.value END AS node
            FROM {{level}} l, LATERAL variant_explode_outer(l.node) c
            """,
            level=level,
        )
    return level
