import pytest
from pyspark.sql import functions as F

from lakewarden.plans.sizing import join_groups, local_table, rows_at_most, unique_by


def test_bounded_rows(spark):
    assert rows_at_most(spark.range(3), 2) is None
    assert [r["id"] for r in rows_at_most(spark.range(3), 3)] == [0, 1, 2]


@pytest.mark.parametrize("kind", ["int", "bigint", "double", "decimal(10,2)", "string", "string collate UTF8_LCASE"])
def test_joining_groups_of_any_type(spark, kind):
    left = spark.sql(f"SELECT cast(id AS {kind}) AS a FROM range(10)")
    for other in ("int", "bigint", "double", kind):
        groups = spark.sql(f"SELECT cast(id AS {other}) AS b, count(*) AS n FROM range(5) GROUP BY 1")
        if "string" in kind:
            groups = groups.withColumn("b", F.col("b").cast("string").cast(kind))
            groups = groups if other != "double" else groups.withColumn("b", F.regexp_replace("b", r"[.]0$", "").cast(kind))
        assert join_groups(left, groups, [("a", "b")]).count() == 5, other
        assert join_groups(left, groups, [("a", "b")], "left_anti").count() == 5, other


def test_joining_groups_on_nulls(spark):
    left = spark.sql("SELECT * FROM VALUES (1), (null) t(a)")
    groups = spark.sql("SELECT * FROM VALUES (1, 2), (null, 3) t(b, n)")
    assert join_groups(left, groups, [("a", "b")]).count() == 1
    assert join_groups(left, groups, [("a", "b")], nulls=True).count() == 2


def test_negative_zero_equals_zero(spark):
    left = spark.sql("SELECT -0.0D AS a")
    assert join_groups(left, spark.sql("SELECT 0.0D AS b"), [("a", "b")]).count() == 1


def test_local_tables_have_a_known_size(spark):
    df = local_table(spark, [(1, "x", None), (2, None, ["y"])], "a int, b string, c array<string>")
    assert [tuple(r) for r in df.collect()] == [(1, "x", None), (2, None, ["y"])]
    assert "LocalTableScan" in df._jdf.queryExecution().executedPlan().toString()
    assert local_table(spark, [], "a int").count() == 0


def test_unique_keys_pass(spark):
    df = spark.range(5)
    assert unique_by(df, ["id"], "t").count() == 5
    with pytest.raises(Exception, match="t: duplicate key"):
        unique_by(df.unionByName(df), ["id"], "t").collect()
