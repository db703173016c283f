from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
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
from lakewarden.plans.sizing import local_table

SCHEMA = "k int, a string, b int"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_diff(spark):
    source = spark.createDataFrame([(1, "x", 1), (2, None, 2), (3, "z", None)], SCHEMA)
    target = spark.createDataFrame([(2, None, 2), (3, "z", 3), (4, "w", 4)], SCHEMA)
    assert rows(sync_diff(source, target, "k", ["a", "b"])) == [
        (1, "create", "x", 1),
        (2, "unchanged", None, 2),
        (3, "update", "z", None),
        (4, "delete", "w", 4),
    ]


table = st.dictionaries(st.integers(0, 8), st.tuples(st.sampled_from(["x", "y", None]), st.integers(0, 2)), max_size=8)


@settings(max_examples=8, deadline=None)
@given(source=table, target=table)
def test_diff_after_upsert_has_nothing_to_do(spark, source, target):
    s = spark.createDataFrame([(k, *v) for k, v in source.items()], SCHEMA)
    t = spark.createDataFrame([(k, *v) for k, v in target.items()], SCHEMA)
    changes = sync_diff(s, t, "k", ["a", "b"]).filter("action IN ('create', 'update')").drop("action")
    after = upsert(t, changes, "k")
    assert {r["action"] for r in sync_diff(s, after, "k", ["a", "b"]).collect()} <= {"unchanged", "delete"}
    assert {r["k"]: (r["a"], r["b"]) for r in after.collect()} == {**target, **source}


def test_upsert_and_insert(spark):
    target = spark.createDataFrame([(1, "x", 1), (2, "y", 2)], SCHEMA)
    source = spark.createDataFrame([(2, "new", None), (3, "z", 3)], SCHEMA)
    assert rows(upsert(target, source, "k")) == [(1, "x", 1), (2, "new", None), (3, "z", 3)]
    assert rows(insert_if_absent(target, source, "k")) == [(1, "x", 1), (2, "y", 2), (3, "z", 3)]
    twice = source.unionByName(source)
    for merge in (upsert, insert_if_absent):
        with pytest.raises(Exception, match="duplicate key"):
            merge(target, twice, "k").collect()
        with pytest.raises(ValueError, match="columns differ"):
            merge(target, source.drop("b"), "k")


def test_duplicate_check_survives_column_pruning(spark):
    target = spark.createDataFrame([(1, "x", 1)], SCHEMA)
    twice = spark.createDataFrame([(3, "z", 3), (3, "z", 3)], SCHEMA)
    with pytest.raises(Exception, match="duplicate key"):
        upsert(target, twice, "k").select("b").collect()
    with pytest.raises(Exception, match="duplicate key"):
        upsert(target, twice, "k").count()


def test_upsert_broadcasts_a_small_source(spark, tmp_path):
    spark.range(1000).select("id", F.lit(1).alias("v")).write.parquet(f"{tmp_path}/t")
    target = spark.read.parquet(f"{tmp_path}/t")
    source = local_table(spark, [(1, 2)], "id long, v int")
    assert "BroadcastHashJoin" in upsert(target, source, "id")._jdf.queryExecution().executedPlan().toString()


def test_replacements(spark):
    rules = spark.createDataFrame([("a.b", "1"), ("aXb", "2"), ("c", None)], "name string, value string")
    new = spark.createDataFrame([("a.b", "9"), ("c", "3"), ("d", "4")], "name string, value string")
    assert rows(apply_replacements(rules, new)) == [("a.b", "9"), ("aXb", "2"), ("c", "3")]
    assert rows(unmatched_replacements(rules, new)) == [("d", "4")]


def test_drift_between_environments(spark):
    values = {
        "harbour": ("lisbon", "oslo", "oslo"),
        "stage": ("dev", "tst", "prd"),
        "berths": ("12", "40", "40"),
        "tide_table": ("spring",) * 3,
        "only_in_test": (None, "x", None),
    }
    docs = spark.createDataFrame(
        [(e, p, v) for p, vs in values.items() for e, v in zip(("dev", "tst", "prd"), vs, strict=True) if v],
        "env string, path string, value string",
    )
    result = config_drift(docs, ["dev", "tst", "prd"], "dev", ignore=["stage"])
    got = {r["path"]: (r["drift"], r["missing"]) for r in result.collect()}
    assert got == {
        "harbour": (True, ""),
        "berths": (True, ""),
        "tide_table": (False, ""),
        "only_in_test": (True, "dev,prd"),
    }


maps = st.dictionaries(st.sampled_from("abc"), st.sampled_from(["1", "2", None]), max_size=3)


@settings(max_examples=8, deadline=None)
@given(a=maps, b=maps, c=maps)
def test_merging_maps_is_associative(spark, a, b, c):
    kind = "map<string,string>"
    df = spark.createDataFrame([(a, b, c)], f"a {kind}, b {kind}, c {kind}")
    left, right, ab = df.select(
        merge_maps(merge_maps("a", "b"), "c"), merge_maps("a", merge_maps("b", "c")), merge_maps("a", "b")
    ).first()
    assert left == right
    assert ab == {k: b[k] if b.get(k) is not None else a.get(k) for k in {*a, *b}}


CHANGES = [
    ("a", datetime(2024, 1, 1), 1, "put"),
    ("a", datetime(2024, 1, 2), 2, "put"),
    ("a", datetime(2024, 1, 2), 3, "drop"),
    ("b", datetime(2024, 1, 2), 4, "put"),
    ("b", datetime(2024, 1, 9), 5, "put"),
]


def test_state_as_of(spark):
    changes = spark.createDataFrame(CHANGES, "k string, ts timestamp_ntz, seq int, op string")

    def at(day, **kwargs):
        state = state_as_of(changes, "k", "ts", "seq", datetime(2024, 1, day), is_delete=F.col("op") == "drop", **kwargs)
        return {(r["k"], r["seq"]) for r in state.collect()}

    assert at(1) == {("a", 1)}
    assert at(2) == {("b", 4)}
    assert at(9, now=datetime(2024, 1, 16)) == {("b", 5)}
    with pytest.raises(ValueError, match="older than the 7 days"):
        at(8, now=datetime(2024, 1, 16))


@pytest.mark.parametrize("rows_per_task", [None, 1, 2])
def test_versions(spark, rows_per_task):
    changes = spark.createDataFrame(CHANGES, "k string, ts timestamp_ntz, seq int, op string")
    got = version_history(changes, "k", "ts", "seq", rows_per_task=rows_per_task)
    assert sorted((r["seq"], r["version_no"], r["valid_to"], r["is_current"]) for r in got.collect()) == [
        (1, 1, datetime(2024, 1, 2), False),
        (2, 2, datetime(2024, 1, 2), False),
        (3, 3, None, True),
        (4, 1, datetime(2024, 1, 9), False),
        (5, 2, None, True),
    ]
