from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakewarden.operators.lifecycle import (
    LifecycleRule,
    default_rules,
    file_size_limits,
    last_access,
    lifecycle_action,
    lifecycle_rules,
    lifecycle_summary,
    retention_sweep,
    with_last_access,
)

AS_OF = datetime(2024, 6, 1)
INVENTORY = "path string, blob_type string, kind string, created_at timestamp_ntz, modified_at timestamp_ntz, last_access timestamp_ntz"


def ago(days, seconds=0):
    return AS_OF - timedelta(days=days, seconds=seconds)


def action(spark, rules, *, path="data/di001/x", blob_type="blockBlob", kind="base", created=0, modified=0, seconds=0, accessed=None):
    row = (path, blob_type, kind, ago(created, seconds), ago(modified, seconds), None if accessed is None else ago(accessed))
    return lifecycle_action(spark.createDataFrame([row], INVENTORY), rules, AS_OF).first()["action"]


def test_age_boundaries(spark):
    rules = default_rules()
    assert action(spark, rules, modified=90) == "hot"
    assert action(spark, rules, modified=90, seconds=1) == "cool"
    assert action(spark, rules, modified=5000) == "cool"
    assert action(spark, rules, modified=400, blob_type="pageBlob") == "hot"
    assert action(spark, rules, kind="snapshot", modified=400, created=5) == "hot"
    assert action(spark, rules, kind="version", modified=5, created=400) == "cool"
    assert action(spark, rules, kind="other", modified=400, created=400) == "hot"


def test_optional_thresholds(spark):
    rules = default_rules(archive=True, delete=True)
    assert action(spark, rules, modified=365) == "cool"
    assert action(spark, rules, modified=366) == "archive"
    assert action(spark, rules, modified=730) == "archive"
    assert action(spark, rules, modified=731) == "delete"


def test_prefixes_several_rules_and_disabled_rules(spark):
    narrow = LifecycleRule("n", "base", "modified", cool_days=None, delete_days=10, prefix_match=["data/di001"])
    off = LifecycleRule("o", "base", "modified", delete_days=1, enabled=False)
    rules = [*default_rules(), narrow, off]
    assert action(spark, rules, modified=100) == "delete"
    assert action(spark, rules, modified=100, path="data/di002/x") == "cool"
    assert action(spark, rules, modified=5) == "hot"
    assert action(spark, [], modified=5000) == "hot"


def test_many_rules_and_rules_from_a_table(spark, monkeypatch):
    schema = (
        "name string, kind string, basis string, cool_days int, archive_days int, delete_days int, "
        "blob_types array<string>, prefix_match array<string>, enabled boolean"
    )
    rows = [(f"r{i}", "base", "modified", 10 + i, None, None, ["blockBlob"], [f"data/di{i:03}"], True) for i in range(7)]
    rows.append(("d", "base", "modified", None, None, 40, ["blockBlob"], None, True))
    rules = lifecycle_rules(spark.createDataFrame(rows, schema))
    monkeypatch.setattr("lakewarden.operators.lifecycle.RULES_PER_STEP", 2)
    assert action(spark, rules, modified=12, path="data/di001/x") == "cool"
    assert action(spark, rules, modified=12, path="data/di002/x") == "hot"
    assert action(spark, rules, modified=41, path="elsewhere") == "delete"
    many = spark.createDataFrame([(f"r{i}", *rows[0][1:]) for i in range(12_000)], schema)
    assert len(lifecycle_rules(many)) == 12_000


def test_age_from_access(spark):
    rules = [LifecycleRule("a", "base", "accessed")]
    assert action(spark, rules, modified=400, accessed=10) == "hot"
    assert action(spark, rules, modified=400, accessed=91) == "cool"
    assert action(spark, rules, modified=400) == "cool"


def test_action_needs_neither_shuffle_nor_join(spark):
    df = spark.createDataFrame([], INVENTORY)
    plan = lifecycle_action(df, default_rules(True, True), AS_OF)._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_summary_levels(spark):
    df = spark.createDataFrame(
        [("c1", "base", "hot", 1), ("c1", "base", "cool", 2), ("c2", "base", "hot", 4)],
        "container string, kind string, action string, bytes long",
    )
    got = {(r["container"], r["action"], r["level"]): (r["objects"], r["bytes"]) for r in lifecycle_summary(df).collect()}
    assert got[(None, None, 7)] == (3, 7) and got[("c1", None, 3)] == (2, 3) and got[("c1", "cool", 0)] == (1, 2)
    assert len(got) == 3 + 2 + 2 + 1


def test_last_access(spark):
    log = spark.createDataFrame(
        [("a", datetime(2024, 1, 1, 5)), ("a", datetime(2024, 1, 2, 23, 59)), ("b", datetime(2024, 1, 1))],
        "object string, at timestamp_ntz",
    )
    accesses = last_access(log, "object", "at")
    assert {tuple(r) for r in accesses.collect()} == {("a", datetime(2024, 1, 2)), ("b", datetime(2024, 1, 1))}
    inventory = spark.createDataFrame([("a",), ("c",)], "path string")
    assert {tuple(r) for r in with_last_access(inventory, accesses).collect()} == {("a", datetime(2024, 1, 2)), ("c", None)}


def test_retention(spark):
    rows = [(1, "logs", ago(120), None), (2, "logs", ago(120, 1), None), (3, "vault", ago(9), ago(7)),
            (4, "vault", ago(9), ago(7, 1)), (5, "other", ago(999), ago(999))]
    df = spark.createDataFrame(rows, "id int, dataset string, ts timestamp_ntz, gone timestamp_ntz")
    policies = spark.createDataFrame([("logs", 120), ("vault", 7)], "dataset string, days int")
    plain = {r["id"]: r["disposition"] for r in retention_sweep(df, policies, AS_OF, "dataset", "ts").collect()}
    assert plain == {1: "keep", 2: "purge", 3: "purge", 4: "purge", 5: "keep"}
    deleted = retention_sweep(df, policies, AS_OF, "dataset", "ts", "gone")
    assert {r["id"]: r["disposition"] for r in deleted.collect()} == {
        1: "keep", 2: "keep", 3: "recoverable", 4: "purge", 5: "keep"
    }


@pytest.mark.parametrize("rows_per_task", [None, 2])
def test_size_limits(spark, rows_per_task):
    df = spark.createDataFrame(
        [("d", i, b) for i, b in enumerate([5, 5, 1, 7, 2])] + [("within", 9, 10), ("free", 9, 99)],
        "dataset string, at int, bytes long",
    )
    limits = spark.createDataFrame([("d", 10), ("within", 10)], "dataset string, max_bytes long")
    got = file_size_limits(df, limits, dataset="dataset", size="bytes", order=["at"], rows_per_task=rows_per_task)
    assert sorted((r["dataset"], r["at"], r["bytes_to_here"], r["crosses"]) for r in got.collect()) == [
        ("d", 2, 11, True),
        ("d", 3, 18, False),
        ("d", 4, 20, False),
    ]


def test_retention_cutoff_prunes_nothing_away(spark):
    df = spark.range(100).select("id", F.lit("x").alias("dataset"), F.lit(AS_OF).cast("timestamp_ntz").alias("ts"))
    policies = spark.createDataFrame([("y", 1)], "dataset string, days int")
    assert retention_sweep(df, policies, AS_OF, "dataset", "ts").count() == 100
