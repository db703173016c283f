from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakewarden.operators.monitor import (
    cost_by_tag,
    enrich_logs,
    provisioning_stats,
    resample_metrics,
    run_outcomes,
    throughput_need,
)


def at(second, micro=0):
    return datetime(2024, 1, 1, 0, 0, second, micro)


def test_cost_by_tag(spark):
    usage = spark.createDataFrame(
        [
            ({"costCenter": "ABCDE-12345"}, 1.0),
            ({"costCenter": "ABCDE-12345", "o": "x"}, 2.0),
            ({"costCenter": "xABCDE-12345"}, 4.0),
            ({"costCenter": ""}, 8.0),
            ({"o": "x"}, 16.0),
            (None, 32.0),
        ],
        "tags map<string,string>, cost double",
    )
    got = {r["tag_value"]: (r["cost"], r["rows"]) for r in cost_by_tag(usage, "costCenter", "cost").collect()}
    assert got == {"ABCDE-12345": (3.0, 2), "invalid": (4.0, 1), "untagged": (56.0, 3)}


def test_resampling(spark):
    df = spark.createDataFrame(
        [("m", at(0), 1, 5.0), ("m", at(4, 999_999), 2, 1.0), ("m", at(4, 999_999), 3, 2.0), ("m", at(5), 4, 9.0)],
        "metric string, ts timestamp_ntz, seq int, value double",
    )
    got = resample_metrics(df, ["metric"], "ts", "value", "seq").sort("period_start").collect()
    assert [tuple(r) for r in got] == [
        ("m", at(0), 2.0, 1.0, 5.0, 8.0 / 3, 3),
        ("m", at(5), 9.0, 9.0, 9.0, 9.0, 1),
    ]


def test_provisioning(spark):
    audit = spark.createDataFrame(
        [(1, "user", "create"), (1, "user", "create"), (2, "user", "delete"), (3, "group", "create"), (3, "user", "create")],
        "cycle_id int, object_type string, action string",
    )
    got = provisioning_stats(audit).sort("cycle_id").collect()
    assert [(r["user_create"], r["user_create_to_date"], r["user_delete_to_date"], r["group_create_to_date"]) for r in got] == [
        (2, 2, 0, 0),
        (0, 2, 1, 0),
        (1, 3, 1, 1),
    ]


def test_outcomes(spark):
    events = spark.createDataFrame(
        [
            (1, at(0), 1, 0, (None,)),
            (1, at(1), 2, 5, ("SUCCESS",)),
            (2, at(1), 3, 0, (None,)),
            (3, at(1), 4, 5, ("FAILED",)),
            (4, at(1), 5, 5, None),
        ],
        "run_id int, ts timestamp_ntz, seq int, end_time long, state struct<result_state:string>",
    )
    got = {r["run_id"]: r["outcome"] for r in run_outcomes(events).collect()}
    assert got == {1: "success", 2: "running", 3: "failed", 4: "failed"}


def test_enrichment(spark):
    logs = spark.createDataFrame([(1, "c1"), (2, "c9"), (3, None)], "id int, cluster string")
    properties = spark.createDataFrame([("c1", "north")], "cluster_id string, region string")
    got = {r["id"]: r["region"] for r in enrich_logs(logs, properties, "cluster", "cluster_id").collect()}
    assert got == {1: "north", 2: None, 3: None}
    with pytest.raises(Exception, match="duplicate key"):
        enrich_logs(logs, properties.unionByName(properties), "cluster", "cluster_id").collect()


def test_throughput(spark):
    events = spark.createDataFrame(
        [(at(0), 1), (at(1), 19), (at(10), 21), (at(20), 1000)], "ts timestamp_ntz, size long"
    )
    need = throughput_need(events, "ts", F.col("size"), window_seconds=10, unit_rate=2.0, hi=3)
    got = [(r["events"], r["bytes"], r["units"], r["saturated"]) for r in need.sort("window_start").collect()]
    assert got == [(2, 20, 1, False), (1, 21, 2, False), (1, 1000, 3, True)]
