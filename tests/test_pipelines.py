"""The three jobs the operators are made for, end to end on small tables."""

import json

from pyspark.sql import functions as F

from lakewarden.functions import resource_id_parts
from lakewarden.operators.changes import apply_replacements, config_drift, sync_diff, upsert
from lakewarden.operators.joins import assign_all, in_scope, resolve_references
from lakewarden.operators.monitor import provisioning_stats, run_outcomes
from lakewarden.operators.rules import Rule, policy_summary, policy_violations_long, rules_frame
from lakewarden.sources import flatten_documents

PARAMETERS = {
    "dev": {"harbour": "lisbon by the sea", "stage": "dev", "berths": "12"},
    "tst": {"harbour": "oslo", "stage": "tst", "berths": "40"},
    "prd": {"harbour": "oslo", "stage": "prd", "berths": "40"},
}


def documents(spark):
    rows = []
    for env, values in PARAMETERS.items():
        values = {**values, "tide": "spring", "pilots": ["mira"]}
        rows.append((env, json.dumps({"settings": {k: {"is": v} for k, v in values.items()}})))
    return spark.createDataFrame(rows, "env string, doc string")


def test_parameter_documents_to_drift_and_constraints(spark):
    leaves = flatten_documents(documents(spark), "env", "doc")
    drift = config_drift(leaves, ["dev", "tst", "prd"], "dev")
    got = {r["path"].removeprefix("settings."): r["drift"] for r in drift.collect()}
    assert got == {"harbour.is": True, "stage.is": True, "berths.is": True, "tide.is": False, "pilots.is.0": False}
    rules = [
        Rule("settings.stage.is", "allowlist", values=["dev", "prd"]),
        Rule("settings.*.is", "unlimited", min_length=2, max_length=9),
        Rule("settings.owner.is", "unlimited", is_optional=False),
    ]
    entities = leaves.withColumnRenamed("env", "entity_id")
    violations = policy_violations_long(entities, rules_frame(spark, rules))
    got = {(r["entity_id"], r["path"].split(".")[1], r["rule_type"]) for r in violations.collect()}
    assert got == {
        ("tst", "stage", "allowlist"),
        *[(e, "owner", "required") for e in PARAMETERS],
        ("dev", "harbour", "length"),
    }
    summary = policy_summary(violations, documents(spark), rules[:1])
    assert {(r["path"], r["violating"]) for r in summary.collect()} == {("all", 3), ("settings.stage.is", 1)}


def test_policies_from_templates_to_resolved_values(spark):
    policy = spark.createDataFrame(
        [("env.PUMP_USER", "old"), ("env.PUMP_FIRMWARE", "f-7"), ("mode", "eco")], "name string, value string"
    )
    values = spark.createDataFrame(
        [("env.PUMP_USER", "{{secrets/pumps/user}}"), ("env.PUMP_FIRMWARE", "f-9")], "name string, value string"
    )
    secrets = spark.createDataFrame([("pumps", "user", "mira")], "scope string, key string, value string")
    resolved = resolve_references(apply_replacements(policy, values), "value", secrets)
    assert {r["name"]: r["resolved"] for r in resolved.collect()} == {
        "env.PUMP_USER": "mira",
        "env.PUMP_FIRMWARE": "f-9",
        "mode": "eco",
    }
    runs = spark.sql(
        "SELECT 1 AS run_id, 1 AS ts, 1 AS seq, 0L AS end_time, struct(cast(null AS string) AS result_state) AS state "
        "UNION ALL SELECT 1, 2, 2, 9L, struct('SUCCESS')"
    )
    assert run_outcomes(runs).first()["outcome"] == "success"


def test_identities_from_members_to_statistics(spark):
    members = spark.createDataFrame(
        [("u1", "g1", "Ann"), ("u2", "g2", "Bea"), ("u3", "g9", "Cem")], "user_id string, group_id string, name string"
    )
    groups = spark.createDataFrame([("g1",), ("g2",)], "principalId string")
    assignments = assign_all(groups, "app", "user")
    assert assignments.count() == 2
    source = in_scope(members, assignments, "group_id", "principalId").select("user_id", "name")
    target = spark.createDataFrame([("u2", "Bee"), ("u7", "Dan")], "user_id string, name string")
    changes = sync_diff(source, target, "user_id", ["name"])
    assert {tuple(r) for r in changes.collect()} == {
        ("u1", "create", "Ann"),
        ("u2", "update", "Bea"),
        ("u7", "delete", "Dan"),
    }
    wanted = changes.filter("action IN ('create', 'update')").drop("action")
    assert {tuple(r) for r in upsert(target, wanted, "user_id").collect()} == {("u1", "Ann"), ("u2", "Bea"), ("u7", "Dan")}
    audit = changes.select(F.lit(1).alias("cycle_id"), F.lit("user").alias("object_type"), "action")
    stats = provisioning_stats(audit).first()
    assert (stats["user_create"], stats["user_update"], stats["user_delete_to_date"], stats["group_create"]) == (1, 1, 1, 0)


def test_ids_of_eight_segments_are_too_short(spark):
    short = "/subscriptions/s/providers/Some.Network/privateDnsZones/zone/extra"
    df = spark.createDataFrame([(short,)], "id string")
    assert len(short.split("/")) == 8
    assert df.select(resource_id_parts("id").alias("p")).first()["p"]["name"] == "incorrectSegmentLength"
