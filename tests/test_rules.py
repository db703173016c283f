import json

import pytest
from pyspark.sql import functions as F

from lakewarden.operators import rules as R
from lakewarden.operators.rules import Rule

# What an invented chain of greenhouses asks of its climate controllers.
POLICY = {
    "light.hours": {"type": "range", "minValue": 6, "maxValue": 18},
    "mode": {"type": "fixed", "value": "auto"},
    "override_code": {"type": "forbidden", "hidden": True},
    "firmware": {"type": "regex", "pattern": "fw-[0-9]+[a-d]?", "hidden": False},
    "crop": {"type": "allowlist", "values": ["basil", "tomato", "orchid"], "defaultValue": "basil"},
    "vents.floor": {"type": "fixed", "value": 2, "hidden": True},
    "vents.ceiling": {"type": "range", "maxValue": 7, "defaultValue": 4},
    "site.code": {"type": "regex", "pattern": "GH[a-z]{3}", "isOptional": False},
    "site.label": {"type": "unlimited", "minLength": 3, "maxLength": 8},
    "debug.*": {"type": "forbidden", "hidden": True},
    "zones.0.feed.valve": {"type": "fixed", "value": "north"},
    "zones.*.feed.valve": {"type": "forbidden"},
    "zones.*.lamp.valve": {"type": "forbidden"},
}
RULES = R.rules_from_policy(json.dumps(POLICY))
PLAIN = {"firmware": "fw-31c", "crop": "tomato", "vents.floor": "2", "vents.ceiling": "7", "site.code": "GHabc", "site.label": "Nursery"}
ENTITIES = {
    "unit_a": {"firmware": "fx-31", "crop": "fern", "fans": "3"},
    "unit_b": {**PLAIN, "vents.ceiling": "7.5"},
    "unit_c": {**PLAIN, "zones.0.feed.valve": "north", "zones.1.feed.valve": "x"},
    "unit_d": {**PLAIN, "site.code": "GHabcd"},
    "unit_e": {**PLAIN, "debug.4": "k", "light.hours": "5"},
    "unit_f": {**PLAIN, "site.label": "Nurseries", "light.hours": "18"},
}
EXPECTED = {
    ("unit_a", "firmware", "regex"),
    ("unit_a", "crop", "allowlist"),
    ("unit_a", "site.code", "required"),
    ("unit_b", "vents.ceiling", "range"),
    ("unit_c", "zones.1.feed.valve", "forbidden"),
    ("unit_d", "site.code", "regex"),
    ("unit_e", "debug.4", "forbidden"),
    ("unit_e", "light.hours", "range"),
    ("unit_f", "site.label", "length"),
}


@pytest.fixture(scope="module")
def entities(spark):
    rows = [(e, p, v) for e, attributes in ENTITIES.items() for p, v in attributes.items()]
    return spark.createDataFrame(rows, "entity_id string, path string, value string")


def found(violations):
    return {(r["entity_id"], r["path"], r["rule_type"]) for r in violations.collect()}


@pytest.mark.parametrize("compiled", [True, False])
def test_long_form_known_answers(spark, entities, monkeypatch, compiled):
    if not compiled:
        monkeypatch.setattr(R, "COMPILED_RULES", 0)
    assert found(R.policy_violations_long(entities, R.rules_frame(spark, RULES))) == EXPECTED


def test_wide_form_agrees_with_long_form(spark, entities):
    paths = sorted({p for e in ENTITIES.values() for p in e})
    values = F.map_from_entries(F.collect_list(F.struct("path", "value")))
    wide = entities.groupBy("entity_id").agg(values.alias("m")).select(
        "entity_id", *[F.try_element_at("m", F.lit(p)).alias(p) for p in paths]
    )
    a = R.policy_violations(wide, "entity_id", RULES)
    b = R.policy_violations_long(entities, R.rules_frame(spark, RULES))
    assert a.columns == b.columns
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


MANY = [
    Rule("mode", "fixed", value="auto"),
    Rule("mode", "required", max_length=5),
    Rule("mode", "allowlist", values=["auto", "eco"]),
    Rule("mode", "required", max_length=5),
    Rule("size", "range", max_value=9.0, default_value="10"),
    Rule("size", "regex", pattern="[0-9]+"),
    Rule("owner", "required"),
    Rule("note", "unlimited", min_length=2),
    Rule("a.*", "forbidden"),
    Rule("a.*", "regex", pattern="q+"),
]


@pytest.mark.parametrize("compiled", [0, 3, 500])
@pytest.mark.parametrize("turned", [False, True])
def test_rules_in_any_order_and_number(spark, monkeypatch, compiled, turned):
    """Several rules on one path hold together, whatever their order and however they are planned."""
    monkeypatch.setattr(R, "COMPILED_RULES", compiled)
    rules = MANY[::-1] if turned else MANY
    rows = [("e", "mode", "manual"), ("e", "size", None), ("e", "a.b", "qp"), ("e", "note", "x"), ("f", "owner", ""), ("f", "note", "xy")]
    frame = spark.createDataFrame(rows, "entity_id string, path string, value string")
    ids = spark.createDataFrame([("e",), ("bare",)], "entity_id string")
    got = R.policy_violations_long(frame, R.rules_frame(spark, rules), ids).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(
        [
            ("e", "mode", "fixed", "auto", "manual"),
            ("e", "mode", "required", "length 1..5", "manual"),
            ("e", "mode", "allowlist", "auto,eco", "manual"),
            *[(x, "size", "range", "..9", "10") for x in ("e", "f", "bare")],
            *[(x, "owner", "required", "length 1..", v) for x, v in (("e", None), ("f", ""), ("bare", None))],
            ("e", "note", "length", "length 2..", "x"),
            ("e", "a.b", "forbidden", "absent", "qp"),
            ("e", "a.b", "regex", "q+", "qp"),
        ],
        key=repr,
    )
    wide = spark.createDataFrame([("e", "manual", "x", "qp")], "entity_id string, mode string, note string, `a.b` string")
    same = R.policy_violations(wide, "entity_id", rules).collect()
    assert sorted(map(tuple, same), key=repr) == sorted((tuple(r) for r in got if r["entity_id"] == "e"), key=repr)


@pytest.mark.parametrize("compiled", [0, 500])
def test_more_rules_than_literals(spark, monkeypatch, compiled):
    monkeypatch.setattr(R, "COMPILED_RULES", compiled)
    rules = [Rule(f"p{i}", "regex", pattern=f"v{i}[xy]") for i in range(20)] + [Rule(f"p{i}", "fixed", value=f"v{i}x") for i in range(10)]
    frame = spark.createDataFrame([("e", f"p{i}", f"v{i}y") for i in range(20)] + [("e", "p19", "v1x")], "entity_id string, path string, value string")
    got = R.policy_violations_long(frame, R.rules_frame(spark, rules)).collect()
    assert {(r["path"], r["rule_type"], r["actual"]) for r in got} == {*[(f"p{i}", "fixed", f"v{i}y") for i in range(10)], ("p19", "regex", "v1x")}


def test_two_fills_are_an_error(spark):
    frame = spark.createDataFrame([("e", "x", "1")], "entity_id string, path string, value string")
    for rules in (
        [Rule("p", "range", max_value=3.0, default_value="1"), Rule("p", "unlimited", default_value="2")],
        [Rule("p", "fixed", value="1"), Rule("p", "fixed", value="2")],
    ):
        with pytest.raises(Exception, match="two fills for p"):
            R.apply_defaults_long(frame, R.rules_frame(spark, rules)).collect()
        with pytest.raises(ValueError, match="two fills for p"):
            R.apply_defaults(frame, rules)
    # A default comes before a fixed value.
    both = [Rule("p", "fixed", value="1"), Rule("p", "unlimited", default_value="2")]
    assert ("e", "p", "2") in map(tuple, R.apply_defaults_long(frame, R.rules_frame(spark, both)).collect())


def test_paths_without_a_column(spark):
    wide = spark.createDataFrame([(1, "x")], "id int, v string")
    rules = [Rule("owner", "required"), Rule("v", "unlimited"), Rule("mode", "fixed", value="auto"), Rule("gone", "forbidden")]
    got = R.policy_violations(wide, "id", rules).collect()
    assert [tuple(r) for r in got] == [("1", "owner", "required", "length 1..", None)]
    assert R.policy_violations(wide, "id", []).count() == 0


def test_wide_form_is_one_scan_without_shuffle(spark, tmp_path):
    spark.range(10).select("id", F.lit("x").alias("mode")).write.parquet(f"{tmp_path}/e")
    wide = spark.read.parquet(f"{tmp_path}/e")
    plan = R.policy_violations(wide, "id", [Rule("mode", "fixed", value="auto")])._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan") :]
    assert "Exchange" not in physical and "Join" not in physical and physical.count("FileScan") == 1


def test_most_specific_rule_wins(spark, monkeypatch):
    rules = R.rules_frame(spark, [Rule(p, "unlimited") for p in ["a.0.x", "a.*.x", "*.0.x", "a.*.*", "b.*", "c"]])
    paths = spark.createDataFrame(
        [("a.0.x",), ("a.1.x",), ("z.0.x",), ("a.1.y",), ("b.q",), ("b.q.r",), ("c",), ("cc",), ("a.0",)], "path string"
    )
    want = {
        "a.0.x": "a.0.x",
        "a.1.x": "a.*.x",
        "z.0.x": "*.0.x",
        "a.1.y": "a.*.*",
        "b.q": "b.*",
        "c": "c",
    }
    assert dict(R.match_rule_paths(paths, rules).collect()) == want
    monkeypatch.setattr(R, "COMPILED_RULES", 0)
    assert {r["path"]: r["rule_path"] for r in R.match_rule_paths(paths, rules).collect()} == want


def test_equally_specific_rules_prefer_the_earlier_name(spark, monkeypatch):
    rules = R.rules_frame(spark, [Rule("a.*", "unlimited"), Rule("*.b", "unlimited")])
    paths = spark.createDataFrame([("a.b",)], "path string")
    assert R.match_rule_paths(paths, rules).first()["rule_path"] == "a.*"
    monkeypatch.setattr(R, "COMPILED_RULES", 0)
    assert R.match_rule_paths(paths, rules).first()["rule_path"] == "a.*"


def test_single_rules_pass_missing_values(spark):
    df = spark.createDataFrame([(1, None), (2, "5"), (3, "x"), (4, "")], "id int, v string")

    def ids(violations):
        return {r["entity_id"] for r in violations.collect()}

    assert ids(R.rule_fixed(df, "id", "v", 5)) == {"3", "4"}
    assert ids(R.rule_range(df, "id", "v", 5, 5)) == {"3", "4"}
    assert ids(R.rule_range(df, "id", "v", 6)) == {"2", "3", "4"}
    assert ids(R.rule_regex(df, "id", "v", "[0-9]|y")) == {"3", "4"}
    assert ids(R.rule_allowlist(df, "id", "v", ["5", "x"])) == {"4"}
    assert ids(R.rule_allowlist(df, "id", "v", df.filter("id = 2").select("v"))) == {"3", "4"}
    assert ids(R.rule_forbidden(df, "id", "v")) == {"2", "3", "4"}
    assert ids(R.rule_required(df, "id", "v")) == {"1", "4"}
    assert ids(R.rule_required(df, "id", "v", 0, 0)) == {"1", "2", "3"}


def test_regex_alternation_matches_whole_value(spark):
    df = spark.createDataFrame([(1, "ab"), (2, "a"), (3, "b\n")], "id int, v string")
    # A trailing line break is part of the value.
    assert {r["entity_id"] for r in R.rule_regex(df, "id", "v", "a|b").collect()} == {"1", "3"}


def test_defaults(spark, entities):
    filled = R.apply_defaults_long(entities, R.rules_frame(spark, RULES))
    got = {(r["path"], r["value"]) for r in filled.filter("entity_id = 'unit_a'").collect()}
    assert ("vents.ceiling", "4") in got and ("mode", "auto") in got
    assert ("crop", "fern") in got and ("site.code", None) in got
    assert filled.groupBy("entity_id", "path").count().filter("count > 1").count() == 0


def test_hidden_attributes(spark, entities):
    rules = R.rules_frame(spark, RULES)
    left = {r["path"] for r in R.hide_attributes(entities, rules).collect()}
    assert "vents.floor" not in left and "debug.4" not in left
    assert {"vents.ceiling", "fans"} <= left
    wide = spark.createDataFrame([(1, 2)], "`vents.floor` int, x int")
    assert R.hide_columns(wide, RULES).columns == ["x"]


def test_summary_counts_entities_once(spark):
    wide = spark.createDataFrame([("a", "x"), ("b", None)], "id string, v string")
    rules = [Rule("v", "fixed", value="y", is_optional=False), Rule("id", "forbidden")]
    summary = R.policy_summary(R.policy_violations(wide, "id", rules), wide, rules)
    got = {(r["path"], r["rule_type"]): (r["checked"], r["violating"], r["share"]) for r in summary.collect()}
    assert got == {
        ("v", "fixed"): (2, 1, 0.5),
        ("v", "required"): (2, 0, 0.0),
        ("id", "forbidden"): (2, 2, 1.0),
        ("all", "any"): (2, 2, 1.0),
    }


def test_summary_of_rules_with_stars(spark, entities):
    violations = R.policy_violations_long(entities, R.rules_frame(spark, RULES))
    summary = R.policy_summary(violations, entities.select("entity_id").distinct(), RULES)
    got = {(r["path"], r["rule_type"]): r["violating"] for r in summary.collect()}
    assert got[("zones.*.feed.valve", "forbidden")] == 1
    assert got[("debug.*", "forbidden")] == 1
    assert got[("zones.0.feed.valve", "fixed")] == 0
    assert got[("site.label", "length")] == 1
    assert got[("all", "any")] == 6 and sum(got.values()) == 6 + len(EXPECTED)


def test_lease_margin(spark):
    leases = spark.createDataFrame([(1, 1600), (2, 1601), (3, None)], "id int, expiry long")
    got = {r["id"]: r["lease"] for r in R.lease_status(leases, "expiry", 1000).collect()}
    assert got == {1: "expired", 2: "valid", 3: "missing"}


def test_only_configured(spark):
    df = spark.createDataFrame([("a", 1), ("", 1), (None, 1), ("b", None)], "s string, n int")
    assert [r["s"] for r in R.only_configured(df, ["s", "n"]).collect()] == ["a"]


def test_rules_survive_the_table_form(spark):
    again = R.rules_from_frame(R.rules_frame(spark, RULES))
    assert sorted(again, key=lambda r: r.path) == sorted(RULES, key=lambda r: r.path)


def test_unknown_rule_type(spark):
    with pytest.raises(ValueError, match="unknown rule type"):
        R.policy_violations(spark.range(1), "id", [Rule("id", "odd")])
