import random

import pytest

from lakewarden.operators.joins import (
    assign_all,
    cidr_lookup,
    collated_join,
    first_match,
    in_scope,
    missing_references,
    resolve_references,
)
from lakewarden.plans.queries.joins import ADDRESS_RANGES, FLOW_RULES, RULE_COLUMNS, event_flows


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_references(spark):
    df = spark.createDataFrame(
        [(1, "{{secrets/s/k}}"), (2, "{{secrets/s/x}}"), (3, "plain"), (4, None), (5, "a {{secrets/s/k}}"), (6, "{{secrets/s/n}}")],
        "id int, v string",
    )
    lookup = spark.createDataFrame([("s", "k", "val"), ("t", "k", "no"), ("s", "n", None)], "scope string, key string, value string")
    got = {r["id"]: (r["resolved"], r["dangling"]) for r in resolve_references(df, "v", lookup).collect()}
    assert got == {
        1: ("val", False),
        2: (None, True),
        3: ("plain", False),
        4: (None, False),
        5: ("a {{secrets/s/k}}", False),
        6: (None, False),
    }


def test_reference_table_with_a_key_twice_fails(spark):
    df = spark.createDataFrame([("{{secrets/s/k}}",)], "v string")
    lookup = spark.createDataFrame([("s", "k", "1"), ("s", "k", "2")], "scope string, key string, value string")
    with pytest.raises(Exception, match="duplicate key"):
        resolve_references(df, "v", lookup).collect()


def test_scope_and_missing(spark):
    members = spark.createDataFrame([("u1", "g1"), ("u2", "g2")], "user_id string, group_id string")
    assigned = spark.createDataFrame([("g1",), ("g1",)], "principalId string")
    assert rows(in_scope(members, assigned, "group_id", "principalId")) == [("u1", "g1")]
    assert in_scope(members, assigned, "group_id", "principalId", sync_all=True).count() == 2
    assert rows(missing_references(members, assigned, "group_id", "principalId")) == [("u2", "g2")]


def test_groups_of_one_application(spark):
    groups = spark.createDataFrame([("g1",), ("g2",)], "principalId string")
    got = assign_all(groups, "app", "user").sort("principalId").collect()
    assert [(r[0], r[1], r[2]) for r in got] == [("g1", "app", "user"), ("g2", "app", "user")]
    assert len({r["assignment_id"] for r in got}) == 2


ADDRESSES = [
    ("172.20.160.5", "lab_a"),
    ("172.20.129.1", "labs"),
    ("172.20.5.5", "campus"),
    ("172.20.203.255", "lab_b"),
    ("172.20.204.0", "labs"),
    ("172.21.31.255", "annex"),
    ("172.21.32.0", "campus"),
    ("8.8.8.8", "anywhere"),
    ("255.255.255.255", "anywhere"),
    ("not an address", None),
    (None, None),
]


@pytest.mark.parametrize("limit", [10_000, 1])
def test_longest_range_wins(spark, limit):
    df = spark.createDataFrame(ADDRESSES, "ip string, want string")
    ranges = spark.createDataFrame(ADDRESS_RANGES, "name string, cidr string")
    for r in cidr_lookup(df, "ip", ranges, limit=limit).collect():
        assert r["range_name"] == r["want"], r


def test_ranges_against_brute_force(spark):
    ranges = [(f"r{i}", f"{i % 7 * 37}.{i * 11 % 256}.0.0/{8 + i % 9}") for i in range(60)]
    ips = [(i * 68_719_477) % 2**32 for i in range(300)] + [(i % 7 * 37 << 24) + (i * 11 % 256 << 16) + i for i in range(200)]

    def best(ip):
        hits = []
        for name, cidr in ranges:
            address, prefix = cidr.split("/")
            number = int.from_bytes(bytes(map(int, address.split("."))))
            shift = 32 - int(prefix)
            if number >> shift == ip >> shift:
                hits.append((-int(prefix), name))
        return min(hits)[1] if hits else None

    df = spark.createDataFrame([(ip,) for ip in ips], "ip long")
    table = spark.createDataFrame(ranges, "name string, cidr string")
    for limit in (10_000, 1):
        got = {r["ip"]: r["range_name"] for r in cidr_lookup(df, "ip", table, limit=limit).collect()}
        assert got == {ip: best(ip) for ip in ips}
        assert sum(v is not None for v in got.values()) > 50


def test_first_match_known_answers(spark):
    flows = spark.createDataFrame(
        [
            ("In", "tcp", 8085, "batch", "web", "Allow", 10),
            ("In", "tcp", 8090, "partner", "web", "Deny", 20),
            ("In", "udp", 5000, "web", "queue", "Allow", 30),
            ("In", "udp", 4999, "web", "queue", "NoMatch", None),
            ("Out", "udp", 514, "web", "store", "Deny", 5),
            ("Out", "tcp", 7070, "batch", "store", "Allow", 15),
            ("Out", "tcp", 7071, "batch", "store", "NoMatch", None),
            ("Out", None, None, "batch", "queue", "Allow", 25),
        ],
        "direction string, protocol string, port int, source string, destination string, want string, want_priority int",
    )
    rules = spark.createDataFrame(FLOW_RULES, RULE_COLUMNS)
    for limit in (256, 1):
        for r in first_match(flows, rules, limit=limit).collect():
            assert (r["access"], r["matched_priority"]) == (r["want"], r["want_priority"]), (limit, r)


def test_no_rules_match_nothing(spark):
    flows = event_flows(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    rules = spark.createDataFrame([], RULE_COLUMNS)
    got = first_match(flows, rules).select("access", "matched_priority").distinct().collect()
    assert [tuple(r) for r in got] == [("NoMatch", None)]
    ranges = spark.createDataFrame([], "name string, cidr string")
    ips = spark.createDataFrame([("1.2.3.4",)], "ip string")
    assert cidr_lookup(ips, "ip", ranges).first()["range_name"] is None


def test_first_match_forms_agree(spark):
    flows = event_flows(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    rules = spark.createDataFrame(FLOW_RULES, RULE_COLUMNS)
    short, long = first_match(flows, rules), first_match(flows, rules, limit=1)
    assert short.columns == long.columns and rows(short) == rows(long)
    assert "NestedLoop" not in long._jdf.queryExecution().toString()
    assert "Exchange" not in short._jdf.queryExecution().toString()


def test_many_rules_of_one_mask(spark):
    """Ten thousand overlapping ranges under one mask: as many joined rows as flows and masks, not rules."""
    rng = random.Random(3)
    ranges = [sorted(rng.choices(range(65_536), k=2)) for _ in range(9_990)]
    rules = [("In", 20_000 - i, "tcp", lo, hi, "a", "*", f"r{i}") for i, (lo, hi) in enumerate(ranges)]
    rules += [("In", 50 + i, "*", lo, hi, "a", "b", f"s{i}") for i, (lo, hi) in enumerate([(5, 4), (100, 200), (None, 20), (65_000, None)])]
    rules += [("In", 90_000, "*", None, None, "*", "*", "any"), ("Out", 1, "tcp", -5, 0, "a", "b", "low")]
    flows = [("In", rng.choice(["tcp", "udp", None]), rng.choice([None, -3, 0, *range(0, 66_000, 37)]), "a", "b") for _ in range(400)]
    flows += [("Out", "tcp", p, "a", "b") for p in (-6, -5, 0, 1, None)] + [(None, "tcp", 5, "a", "b")]
    frame = spark.createDataFrame(list(enumerate(flows)), "id int, f struct<direction: string, protocol: string, port: int, source: string, destination: string>")
    frame = frame.select("id", "f.*")
    result = first_match(frame, spark.createDataFrame(rules, RULE_COLUMNS))
    want = {}
    for i, (direction, protocol, port, source, destination) in enumerate(flows):
        fits = [
            (r[1], r[7]) for r in rules
            if r[0] == direction and r[2] in ("*", protocol) and r[5] in ("*", source) and r[6] in ("*", destination)
            and (r[3] is None or (port is not None and port >= r[3])) and (r[4] is None or (port is not None and port <= r[4]))
        ]
        want[i] = min(fits, default=(None, "NoMatch"))
    assert {r["id"]: (r["matched_priority"], r["access"]) for r in result.collect()} == want
    # No rule column meets the flows: joins are equalities, without conditions on ports.
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert "port_lo" not in " ".join(line for line in plan.split("\n") if "Join" in line)


def test_collation(spark):
    a = spark.createDataFrame([("ABC",), ("é",)], "x string")
    b = spark.createDataFrame([("abc",), ("e",), ("É",)], "y string")
    assert rows(collated_join(a, b, ("x", "y"))) == [("ABC", "abc"), ("é", "É")]
