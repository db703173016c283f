import hashlib
import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakewarden.functions import (
    canonical_name,
    deterministic_id,
    fill_template,
    host_prefix,
    ipv4_to_long,
    resource_id_parts,
    storage_name,
)
from lakewarden.functions.columns import any_of
from lakewarden.operators.text import expand_grid, index_range, mask_values, name_collisions

FULL = "/subscriptions/s1/resourceGroups/g1/providers/P/accounts/acc"
SHORT = "/subscriptions/s1/providers/P/accounts/acc/x"


def test_resource_ids(spark):
    df = spark.createDataFrame([(FULL,), (SHORT,), ("a/b/c/d/e",), (None,)], "id string")
    got = [tuple(r["p"]) if r["p"] else None for r in df.select(resource_id_parts("id", 9, "sub", "grp").alias("p")).collect()]
    wrong = ("sub", "grp", "incorrectSegmentLength", "incorrectSegmentLength")
    assert got == [("s1", "g1", "acc", "acc"), wrong, wrong, wrong]
    container = FULL + "/blobServices/default/containers/c1"
    row = spark.createDataFrame([(container,)], "id string").select(resource_id_parts("id", 13).alias("p")).first()["p"]
    assert (row["account"], row["name"]) == ("acc", "c1")


def test_ids_depend_on_values_only(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("", "a"), ("a", None)], "x string, y string")
    got = [r[0] for r in df.select(deterministic_id("x", "y")).collect()]
    assert got[0] == got[3] and len(set(got)) == 3
    digest = hashlib.sha256(b"1:a-").hexdigest()
    assert got[0] == "-".join([digest[:8], digest[8:12], digest[12:16], digest[16:20], digest[20:32]])


def test_template(spark):
    text = F.lit("NAME=\nname= x GRP_NAME=\n")
    filled = spark.range(1).select(fill_template(text, {"NAME": "v$1\\", "GRP": "never"})).first()[0]
    assert filled == "NAME=v$1\\\nNAME=v$1\\ x GRP_NAME=v$1\\\n"


def test_names(spark):
    df = spark.createDataFrame([("Lak-01", "DEV")], "p string, e string")
    name = canonical_name("p", "e", "runtime")
    assert tuple(df.select(name, storage_name(name), host_prefix(name)).first()) == (
        "lak-01-dev-runtime",
        "lak01devruntime",
        "lak-01-de",
    )


def test_collisions(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None), (5, None)], "id int, n string")
    assert {(r["id"], r["sharing"]) for r in name_collisions(df, "n").collect()} == {(1, 2), (3, 2)}


def test_expansion(spark):
    df = spark.createDataFrame([(1, ["x", None]), (2, []), (3, None)], "id int, a array<string>")
    assert [tuple(r) for r in expand_grid(df, "a").collect()] == [(1, 0, "x"), (1, 1, None)]
    assert [tuple(r) for r in expand_grid(df, "a", with_index=False).collect()] == [(1, "x"), (1, None)]
    counts = spark.createDataFrame([(3,), (0,), (-1,), (None,)], "n int").select(index_range("n").alias("r"))
    assert [r["r"] for r in counts.collect()] == [[0, 1, 2], [], [], []]


def test_addresses(spark):
    df = spark.createDataFrame([("10.1.6.7",), ("1.2.3",), ("1.2.3.256",), ("1.2.3.4.5",), ("a.b.c.d",), (None,)], "a string")
    assert [r[0] for r in df.select(ipv4_to_long("a")).collect()] == [167839239, None, None, None, None, None]


SECRETS = ["ab", "abc", "b.", "é", "x|y", "caab"]
TEXTS = ["abcab", "zab.b.", "caabc", "éé x|y \nab", "", "none", None, "aab", "xy"]


def masked(text):
    longest_first = sorted(SECRETS, key=len, reverse=True)
    return None if text is None else re.sub("|".join(map(re.escape, longest_first)), "***", text)


@pytest.mark.parametrize("limit", [1000, 1])
def test_masking(spark, limit):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, t string")
    secrets = spark.createDataFrame([(s,) for s in [*SECRETS, ""]], "s string")
    got = {r["id"]: r["t"] for r in mask_values(df, "t", secrets, limit=limit).collect()}
    assert got == {i: masked(t) for i, t in enumerate(TEXTS)}


def test_masking_with_a_long_table(spark):
    """The same call, schema and rows on both sides of the limit; no id is needed, repeated texts are one."""
    rng = random.Random(7)
    secrets = {"".join(rng.choices("abcd", k=rng.randint(5, 9))) for _ in range(3_000)}
    texts = [None, "", "abcd", *("".join(rng.choices("abcd ", k=rng.randint(0, 400))) for _ in range(60))]
    df = spark.createDataFrame([(t, 1) for t in texts + texts[3:9] * 5], "t string, piece int")
    table = spark.createDataFrame([(s,) for s in sorted(secrets)] + [(None,), ("",)], "secret string")
    long, short = mask_values(df, "t", table), mask_values(df, "t", table, limit=10_000)
    assert long.schema == short.schema == df.schema
    rows = Counter(map(tuple, long.collect()))
    assert rows == Counter(map(tuple, short.collect())) and sum("***" in (t or "") for t, _ in rows) > 40


@pytest.mark.parametrize("shortest", ["tok1", "tok1000"])
def test_places_without_a_secret_are_not_shuffled(spark, shortest):
    """The places of a text meet what secrets begin with by broadcast, with few anchors as with more than the limit."""
    secrets = {f"tok{n:04d}" for n in range(0, 3_600, 3)} | {shortest}
    texts = [f"a text tok{n}, tok{n // 2}" for n in range(980, 1_020)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = mask_values(df, "t", spark.createDataFrame([(s,) for s in sorted(secrets)], "secret string"))
    parents = got._jdf.queryExecution().executedPlan().toString().split("Generate posexplode")[0].splitlines()
    assert "BroadcastHashJoin" in next(p for p in reversed(parents) if "Exchange" in p or "Join" in p)
    longest_first = "|".join(sorted(secrets, key=len, reverse=True))
    assert sorted(r["t"] for r in got.collect()) == sorted(re.sub(longest_first, "***", t) for t in texts)


@pytest.mark.parametrize("limit", [2, 3, 5])
def test_masking_by_anchors_and_by_beginnings(spark, limit):
    df = spark.createDataFrame([(t,) for t in ["xabcd abc", "abcab", "bcd", "zzabdab", "caé", None, "ab", ""] * 2], "t string")
    table = spark.createDataFrame([(s,) for s in ["abc", "abcd", "abd", "bca", "bcd é", "caé"]], "s string")
    want = ["x*** ***", "***ab", "bcd", "zz***ab", "***", None, "ab", ""] * 2
    got = mask_values(df, "t", table, limit=limit)
    assert got.schema == df.schema and Counter(r["t"] for r in got.collect()) == Counter(want)


def test_patterns_of_shared_beginnings():
    assert any_of(["the", "then", "tion", "e."]) == r"(?:e\.|t(?:he(?:n)?|ion))"
    assert any_of(["a.b"]) == r"a\.b"
    nested = ["a" * n for n in range(1, 200)]
    assert any_of(nested).startswith("a" * 199 + "|")
    assert re.sub(any_of(nested), "-", "b" + "a" * 250) == "b--"


def test_masking_a_list(spark):
    df = spark.createDataFrame([("abcab",)], "t string")
    assert mask_values(df, "t", SECRETS).first()["t"] == "******"
    assert mask_values(df, "t", []).first()["t"] == "abcab"


@settings(max_examples=6, deadline=None)
@given(
    texts=st.lists(st.text(alphabet="abcé\n", max_size=30), min_size=1, max_size=6),
    secrets=st.lists(st.text(alphabet="abcé", min_size=1, max_size=4), min_size=2, max_size=6, unique=True),
)
def test_joined_masking_equals_the_expression(spark, texts, secrets):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    table = spark.createDataFrame([(s,) for s in secrets], "s string")
    short = dict(mask_values(df, "t", table).collect())
    assert short == dict(mask_values(df, "t", table, limit=1).collect())


def test_literals_ignore_the_local_time_zone(spark, monkeypatch):
    import time
    from datetime import datetime

    from pyspark.sql.types import TimestampNTZType

    from lakewarden.functions.columns import moment

    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        text = spark.range(1).select(moment(datetime(2024, 7, 1, 12), TimestampNTZType()).cast("string")).first()[0]
    finally:
        monkeypatch.delenv("TZ")
        time.tzset()
    assert text == "2024-07-01 12:00:00"
