"""The Merkle tree against one built in a few lines, and against its SQL."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from lakewarden.llm import manifest
from tests.llm.conftest import SF_DIR
from tests.oracle import compare, connect

FIELDS = list(manifest.FIELDS)


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes, arity):
    """The top node, and for every node the pairs of what stands left and right of its way up."""
    ways, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, place in enumerate(places):
            start = place // arity * arity
            ways[i].append(("".join(nodes[start:place]), "".join(nodes[place + 1 : start + arity])))
            places[i] = place // arity
        nodes = [sha(*nodes[i : i + arity]) for i in range(0, len(nodes), arity)]
    return nodes[0], ways


def expected(rows, changed, arity=3):
    groups = {}
    for row in rows:
        groups.setdefault((row[1] is not None, (row[1] or "").encode()), []).append((row[0] is not None, row[0] or 0, leaf(row), leaf(changed(row)), row))
    tops = {g: tree([x[2] for x in sorted(members, key=lambda x: x[:3])], arity) for g, members in groups.items()}
    root, high = tree([tops[g][0] for g in sorted(tops)], arity)
    out = []
    for above, g in zip(high, sorted(tops), strict=True):
        for (_, _, own, now, row), way in zip(sorted(groups[g], key=lambda x: x[:3]), tops[g][1], strict=True):
            steps = [*way, *above]
            node = now
            for left, right in steps:
                node = sha(left, node, right)
            out.append((row[0], own, tops[g][0], root, sha(*(s for step in steps for s in step)), node, node == root))
    return sorted(out, key=repr)


def rows_of(counts):
    rng = random.Random(4)
    rows = []
    for source, n in counts.items():
        for _ in range(n):
            text = rng.choice([None, "", "a\nb", "no line", "Ünï\n中文 😀", "x" * 50_000 + "\n"])
            rows.append((rng.randrange(10**12), source, rng.choice(["en", None]), rng.choice([None, 5]), text))
    return rows


@pytest.mark.parametrize(("arity", "height"), [(3, 6), (3, 1), (3, 2), (2, 2), (5, 1)])
def test_manifest(spark, arity, height):
    rows = rows_of({"a": 100, "b": 1, None: 5, "": 3, "Ω": 28, "z": 27, "é": 2})
    rows += [rows[0]] * 40  # one row very often
    rows += [(rows[1][0], "a", "de", 1, "same id"), (None, "a", None, None, None), (None, "b", "en", 7, "x\n"), (2**62 + 1, "b", "en", 7, "x")]
    frame = spark.createDataFrame([(*r, "extra", 1) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, node string, pos int").repartition(5)
    got = manifest.manifest(frame, FIELDS, "doc_id", "source", {"text": F.replace("text", F.lit("\n"), F.lit(""))}, arity, height)
    want = expected(rows, lambda r: (*r[:4], r[4] and r[4].replace("\n", "")), arity)
    assert sorted(map(tuple, got.collect()), key=repr) == want


def test_untouched_rows_verify(spark):
    rows = rows_of({"a": 30, "b": 30})
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert manifest.manifest(frame, FIELDS, "doc_id", "source").filter("not verified").isEmpty()


def test_small_tables(spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    assert manifest.manifest(spark.createDataFrame([], schema), FIELDS, "doc_id", "source").count() == 0
    one = manifest.manifest(spark.createDataFrame([(1, "s", "en", 2, "ab")], schema), FIELDS, "doc_id", "source").collect()
    own = leaf((1, "s", "en", 2, "ab"))
    assert list(map(tuple, one)) == [(1, own, own, own, sha(), own, True)]


def test_query(spark):
    result = driver.queries()["op11_merkle_manifest"](spark, SF_DIR)
    assert compare(result, connect(SF_DIR), driver.oracle_sql()["op11_merkle_manifest"]) is None
