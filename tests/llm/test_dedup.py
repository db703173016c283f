"""Near-duplicates, vectors and repeated passages against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from lakewarden.llm import near_dedup, substring_dedup, vector_dedup
from lakewarden.llm.components import components
from lakewarden.llm.fm_index import FmIndex
from tests.llm.conftest import SF_DIR, lower, words_of


def shingles(text, size):
    words = words_of(lower(text))
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def roots(ids, linked):
    low = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if low[a] != low[b] and linked(a, b):
                    low[a] = low[b] = min(low[a], low[b])
                    changed = True
    return low


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates(docs, rows, size, percent):
    sets = {r[0]: shingles(r[1], size) for r in rows}

    def linked(a, b):
        both = len(sets[a] & sets[b])
        return both > 0 and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both)

    low = roots([i for i in sets if i is not None], linked)
    got = near_dedup.link_documents(docs, size, percent).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.n_shingles == len(sets[r.doc_id])
        assert (r.component_id, r.kept) == ((low[r.doc_id], low[r.doc_id] == r.doc_id) if r.doc_id is not None else (None, True))


def test_near_duplicates_of_nothing(none):
    assert near_dedup.link_documents(none).count() == 0
    assert near_dedup.drop_near_duplicates(none).columns == none.columns


def test_hub_of_a_chain_of_near_copies(spark):
    """Copies that are like the original only, not like each other, still form one group."""
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words)]
    for i in range(1, 40):
        copy = list(words)
        for j in range(6):
            copy[(i * 9 + j * 61) % 400] = f"new{i}_{j}"
        texts.append(" ".join(copy))
    order = [texts[7], texts[3], *texts[8:], texts[0], *texts[1:3], *texts[4:7]]
    docs = spark.createDataFrame(list(enumerate(order)), "doc_id long, text string")
    got = near_dedup.link_documents(docs, 3, 85).collect()
    sets = [shingles(t, 3) for t in order]
    low = roots(range(len(sets)), lambda a, b: 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]))
    assert {r.doc_id: r.component_id for r in got} == low


@pytest.mark.parametrize("share", [0.75, 0.88])
def test_stars_bound_pairs_and_keep_links(spark, monkeypatch, share):
    """Of 400 documents made from one text, unlike each other, few pairs are compared; copies among them are still found."""
    rng = np.random.default_rng(0)
    base = rng.integers(0, 1 << 60, 300)
    texts = []
    for _ in range(400):
        words = np.where(rng.random(300) < share, base, rng.integers(0, 1 << 60, 300))
        texts.append(words)
    for i in range(60):
        texts.append(np.where(rng.random(300) < 0.95, texts[i], rng.integers(0, 1 << 60, 300)))
    docs = spark.createDataFrame([(i, " ".join(map(str, words))) for i, words in enumerate(texts)], "doc_id long, text string")
    compared = []
    confirm = near_dedup.confirmed
    monkeypatch.setattr(near_dedup, "confirmed", lambda pairs, *rest: compared.append(pairs.count()) or confirm(pairs, *rest))
    got = {r.doc_id: r.component_id for r in near_dedup.link_documents(docs, 1, 80).collect()}
    assert sum(compared) <= 32 * len(texts)
    sets = [set(words.tolist()) for words in texts]
    near = [(a, b) for a in range(460) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert len(near) > 50
    assert np.mean([got[a] == got[b] for a, b in near]) >= 0.95


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7), (200, 150), (None, 3)]
    found = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long").repartition(5)).collect()}
    assert found == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100, 150: 150, 200: 150}


def test_vectors(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(120):
        x = rng.normal(size=8)
        for k in range(rng.integers(1, 4)):
            y = x * rng.uniform(0.5, 2) + rng.normal(size=8) * (0.05 if k else 0)
            rows.append((len(rows), y.tolist(), int(i % 3)))
    rows += [(1000, None, 1), (1001, [0.0] * 8, 1), (1002, [float("nan")] * 8, 1), (1003, [None] * 8, 1), (1004, [], 1), (1005, rows[0][1], None)]
    rows += [(1006 + i, [3.0] * 8, 2) for i in range(30)] + [(1050, [1.0] * 4, 2), (None, [3.0] * 8, 2)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    good = [r for r in rows if r[0] is not None and r[0] not in (1000, 1001, 1002, 1003, 1004, 1005)]
    unit = {r[0]: np.array(r[1]) / np.linalg.norm(r[1]) for r in good}
    label = {r[0]: r[2] for r in good}

    def linked(a, b):
        return a != b and label[a] == label[b] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.98

    low = roots(list(unit), linked)
    degree = {a: sum(linked(a, b) for b in unit) for a in unit}
    for options in ({}, {"per_pivot": 5, "block": 7}):
        got = vector_dedup.link_vectors(frame, **options).collect()
        assert len(got) == len(rows)
        for r in got:
            assert (r.n_links, r.component_id) == (degree.get(r.vec_id, 0), low.get(r.vec_id, r.vec_id))
    assert vector_dedup.link_vectors(frame.limit(0)).count() == 0


def expected_rest(rows, window):
    seen = Counter()
    for r in rows:
        words = words_of(r[1])
        seen.update(tuple(words[i : i + window]) for i in range(len(words) - window + 1))
    out = Counter()
    for r in rows:
        words = words_of(r[1])
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if seen[tuple(words[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out[r[0], len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("small", [False, True])
def test_repeated_passages(docs, rows, small, monkeypatch):
    if small:  # every hash counts as common
        monkeypatch.setattr(substring_dedup.search_shards, "__defaults__", (2, 2000))
    got = substring_dedup.remove_repeats(docs, 35, outputs=("kept_sha256", "cleaned")).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == expected_rest(rows, 35)
    texts = {r[0]: r[1] for r in rows}
    assert all(r.cleaned == texts[r.doc_id] for r in got if not r.n_removed)


def test_repeats_of_nothing(none):
    assert substring_dedup.remove_repeats(none).count() == 0


def test_fm_index():
    rng = np.random.default_rng(1)
    for _ in range(60):
        depth, alphabet = int(rng.integers(1, 6)), int(rng.integers(1, 5))
        runs = [rng.integers(0, alphabet, rng.integers(depth, 20)).astype(np.uint64) for _ in range(rng.integers(1, 8))]
        weights = rng.integers(1, 3, len(runs))
        seen = Counter()
        for run, weight in zip(runs, weights, strict=True):
            for i in range(len(run) - depth + 1):
                seen[tuple(run[i : i + depth])] += int(weight)
        index = FmIndex(runs, depth)
        for run, counts in zip(runs, index.matches(runs, weights), strict=True):
            assert counts.tolist() == [seen[tuple(run[i : i + depth])] for i in range(len(run) - depth + 1)]
        others = [rng.integers(0, alphabet + 1, depth).astype(np.uint64) for _ in range(10)]
        assert [c.tolist() for c in index.matches(others, weights)] == [[seen[tuple(o)]] for o in others]


def test_registered_queries(spark):
    import lakewarden.llm.queries  # noqa: F401  registers them
    from lakewarden.llm.registry import QUERIES

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    got = QUERIES["op9_substring_dedup"](spark, SF_DIR).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == expected_rest(rows, 35)
