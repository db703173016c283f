"""A quality classifier by co-training on two views of a document: its text, and its metadata.

Each view has a classifier of its own. In every round each one labels documents of an unlabelled pool, and those it is
most sure of join the other one's training rows. In the end both views are calibrated on labelled rows set aside, a
third small model combines the calibrated views, and every document of the table is scored.

Fitting takes place on bounded samples: ``LABELLED`` labelled and ``POOL`` unlabelled documents at most, those with the
least hashes of their ids. Scoring covers all documents. Labels without an id or a value are left out, a document's
conflicting labels are averaged and taken as good from a half on. With labels of one kind only, every document gets that
kind's score. Null text, language, source or size are values of their own. Null ids are scored like any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewarden.llm.base import HASHES, map_batches, slices

#: Bounds of the samples that are fitted on the driver.
LABELLED, POOL = 4_000, 6_000
ROUNDS, SURE, SHARE = 4, 0.95, 0.1
WORD_BINS, META_BINS = 256, 64
SIGNS = b"#*$%&|<>!?.,;:"
#: Ridge of the columns of both views: single words weigh little unless many documents speak for them.
RIDGES = (np.concatenate([np.full(12 + len(SIGNS), 0.5), np.full(WORD_BINS, 50.0)]), np.full(META_BINS + 2, 5.0))
#: The columns both views are made from.
NAMED = [f"{c} AS __{c}" for c in ("text", "lang", "source", "n_chars")]


def text_view(text: bytes) -> np.ndarray:
    """Shape of a text, then the shares of its words by hash."""
    words = text.split()
    n = len(words)
    out = np.zeros(12 + len(SIGNS) + WORD_BINS)
    out[0] = np.log1p(n)
    if not n:
        return out
    size = len(text)
    raw = np.frombuffer(text, np.uint8)
    hashes = HASHES.of([w.lower() for w in words])
    kinds, counts = np.unique(hashes, return_counts=True)
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    out[1] = sum(map(len, words)) / n
    out[2] = ((raw >= 65) & (raw <= 90)).sum() / size
    out[3] = ((raw >= 48) & (raw <= 57)).sum() / size
    out[4] = (raw >= 128).sum() / size
    out[5] = len(kinds) / n
    out[6] = counts.max() / n
    out[7] = (hashes[1:] == hashes[:-1]).mean() if n > 1 else 0
    out[8] = np.log1p(len(lines))
    out[9] = 1 - len(set(lines)) / max(1, len(lines))
    out[10] = -(counts / n * np.log(counts / n)).sum() / max(1.0, np.log(n))
    out[11] = np.log1p(max(map(len, words)))
    for i, sign in enumerate(SIGNS):
        out[12 + i] = text.count(sign) / n
    out[12 + len(SIGNS) :] = np.bincount((hashes % np.uint64(WORD_BINS)).astype(np.int64), minlength=WORD_BINS) / np.sqrt(n)
    return out


def metadata_view(lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
    """Hashed indicators of the language, the source, both together and the size's order."""
    out = np.zeros(META_BINS + 2)
    size = -1 if n_chars is None else max(0, int(n_chars)).bit_length()
    for value in (f"l{lang!r}", f"s{source!r}", f"b{lang!r}{source!r}", f"n{size}"):
        out[xxhash.xxh3_64_intdigest(value) % META_BINS] += 1
    out[META_BINS] = size
    out[META_BINS + 1] = n_chars is None
    return out


class Logistic:
    """Logistic regression on standardised columns, by Newton steps with a ridge."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float | np.ndarray = 1.0):
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-6
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        z = np.column_stack([z, np.ones(len(z))])
        w = np.zeros(z.shape[1])
        penalty = np.append(np.broadcast_to(ridge, len(w) - 1), 1e-3)
        for _ in range(12):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            curve = (z * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ z + np.diag(penalty)
            w = w + np.linalg.solve(curve, z.T @ (y - p) - penalty * w)
        self.w = w

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.clip((x - self.mean) / self.scale, -8, 8) @ self.w[:-1] + self.w[-1], -30, 30)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class CoTrained:
    """Both views' classifiers, their calibration and their combination."""

    def __init__(self, views: list[np.ndarray], labels: np.ndarray, pool: list[np.ndarray]):
        self.constant = None if len(set(labels.tolist())) == 2 else float(labels.mean()) if len(labels) else 1.0
        if self.constant is not None:
            return
        aside = np.arange(len(labels)) % 4 == 3  # rows come in the order of a hash
        if len(set(labels[aside].tolist())) < 2 or len(set(labels[~aside].tolist())) < 2:
            aside = np.zeros(len(labels), bool)
        fit = ~aside
        rows = [[v[fit], labels[fit].astype(float)] for v in views]
        free = np.ones(len(pool[0]), bool)
        self.models = [Logistic(x, y, r) for (x, y), r in zip(rows, RIDGES, strict=True)]
        for _ in range(ROUNDS):
            for giver, taker in ((0, 1), (1, 0)):
                left = np.flatnonzero(free)
                if not len(left):
                    break
                p = sigmoid(self.models[giver].logit(pool[giver][left]))
                most = max(1, int(SHARE * len(pool[0]) / 2))
                good, bad = np.argsort(-p, kind="stable")[:most], np.argsort(p, kind="stable")[:most]
                chosen = np.concatenate([good[p[good] >= SURE], bad[p[bad] <= 1 - SURE]])
                if not len(chosen):
                    continue
                rows[taker][0] = np.concatenate([rows[taker][0], pool[taker][left[chosen]]])
                rows[taker][1] = np.concatenate([rows[taker][1], (p[chosen] > 0.5).astype(float)])
                free[left[chosen]] = False
            self.models = [Logistic(x, y, r) for (x, y), r in zip(rows, RIDGES, strict=True)]
        check = aside if aside.any() else fit
        y = labels[check].astype(float)
        logits = [m.logit(v[check])[:, None] for m, v in zip(self.models, views, strict=True)]
        self.calibrations = [Logistic(x, y, 0.1) for x in logits]
        self.combined = Logistic(np.column_stack([c.logit(x) for c, x in zip(self.calibrations, logits, strict=True)]), y, 0.1)

    def scores(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities of good quality by text, by metadata, and by both."""
        if self.constant is not None:
            same = np.full(len(text), self.constant)
            return same, same, same
        views = [c.logit(m.logit(v)[:, None]) for c, m, v in zip(self.calibrations, self.models, (text, meta), strict=True)]
        return sigmoid(views[0]), sigmoid(views[1]), sigmoid(self.combined.logit(np.column_stack(views)))


def views_of(part: pa.RecordBatch, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    meta = zip(*(part.column(part.schema.get_field_index(c)).to_pylist() for c in ("__lang", "__source", "__n_chars")), strict=True)
    return np.array([text_view(t) for t in texts]), np.array([metadata_view(*m) for m in meta])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", labelled: int = LABELLED, pool: int = POOL) -> CoTrained:
    """Train on bounded samples of labelled and of other documents."""
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg((F.avg(label) >= 0.5).cast("int").alias("y"))
    )
    order = F.xxhash64("doc_id")
    # Both samples are bounded by their limits, so their ids may be broadcast.
    given = known.join(docs.select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct(), "doc_id", "left_semi").orderBy(order, "doc_id").limit(labelled)
    other = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id")).filter("doc_id is not null").distinct()
        .join(known, "doc_id", "left_anti").orderBy(order, "doc_id").limit(pool).withColumn("y", F.lit(None).cast("int"))
    )
    ids = F.broadcast(given.unionByName(other).withColumn("rank", order).withColumnRenamed("doc_id", "__id"))
    named = docs.selectExpr("cast(doc_id AS bigint) AS __doc", *NAMED)
    rows = named.join(ids, F.col("__doc") == F.col("__id")).select("__text", "__lang", "__source", "__n_chars", "y", "rank")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, "__text"):
            one, two = views_of(part, texts)
            arrays = [part.column(4), part.column(5), *[pa.array(list(v.astype(np.float32)), pa.list_(pa.float32())) for v in (one, two)]]
            yield pa.RecordBatch.from_arrays(arrays, names=["y", "rank", "text", "meta"])

    sample = map_batches(rows, run, "y int, rank bigint, text array<float>, meta array<float>").toArrow()
    # A document that is there twice counts twice; the order makes the result the same on every run.
    y = sample["y"].to_numpy(zero_copy_only=False).astype(float)
    views = [np.array(sample[c].to_pylist(), float).reshape(len(y), len(r)) for c, r in zip(("text", "meta"), RIDGES, strict=True)]
    at = np.lexsort((views[0][:, 0], sample["rank"].to_numpy())) if len(y) else np.zeros(0, int)
    has = ~np.isnan(y[at])
    return CoTrained([v[at][has] for v in views], y[at][has].astype(int), [v[at][~has] for v in views])


def score_documents(docs: DataFrame, model: CoTrained, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of every document with text_score, meta_score, score and kept (score of a half at least)."""
    added = ("text_score", "meta_score", "score")
    fields = [T.StructField(f"k{i}", docs.schema[c].dataType) for i, c in enumerate(keep)]
    schema = T.StructType([*fields, *[T.StructField(c, T.DoubleType()) for c in added], T.StructField("kept", T.BooleanType())])
    # A kept text is the one that is scored, and goes to Python once.
    sent = [i for i, c in enumerate(keep) if c != "text"]
    renamed = docs.selectExpr(*[f"`{keep[i]}` AS k{i}" for i in sent], *NAMED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, "__text"):
            scores = model.scores(*views_of(part, texts))
            kept = [part.column(part.schema.get_field_index(f"k{i}" if c != "text" else "__text")) for i, c in enumerate(keep)]
            arrays = kept + [pa.array(s) for s in scores] + [pa.array(scores[2] >= 0.5)]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return map_batches(renamed, run, schema).toDF(*keep, *added, "kept")
