"""Packing documents into sequences of a fixed number of tokens.

Lengths are at most the capacity, so their histogram is small whatever the number of documents, and the driver decides
on the histogram alone: it enumerates patterns of two and three lengths that fill a sequence exactly, fits how often
each is used by non-negative least squares, rounds down, and packs what is left best fit first, again by pattern. The
plan says which ranks of each length go where. Pieces get their rank within their length on the executors.

A null or empty text is the end token alone. Only documents longer than a sequence are cut. Repeated rows are separate
documents. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakewarden.llm.base import map_batches, settled, slices
from lakewarden.llm.bpe import word_bpe

#: Lengths tried as the second of three, and steps of the fit.
PARTNERS, STEPS = 12, 200
#: Rows ranked in one task.
ROWS_PER_RANKING = 1_000_000

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """One row per piece of each document: its ids followed by ``end_id``, cut only where they exceed ``capacity``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(tokenizer)
        end = end_id.to_bytes(4, "little")
        for part, texts in slices(batches, "text"):
            cut = [t.split() for t in texts]
            table = bpe.table({w for words in cut for w in words})
            rows = []
            for name, words in zip(part.column(0).to_pylist(), cut, strict=True):
                ids = b"".join(map(table.__getitem__, words)) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    some = ids[at : at + 4 * capacity]
                    rows.append((name, piece, at // 4, len(some) // 4, zlib.crc32(some)))
            columns = list(zip(*rows, strict=True))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return map_batches(rows, run, PIECES)


def exact_patterns(histogram: np.ndarray, capacity: int) -> list[tuple[int, ...]]:
    """Lengths, two or three of those present, that fill a sequence exactly."""
    present = np.flatnonzero(histogram)
    present = present[present < capacity]
    have = set(present.tolist())
    few = present[np.unique(np.linspace(0, len(present) - 1, PARTNERS).astype(int))].tolist() if len(present) else []
    found = {(b, a) for a in have if (b := capacity - a) in have and b >= a}
    for a in have:
        for b in few:
            c = capacity - a - b
            if c in have:
                found.add(tuple(sorted((a, b, c), reverse=True)))
    return sorted(found, reverse=True)


def fit_counts(patterns: list[tuple[int, ...]], histogram: np.ndarray) -> np.ndarray:
    """How often to use each pattern: non-negative least squares against the histogram, by multiplicative steps."""
    if not patterns:
        return np.zeros(0)
    which = np.repeat(np.arange(len(patterns)), [len(p) for p in patterns])
    length = np.concatenate(patterns)
    target = np.bincount(which, histogram[length], len(patterns))
    uses = np.full(len(patterns), histogram.sum() / len(patterns) / 3 + 1e-9)
    for _ in range(STEPS):
        reached = np.bincount(length, uses[which], len(histogram))
        uses *= target / np.maximum(np.bincount(which, reached[length], len(patterns)), 1e-12)
    return uses


def best_fit_patterns(left: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """Pack a histogram: the largest length first, then always the largest that still fits, as often as counts allow."""
    left, out = left.copy(), []
    while left.any():
        pattern: dict[int, int] = {}
        room = capacity
        while room > 0:
            fits = np.flatnonzero(left[: room + 1])
            fits = fits[::-1]
            size = next((int(s) for s in fits[: len(pattern) + 1] if s not in pattern), 0)
            if not size:
                break
            pattern[size] = min(room // size, int(left[size]))
            room -= size * pattern[size]
        times = min(int(left[s]) // n for s, n in pattern.items())
        for s, n in pattern.items():
            left[s] -= times * n
        out.append((pattern, times))
    return out


def packing_plan(histogram: np.ndarray, capacity: int) -> pd.DataFrame:
    """Where the ranks of each length go: rows (length, first rank, first sequence, per sequence, first offset)."""
    left = histogram.copy()
    chosen: list[tuple[dict[int, int], int]] = []
    patterns = exact_patterns(left, capacity)
    for pattern, uses in zip(patterns, fit_counts(patterns, left), strict=True):
        counts = {s: pattern.count(s) for s in set(pattern)}
        times = min(int(uses), *(int(left[s]) // n for s, n in counts.items()))
        if times > 0:
            chosen.append((counts, times))
            for s, n in counts.items():
                left[s] -= times * n
    chosen += best_fit_patterns(left, capacity)
    rank = np.zeros(len(histogram), np.int64)
    rows, sequence = [], 0
    for counts, times in chosen:
        offset = 0
        for s, n in sorted(counts.items(), reverse=True):
            rows.append((s, rank[s], sequence, n, offset))
            rank[s] += times * n
            offset += s * n
        sequence += times
    plan = pd.DataFrame(rows, columns=["length", "first_rank", "sequence", "per", "offset"], dtype="int64")
    return plan.sort_values(["length", "first_rank"], ignore_index=True)


def ranked(pieces: DataFrame, counts: dict[int, int], rows_per_task: int = ROWS_PER_RANKING) -> DataFrame:
    """Add ``rank``, from 0 within each length. A common length is ranked in many parts, whose sizes are then summed."""
    parts = max(1, -(-max(counts.values(), default=0) // rows_per_task))
    part = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts))
    rows = pieces.withColumn("part", part)
    order = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    within = rows.withColumn("rank", F.row_number().over(order).cast("bigint") - 1)
    if parts == 1:
        return within.drop("part")
    # At most ``capacity`` times ``parts`` rows.
    sizes = rows.groupBy("length", "part").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("length", "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first"))
    return within.join(firsts, ["length", "part"]).withColumn("rank", F.col("rank") + F.col("first")).drop("first", "part")


def pack(pieces: DataFrame, capacity: int = 4096, rows_per_task: int = ROWS_PER_RANKING) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces of at most ``capacity`` tokens."""
    pieces = settled(pieces)
    # One row per length, so at most ``capacity``.
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    histogram = np.zeros(capacity + 1, np.int64)
    for length, count in counts.items():
        histogram[length] = count
    plan = packing_plan(histogram, capacity)
    # Lengths and ranks as one ascending number; a few rows per pattern, and no more patterns than pairs of lengths.
    shift = 40
    keys = (plan["length"].to_numpy() << shift) + plan["first_rank"].to_numpy()
    held = pieces.sparkSession.sparkContext.broadcast((keys, *(plan[c].to_numpy() for c in ("first_rank", "sequence", "per", "offset"))))

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, first, sequence, per, offset = held.value
        for frame in frames:
            length, rank = frame["length"].to_numpy(), frame.pop("rank").to_numpy()
            at = np.searchsorted(keys, (length << shift) + rank, "right") - 1
            nth = rank - first[at]
            frame["sequence_id"] = sequence[at] + nth // per[at]
            frame["offset"] = offset[at] + nth % per[at] * length
            yield frame

    return ranked(pieces, counts, rows_per_task).select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInPandas(
        place, f"{PIECES}, sequence_id bigint, offset bigint"
    )


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """Documents cut into pieces and placed: every row says where its tokens stand."""
    return pack(token_pieces(docs, tokenizer, capacity, end_id), capacity)
