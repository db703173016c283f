"""Scoring texts with a backoff automaton of word n-grams learned from the corpus.

States are the n-grams seen in training shorter than the order, and the beginning of a text; an arc carries a seen
continuation with its smoothed log-probability to the longest state that ends there. A state's failure arc, with a weight
of its own, leads to the state without the oldest word and at last to the root, which has an arc for every word. The
probability of a word after context ``h`` is ``(c(h, word) + MASS * p(word | shorter h)) / (c(h) + MASS)`` and at the root
``(c(word) + 1) / (N + V + 1)``, so the probabilities after any context sum to one. A text is read from left to right once:
each token follows an arc of the state, or failure arcs until there is one. Long texts are read in pieces at a time, side
by side; a piece begins ``order - 1`` tokens early, which is all that its first state depends on.

The corpus' n-grams are too many for any one machine. Tasks cut the rows they read into chunks of bounded size, whatever
the rows are. A chunk asks for the total count of each distinct n-gram that it holds and tells its own training count; requests
are sorted arrays cut by ranges of hashes. The shard of a range adds up all chunks' counts and answers each request in
the order it came. So each chunk gets the part of the automaton that its own texts can visit, however large the whole is.
The chunk's tokens, as numbers, travel with the requests: texts are read and cut into words once, and never shuffled.

Words are told apart by hashes of 64 bits, longer n-grams by 44 bits or more: ``SPARE`` more than it takes to number all
tokens, so that at any size fewer than one n-gram in 2 ** SPARE shares its hash with another. A null text is empty: its only token is the end; very
long texts are read whole. A null id counts as training. Repeated rows are scored alike and each counts in training. An
empty table gives an empty result. Columns beyond the id and the text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewarden.llm.base import HASHES, map_batches, mixed, settled, ship_package, slices, text_bytes

#: Text in a chunk, n-grams in a shard, and the weight of the shorter context.
CHUNK_BYTES, SHARD_ENTRIES, MASS = 6 << 20, 2_000_000, 2.0
#: Bits of the hashes of words, the least bits of those of longer n-grams, and how many are to spare there.
WORD_BITS, LEAST_BITS, SPARE = 64, 44, 14
#: Tokens of a piece.
PIECE = 256
#: Marks no word can equal, as words hold no space.
START, END = (np.uint64(xxhash.xxh3_64_intdigest(m)) for m in (b" start", b" end"))
ROOT = 0

SCORES = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def packed(values: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane, compressed: leading zeros and small counts take little."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return len(values).to_bytes(8, "little") + pa.Codec("zstd", compression_level=4).compress(planes.tobytes(), asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.decompress(data[8:], 8 * n, "zstd", asbytes=True), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def is_held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def gram_bits(total_bytes: int) -> int:
    """Bits for the hashes of n-grams of so many bytes of text; no token is shorter than a byte and a space."""
    return min(WORD_BITS, max(LEAST_BITS, (total_bytes // 2).bit_length() + SPARE))


class Grams:
    """The token sequences of a chunk's documents, and their n-grams up to an order.

    For length k + 1: ``keys[k]`` are the sorted distinct n-grams, ``at[k]`` gives for each token the number of the one
    that ends there (-1: none), ``first[k]`` for each n-gram a token where it ends.
    """

    def __init__(self, tokens: np.ndarray, lengths: np.ndarray, ids: list[int | None], order: int, width: int = LEAST_BITS):
        self.tokens, self.lengths, self.ids = tokens, lengths, ids
        self.held_out = np.array([is_held_out(i) for i in ids], bool)
        self.starts = np.cumsum(lengths) - lengths
        self.place = np.arange(len(tokens)) - np.repeat(self.starts, lengths)
        self.trained = np.repeat(~self.held_out, lengths)
        self.keys, self.at, self.first = [], [], []
        chain = tokens
        for k in range(order):
            if k:
                longer = np.zeros_like(chain)
                longer[1:] = mixed(chain[:-1] * np.uint64(0x9E3779B97F4A7C15) + tokens[1:] + np.uint64(k + 1))
                chain = longer
            ends = np.flatnonzero(self.place >= max(1, k))
            keys, first, number = np.unique(chain[ends] >> np.uint64(64 - width if k else 0), return_index=True, return_inverse=True)
            at = np.full(len(tokens), -1, np.int32)
            at[ends] = number
            self.keys.append(keys)
            self.at.append(at)
            self.first.append(ends[first])

    @classmethod
    def of_texts(cls, ids: list[int | None], texts: list[bytes], order: int, width: int = LEAST_BITS) -> Grams:
        parts, lengths = [], []
        for text in texts:
            words = HASHES.of(text.lower().split())
            parts += [[START], words, [END]]
            lengths.append(len(words) + 2)
        tokens = np.concatenate(parts).astype(np.uint64) if parts else np.zeros(0, np.uint64)
        return cls(tokens, np.array(lengths, np.int64), ids, order, width)

    def to_bytes(self) -> bytes:
        """Tokens as numbers among the distinct ones, lengths and ids."""
        distinct, number, times = np.unique(self.tokens, return_inverse=True, return_counts=True)
        # Frequent words get small numbers, which compress.
        often = np.argsort(-times, kind="stable")
        rank = np.empty(len(often), np.int64)
        rank[often] = np.arange(len(often))
        null = np.array([i is None for i in self.ids], bool)
        ids = np.array([i or 0 for i in self.ids], np.int64).view(np.uint64)
        parts = [packed(np.diff(distinct, prepend=np.uint64(0))), packed(often), packed(rank[number]), packed(self.lengths), packed(null), packed(ids)]
        return b"".join(len(p).to_bytes(8, "little") + p for p in parts)

    @classmethod
    def from_bytes(cls, data: bytes, order: int, width: int = LEAST_BITS) -> Grams:
        parts, at = [], 0
        while at < len(data):
            size = int.from_bytes(data[at : at + 8], "little")
            parts.append(unpacked(data[at + 8 : at + 8 + size]))
            at += 8 + size
        steps, often, number, lengths, null, ids = parts
        known = [None if n else int(i) for i, n in zip(ids.view(np.int64), null, strict=True)]
        words = np.cumsum(steps, dtype=np.uint64)[often.astype(np.int64)]
        return cls(words[number.astype(np.int64)], lengths.astype(np.int64), known, order, width)

    def training_counts(self, k: int) -> np.ndarray:
        held = self.at[k] >= 0
        return np.bincount(self.at[k][held], self.trained[held], len(self.keys[k])).astype(np.uint64)


class Automaton:
    """The part of the automaton that one chunk can visit: states, arcs by (state, word), failure arcs."""

    def __init__(self, grams: Grams, counts: list[np.ndarray], tokens: int, distinct: int, texts: int):
        order = len(grams.keys)
        # A word's number is that of its unigram; the last number is for words that have no arc anywhere.
        self.words = grams.at[0]
        self.unknown = -np.log10(tokens + distinct + 1.0)
        seen = [c > 0 for c in counts]
        self.begin = 1 if texts else ROOT
        number, held, fail, weight = 2, [], [[ROOT, ROOT]], [[0.0, np.log10(MASS / (texts + MASS))]]
        # Nothing follows an end, so n-grams that end with it are no states; arcs to them lead to the root.
        kept = [s & (grams.tokens[first] != END) for s, first in zip(seen, grams.first, strict=True)]
        for k in range(order - 1):
            ids = np.full(len(kept[k]), ROOT, np.int64)
            ids[kept[k]] = number + np.arange(int(kept[k].sum()))
            number += int(kept[k].sum())
            held.append(ids)

        def state(k: int, at: np.ndarray) -> np.ndarray:
            """States of the n-grams of length k that end at these tokens."""
            if k == 0:
                return np.full(len(at), ROOT)
            ids = held[k - 1][grams.at[k - 1][at]]
            return np.where(grams.place[at] == 0, self.begin, ids) if k == 1 else ids

        def count(k: int, at: np.ndarray) -> np.ndarray:
            found = counts[k - 1][grams.at[k - 1][at]].astype(np.float64)
            return np.where(grams.place[at] == 0, float(texts), found) if k == 1 else found

        sources, words, targets, logs, lower = [], [], [], [], None
        for k in range(order):
            end = grams.first[k]
            own = counts[k].astype(np.float64)
            if k == 0:
                probability = (own + 1) / (tokens + distinct + 1)
            else:
                probability = (own + MASS * lower[grams.at[k - 1][end]]) / (count(k, end - 1) + MASS)
            lower = probability
            arcs = end[seen[k]]
            sources.append(state(k, arcs - 1) if k else np.full(len(arcs), ROOT))
            words.append(self.words[arcs])
            # To the state of the n-gram itself, or of its end where it is as long as the order.
            targets.append(state(min(k + 1, order - 1), arcs))
            logs.append(np.log10(probability[seen[k]]))
            if k < order - 1:
                fail.append(state(k, end[kept[k]]))
                weight.append(np.log10(MASS / (own[kept[k]] + MASS)))
        self.fail, self.weight = np.concatenate(fail).astype(np.int64), np.concatenate(weight)
        keys = np.concatenate(sources).astype(np.int64) << 32 | np.concatenate(words)
        by_key = np.argsort(keys, kind="stable")
        # One key more than any, so that each search ends at an arc.
        self.keys = np.append(keys[by_key], np.int64(2**63 - 1))
        self.targets = np.append(np.concatenate(targets)[by_key], ROOT)
        self.logs = np.append(np.concatenate(logs)[by_key], 0.0)

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """From each state by each word: log-probability and next state, over failure arcs where there is no arc."""
        total, after = np.zeros(len(state)), np.full(len(state), ROOT)
        left = np.arange(len(state))
        now = state
        while len(left):
            keys = now << 32 | word[left]
            arc = np.searchsorted(self.keys, keys)
            there = self.keys[arc] == keys
            total[left[there]] += self.logs[arc[there]]
            after[left[there]] = self.targets[arc[there]]
            lost = ~there & (now == ROOT)
            total[left[lost]] += self.unknown
            go = ~there & (now != ROOT)
            left, now = left[go], now[go]
            total[left] += self.weight[now]
            now = self.fail[now]
        return total, after

    def read(self, grams: Grams) -> np.ndarray:
        """Log-probability of each token, by one pass over each text from left to right."""
        order = len(grams.keys)
        out = np.zeros(len(grams.tokens))
        pieces = -(-(grams.lengths - 1) // PIECE)
        text = np.repeat(np.arange(len(grams.lengths)), pieces)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = grams.starts[text] + 1  # after the mark of the beginning
        first = begin + nth * PIECE
        stop = np.minimum(first + PIECE, (grams.starts + grams.lengths)[text])
        at = np.maximum(begin, first - (order - 1))
        state = np.where(at == begin, self.begin, ROOT)
        while len(at):
            total, state = self.step(state, self.words[at].astype(np.int64))
            counted = at >= first
            out[at[counted]] = total[counted]
            at = at + 1
            go = at < stop
            if not go.all():
                at, state, first, stop = at[go], state[go], first[go], stop[go]
        return out


def shard_edges(shards: int, width: int) -> np.ndarray:
    """The first hash of each shard's range."""
    return (np.arange(shards, dtype=np.float64) / shards * 2.0**width).astype(np.uint64)


def score_texts(docs: DataFrame, order: int = 3, doc_id: str = "doc_id", text: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per document: held_out, n_tokens, n_known, train_tokens, base_score and score (log10 of the text's probability).

    Texts are lower-cased (A-Z); a text's tokens are its words and one end. Documents whose crc32(id) mod 7 is 2 are
    held out of training.
    """
    spark = docs.sparkSession
    ship_package(spark)
    total = text_bytes(docs, text)
    width = gram_bits(total)
    # Each order has at most one n-gram per token; a word takes six bytes or so.
    shards = max(1, order * total // 6 // SHARD_ENTRIES)
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    asks = "shard bigint, chunk bigint, k int, keys binary, counts binary"

    def requests(chunk: int, grams: Grams) -> pa.RecordBatch:
        # The tokens go the same way as requests, to a group of their own.
        out = [(-1 - chunk, chunk, -1, grams.to_bytes(), b"")]
        for k, keys in enumerate(grams.keys):
            counts = grams.training_counts(k)
            cuts = np.append(np.searchsorted(keys, shard_edges(shards, width if k else WORD_BITS)), len(keys))
            for s in np.flatnonzero(np.diff(cuts)).tolist():
                part = slice(cuts[s], cuts[s + 1])
                out.append((s, chunk, k, packed(np.diff(keys[part], prepend=np.uint64(0))), packed(counts[part])))
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
        arrays = [pa.array(v, t) for v, t in zip(zip(*out, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=["shard", "chunk", "k", "keys", "counts"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        ids, texts, size = [], [], 0
        for part, some in slices(batches, "text", chunk_bytes // 4):
            ids += part.column(0).to_pylist()
            texts += some
            size += sum(map(len, some))
            if size >= chunk_bytes:
                yield requests(chunk, Grams.of_texts(ids, texts, order, width))
                ids, texts, size, chunk = [], [], 0, chunk + 1
        if ids:
            yield requests(chunk, Grams.of_texts(ids, texts, order, width))

    def answer(group: pa.Table) -> pa.Table:
        n, k = group.num_rows, group["k"][0].as_py()
        sums = [0, 0, 0]
        if k < 0:
            answers = group["keys"].to_pylist()
        else:
            keys = [np.cumsum(unpacked(b), dtype=np.uint64) for b in group["keys"].to_pylist()]
            counts = np.concatenate([unpacked(b) for b in group["counts"].to_pylist()])
            distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
            totals = np.bincount(place, counts, len(distinct)).astype(np.uint64)
            answers = [packed(a) for a in np.split(totals[place], np.cumsum([len(x) for x in keys])[:-1])]
            if k == 0:
                sums = [int(totals.sum()), int((totals > 0).sum()), int(totals[distinct == END].sum())]
        extra = [pa.array([v] + [0] * (n - 1), pa.int64()) for v in sums]
        return pa.table([group["chunk"], group["k"], group["shard"], pa.array(answers, pa.binary()), *extra], names=["chunk", "k", "shard", "counts", "tokens", "types", "endings"])

    replies = settled(
        map_batches(rows, ask, asks).groupBy("shard", "k").applyInArrow(
            answer, "chunk bigint, k int, shard bigint, counts binary, tokens bigint, types bigint, endings bigint"
        )
    )
    tokens, types, endings = (v or 0 for v in replies.agg(F.sum("tokens"), F.sum("types"), F.sum("endings")).first())

    def score(given: pa.Table) -> pa.Table:
        given = given.sort_by([("k", "ascending"), ("shard", "ascending")])
        which, blobs = given["k"].to_numpy(), given["counts"].to_pylist()
        grams = Grams.from_bytes(blobs[0], order, width)
        counts = [np.concatenate([np.zeros(0, np.uint64)] + [unpacked(blobs[i]) for i in np.flatnonzero(which == k)]) for k in range(order)]
        logs = Automaton(grams, counts, tokens, types, endings).read(grams)
        scored = grams.place >= 1
        plain = counts[0][grams.at[0][scored]].astype(np.float64)
        owner = np.repeat(np.arange(len(grams.ids)), grams.lengths)[scored]
        n = len(grams.ids)
        sums = [np.bincount(owner, v, n) for v in (plain > 0, np.log10((plain + 1) / (tokens + types + 1)), logs[scored])]
        arrays = [
            pa.array(grams.ids, pa.int64()),
            pa.array(grams.held_out),
            pa.array(grams.lengths - 1),
            pa.array(sums[0].astype(np.int64)),
            pa.array(np.full(n, tokens)),
            pa.array(sums[1]),
            pa.array(sums[2]),
        ]
        return pa.table(arrays, names=[f.split()[0] for f in SCORES.split(", ")])

    return replies.select("chunk", "k", "shard", "counts").groupBy("chunk").applyInArrow(score, SCORES)
