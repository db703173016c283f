"""Removal of passages that repeat anywhere in the corpus, found with FM-indexes over shards.

A window is ``window`` consecutive words of a document. Each window belongs to the smallest hash of the ``SEED``-word
runs inside it, so equal windows belong to the same hash wherever they stand. Neighbouring windows with the same hash
form a segment. Hashes that stand at one place only are done with. Segments equal as a whole are merged and counted. Where a hash has
several different segments, these go to the shard of the hash, as words: the shard builds an FM-index and reads the
segments backwards through it, which gives for every window how often it occurs. A hash with very many different
segments is cut into blocks, and each block of segments is searched in the index of each block, one task per pair, so
that memory stays bounded.

A null text has no words. Texts shorter than a window, empty tables and repeated rows are allowed; a row repeated as a
whole is a repeated passage too, so all copies lose it. A null id is an id like any other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewarden.llm.base import HASHES, map_batches, settled, ship_package, slices, window_hashes
from lakewarden.llm.fm_index import FmIndex

SEED = 8
#: Words in a shard's index, and segments of one hash in a block.
SHARD_WORDS, BLOCK_SEGMENTS = 300_000, 10_000

SEGMENT = "m bigint, seg bigint, d bigint, t bigint, s0 int, windows int, twice boolean"
_BASE = np.uint64(0xD6E8FEB86659FD93)


def runs_of_equal(values: np.ndarray, size: int) -> np.ndarray:
    """The least of each ``size`` neighbouring values."""
    width, low = 1, values
    while width * 2 <= size:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    rest = size - width
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def segments_of(texts: list[bytes], window: int) -> tuple[np.ndarray, ...]:
    """Segments of all texts: (text number, first word, windows, least hash, hash of the words, whether it stands there twice)."""
    cut = [t.split() for t in texts]
    sizes = np.array([len(c) for c in cut])
    words = HASHES.of([w for c in cut for w in c])
    if len(words) < window:
        return tuple(np.zeros(0, k) for k in (np.int64, np.int64, np.int64, np.uint64, np.uint64, bool))
    seeds = window_hashes(words, SEED)
    least = runs_of_equal(seeds, window - SEED + 1)
    text = np.repeat(np.arange(len(texts)), sizes)[: len(least)]
    stop = np.repeat(np.cumsum(sizes), sizes)[: len(least)]
    fits = np.arange(len(least)) + window <= stop
    at = np.flatnonzero(fits)
    fresh = np.ones(len(at), bool)
    fresh[1:] = (least[at[1:]] != least[at[:-1]]) | (at[1:] != at[:-1] + 1)
    head = np.flatnonzero(fresh)
    start = at[head]
    count = np.diff(np.append(head, len(at)))
    # A hash of each segment's words from running sums of words times powers of an odd number.
    powers = np.cumprod(np.full(len(words), _BASE))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * powers)])
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    back = np.cumprod(np.full(len(words), inverse))
    seg = (sums[start + count + window - 1] - sums[start]) * back[start] + count.astype(np.uint64)
    # Only a segment that holds its hash at two places can hold a window twice.
    places = count + window - SEED
    inside = np.arange(places.sum()) + np.repeat(start - np.cumsum(places) + places, places)
    holds = np.bincount(np.repeat(np.arange(len(start)), places)[seeds[inside] == np.repeat(least[start], places)], minlength=len(start))
    starts = np.cumsum(sizes) - sizes
    return text[start], start - starts[text[start]], count, least[start], seg, holds > 1


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Whole texts with a key, equal only for rows with the same id and text."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.coalesce(F.col(doc_id).cast("bigint"), F.lit(0)).alias("d"), F.xxhash64(body, F.col(doc_id)).alias("t"), body.alias("text"))


def segments(docs: DataFrame, window: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, "text"):
            text, first, count, least, seg, twice = segments_of(texts, window)
            row = pa.array(text)
            arrays = [
                pa.array(least.view(np.int64)),
                pa.array(seg.view(np.int64)),
                part.column(0).take(row),
                part.column(1).take(row),
                pa.array(first.astype(np.int32)),
                pa.array(count.astype(np.int32)),
                pa.array(twice),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["m", "seg", "d", "t", "s0", "windows", "twice"])

    return map_batches(docs, run, SEGMENT)


def words_of_segments(docs: DataFrame, chosen: DataFrame, window: int) -> DataFrame:
    """The words of the chosen segments, cut from their documents."""
    by_doc = chosen.groupBy("d", "t").agg(F.collect_list(F.struct("m", "seg", "n", "s0", "windows")).alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, "text"):
            rows = []
            for text, parts in zip(texts, part.column(1).to_pylist(), strict=True):
                words = text.split()
                rows += [(p["m"], p["seg"], p["n"], b" ".join(words[p["s0"] : p["s0"] + p["windows"] + window - 1])) for p in parts]
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["m", "seg", "n", "words"])

    return map_batches(docs.join(by_doc, ["d", "t"]).select("text", "parts"), run, "m bigint, seg bigint, n bigint, words binary")


def search_shards(parts: DataFrame, words: int, window: int, block_segments: int = BLOCK_SEGMENTS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Windows that occur at least twice among the segments: rows (m, seg, low, high), offsets of windows, both included.

    ``parts`` has (m, seg, n, words), each segment once with its count.
    """
    ship_package(parts.sparkSession)
    shards = max(1, -(-words // shard_words))
    many = parts.groupBy("m").agg(F.count(F.lit(1)).alias("segments")).filter(F.col("segments") > block_segments)
    marked = parts.join(many, "m", "left").withColumn("blocks", F.ceil(F.coalesce("segments", F.lit(0)) / block_segments))
    single = marked.filter("blocks = 0").select(
        F.pmod("m", F.lit(shards)).alias("g"), F.lit(-1).alias("i"), F.lit(-1).alias("q"), "m", "seg", "n", "words", F.lit(2).alias("role")
    )
    own = F.pmod(F.col("seg"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)).alias("other")
    large = marked.filter("blocks > 0").select("m", "seg", "n", "words", own.alias("own"), other)
    columns = ["m", "seg", "n", "words"]
    indexed = large.select(F.col("m").alias("g"), F.col("own").alias("i"), F.col("other").alias("q"), *columns, F.lit(0).alias("role"))
    queried = large.select(F.col("m").alias("g"), F.col("other").alias("i"), F.col("own").alias("q"), *columns, F.lit(1).alias("role"))

    def search(group: pa.Table) -> pa.Table:
        runs = [HASHES.of(w.split()) for w in group["words"].to_pylist()]
        n, role = group["n"].to_numpy(), group["role"].to_numpy()
        inside = np.flatnonzero(role != 1)
        names, segs = group["m"].to_numpy(), group["seg"].to_numpy()
        out = []
        both = len(inside) and (role != 0).any()
        index = FmIndex([runs[i] for i in inside], window) if both else None
        if not both:
            pass  # a block without segments, or without another block's
        elif role[0] == 2:
            for i, counts in zip(inside, index.matches(runs, n), strict=True):
                edges = np.flatnonzero(np.diff(np.concatenate([[0], (counts > 1).astype(np.int8), [0]])))
                out += [(names[i], segs[i], lo, hi - 1, 2) for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)]
        else:
            # The index holds one block; each window of the other block is searched by itself.
            asked = [(i, s) for i in np.flatnonzero(role == 1) for s in range(len(runs[i]) - window + 1)]
            counts = index.matches([runs[i][s : s + window] for i, s in asked], n[inside])
            out = [(names[i], segs[i], s, s, int(c[0])) for (i, s), c in zip(asked, counts, strict=True) if c[0]]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64())
        columns = list(zip(*out, strict=True)) if out else [()] * 5
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["m", "seg", "low", "high", "n"])

    schema = "m bigint, seg bigint, low int, high int, n bigint"
    found = single.groupBy("g", "i", "q").applyInArrow(search, schema).select("m", "seg", "low", "high")
    spread = indexed.unionByName(queried).groupBy("g", "i", "q").applyInArrow(search, schema)
    summed = spread.groupBy("m", "seg", "low", "high").agg(F.sum("n").alias("n")).filter("n > 1").drop("n")
    return found.unionByName(summed)


def remove_repeats(docs: DataFrame, window: int = 35, doc_id: str = "doc_id", text: str = "text", outputs: tuple[str, ...] = ("kept_text",)) -> DataFrame:
    """``docs`` with n_words, n_removed and the outputs asked for: kept_text (kept words joined by one space), kept_sha256,
    cleaned (as kept_text, but a text that loses nothing stays as it is; null stays null).

    Each word covered by a window whose words also start anywhere else is removed.
    """
    texts = keyed(docs, doc_id, text)
    found = segments(texts, window)
    seen = found.groupBy("m").agg(
        F.count(F.lit(1)).alias("times"), F.min("seg").alias("low"), F.max("seg").alias("high"), F.bool_or("twice").alias("twice")
    )
    repeated = seen.filter("times > 1 or twice").select("m", F.expr("low < high or twice").alias("several"))
    again = settled(found.drop("twice").join(repeated, "m"))
    chosen = again.filter("several").groupBy("m", "seg").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("d", "t", "s0", "windows")).alias("at"))
    chosen = settled(chosen.select("m", "seg", "n", "at.*"))
    words = chosen.agg(F.sum(F.col("windows") + window)).first()[0] or 0
    results = search_shards(words_of_segments(texts, chosen, window), words, window)
    whole = again.filter("not several").select("d", "t", F.col("s0").alias("low"), (F.col("s0") + F.col("windows") - 1).alias("high"))
    partly = (
        again.filter("several").select("m", "seg", "d", "t", "s0").join(results, ["m", "seg"])
        .select("d", "t", (F.col("s0") + F.col("low")).alias("low"), (F.col("s0") + F.col("high")).alias("high"))
    )
    spans = whole.unionByName(partly).groupBy("d", "t").agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    kinds = dict.fromkeys(("kept_text", "kept_sha256", "cleaned"), T.StringType())
    added = {"n_words": T.LongType(), "n_removed": T.LongType()} | {o: kinds[o] for o in outputs}
    kept_columns = [c for c in docs.columns if c not in added and c != text]
    schema = T.StructType([*[docs.schema[c] for c in kept_columns], *[T.StructField(c, k) for c, k in added.items()]])

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, whole_texts in slices(batches, "__text"):
            spans = part.column(part.num_columns - 1)
            sizes, gone, kept = [], [], []
            for i, t in enumerate(whole_texts):
                words = t.split()
                sizes.append(len(words))
                found = spans[i].as_py()
                if found:
                    steps = np.zeros(len(words) + 1, np.int64)
                    np.add.at(steps, [s["low"] for s in found], 1)
                    np.add.at(steps, [s["high"] + window for s in found], -1)
                    stays = np.cumsum(steps[:-1]) == 0
                    words = [words[j] for j in np.flatnonzero(stays)]
                gone.append(sizes[-1] - len(words))
                kept.append(b" ".join(words))
            made = {
                "kept_text": lambda: [k.decode() for k in kept],
                "kept_sha256": lambda: [hashlib.sha256(k).hexdigest() for k in kept],
                "cleaned": lambda: [
                    k.decode() if g else (None if absent else t.decode())
                    for k, g, t, absent in zip(kept, gone, whole_texts, part.column(part.num_columns - 2).to_pylist(), strict=True)
                ],
            }
            arrays = [part.column(i) for i in range(len(kept_columns))] + [pa.array(sizes, pa.int64()), pa.array(gone, pa.int64())]
            arrays += [pa.array(made[o](), pa.string()) for o in outputs]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    body = F.coalesce(F.col(text), F.lit(""))
    key = [F.coalesce(F.col(doc_id).cast("bigint"), F.lit(0)).alias("__d"), F.xxhash64(body, F.col(doc_id)).alias("__t")]
    rows = docs.select(*kept_columns, body.alias("__text"), F.col(text).isNull().alias("__absent"), *key)
    joined = rows.join(spans.toDF("__d", "__t", "__spans"), ["__d", "__t"], "left").select(*kept_columns, "__text", "__absent", "__spans")
    return map_batches(joined, cover, schema)
