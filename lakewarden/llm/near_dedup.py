"""Near-duplicate documents by MinHash with one permutation.

A document's set of word shingles is hashed once. The hashes fall into bins by their first bits; the least of each bin
is the bin's value, and an empty bin takes that of another, found by a fixed sequence of bins of its own (optimal
densification). Bands of four bins are bucket keys. Documents with equal sets are one from the start. Each bucket gives
one star: its hub is compared with the members that links don't connect to it yet, so a round makes at most one pair per
member and bucket, and no pair is compared twice. Links are confirmed on the full sets. Two rounds go through the 32
bands; documents that are alike only somewhat may share buckets with very many others there, so two more rounds
lengthen the keys to 12 and 16 bins, which parts them, and give the smaller buckets hubs that were none before.

Two documents of similarity 0.85 share none of the 32 buckets with a probability below 1e-10 (0.8: below 1e-7). A link can
be missed only if in every bucket that its documents share, of all rounds, some third one is the hub and isn't linked to
both, directly or through others. The README has the recall measured against all pairs.

A text without words, null or empty, has the empty set and no links; very long texts are hashed whole. A null id takes
part in no link; its row keeps a null component. Rows with the same id count as one document: their links are joined.
An empty table gives no rows. Columns of the input other than the id and the text play no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewarden.llm.base import HASHES, Workspace, map_batches, mixed, settled, slices, window_hashes
from lakewarden.llm.components import components

BINS, ROWS = 128, 4
BANDS = BINS // ROWS
_BIN_SHIFT = np.uint64(64 - 7)
_draw = np.random.default_rng(2017)
#: Where an empty bin looks, in order; in the end at every bin.
PROBES = np.concatenate([_draw.integers(0, BINS, (BINS, 256)), np.stack([_draw.permutation(BINS) for _ in range(BINS)])], axis=1)
BAND_SEEDS = mixed(np.arange(1, BANDS + 1, dtype=np.uint64))

#: The bands that make the buckets of each round, and which others lengthen their keys. Two rounds go through the bands;
#: two go on with longer keys, which part documents that are only somewhat alike.
ROUNDS = (
    (range(0, 8), (0,)),
    (range(8, BANDS), (0,)),
    (range(0, BANDS), (0, 3, 10)),
    (range(0, BANDS), (0, 5, 11, 18)),
)

SIGNATURE = "doc_id bigint, n_shingles bigint, f1 bigint, bands array<bigint>"


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """Sorted distinct hashes of a text's word shingles; a shorter text is one shingle."""
    words = HASHES.of(text.lower().split())  # of bytes: A-Z only
    if not len(words):
        return words
    return np.unique(window_hashes(words, min(size, len(words))))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """Bucket keys, one per band, of a set that isn't empty."""
    bins = hashes >> _BIN_SHIFT
    first = np.searchsorted(bins, np.arange(BINS, dtype=np.uint64))
    full = first < len(bins)
    full[full] = bins[first[full]] == np.flatnonzero(full).astype(np.uint64)
    source = np.arange(BINS)
    empty = np.flatnonzero(~full)
    if len(empty):
        source[empty] = PROBES[empty, full[PROBES[empty]].argmax(1)]
    values = mixed(hashes[first[source]]).reshape(BANDS, ROWS)
    keys = BAND_SEEDS.copy()
    for i in range(ROWS):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + values[:, i])
    return keys


def signatures(docs: DataFrame, shingle: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Size, fingerprint and bucket keys of each document's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches, "text"):
            sets = [shingle_set(t, shingle) for t in texts]
            keys = [band_keys(s).view(np.int64) if len(s) else None for s in sets]
            arrays = [
                part.column(0),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([fingerprint(s) for s in sets], pa.int64()),
                pa.array(keys, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_shingles", "f1", "bands"])

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return map_batches(rows, run, SIGNATURE)


def fingerprint(hashes: np.ndarray) -> int:
    """A number that tells sets apart, in 64 bits."""
    return int(mixed(hashes).sum(dtype=np.uint64).view(np.int64)) if len(hashes) else 0


def packed_set(hashes: np.ndarray) -> bytes:
    """A sorted set by the first 48 bits of its hashes, six bytes each."""
    return (np.unique(hashes >> np.uint64(16)).astype("<u8")[:, None].view(np.uint8)[:, :6]).tobytes()


def unpacked_set(data: np.ndarray) -> np.ndarray:
    """The numbers of a packed set, from its bytes."""
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = data.reshape(-1, 6)
    return out.view("<u8").ravel()


def full_sets(docs: DataFrame, wanted: DataFrame, shingle: int, doc_id: str, text: str) -> DataFrame:
    """Fingerprints and sets, as sorted 48-bit hashes, of the documents whose ids are in ``wanted``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in slices(batches, "text"):
            sets = [shingle_set(t, shingle) for t in texts]
            arrays = [pa.array([fingerprint(s) for s in sets], pa.int64()), pa.array([packed_set(s) for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc", "hashes"])

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return map_batches(rows.join(wanted, "doc_id", "left_semi"), run, "doc bigint, hashes binary")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b), those whose full sets overlap enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                one, two = (unpacked_set(np.frombuffer(s.as_buffer(), np.uint8)) for s in (x, y))
                both = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(100 * both >= percent * (len(one) + len(two) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # The hub's set is joined last, as one hub may have very many partners.
    one = pairs.join(sets.toDF("b", "set_b"), "b")
    both = one.join(sets.toDF("a", "set_a"), "a").select("a", "b", "set_a", "set_b")
    return map_batches(both, run, "a bigint, b bigint")


def labels(links: DataFrame) -> DataFrame:
    """Rows (doc, root, degree): a linked document within two links, the same for most of a group, and its links."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count(F.lit(1)).alias("degree"))
    far = both.join(near.select(F.col("a").alias("b"), "m"), "b").groupBy("a").agg(F.min("m").alias("far"))
    return near.join(far, "a").select(F.col("a").alias("doc"), F.least("m", "far").alias("root"), "degree")


def bucket_keys(bands: range, steps: tuple[int, ...]) -> Column:
    """Bucket keys of a round: each of some bands together with those ``steps`` further on, so the more steps, the longer."""
    if steps == (0,):
        return F.array(*[F.col("bands")[b] for b in bands])
    return F.array(*[F.xxhash64(*[F.col("bands")[(b + s) % BANDS] for s in steps]) for b in bands])


def still_apart(work: Workspace, nodes: DataFrame, links: DataFrame) -> DataFrame:
    """The nodes that share a bucket with one that links don't connect them to."""
    rooted = nodes.join(labels(links), "doc", "left").select("doc", F.explode("bands").alias("key"), F.coalesce("root", "doc").alias("root"))
    apart = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high")
    docs = rooted.join(work.settled(apart.select("key")), "key").select("doc").distinct()
    return work.settled(nodes.join(docs, "doc", "left_semi"))


def star_links(work: Workspace, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Confirmed links (a, b), a < b, from one star per bucket and round.

    ``nodes`` has doc, rep, size, weight and bands. Members of a bucket that links connect already are not compared, nor
    are two documents compared twice. The hub of a bucket is the member whose buckets hold most documents; later on it
    is one that was no hub yet and has few links.
    """
    found, compared, stars = [], [], []
    for number, (bands, steps) in enumerate(ROUNDS):
        if len(steps) > 1 and len(ROUNDS[number - 1][1]) == 1:
            nodes = still_apart(work, nodes, together(found))
        state = nodes.select("doc", "rep", "size", "weight", bucket_keys(bands, steps).alias("keys"))
        root, rank = F.col("doc"), [F.col("weight"), -F.col("rep"), F.col("doc")]
        if number:
            used = together(stars).select(F.col("hub").alias("doc"), F.lit(1).alias("used")).distinct()
            state = work.settled(state.join(labels(together(found)), "doc", "left").join(used, "doc", "left"))
            root = F.coalesce("root", "doc")
            rank = [F.coalesce(-F.col("used"), F.lit(0)), -F.coalesce("degree", F.lit(0)), *rank]
        entries = state.select(F.explode("keys").alias("key"), "doc", "size", root.alias("root"), F.struct(*rank).alias("rank"))
        chosen = entries.groupBy("key").agg(
            F.max(F.struct("rank", "doc", "size", "root")).alias("hub"), F.min("root").alias("low"), F.max("root").alias("high")
        )
        # Written, so that the join below gets both sides from plain shuffles and Spark can split a large bucket.
        hubs = work.settled(
            chosen.filter("low < high").select("key", F.col("hub.doc").alias("hub"), F.col("hub.size").alias("hub_size"), F.col("hub.root").alias("hub_root"))
        )
        pairs = (
            entries.join(hubs, "key")
            .filter("root <> hub_root")
            .filter(f"100 * least(size, hub_size) >= {percent} * greatest(size, hub_size)")
            .select(F.least("doc", "hub").alias("a"), F.greatest("doc", "hub").alias("b"))
            .distinct()
        )
        if compared:
            pairs = pairs.join(together(compared), ["a", "b"], "left_anti")
        compared.append(work.settled(pairs))
        found.append(work.settled(confirmed(compared[-1], sets, percent)))
        stars.append(hubs)
        if number:
            work.drop(state)
    return together(found)


def together(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def link_documents(docs: DataFrame, shingle: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_shingles, component_id (least id reachable by links) and kept (the least id itself).

    Two documents are linked if their sets of ``shingle``-word shingles, words lower-cased, have
    100 * |intersection| >= percent * |union|.
    """
    with Workspace(docs.sparkSession) as work:
        signed = work.settled(signatures(docs, shingle, doc_id, text))
        able = signed.filter("doc_id is not null and n_shingles > 0")
        classes = work.settled(
            able.groupBy(F.col("f1").alias("doc"), "n_shingles").agg(F.min("doc_id").alias("rep"), F.any_value("bands").alias("bands"))
        )
        entries = classes.select(F.explode("bands").alias("key"), "doc")
        shared = entries.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
        weights = entries.join(work.settled(shared), "key").groupBy("doc").agg(F.sum("members").alias("weight"))
        nodes = work.settled(classes.withColumnRenamed("n_shingles", "size").join(weights, "doc"))
        reps = work.settled(classes.select("doc", "rep"))
        work.drop(classes)
        sets = work.settled(full_sets(docs, nodes.select(F.col("rep").alias("doc_id")), shingle, doc_id, text))
        links = star_links(work, nodes, sets, percent)
        work.drop(sets, nodes)
        between = links.join(reps.toDF("a", "u"), "a").join(reps.toDF("b", "v"), "b").select("u", "v")
        within = able.join(reps, F.col("f1") == F.col("doc")).filter("doc_id <> rep").select("doc_id", "rep")
        found = components(between.unionByName(within.toDF("u", "v")), work)
        component = F.coalesce("root", "doc_id")
        return settled(
            signed.select("doc_id", "n_shingles")
            .join(found.toDF("doc_id", "root"), "doc_id", "left")
            .select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
        )


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that keep their component's least id, with all their columns; of rows with one id all stay."""
    gone = link_documents(docs, shingle, percent, doc_id, text).filter("not kept").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, F.col(doc_id).cast("bigint") == F.col("__gone"), "left_anti")
