"""Small helpers the operators of this folder share."""

from __future__ import annotations

import ctypes
import io
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewarden.session import shared_dir

#: White space between words, as a class of a regular expression. ``bytes.split()`` cuts at the same six characters.
SPACE = r"[\x20\x09-\x0D]"
SLICE_BYTES = 4 << 20
#: Spark's setting for dropping a query's shuffle files at its end, not when the driver next collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Runs of rows holding at most ``size`` bytes of text (one row at least), with their texts in UTF-8; null is empty."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + size, "right")))
            part = batch.slice(start, stop - start)
            yield part, [t or b"" for t in texts.slice(start, stop - start).to_pylist()]
            start = stop


class WordHashes(dict):
    """64-bit hashes of words; a memo that empties itself when it holds about ``limit`` bytes."""

    def __init__(self, limit: int = 12 << 20):
        super().__init__()
        self.limit, self.held = limit, 0

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        self.held += len(word) + 160
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if self.held > self.limit:
            self.forget()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))

    def forget(self) -> None:
        self.clear()
        self.held = 0


HASHES = WordHashes()

#: What a Python worker keeps between tasks, and the module whose work it did last. Workers outlive a stage.
_kept: dict[tuple, object] = {}
_owner = ""


def kept_tool(make: Callable, *options):
    """``make(*options)``, kept in this process as long as it works for the same module."""
    key = (make, options)
    if key not in _kept:
        _kept[key] = make(*options)
    return _kept[key]


def start_work(owner: str) -> None:
    """Drop the tools of another module."""
    global _owner
    if _owner != owner:
        _kept.clear()
        _owner = owner


def end_work() -> None:
    """Forget words and hand free memory back, so that idle workers hold little."""
    HASHES.forget()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def mixed(values: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values."""
    values = (values ^ (values >> np.uint64(30))) * _MIX
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each run of ``size`` consecutive word hashes."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = words[:n].copy()
    for i in range(1, size):
        total = mixed(total * _ODD + words[i : i + n])
    return mixed(total + np.uint64(size))


def scratch(spark: SparkSession) -> str:
    """A new folder in the place all executors share."""
    return f"{shared_dir(spark).rstrip('/')}/{uuid.uuid4().hex}"


def write_parquet(df: DataFrame, path: str) -> None:
    """Write ``df``, after which its shuffle files serve no one and go at once."""
    if df.sparkSession.conf.get(CLEANUP) != "true":
        # For good: no query of this library reads another one's shuffle files.
        df.sparkSession.conf.set(CLEANUP, "true")
    df.write.option("compression", "zstd").parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


class Workspace:
    """Tables written to the shared folder while an operator works; all go when it is done, or earlier by ``drop``.

    ``settled`` as a function of this module is for results that others go on reading.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.folder, self.paths = spark, scratch(spark), {}

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_) -> None:
        remove_folder(self.spark, self.folder)

    def settled(self, df: DataFrame) -> DataFrame:
        path = f"{self.folder}/{len(self.paths)}"
        write_parquet(df, path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[len(self.paths)] = (out, path)
        return out

    def drop(self, *tables: DataFrame) -> None:
        for number, (table, path) in self.paths.items():
            if any(table is t for t in tables):
                remove_folder(self.spark, path)
                self.paths[number] = (None, path)


def settled(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read back: later uses neither compute it again nor lose it."""
    path = scratch(df.sparkSession)
    write_parquet(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(docs: DataFrame, column: str) -> int:
    """Bytes of all texts, for choosing a number of partitions."""
    return docs.agg(F.sum(F.octet_length(F.col(column)))).first()[0] or 0


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """A file in any store that Spark can write."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(data))
    out.close()


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the executors, once per application, as they may have no copy."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, source.relative_to(root.parent))
    folder = scratch(spark)
    path = f"{folder}/{root.name}-{folder.rpartition('/')[2]}.zip"
    write_bytes(spark, path, data.getvalue())
    spark.sparkContext.addPyFile(path)
    _shipped.add(application)


def map_batches(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``mapInArrow`` with this package at hand on the executors; what a worker kept for other modules is dropped."""
    ship_package(df.sparkSession)
    owner = run.__module__

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start_work(owner)
        try:
            yield from run(batches)
        finally:
            end_work()

    return df.mapInArrow(work, schema)
