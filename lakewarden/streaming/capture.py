"""Capturing an event stream into files bounded by time and size."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.readwriter import DataStreamWriter

from lakewarden.plans.ordered import ordered_columns

# Fixed values.
CAPTURE_SECONDS = 900
CAPTURE_BYTES = 10_485_760
#: Stand for what a folder name can't say: an event without a time, and one without a partition.
NO_WINDOW, NO_PARTITION = -(2**62), "__no_partition__"
#: Files of a window that one task writes, one after the other.
FILES_TOGETHER = 16
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def assign_capture_files(
    events: DataFrame,
    partition: str,
    ts: str,
    seq: str,
    size: Column,
    *,
    interval_seconds: int = CAPTURE_SECONDS,
    max_bytes: int = CAPTURE_BYTES,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Add ``bytes``, ``window_start`` and ``file_no`` to each event.

    Windows are ``interval_seconds`` long and aligned to the epoch. Within one window of one
    partition the events, ordered by ``ts, seq``, fill file 0, 1, …: an event goes to file
    ``floor(bytes before it / max_bytes)``.
    """
    marked = events.withColumns(
        {"bytes": size.cast("bigint"), "window_start": F.window(ts, f"{interval_seconds} seconds")["start"]}
    )
    running = ordered_columns(
        marked,
        [partition, "window_start"],
        [ts, seq],
        sum_before={"bytes_before": "bytes"},
        rows_per_task=rows_per_task,
    )
    # Whole-number division: bytes do not fit a double exactly for ever.
    return running.withColumn("file_no", F.expr(f"bytes_before DIV {int(max_bytes)}")).drop("bytes_before")


def capture_windows(
    events: DataFrame,
    partition: str,
    ts: str,
    seq: str,
    size: Column,
    *,
    interval_seconds: int = CAPTURE_SECONDS,
    max_bytes: int = CAPTURE_BYTES,
    rows_per_task: int | None = None,
) -> DataFrame:
    """One row per capture file: events, bytes and the times of its first and last event."""
    narrow = events.select(partition, ts, seq, size.alias("__size"))
    assigned = assign_capture_files(
        narrow,
        partition,
        ts,
        seq,
        F.col("__size"),
        interval_seconds=interval_seconds,
        max_bytes=max_bytes,
        rows_per_task=rows_per_task,
    )
    # Already partitioned by a part of these keys, so this adds no shuffle.
    return assigned.groupBy(partition, "window_start", "file_no").agg(
        F.count(F.lit(1)).alias("events"),
        F.sum("bytes").alias("bytes"),
        F.min(ts).alias("first_ts"),
        F.max(ts).alias("last_ts"),
    )


def _splitter(columns: list[str], order: list[str], span_ms: int, max_bytes: int) -> StatefulProcessor:
    # A class made here travels to the workers by value: they need not have this package.
    class CaptureSplitter(StatefulProcessor):
        """Numbers the files of one partition and span of windows as events arrive.

        The state holds the bytes so far of each window.
        """

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.bytes = handle.getMapState("bytes", "window_ms long", "bytes long")

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            before: dict[int, int] = {}
            if not self.bytes.exists():
                self.handle.registerTimer(int(key[1]) + span_ms)
            for chunk in rows:
                chunk = chunk.sort_values(order, ignore_index=True)
                windows = chunk["window_ms"]
                for window in windows.unique():
                    if window not in before:
                        state = self.bytes.getValue((int(window),))
                        before[window] = state[0] if state else 0
                own = chunk.groupby("window_ms")["bytes"].cumsum()
                reached = windows.map(before) + own
                chunk["file_no"] = (reached - chunk["bytes"]) // max_bytes
                before.update(reached.groupby(windows).max())
                yield chunk[[*columns, "file_no"]]
            for window, total in before.items():
                self.bytes.updateValue((int(window),), (int(total),))

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            # The watermark has passed these windows: no more events can come for them.
            self.bytes.clear()
            return iter([])

        def close(self) -> None:
            pass

    return CaptureSplitter()


def split_capture_stream(
    stream: DataFrame,
    partition: str,
    ts: str,
    seq: str,
    size: Column,
    *,
    interval_seconds: int = CAPTURE_SECONDS,
    max_bytes: int = CAPTURE_BYTES,
    lateness: str = "15 minutes",
    windows_per_key: int = 1,
) -> DataFrame:
    """``assign_capture_files`` on a stream, in order of arrival.

    Each key costs some milliseconds per trigger, which only shows where windows hold few events;
    ``windows_per_key`` then puts several windows of a partition under one key. One window per key
    lets a backlog spread most.

    Needs the RocksDB state store: set ``spark.sql.streaming.stateStore.providerClass`` to
    ``ROCKSDB`` before the query starts.
    """
    start = F.window(ts, f"{interval_seconds} seconds")["start"]
    span_ms = interval_seconds * 1000 * windows_per_key
    marked = stream.withWatermark(ts, lateness).withColumns(
        {"bytes": size.cast("bigint"), "window_ms": F.unix_millis(start)}
    )
    output = T.StructType([*marked.schema.fields, T.StructField("file_no", T.LongType())])
    split = (
        marked.withColumn("span_ms", F.col("window_ms") - F.pmod("window_ms", F.lit(span_ms)))
        .groupBy(partition, "span_ms")
        .transformWithStateInPandas(
            statefulProcessor=_splitter(marked.columns, [ts, seq], span_ms, max_bytes),
            outputStructType=output,
            outputMode="append",
            timeMode="eventtime",
        )
    )
    # Worked out again: cheaper than passing one more time column through Python.
    return split.drop("window_ms").withColumn("window_start", start)


def _carried(spark: SparkSession, folder: str, batch_id: int) -> DataFrame | None:
    """What the batch before this one left: bytes so far of each carried window, and the newest window seen."""
    if batch_id == 0:
        return None
    return spark.read.parquet(f"{folder}/batch_id={batch_id - 1}")


def capture_files(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    partition: str,
    ts: str,
    seq: str,
    size: Column,
    *,
    interval_seconds: int = CAPTURE_SECONDS,
    max_bytes: int = CAPTURE_BYTES,
    carry_seconds: int = 3 * 86_400,
    trigger: str | None = f"{CAPTURE_SECONDS} seconds",
) -> DataStreamWriter:
    """A writer that cuts each partition's events into files by time and by size, across batches.

    Windows are ``interval_seconds`` long and aligned to the epoch. Within a window of a partition the events, in
    order of arrival (within a batch by ``ts, seq``), go to file ``floor(bytes before them / max_bytes)``, so a file
    exceeds ``max_bytes`` by less than its last event. The bytes so far are carried from batch to batch beside the
    checkpoint, for the windows that began at most ``carry_seconds`` before the newest one. An event of an older
    window opens files of its own, numbered from ``(batch id + 1) * 2**32``, as the old files' fill is not known.

    ``path`` gets folders ``batch_id=/partition=/window_start=/file_no=``; a file that goes on in the next batch has a
    part in each. A batch that runs again replaces its own folders only, so every event is there once. All steps are
    Spark's own; ``read_captured`` reads the events back. Null partitions and sizes are allowed (a null size is 0); an
    event without a time is in a window of its own, ``null``, which is carried for ever.
    """
    state = f"{checkpoint}/carried"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        start = F.window(ts, f"{interval_seconds} seconds")["start"]
        # ``window`` drops rows without a time.
        timed = batch.filter(F.col(ts).isNotNull()).withColumn("__window", start)
        timed = timed.unionByName(batch.filter(F.col(ts).isNull()).withColumn("__window", F.lit(None).cast("timestamp")))
        marked = timed.withColumns({
            "__bytes": F.coalesce(size.cast("bigint"), F.lit(0)),
            "__epoch": F.coalesce(F.unix_seconds("__window"), F.lit(NO_WINDOW)),
            "__partition": F.coalesce(F.col(partition).cast("string"), F.lit(NO_PARTITION)),
            "__time": F.coalesce(ts, F.lit("1970-01-01").cast("timestamp")),
        })
        running = ordered_columns(marked, ["__partition", "__epoch"], ["__time", seq], sum_before={"__before": "__bytes"})
        carried = _carried(spark, state, batch_id)
        base, old = F.lit(0).cast("bigint"), F.lit(False)
        if carried is not None:
            newest = carried.agg(F.max("newest")).scalar()
            known = carried.filter("epoch IS NOT NULL").select("partition_key", "epoch", F.col("bytes").alias("__carried"))
            # One row per carried window; Spark decides how to join.
            running = running.join(
                known, (F.col("__partition") == F.col("partition_key")) & (F.col("__epoch") == F.col("epoch")), "left"
            )
            base = F.coalesce("__carried", F.lit(0))
            old = (F.col("__epoch") != NO_WINDOW) & (F.col("__epoch") < newest - carry_seconds)
        total = base + F.col("__before")
        number = F.when(old, F.lit((batch_id + 1) << 32)).otherwise(F.lit(0)) + F.expr("__total DIV __most")
        files = running.withColumns({"__total": total, "__most": F.lit(int(max_bytes))}).select(
            *batch.columns,
            F.col("__bytes").alias("bytes"),
            F.col("__partition").alias("partition_key"),
            F.col("__epoch").alias("window_epoch"),
            number.alias("file_no"),
        )
        keys = ["partition_key", "window_epoch", "file_no"]
        # Each file's events go to one task, with those of the next files, as every task makes the folders above its own.
        # It is files that take time here, not the bytes by which Spark would merge tasks.
        tasks, block = int(spark.conf.get("spark.sql.shuffle.partitions")), F.expr(f"file_no DIV {FILES_TOGETHER}")
        writer = files.repartition(tasks, *keys[:2], block).write.partitionBy(*keys).mode("overwrite")
        writer.parquet(f"{path}/batch_id={batch_id}")
        # The batch's bytes are summed up from its events: no file is opened again for it.
        touched = marked.groupBy(F.col("__partition").alias("partition_key"), F.col("__epoch").alias("epoch")).agg(F.sum("__bytes").alias("bytes"))
        if carried is not None:
            touched = touched.unionByName(carried.filter("epoch IS NOT NULL").select("partition_key", "epoch", "bytes"))
        summed = touched.groupBy("partition_key", "epoch").agg(F.sum("bytes").alias("bytes"))
        timed_only = F.when(F.col("epoch") != NO_WINDOW, F.col("epoch"))
        top = [summed.agg(F.max(timed_only)).scalar()] + ([carried.agg(F.max("newest")).scalar()] if carried is not None else [])
        latest = top[0] if len(top) == 1 else F.greatest(*top)
        kept = summed.filter((F.col("epoch") == NO_WINDOW) | (F.col("epoch") >= latest - carry_seconds)).withColumn("newest", latest)
        # One row without a window keeps the newest time even when no window is carried.
        marker = spark.range(1).select(
            F.lit(None).cast("string").alias("partition_key"), F.lit(None).cast("bigint").alias("epoch"), F.lit(None).cast("bigint").alias("bytes"), latest.alias("newest")
        )
        kept.unionByName(marker).coalesce(1).write.mode("overwrite").parquet(f"{state}/batch_id={batch_id}")
        if batch_id >= 2:
            _remove(spark, f"{state}/batch_id={batch_id - 2}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)


@contextmanager
def _listing(spark: SparkSession) -> Iterator[None]:
    """Folders are listed by as many tasks as run at a time, not by a task each."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name)
    spark.conf.set(name, min(int(before), 2 * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def read_captured(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The events ``capture_files`` wrote, of ``schema``, with bytes, partition_key, window_start and file_no."""
    keys = [("batch_id", T.LongType()), ("partition_key", T.StringType()), ("window_epoch", T.LongType()), ("file_no", T.LongType())]
    full = T.StructType([*schema, T.StructField("bytes", T.LongType()), *[T.StructField(n, t) for n, t in keys]])
    with _listing(spark):
        stored = spark.read.schema(full).parquet(path)
    return stored.select(
        *schema.names,
        "bytes",
        F.when(F.col("partition_key") != NO_PARTITION, F.col("partition_key")).alias("partition_key"),
        F.when(F.col("window_epoch") != NO_WINDOW, F.timestamp_seconds("window_epoch")).alias("window_start"),
        "file_no",
    )


def _place(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _remove(spark: SparkSession, path: str) -> None:
    store, target = _place(spark, path)
    store.delete(target, True)


def capture_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    *,
    trigger: str | None = f"{CAPTURE_SECONDS} seconds",
    fmt: str = "parquet",
) -> DataStreamWriter:
    """A writer that appends every event to files in ``path`` exactly once.

    Each trigger with events adds files, one without adds none. ``trigger=None`` captures what is
    there and stops. ``fmt="avro"`` works where the Avro package is on the classpath.
    """
    writer = stream.writeStream.format(fmt).outputMode("append").options(path=path, checkpointLocation=checkpoint)
    return writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)
