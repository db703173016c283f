"""Resampling, retention, fan-out and latest state on streams."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.readwriter import DataStreamWriter

from lakewarden.operators.monitor import SAMPLING_PERIOD, resample_metrics
from lakewarden.plans.ordered import one_group, ordered_columns

# Fixed value.
RETENTION_DAYS = 3


def run_available(writer: DataStreamWriter) -> None:
    """Process what is there now, then stop."""
    writer.trigger(availableNow=True).start().awaitTermination()


def stream_resample(
    stream: DataFrame,
    keys: Sequence[str],
    ts: str,
    value: str,
    seq: str,
    *,
    period: str = SAMPLING_PERIOD,
    lateness: str = "1 minute",
) -> DataFrame:
    """``resample_metrics`` on a stream, for append mode.

    A period is emitted once the watermark, ``lateness`` behind the newest event, has passed its
    end; events that come later than that are dropped.
    """
    return resample_metrics(stream.withWatermark(ts, lateness), keys, ts, value, seq, period)


def stream_retention(stream: DataFrame, ts: str, key: str, days: int = RETENTION_DAYS) -> DataFrame:
    """The events at most ``days`` behind the newest seen so far, each key once within that time.

    Later events are dropped and their keys forgotten, so the state covers ``days`` of events.
    """
    return stream.withWatermark(ts, f"{days} days").dropDuplicatesWithinWatermark([key])


def retain_stream(
    stream: DataFrame, path: str, checkpoint: str, ts: str, order: Sequence[str], days: int = RETENTION_DAYS
) -> DataStreamWriter:
    """A writer that keeps the events at most ``days`` behind the newest one that arrived before them.

    ``order`` is the order of arrival, a total one, as offsets are. Each event is held against the newest time among all
    events before it, those of earlier batches too, so the result doesn't depend on how the stream is cut into batches.
    Later events are diverted: every batch goes to ``<path>/batch_id=<id>/late=false`` and ``late=true``, and an
    event without a time is late. ``<checkpoint>/newest/batch_id=<id>`` has the newest time and how many events the batch kept
    and diverted. A batch that runs again replaces its own folders.
    """
    state = f"{checkpoint}/newest"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        marked = batch.withColumn("__all", one_group(*order))
        # One group, which is cut into stretches when a batch is large.
        seen = ordered_columns(marked, ["__all"], list(order), max_before={"__newest": ts})
        newest = F.col("__newest")
        if batch_id:
            before = spark.read.parquet(f"{state}/batch_id={batch_id - 1}")
            newest = F.greatest(newest, before.agg(F.max("newest")).scalar())
        behind = F.col(ts) < newest - F.make_interval(days=F.lit(days))
        late = F.col(ts).isNull() | F.coalesce(behind, F.lit(False))
        folder = f"{path}/batch_id={batch_id}"
        flagged = seen.select(*batch.columns, late.alias("late"))
        flagged.write.partitionBy("late").mode("overwrite").parquet(folder)
        # Counted from what was written: the batch is computed once.
        schema = T.StructType([*batch.schema, T.StructField("late", T.BooleanType())])
        written = spark.read.schema(schema).option("basePath", folder).parquet(folder)
        counts = written.agg(
            F.max(ts).alias("newest"), F.count_if(~F.col("late")).alias("kept"), F.count_if("late").alias("diverted")
        )
        if batch_id:
            counts = counts.withColumn("newest", F.greatest("newest", before.agg(F.max("newest")).scalar()))
        counts.write.mode("overwrite").parquet(f"{state}/batch_id={batch_id}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def read_retained(spark: SparkSession, path: str, schema: T.StructType, late: bool = False) -> DataFrame:
    """The events that ``retain_stream`` kept, or diverted as ``late``."""
    full = T.StructType([*schema, T.StructField("batch_id", T.LongType()), T.StructField("late", T.BooleanType())])
    return spark.read.schema(full).parquet(path).filter(F.col("late") == late).select(*schema.names)


def fan_out(stream: DataFrame, paths: Sequence[str], checkpoint: str, fmt: str = "parquet") -> DataStreamWriter:
    """A writer that sends every event to each of the paths.

    A batch goes to folder ``batch_id=<id>`` of each path and replaces what an earlier attempt at
    the same batch left there.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # The first sink's files feed the others: the batch is computed once and cached nowhere.
        first, *others = [f"{path}/batch_id={batch_id}" for path in paths]
        batch.write.format(fmt).mode("overwrite").save(first)
        for other in others:
            written = batch.sparkSession.read.format(fmt).schema(batch.schema).load(first)
            written.write.format(fmt).mode("overwrite").save(other)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def stream_latest(stream: DataFrame, key: str, ts: str, seq: str, state: Column) -> DataFrame:
    """The ``state`` of each key's latest event, for update mode."""
    return stream.groupBy(key).agg(
        F.max(F.struct(ts, seq)).alias("at"), F.max_by(state, F.struct(ts, seq)).alias("state")
    )


def write_latest(
    latest: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", compact_every: int = 20
) -> DataStreamWriter:
    """A writer that keeps the keys each batch updated in folder ``batch_id=<id>``.

    Every ``compact_every`` batches the state of all keys is written to folder ``upto=<id>``, which counts from the
    moment Spark marks it as complete. What an earlier snapshot already replaced is removed then; what the newest one
    replaces stays until the next, for those who are reading it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.format(fmt).mode("overwrite").save(f"{path}/batch_id={batch_id}")
        if (batch_id + 1) % compact_every == 0:
            key = batch.columns[0]
            snapshots, _ = _folders(spark, path)
            current = _current(spark, path, key, fmt, before=batch_id + 1)
            current.write.format(fmt).mode("overwrite").save(f"{path}/upto={batch_id}")
            _remove_replaced(spark, path, max((s for s in snapshots if s < batch_id), default=-1))

    return latest.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)


def read_latest(spark: SparkSession, path: str, key: str, fmt: str = "parquet") -> DataFrame:
    """The current state of every key written by ``write_latest``: key and ``state``.

    Reads the newest complete snapshot and the batches after it.
    """
    return _current(spark, path, key, fmt, before=None).select(key, "state")


def _current(spark: SparkSession, path: str, key: str, fmt: str, before: int | None) -> DataFrame:
    """Key, state and the batch that set it, from one snapshot and the batches after it."""
    snapshots, batches = _folders(spark, path)
    if before is not None:
        snapshots, batches = [s for s in snapshots if s < before - 1], [b for b in batches if b < before]
    newest = max(snapshots, default=-1)
    parts = []
    if newest >= 0:
        parts.append(spark.read.format(fmt).load(f"{path}/upto={newest}").select(key, "state", F.col("set_by").cast("bigint")))
    later = [f"{path}/batch_id={b}" for b in batches if b > newest]
    if later:
        read = spark.read.format(fmt).option("basePath", path).load(later)
        parts.append(read.select(key, "state", F.col("batch_id").cast("bigint").alias("set_by")))
    if not parts:
        raise ValueError(f"nothing was written to {path}")
    both = reduce(DataFrame.unionByName, parts)
    return both.groupBy(key).agg(F.max_by("state", "set_by").alias("state"), F.max("set_by").alias("set_by"))


def _folders(spark: SparkSession, path: str) -> tuple[list[int], list[int]]:
    """The complete snapshots and the batches there are, by number: a few, as old ones are removed."""
    store, place = _store(spark, path)
    snapshots, batches = [], []
    for status in store.listStatus(place):
        name, _, number = status.getPath().getName().partition("=")
        if name == "upto" and store.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            snapshots.append(int(number))
        elif name == "batch_id":
            batches.append(int(number))
    return sorted(snapshots), sorted(batches)


def _remove_replaced(spark: SparkSession, path: str, snapshot: int) -> None:
    """Remove what a snapshot before the newest one replaced."""
    snapshots, batches = _folders(spark, path)
    store, _ = _store(spark, path)
    old = [f"{path}/upto={s}" for s in snapshots if s < snapshot] + [f"{path}/batch_id={b}" for b in batches if b <= snapshot]
    for folder in old:
        store.delete(spark._jvm.org.apache.hadoop.fs.Path(folder), True)


def _store(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place
