"""Queries over streams: each runs to the end of the events there are and reads the result back."""

from contextlib import contextmanager

from pyspark.sql import functions as F

from lakewarden.operators.monitor import outcome
from lakewarden.plans.queries.monitor import RESAMPLED_SQL, run_events
from lakewarden.plans.registry import events_path, query, scratch, table
from lakewarden.sources import read_event_stream
from lakewarden.streaming import (
    ROCKSDB,
    capture_files,
    capture_stream,
    capture_windows,
    fan_out,
    read_captured,
    read_latest,
    read_retained,
    retain_stream,
    run_available,
    split_capture_stream,
    stream_latest,
    stream_resample,
    write_latest,
)


def _stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    return read_event_stream(spark, events_path(sf_dir), schema, fmt="parquet")


def _drain(spark, stream, root, mode="append"):
    """Append the stream to files and read them."""
    writer = stream.writeStream.format("parquet").outputMode(mode)
    run_available(writer.options(path=f"{root}/out", checkpointLocation=f"{root}/progress"))
    return spark.read.parquet(f"{root}/out")


@contextmanager
def _rocksdb(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(name, before)


MAX_BYTES = 32


def _partitioned(events):
    return events.withColumn("partition", F.col("user_id") % 4)


def _size():
    return F.length("props").cast("bigint") + 8


@query(
    "capture_windows",
    """
    WITH marked AS (
        SELECT user_id % 4 AS partition, time_bucket(INTERVAL 15 MINUTE, ts) AS window_start, ts, event_id,
               length(props) + 8 AS bytes
        FROM events),
    running AS (
        SELECT *, sum(bytes) OVER (PARTITION BY partition, window_start ORDER BY ts, event_id
                                   ROWS UNBOUNDED PRECEDING) - bytes AS bytes_before
        FROM marked)
    SELECT partition, window_start, cast(bytes_before // 32 AS bigint) AS file_no, count(*) AS events,
           cast(sum(bytes) AS bigint) AS bytes, min(ts) AS first_ts, max(ts) AS last_ts
    FROM running GROUP BY 1, 2, 3
    """,
)
def capture_windows_query(spark, sf_dir):
    events = _partitioned(table(spark, sf_dir, "events"))
    return capture_windows(events, "partition", "ts", "event_id", _size(), max_bytes=MAX_BYTES)


# Odd times, so that batches end inside windows.
BATCH_ENDS = ["2024-01-06 03:07:11", "2024-01-06 03:09:00", "2024-01-17 22:52:30"]


def _arriving(spark, events, root, run, time="ts"):
    """Feed the events to a stream in batches, by time, one after the other."""
    ends = [F.lit(e).cast("timestamp_ntz") for e in BATCH_ENDS]
    number = sum((F.col(time) >= e).cast("int") for e in ends)
    for batch in range(len(ends) + 1):
        events.filter(number == batch).write.mode("append").parquet(f"{root}/in")
        run(read_event_stream(spark, f"{root}/in", events.schema, fmt="parquet"))


# Five days and a few kilobytes: few files, as every file of a window is one of the file system.
FILE_SECONDS, FILE_BYTES = 432_000, 4_096


@query(
    "capture_files",
    """
    WITH marked AS (
        SELECT cast(user_id % 4 AS varchar) AS partition_key,
               make_timestamp(epoch_us(ts) // 432000000000 * 432000000000) AS window_start, ts, event_id,
               length(props) + 8 AS bytes
        FROM events),
    running AS (
        SELECT *, sum(bytes) OVER (PARTITION BY partition_key, window_start ORDER BY ts, event_id
                                   ROWS UNBOUNDED PRECEDING) - bytes AS bytes_before
        FROM marked)
    SELECT partition_key, window_start, cast(bytes_before // 4096 AS bigint) AS file_no, count(*) AS events,
           cast(sum(bytes) AS bigint) AS bytes, sum(bytes) < 4096 + max(bytes) AS bounded
    FROM running GROUP BY 1, 2, 3
    """,
)
def capture_files_query(spark, sf_dir):
    root = scratch(spark)
    events = table(spark, sf_dir, "events")

    def run(stream):
        writer = capture_files(
            _partitioned(stream), f"{root}/out", f"{root}/progress", "partition", "ts", "event_id", _size(),
            interval_seconds=FILE_SECONDS, max_bytes=FILE_BYTES, trigger=None,
        )
        writer.start().awaitTermination()

    _arriving(spark, events, root, run)
    schema = _partitioned(events.withColumn("ts", F.col("ts").cast("timestamp"))).schema
    return (
        read_captured(spark, f"{root}/out", schema)
        .groupBy("partition_key", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "file_no")
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.sum("bytes").alias("bytes"),
            (F.sum("bytes") < FILE_BYTES + F.max("bytes")).alias("bounded"),
        )
    )


@query(
    "split_capture_stream",
    """
    SELECT user_id % 4 AS partition, time_bucket(INTERVAL 15 MINUTE, ts) AS window_start,
           count(*) AS events, cast(sum(length(props) + 8) AS bigint) AS bytes
    FROM events GROUP BY 1, 2
    """,
)
def split_capture_stream_query(spark, sf_dir):
    # Which file an event falls in depends on the order of arrival, so the files are summed up here.
    events = _partitioned(_stream(spark, sf_dir)).select("event_id", "ts", "partition", _size().alias("size"))
    with _rocksdb(spark):
        files = _drain(
            spark,
            split_capture_stream(events, "partition", "ts", "event_id", F.col("size"), max_bytes=MAX_BYTES, windows_per_key=96),
            scratch(spark),
        )
    per_file = files.groupBy("partition", "window_start", "file_no").agg(
        F.count(F.lit(1)).alias("events"), F.sum("bytes").alias("bytes")
    )
    return per_file.groupBy("partition", F.col("window_start").cast("timestamp_ntz").alias("window_start")).agg(
        F.sum("events").alias("events"), F.sum("bytes").alias("bytes")
    )


@query("capture_stream", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def capture_stream_query(spark, sf_dir):
    root = scratch(spark)
    writer = capture_stream(_stream(spark, sf_dir), f"{root}/out", f"{root}/progress", trigger=None)
    writer.start().awaitTermination()
    return spark.read.parquet(f"{root}/out").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query(
    "stream_resample",
    RESAMPLED_SQL
    + """
    HAVING time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE
    """,
)
def stream_resample_query(spark, sf_dir):
    stream = _stream(spark, sf_dir)
    periods = stream_resample(
        stream, ["event_type"], "ts", "value", "event_id", period="1 hour", lateness="10 minutes"
    )
    closed = _drain(spark, periods, scratch(spark))
    return closed.withColumns(
        {"period_start": F.col("period_start").cast("timestamp_ntz"), "mean_value": F.round("mean_value", 4)}
    )


# One event in fifty arrives six days after its time.
ARRIVAL_SQL = "ts + CASE WHEN event_id % 50 = 0 THEN INTERVAL 6 DAY ELSE INTERVAL 0 DAY END"


@query(
    "stream_retention",
    f"""
    WITH arrived AS (SELECT event_id, event_type, ts, {ARRIVAL_SQL} AS arrival FROM events),
    held AS (
        SELECT *, max(ts) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest
        FROM arrived)
    SELECT event_id, event_type, coalesce(ts < newest - INTERVAL 3 DAY, false) AS late FROM held
    """,
)
def stream_retention_query(spark, sf_dir):
    root = scratch(spark)
    events = table(spark, sf_dir, "events").withColumn("arrival", F.expr(ARRIVAL_SQL)).select("event_id", "event_type", "ts", "arrival")

    def run(stream):
        run_available(retain_stream(stream, f"{root}/out", f"{root}/progress", "ts", ["arrival", "event_id"]))

    _arriving(spark, events, root, run, "arrival")
    schema = events.select("event_id", "event_type").schema
    kept, late = (read_retained(spark, f"{root}/out", schema, late=late).withColumn("late", F.lit(late)) for late in (False, True))
    return kept.unionByName(late)


@query(
    "fan_out",
    """
    SELECT sink, event_type, count(*) AS events
    FROM events CROSS JOIN (VALUES ('primary'), ('extra')) s(sink) GROUP BY sink, event_type
    """,
)
def fan_out_query(spark, sf_dir):
    root = scratch(spark)
    sinks = {name: f"{root}/{name}" for name in ("primary", "extra")}
    run_available(fan_out(_stream(spark, sf_dir), list(sinks.values()), f"{root}/progress"))
    first, second = [
        spark.read.parquet(path).select(F.lit(name).alias("sink"), "event_type") for name, path in sinks.items()
    ]
    return first.unionByName(second).groupBy("sink", "event_type").agg(F.count(F.lit(1)).alias("events"))


@query(
    "stream_latest",
    """
    SELECT user_id AS run_id,
           CASE WHEN event_type IN ('view', 'click') THEN 'running'
                WHEN event_type IN ('purchase', 'signup') THEN 'success' ELSE 'failed' END AS outcome
    FROM (SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY user_id)
    """,
)
def stream_latest_query(spark, sf_dir):
    root = scratch(spark)
    state = F.struct("end_time", F.col("state.result_state").alias("result_state"))
    latest = stream_latest(run_events(_stream(spark, sf_dir)), "run_id", "ts", "seq", state)
    run_available(write_latest(latest, f"{root}/out", f"{root}/progress"))
    current = read_latest(spark, f"{root}/out", "run_id")
    return current.select("run_id", outcome(F.col("state.end_time"), F.col("state.result_state")).alias("outcome"))
