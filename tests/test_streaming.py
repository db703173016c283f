from datetime import datetime, timedelta

import pytest
from pyspark.sql import DataFrameReader
from pyspark.sql import functions as F

from lakewarden.operators.monitor import resample_metrics
from lakewarden.plans.queries.streams import _arriving
from lakewarden.sources import read_event_stream
from lakewarden.streaming import (
    ROCKSDB,
    assign_capture_files,
    capture,
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
    stream_retention,
    write_latest,
)

START = datetime(2024, 1, 1)
SCHEMA = "event_id long, ts timestamp_ntz, key long, size long, value double"


class Feed:
    """A folder of files that a stream follows, one file a batch."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, root

    def add(self, rows):
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.root}/in")

    def stream(self):
        schema = self.spark.createDataFrame([], SCHEMA).schema
        return read_event_stream(self.spark, f"{self.root}/in", schema, fmt="parquet")

    def drain(self, stream, mode="append"):
        writer = stream.writeStream.format("parquet").outputMode(mode)
        run_available(writer.options(path=f"{self.root}/out", checkpointLocation=f"{self.root}/progress"))
        return self.spark.read.parquet(f"{self.root}/out")


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, str(tmp_path))


def event(i, seconds=0, key=0, size=1, value=1.0):
    return (i, START + timedelta(seconds=seconds), key, size, value)


MIB = 1024 * 1024


def test_capture_by_size(spark):
    df = spark.createDataFrame([event(i, i, size=5 * MIB) for i in range(3)], SCHEMA)
    files = assign_capture_files(df, "key", "ts", "event_id", F.col("size"))
    assert [r["file_no"] for r in files.sort("event_id").collect()] == [0, 0, 1]


@pytest.mark.parametrize("rows_per_task", [None, 3])
def test_capture_by_time_and_size(spark, rows_per_task):
    df = spark.createDataFrame([event(i, 100 * i, key=i % 2, size=10) for i in range(20)], SCHEMA)
    files = capture_windows(df, "key", "ts", "event_id", F.col("size"), max_bytes=25, rows_per_task=rows_per_task)
    got = sorted((r["key"], (r["window_start"] - START).seconds, r["file_no"], r["events"], r["bytes"]) for r in files.collect())
    want = {}
    before = {}
    for i in range(20):
        window = (i % 2, 100 * i // 900 * 900)
        file = (*window, before.get(window, 0) // 25)
        before[window] = before.get(window, 0) + 10
        n, b = want.get(file, (0, 0))
        want[file] = (n + 1, b + 10)
    assert got == sorted((*f, *v) for f, v in want.items())


@pytest.mark.parametrize("windows_per_key", [1, 3])
def test_capture_split_on_a_stream(spark, feed, windows_per_key):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    batches = [[event(i, 60 * i, size=10) for i in range(4)], [event(i, 60 * i, size=10) for i in range(4, 18)]]
    for batch in batches:
        feed.add(batch)
        stream = split_capture_stream(feed.stream(), "key", "ts", "event_id", F.col("size"), max_bytes=25, windows_per_key=windows_per_key)
        stored = feed.drain(stream)
    got = {r["event_id"]: r["file_no"] for r in stored.collect()}
    df = spark.createDataFrame([e for b in batches for e in b], SCHEMA)
    same = assign_capture_files(df, "key", "ts", "event_id", F.col("size"), max_bytes=25)
    assert got == {r["event_id"]: r["file_no"] for r in same.collect()}


def test_capture_is_exactly_once_and_skips_empty_batches(spark, feed, tmp_path):
    def run():
        capture_stream(feed.stream(), f"{feed.root}/out", f"{feed.root}/progress", trigger=None).start().awaitTermination()
        return len(list((tmp_path / "out").glob("*.parquet")))

    feed.add([event(1), event(2)])
    files = run()
    assert run() == files
    feed.add([event(3)])
    assert run() == files + 1
    assert sorted(r["event_id"] for r in spark.read.parquet(f"{feed.root}/out").collect()) == [1, 2, 3]


def captured(spark, feed, batches, **options):
    """File numbers by event after feeding the batches one by one."""
    for batch in batches:
        feed.add(batch)
        stream = feed.stream()
        options = {"max_bytes": 25, **options}
        capture_files(stream, f"{feed.root}/files", f"{feed.root}/at", "key", "ts", "event_id", F.col("size"), trigger=None, **options).start().awaitTermination()
    return read_captured(spark, f"{feed.root}/files", stream.schema)


def test_files_go_on_in_the_next_batch(spark, feed, tmp_path, monkeypatch):
    plans = []
    ordered = capture.ordered_columns
    monkeypatch.setattr(capture, "ordered_columns", lambda df, *a, **k: plans.append(df) or ordered(df, *a, **k))
    events = [event(i, 53 * i, key=i % 2, size=4 + i % 9) for i in range(60)]
    events += [(99, None, 1, 30, 1.0), (98, START, None, 24, 1.0), (97, START, None, None, 1.0), (96, None, 1, 30, 1.0)]
    cuts = [events[:7], events[7:8], events[8:45], [], events[45:]]
    got = {r["event_id"]: r for r in captured(spark, feed, [c for c in cuts if c]).collect()}
    before, want = {}, {}
    for i, at, key, size, _ in sorted(events[:60], key=lambda e: e[0]):
        window = (key, int((at - START).total_seconds()) // 900)
        want[i] = before.get(window, 0) // 25
        before[window] = before.get(window, 0) + size
    assert {i: got[i]["file_no"] for i in want} == want
    # An event without a time, partition or size is kept, too.
    assert (got[96]["file_no"], got[99]["file_no"], got[99]["window_start"]) == (0, 1, None)
    assert (got[97]["file_no"], got[98]["file_no"], got[97]["partition_key"], got[97]["bytes"]) == (0, 0, None, 0)
    assert len(got) == 64
    # Each part of a file is one file of the file system, and exceeds the bound by less than an event.
    for folder in tmp_path.glob("files/batch_id=*/*/*/*"):
        assert len(list(folder.glob("*.parquet"))) == 1
    sizes = {}
    for r in got.values():
        sizes.setdefault((r["partition_key"], r["window_start"], r["file_no"]), []).append(r["bytes"])
    assert all(sum(s) < 25 + max(s) for s in sizes.values() if sum(s))
    physical = plans[-1]._jdf.queryExecution().optimizedPlan().toString()
    assert not any(word in physical for word in ("Python", "Pandas", "Arrow"))


def test_files_of_windows_no_longer_carried(spark, feed):
    """An event that comes when its window's fill is forgotten opens a file of its own."""
    batches = [[event(1, 0, size=20)], [event(2, 10 * 900, size=1)], [event(3, 1, size=20), event(4, 2, size=20)], [event(5, 3, size=20), event(6, 10 * 900 + 1, size=30), event(7, 10 * 900 + 2)]]
    got = {r["event_id"]: r["file_no"] for r in captured(spark, feed, batches, carry_seconds=1800).collect()}
    assert got == {1: 0, 2: 0, 3: 3 << 32, 4: 3 << 32, 5: 4 << 32, 6: 0, 7: 1}


def test_a_batch_that_runs_again_replaces_itself(spark, feed, tmp_path):
    events = [event(i, i, size=10) for i in range(9)]
    first = captured(spark, feed, [events[:5], events[5:]]).collect()
    # As if the last batch had failed after writing: its commit goes, and it runs again.
    (tmp_path / "at" / "commits" / "1").unlink()
    (tmp_path / "at" / "commits" / ".1.crc").unlink(missing_ok=True)
    capture_files(feed.stream(), f"{feed.root}/files", f"{feed.root}/at", "key", "ts", "event_id", F.col("size"), trigger=None, max_bytes=25).start().awaitTermination()
    again = read_captured(spark, f"{feed.root}/files", feed.stream().schema).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, first)) and len(again) == 9
    assert {r["event_id"]: r["file_no"] for r in again} == {i: i * 10 // 25 for i in range(9)}


def test_captured_files_are_listed_by_few_tasks_and_read_once(spark, feed, tmp_path, monkeypatch):
    """A batch opens none of the files written, and reading them doesn't take a task per folder."""
    reads, name = [], "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before, parquet = spark.conf.get(name), DataFrameReader.parquet
    monkeypatch.setattr(DataFrameReader, "parquet", lambda r, path, **k: reads.append((path, spark.conf.get(name))) or parquet(r, path, **k))
    batches = [[event(i, i, key=i % 2, size=10) for i in range(n, n + 90)] for n in (0, 90)]
    got = captured(spark, feed, batches).collect()
    assert {r["event_id"]: r["file_no"] for r in got} == {i: i // 2 * 10 // 25 for i in range(180)}
    files = [tasks for path, tasks in reads if f"{feed.root}/files" in path]
    assert len(files) == 1 and int(files[0]) <= 2 * spark.sparkContext.defaultParallelism
    assert spark.conf.get(name) == before
    # The files of a window are written by several tasks, neighbours by the same.
    parts = {}
    for f in tmp_path.glob("files/batch_id=0/partition_key=0/*/*/*.parquet"):
        parts[int(f.parent.name.split("=")[1])] = f.name.split("-")[1]
    assert len(parts) == 18 and len({parts[n] for n in range(16)}) == 1


def test_a_feed_is_not_written_by_one_task(spark, tmp_path):
    events = spark.createDataFrame([event(i, 86_400 * i) for i in range(30)], SCHEMA).repartition(3)
    batches = []
    _arriving(spark, events, str(tmp_path), lambda stream: batches.append(len(list(tmp_path.glob("in/*.parquet")))))
    assert len(batches) == 4 and batches[0] > 1
    assert spark.read.parquet(f"{tmp_path}/in").count() == 30


def test_resampled_stream_equals_closed_batch_windows(spark, feed):
    rows = [event(i, 7 * i, key=i % 3, value=float(i % 5)) for i in range(200)]
    feed.add(rows)
    got = feed.drain(stream_resample(feed.stream(), ["key"], "ts", "value", "event_id", period="1 minute", lateness="2 minutes"))
    batch = resample_metrics(spark.createDataFrame(rows, SCHEMA), ["key"], "ts", "value", "event_id", "1 minute")
    closed = batch.filter(F.col("period_start") + F.expr("INTERVAL 1 MINUTE") <= F.lit(rows[-1][1] - timedelta(minutes=2)))
    got = got.withColumn("period_start", F.col("period_start").cast("timestamp_ntz"))
    assert 0 < got.count() < batch.count()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, closed.select(got.columns).collect()))


DAY = 86_400


def test_retention_drops_late_and_repeated_events(spark, feed):
    feed.add([event(1, 0), event(2, 10 * DAY)])
    feed.drain(stream_retention(feed.stream(), "ts", "event_id"))
    feed.add([event(3, 6 * DAY), event(4, 8 * DAY), event(2, 10 * DAY)])
    kept = feed.drain(stream_retention(feed.stream(), "ts", "event_id"))
    # Event 3 is four days late, event 4 two, event 2 comes again.
    assert sorted(r["event_id"] for r in kept.collect()) == [1, 2, 4]


def test_fan_out_reaches_every_sink(spark, feed):
    paths = [f"{feed.root}/a", f"{feed.root}/b"]
    for rows in ([event(1), event(2)], [event(3)]):
        feed.add(rows)
        run_available(fan_out(feed.stream(), paths, f"{feed.root}/progress"))
    for path in paths:
        stored = spark.read.parquet(path)
        assert sorted(r["event_id"] for r in stored.collect()) == [1, 2, 3]
        assert stored.select("batch_id").distinct().count() == 2


def test_latest_over_several_batches(spark, feed):
    for rows in ([event(1, 5, key=1, value=1.0), event(2, 5, key=2, value=2.0)], [event(3, 9, key=1, value=3.0), event(4, 1, key=2, value=4.0)]):
        feed.add(rows)
        stream = stream_latest(feed.stream(), "key", "ts", "event_id", F.col("value"))
        run_available(write_latest(stream, f"{feed.root}/out", f"{feed.root}/progress"))
        latest = read_latest(spark, f"{feed.root}/out", "key")
    assert {r["key"]: r["state"] for r in latest.collect()} == {1: 3.0, 2: 2.0}


def test_latest_reads_one_snapshot_and_newer_batches(spark, feed, tmp_path):
    out = tmp_path / "out"
    for batch in range(13):
        feed.add([event(batch, batch, key=batch % 5, value=float(batch)), event(100 + batch, 50 - batch, key=9, value=float(batch))])
        latest = stream_latest(feed.stream(), "key", "ts", "event_id", F.col("value"))
        run_available(write_latest(latest, str(out), f"{feed.root}/at", compact_every=4))
    state = read_latest(spark, str(out), "key")
    assert {r["key"]: r["state"] for r in state.collect()} == {0: 10.0, 1: 11.0, 2: 12.0, 3: 8.0, 4: 9.0, 9: 0.0}
    # One snapshot, of batch 11, and batch 12.
    read = {f.split("/out/")[1].split("/")[0] for f in state.inputFiles()}
    assert read == {"upto=11", "batch_id=12"}
    # The snapshot before stays for readers, what it replaced is gone.
    assert {p.name for p in out.iterdir()} == {"upto=7", "upto=11", *(f"batch_id={b}" for b in range(8, 13))}
    # An unfinished snapshot doesn't count.
    (out / "upto=11" / "_SUCCESS").unlink()
    again = read_latest(spark, str(out), "key")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, state.collect()))


@pytest.mark.parametrize("cuts", [[5], [2, 3, 9, 30, 31], [1, 20, 40]])
def test_retention_does_not_depend_on_batches(spark, tmp_path, cuts):
    """Of events in order of arrival, those within three days of the newest before them, however the batches are cut."""
    events = [event(i, (i * DAY) // 2 - (5 * DAY if i % 7 == 3 else 0)) for i in range(40)] + [(40, None, 0, 1, 1.0)]
    want, newest = set(), None
    for i, at, *_ in events:
        if at is not None and (newest is None or at >= newest - timedelta(days=3)):
            want.add(i)
        newest = max((t for t in (newest, at) if t is not None), default=None)
    feed = Feed(spark, f"{tmp_path}/{len(cuts)}")
    for start, stop in zip([0, *cuts], [*cuts, len(events)], strict=True):
        if events[start:stop]:
            feed.add(events[start:stop])
            run_available(retain_stream(feed.stream(), f"{feed.root}/out", f"{feed.root}/at", "ts", ["event_id"]))
    schema = feed.stream().schema
    kept, late = ({r["event_id"] for r in read_retained(spark, f"{feed.root}/out", schema, late=x).collect()} for x in (False, True))
    assert kept == want and late == {e[0] for e in events} - want and 5 < len(late)
    counts = spark.read.parquet(f"{feed.root}/at/newest").agg(F.sum("kept"), F.sum("diverted")).first()
    assert tuple(counts) == (len(kept), len(late))
