from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakewarden.sources import (
    documents,
    flatten_documents,
    object_inventory,
    parse_messages,
    read_event_stream,
    read_jdbc,
    read_zone,
    register_dataset,
    write_jdbc,
    write_zone,
    zone_path,
)


def test_zone_modes(spark, tmp_path):
    target = (str(tmp_path), "raw", "di001", "t")
    first = spark.range(6).select("id", (F.col("id") % 3).alias("p"))
    write_zone(first, *target, partition_by=["p"])
    write_zone(first.filter("p = 1").withColumn("id", F.col("id") + 100), *target, partition_by=["p"])
    assert sorted(map(tuple, read_zone(spark, *target).select("id", "p").collect())) == [
        (0, 0), (2, 2), (3, 0), (5, 2), (101, 1), (104, 1)
    ]
    write_zone(first, *target, mode="ignore", partition_by=["p"])
    assert read_zone(spark, *target).count() == 6
    write_zone(first, *target, mode="append", partition_by=["p"])
    assert read_zone(spark, *target).count() == 12
    plain = (str(tmp_path), "ext", "data", "u")
    write_zone(first, *plain)
    write_zone(first.limit(1), *plain)
    assert read_zone(spark, *plain).count() == 1


def test_zone_names():
    assert zone_path("s3://lake/", "work", "dp002", "x") == "s3://lake/work/dp002/x"
    with pytest.raises(ValueError, match="unknown zone"):
        zone_path("r", "bronze", "data", "x")
    with pytest.raises(ValueError, match="no container"):
        zone_path("r", "work", "di001", "x")
    with pytest.raises(ValueError, match="no container"):
        zone_path("r", "ext", "di001", "x")


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_zone_formats(spark, tmp_path, fmt):
    target = (str(tmp_path), "encur", "data", "t")
    write_zone(spark.range(3), *target, fmt=fmt)
    assert read_zone(spark, *target, fmt=fmt).count() == 3


def test_zone_filters_reach_the_scan(spark, tmp_path):
    target = (str(tmp_path), "raw", "data", "t")
    write_zone(spark.range(10).select("id", (F.col("id") % 3).alias("p"), F.lit("x").alias("wide")), *target, partition_by=["p"])
    df = read_zone(spark, *target).filter("p = 1 AND id > 3").select("id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan and "GreaterThan(id,3)" in plan
    assert "wide" not in plan[plan.index("ReadSchema") :]


def test_registered_dataset_keeps_its_files(spark, tmp_path):
    spark.range(4).write.parquet(f"{tmp_path}/d")
    assert register_dataset(spark, f"{tmp_path}/d", "lw_t").count() == 4
    assert register_dataset(spark, f"{tmp_path}/d", "lw_t").count() == 4
    assert spark.sql("SELECT max(id) FROM lw_t").first()[0] == 3
    spark.sql("DROP TABLE lw_t")
    assert spark.read.parquet(f"{tmp_path}/d").count() == 4


@pytest.mark.parametrize("folders", [1, 3, 512])
def test_inventory_by_folders(spark, tmp_path, folders):
    """Every file once, whatever the level at which tasks take over; folders are tasks."""
    sizes = {}
    for i in range(40):
        parts = [f"d{i % 3}", f"e{i % 7}", f"f{i}"][: i % 4]
        name = "/".join([*parts, f"file{i}.bin"])
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"x" * i)
        sizes[name] = i
    (tmp_path / "empty" / "folder").mkdir(parents=True)
    inventory = object_inventory(spark, f"file://{tmp_path}", folders=folders)
    got = {r["path"]: (r["container"], r["bytes"], r["kind"], r["blob_type"]) for r in inventory.collect()}
    assert got == {p: (p.split("/")[0] if "/" in p else None, n, "base", "blockBlob") for p, n in sizes.items()}
    assert inventory.count() == 40
    tasks = inventory.rdd.getNumPartitions()
    assert tasks == 1 if folders == 1 else tasks > 3
    plain = object_inventory(spark, str(tmp_path), by_spark=True)
    assert plain.columns == inventory.columns and plain.dtypes == inventory.dtypes
    assert sorted(map(tuple, plain.select("path", "bytes", "container").collect()), key=repr) == sorted(
        map(tuple, inventory.filter("bytes > 0").select("path", "bytes", "container").collect()), key=repr
    )
    assert "content" not in plain._jdf.queryExecution().executedPlan().toString()


def test_inventory_of_snapshots_and_versions(spark, tmp_path):
    names = ["a/x", "a/.snapshot/20240131T235959/x", ".snapshot/s1/y", ".version/20240201T000000/deep/z", "a.snapshot/x"]
    for name in names:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"1")
    got = {r["path"]: r for r in object_inventory(spark, str(tmp_path)).collect()}
    assert {p: r["kind"] for p, r in got.items()} == dict(zip(names, ["base", "snapshot", "snapshot", "version", "base"], strict=True))
    assert got[names[1]]["created_at"] == datetime(2024, 1, 31, 23, 59, 59)
    assert got[names[3]]["created_at"] == datetime(2024, 2, 1)
    assert all(got[n]["created_at"] == got[n]["modified_at"] for n in (names[0], names[2], names[4]))


DOCUMENTS = [
    (1, '{"a": {"b": [1, {"c": null}], "e": {}, "f": []}, "x": "y", "n": 1.5, "t": true}'),
    (2, "no json"),
    (3, "5"),
    (4, None),
    (5, '{"k.l": {"*": "s"}}'),
]


def test_flattening(spark):
    df = spark.createDataFrame(DOCUMENTS, "id int, j string")
    got = {tuple(r) for r in flatten_documents(df, "id", "j").collect()}
    assert got == {
        (1, "a.b.0", "1"),
        (1, "a.b.1.c", None),
        (1, "x", "y"),
        (1, "n", "1.5"),
        (1, "t", "true"),
        (3, "", "5"),
        (5, "k\\.l.*", "s"),
    }


def test_flattening_of_deep_documents(spark, monkeypatch):
    """Every leaf of twelve levels, of mixed containers, with brackets and quotes inside strings."""
    deep = '"[[{\\\\\\"{"'
    for i in range(12):
        deep = f'{{"k{i}": {deep}, "e": {{}}}}' if i % 2 else f"[{i}, {deep}, []]"
    rows = [(1, deep), (2, '{"a": "' + "[" * 50 + '"}'), (3, "[" * 40)]
    opened = []
    original = documents._opened
    monkeypatch.setattr(documents, "_opened", lambda *a: opened.append(a[-1]) or original(*a))
    got = {tuple(r) for r in flatten_documents(spark.createDataFrame(rows, "id int, j string"), "id", "j").collect()}
    path = ".".join(f"k{i}" if i % 2 else "1" for i in reversed(range(12)))
    want = {(1, path, '[[{\\"{'), (2, "a", "[" * 50)}
    for i in range(0, 12, 2):
        want.add((1, ".".join([*(f"k{j}" if j % 2 else "1" for j in reversed(range(i + 1, 12))), "0"]), str(i)))
    assert got == want
    # Twelve levels and the empty list inside the innermost one; the brackets in strings add none.
    assert opened == [13]


def test_documents_without_containers(spark):
    df = spark.createDataFrame([(1, "7"), (2, "bad"), (3, None)], "id int, j string")
    assert [tuple(r) for r in flatten_documents(df, "id", "j").collect()] == [(1, "", "7")]
    assert flatten_documents(df.limit(0), "id", "j").count() == 0


def test_flattening_scans_once_without_shuffle(spark, tmp_path):
    spark.createDataFrame(DOCUMENTS, "id int, j string").write.parquet(f"{tmp_path}/d")
    df = spark.read.parquet(f"{tmp_path}/d")
    plan = flatten_documents(df, "id", "j")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_event_stream_from_files(spark, tmp_path):
    spark.sql("SELECT 1 AS event_id, timestamp_ntz'2024-01-01' AS ts").write.parquet(f"{tmp_path}/e")
    schema = spark.read.parquet(f"{tmp_path}/e").schema
    stream = read_event_stream(spark, f"{tmp_path}/e", schema, fmt="parquet")
    assert stream.isStreaming and dict(stream.dtypes)["ts"] == "timestamp"


def test_messages_that_do_not_parse(spark):
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("tags", T.MapType(T.StringType(), T.IntegerType()))])
    texts = [
        '{"event_id": 1, "ts": "2024-01-01T00:00:00", "tags": {"a": 1}}', '{"event_id": 2, "ts": "2024-01-01T00:00:00", "offset": 9}',
        '{"event_id": "x", "ts": "2024-01-01T00:00:00"}', '{"event_id": 4, "ts"', "[1]", "7", "", "  ", None, '{"event_id": 5}', "{}",
    ]
    messages = spark.createDataFrame([(t.encode() if t is not None else None, i) for i, t in enumerate(texts)], "value binary, offset long")
    events, rejected = parse_messages(messages, schema)
    assert events.columns == ["event_id", "ts", "tags", "offset"] and dict(events.dtypes)["ts"] == "timestamp"
    assert sorted((r["event_id"], r["offset"]) for r in events.collect()) == [(1, 0), (2, 1)]
    got = {r["offset"]: r["reason"] for r in rejected.collect()}
    assert got == {2: "unparsable", 3: "unparsable", 4: "unparsable", 5: "unparsable", 6: "empty", 7: "empty", 8: "empty", 9: "no time", 10: "no time"}
    assert rejected.columns == ["value", "offset", "reason"]


def test_partitioned_writes_make_files_by_size(spark, tmp_path):
    """Many tasks, few files: as many as the size asks for, and several for a large partition."""
    rows = spark.range(0, 60_000, 1, 16).select("id", F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 10)).alias("p"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "512k")
    try:
        write_zone(rows, str(tmp_path), "raw", "data", "t", partition_by=["p"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {p.name: len(list(p.glob("*.parquet"))) for p in (tmp_path / "raw" / "data" / "t").glob("p=*")}
    assert files["p=p8"] == files["p=p9"] == 1
    assert 3 <= files["p=hot"] <= 16
    assert read_zone(spark, str(tmp_path), "raw", "data", "t").count() == 60_000


def test_kafka_needs_its_package(spark):
    schema = spark.range(1).schema
    with pytest.raises(Exception, match="(?i)kafka"):
        read_event_stream(spark, "host:9093", schema, topic="t")


class Recorder:
    """Stands in for Spark's reader and writer and keeps what it is told."""

    def __init__(self):
        self.read = self.write = self
        self.calls = {}

    def format(self, name):
        self.calls["format"] = name
        return self

    def mode(self, name):
        self.calls["mode"] = name
        return self

    def options(self, **options):
        self.calls |= options
        return self

    def load(self):
        return self

    save = load


def test_relational_options():
    source, sink = Recorder(), Recorder()
    read_jdbc(source, "jdbc:x", "nation", "n_nationkey", (0, 24), 4, fetchsize="1000")
    assert source.calls == {
        "format": "jdbc", "url": "jdbc:x", "dbtable": "nation", "partitionColumn": "n_nationkey",
        "lowerBound": 0, "upperBound": 24, "numPartitions": 4, "fetchsize": "1000",
    }
    write_jdbc(sink, "jdbc:x", "nation", mode="overwrite", n=2)
    assert sink.calls == {"format": "jdbc", "mode": "overwrite", "url": "jdbc:x", "dbtable": "nation", "numPartitions": 2}
