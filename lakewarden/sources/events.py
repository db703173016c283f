"""Event streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.readwriter import DataStreamWriter

_TEXT = "__message"


def _parsed(messages: DataFrame, schema: T.StructType, value: str, event_time: str) -> DataFrame:
    """``messages`` with ``event`` and ``reason``, null for a message that parses."""
    full = T.StructType([*schema, T.StructField(_TEXT, T.StringType())])
    text = F.col(value).cast("string")
    event = F.from_json(text, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _TEXT})
    marked = messages.withColumn("event", event)
    blank = F.col(value).isNull() | (F.trim(text) == "")
    untimed = F.col(f"event.{event_time}").isNull() if event_time in schema.names else F.lit(False)
    reason = (
        F.when(blank, "empty").when(F.col("event").isNull() | F.col(f"event.{_TEXT}").isNotNull(), "unparsable").when(untimed, "no time")
    )
    return marked.withColumn("reason", reason)


def parse_messages(
    messages: DataFrame, schema: T.StructType, *, value: str = "value", event_time: str = "ts"
) -> tuple[DataFrame, DataFrame]:
    """JSON messages as events of ``schema`` and the messages that are none, of a table or a stream.

    The events have the other columns of ``messages`` (partition, offset …) behind their own and ``event_time`` as
    ``timestamp``. The second output has the columns of ``messages`` as they came and ``reason``: ``empty``,
    ``unparsable`` (no JSON object, or a value that doesn't fit its type) or ``no time``. Every message is in one of the two.
    """
    parsed = _parsed(messages, schema, value, event_time)
    others = [c for c in messages.columns if c != value and c not in schema.names]
    events = parsed.filter(F.col("reason").isNull()).select(*[F.col(f"event.`{c}`").alias(c) for c in schema.names], *others)
    if event_time in schema.names:
        events = events.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return events, parsed.filter(F.col("reason").isNotNull()).select(*messages.columns, "reason")


def write_parsed(
    messages: DataFrame, schema: T.StructType, path: str, checkpoint: str, *, value: str = "value", event_time: str = "ts"
) -> DataStreamWriter:
    """A writer that keeps a stream's events below ``<path>/events`` and its other messages below ``<path>/rejected``.

    Each batch goes to ``batch_id=<id>`` of both, replacing what an earlier attempt at it left.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        for name, rows in zip(("events", "rejected"), parse_messages(batch, schema, value=value, event_time=event_time), strict=True):
            rows.write.mode("overwrite").parquet(f"{path}/{name}/batch_id={batch_id}")

    return messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def read_message_stream(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """A topic's messages as they are: ``value``, ``partition`` and ``offset`` (needs the Kafka package on the classpath)."""
    reader = spark.readStream.format("kafka").options(**options)
    raw = reader.options(**{"kafka.bootstrap.servers": servers, "subscribe": topic}).load()
    return raw.select("value", "partition", "offset")


def read_event_stream(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    *,
    fmt: str = "kafka",
    topic: str | None = None,
    event_time: str = "ts",
    **options: str,
) -> DataFrame:
    """A stream of parsed events with a usable event time.

    ``fmt="kafka"`` reads ``topic`` from the servers in ``source`` and parses each JSON message by
    ``schema``, keeping its ``partition`` and ``offset``. Messages that are no events are left out;
    ``read_message_stream`` with ``parse_messages`` or ``write_parsed`` keeps them. Any other format
    follows the files that arrive in folder ``source``. Event time comes out as ``timestamp``, the
    only type watermarks take.
    """
    if fmt == "kafka":
        if topic is None:
            raise ValueError("name the topic to read")
        return parse_messages(read_message_stream(spark, source, topic, **options), schema, event_time=event_time)[0]
    events = spark.readStream.format(fmt).options(**options).schema(schema).load(source)
    return events.withColumn(event_time, F.col(event_time).cast("timestamp"))
