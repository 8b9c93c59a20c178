"""Text topics: Kafka topics, or folders of text files with one record per line."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemill.functions.records import json_columns
from tidemill.functions.times import whole_seconds


@dataclass(frozen=True)
class Topics:
    """Where topics live: ``folder`` (files, one sub-folder per topic) or ``servers`` (Kafka)."""

    folder: str | None = None
    servers: str | None = None

    def path(self, topic: str) -> str:
        return f"{self.folder.rstrip('/')}/{topic}"


def starting_options(mode: str, timestamp_ms: int | None = None,
                     offsets: dict | None = None) -> dict[str, str]:
    """Kafka reader options for a start mode.

    ``initial`` and ``earliest`` read everything kept (an initial snapshot is put before the
    changes with ``snapshot_rows``), ``latest`` only what comes next, ``timestamp`` what came
    since, ``offsets`` from {topic: {partition: offset}}.
    """
    if mode in ("initial", "earliest"):
        return {"startingOffsets": "earliest"}
    if mode == "latest":
        return {"startingOffsets": "latest"}
    if mode == "timestamp" and timestamp_ms is not None:
        return {"startingTimestamp": str(timestamp_ms),
                "startingOffsetsByTimestampStrategy": "latest"}
    if mode == "offsets" and offsets:
        return {"startingOffsets": json.dumps(offsets)}
    raise ValueError(f"unknown or incomplete start mode: {mode}")


def read_topic(spark: SparkSession, topics: Topics, topic: str, streaming: bool = True,
               group: str | None = None, starting: dict[str, str] | None = None,
               max_files: int | None = None, origin: str | None = None,
               by_batch: bool = False) -> DataFrame:
    """The lines of a topic as ``value STRING``; Kafka adds topic, partition and offset.

    ``origin`` is, for files, the folder of a writer that spreads rows over several topics;
    ``by_batch`` says that it commits them by micro-batch, of which only whole ones are read.
    """
    reader = spark.readStream if streaming else spark.read
    if topics.servers:
        reader = (reader.format("kafka").option("kafka.bootstrap.servers", topics.servers)
                  .option("subscribe", topic).options(**(starting or {})))
        if group:
            reader = reader.option("kafka.group.id", group)
        return reader.load().select(F.col("value").cast("string").alias("value"),
                                    "topic", "partition", "offset")
    if streaming and max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    reader = reader.format("text")
    if origin:
        batch = "batch_id BIGINT, " if by_batch else ""
        return (reader.schema(f"value STRING, {batch}topic STRING").load(topics.path(origin))
                .where(F.col("topic") == topic).select("value"))
    return reader.load(topics.path(topic))


def with_place(lines: DataFrame) -> DataFrame:
    """Lines with ``place``, which orders those of equal time: the offset where the source has
    one, else a hash of the text."""
    place = F.col("offset") if "offset" in lines.columns else F.xxhash64("value")
    return lines.select("value", place.alias("place"))


def read_records(spark: SparkSession, topics: Topics, topic: str, schema: str,
                 streaming: bool = True, **options) -> DataFrame:
    """The records of a topic as typed columns, with their ``place``."""
    return json_columns(with_place(read_topic(spark, topics, topic, streaming, **options)), schema)


def json_table(lines: DataFrame, schema: str, row_time: Column, delay: str | None = None,
               view: str | None = None, value: str = "value") -> DataFrame:
    """Declared columns of JSON lines plus the computed column ``row_time``.

    On streams ``delay`` sets the watermark. ``view`` registers the table for SQL.
    """
    table = (
        lines.select(F.from_json(value, schema).alias("r")).select("r.*")
        .withColumn("row_time", row_time)
    )
    if delay is not None:
        table = table.withWatermark("row_time", delay)
    if view:
        table.createOrReplaceTempView(view)
    return table


def millis_row_time(ts: str = "ts") -> Column:
    """Row time of an epoch-ms column, cut to whole seconds."""
    return whole_seconds(F.col(ts))
