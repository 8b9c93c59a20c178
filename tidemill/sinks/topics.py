"""JSON text to topics, for batch and for streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemill.sinks import committed
from tidemill.sources.topics import Topics


def as_json(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def sink_topic(df: DataFrame, topics: Topics, topic: str, checkpoint: str | None = None,
               once: bool = False) -> StreamingQuery | None:
    """Every row as JSON to one topic. Files are exactly-once, Kafka at-least-once."""
    return _write(as_json(df), topics, topic, None, checkpoint, once)


def by_row_lines(routed: DataFrame, default: str = "default_topic") -> DataFrame:
    return routed.select(F.to_json("after").alias("value"),
                         F.coalesce("sink_table", F.lit(default)).alias("topic"))


def sink_topic_by_row(routed: DataFrame, topics: Topics, checkpoint: str | None = None,
                      once: bool = False, origin: str = "by_row",
                      default: str = "default_topic",
                      batch_id: int | None = None) -> StreamingQuery | None:
    """The ``after`` image of each row to the topic its ``sink_table`` names; ``batch_id`` as in
    ``sink_lines``."""
    return sink_lines(by_row_lines(routed, default), topics, origin, checkpoint, once, batch_id)


def sink_lines(lines: DataFrame, topics: Topics, origin: str, checkpoint: str | None = None,
               once: bool = False, batch_id: int | None = None) -> StreamingQuery | None:
    """``topic, value`` lines to their topics; files lie below ``origin``.

    Within ``foreachBatch``, ``batch_id`` makes files exactly-once: a batch that runs again leaves
    its lines once, and they are read with ``by_batch``. Kafka stays at-least-once.
    """
    if batch_id is not None and not topics.servers:
        committed.write_batch(lines, topics.path(origin), batch_id)
        return None
    return _write(lines, topics, origin, "topic", checkpoint, once)


def _write(rows: DataFrame, topics: Topics, topic: str, by: str | None,
           checkpoint: str | None, once: bool) -> StreamingQuery | None:
    writer = rows.writeStream if rows.isStreaming else rows.write
    if topics.servers:
        writer = writer.format("kafka").option("kafka.bootstrap.servers", topics.servers)
        if not by:
            writer = writer.option("topic", topic)
    else:
        writer = writer.format("text").option("path", topics.path(topic))
        if by:
            writer = writer.partitionBy(by)
    if not rows.isStreaming:
        writer.mode("append").save()
        return None
    writer = writer.option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def sink_console(df: DataFrame, rows: int) -> StreamingQuery | None:
    """Debug print of the first ``rows`` rows of a batch, or of each micro-batch."""
    if df.isStreaming:
        return (df.writeStream.format("console").option("numRows", str(rows))
                .option("truncate", "false").start())
    df.show(rows, truncate=False)
    return None
