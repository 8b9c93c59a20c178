"""Running streams: to the end of their input, to several outputs, again after a stop."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemill.session import (
    ROCKSDB_PROVIDER, STATE_PROVIDER_KEY, state_partitions, work_folder)


@contextmanager
def stream_settings(spark: SparkSession, more: dict[str, str] | None = None) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB, in ``state_partitions`` parts, and have
    the settings ``more``. The session's own settings return afterwards; a running query keeps
    those it started with."""
    wanted = {STATE_PROVIDER_KEY: ROCKSDB_PROVIDER,
              "spark.sql.shuffle.partitions": str(state_partitions(spark)), **(more or {})}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def start_to_files(df: DataFrame, path: str, checkpoint: str, once: bool = True,
                   trigger: str = "10 seconds",
                   settings: dict[str, str] | None = None) -> StreamingQuery:
    """Append a stream to Parquet files, exactly once. A restart is a new start with the same
    checkpoint."""
    writer = (
        df.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=trigger)
    with stream_settings(df.sparkSession, settings):
        return writer.start()


def drain(df: DataFrame, purpose: str) -> DataFrame:
    """Run a stream over all input there is now, and read what it wrote."""
    spark = df.sparkSession
    folder = work_folder(spark, purpose)
    start_to_files(df, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{folder}/out")


def start_per_batch(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
                    once: bool = True, trigger: str = "10 seconds") -> StreamingQuery:
    """Hand every micro-batch to ``write``; it must be repeatable for the same batch id."""
    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=trigger)
    with stream_settings(df.sparkSession):
        return writer.start()


#: Fixed value: how often a failed query is started again.
RESTARTS = 3


def supervise(start: Callable[[], StreamingQuery], restarts: int = RESTARTS,
              pause: float = 5.0) -> StreamingQuery:
    """Run what ``start`` starts to its end. A query that fails is started again from its
    checkpoint after ``pause`` seconds, at most ``restarts`` times; then its error is raised."""
    for left in range(restarts, -1, -1):
        query = start()
        try:
            query.awaitTermination()
            break
        except StreamingQueryException:
            if not left:
                raise
            time.sleep(pause)
    return query


def side_outputs(split: Callable[[DataFrame], dict[str, DataFrame]],
                 folder: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes several outputs of one pass.

    The batch is computed once and kept while it is split; each output replaces its own
    ``batch_id`` partition, so a repeated batch writes the same rows once.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            for name, part in split(kept).items():
                part.write.mode("overwrite").parquet(f"{folder}/{name}/batch_id={batch_id}")
        finally:
            kept.unpersist()

    return write
