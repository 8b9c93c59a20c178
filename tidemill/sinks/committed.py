"""Topics in folders that micro-batches write, each batch as a whole or not at all.

``folder/batch_id=…/topic=…`` holds the lines of a batch. They are written below
``folder/_writing``, which readers do not list, and put in place by one rename; the rename is the
commit. What a batch wrote before it failed is replaced when the batch runs again, and a batch
that is in place already changes nothing, so a folder belongs to one checkpoint. The file
system must rename folders as a whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemill.sinks.tables import delete, exists, rename


def _place(folder: str, batch_id: int) -> str:
    return f"{folder}/batch_id={batch_id}"


def stage_batch(lines: DataFrame, folder: str, batch_id: int) -> None:
    """Write ``value, topic`` lines where no reader sees them yet."""
    (
        lines.select("value", "topic").write.mode("overwrite").partitionBy("topic")
        .text(_place(f"{folder}/_writing", batch_id))
    )


def commit_batch(spark: SparkSession, folder: str, batch_id: int) -> None:
    """Show readers the lines of a batch."""
    rename(spark, _place(f"{folder}/_writing", batch_id), _place(folder, batch_id))


def in_place(spark: SparkSession, folder: str, batch_id: int) -> bool:
    return exists(spark, _place(folder, batch_id))


def write_batch(lines: DataFrame, folder: str, batch_id: int) -> None:
    """Write and commit the lines of a batch, unless they are in place."""
    spark = lines.sparkSession
    if not in_place(spark, folder, batch_id):
        stage_batch(lines, folder, batch_id)
        commit_batch(spark, folder, batch_id)


def pinned(rows: DataFrame, folder: str, batch_id: int) -> DataFrame:
    """``rows`` as the first attempt of the batch saw them, also when it runs again. What the
    batch before had seen is deleted: it has ended."""
    spark, place = rows.sparkSession, _place(folder, batch_id)
    if not in_place(spark, folder, batch_id):
        staged = _place(f"{folder}/_writing", batch_id)
        rows.write.mode("overwrite").parquet(staged)
        rename(spark, staged, place)
    delete(spark, _place(folder, batch_id - 1))
    return spark.read.schema(rows.schema).parquet(place)
