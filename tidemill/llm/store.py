"""Tables written in the shared work folder, and filters of a fixed size."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemill.session import work_folder


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a table in the shared folder: no lineage to lose with an executor."""
    return stored(df, purpose)[0]


def stored(df: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """Like ``written``, with the folder, so that a loop can remove what it has replaced.

    What was shuffled on the way is not needed once the table stands, and is removed with the
    end of the job instead of whenever the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    folder = work_folder(spark, purpose)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(folder)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(folder), folder


def removed(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def bit_filter(hashes: DataFrame, column: str, bits: int) -> np.ndarray:
    """A set of 64-bit hashes as 2^``bits`` bits: absent hashes mostly, present ones always seen.

    The driver gets at most 2^(``bits`` - 6) words whatever the number of hashes; a fuller
    filter only passes more rows to the exact join behind it.
    """
    place = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    words = (hashes.select(F.shiftright(place, 6).alias("word"),
                           F.expr(f"shiftleft(1L, cast({column} & 63L as int))").alias("bit"))
             .groupBy("word").agg(F.bit_or("bit").alias("bits")))
    out, found = np.zeros(1 << (bits - 6), np.int64), words.toArrow()
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return out.view(np.uint64)


def in_filter(filter_bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes & np.uint64(len(filter_bits) * 64 - 1)
    found = filter_bits[(place >> np.uint64(6)).astype(np.int64)]
    return (found >> (place & np.uint64(63))) & np.uint64(1) == 1


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)
