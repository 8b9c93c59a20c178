"""Report tables and databases, and the merge of changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemill.operators.visits import first_per


def _replace_partitions(rows: DataFrame, folder: str, by: list[str]) -> None:
    """Overwrite only the partitions present in ``rows``; even files, also for a hot one."""
    (
        rows.hint("rebalance", *[F.col(c) for c in by])
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by).parquet(folder)
    )


def files(spark: SparkSession, folder: str):
    """The file system of a folder, and its path there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, folder: str) -> bool:
    fs, path = files(spark, folder)
    return fs.exists(path)


def rename(spark: SparkSession, source: str, target: str) -> None:
    fs, path = files(spark, source)
    if not fs.rename(path, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"{source} could not be renamed to {target}")


def delete(spark: SparkSession, folder: str) -> None:
    fs, path = files(spark, folder)
    fs.delete(path, True)


def make(spark: SparkSession, folder: str) -> None:
    fs, path = files(spark, folder)
    fs.mkdirs(path)


def merge_changes(changes: DataFrame, columns: list[str], order: list[str]) -> DataFrame:
    """Per ``pk``, each column's value in the last change that has it."""
    def last(column: str):
        place = F.when(F.map_contains_key("after", column), F.struct(*order))
        return F.max_by(F.struct(F.col("after")[column].alias("v")), place)["v"].alias(column)

    return changes.groupBy("pk").agg(*[last(c) for c in columns]).select(*columns)


def without(df: DataFrame, transient: list[str]) -> DataFrame:
    """The columns a positional insert binds: all but the marked ones."""
    return df.drop(*transient)


def sink_jdbc(df: DataFrame, url: str, table: str, transient: list[str] | None = None,
              driver: str | None = None, batch_size: int = 1000, writers: int = 8) -> None:
    """Insert rows into a database table by column position of the remaining columns.

    ``writers`` bounds the connections; it never drops rows.
    """
    rows = without(df, transient or [])
    options = {"url": url, "dbtable": table, "batchsize": str(batch_size),
               "numPartitions": str(writers)}
    if driver:
        options["driver"] = driver
    rows.write.format("jdbc").options(**options).mode("append").save()


def newest_per_key(rows: DataFrame, keys: list[str], version: str = "ts") -> DataFrame:
    """The row with the greatest version per key."""
    others = [F.col(c) for c in rows.columns if c not in (*keys, version)]
    return first_per(rows, keys, [F.col(version).desc(), *others])


def sink_replacing(rows: DataFrame, folder: str, batch_id: int, start: str = "stt") -> None:
    """Add a batch of report rows below ``folder/day=…/batch_id=…``; see ``read_replacing``."""
    rows = rows.withColumn("day", F.substring(start, 1, 10)).withColumn(
        "batch_id", F.lit(batch_id))
    _replace_partitions(rows, folder, ["day", "batch_id"])


def read_replacing(spark: SparkSession, folder: str, keys: list[str],
                   version: str = "ts") -> DataFrame:
    """The report with only the newest version of each key, read day by day partition."""
    return newest_per_key(spark.read.parquet(folder).drop("batch_id"), ["day", *keys],
                          version).drop("day")
