"""Dimension tables that are merged when they are written: buckets of rows under a manifest.

``folder/rows/sink_table=…/bucket=…/version=…`` holds the merged rows of a bucket as some batch
left them, ``folder/manifest/version=…`` names for every bucket the version that counts. A batch
writes new versions of the buckets it touches, then its manifest, which is renamed into place
as a whole; readers follow the last manifest and merge nothing. What a batch wrote before it
failed is not in any manifest, and is replaced when the batch runs again.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemill.sinks.tables import delete, files, rename

#: Buckets of a table that is first written. A batch rewrites the buckets that it touches, so
#: give a large table that is changed in few places many of them.
BUCKETS = 32

_CELL = "STRUCT<ts_ms: BIGINT, batch_id: BIGINT, place: BIGINT, value: STRING>"
ROWS = f"pk STRING, cells MAP<STRING, {_CELL}>"


def _versions(spark: SparkSession, folder: str) -> list[int]:
    """The manifests in place, oldest first."""
    fs, path = files(spark, f"{folder}/manifest")
    if not fs.exists(path):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(path)]
    return sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version="))


def _manifest(spark: SparkSession, folder: str, version: int) -> dict:
    """{"buckets": number, "tables": {table: {bucket: version}}}"""
    lines = spark.read.text(f"{folder}/manifest/version={version}").collect()
    return json.loads(lines[0].value)


def current(spark: SparkSession, folder: str) -> dict:
    """The manifest that counts; before the first batch, one without tables."""
    versions = _versions(spark, folder)
    return _manifest(spark, folder, versions[-1]) if versions else {
        "buckets": BUCKETS, "tables": {}}


def _switch(spark: SparkSession, folder: str, manifest: dict, version: int) -> None:
    """Put a manifest in place by one rename."""
    new = f"{folder}/manifest/new-{version}"
    spark.createDataFrame([(json.dumps(manifest),)], "value STRING").coalesce(1).write.mode(
        "overwrite").text(new)
    rename(spark, new, f"{folder}/manifest/version={version}")


def _read(spark: SparkSession, folder: str, table: str, versions: dict[str, int]) -> DataFrame:
    paths = [f"{folder}/rows/sink_table={table}/bucket={bucket}/version={version}"
             for bucket, version in versions.items()]
    if not paths:
        return spark.createDataFrame([], ROWS)
    return spark.read.schema(ROWS).parquet(*paths)


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("pk"), F.lit(buckets)).cast("int")


def upsert_batch(routed: DataFrame, folder: str, batch_id: int, place: str | None = None,
                 by_batch: bool = True) -> None:
    """Merge one batch of routed changes (``sink_table``, ``pk``, ``after``, ``ts_ms``) into its
    tables: per key and column, the last change that carries the column counts, nulls included.

    Changes are ordered by ``ts_ms``, batch (unless not ``by_batch``) and ``place``, a BIGINT
    column; an older one that comes late does not win. The key is kept under its own name
    (``sink_pk``, if the rows have it) even where the rule does not list it. A batch that is
    in place already changes nothing, so a folder belongs to one checkpoint.
    """
    spark = routed.sparkSession
    versions = _versions(spark, folder)
    if versions and batch_id <= versions[-1]:
        return
    manifest = current(spark, folder)
    after = F.col("after")
    if "sink_pk" in routed.columns:
        after = F.map_concat(F.map_filter("after", lambda k, _: k != F.col("sink_pk")),
                             F.create_map("sink_pk", "pk"))
    order = (F.col("ts_ms").cast("bigint").alias("ts_ms"),
             F.lit(batch_id if by_batch else 0).cast("bigint").alias("batch_id"),
             (F.col(place) if place else F.lit(0)).cast("bigint").alias("place"))
    changes = routed.select(
        "sink_table", _bucket(manifest["buckets"]).alias("bucket"), "pk",
        F.transform_values(after, lambda _, v: F.struct(*order, v.alias("value"))).alias("cells"))
    touched = [(r.sink_table, str(r.bucket))
               for r in changes.select("sink_table", "bucket").distinct().collect()]
    rows = changes
    for table in sorted({t for t, _ in touched}):
        held = manifest["tables"].get(table, {})
        before = {b: held[b] for t, b in touched if t == table and b in held}
        if before:
            rows = rows.unionByName(_read(spark, folder, table, before).select(
                F.lit(table).alias("sink_table"), _bucket(manifest["buckets"]).alias("bucket"),
                "pk", "cells"))
    key = ["sink_table", "bucket", "pk"]
    last = (rows.select(*key, F.explode_outer("cells").alias("name", "cell"))
            .groupBy(*key, "name").agg(F.max("cell").alias("cell")))
    named = F.when(F.col("name").isNotNull(), F.struct("name", "cell"))
    merged = last.groupBy(*key).agg(F.map_from_entries(F.collect_list(named)).alias("cells"))
    (
        merged.withColumn("version", F.lit(batch_id))
        .hint("rebalance", F.col("sink_table"), F.col("bucket"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("sink_table", "bucket", "version").parquet(f"{folder}/rows")
    )
    for table, bucket in touched:
        manifest["tables"].setdefault(table, {})[bucket] = batch_id
    _switch(spark, folder, manifest, batch_id)


def sink_dim_upsert(folder: str, place: str | None = None) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that upserts routed changes into dimension tables."""
    return lambda batch, batch_id: upsert_batch(batch, folder, batch_id, place)


def read_dimension(spark: SparkSession, folder: str, table: str, columns: list[str]) -> DataFrame:
    """The dimension as text columns, one row per key, without any merging. A table that was never
    written is empty; a column that no change carried is null."""
    versions = current(spark, folder)["tables"].get(table, {})
    return _read(spark, folder, table, versions).select(
        *[F.try_element_at("cells", F.lit(c))["value"].alias(c) for c in columns])


def vacuum(spark: SparkSession, folder: str, manifests: int = 2) -> None:
    """Delete versions of buckets that none of the last ``manifests`` manifests names, and
    the manifests before those. Readers that still follow an older one would miss files."""
    versions = _versions(spark, folder)
    kept = versions[-manifests:]
    named = {(t, b, v) for n in kept for t, held in _manifest(spark, folder, n)["tables"].items()
             for b, v in held.items()}
    fs, path = files(spark, f"{folder}/rows/sink_table=*/bucket=*/version=*")
    for status in fs.globStatus(path) or []:
        place = status.getPath()
        table, bucket, version = (p.getName().split("=", 1)[1] for p in (
            place.getParent().getParent(), place.getParent(), place))
        # a version beyond the last manifest may be of a batch that is being written
        if (table, bucket, int(version)) not in named and int(version) <= max(kept, default=-1):
            fs.delete(place, True)
    for old in versions[:-manifests]:
        delete(spark, f"{folder}/manifest/version={old}")


def sink_current_state(folder: str, pk: str, order: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that keeps the rows which changes leave standing, as
    ``current_state`` does for a batch. A deletion stays as a mark, so that an older change
    that comes after it does not bring the row back. ``order`` orders changes of one time."""
    def write(batch: DataFrame, batch_id: int) -> None:
        row = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
        gone = F.when(F.col("op") == "d", "1").otherwise("0")
        changes = batch.select(
            F.lit("rows").alias("sink_table"), row[pk].alias("pk"), "ts_ms", order,
            F.create_map(F.lit("row"), F.to_json(row, {"ignoreNullFields": "false"}),
                         F.lit("gone"), gone).alias("after"))
        upsert_batch(changes, folder, batch_id, order, by_batch=False)
    return write


def read_current_state(spark: SparkSession, folder: str) -> DataFrame:
    """(pk, row) of the rows that stand."""
    versions = current(spark, folder)["tables"].get("rows", {})
    return (_read(spark, folder, "rows", versions)
            .where(F.try_element_at("cells", F.lit("gone"))["value"] == "0")
            .select("pk", F.from_json(F.try_element_at("cells", F.lit("row"))["value"],
                                      "map<string,string>").alias("row")))
