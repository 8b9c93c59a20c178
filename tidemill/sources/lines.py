"""Delimited text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def parse_csv_line(lines: DataFrame, second: str, value: str = "value") -> DataFrame:
    """``id,<second>,seconds`` lines to ``id``, ``second``, ``ts`` (seconds) and ``time``."""
    parsed = F.from_csv(value, f"id STRING, `{second}` STRING, ts BIGINT")
    return (
        lines.select(parsed.alias("r")).select("r.*")
        .withColumn("time", F.timestamp_millis(F.col("ts") * 1000))
    )
