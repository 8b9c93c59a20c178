"""Column names."""

from __future__ import annotations

from pyspark.sql import DataFrame


def camel_name(name: str) -> str:
    head, *rest = name.lower().split("_")
    return head + "".join(part.capitalize() for part in rest)


def snake_to_camel(df: DataFrame, enabled: bool = True) -> DataFrame:
    """Rename ``a_b`` to ``aB`` in every column."""
    return df.toDF(*map(camel_name, df.columns)) if enabled else df
