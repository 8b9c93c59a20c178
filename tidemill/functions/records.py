"""JSON text to typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import AtomicType, StringType, StructField, StructType


def fields_of(ddl: str) -> list[StructField]:
    return StructType.fromDDL(ddl).fields


def json_columns(df: DataFrame, ddl: str, value: str = "value") -> DataFrame:
    """The fields of JSON objects, typed. Simple fields may be written as numbers or as text
    (change logs write decimals and ids as text); what does not fit its type becomes null."""
    fields = fields_of(ddl)
    as_text = StructType([
        StructField(f.name, StringType() if isinstance(f.dataType, AtomicType) else f.dataType)
        for f in fields])

    def typed(field: StructField) -> Column:
        column = F.col(f"_r.{field.name}")
        simple = isinstance(field.dataType, AtomicType)
        return (column.try_cast(field.dataType) if simple else column).alias(field.name)

    others = [c for c in df.columns if c != value]
    parsed = df.select(*others, F.explode(F.array(F.from_json(value, as_text))).alias("_r"))
    return parsed.select(*others, *[typed(f) for f in fields])
