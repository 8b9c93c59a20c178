"""Interval joins, dimension lookups, rule routing."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructField

_MICROS = timedelta(microseconds=1)


def interval_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                  left_time: str, right_time: str, lower: timedelta, upper: timedelta,
                  lower_inclusive: bool = True, upper_inclusive: bool = True,
                  salts: int = 1) -> DataFrame:
    """Pairs of equal key with right time in [left time + lower, left time + upper].

    Both sides get a time bucket next to the key: a right row sits in one bucket, a left row
    is shown to the one or two buckets its interval touches. A key that owns a large share
    of the rows is thereby spread over time, and only neighbours in time are compared. A key
    that is hot within a single bucket can be spread further with ``salts``: right rows
    take one of them, left rows are shown to all. The same form serves batch and streams;
    give streams their watermarks first, and leave ``salts`` at 1.
    """
    width = max(2 * ((upper - lower) // _MICROS), 1_000_000)

    def bucket(time: Column) -> Column:
        return F.floor(F.unix_micros(time) / F.lit(width)).cast("bigint")

    def shifted(by: timedelta) -> Column:
        return F.col(left_time) + F.lit(by)

    left = left.withColumn(
        "_bucket", F.explode(F.sequence(bucket(shifted(lower)), bucket(shifted(upper)))))
    right = right.withColumn("_right_bucket", bucket(F.col(right_time)))
    on = (F.col(left_key) == F.col(right_key)) & (F.col("_bucket") == F.col("_right_bucket"))
    if salts > 1:
        left = left.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        right = right.withColumn("_right_salt", row_salt(right, salts))
        on = on & (F.col("_salt") == F.col("_right_salt"))
    after = F.col(right_time) >= shifted(lower) if lower_inclusive \
        else F.col(right_time) > shifted(lower)
    before = F.col(right_time) <= shifted(upper) if upper_inclusive \
        else F.col(right_time) < shifted(upper)
    return (
        left.join(right, on & after & before, "inner")
        .drop("_bucket", "_right_bucket", "_salt", "_right_salt")
    )


def row_salt(df: DataFrame, salts: int) -> Column:
    """A salt by a hash of all the row's columns: it differs from row to row, and a task that runs
    again gives every row the salt that it had. Only exact copies of a row share one."""
    def hashed(field: StructField) -> Column:
        kind = field.dataType.simpleString()
        plain = "map<" not in kind and "variant" not in kind
        return F.col(f"`{field.name}`") if plain else F.to_json(F.struct(F.col(f"`{field.name}`")))
    return F.pmod(F.xxhash64(*map(hashed, df.schema.fields)), F.lit(salts)).cast("int")


def dim_join(df: DataFrame, dim: DataFrame, key: str, attributes: dict[str, str | Column],
             dim_key: str = "id", max_broadcast_bytes: int = 32 << 20,
             salts: int = 16) -> DataFrame:
    """Left lookup: add ``attributes`` (output name -> dimension column) for ``key``.

    Rows without a match keep null attributes; repeated dimension keys never multiply rows
    (the greatest row wins). A dimension that was measured to be small is broadcast; the
    result does not depend on it. A larger one is joined by key and salt: each row takes one
    of ``salts``, the dimension is shown to all, so a hot key, and the rows with a null key,
    spread over that many tasks.
    """
    base = df.drop(*attributes)
    picked = (
        dim.where(F.col(dim_key).isNotNull())
        .groupBy(F.col(dim_key).cast("string").alias("_dim_key"))
        .agg(F.max(F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(f"_dim_{out}")
                              for out, c in attributes.items()])).alias("_dim"))
        .select("_dim_key", "_dim.*")
    )
    on = F.col(key).cast("string") == F.col("_dim_key")
    if is_small(picked, max_broadcast_bytes):
        picked = F.broadcast(picked)
    else:
        # the planner guesses sizes from compressed files and would broadcast a large
        # dimension through the driver all the same
        picked = picked.hint("merge")
        if salts > 1:
            base = base.withColumn("_salt", row_salt(base, salts))
            picked = picked.withColumn(
                "_dim_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
            on = on & (F.col("_salt") == F.col("_dim_salt"))
    joined = base.join(picked, on, "left")
    looked_up = {out: F.col(f"_dim_{out}") for out in attributes}
    return joined.select(
        *[looked_up.get(c, F.col(c)).alias(c) for c in df.columns],
        *[column.alias(out) for out, column in looked_up.items() if out not in df.columns],
    )


def is_small(df: DataFrame, max_bytes: int) -> bool:
    """Whether the rows of ``df`` take at most ``max_bytes``; one pass over them. Texts are
    measured, simple columns count 16 bytes, others are printed to be measured."""
    def size(field: StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, StringType):
            return F.coalesce(F.octet_length(column), F.lit(0)) + 8
        if "<" in field.dataType.simpleString():
            return F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0))
        return F.lit(16)
    total = sum(map(size, df.schema.fields), F.lit(0))
    return (df.agg(F.sum(total)).first()[0] or 0) <= max_bytes
