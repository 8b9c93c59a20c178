"""Per-device questions on the page log, batch forms.

A device may own any share of the rows, so none of these sorts a whole device in one task:
firsts are reduced before the shuffle, and neighbours are looked up inside time buckets.
``order`` names columns that make rows of one device with one ``ts`` distinct (for example
the source offset); they stand in for arrival order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemill.operators.logs import is_session_entry


def first_per(df: DataFrame, keys: list[Column | str], order: list[Column | str]) -> DataFrame:
    """The first row per key. Spark keeps one row per key and task before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_row_no", place).where("_row_no = 1").drop("_row_no")


def repair_is_new(logs: DataFrame, order: list[str], device: str = "common.mid") -> DataFrame:
    """Only the first row of a device flagged new stays new; rows flagged old pass untouched.

    A row without a time comes before all others. The firsts come from narrow columns, and the join back is on the row's own identity, which
    spreads a hot device evenly. Old rows are not shuffled.
    """
    flagged = F.col("common.is_new").eqNullSafe("1")
    new = logs.where(flagged)
    identity = ["ts", *order]
    firsts = first_per(
        new.select(F.col(device).alias("_device"), *[F.col(c).alias(f"_first_{c}") for c in identity]),
        ["_device"], [f"_first_{c}" for c in identity])
    same_row = F.col(device).eqNullSafe(F.col("_device"))
    for c in identity:
        same_row = same_row & F.col(c).eqNullSafe(F.col(f"_first_{c}"))
    repaired = (
        new.join(firsts.withColumn("_is_first", F.lit(True)), same_row, "left")
        .withColumn("common", F.col("common").withField(
            "is_new", F.when(F.col("_is_first"), "1").otherwise("0")))
        .select(*logs.columns)
    )
    return logs.where(~flagged).unionByName(repaired)


def unique_visit(pages: DataFrame, order: list[str], device: str = "common.mid") -> DataFrame:
    """The first session-entry row per device and calendar day of the session's zone."""
    day = F.to_date(F.timestamp_millis(F.col("ts")))
    return first_per(pages.where(is_session_entry()).withColumn("_day", day),
                     [device, "_day"], ["ts", *order]).drop("_day")


def show_ahead(df: DataFrame, gap_ms: int, bucket_gaps: int) -> DataFrame:
    """Put rows into time buckets of ``bucket_gaps`` gaps, as ``_bucket`` and ``_own``. Rows
    closer than one gap to the start of a bucket are also shown, not owned, to the bucket
    before, so the neighbours within one gap of an owned row are all in its bucket."""
    width = gap_ms * bucket_gaps
    bucket = F.floor(F.col("ts") / F.lit(width))
    own = F.struct(bucket.alias("id"), F.lit(True).alias("own"))
    ahead = F.when(F.pmod(F.col("ts"), F.lit(width)) < gap_ms,
                   F.struct((bucket - 1).alias("id"), F.lit(False).alias("own")))
    both = F.filter(F.array(own, ahead), lambda b: b.isNotNull())
    return (
        df.withColumn("_b", F.explode(both))
        .withColumn("_bucket", F.col("_b.id")).withColumn("_own", F.col("_b.own")).drop("_b")
    )


def with_next(pages: DataFrame, order: list[str], gap_ms: int = 10_000,
              device: str = "common.mid", bucket_gaps: int = 30) -> DataFrame:
    """Entry rows with what follows within the gap: ``_next_entry`` is true when the next row
    of the device is an entry row, false when it is not, null when none comes within ``gap_ms``.
    Each time bucket of a device is decided alone."""
    shown = show_ahead(pages, gap_ms, bucket_gaps).withColumn("_entry", is_session_entry())
    line = Window.partitionBy(F.col(device), "_bucket").orderBy("ts", *order)
    within = F.lead("ts").over(line) < F.col("ts") + gap_ms
    return (
        shown.withColumn("_next_entry", F.when(within, F.lead("_entry").over(line)))
        .where(F.col("_own") & F.col("_entry"))
        .select(*pages.columns, "_next_entry")
    )


def matched_jumps(entries: DataFrame) -> DataFrame:
    """Entry rows directly followed by another entry row within the gap."""
    return entries.where("_next_entry").drop("_next_entry")


def timed_out_jumps(entries: DataFrame) -> DataFrame:
    """Entry rows after which nothing comes within the gap."""
    return entries.where("_next_entry IS NULL").drop("_next_entry")


def user_jump(pages: DataFrame, order: list[str], gap_ms: int = 10_000,
              device: str = "common.mid", bucket_gaps: int = 30) -> DataFrame:
    """Entry rows whose visit ends at once, by either reason, in one pass."""
    entries = with_next(pages, order, gap_ms, device, bucket_gaps)
    return entries.where("_next_entry IS NOT FALSE").drop("_next_entry")
