"""Statistics over tumbling event-time windows, for batch and for streams.

Distinct orders are counted in two grouped steps: rows are first merged per (key, order) and
then per key. Both steps combine before their shuffle, so a hot product or province is
spread over its orders, no set of ids is ever held, and the same plan is legal in a stream.
"""

from __future__ import annotations

from collections.abc import Iterable
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemill import codes, schemas
from tidemill.functions.times import second_text, text_to_time
from tidemill.functions.words import split_words
from tidemill.operators import products

WIDTH = "10 seconds"


def event_time(ts: str = "ts") -> Column:
    return F.timestamp_millis(F.col(ts))


def _timed(df: DataFrame, time: Column, delay: str | None) -> DataFrame:
    """Event time, and on streams the watermark."""
    df = df.withColumn("_time", time)
    return df.withWatermark("_time", delay) if delay is not None and df.isStreaming else df


def _bounds() -> list[Column]:
    return [second_text(F.col("window.start")).alias("stt"),
            second_text(F.col("window.end")).alias("edt")]


def _cents(amount: str) -> Column:
    """Money as BIGINT hundredths: summing longs is about twice as fast as summing decimals."""
    return (F.col(amount) * F.lit(100)).cast("bigint").alias(amount)


def _money(cents: Column) -> Column:
    return (F.coalesce(cents, F.lit(0)).cast("decimal(26,0)")
            * F.lit(Decimal("0.01"))).cast("decimal(28,2)")


def _milli_clock(as_of: Column | None) -> Column:
    now = F.unix_millis(as_of if as_of is not None else F.current_timestamp())
    return F.floor(now / F.lit(1000)).cast("bigint") * F.lit(1000).cast("bigint")


def visitor_stats(rows: DataFrame, width: str = WIDTH, delay: str | None = "12 seconds") -> DataFrame:
    """Sums of the visitor measures per region, channel, visitor kind and version."""
    return _visitor_sums(_timed(rows, event_time(), delay), width)


def visitor_stats_of(inputs: Iterable[DataFrame], width: str = WIDTH,
                     delay: str | None = "12 seconds") -> DataFrame:
    """The same over several inputs, each with its own watermark before the union."""
    timed = [_timed(rows, event_time(), delay) for rows in inputs]
    return _visitor_sums(reduce(DataFrame.unionByName, timed), width)


def _visitor_sums(rows: DataFrame, width: str) -> DataFrame:
    measures = ["uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum"]
    return (
        rows.groupBy(F.window("_time", width).alias("window"), "ar", "ch", "is_new", "vc")
        .agg(*[F.sum(m).alias(m) for m in measures], F.min("ts").alias("ts"))
        .select(*_bounds(), *schemas.VISITOR_STATS[2:])
    )


def product_stats(rows: DataFrame, width: str = WIDTH, delay: str | None = "2 seconds") -> DataFrame:
    """Sums of the product measures and counts of distinct orders per stock unit."""
    summed = [*products.COUNTS, *products.AMOUNTS]
    per_order = (
        _timed(rows, event_time(), delay)
        .withColumns({m: _cents(m) for m in products.AMOUNTS})
        .groupBy(F.window("_time", width).alias("window"), "sku_id", "order_kind", "order_ref")
        .agg(*[F.sum(m).alias(m) for m in summed], F.min("ts").alias("ts"))
    )

    def orders_of(kind: str) -> Column:
        return F.count(F.when(F.col("order_kind") == kind, F.col("order_ref")))

    return (
        per_order.groupBy("window", "sku_id")
        .agg(*[F.coalesce(F.sum(m), F.lit(0)).cast("bigint").alias(m) for m in products.COUNTS],
             *[_money(F.sum(m)).alias(m) for m in products.AMOUNTS],
             orders_of(products.ORDER).alias("order_ct"),
             orders_of(products.PAID).alias("paid_order_ct"),
             orders_of(products.REFUND).alias("refund_order_ct"),
             F.min("ts").alias("ts"))
        .select(*_bounds(), "sku_id", *products.COUNTS, *products.AMOUNTS,
                "order_ct", "paid_order_ct", "refund_order_ct", "ts")
    )


_PROVINCE = ["province_id", "province_name", "province_area_code",
             "province_iso_code", "province_3166_2_code"]


def province_stats(wide: DataFrame, width: str = WIDTH, delay: str | None = "1 second",
                   as_of: Column | None = None) -> DataFrame:
    """Distinct orders and the sum of line totals per province."""
    per_order = (
        _timed(wide, text_to_time(F.col("create_time")), delay)
        .withColumn("_cents", _cents("split_total_amount"))
        .groupBy(F.window("_time", width).alias("window"), *_PROVINCE, "order_id")
        .agg(F.sum("_cents").alias("_cents"))
    )
    return (
        per_order.groupBy("window", *_PROVINCE)
        .agg(F.count("order_id").alias("order_count"),
             _money(F.sum("_cents")).alias("order_amount"))
        .select(*_bounds(), *_PROVINCE, "order_amount", "order_count",
                _milli_clock(as_of).alias("ts"))
    )


def province_stats_sql(spark: SparkSession, view: str, width: str = WIDTH,
                       time: str = "row_time") -> DataFrame:
    """The same report as SQL over a registered view (``sources.topics.json_table`` makes one from
    JSON lines). Orders are counted in two grouped steps, so the view may be a stream with a
    watermark on ``time``; a stream gives the windows that the watermark has closed. Rows without
    a time are in no window."""
    keys = ", ".join(_PROVINCE)
    return spark.sql(f"""
        SELECT date_format(window.start, '{codes.SECOND_FORMAT}') AS stt,
               date_format(window.end, '{codes.SECOND_FORMAT}') AS edt,
               {keys},
               CAST(sum(amount) AS DECIMAL(28,2)) AS order_amount,
               count(order_id) AS order_count,
               unix_timestamp() * 1000 AS ts
        FROM (SELECT window, {keys}, order_id, sum(split_total_amount) AS amount
              FROM {view} GROUP BY window({time}, '{width}'), {keys}, order_id)
        GROUP BY window, {keys}
    """)


def keyword_stats(searches: DataFrame, width: str = WIDTH, time: str = "row_time",
                  delay: str | None = "2 seconds", source: str = codes.SOURCE_SEARCH,
                  as_of: Column | None = None) -> DataFrame:
    """How often each word was searched. The counting step is this library's completion of a
    report whose definition stops after the words."""
    words = split_words(searches, "full_word", "keyword").select("keyword", time)
    return (
        _timed(words, F.col(time), delay)
        .groupBy(F.window("_time", width).alias("window"), "keyword")
        .agg(F.count("*").alias("ct"))
        .select(*_bounds(), "keyword", F.lit(source).alias("source"), "ct",
                _milli_clock(as_of).alias("ts"))
    )
