"""Order, detail and payment records."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType

from tidemill import schemas
from tidemill.functions.records import fields_of
from tidemill.functions.times import age_in_years, text_to_millis, text_to_time
from tidemill.operators.joins import dim_join, interval_join


def with_order_times(orders: DataFrame) -> DataFrame:
    """Add ``create_date``, ``create_hour`` and epoch-ms ``create_ts`` from ``create_time``."""
    day_and_clock = F.split("create_time", " ")
    return (
        orders.withColumn("create_date", day_and_clock[0])
        .withColumn("create_hour", F.split(day_and_clock[1], ":")[0])
        .withColumn("create_ts", text_to_millis(F.col("create_time")))
    )


def with_detail_times(details: DataFrame) -> DataFrame:
    return details.withColumn("create_ts", text_to_millis(F.col("create_time")))


# Where each column of the order-wide record comes from; the rest is looked up or stays null.
_FROM_ORDER = {"order_id": "id", **{c: c for c in (
    "order_status", "create_time", "create_date", "create_hour", "activity_reduce_amount",
    "coupon_reduce_amount", "original_total_amount", "feight_fee", "total_amount",
    "province_id", "user_id")}}
_FROM_DETAIL = {"detail_id": "id", **{c: c for c in (
    "sku_id", "sku_name", "order_price", "sku_num", "split_activity_amount",
    "split_coupon_amount", "split_total_amount")}}


def merge_order_wide(joined: DataFrame, order: str = "o", detail: str = "d") -> DataFrame:
    """The order-wide record from a join with the two rows as structs ``o`` and ``d``."""
    def source(name: str, kind: DataType) -> Column:
        if name in _FROM_ORDER:
            column = F.col(f"{order}.{_FROM_ORDER[name]}")
        elif name in _FROM_DETAIL:
            column = F.col(f"{detail}.{_FROM_DETAIL[name]}")
        else:
            column = F.lit(None)
        return column.cast(kind).alias(name)

    return joined.select(*[source(f.name, f.dataType) for f in fields_of(schemas.ORDER_WIDE)])


def _timed(df: DataFrame, struct: str, key: str, key_out: str, delay: str | None,
           time_text: str = "create_time") -> DataFrame:
    """Pack rows into one struct with their join key and event time."""
    time = text_to_time(F.col(time_text))
    packed = df.select(F.struct(*df.columns).alias(struct), F.col(key).alias(key_out),
                       time.alias(f"{key_out}_time"))
    return packed.withWatermark(f"{key_out}_time", delay) if delay is not None else packed


def join_order_detail(orders: DataFrame, details: DataFrame,
                      lower: timedelta = timedelta(seconds=-5),
                      upper: timedelta = timedelta(seconds=5),
                      delay: str | None = None, salts: int = 1) -> DataFrame:
    """Order and detail rows of one order created within the bounds of each other, merged.

    ``delay`` is the watermark delay for streams (monotonic sources use ``0 seconds``).
    """
    left = _timed(with_order_times(orders), "o", "id", "ok", delay)
    right = _timed(with_detail_times(details), "d", "order_id", "dk", delay)
    return merge_order_wide(interval_join(
        left, right, "ok", "dk", "ok_time", "dk_time", lower, upper, salts=salts))


def with_dimensions(wide: DataFrame, dims: dict[str, DataFrame], as_of: Column | None = None) -> DataFrame:
    """The six lookups of the order-wide record. ``dims`` is keyed by dimension table name."""
    now = as_of if as_of is not None else F.current_timestamp()
    out = dim_join(wide, dims["dim_user_info"], "user_id", {
        "user_age": age_in_years(F.col("birthday"), now), "user_gender": "gender"})
    out = dim_join(out, dims["dim_base_province"], "province_id", {
        "province_name": "name", "province_area_code": "area_code",
        "province_iso_code": "iso_code", "province_3166_2_code": "iso_3166_2"})
    out = dim_join(out, dims["dim_sku_info"], "sku_id", {
        "sku_name": "sku_name", **sku_links()})
    return with_product_names(out, dims)


def sku_links() -> dict[str, Column]:
    """The ids a stock unit points to, which the next lookups use."""
    return {c: F.col(c).try_cast("bigint") for c in ("category3_id", "spu_id", "tm_id")}


def with_product_names(df: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    out = dim_join(df, dims["dim_spu_info"], "spu_id", {"spu_name": "spu_name"})
    out = dim_join(out, dims["dim_base_trademark"], "tm_id", {"tm_name": "tm_name"})
    return dim_join(out, dims["dim_base_category3"], "category3_id",
                    {"category3_name": "name"})


def merge_payment_wide(joined: DataFrame, payment: str = "p", wide: str = "w") -> DataFrame:
    """The order-wide row with the payment laid over it: on shared names the payment's value
    stands, also when it is null."""
    renamed = {"payment_id": f"{payment}.id", "payment_create_time": f"{payment}.create_time",
               "order_create_time": f"{wide}.create_time"}
    from_payment = {"subject", "payment_type", "callback_time",
                    "order_id", "user_id", "total_amount"}

    def source(name: str) -> str:
        return renamed.get(name) or f"{payment if name in from_payment else wide}.{name}"

    return joined.select(*[F.col(source(n)).alias(n) for n in schemas.PAYMENT_WIDE])


def join_payment_order(payments: DataFrame, wide: DataFrame,
                       lower: timedelta = timedelta(minutes=-15),
                       upper: timedelta = timedelta(seconds=10),
                       delay: str | None = None, salts: int = 1) -> DataFrame:
    """Payments with the order rows created up to 15 min before and 10 s after them."""
    left = _timed(payments, "p", "order_id", "pk", delay)
    right = _timed(wide, "w", "order_id", "wk", delay)
    return merge_payment_wide(interval_join(
        left, right, "pk", "wk", "pk_time", "wk_time", lower, upper, salts=salts))
