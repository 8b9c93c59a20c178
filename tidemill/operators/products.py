"""Product measures: seven inputs in one row shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemill import codes
from tidemill.functions.times import text_to_millis
from tidemill.operators.logs import explode_display

COUNTS = ["display_ct", "click_ct", "favor_ct", "cart_ct", "order_sku_num",
          "comment_ct", "good_comment_ct"]
AMOUNTS = ["order_amount", "payment_amount", "refund_amount"]
ORDER, PAID, REFUND = "order", "paid", "refund"


def _measures(df: DataFrame, sku: Column, ts: Column, kind: str | None = None,
              order_id: Column | None = None, **measures: Column) -> DataFrame:
    """Rows of the common shape. ``order_kind`` and ``order_ref`` say which orders to count."""
    return df.select(
        sku.cast("bigint").alias("sku_id"),
        *[measures.get(c, F.lit(0)).cast("bigint").alias(c) for c in COUNTS],
        *[F.coalesce(measures.get(c, F.lit(0)), F.lit(0)).cast("decimal(16,2)").alias(c)
          for c in AMOUNTS],
        F.lit(kind).cast("string").alias("order_kind"),
        (order_id if order_id is not None else F.lit(None)).cast("bigint").alias("order_ref"),
        ts.alias("ts"),
    )


def product_click(pages: DataFrame) -> DataFrame:
    hits = pages.where((F.col("page.page_id") == codes.PAGE_DETAIL)
                       & (F.col("page.item_type") == codes.ITEM_SKU))
    return _measures(hits, F.col("page.item").try_cast("bigint"), F.col("ts"),
                     click_ct=F.lit(1))


def product_display(pages: DataFrame) -> DataFrame:
    shown = (
        pages.select("ts", F.explode("displays").alias("d"))
        .where(F.col("d.item_type") == codes.ITEM_SKU)
    )
    return _measures(shown, F.col("d.item").try_cast("bigint"), F.col("ts"),
                     display_ct=F.lit(1))


def product_page(pages: DataFrame) -> DataFrame:
    """Clicks and displays of page logs in one pass over them."""
    def item(sku: Column, click: int) -> Column:
        return F.struct(sku.try_cast("bigint").alias("sku"), F.lit(click).alias("click"))

    click = F.when((F.col("page.page_id") == codes.PAGE_DETAIL)
                   & (F.col("page.item_type") == codes.ITEM_SKU),
                   F.array(item(F.col("page.item"), 1)))
    shown = F.transform(F.filter("displays", lambda d: d["item_type"] == codes.ITEM_SKU),
                        lambda d: item(d["item"], 0))
    none = F.array().cast("array<struct<sku: bigint, click: int>>")
    items = pages.select("ts", F.explode(F.concat(
        F.coalesce(click, none), F.coalesce(shown, none))).alias("i"))
    return _measures(items, F.col("i.sku"), F.col("ts"), click_ct=F.col("i.click"),
                     display_ct=1 - F.col("i.click"))


def product_favor(favors: DataFrame) -> DataFrame:
    return _measures(favors, F.col("sku_id"), text_to_millis(F.col("create_time")),
                     favor_ct=F.lit(1))


def product_cart(carts: DataFrame) -> DataFrame:
    return _measures(carts, F.col("sku_id"), text_to_millis(F.col("create_time")),
                     cart_ct=F.lit(1))


def product_order(wide: DataFrame) -> DataFrame:
    """Ordered units and the unit price of each order line (not multiplied)."""
    return _measures(wide, F.col("sku_id"), text_to_millis(F.col("create_time")), ORDER,
                     F.col("order_id"), order_sku_num=F.col("sku_num"),
                     order_amount=F.col("order_price"))


def product_payment(payments: DataFrame) -> DataFrame:
    return _measures(payments, F.col("sku_id"), text_to_millis(F.col("payment_create_time")),
                     PAID, F.col("order_id"), payment_amount=F.col("order_price"))


def product_refund(refunds: DataFrame) -> DataFrame:
    return _measures(refunds, F.col("sku_id"), text_to_millis(F.col("create_time")), REFUND,
                     F.col("order_id"), refund_amount=F.col("refund_amount"))


def product_comment(comments: DataFrame) -> DataFrame:
    good = F.when(F.col("appraise") == codes.APPRAISE_GOOD, 1).otherwise(0)
    return _measures(comments, F.col("sku_id"), text_to_millis(F.col("create_time")),
                     comment_ct=F.lit(1), good_comment_ct=good)


def union_product(pages: DataFrame, favors: DataFrame, carts: DataFrame, orders: DataFrame,
                  payments: DataFrame, refunds: DataFrame, comments: DataFrame) -> DataFrame:
    """All seven inputs as measure rows, duplicates kept."""
    parts = [product_page(pages), product_favor(favors), product_cart(carts),
             product_order(orders), product_payment(payments), product_refund(refunds),
             product_comment(comments)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
