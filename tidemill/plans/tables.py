"""The given tables in the shapes the operators take: logs, changes, facts and dimensions.

Every frame here is derived row by row from a whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import TimestampNTZType

from tidemill import schemas
from tidemill.functions.records import fields_of
from tidemill.functions.times import second_text


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return _zoned(spark.read.parquet(f"{folder}/{name}.parquet"))


def table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table's file as a stream."""
    raw = spark.read.parquet(f"{folder}/{name}.parquet").schema
    return _zoned(spark.readStream.schema(raw).option("pathGlobFilter", f"{name}.parquet")
                  .parquet(folder))


def _zoned(df: DataFrame) -> DataFrame:
    """Timestamps without zone become timestamps of the session's zone."""
    return df.select(*[F.col(f.name).cast("timestamp").alias(f.name)
                       if isinstance(f.dataType, TimestampNTZType) else F.col(f.name)
                       for f in df.schema.fields])


def _money(column: str) -> Column:
    return F.col(column).cast("decimal(16,2)")


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _k() -> Column:
    return F.get_json_object("props", "$.k")


def is_type(*names: str) -> Column:
    return F.col("event_type").isin(*names)


def logs(events: DataFrame) -> DataFrame:
    """Parsed log records of events, with ``event_id`` as the place in the source.

    Sign-ups are start logs, the others page logs. Views and errors enter a session (without
    and with an empty last page); sign-ups and views are flagged new.
    """
    k = _k()
    common = F.struct(
        k.alias("ar"), F.lit("brand").alias("ba"), F.col("event_type").alias("ch"),
        F.when(is_type("signup", "view"), "1").otherwise("0").alias("is_new"),
        F.lit("model").alias("md"),
        F.concat(F.lit("mid_"), _text("user_id")).alias("mid"), F.lit("os").alias("os"),
        _text("user_id").alias("uid"), F.lit("v1").alias("vc"))
    start = F.when(is_type("signup"), F.struct(
        F.lit("icon").alias("entry"), k.cast("bigint").alias("loading_time"),
        k.cast("bigint").alias("open_ad_id"), F.lit(0).cast("bigint").alias("open_ad_ms"),
        F.lit(0).cast("bigint").alias("open_ad_skip_ms")))
    page = F.when(~is_type("signup"), F.struct(
        F.floor("value").cast("bigint").alias("during_time"),
        F.when(is_type("click"), k)
        .when(is_type("purchase"), F.concat_ws(",", k, _text("user_id"))).alias("item"),
        F.when(is_type("click"), "sku_id").when(is_type("purchase"), "sku_ids")
        .alias("item_type"),
        F.when(is_type("click"), "search").when(is_type("purchase"), "cart")
        .when(is_type("error"), "").alias("last_page_id"),
        F.when(is_type("click"), "good_detail").when(is_type("purchase"), "trade")
        .otherwise("home").alias("page_id")))

    def display(kind: str, item: Column, item_type: str, place: int) -> Column:
        return F.struct(
            F.lit(kind).alias("display_type"), item.alias("item"),
            F.lit(item_type).alias("item_type"),
            F.lit(place).cast("bigint").alias("order"),
            F.lit(place).cast("bigint").alias("pos_id"))

    displays = F.when(is_type("view"), F.array(
        display("query", k, "sku_id", 1),
        display("activity", _text("user_id"), "activity_id", 2),
        display("promotion", _text("user_id"), "sku_id", 3)))
    return events.select("event_id", common.alias("common"), start.alias("start"),
                         page.alias("page"), displays.alias("displays"),
                         F.unix_millis("ts").alias("ts"))


def page_logs(events: DataFrame) -> DataFrame:
    return logs(events.where(~is_type("signup")))


def log_lines(events: DataFrame) -> DataFrame:
    """The log records as JSON text; error events are broken lines."""
    fields = ["common", "start", "page", "displays", "ts"]
    error = F.col("common.ch") == "error"
    whole = F.to_json(F.struct(*fields))
    return logs(events).select(
        "event_id", F.when(error, F.concat(F.lit("error "), whole)).otherwise(whole)
        .alias("value"))


_OP = {"signup": "c", "view": "r", "click": "u", "purchase": "u", "error": "d"}


def changes(events: DataFrame) -> DataFrame:
    """Events as changes of a table keyed by user, in the database ``shop``."""
    op = F.coalesce(*[F.when(is_type(t), c) for t, c in _OP.items()])
    image = F.create_map(F.lit("user_id"), _text("user_id"), F.lit("k"), _k(),
                         F.lit("event_id"), _text("event_id"))
    before = F.when(op.isin("u", "d"), F.create_map(
        F.lit("user_id"), _text("user_id"), F.lit("k"), F.lit(None).cast("string")))
    return events.select(
        "event_id", op.alias("op"),
        F.struct(F.lit("shop").alias("db"), F.col("event_type").alias("table")).alias("source"),
        before.alias("before"), F.when(op != "d", image).alias("after"),
        F.unix_millis("ts").alias("ts_ms"))


def change_lines(events: DataFrame) -> DataFrame:
    fields = ["op", "source", "before", "after", "ts_ms"]
    return changes(events).select("event_id", F.to_json(F.struct(*fields)).alias("value"))


RULES = [
    ("signup", "c", "kafka", "dwd_signup", "user_id,k", "user_id", None),
    ("click", "u", "kafka", "dwd_click", "user_id,event_id", "user_id", None),
    ("view", "r", "hbase", "dim_user", "user_id,k", "user_id", None),
    ("purchase", "u", "hbase", "dim_user", "user_id,event_id", "user_id", None),
    ("error", "d", "kafka", "dwd_error", "user_id", "user_id", None),
]


def rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(RULES, schemas.RULE)


def order_info(orders: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("decimal(16,2)")
    return orders.select(
        F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 25).alias("province_id"),
        F.col("o_orderstatus").alias("order_status"), F.col("o_custkey").alias("user_id"),
        _money("o_totalprice").alias("total_amount"), zero.alias("activity_reduce_amount"),
        zero.alias("coupon_reduce_amount"), _money("o_totalprice").alias("original_total_amount"),
        zero.alias("feight_fee"), F.lit(None).cast("string").alias("expire_time"),
        second_text(F.col("o_orderdate")).alias("create_time"),
        F.lit(None).cast("string").alias("operate_time"))


def order_detail(lineitem: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("decimal(16,2)")
    return lineitem.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("bigint").alias("id"),
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("sku_id"),
        _money("l_extendedprice").alias("order_price"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        F.lit(None).cast("string").alias("sku_name"),
        second_text(F.col("l_shipdate")).alias("create_time"),
        _money("l_extendedprice").alias("split_total_amount"),
        zero.alias("split_activity_amount"), zero.alias("split_coupon_amount"))


def payment_info(orders: DataFrame) -> DataFrame:
    """One payment per order at the order's time; its total is the order's without cents."""
    return orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.floor("o_totalprice").cast("decimal(16,2)").alias("total_amount"),
        F.col("o_orderpriority").alias("subject"), F.lit("1101").alias("payment_type"),
        second_text(F.col("o_orderdate")).alias("create_time"),
        F.lit(None).cast("string").alias("callback_time"))


def line_order_wide(lineitem: DataFrame) -> DataFrame:
    """Every line as an order-wide record at its ship date, without the order's own columns."""
    details = order_detail(lineitem)
    have = {c: F.col(c) for c in details.columns if c != "id"} | {"detail_id": F.col("id")}
    return details.select(*[have.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                            for f in fields_of(schemas.ORDER_WIDE)])


def dimensions(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The six dimension tables, all text. Many keys of products have no spu, brand or
    category row on purpose."""
    customer, nation = table(spark, folder, "customer"), table(spark, folder, "nation")
    part, supplier = table(spark, folder, "part"), table(spark, folder, "supplier")
    region = table(spark, folder, "region")
    birthday = F.date_format(
        F.date_add(F.lit("1950-01-01").cast("date"), (F.col("c_custkey") % 20000).cast("int")),
        "yyyy-MM-dd")
    return {
        "dim_user_info": customer.select(
            _text("c_custkey").alias("id"), birthday.alias("birthday"),
            F.when(F.col("c_acctbal") < 0, "M").otherwise("F").alias("gender")),
        "dim_base_province": nation.select(
            _text("n_nationkey").alias("id"), F.col("n_name").alias("name"),
            _text("n_regionkey").alias("area_code"),
            F.concat(F.lit("CN-"), _text("n_nationkey")).alias("iso_code"),
            F.concat(F.lit("ISO-"), _text("n_nationkey")).alias("iso_3166_2")),
        "dim_sku_info": part.select(
            _text("p_partkey").alias("id"), F.col("p_name").alias("sku_name"),
            _money("p_retailprice").cast("string").alias("price"),
            _text("p_size").alias("category3_id"),
            (F.col("p_partkey") % 150).cast("string").alias("spu_id"),
            F.regexp_extract("p_brand", "([0-9]+)", 1).alias("tm_id")),
        "dim_spu_info": supplier.select(
            _text("s_suppkey").alias("id"), F.col("s_name").alias("spu_name")),
        "dim_base_trademark": nation.select(
            _text("n_nationkey").alias("id"), F.col("n_name").alias("tm_name")),
        "dim_base_category3": region.select(
            _text("r_regionkey").alias("id"), F.col("r_name").alias("name")),
    }


def search_lines(documents: DataFrame) -> DataFrame:
    """Documents as page views of search results, one per second, the whole text as query."""
    page = F.create_map(F.lit("last_page_id"), F.lit("search"), F.lit("item"), F.col("text"))
    common = F.create_map(F.lit("mid"), F.col("source"))
    return documents.select(F.to_json(F.struct(
        common.alias("common"), page.alias("page"),
        (F.col("doc_id") * 1000).alias("ts"))).alias("value"))
