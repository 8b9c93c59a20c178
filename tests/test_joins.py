import random
from datetime import timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemill import schemas
from tidemill.operators import joins, orders as od, products, stats
from tidemill.sources.lines import parse_csv_line

ORDER = ("id BIGINT, province_id BIGINT, order_status STRING, user_id BIGINT, "
         "total_amount DECIMAL(16,2), create_time STRING")


def _fill(df, ddl):
    from tidemill.functions.records import fields_of
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None))
                       .cast(f.dataType).alias(f.name) for f in fields_of(ddl)])


def order(spark, rows):
    df = spark.createDataFrame(rows, "id BIGINT, total_amount DECIMAL(16,2), create_time STRING")
    return _fill(df.withColumn("province_id", F.lit(1)).withColumn("user_id", F.lit(2)),
                 schemas.ORDER_INFO)


def detail(spark, rows):
    df = spark.createDataFrame(rows, "id BIGINT, order_id BIGINT, create_time STRING")
    return _fill(df.withColumn("sku_id", F.lit(3)), schemas.ORDER_DETAIL)


def test_order_detail_bounds(spark):
    orders = order(spark, [(1, Decimal(5), "2024-01-01 00:00:10"), (9, Decimal(5), "2024-01-01 00:00:10")])
    details = detail(spark, [(i, 1, f"2024-01-01 00:00:{s:02d}") for i, s in
                             enumerate([4, 5, 10, 15, 16])] + [(7, 2, "2024-01-01 00:00:10")])
    got = od.join_order_detail(orders, details)
    assert sorted(r.detail_id for r in got.collect()) == [1, 2, 3]
    row = got.where("detail_id = 2").first()
    assert (row.order_id, row.create_date, row.create_hour) == (1, "2024-01-01", "00")
    assert row.expire_time is None and row.split_feight_fee is None and row.user_id == 2
    assert len(got.columns) == 35


def test_payment_bounds_and_overlay(spark):
    payment = _fill(spark.createDataFrame(
        [(70, 1, None, "2024-01-01 01:00:00")],
        "id BIGINT, order_id BIGINT, total_amount DECIMAL(16,2), create_time STRING"),
        schemas.PAYMENT_INFO)
    wide = _fill(spark.createDataFrame(
        [(i, 1, Decimal(8), 4, t) for i, t in enumerate([
            "2024-01-01 00:44:59", "2024-01-01 00:45:00", "2024-01-01 01:00:10",
            "2024-01-01 01:00:11"])],
        "detail_id BIGINT, order_id BIGINT, total_amount DECIMAL(16,2), user_id BIGINT, create_time STRING"),
        schemas.ORDER_WIDE)
    got = od.join_payment_order(payment, wide).orderBy("detail_id").collect()
    assert [r.detail_id for r in got] == [1, 2]
    assert got[0].total_amount is None and got[0].user_id is None
    assert got[0].payment_id == 70 and got[0].payment_create_time == "2024-01-01 01:00:00"
    assert got[0].order_create_time == "2024-01-01 00:45:00"
    assert len(got[0]) == 35


def test_csv_demo(spark):
    left = parse_csv_line(spark.createDataFrame([("1001,zhang,1",), ("1002,li,10",)], "value STRING"), "name")
    right = parse_csv_line(spark.createDataFrame(
        [("1001,male,1",), ("1001,female,2",), ("1001,male,3",), ("1002,female,10",),
         ("1001,male,11",)], "value STRING"), "sex")
    right = right.toDF("right_id", "sex", "right_ts", "right_time")

    def pairs(**bounds):
        got = joins.interval_join(left, right, "id", "right_id", "time", "right_time",
                                  timedelta(seconds=-5), timedelta(seconds=5), **bounds)
        return sorted((r.id, r.right_ts) for r in got.collect())

    assert pairs() == [("1001", 1), ("1001", 2), ("1001", 3), ("1002", 10)]
    assert pairs(salts=3) == pairs()


@pytest.mark.parametrize("low, high", [(-5, 5), (-7, 3), (0, 4), (2, 6), (-6, -2), (0, 0)])
def test_interval_join_against_brute_force_with_a_hot_key(spark, low, high):
    rng = random.Random(low * 100 + high)
    left = [(i, 1 if rng.random() < 0.4 else rng.randrange(9), rng.randrange(100)) for i in range(150)]
    right = [(i, 1 if rng.random() < 0.4 else rng.randrange(9), rng.randrange(100)) for i in range(300)]
    lf = spark.createDataFrame(left, "l INT, lk INT, ls BIGINT").withColumn("lt", F.timestamp_seconds("ls"))
    rf = spark.createDataFrame(right, "r INT, rk INT, rs BIGINT").withColumn("rt", F.timestamp_seconds("rs"))
    for lo, hi, salts in [(True, True, 1), (False, False, 1), (True, False, 4)]:
        want = sorted((a, b) for a, ka, ta in left for b, kb, tb in right if ka == kb
                      and (low <= tb - ta if lo else low < tb - ta)
                      and (tb - ta <= high if hi else tb - ta < high))
        got = joins.interval_join(lf, rf, "lk", "rk", "lt", "rt", timedelta(seconds=low),
                                  timedelta(seconds=high), lo, hi, salts)
        assert sorted((r.l, r.r) for r in got.collect()) == want


def dims(spark):
    def table(rows, ddl):
        return spark.createDataFrame(rows, ddl)
    return {
        "dim_user_info": table([("2", "1990-01-01", "F"), ("3", None, "M")], "id STRING, birthday STRING, gender STRING"),
        "dim_base_province": table([("1", "p", "a", "i", "x")],
                                   "id STRING, name STRING, area_code STRING, iso_code STRING, iso_3166_2 STRING"),
        "dim_sku_info": table([("3", "sku", "9.90", "5", "404", "6")],
                              "id STRING, sku_name STRING, price STRING, category3_id STRING, spu_id STRING, tm_id STRING"),
        "dim_spu_info": table([("4", "spu")], "id STRING, spu_name STRING"),
        "dim_base_trademark": table([("6", "tm")], "id STRING, tm_name STRING"),
        "dim_base_category3": table([("5", "c3")], "id STRING, name STRING"),
    }


def test_order_dimensions_keep_rows_without_match(spark):
    wide = od.join_order_detail(order(spark, [(1, Decimal(5), "2024-01-01 00:00:10")]),
                                detail(spark, [(8, 1, "2024-01-01 00:00:10")]))
    as_of = F.lit("2024-01-01").cast("timestamp")
    row = od.with_dimensions(wide, dims(spark), as_of).first()
    assert (row.user_age, row.user_gender, row.province_name) == (34, "F", "p")
    assert (row.sku_name, row.spu_id, row.spu_name) == ("sku", 404, None)
    assert (row.tm_name, row.category3_name) == ("tm", "c3")
    assert len(row) == 35


@pytest.mark.parametrize("max_bytes, salts", [(1000, 16), (0, 1), (0, 5)])
def test_repeated_and_missing_dimension_keys(spark, max_bytes, salts):
    rows = spark.createDataFrame([(i, k) for i, k in enumerate([1, 1, 2, None, 3])], "i INT, k INT")
    dim = spark.createDataFrame([("1", "a"), ("1", "b"), (None, "n"), ("2", None)], "id STRING, v STRING")
    got = joins.dim_join(rows, dim, "k", {"v": "v"}, max_broadcast_bytes=max_bytes, salts=salts)
    assert sorted((r.i, r.v) for r in got.collect()) == [
        (0, "b"), (1, "b"), (2, None), (3, None), (4, None)]


def test_large_dimension_is_not_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        rows = spark.range(10).withColumnRenamed("id", "k")
        dim = spark.range(10).select(F.col("id").cast("string").alias("id"), F.lit("x").alias("v"))
        got = joins.dim_join(rows, dim, "k", {"v": "v"}, max_broadcast_bytes=5)
        assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
        assert got.where("v = 'x'").count() == 10
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_small_is_a_matter_of_bytes(spark):
    one = spark.createDataFrame([("x" * 1000,)], "v STRING")
    assert not joins.is_small(one, 1000) and joins.is_small(spark.range(10), 1000)
    assert joins.is_small(one.limit(0), 0)


def test_salts_spread_a_hot_key_of_one_partition(spark):
    rows = spark.range(1000).coalesce(1)
    assert rows.select(joins.row_salt(rows, 16).alias("s")).distinct().count() == 16


def test_salts_of_rows_do_not_depend_on_their_order(spark):
    """Also with a map among the columns; a task that runs again must not deal rows anew."""
    rows = spark.range(500).select("id", F.create_map(F.lit("k"), F.col("id").cast("string")).alias("m"))

    def salts(df):
        return {r.id: r.s for r in df.withColumn("s", joins.row_salt(rows, 16)).collect()}
    assert salts(rows) == salts(rows.repartition(7)) == salts(rows.orderBy(F.desc("id")))


def test_product_stats_counts_distinct_orders(spark):
    rows = [(1, "order", 10, 2, "5.50", 1000), (1, "order", 10, 1, "4.50", 2000),
            (1, "order", 11, 1, None, 9999), (1, "paid", 10, 0, "0", 3000),
            (1, None, None, 0, "0", 10_000)]
    df = spark.createDataFrame(rows, "sku_id BIGINT, order_kind STRING, order_ref BIGINT, n BIGINT, a STRING, ts BIGINT")
    df = products._measures(df, F.col("sku_id"), F.col("ts"), None, F.col("order_ref"),
                            order_sku_num=F.col("n"), order_amount=F.col("a").cast("decimal(16,2)"),
                            click_ct=F.when(F.col("order_kind").isNull(), 1).otherwise(0)) \
        .drop("order_kind").join(df.select("ts", "order_kind"), "ts")
    got = stats.product_stats(df).orderBy("stt").collect()
    first, second = got
    assert (first.order_ct, first.paid_order_ct, first.refund_order_ct) == (2, 1, 0)
    assert (first.order_amount, first.order_sku_num, first.ts) == (Decimal("10.00"), 4, 1000)
    assert (first.stt, first.edt) == ("1970-01-01 00:00:00", "1970-01-01 00:00:10")
    assert (second.click_ct, second.order_ct, second.order_amount) == (1, 0, Decimal("0.00"))


def test_comment_and_payment_rows(spark):
    comments = spark.createDataFrame([(1, "1201", "2024-01-01 00:00:00"), (1, "1203", "2024-01-01 00:00:00"),
                                      (1, None, "2024-01-01 00:00:00")], schemas.COMMENT)
    got = products.product_comment(comments).agg(F.sum("comment_ct"), F.sum("good_comment_ct")).first()
    assert tuple(got) == (3, 1)


def test_province_stats_batch_equals_sql(spark):
    rows = _fill(spark.createDataFrame(
        [(1, 7, Decimal("1.10"), "2024-01-01 00:00:01"), (1, 7, Decimal("2.20"), "2024-01-01 00:00:09"),
         (1, 8, Decimal("3.00"), "2024-01-01 00:00:09"), (1, 8, Decimal("4.00"), "2024-01-01 00:00:10")],
        "province_id BIGINT, order_id BIGINT, split_total_amount DECIMAL(16,2), create_time STRING"),
        schemas.ORDER_WIDE)
    got = stats.province_stats(rows).drop("ts").orderBy("stt")
    assert [(r.order_count, r.order_amount) for r in got.collect()] == [
        (2, Decimal("6.30")), (1, Decimal("4.00"))]
    rows.withColumn("row_time", F.col("create_time").cast("timestamp")).createOrReplaceTempView("wide_rows")
    sql = stats.province_stats_sql(spark, "wide_rows").drop("ts").orderBy("stt")
    assert sql.collect() == got.select(*sql.columns).collect()


def test_dim_join_large_dimension_is_not_broadcast(spark, folder):
    """A dimension measured too large goes by shuffle, whatever the planner guesses of it
    from its compressed file."""
    rows = spark.createDataFrame([(1, 1), (2, 5), (3, None)], "id BIGINT, sku_id BIGINT")
    spark.createDataFrame([("1", "a"), ("5", "b")], "id STRING, name STRING").write.parquet(
        f"{folder}/dim")
    dim = spark.read.parquet(f"{folder}/dim")
    got = joins.dim_join(rows, dim, "sku_id", {"name": "name"}, max_broadcast_bytes=0)
    assert sorted((r.id, r.name) for r in got.collect()) == [(1, "a"), (2, "b"), (3, None)]
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()
