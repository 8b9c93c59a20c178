from pyspark.sql import functions as F

from tidemill.functions import names, times, words
from tidemill.functions.records import json_columns


def test_words_of_mixed_text(spark):
    df = spark.createDataFrame([(1, "iphone11和ipad123123评估苹果手机"), (2, ""), (3, "a-b c")],
                               "id INT, q STRING")
    got = words.split_words(df, "q").orderBy("id").select("id", "word").collect()
    assert [(r.id, r.word) for r in got if r.id == 1] == [
        (1, "iphone11"), (1, "和"), (1, "ipad123123"), (1, "评估苹果手机")]
    assert [r.word for r in got if r.id == 3] == ["a", "b", "c"]
    assert not [r for r in got if r.id == 2]


def test_words_in_sql_equal_the_function(spark):
    words.register_split_words(spark)
    spark.createDataFrame([("x1 和y",), (None,)], "q STRING").createOrReplaceTempView("searched")
    got = spark.sql("SELECT word FROM searched s, LATERAL split_words(s.q)").collect()
    assert [r.word for r in got] == ["x1", "和", "y"]


def test_own_tokenizer(spark):
    df = spark.createDataFrame([("a|b",)], "q STRING")
    got = words.split_words(df, "q", tokenizer=lambda c: F.split(c, r"\|"))
    assert [r.word for r in got.collect()] == ["a", "b"]


def test_times_follow_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
        row = spark.range(1).select(
            times.text_to_millis(F.lit("2020-12-18 10:37:33")).alias("full"),
            times.text_to_millis(F.lit("2020-12-18")).alias("day"),
            times.text_to_millis(F.lit("no time")).alias("bad"),
            times.second_text(times.millis_to_time(F.lit(1608259053000))).alias("text"),
            times.day_text(times.millis_to_time(F.lit(1608259053000))).alias("date")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert row.full == 1608259053000 and row.day == 1608220800000 and row.bad is None
    assert (row.text, row.date) == ("2020-12-18 10:37:33", "2020-12-18")


def test_age_counts_years_of_365_days(spark):
    as_of = F.lit("2001-01-01 00:00:00").cast("timestamp")
    rows = spark.createDataFrame(
        [("2000-01-02 00:00:00",), ("2000-01-02",), ("2000-01-03",), (None,)], "b STRING")
    got = [r[0] for r in rows.select(times.age_in_years(F.col("b"), as_of)).collect()]
    assert got == [1, 1, 0, None]


def test_camel_names(spark):
    df = spark.createDataFrame([(1, 2)], "aa_dd INT, ID INT")
    assert names.snake_to_camel(df).columns == ["aaDd", "id"]
    assert names.snake_to_camel(df, enabled=False).columns == ["aa_dd", "ID"]


def test_json_columns_take_text_and_numbers(spark):
    df = spark.createDataFrame([('{"id":"7","m":"10.50"}',), ('{"id":7,"m":10.5}',),
                                ('{"id":"x"}',), ("broken",)], "value STRING")
    got = json_columns(df, "id BIGINT, m DECIMAL(16,2)").collect()
    assert [(r.id, str(r.m)) for r in got] == [(7, "10.50"), (7, "10.50"), (None, "None"),
                                               (None, "None")]
