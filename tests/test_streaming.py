import json
import random
from collections import Counter
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from samples import display, page, pages, split_evenly, stream_of
from tidemill.operators import joins, logs as lg, products, stats, visits
from tidemill.plans import deploy, jobs, queries
from tidemill.session import work_folder
from tidemill.sinks import committed, dimensions
from tidemill.sources.topics import Topics, read_topic
from tidemill.streaming import lookups, run, state

BASE = 1_699_920_000_000  # 2023-11-14; a stream's first watermark is 1970-01-01
LATE = page("sentinel", BASE + 10_000_000_000, place=10_000)


def random_logs(seed, n=240):
    """Rows of a few devices, one of them with a third of all, in time order."""
    rng = random.Random(seed)
    times = sorted(rng.randrange(0, 4 * 86_400_000, 2_500) for _ in range(n))
    dense = sorted(rng.randrange(0, 400_000, 1_000) for _ in range(n))
    rows = [page("hot" if rng.random() < 0.33 else f"d{rng.randrange(6)}", BASE + ts,
                 rng.choice([None, "", "home"]), place=i, is_new=rng.choice("01"),
                 displays=[display(str(rng.randrange(3)))])
            for i, ts in enumerate(sorted(times + dense))]
    return rows


def micro_batches(spark, folder, rows, n):
    return stream_of(spark, pages(spark, rows[:1]).schema, folder, [*split_evenly(rows, n), [LATE]])


@pytest.mark.parametrize("n", [1, 2, 5])
def test_repair_stream_equals_batch(spark, folder, n):
    rows = random_logs(n)
    got = run.drain(state.repair_is_new_stream(micro_batches(spark, folder, rows, n), "place"), "t")
    want = visits.repair_is_new(pages(spark, [*rows, LATE]), ["place"])
    assert sorted((r.place, r.common.is_new, r.ts) for r in got.collect()) == sorted(
        (r.place, r.common.is_new, r.ts) for r in want.collect())


@pytest.mark.parametrize("n", [1, 2, 5])
def test_jump_stream_equals_batch(spark, folder, n):
    rows = random_logs(n + 10)
    got = run.drain(state.user_jump_stream(micro_batches(spark, folder, rows, n), "place"), "t")
    want = visits.user_jump(pages(spark, [*rows, LATE]), ["place"]).where("place < 10000")
    assert sorted(r.place for r in got.collect()) == sorted(r.place for r in want.collect())
    assert got.where("displays IS NULL OR page IS NULL").count() == 0


@pytest.mark.parametrize("n", [1, 2, 5])
def test_visit_stream_equals_batch(spark, folder, n):
    rows = random_logs(n + 20)
    got = run.drain(state.unique_visit_stream(micro_batches(spark, folder, rows, n), "place"), "t")
    want = visits.unique_visit(pages(spark, [*rows, LATE]), ["place"])
    assert sorted(r.place for r in got.where("place < 10000").collect()) == sorted(
        r.place for r in want.where("place < 10000").collect())


def test_jump_stream_started_again_with_other_settings(spark, folder):
    """State keys do not depend on the session, so waiting rows are found after a restart."""
    rows = random_logs(31)
    parts = [*split_evenly(rows, 4), [LATE]]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for i, part in enumerate(parts):
            spark.conf.set("spark.sql.shuffle.partitions", str((4, 2, 7, 3, 5)[i]))
            pages(spark, part).coalesce(1).write.mode("append").parquet(f"{folder}/in")
            source = spark.readStream.schema(pages(spark, part).schema).parquet(f"{folder}/in")
            run.start_to_files(state.user_jump_stream(source, "place"), f"{folder}/out",
                               f"{folder}/checkpoint").awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = visits.user_jump(pages(spark, [*rows, LATE]), ["place"]).where("place < 10000")
    assert sorted(r.place for r in spark.read.parquet(f"{folder}/out").collect()) == sorted(
        r.place for r in want.collect())


def _progress(df, folder):
    query = run.start_to_files(df, f"{folder}-out", f"{folder}-checkpoint")
    query.awaitTermination()
    return query.recentProgress


def test_visit_state_leaves_after_its_day(spark, folder):
    rows = random_logs(1)
    progress = _progress(state.unique_visit_stream(micro_batches(spark, folder, rows, 4), "place"), folder)
    assert sum(o["numRowsRemoved"] for p in progress for o in p["stateOperators"]) > 0


@pytest.mark.parametrize("n", [2, 5])
def test_product_stats_stream_equals_batch(spark, folder, n):
    rng = random.Random(n)
    ddl = "order_id BIGINT, sku_id BIGINT, sku_num BIGINT, order_price DECIMAL(16,2), create_time STRING"
    rows = [(rng.randrange(12), 1 if rng.random() < 0.4 else rng.randrange(5), rng.randrange(3),
             None, f"2024-01-01 00:{i // 10:02d}:{i % 10 * 6:02d}") for i in range(300)]
    late = (99, 99, 0, None, "2025-01-01 00:00:00")
    df = spark.createDataFrame(rows, ddl)
    stream = stream_of(spark, df.schema, folder, [*split_evenly(rows, n), [late]])
    got = run.drain(stats.product_stats(products.product_order(stream)), "t")
    want = stats.product_stats(products.product_order(df))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_visitor_stats_stream_equals_batch(spark, folder):
    rows = random_logs(3)
    got = run.drain(stats.visitor_stats(lg.visitor_pv(micro_batches(spark, folder, rows, 3))), "t")
    want = stats.visitor_stats(lg.visitor_pv(pages(spark, rows)))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("n", [1, 4])
def test_interval_join_stream_equals_batch_and_forgets(spark, folder, n):
    rng = random.Random(n)
    def rows(count):
        return sorted(((rng.choice([1, 1, 2, 3]), 1_000 + rng.randrange(600)) for _ in range(count)), key=lambda r: r[1])
    left, right = rows(120), rows(200)

    def sides(lf, rf):
        return (lf.toDF("lk", "ls").withColumn("lt", F.timestamp_seconds("ls")),
                rf.toDF("rk", "rs").withColumn("rt", F.timestamp_seconds("rs")))

    def join(lf, rf):
        return joins.interval_join(lf, rf, "lk", "rk", "lt", "rt", timedelta(seconds=-5),
                                   timedelta(seconds=5)).select("lk", "ls", "rs")

    ddl = spark.createDataFrame(left, "k INT, s BIGINT").schema
    end = [(9, 100_000)]
    lf, rf = sides(stream_of(spark, ddl, f"{folder}/l", [*split_evenly(left, n), end, end]),
                   stream_of(spark, ddl, f"{folder}/r", [*split_evenly(right, n), end, end]))
    joined = join(lf.withWatermark("lt", "0 seconds"), rf.withWatermark("rt", "0 seconds"))
    progress = _progress(joined, folder)
    got = spark.read.parquet(f"{folder}-out").where("lk < 9")
    want = join(*sides(spark.createDataFrame(left, ddl), spark.createDataFrame(right, ddl)))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert sum(o["numRowsRemoved"] for p in progress for o in p["stateOperators"]) > 0


@pytest.mark.parametrize("which", ["repair", "jump"])
def test_restart_neither_loses_nor_repeats(spark, folder, which):
    rows = random_logs(7)
    schema = pages(spark, rows[:1]).schema
    parts = [*split_evenly(rows, 3), [LATE]]
    for part in parts:
        stream = stream_of(spark, schema, f"{folder}/in", [part])
        df = (state.repair_is_new_stream(stream, "place") if which == "repair"
              else state.user_jump_stream(stream, "place"))
        run.start_to_files(df, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    got = spark.read.parquet(f"{folder}/out")
    all_rows = pages(spark, [*rows, LATE])
    if which == "repair":
        want = visits.repair_is_new(all_rows, ["place"])
        pick = lambda df: sorted((r.place, r.common.is_new) for r in df.collect())
    else:
        want = visits.user_jump(all_rows, ["place"]).where("place < 10000")
        pick = lambda df: sorted(r.place for r in df.collect())
    assert pick(got) == pick(want)


def test_side_outputs_repeat_safely(spark, folder):
    df = pages(spark, [page("a", 1), page("b", 2)])
    write = run.side_outputs(lambda b: {"x": b, "y": b.where("ts = 2")}, folder)
    for _ in range(2):
        write(df, 0)
    write(df, 1)
    assert spark.read.parquet(f"{folder}/x").count() == 4
    assert spark.read.parquet(f"{folder}/y").count() == 2


def test_own_settings_are_left_as_they_were(spark):
    keys = ["spark.sql.streaming.stateStore.providerClass", "spark.sql.shuffle.partitions"]
    before = [spark.conf.get(k) for k in keys]
    with run.stream_settings(spark):
        assert "RocksDB" in spark.conf.get(keys[0])
    assert [spark.conf.get(k) for k in keys] == before


def _lines(spark, path, lines):
    spark.createDataFrame([(line,) for line in lines], "value STRING").coalesce(1).write.mode("append").text(path)


def test_log_jobs_end_to_end(spark, folder):
    rows = [*{r["ts"]: r for r in random_logs(5, 60)}.values(), LATE]
    body = F.to_json(F.struct("common", "page", "displays", "ts"))
    topics = Topics(folder=f"{folder}/topics")
    pages(spark, rows).select(body).write.text(topics.path("ods_base_log"))
    _lines(spark, topics.path("ods_base_log"), ["broken"])
    at = deploy.Place(spark, topics, f"{folder}/state", once=True)
    for job in ("base_log", "unique_visit", "user_jump", "visitor_stats", "keyword_stats"):
        deploy.JOBS[job](at).awaitTermination()
    repaired = visits.repair_is_new(pages(spark, rows), ["place"])
    want = jobs.job_visitor_stats(visits.unique_visit(repaired, ["place"]),
                                  visits.user_jump(repaired, ["place"]), repaired)
    sums = [F.sum(c) for c in ("uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum")]
    got = spark.read.parquet(f"{folder}/state/reports/visitor_stats")
    last = got.agg(F.max("edt")).first()[0]  # bounces are the slowest input: windows close by them
    assert got.where("uj_ct > 0").count() > 5
    assert tuple(got.agg(*sums).first()) == tuple(want.where(F.col("edt") <= last).agg(*sums).first())


@pytest.mark.parametrize("order", [("visitor_stats", "user_jump"), ("user_jump", "visitor_stats")])
def test_visitor_job_counts_bounces_published_late(spark, folder, order):
    """Three rounds; bounces reach their topic before or after the visitor job has run."""
    rows = [*{r["ts"]: r for r in random_logs(7, 60)}.values(), LATE]
    body = F.to_json(F.struct("common", "page", "displays", "ts"))
    topics = Topics(folder=f"{folder}/topics")
    at = deploy.Place(spark, topics, f"{folder}/state", once=True)
    for i, part in enumerate([*split_evenly(rows[:-1], 3), rows[-1:], []]):
        if part:
            pages(spark, part).select(body).write.mode("append").text(topics.path("ods_base_log"))
        for job in ("base_log", "unique_visit", *order):
            if job == "visitor_stats" and i == 0 and order[0] == "visitor_stats":
                continue  # its topics do not exist yet
            deploy.JOBS[job](at).awaitTermination()
    sums = [F.sum(c) for c in ("uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum")]
    repaired = visits.repair_is_new(pages(spark, rows), ["place"])
    want = jobs.job_visitor_stats(visits.unique_visit(repaired, ["place"]),
                                  visits.user_jump(repaired, ["place"]), repaired)
    got = spark.read.parquet(f"{folder}/state/reports/visitor_stats")
    last = got.agg(F.max("edt")).first()[0]
    assert tuple(got.agg(*sums).first()) == tuple(
        want.where(F.col("edt") <= last).where(F.col("edt") < "2024-01-01").agg(*sums).first())
    assert got.agg(F.sum("uj_ct")).first()[0] > 50


def test_database_jobs_end_to_end(spark, folder):
    topics = Topics(folder=f"{folder}/topics")

    def change(table, after, op="c", ts=1):
        return json.dumps({"op": op, "source": {"db": "shop", "table": table}, "after": after, "ts_ms": ts})

    def rule(source, op, kind, sink, columns):
        return change("table_process", {"sourceTable": source, "operateType": op, "sinkType": kind,
                                        "sinkTable": sink, "sinkColumns": columns})

    _lines(spark, f"{folder}/state/rules", [
        rule("order_info", "c", "kafka", "dwd_order_info", "id,province_id,user_id,total_amount,create_time"),
        rule("order_detail", "c", "kafka", "dwd_order_detail", "id,order_id,sku_id,sku_num,order_price,split_total_amount,create_time"),
        rule("payment_info", "c", "kafka", "dwd_payment_info", "id,order_id,total_amount,create_time"),
        rule("sku_info", "c", "hbase", "dim_sku_info", "id,sku_name,price,spu_id"),
        rule("sku_info", "u", "hbase", "dim_sku_info", "id,sku_name"),
        rule("user_info", "c", "hbase", "dim_user_info", "id,gender,birthday")])
    late = "2024-02-01 00:00:00"
    _lines(spark, topics.path("ods_base_db"), [
        change("sku_info", {"id": "3", "sku_name": "old", "price": "9.90", "spu_id": "4", "secret": "x"}),
        change("sku_info", {"id": "3", "sku_name": "new"}, "u", 2),
        change("user_info", {"id": "2", "gender": "F", "birthday": "1990-01-01"}),
        change("order_info", {"id": "1", "province_id": "5", "user_id": "2", "total_amount": "7.00", "create_time": "2024-01-01 00:00:10"}),
        change("order_info", {"id": "9", "create_time": late}),
        change("order_detail", {"id": "11", "order_id": "1", "sku_id": "3", "sku_num": "2", "order_price": "3.50", "split_total_amount": "7.00", "create_time": "2024-01-01 00:00:12"}),
        change("order_detail", {"id": "12", "order_id": "9", "sku_id": "8", "sku_num": "1", "order_price": "1.00", "create_time": late}),
        change("payment_info", {"id": "70", "order_id": "1", "total_amount": "7.00", "create_time": "2024-01-01 00:05:00"}),
        change("payment_info", {"id": "71", "order_id": "9", "create_time": late}),
        change("order_info", {"id": "1"}, "d"), change("unruled", {"id": "1"}), "broken"])
    others = ("dwd_cart_info", "dwd_favor_info", "dwd_order_refund_info", "dwd_comment_info")
    for i, topic in enumerate(others):
        committed.write_batch(spark.createDataFrame([('{"sku_id":"3","create_time":"2024-01-01 00:00:11","appraise":"1201","order_id":"1","refund_amount":"1.25"}', topic)],
                              "value STRING, topic STRING"), topics.path("base_db"), 1000 + i)
    log = pages(spark, [page("m", 1704067211000, page_id="good_detail", item="3", item_type="sku_id")])
    log.select(F.to_json(F.struct("common", "page", "displays", "ts"))).write.text(topics.path("ods_base_log"))
    at = deploy.Place(spark, topics, f"{folder}/state", once=True)
    for job in ("base_db", "base_log", "order_wide", "payment_wide", "province_stats", "product_stats"):
        deploy.JOBS[job](at).awaitTermination()
    got = spark.read.parquet(f"{folder}/state/reports/product_stats").where("sku_id = 3").orderBy("stt").collect()
    first = got[0]
    assert (first.sku_name, str(first.sku_price), first.spu_id, first.spu_name) == ("new", "9.90", 4, None)
    assert (first.stt, first.order_ct, first.order_sku_num, str(first.order_amount)) == ("2024-01-01 00:00:10", 1, 2, "3.50")
    assert (first.cart_ct, first.favor_ct, first.comment_ct, first.good_comment_ct, first.click_ct) == (1, 1, 1, 1, 1)
    assert (first.refund_order_ct, str(first.refund_amount)) == (1, "1.25")
    assert sum(r.paid_order_ct for r in got) == 1
    province = spark.read.parquet(f"{folder}/state/reports/province_stats").where("province_id = 5").first()
    assert (province.order_count, str(province.order_amount)) == (1, "7.00")


def fails_once(monkeypatch, module, name, after):
    """Let a function fail the first time it is called, before or after it has done its work."""
    real, calls = getattr(module, name), []

    def broken(*args, **kwargs):
        calls.append(1)
        if len(calls) > 1:
            return real(*args, **kwargs)
        if after:
            real(*args, **kwargs)
        raise RuntimeError("lost")

    monkeypatch.setattr(module, name, broken)
    return calls


def database_lines(spark, folder):
    def change(table, after, ts):
        return json.dumps({"op": "c", "source": {"db": "shop", "table": table}, "after": after, "ts_ms": ts})

    def rules(sink, ts):
        return [change("table_process", {"sourceTable": source, "operateType": "c", "sinkType": kind,
                                         "sinkTable": sink + name, "sinkColumns": "id,name"}, ts)
                for source, kind, name in (("order_info", "kafka", "orders"), ("sku_info", "hbase", "skus"))]

    _lines(spark, f"{folder}/state/rules", rules("old_", 1))
    _lines(spark, f"{folder}/topics/ods_base_db", [
        *[change("order_info", {"id": str(i), "name": "same"}, i) for i in (1, 2, 3, 3)],
        change("sku_info", {"id": "7", "name": "n"}, 5), "broken", "broken"])
    return rules


@pytest.mark.parametrize("module, name, after", [
    (dimensions, "upsert_batch", False), (dimensions, "upsert_batch", True),
    (committed, "stage_batch", True), (committed, "commit_batch", True),
    (deploy.sinks, "sink_lines", True)])
def test_a_failed_batch_leaves_its_lines_once(spark, folder, monkeypatch, module, name, after):
    """The batch fails at some write, a rule is replaced, and it runs again: equal lines of one
    batch stay, none is there twice, and all of them follow the rules of the first attempt."""
    rules = database_lines(spark, folder)
    topics = Topics(folder=f"{folder}/topics")
    at = deploy.Place(spark, topics, f"{folder}/state", once=True)
    calls = fails_once(monkeypatch, module, name, after)
    starts = []

    def start():
        if starts:
            _lines(spark, f"{folder}/state/rules", rules("new_", 9))
        starts.append(1)
        return deploy.JOBS["base_db"](at)

    run.supervise(start, pause=0.1)
    assert len(starts) == 2 and calls
    lines = read_topic(spark, topics, "old_orders", False, origin="base_db", by_batch=True)
    assert sorted(json.loads(r.value)["id"] for r in lines.collect()) == ["1", "2", "3", "3"]
    assert read_topic(spark, topics, "new_orders", False, origin="base_db", by_batch=True).isEmpty()
    assert read_topic(spark, topics, deploy.DIRTY_DB, False, origin=deploy.DIRTY_DB,
                      by_batch=True).count() == 2
    held = {t: dimensions.read_dimension(spark, at.dimensions, t, ["id", "name"]).collect()
            for t in ("old_skus", "new_skus")}
    assert [tuple(r) for r in held["old_skus"]] == [("7", "n")] and held["new_skus"] == []
    _lines(spark, topics.path("ods_base_db"), [json.dumps(
        {"op": "c", "source": {"db": "shop", "table": "order_info"}, "after": {"id": "8"}, "ts_ms": 10})])
    start().awaitTermination()
    new = read_topic(spark, topics, "new_orders", False, origin="base_db", by_batch=True)
    assert [json.loads(r.value)["id"] for r in new.collect()] == ["8"]


def test_readers_see_committed_batches_only(spark, folder):
    topics = Topics(folder=folder)
    lines = spark.createDataFrame([("a", "x"), ("b", "y")], "value STRING, topic STRING")
    committed.write_batch(lines, topics.path("o"), 0)
    committed.stage_batch(lines, topics.path("o"), 1)

    def seen():
        stream = read_topic(spark, topics, "x", origin="o", by_batch=True)
        run.start_to_files(stream, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
        return (spark.read.parquet(f"{folder}/out").count(),
                read_topic(spark, topics, "x", False, origin="o", by_batch=True).count())

    assert seen() == (1, 1)
    committed.write_batch(lines, topics.path("o"), 1)
    committed.write_batch(lines.limit(0), topics.path("o"), 2)
    committed.write_batch(lines, topics.path("o"), 1)
    assert seen() == (2, 2)


def test_supervision_ends_after_three_restarts(spark, folder):
    rows = spark.createDataFrame([("a",)], "value STRING")
    rows.write.text(f"{folder}/in")
    starts = []

    def start():
        def fail(batch, batch_id):
            raise RuntimeError("always")

        starts.append(1)
        return run.start_per_batch(spark.readStream.text(f"{folder}/in"), fail, f"{folder}/checkpoint")

    with pytest.raises(StreamingQueryException):
        run.supervise(start, pause=0)
    assert len(starts) == 4


FACT, VERSION = "id LONG, k STRING, time TIMESTAMP, name STRING, price DECIMAL(16,2)", \
    "id STRING, name STRING, seen TIMESTAMP, v LONG"
SEEN = datetime(2024, 5, 1, 1, 2, 3, 456_789)


def waiting_rounds(spark, folder, rounds, salts=2):
    """What a waiting lookup has written after each round of facts and versions."""
    def at(seconds):
        return None if seconds is None else datetime(2024, 1, 1) + timedelta(seconds=seconds)

    seen = []
    for facts, versions in rounds:
        spark.createDataFrame([(i, k, at(s), "own", None) for i, k, s in facts], FACT).coalesce(
            1).write.mode("append").parquet(f"{folder}/facts")
        spark.createDataFrame([(i, n, SEEN, v) for i, n, v in versions], VERSION).coalesce(
            1).write.mode("append").parquet(f"{folder}/versions")
        joined = lookups.dim_join_stream(
            spark.readStream.schema(FACT).parquet(f"{folder}/facts"),
            spark.readStream.schema(VERSION).parquet(f"{folder}/versions"),
            "k", {"name": "name", "seen": "seen"}, "time", timedelta(seconds=60), "v", salts=salts)
        run.start_to_files(joined, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
        rows = spark.read.parquet(f"{folder}/out").collect()
        assert all((r.seen == SEEN) == (r.name is not None) for r in rows)
        seen.append(sorted((r.id, r.name) for r in rows))
    return seen


def test_lookup_waits_for_its_dimension(spark, folder):
    seen = waiting_rounds(spark, folder, [
        ([(1, "a", 0), (2, "b", 1), (3, None, 2), (4, "b", 1), (4, "b", 1)], []),
        ([(5, "a", 3)], [("a", "A1", 5), ("a", "A0", 4), (None, "none", 9), ("b", None, None)]),
        ([(6, "a", 20), (7, "b", 100)], [("a", "old", 1), ("a", "A2", 6)]),
        ([(8, "a", 0), (9, "c", 150), (10, "c", None)], [("b", "B", 1)]),
        ([(11, "z", 1000)], [])])
    assert seen[0] == [(3, None)]                                    # the others wait
    assert seen[1] == [(1, "A1"), (3, None), (5, "A1")]              # their dimension has come
    assert seen[2] == sorted([*seen[1], (2, None), (4, None), (4, None), (6, "A1")],
                             key=lambda r: r[0])                     # waited too long
    assert seen[3] == [*seen[2], (7, "B"), (8, "A2"), (10, None)]    # late rows are not lost
    assert seen[4] == [*seen[3][:-1], (9, None), (10, None)]         # 11 still waits


def test_lookup_stream_equals_batch_under_skew(spark, folder):
    rng = random.Random(5)
    facts = [(i, "hot" if rng.random() < 0.4 else f"k{rng.randrange(8)}", i // 10) for i in range(300)]
    versions = [("hot", "H", 1), *[(f"k{i}", f"K{i}", 1) for i in range(5)]]
    seen = waiting_rounds(spark, folder, [(facts[:150], []), (facts[150:], versions),
                                          ([(-1, None, 10_000)], [])], salts=4)
    names = {k: n for k, n, _ in versions}
    assert [r for r in seen[-1] if r[0] >= 0] == sorted((i, names.get(k)) for i, k, _ in facts)


def test_many_rows_are_fed_in_more_rounds(spark, monkeypatch):
    """A stream fed in rounds got all rows at once, however many, and they stayed staged."""
    rows = [(i, None if i % 50 == 7 else (i * 7919 % 1000) ** 2 * 100) for i in range(1000)]
    wanted = Counter(ts // 1_000_000 for _, ts in rows if ts is not None)
    folders, started = [], []
    monkeypatch.setattr(queries, "ROUND_ROWS", 100)
    monkeypatch.setattr(queries, "work_folder", lambda *a: folders.append(
        work_folder(*a)) or folders[-1])
    monkeypatch.setattr(queries.run, "start_to_files", lambda *a, start=queries.run.start_to_files,
                        **k: started.append(start(*a, **k)) or started[-1])
    out = queries._in_rounds(
        spark, {"rows": spark.createDataFrame(rows, "id long, ts long")},
        {"id": F.lit(-1).cast("long")},
        lambda df: df.withColumn("time", F.timestamp_millis("ts")).withWatermark(
            "time", "1 second").groupBy(F.window("time", "1000 seconds").alias("window")).agg(
            F.count("*").alias("n")).select(F.unix_millis("window.start").alias("start"), "n"),
        "rounds", 1)
    assert {r.start // 1_000_000: r.n for r in out.collect()} == wanted
    fed = [max(p["numInputRows"] for p in q.recentProgress) for q in started]
    assert len(fed) == 11 and max(fed) < 150 and sum(fed) == len(rows) + 1
    assert not list(Path(folders[0], "staged").rglob("part-*"))
    assert not list(Path(folders[0], "rows").rglob("part-*"))
