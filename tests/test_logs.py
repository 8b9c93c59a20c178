import json
import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from samples import display, page, pages
from tidemill import schemas
from tidemill.operators import logs as lg, products, visits
from tidemill.plans import jobs


@pytest.mark.parametrize("text, dirty", [
    ('{"ts":1}', False), ("{}", False), (' {"ts":1} \n', False), ('{"unknown":1}', False),
    ('{"ts":1', True), ("[1]", True), ('[{"ts":1}]', True), ("null", True), ("", True),
    (None, True), ("words", True), ('{"ts":1} x', True), ('{"ts":1}{"ts":2}', True),
    ('{"ts":1} x}', True), ('{"a":1}],[{}', True), ('{"a":1}},{"b":{}', True), ('{"a":1},{"b":2}', True),
    ('{"ts":"1608280220000"}', False), ('{"page":{"during_time":"12"}}', False),
    ('{"page":{"during_time":12.5}}', False), ('{"start":""}', False), ('{"common":5}', False)])
def test_dirty_lines(spark, text, dirty):
    df = spark.createDataFrame([(1, text)], "id INT, value STRING")
    clean, bad = lg.split_dirty(df, schemas.LOG)
    assert (clean.count(), bad.count()) == ((0, 1) if dirty else (1, 0))
    assert bad.columns == ["id", "value"]


def test_numbers_as_text(spark):
    df = spark.createDataFrame([('{"ts":"1608280220000","page":{"during_time":"12","item":7}}',)], "value STRING")
    row = lg.split_dirty(df, schemas.LOG)[0].first()
    assert (row.ts, row.page.during_time, row.page["item"]) == (1608280220000, 12, "7")


def test_text_is_parsed_once(spark):
    df = spark.createDataFrame([('{"ts":1}',)], "value STRING")
    plan = lg.split_dirty(df, schemas.LOG)[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_routes_and_displays(spark):
    start = page("m", 1) | {"start": {"entry": "icon", "loading_time": 1, "open_ad_id": 1,
                                      "open_ad_ms": 1, "open_ad_skip_ms": 1}, "page": None}
    rows = [start, page("m", 2), page("m", 3, displays=[]),
            page("m", 4, displays=[display(str(i), order=i) for i in range(11)], page_id="list")]
    df = pages(spark, rows)
    assert [r.ts for r in lg.route_start(df).collect()] == [1]
    assert sorted(r.ts for r in lg.route_page(df).collect()) == [2, 3, 4]
    shown = lg.explode_display(lg.route_page(df))
    assert shown.columns == ["display_type", "item", "item_type", "order", "pos_id", "page_id"]
    assert sorted(r.order for r in shown.collect()) == list(range(11))
    assert {r.page_id for r in shown.collect()} == {"list"}


def test_one_pass_lines_equal_the_frames(spark):
    logs = pages(spark, [page("m", 1, is_new="1", displays=[display("5"), display("6")]),
                         page("m", 2, is_new="1"), page("n", 3)])
    lines = logs.select("place", F.to_json(F.struct("common", "page", "displays", "ts")).alias("value")) \
        .unionByName(spark.createDataFrame([(9, "broken")], "place BIGINT, value STRING"))
    got = jobs.base_log_lines(lines, ["place"]).collect()
    assert sorted(r.topic for r in got) == ["dirty"] + ["dwd_display_log"] * 2 + ["dwd_page_log"] * 3
    frames = jobs.job_base_log(lines, ["place"])
    def texts(topic, columns):
        rows = frames[topic].select(F.to_json(F.struct(*columns)).alias("v")).collect()
        return sorted((json.loads(r.v) for r in rows), key=str)

    def lines_of(topic):
        return sorted((json.loads(r.value) for r in got if r.topic == topic), key=str)

    def unordered(rows):
        return sorted((json.dumps(r, sort_keys=True) for r in rows))

    for topic, columns in (("dwd_page_log", ["common", "start", "page", "displays", "ts"]),
                           ("dwd_display_log", frames["dwd_display_log"].columns)):
        assert unordered(texts(topic, columns)) == unordered(lines_of(topic))


def test_lines_pass_whole(spark):
    lines = ['{"ts":1,"err":{"code":5},"common":{"mid":"m","sid":"s9","is_new":"1"},"page":{"page_id":"p"},'
             '"displays":[{"item":"1","shade":{"x":2}}]}',
             '{"ts":2,"err":{"code":6},"common":{"mid":"m","sid":"s8","is_new":"1"},"page":{"page_id":"p"}}']
    df = spark.createDataFrame(list(enumerate(lines)), "place BIGINT, value STRING")
    got = sorted((r.topic, r.value) for r in jobs.base_log_lines(df, ["place"]).collect())
    repaired = json.loads(lines[1])
    repaired["common"]["is_new"] = "0"
    assert [(t, json.loads(v)) for t, v in got] == [
        ("dwd_display_log", {"item": "1", "shade": {"x": 2}, "page_id": "p"}),
        ("dwd_page_log", repaired), ("dwd_page_log", json.loads(lines[0]))] or [
        (t, json.loads(v)) for t, v in got] == [
        ("dwd_display_log", {"item": "1", "shade": {"x": 2}, "page_id": "p"}),
        ("dwd_page_log", json.loads(lines[0])), ("dwd_page_log", repaired)]
    assert lines[0] in [v for _, v in got]


def test_first_row_without_a_time(spark):
    df = pages(spark, [page("m", None, place=0, is_new="1"), page("m", 5, place=1, is_new="1"),
                       page("m", 6, place=2, is_new="1")])
    got = {r.place: r.common.is_new for r in visits.repair_is_new(df, ["place"]).collect()}
    assert got == {0: "1", 1: "0", 2: "0"}


def test_session_entry(spark):
    df = pages(spark, [page("m", 1), page("m", 2, ""), page("m", 3, "home")])
    assert [r[0] for r in df.orderBy("ts").select(lg.is_session_entry()).collect()] == [
        True, True, False]


@pytest.mark.parametrize("flags, want", [
    ("11", "10"), ("011", "010"), ("101", "100"), ("00", "00"), ("1", "1")])
def test_repair_is_new(spark, flags, want):
    rows = [page(m, i, is_new=f, place=i) for m in ("a", "b") for i, f in enumerate(flags)]
    got = visits.repair_is_new(pages(spark, rows), ["place"])
    assert got.columns == pages(spark, rows).columns
    for m in ("a", "b"):
        seen = got.where(F.col("common.mid") == m).orderBy("ts").collect()
        assert "".join(r.common.is_new for r in seen) == want


def test_repair_with_equal_times_and_null_device(spark):
    rows = [page("a", 5, is_new="1", place=p) for p in (3, 1, 2)]
    rows += [page(None, 5, is_new="1", place=p) for p in (8, 7)] + [page("a", 1, is_new=None)]
    got = {(r.common.mid, r.place): r.common.is_new
           for r in visits.repair_is_new(pages(spark, rows), ["place"]).collect()}
    assert got == {("a", 1): "1", ("a", 2): "0", ("a", 3): "0", (None, 7): "1", (None, 8): "0",
                   ("a", 0): None}


def _ms(text):
    return int(datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp() * 1000)


def test_unique_visit_uses_days_of_the_session_zone(spark):
    rows = [page("a", _ms("2024-01-01 15:59:59"), place=1),
            page("a", _ms("2024-01-01 16:00:00"), place=2),
            page("a", _ms("2024-01-01 16:00:01"), place=3),
            page("b", _ms("2024-01-01 15:00:00"), "home", place=4)]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        assert [r.place for r in visits.unique_visit(pages(spark, rows), ["place"]).collect()] == [1]
        spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
        got = visits.unique_visit(pages(spark, rows), ["place"]).collect()
        assert sorted(r.place for r in got) == [1, 2]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize("gap, last, jumped", [
    (9_999, None, True), (9_999, "home", False), (10_000, "home", True), (10_001, "home", True),
    (0, "home", False)])
def test_user_jump_gap(spark, gap, last, jumped):
    rows = [page("a", 299_995, place=1), page("a", 299_995 + gap, last, place=2)]
    got = {r.place for r in visits.user_jump(pages(spark, rows), ["place"]).collect()}
    assert (1 in got) is jumped
    assert (2 in got) is (last is None)


def brute_jumps(rows, gap_ms):
    out = []
    for mid in {r["common"]["mid"] for r in rows}:
        line = sorted((r for r in rows if r["common"]["mid"] == mid),
                      key=lambda r: (r["ts"], r["place"]))
        for i, row in enumerate(line):
            after = line[i + 1] if i + 1 < len(line) else None
            if not row["page"]["last_page_id"] and (
                    after is None or after["ts"] >= row["ts"] + gap_ms
                    or not after["page"]["last_page_id"]):
                out.append(row["place"])
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_user_jump_against_brute_force_with_a_hot_device(spark, seed):
    rng = random.Random(seed)
    rows = [page("hot" if rng.random() < 0.4 else f"d{rng.randrange(20)}",
                 rng.randrange(0, 2_000_000, 500), rng.choice([None, "", "home"]), place=i)
            for i in range(1500)]
    df = pages(spark, rows)
    want = brute_jumps(rows, 10_000)
    assert sorted(r.place for r in visits.user_jump(df, ["place"]).collect()) == want
    narrow = visits.user_jump(df, ["place"], bucket_gaps=1)
    assert sorted(r.place for r in narrow.collect()) == want
    entries = visits.with_next(df, ["place"])
    both = visits.matched_jumps(entries).unionByName(visits.timed_out_jumps(entries))
    assert sorted(r.place for r in both.collect()) == want


def test_search_filter(spark):
    df = spark.createDataFrame([
        ({"last_page_id": "search", "item": "phone"}, 1), ({"last_page_id": "search"}, 2),
        ({"last_page_id": "home", "item": "x"}, 3), (None, 4)], "page MAP<STRING, STRING>, row_time INT")
    assert [r.full_word for r in lg.filter_search(df).collect()] == ["phone"]


def test_visitor_rows(spark):
    rows = [page("a", 1, None, during=7), page("a", 2, "home", during=5)]
    df = pages(spark, rows)
    pv = lg.visitor_pv(df).orderBy("ts").collect()
    assert [(r.pv_ct, r.sv_ct, r.dur_sum, r.uv_ct, r.uj_ct) for r in pv] == [
        (1, 1, 7, 0, 0), (1, 0, 5, 0, 0)]
    assert lg.union_visitor(df, df, df).count() == 6


def test_click_and_display_rows(spark):
    rows = [page("a", 1, page_id="good_detail", item="9", item_type="sku_id"),
            page("a", 2, page_id="good_detail", item="3,7", item_type="sku_ids"),
            page("a", 3, page_id="home", item="9", item_type="sku_id",
                 displays=[display("2"), display("4", "activity_id"), display("2")])]
    df = pages(spark, rows)
    assert [(r.sku_id, r.click_ct) for r in products.product_click(df).collect()] == [(9, 1)]
    assert [(r.sku_id, r.display_ct) for r in products.product_display(df).collect()] == [
        (2, 1), (2, 1)]
