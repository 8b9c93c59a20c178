import glob
import json

import pytest
from pyspark.sql import functions as F

from tidemill import schemas
from tidemill.operators import changes as ch
from tidemill.sinks import dimensions as dm, tables as st, topics as sinks
from tidemill.sources import changes as sc
from tidemill.sources.topics import Topics, read_topic, starting_options


def change(op, table="base_trademark", before=None, after=None, ts=1, place=0):
    return (op, {"db": "shop", "table": table}, before, after, ts, place)


def changes(spark, rows):
    return spark.createDataFrame(rows, schemas.CHANGE + ", place BIGINT")


A, B = {"id": "2", "tm_name": "it's", "logo_url": "/a"}, {"id": "2", "tm_name": None, "logo_url": "/b"}


def test_envelope_lines(spark):
    good = json.dumps({"op": "c", "source": {"db": "shop", "table": "t", "file": "x"},
                       "before": None, "after": {"id": 2, "price": "1.50"}, "ts_ms": 5})
    df = spark.createDataFrame([(good,), ('{"op":"c"',)], "value STRING")
    ok, dirty = sc.change_envelopes(df)
    row = ok.first()
    assert (row.op, row.source.table, row.before, row.after) == ("c", "t", None, {"id": "2", "price": "1.50"})
    assert dirty.count() == 1


def test_flat_envelope(spark):
    df = changes(spark, [change("c", after=A), change("d", before=A)]).withColumn(
        "topic", F.lit("server.shop.base_trademark"))
    got = ch.flat_envelope(df).orderBy("type").collect()
    assert [(r.type, r.database, r.tableName) for r in got] == [
        ("CREATE", "shop", "base_trademark"), ("DELETE", "shop", "base_trademark")]
    assert got[0].before == {} and got[1].after == {}


def test_changelog_and_state(spark):
    rows = [change("r", after=A, ts=1), change("u", before=A, after=B, ts=2),
            change("d", before=B, ts=3), change("c", after={"id": "3"}, ts=4),
            change("u", before={"id": "4"}, after={"id": "4", "v": "x"}, ts=9, place=1),
            change("u", before={"id": "4"}, after={"id": "4", "v": "y"}, ts=9, place=2)]
    df = changes(spark, rows)
    kinds = ch.changelog_view(df).groupBy("row_kind").count().collect()
    assert {r.row_kind: r["count"] for r in kinds} == {"+I": 2, "-U": 3, "+U": 3, "-D": 1}
    state = ch.current_state(df, "id", ["ts_ms", "place"]).collect()
    assert {r.pk: r.row.get("v") for r in state} == {"3": None, "4": "y"}


def test_start_modes(spark):
    df = changes(spark, [change("c", after=A, ts=1), change("u", after=B, ts=5)]).drop("place")
    table = spark.createDataFrame([(7, "n")], "id INT, name STRING")
    snapshot = ch.snapshot_rows(table, "shop", "t")
    assert sc.start_at(df, "initial", snapshot).count() == 3
    assert snapshot.first().after == {"id": "7", "name": "n"} and snapshot.first().op == "r"
    assert sc.start_at(df, "earliest").count() == 2
    assert sc.start_at(df, "timestamp", timestamp_ms=5).count() == 1
    with pytest.raises(ValueError):
        sc.start_at(df, "timestamp")


def test_kafka_start_options():
    assert starting_options("initial") == {"startingOffsets": "earliest"}
    assert starting_options("latest") == {"startingOffsets": "latest"}
    assert starting_options("timestamp", timestamp_ms=5)["startingTimestamp"] == "5"
    assert json.loads(starting_options("offsets", offsets={"t": {"0": 4}})["startingOffsets"]) == {"t": {"0": 4}}
    with pytest.raises(ValueError):
        starting_options("offsets")


RULES = [("base_trademark", "c", "hbase", "dim_base_trademark", "id,tm_name", None, None),
         ("base_trademark", "u", "hbase", "dim_base_trademark", "id, tm_name,logo_url", "id", None),
         ("order_info", "c", "kafka", "dwd_order_info", "id", "id", None),
         ("click", "c", "clickhouse", "x", "id", "id", None)]


@pytest.mark.parametrize("max_bytes", [1 << 20, 1])
def test_routes(spark, max_bytes):
    rows = [change("c", after=A), change("u", before=A, after=B), change("d", before=B),
            change("c", "order_info", after={"id": "5", "other": "z"}),
            change("c", "unruled", after=A), change("c", "click", after=A), change(None, after=A)]
    routed = ch.route_by_rule(ch.drop_deletes(changes(spark, rows)),
                              spark.createDataFrame(RULES, schemas.RULE), max_bytes)
    assert [(r.sink_table, r.after) for r in ch.to_topics(routed).collect()] == [
        ("dwd_order_info", {"id": "5"})]
    dims = {r.op: r for r in ch.to_dimensions(routed).collect()}
    assert dims["c"].after == {"id": "2", "tm_name": "it's"} and dims["c"].sink_pk == "id"
    # Names are compared as written: " tm_name" is not tm_name.
    assert dims["u"].after == {"id": "2", "logo_url": "/b"}
    assert routed.where("sink_table = 'x'").count() == 1


def test_drop_deletes_keeps_null_op(spark):
    df = changes(spark, [change(None, after=A), change("d", before=A)])
    assert [r.op for r in ch.drop_deletes(df).collect()] == [None]


def test_last_rule_wins(spark):
    fields = ["sourceTable", "operateType", "sinkType", "sinkTable", "sinkColumns"]

    def rule(table, ts, op="c"):
        after = dict(zip(fields, ["t", "c", "kafka", table, "id"]))
        return change(op, "table_process", after=after, ts=ts)

    df = changes(spark, [rule("old", 1, "r"), rule("new", 2, "u")])
    assert [r.sinkTable for r in sc.rule_table(df, ["ts_ms"]).collect()] == ["new"]


def _dim_rows(spark, rows):
    routed = changes(spark, rows)
    return routed.withColumn("pk", F.col("after")["id"]).withColumn("sink_table", F.lit("dim"))


def test_key_need_not_be_listed_and_null_keys_are_dirty(spark, folder):
    rules = spark.createDataFrame(
        [("t", "c", "hbase", "dim", "name", "id", None)], schemas.RULE)
    rows = changes(spark, [change("c", "t", after={"id": "1", "name": "a"}),
                           change("c", "t", after={"id": "2", "name": "b"}),
                           change("c", "t", after={"id": None, "name": "c"}),
                           change("c", "t", after={"name": "d"})])
    routed = ch.route_by_rule(rows, rules)
    dm.upsert_batch(ch.to_dimensions(routed), folder, 0)
    assert sorted(r.name for r in dm.read_dimension(spark, folder, "dim", ["name"]).collect()) == ["a", "b"]
    assert ch.without_key(routed).count() == 2


def test_dimension_never_written_is_empty(spark, folder):
    got = dm.read_dimension(spark, folder + "/none", "dim", ["id", "a"])
    assert got.columns == ["id", "a"] and got.count() == 0


def test_upsert_is_repeatable_and_merges_columns(spark, folder):
    first = _dim_rows(spark, [change("c", after={"id": "1", "a": "x", "b": "y"}, ts=1),
                              change("c", after={"id": "2", "a": "q'uote", "b": None}, ts=1)])
    second = _dim_rows(spark, [change("u", after={"id": "1", "a": "x2"}, ts=2),
                               change("u", after={"id": "1", "a": "x3"}, ts=2, place=1)])
    for batch, rows in enumerate([first, second]):
        for _ in range(2):
            dm.upsert_batch(rows, folder, batch, "place")
    got = sorted(map(tuple, dm.read_dimension(spark, folder, "dim", ["id", "a", "b"]).collect()))
    assert got == [("1", "x3", "y"), ("2", "q'uote", None)]


def test_a_batch_that_fails_before_its_switch_runs_again(spark, folder, monkeypatch):
    dm.upsert_batch(_dim_rows(spark, [change("c", after={"id": "1", "a": "x"}, ts=1)]), folder, 0)
    later = _dim_rows(spark, [change("u", after={"id": "1", "a": "y"}, ts=2),
                              change("c", after={"id": "2", "a": "z"}, ts=2)])

    def killed(*_):
        raise OSError("killed")

    def rows():
        return sorted(map(tuple, dm.read_dimension(spark, folder, "dim", ["id", "a"]).collect()))

    with monkeypatch.context() as patch:
        patch.setattr(dm, "_switch", killed)
        with pytest.raises(OSError):
            dm.upsert_batch(later, folder, 1)
    assert rows() == [("1", "x")]
    dm.upsert_batch(later, folder, 1)
    assert rows() == [("1", "y"), ("2", "z")]


def test_readers_do_not_merge_and_old_versions_go(spark, folder):
    for batch in range(5):
        dm.upsert_batch(_dim_rows(spark, [
            change("u", after={"id": str(i), "a": f"{batch}"}, ts=batch) for i in range(batch, 40)]),
            folder, batch)
    got = dm.read_dimension(spark, folder, "dim", ["id", "a"])
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    want = sorted((str(i), str(min(i, 4))) for i in range(40))
    assert sorted(map(tuple, got.collect())) == want
    dm.vacuum(spark, folder)
    assert sorted(map(tuple, dm.read_dimension(spark, folder, "dim", ["id", "a"]).collect())) == want
    left = glob.glob(f"{folder}/rows/sink_table=dim/bucket=*/version=*")
    assert left and len(left) < 40 * 3 and len(glob.glob(f"{folder}/manifest/version=*")) == 2
    assert not any(p.endswith("version=0") for p in left)


def test_key_that_the_rule_does_not_list_is_kept(spark, folder):
    rows = _dim_rows(spark, [change("c", after={"id": "1", "name": "a"}, ts=1),
                             change("c", after={"id": "2", "name": "b"}, ts=1)])
    pruned = rows.withColumn("sink_pk", F.lit("id")).withColumn(
        "after", F.map_filter("after", lambda k, _: k == "name"))
    dm.upsert_batch(pruned, folder, 0)
    got = dm.read_dimension(spark, folder, "dim", ["id", "name"]).collect()
    assert sorted(map(tuple, got)) == [("1", "a"), ("2", "b")]


def test_current_state_of_a_stream_of_batches(spark, folder):
    """An older change that comes later neither wins nor brings a deleted row back."""
    batches = [[change("c", after={"id": "1", "a": "new"}, ts=5), change("d", before={"id": "2"}, ts=5)],
               [change("c", after={"id": "1", "a": "old"}, ts=1),
                change("c", after={"id": "2", "a": "old"}, ts=1),
                change("c", after={"id": "3", "a": None}, ts=1)],
               [change("d", before={"id": "3"}, ts=2), change("u", after={"id": "4", "b": "x"}, ts=2)]]
    for i, rows in enumerate(batches):
        dm.sink_current_state(folder, "id", "place")(changes(spark, rows), i)
    got = {r.pk: r.row for r in dm.read_current_state(spark, folder).collect()}
    assert got == {"1": {"id": "1", "a": "new"}, "4": {"id": "4", "b": "x"}}


def test_null_set_by_a_later_change_stays(spark, folder):
    dm.upsert_batch(_dim_rows(spark, [change("c", after={"id": "1", "a": "x"}, ts=1),
                                      change("u", after={"id": "1", "a": None}, ts=2)]), folder, 0)
    assert [tuple(r) for r in dm.read_dimension(spark, folder, "dim", ["id", "a"]).collect()] == [("1", None)]


def test_replacing_keeps_the_newest_version(spark, folder):
    ddl = "stt STRING, k INT, n INT, ts BIGINT"
    st.sink_replacing(spark.createDataFrame([("2024-01-01 00:00:00", 1, 5, 10), ("2024-01-02 00:00:00", 1, 6, 10)], ddl), folder, 0)
    for _ in range(2):
        st.sink_replacing(spark.createDataFrame([("2024-01-01 00:00:00", 1, 7, 11)], ddl), folder, 1)
    got = st.read_replacing(spark, folder, ["stt", "k"]).orderBy("stt").collect()
    assert [(r.n, r.ts) for r in got] == [(7, 11), (6, 10)]


def test_jdbc_columns_leave_transient_ones_out(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a INT, hidden INT, b INT")
    assert st.without(df, ["hidden"]).columns == ["a", "b"]


def test_topics(spark, folder):
    topics = Topics(folder=folder)
    df = spark.createDataFrame([(1, None), (2, "x")], "a INT, b STRING")
    sinks.sink_topic(df, topics, "t")
    assert sorted(r.value for r in read_topic(spark, topics, "t", streaming=False).collect()) == [
        '{"a":1}', '{"a":2,"b":"x"}']
    routed = spark.createDataFrame([({"id": "1"}, "dwd_a"), ({"id": "2"}, "dwd_b")],
                                   "after MAP<STRING, STRING>, sink_table STRING")
    sinks.sink_topic_by_row(routed, topics)
    got = read_topic(spark, topics, "dwd_b", streaming=False, origin="by_row")
    assert [r.value for r in got.collect()] == ['{"id":"2"}']


def test_console(spark, capfd):
    sinks.sink_console(spark.createDataFrame([("shown",)], "a STRING"), 5)
    assert "shown" in capfd.readouterr().out
