"""One query per operator over the given tables, each with its DuckDB statement where SQL can
say the same. Queries run the library's operators on whole tables in the shapes of
``tables``. Streams run over the tables' files to their end and return what they wrote."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tidemill import schemas
from tidemill.functions import times, words
from tidemill.functions.names import snake_to_camel
from tidemill.operators import changes as ch
from tidemill.operators import joins, logs as lg, orders as od, products, stats, visits
from tidemill.plans import jobs, tables as t
from tidemill.session import work_folder
from tidemill.sinks import committed, dimensions, tables as sink_tables, topics as sink_topics
from tidemill.sources import changes as src_changes, lines as src_lines, topics as src_topics
from tidemill.streaming import lookups, run, state

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

ORDER = ["event_id"]
HOUR_MS = 3_600_000
AS_OF = "2024-06-01 00:00:00"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql:
            ORACLE[name] = sql
        return function
    return register


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return t.table(spark, sf, "events")


def _pages(spark: SparkSession, sf: str) -> DataFrame:
    return t.page_logs(_events(spark, sf))


def _logs(spark: SparkSession, sf: str) -> DataFrame:
    return t.logs(_events(spark, sf))


def _log_stream(spark: SparkSession, sf: str) -> DataFrame:
    return t.logs(t.table_stream(spark, sf, "events"))


def _page_stream(spark: SparkSession, sf: str) -> DataFrame:
    return t.page_logs(t.table_stream(spark, sf, "events"))


def _wide_lines(spark: SparkSession, sf: str) -> DataFrame:
    return t.line_order_wide(t.table(spark, sf, "lineitem"))


def _as_of() -> F.Column:
    return F.lit(AS_OF).cast("timestamp")


# --- SQL parts -------------------------------------------------------------------------------

SECOND = "'%Y-%m-%d %H:%M:%S'"

LG = """lg AS (
    SELECT event_id, user_id, event_type, json_extract_string(props, '$.k') AS k,
           event_type AS ch, 'v1' AS vc, 'mid_' || user_id AS mid,
           CASE WHEN event_type IN ('signup', 'view') THEN '1' ELSE '0' END AS is_new,
           CAST(floor(value) AS BIGINT) AS during_time,
           CASE event_type WHEN 'click' THEN json_extract_string(props, '$.k')
                WHEN 'purchase' THEN json_extract_string(props, '$.k') || ',' || user_id END AS item,
           CASE event_type WHEN 'click' THEN 'search' WHEN 'purchase' THEN 'cart'
                WHEN 'error' THEN '' END AS last_page_id,
           CASE event_type WHEN 'click' THEN 'good_detail' WHEN 'purchase' THEN 'trade'
                WHEN 'signup' THEN NULL ELSE 'home' END AS page_id,
           event_type IN ('view', 'error') AS entry,
           epoch_us(ts) // 1000 AS ts, ts AS t
    FROM events)"""

FIXED = LG + """, fixed AS (
    SELECT *, CASE WHEN is_new = '1' AND row_number() OVER (
                  PARTITION BY user_id, is_new ORDER BY ts, event_id) = 1
              THEN '1' ELSE '0' END AS repaired
    FROM lg)"""

# The page log that the raw-line job leaves: error lines are dirty, flags are repaired.
JOB_PAGES = LG + """, ok AS (
    SELECT *, CASE WHEN is_new = '1' AND row_number() OVER (
                  PARTITION BY user_id, is_new ORDER BY ts, event_id) = 1
              THEN '1' ELSE '0' END AS repaired
    FROM lg WHERE event_type <> 'error'), job_pages AS (
    SELECT * FROM ok WHERE event_type <> 'signup')"""


def _jumps_sql(source: str, gap_ms: int) -> str:
    return f"""SELECT * FROM (
        SELECT *, lead(ts) OVER w AS next_ts, lead(entry) OVER w AS next_entry
        FROM {source} WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    WHERE entry AND (next_ts IS NULL OR next_ts >= ts + {gap_ms} OR next_entry)"""


def _visits_sql(source: str) -> str:
    return f"""SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, CAST(t AS DATE)
                                     ORDER BY ts, event_id) AS place
        FROM {source} WHERE entry) WHERE place = 1"""


CHANGES = """chg AS (
    SELECT event_id, user_id, json_extract_string(props, '$.k') AS k, event_type,
           CASE event_type WHEN 'signup' THEN 'c' WHEN 'view' THEN 'r' WHEN 'click' THEN 'u'
                WHEN 'purchase' THEN 'u' WHEN 'error' THEN 'd' END AS op,
           epoch_us(ts) // 1000 AS ts_ms
    FROM events)"""

RULES_SQL = "rules AS (SELECT * FROM (VALUES {}) r(src, rop, sink_type, sink_table, cols))".format(
    ", ".join(f"('{r[0]}', '{r[1]}', '{r[2]}', '{r[3]}', '{r[4]}')" for r in t.RULES))

ROUTED = CHANGES + ", " + RULES_SQL + """, routed AS (
    SELECT chg.*, sink_type, sink_table, cols FROM chg
    JOIN rules ON src = event_type AND rop = op WHERE op IS DISTINCT FROM 'd')"""

DIMS = """u AS (SELECT CAST(c_custkey AS BIGINT) AS id,
        CAST((epoch_us(TIMESTAMP '2024-06-01 00:00:00')
              - epoch_us(CAST(DATE '1950-01-01' + CAST(c_custkey % 20000 AS INTEGER) AS TIMESTAMP)))
             // 1000 // 31536000000 AS INTEGER) AS user_age,
        CASE WHEN c_acctbal < 0 THEN 'M' ELSE 'F' END AS user_gender FROM customer),
    pv AS (SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS province_name,
        CAST(n_regionkey AS VARCHAR) AS province_area_code,
        'CN-' || n_nationkey AS province_iso_code,
        'ISO-' || n_nationkey AS province_3166_2_code FROM nation),
    sku AS (SELECT p_partkey AS id, p_name AS sku_name,
        CAST(p_retailprice AS DECIMAL(16,2)) AS sku_price,
        CAST(p_size AS BIGINT) AS category3_id, p_partkey % 150 AS spu_id,
        CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS BIGINT) AS tm_id FROM part),
    spu AS (SELECT s_suppkey AS id, s_name AS spu_name FROM supplier),
    tm AS (SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS tm_name FROM nation),
    c3 AS (SELECT CAST(r_regionkey AS BIGINT) AS id, r_name AS category3_name FROM region)"""

ORDER_COLUMNS = f"""o_orderkey AS order_id, o_custkey % 25 AS province_id,
    o_orderstatus AS order_status, o_custkey AS user_id,
    CAST(o_totalprice AS DECIMAL(16,2)) AS total_amount,
    strftime(o_orderdate, {SECOND}) AS create_time,
    strftime(o_orderdate, '%Y-%m-%d') AS create_date, strftime(o_orderdate, '%H') AS create_hour"""

DETAIL_COLUMNS = """l_orderkey * 10 + l_linenumber AS detail_id, l_partkey AS sku_id,
    CAST(l_extendedprice AS DECIMAL(16,2)) AS order_price, CAST(l_quantity AS BIGINT) AS sku_num,
    CAST(l_extendedprice AS DECIMAL(16,2)) AS split_total_amount"""

WIDE = ["detail_id", "order_id", "sku_id", "order_price", "sku_num", "province_id",
        "order_status", "user_id", "total_amount", "split_total_amount", "create_time",
        "create_date", "create_hour"]
NULLS = "CAST(NULL AS VARCHAR) AS expire_time, CAST(NULL AS VARCHAR) AS operate_time"

LOOKED_UP = ["user_age", "user_gender", "province_name", "province_area_code",
             "province_iso_code", "province_3166_2_code", "sku_name", "category3_id", "spu_id",
             "tm_id", "spu_name", "tm_name", "category3_name"]
LOOKUPS = """LEFT JOIN u ON u.id = user_id LEFT JOIN pv ON pv.id = province_id
    LEFT JOIN sku ON sku.id = sku_id LEFT JOIN spu ON spu.id = sku.spu_id
    LEFT JOIN tm ON tm.id = sku.tm_id LEFT JOIN c3 ON c3.id = sku.category3_id"""


def _wide_sql(low: str, high: str) -> str:
    return f"""wide AS (SELECT {ORDER_COLUMNS}, {DETAIL_COLUMNS} FROM orders
        JOIN lineitem ON o_orderkey = l_orderkey
        AND l_shipdate BETWEEN o_orderdate + INTERVAL '{low}' AND o_orderdate + INTERVAL '{high}')"""


# --- Sources ---------------------------------------------------------------------------------

def _plain_lines(events: DataFrame) -> DataFrame:
    return events.select(F.concat_ws(",", "user_id", "event_type", F.floor(
        F.unix_millis("ts") / 1000).cast("bigint"), "event_id").alias("value"))


@query("src_topic_text", """
    SELECT user_id || ',' || event_type || ',' || epoch_us(ts) // 1000000 || ',' || event_id AS value
    FROM events""")
def src_topic_text(spark, sf):
    topics = src_topics.Topics(folder=work_folder(spark, "topic"))
    _plain_lines(_events(spark, sf)).write.text(topics.path("ods_base_log"))
    return run.drain(src_topics.read_topic(spark, topics, "ods_base_log"), "src-topic")


@query("src_cdc_envelope", f"""
    WITH {CHANGES}
    SELECT op, event_type AS table_name, 'shop' AS db, CAST(user_id AS VARCHAR) AS id, ts_ms FROM chg
    UNION ALL
    SELECT 'r', 'customer', 'shop', CAST(c_custkey AS VARCHAR), 0 FROM customer""")
def src_cdc_envelope(spark, sf):
    parsed, _ = src_changes.change_envelopes(t.change_lines(_events(spark, sf)))
    snapshot = ch.snapshot_rows(t.table(spark, sf, "customer"), "shop", "customer")
    read = src_changes.start_at(parsed.drop("event_id"), "initial", snapshot)
    image = F.coalesce("after", "before")
    return read.select("op", F.col("source.table").alias("table_name"),
                       F.col("source.db").alias("db"),
                       F.coalesce(image["user_id"], image["c_custkey"]).alias("id"), "ts_ms")


def _read_changes(spark, sf, mode: str, **options) -> DataFrame:
    parsed, _ = src_changes.change_envelopes(t.change_lines(_events(spark, sf)))
    return src_changes.start_at(parsed, mode, **options).select("event_id", "op", "ts_ms")


@query("src_cdc_earliest", f"WITH {CHANGES} SELECT event_id, op, ts_ms FROM chg")
def src_cdc_earliest(spark, sf):
    return _read_changes(spark, sf, "earliest")


START_MS = 1_705_363_200_000


@query("src_cdc_timestamp", f"""
    WITH {CHANGES} SELECT event_id, op, ts_ms FROM chg WHERE ts_ms >= {START_MS}""")
def src_cdc_timestamp(spark, sf):
    return _read_changes(spark, sf, "timestamp", timestamp_ms=START_MS)


@query("src_cdc_offset", f"WITH {CHANGES} SELECT event_id, op, ts_ms FROM chg WHERE event_id >= 500")
def src_cdc_offset(spark, sf):
    return _read_changes(spark, sf, "offset", place="event_id", offset=500)


@query("src_cdc_latest", f"WITH {CHANGES} SELECT event_id, op, ts_ms FROM chg WHERE event_id > 500")
def src_cdc_latest(spark, sf):
    """A reader that starts when change 500 was the last one sees what comes after it."""
    return _read_changes(spark, sf, "latest", place="event_id", offset=500)


@query("src_cdc_flat", f"""
    WITH {CHANGES}
    SELECT 'shop' AS database, event_type AS "tableName",
           CASE op WHEN 'c' THEN 'CREATE' WHEN 'r' THEN 'READ' WHEN 'u' THEN 'UPDATE'
                WHEN 'd' THEN 'DELETE' END AS type,
           CASE WHEN op = 'd' THEN 0 ELSE 3 END AS n_after,
           CASE WHEN op IN ('u', 'd') THEN 2 ELSE 0 END AS n_before,
           CASE WHEN op <> 'd' THEN CAST(event_id AS VARCHAR) END AS event_id
    FROM chg""")
def src_cdc_flat(spark, sf):
    changes = t.changes(_events(spark, sf)).withColumn(
        "topic", F.concat(F.lit("mysql_binlog.shop."), F.col("source.table")))
    return ch.flat_envelope(changes).select(
        "database", "tableName", "type", F.size("after").alias("n_after"),
        F.size("before").alias("n_before"), F.col("after")["event_id"].alias("event_id"))


@query("cdc_changelog_view", f"""
    WITH {CHANGES}
    SELECT event_id, '+I' AS row_kind, CAST(user_id AS VARCHAR) AS id, k FROM chg WHERE op IN ('c', 'r')
    UNION ALL SELECT event_id, '-U', CAST(user_id AS VARCHAR), NULL FROM chg WHERE op = 'u'
    UNION ALL SELECT event_id, '+U', CAST(user_id AS VARCHAR), k FROM chg WHERE op = 'u'
    UNION ALL SELECT event_id, '-D', CAST(user_id AS VARCHAR), NULL FROM chg WHERE op = 'd'""")
def cdc_changelog_view(spark, sf):
    return ch.changelog_view(t.changes(_events(spark, sf))).select(
        "event_id", "row_kind", F.col("row")["user_id"].alias("id"), F.col("row")["k"].alias("k"))


CURRENT_STATE = f"""
    WITH {CHANGES}, placed AS (SELECT *, row_number() OVER (
        PARTITION BY user_id ORDER BY ts_ms DESC, event_id DESC) AS place FROM chg)
    SELECT CAST(user_id AS VARCHAR) AS pk, k, CAST(event_id AS VARCHAR) AS event_id
    FROM placed WHERE place = 1 AND op <> 'd'"""


@query("stream_cdc_current_state", CURRENT_STATE)
def stream_cdc_current_state(spark, sf):
    """The whole table in three micro-batches with a restart after each; which of them a change is
    in does not depend on its time, so many changes come after newer ones."""
    events, folder = _events(spark, sf), work_folder(spark, "state")
    for part in range(3):
        events.where(F.pmod("event_id", F.lit(3)) == part).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{folder}/in")
        run.start_per_batch(
            t.changes(stream), dimensions.sink_current_state(f"{folder}/out", "user_id", "event_id"),
            f"{folder}/checkpoint").awaitTermination()
    return dimensions.read_current_state(spark, f"{folder}/out").select(
        "pk", F.col("row")["k"].alias("k"), F.col("row")["event_id"].alias("event_id"))


@query("cdc_current_state", CURRENT_STATE)
def cdc_current_state(spark, sf):
    return ch.current_state(t.changes(_events(spark, sf)), "user_id", ["ts_ms", "event_id"]).select(
        "pk", F.col("row")["k"].alias("k"), F.col("row")["event_id"].alias("event_id"))


@query("src_json_table", f"""
    WITH {LG}
    SELECT mid, page_id, ts, strftime(t, {SECOND}) AS row_time FROM lg""")
def src_json_table(spark, sf):
    lines = sink_topics.as_json(_logs(spark, sf))
    src_topics.json_table(lines, schemas.PAGE_VIEW, src_topics.millis_row_time(),
                          view="page_view")
    return spark.sql("""
        SELECT common['mid'] AS mid, page['page_id'] AS page_id, ts,
               date_format(row_time, 'yyyy-MM-dd HH:mm:ss') AS row_time
        FROM page_view""")


@query("src_rule_table", f"""
    WITH {CHANGES}, placed AS (SELECT *, row_number() OVER (
        PARTITION BY event_type, op ORDER BY ts_ms DESC, event_id DESC) AS place
        FROM chg WHERE op <> 'd')
    SELECT event_type AS "sourceTable", op AS "operateType", 't_' || k AS "sinkTable" FROM placed
    WHERE place = 1""")
def src_rule_table(spark, sf):
    return src_changes.rule_table(_rule_changes(_events(spark, sf)), ["ts_ms", "event_id"]).select(
        "sourceTable", "operateType", "sinkTable")


def _rule_changes(events: DataFrame) -> DataFrame:
    """Each event as a change of the rule for its own table and operation."""
    changes = t.changes(events)
    after = F.create_map(
        F.lit("sourceTable"), F.col("source.table"), F.lit("operateType"), F.col("op"),
        F.lit("sinkType"), F.lit("kafka"),
        F.lit("sinkTable"), F.concat(F.lit("t_"), F.col("after")["k"]),
        F.lit("sinkColumns"), F.lit("user_id"))
    return changes.withColumn("after", after)


@query("parse_csv_line", """
    SELECT CAST(user_id AS VARCHAR) AS id, event_type, epoch_us(ts) // 1000000 AS ts,
           epoch_us(ts) // 1000000 * 1000 AS time_ms
    FROM events""")
def parse_csv_line(spark, sf):
    return src_lines.parse_csv_line(_plain_lines(_events(spark, sf)), "event_type").select(
        "id", "event_type", "ts", F.unix_millis("time").alias("time_ms"))


# --- Sinks -----------------------------------------------------------------------------------

@query("sink_topic", """
    SELECT '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"'
           || event_type || '"}' AS value FROM events""")
def sink_topic(spark, sf):
    folder = work_folder(spark, "sink-topic")
    topics = src_topics.Topics(folder=folder)
    rows = t.table_stream(spark, sf, "events").select("event_id", "user_id", "event_type")
    sink_topics.sink_topic(rows, topics, "dwd", f"{folder}/checkpoint", once=True).awaitTermination()
    return src_topics.read_topic(spark, topics, "dwd", streaming=False)


BY_ROW = f"""
    WITH {ROUTED}
    SELECT sink_table AS topic, CASE WHEN cols = 'user_id,k'
        THEN '{{"user_id":"' || user_id || '","k":"' || k || '"}}'
        ELSE '{{"user_id":"' || user_id || '","event_id":"' || event_id || '"}}' END AS value
    FROM routed WHERE sink_type = 'kafka'"""


@query("sink_topic_by_row", BY_ROW)
def sink_topic_by_row(spark, sf):
    folder = work_folder(spark, "by-row")
    topics = src_topics.Topics(folder=folder)
    changes = t.changes(t.table_stream(spark, sf, "events"))
    routed = ch.to_topics(ch.route_by_rule(ch.drop_deletes(changes), t.rules(spark)))
    sink_topics.sink_topic_by_row(routed, topics, f"{folder}/checkpoint", once=True) \
        .awaitTermination()
    return spark.read.schema("value STRING, topic STRING").text(topics.path("by_row"))


@query("sink_topic_by_row_restarted", BY_ROW)
def sink_topic_by_row_restarted(spark, sf):
    """The whole table in three micro-batches, committed one by one. The first fails once its lines
    are written, the second once they are committed; both run again."""
    events, folder = _events(spark, sf), work_folder(spark, "by-batch")
    origin, faults = f"{folder}/by_row", {0, 1}
    for part in range(3):
        events.where(F.pmod("event_id", F.lit(3)) == part).coalesce(1).write.mode("append").parquet(
            f"{folder}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", "1").parquet(
        f"{folder}/in")
    routed = ch.to_topics(ch.route_by_rule(ch.drop_deletes(t.changes(stream)), t.rules(spark)))

    def fail(batch_id: int) -> None:
        if batch_id in faults:
            faults.remove(batch_id)
            raise RuntimeError(f"fault in batch {batch_id}")

    def write(batch: DataFrame, batch_id: int) -> None:
        if committed.in_place(spark, origin, batch_id):
            return
        committed.stage_batch(sink_topics.by_row_lines(batch), origin, batch_id)
        if batch_id == 0:
            fail(batch_id)
        committed.commit_batch(spark, origin, batch_id)
        fail(batch_id)

    run.supervise(lambda: run.start_per_batch(routed, write, f"{folder}/checkpoint"), pause=0)
    return spark.read.schema("value STRING, batch_id BIGINT, topic STRING").text(origin).drop(
        "batch_id")


@query("sink_dim_upsert", f"""
    WITH {ROUTED}, d AS (SELECT * FROM routed WHERE sink_type = 'hbase')
    SELECT CAST(user_id AS VARCHAR) AS user_id,
           max_by(k, event_id) FILTER (cols = 'user_id,k') AS k,
           CAST(max(event_id) FILTER (cols = 'user_id,event_id') AS VARCHAR) AS event_id
    FROM d GROUP BY d.user_id""")
def sink_dim_upsert(spark, sf):
    folder = work_folder(spark, "dims")
    changes = t.changes(t.table_stream(spark, sf, "events"))
    routed = ch.to_dimensions(ch.route_by_rule(ch.drop_deletes(changes), t.rules(spark)))
    run.start_per_batch(routed, dimensions.sink_dim_upsert(f"{folder}/out", "event_id"),
                        f"{folder}/checkpoint").awaitTermination()
    return dimensions.read_dimension(spark, f"{folder}/out", "dim_user",
                                      ["user_id", "k", "event_id"])


@query("sink_replacing", f"""
    WITH placed AS (SELECT date_trunc('day', ts) AS d, user_id, event_id,
        CAST(value AS DECIMAL(16,2)) AS amount, row_number() OVER (
            PARTITION BY date_trunc('day', ts), user_id ORDER BY event_id DESC) AS place
        FROM events)
    SELECT strftime(d, {SECOND}) AS stt, user_id, amount, event_id AS ts FROM placed WHERE place = 1""")
def sink_replacing(spark, sf):
    """A report written twice: the second batch holds newer versions of every key."""
    folder = work_folder(spark, "replacing")
    rows = _events(spark, sf).select(
        times.second_text(F.date_trunc("day", "ts")).alias("stt"), "user_id",
        F.col("value").cast("decimal(16,2)").alias("amount"), F.col("event_id").alias("ts"))
    older = rows.withColumn("amount", F.lit(0).cast("decimal(16,2)")).withColumn(
        "ts", F.col("ts") - 1_000_000_000)
    sink_tables.sink_replacing(older, folder, 0)
    sink_tables.sink_replacing(rows, folder, 1)
    return sink_tables.read_replacing(spark, folder, ["stt", "user_id"])


# --- Projections, filters --------------------------------------------------------------------

@query("split_dirty", f"""
    WITH {LG}
    SELECT event_id AS id, 'event' AS kind, event_type = 'error' AS dirty,
           CASE WHEN event_type <> 'error' THEN mid END AS mid FROM lg
    UNION ALL SELECT conv_id * 1000 + turn, 'talk', true, NULL FROM conversations""")
def split_dirty(spark, sf):
    talk = t.table(spark, sf, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.lit("talk").alias("kind"),
        F.col("text").alias("value"))
    lines = t.log_lines(_events(spark, sf)).select(
        F.col("event_id").alias("id"), F.lit("event").alias("kind"), "value")
    clean, dirty = lg.split_dirty(lines.unionByName(talk), schemas.LOG)
    return clean.select("id", "kind", F.lit(False).alias("dirty"),
                        F.col("common.mid").alias("mid")).unionByName(
        dirty.select("id", "kind", F.lit(True).alias("dirty"),
                     F.lit(None).cast("string").alias("mid")))


@query("route_start", f"""
    WITH {LG} SELECT event_id, mid, 'icon' AS entry, CAST(k AS BIGINT) AS loading_time, ts
    FROM lg WHERE event_type = 'signup'""")
def route_start(spark, sf):
    return lg.route_start(_logs(spark, sf)).select(
        "event_id", F.col("common.mid").alias("mid"), F.col("start.entry").alias("entry"),
        F.col("start.loading_time").alias("loading_time"), "ts")


@query("route_page", f"""
    WITH {LG} SELECT event_id, mid, page_id, last_page_id, item, during_time,
        CASE WHEN event_type = 'view' THEN 3 ELSE 0 END AS n_displays, ts
    FROM lg WHERE event_type <> 'signup'""")
def route_page(spark, sf):
    return lg.route_page(_logs(spark, sf)).select(
        "event_id", F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"),
        F.col("page.last_page_id").alias("last_page_id"), F.col("page.item").alias("item"),
        F.col("page.during_time").alias("during_time"),
        F.coalesce(F.array_size("displays"), F.lit(0)).alias("n_displays"), "ts")


DISPLAYS = """shown AS (
    SELECT 'query' AS display_type, k AS item, 'sku_id' AS item_type, 1 AS place, ts
    FROM lg WHERE event_type = 'view'
    UNION ALL SELECT 'activity', CAST(user_id AS VARCHAR), 'activity_id', 2, ts
    FROM lg WHERE event_type = 'view'
    UNION ALL SELECT 'promotion', CAST(user_id AS VARCHAR), 'sku_id', 3, ts
    FROM lg WHERE event_type = 'view')"""


@query("explode_display", f"""
    WITH {LG}, {DISPLAYS}
    SELECT display_type, item, item_type, CAST(place AS BIGINT) AS place,
           CAST(place AS BIGINT) AS pos_id, 'home' AS page_id FROM shown""")
def explode_display(spark, sf):
    return lg.explode_display(_pages(spark, sf)).withColumnRenamed("order", "place")


@query("drop_deletes", f"WITH {CHANGES} SELECT event_id, op FROM chg WHERE op <> 'd'")
def drop_deletes(spark, sf):
    return ch.drop_deletes(t.changes(_events(spark, sf))).select("event_id", "op")


@query("prune_sink_columns", f"""
    WITH {CHANGES} SELECT event_id,
        CASE op WHEN 'u' THEN 'event_id,user_id' WHEN 'd' THEN NULL ELSE 'k,user_id' END AS names
    FROM chg""")
def prune_sink_columns(spark, sf):
    listed = F.when(F.col("op") == "u", "user_id,event_id,other").otherwise("user_id,k")
    pruned = ch.prune_sink_columns(t.changes(_events(spark, sf)).withColumn("sinkColumns", listed))
    return pruned.select("event_id", F.when(F.col("after").isNotNull(), F.array_join(
        F.array_sort(F.map_keys("after")), ",")).alias("names"))


@query("is_session_entry", f"WITH {LG} SELECT event_id, entry FROM lg WHERE event_type <> 'signup'")
def is_session_entry(spark, sf):
    return _pages(spark, sf).select("event_id", lg.is_session_entry().alias("entry"))


@query("proj_order_info", f"""
    SELECT {ORDER_COLUMNS}, epoch_us(o_orderdate) // 1000 AS create_ts FROM orders""")
def proj_order_info(spark, sf):
    return od.with_order_times(t.order_info(t.table(spark, sf, "orders"))).select(
        F.col("id").alias("order_id"), "province_id", "order_status", "user_id", "total_amount",
        "create_time", "create_date", "create_hour", "create_ts")


@query("proj_order_detail", f"""
    SELECT l_orderkey AS order_id, {DETAIL_COLUMNS}, epoch_us(l_shipdate) // 1000 AS create_ts
    FROM lineitem""")
def proj_order_detail(spark, sf):
    return od.with_detail_times(t.order_detail(t.table(spark, sf, "lineitem"))).select(
        "order_id", F.col("id").alias("detail_id"), "sku_id", "order_price", "sku_num",
        "split_total_amount", "create_ts")


@query("merge_order_wide", f"""
    SELECT {ORDER_COLUMNS}, {DETAIL_COLUMNS}, {NULLS}
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def merge_order_wide(spark, sf):
    orders = od.with_order_times(t.order_info(t.table(spark, sf, "orders")))
    details = t.order_detail(t.table(spark, sf, "lineitem"))
    joined = orders.select(F.col("id").alias("ok"), F.struct(*orders.columns).alias("o")).join(
        details.select(F.col("order_id").alias("dk"), F.struct(*details.columns).alias("d")),
        F.col("ok") == F.col("dk"))
    return od.merge_order_wide(joined).select(*WIDE, "expire_time", "operate_time")


PAYMENT_COLUMNS = f"""o_orderkey AS payment_id, o_orderpriority AS subject, '1101' AS payment_type,
    strftime(o_orderdate, {SECOND}) AS payment_create_time, o_orderkey AS order_id,
    o_custkey AS user_id, CAST(floor(o_totalprice) AS DECIMAL(16,2)) AS total_amount,
    strftime(l_shipdate, {SECOND}) AS order_create_time, {DETAIL_COLUMNS},
    CAST(NULL AS VARCHAR) AS callback_time"""
PAYMENT = ["payment_id", "subject", "payment_type", "payment_create_time", "order_id", "user_id",
           "total_amount", "order_create_time", "detail_id", "sku_id", "order_price", "sku_num",
           "split_total_amount", "callback_time"]


@query("merge_payment_wide", f"""
    SELECT {PAYMENT_COLUMNS} FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def merge_payment_wide(spark, sf):
    payments = t.payment_info(t.table(spark, sf, "orders"))
    wide = _wide_lines(spark, sf)
    joined = payments.select(F.col("order_id").alias("pk"),
                             F.struct(*payments.columns).alias("p")).join(
        wide.select(F.col("order_id").alias("wk"), F.struct(*wide.columns).alias("w")),
        F.col("pk") == F.col("wk"))
    return od.merge_payment_wide(joined).select(*PAYMENT)


VISITOR = "k AS ar, ch, is_new, vc, ts"


@query("proj_visitor_uv", f"""
    WITH {LG} SELECT {VISITOR}, 1 AS uv_ct, 0 AS pv_ct, 0 AS sv_ct, 0 AS uj_ct, 0 AS dur_sum
    FROM lg WHERE event_type <> 'signup'""")
def proj_visitor_uv(spark, sf):
    return lg.visitor_uv(_pages(spark, sf))


@query("proj_visitor_uj", f"""
    WITH {LG} SELECT {VISITOR}, 0 AS uv_ct, 0 AS pv_ct, 0 AS sv_ct, 1 AS uj_ct, 0 AS dur_sum
    FROM lg WHERE event_type <> 'signup'""")
def proj_visitor_uj(spark, sf):
    return lg.visitor_uj(_pages(spark, sf))


PV = f"""SELECT {VISITOR}, 0 AS uv_ct, 1 AS pv_ct, CAST(entry AS INTEGER) AS sv_ct, 0 AS uj_ct,
    during_time AS dur_sum"""


@query("proj_visitor_pv", f"WITH {LG} {PV} FROM lg WHERE event_type <> 'signup'")
def proj_visitor_pv(spark, sf):
    return lg.visitor_pv(_pages(spark, sf))


def _measure_sql(source: str, sku: str, ts: str, kind: str = "NULL", ref: str = "NULL",
                 **measures: str) -> str:
    counts = ", ".join(f"CAST({measures.get(c, 0)} AS BIGINT) AS {c}" for c in products.COUNTS)
    amounts = ", ".join(f"CAST({measures.get(c, 0)} AS DECIMAL(16,2)) AS {c}"
                        for c in products.AMOUNTS)
    kind = f"'{kind}'" if kind != "NULL" else kind
    return (f"SELECT CAST({sku} AS BIGINT) AS sku_id, {counts}, {amounts}, "
            f"CAST({kind} AS VARCHAR) AS order_kind, CAST({ref} AS BIGINT) AS order_ref, "
            f"{ts} AS ts FROM {source}")


EVENT_SECOND = "epoch_us(t) // 1000000 * 1000"
SHIP = "epoch_us(l_shipdate) // 1000"
PRICE = "l_extendedprice"
CLICK_SQL = _measure_sql("lg WHERE event_type = 'click'", "k", "ts", click_ct="1")
DISPLAY_SQL = _measure_sql("shown WHERE item_type = 'sku_id'", "item", "ts", display_ct="1")
FAVOR_SQL = _measure_sql("lg", "k", EVENT_SECOND, favor_ct="1")
CART_SQL = _measure_sql("lg", "user_id", EVENT_SECOND, cart_ct="1")
ORDER_SQL = _measure_sql("lineitem", "l_partkey", SHIP, "order", "l_orderkey",
                         order_sku_num="l_quantity", order_amount=PRICE)
PAYMENT_SQL = _measure_sql(
    "orders JOIN lineitem ON o_orderkey = l_orderkey", "l_partkey",
    "epoch_us(o_orderdate) // 1000", "paid", "o_orderkey", payment_amount=PRICE)
REFUND_SQL = _measure_sql("lineitem WHERE l_returnflag = 'R'", "l_partkey", SHIP, "refund",
                          "l_orderkey", refund_amount=PRICE)
COMMENT_SQL = _measure_sql("labels", "doc_id", "doc_id * 1000", comment_ct="1",
                           good_comment_ct="CASE WHEN quality = 1 THEN 1 ELSE 0 END")


def _favors(spark, sf):
    return _events(spark, sf).select(F.get_json_object("props", "$.k").cast("bigint")
                                     .alias("sku_id"), times.second_text(F.col("ts")).alias("create_time"))


def _carts(spark, sf):
    return _events(spark, sf).select(F.col("user_id").alias("sku_id"),
                                     times.second_text(F.col("ts")).alias("create_time"))


def _payment_wide(spark, sf):
    orders, lines = t.table(spark, sf, "orders"), t.table(spark, sf, "lineitem")
    return orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("l_partkey").alias("sku_id"), F.col("o_orderkey").alias("order_id"),
        F.col("l_extendedprice").cast("decimal(16,2)").alias("order_price"),
        times.second_text(F.col("o_orderdate")).alias("payment_create_time"))


def _refunds(spark, sf):
    return t.table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("sku_id"),
        F.col("l_extendedprice").cast("decimal(16,2)").alias("refund_amount"),
        times.second_text(F.col("l_shipdate")).alias("create_time"))


def _comments(spark, sf):
    return t.table(spark, sf, "labels").select(
        F.col("doc_id").alias("sku_id"),
        F.when(F.col("quality") == 1, "1201").otherwise("1203").alias("appraise"),
        times.second_text(F.timestamp_seconds("doc_id")).alias("create_time"))


@query("proj_click", f"WITH {LG} {CLICK_SQL}")
def proj_click(spark, sf):
    return products.product_click(_pages(spark, sf))


@query("proj_display", f"WITH {LG}, {DISPLAYS} {DISPLAY_SQL}")
def proj_display(spark, sf):
    return products.product_display(_pages(spark, sf))


@query("proj_favor", f"WITH {LG} {FAVOR_SQL}")
def proj_favor(spark, sf):
    return products.product_favor(_favors(spark, sf))


@query("proj_cart", f"WITH {LG} {CART_SQL}")
def proj_cart(spark, sf):
    return products.product_cart(_carts(spark, sf))


@query("proj_order", ORDER_SQL)
def proj_order(spark, sf):
    return products.product_order(_wide_lines(spark, sf))


@query("proj_payment", PAYMENT_SQL)
def proj_payment(spark, sf):
    return products.product_payment(_payment_wide(spark, sf))


@query("proj_refund", REFUND_SQL)
def proj_refund(spark, sf):
    return products.product_refund(_refunds(spark, sf))


@query("proj_comment", COMMENT_SQL)
def proj_comment(spark, sf):
    return products.product_comment(_comments(spark, sf))


@query("filter_search", f"""
    WITH {LG} SELECT item AS full_word, strftime(t, {SECOND}) AS row_time
    FROM lg WHERE event_type = 'click'""")
def filter_search(spark, sf):
    lines = sink_topics.as_json(_logs(spark, sf))
    views = src_topics.json_table(lines, schemas.PAGE_VIEW, src_topics.millis_row_time())
    return lg.filter_search(views).select(
        "full_word", times.second_text(F.col("row_time")).alias("row_time"))


@query("user_age", f"""
    SELECT 'user' AS kind, c_custkey AS id, user_age FROM customer JOIN (WITH {DIMS} SELECT * FROM u)
    ON id = c_custkey
    UNION ALL SELECT 'order', o_orderkey, CAST((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(o_orderdate))
        // 1000 // 31536000000 AS INTEGER) FROM orders""")
def user_age(spark, sf):
    users = t.dimensions(spark, sf)["dim_user_info"].select(
        F.lit("user").alias("kind"), F.col("id").cast("bigint").alias("id"), "birthday")
    orders = t.table(spark, sf, "orders").select(
        F.lit("order").alias("kind"), F.col("o_orderkey").alias("id"),
        times.second_text(F.col("o_orderdate")).alias("birthday"))
    return users.unionByName(orders).select(
        "kind", "id", times.age_in_years(F.col("birthday"), _as_of()).alias("user_age"))


@query("snake_to_camel", """
    SELECT o_orderkey AS "oOrderkey", o_custkey AS "oCustkey", o_orderstatus AS "oOrderstatus"
    FROM orders""")
def snake_to_camel_query(spark, sf):
    return snake_to_camel(t.table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus"))


@query("scalar_functions", f"""
    SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, {SECOND}) AS second,
           epoch_us(ts) // 1000000 * 1000 AS millis, epoch_us(date_trunc('day', ts)) // 1000 AS day_millis,
           upper(event_type) || ',' || user_id AS joined
    FROM events""")
def scalar_functions(spark, sf):
    second = times.second_text(times.millis_to_time(F.unix_millis("ts")))
    day = times.day_text(times.millis_to_time(F.unix_millis("ts")))
    return _events(spark, sf).select(
        "event_id", day.alias("day"), second.alias("second"),
        times.text_to_millis(second).alias("millis"), times.text_to_millis(day).alias("day_millis"),
        F.concat_ws(",", F.upper("event_type"), "user_id").alias("joined"))


# --- Joins -----------------------------------------------------------------------------------

@query("ijoin_order_detail", f"""
    WITH {_wide_sql('-5 days', '5 days')} SELECT *, {NULLS} FROM wide""")
def ijoin_order_detail(spark, sf):
    return od.join_order_detail(
        t.order_info(t.table(spark, sf, "orders")), t.order_detail(t.table(spark, sf, "lineitem")),
        timedelta(days=-5), timedelta(days=5)).select(*WIDE, "expire_time", "operate_time")


@query("ijoin_payment_order", f"""
    SELECT {PAYMENT_COLUMNS} FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    AND l_shipdate BETWEEN o_orderdate - INTERVAL 15 DAY AND o_orderdate + INTERVAL 10 DAY""")
def ijoin_payment_order(spark, sf):
    return od.join_payment_order(
        t.payment_info(t.table(spark, sf, "orders")), _wide_lines(spark, sf),
        timedelta(days=-15), timedelta(days=10)).select(*PAYMENT)


def _demo_sql(low: str, high: str) -> str:
    return f"""
    WITH e AS (SELECT *, epoch_us(ts) // 1000000 AS s FROM events)
    SELECT CAST(l.user_id AS VARCHAR) AS id, l.s AS left_ts, r.s AS right_ts
    FROM e l JOIN e r ON l.user_id = r.user_id AND l.event_type = 'view'
    AND r.event_type = 'purchase' AND r.s - l.s {low} AND r.s - l.s {high}"""


def _demo_sides(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    lines = _plain_lines(events)
    sides = src_lines.parse_csv_line(lines, "kind")
    return (sides.where("kind = 'view'").select(
                F.col("id").alias("left_id"), F.col("ts").alias("left_ts"),
                F.col("time").alias("left_time")),
            sides.where("kind = 'purchase'").select(
                F.col("id").alias("right_id"), F.col("ts").alias("right_ts"),
                F.col("time").alias("right_time")))


@query("ijoin_demo", _demo_sql(">= -3600", "<= 3600"))
def ijoin_demo(spark, sf):
    left, right = _demo_sides(_events(spark, sf))
    return joins.interval_join(
        left, right, "left_id", "right_id", "left_time", "right_time",
        timedelta(hours=-1), timedelta(hours=1)).select(
        F.col("left_id").alias("id"), "left_ts", "right_ts")


@query("ijoin_exclusive_salted", _demo_sql("> -3600", "< 7200"))
def ijoin_exclusive_salted(spark, sf):
    left, right = _demo_sides(_events(spark, sf))
    return joins.interval_join(
        left, right, "left_id", "right_id", "left_time", "right_time",
        timedelta(hours=-1), timedelta(hours=2), lower_inclusive=False, upper_inclusive=False,
        salts=4).select(F.col("left_id").alias("id"), "left_ts", "right_ts")


@query("stream_ijoin", _demo_sql(">= -3600", "<= 3600"))
def stream_ijoin(spark, sf):
    left, right = _demo_sides(t.table_stream(spark, sf, "events"))
    joined = joins.interval_join(
        left.withWatermark("left_time", "0 seconds"), right.withWatermark("right_time", "0 seconds"),
        "left_id", "right_id", "left_time", "right_time",
        timedelta(hours=-1), timedelta(hours=1))
    return run.drain(joined.select(F.col("left_id").alias("id"), "left_ts", "right_ts"), "ijoin")


def _dim_query(name: str, key: str, attributes: list[str], lookups: str, lines: bool) -> None:
    """One lookup on whole orders or lines. Products go through the stock unit first."""
    source = "lineitem" if lines else "orders"
    ids = "l_orderkey AS id, l_linenumber AS line" if lines else "o_orderkey AS id, 0 AS line"

    @query(name, f"WITH {DIMS} SELECT {ids}, {', '.join(attributes)} FROM {source} {lookups}")
    def lookup(spark, sf):
        dims = t.dimensions(spark, sf)
        if not lines:
            rows = t.order_info(t.table(spark, sf, "orders")).select(
                "id", F.lit(0).alias("line"), "user_id", "province_id")
        else:
            rows = t.table(spark, sf, "lineitem").select(
                F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"),
                F.col("l_partkey").alias("sku_id"))
            rows = joins.dim_join(rows, dims["dim_sku_info"], "sku_id", {
                "sku_name": "sku_name", "sku_price": F.col("price").try_cast("decimal(16,2)"),
                **od.sku_links()})
        columns = {
            "dim_user": ("dim_user_info", {
                "user_age": times.age_in_years(F.col("birthday"), _as_of()),
                "user_gender": "gender"}),
            "dim_province": ("dim_base_province", {
                "province_name": "name", "province_area_code": "area_code",
                "province_iso_code": "iso_code", "province_3166_2_code": "iso_3166_2"}),
            "dim_spu": ("dim_spu_info", {"spu_name": "spu_name"}),
            "dim_trademark": ("dim_base_trademark", {"tm_name": "tm_name"}),
            "dim_category3": ("dim_base_category3", {"category3_name": "name"}),
        }
        if name in columns:
            table, picked = columns[name]
            rows = joins.dim_join(rows, dims[table], key, picked)
        return rows.select("id", "line", *attributes)


_dim_query("dim_user", "user_id", ["user_age", "user_gender"],
           "LEFT JOIN u ON u.id = o_custkey", False)
_dim_query("dim_province", "province_id",
           ["province_name", "province_area_code", "province_iso_code", "province_3166_2_code"],
           "LEFT JOIN pv ON pv.id = o_custkey % 25", False)
_SKU = "LEFT JOIN sku ON sku.id = l_partkey"
_dim_query("dim_sku", "sku_id", ["sku_name", "sku_price", "category3_id", "spu_id", "tm_id"],
           _SKU, True)
_dim_query("dim_spu", "spu_id", ["spu_name"], f"{_SKU} LEFT JOIN spu ON spu.id = sku.spu_id", True)
_dim_query("dim_trademark", "tm_id", ["tm_name"],
           f"{_SKU} LEFT JOIN tm ON tm.id = sku.tm_id", True)
_dim_query("dim_category3", "category3_id", ["category3_name"],
           f"{_SKU} LEFT JOIN c3 ON c3.id = sku.category3_id", True)


@query("dim_join", """
    SELECT l_orderkey AS id, l_linenumber AS line, s_name AS supplier_name,
           CAST(s_nationkey AS BIGINT) AS nation_id
    FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey AND s_nationkey > 4""")
def dim_join(spark, sf):
    """Any table serves as dimension; suppliers of the first nations are missing here. The
    lookup goes the way of a dimension too large to broadcast."""
    suppliers = t.table(spark, sf, "supplier").where("s_nationkey > 4")
    lines = t.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"), "l_suppkey")
    return joins.dim_join(lines, suppliers, "l_suppkey", {
        "supplier_name": "s_name", "nation_id": F.col("s_nationkey").cast("bigint")},
        dim_key="s_suppkey", max_broadcast_bytes=0, salts=4).drop("l_suppkey")


@query("route_by_rule", f"""
    WITH {ROUTED}
    SELECT event_id, sink_type, sink_table, CASE cols WHEN 'user_id,k' THEN 'k,user_id'
        ELSE 'event_id,user_id' END AS names FROM routed""")
def route_by_rule(spark, sf):
    routed = ch.route_by_rule(ch.drop_deletes(t.changes(_events(spark, sf))), t.rules(spark))
    return routed.select("event_id", "sink_type", "sink_table", F.array_join(
        F.array_sort(F.map_keys("after")), ",").alias("names"))


@query("rule_upsert", f"""
    WITH {CHANGES}, placed AS (SELECT *, row_number() OVER (
        PARTITION BY event_type, op ORDER BY event_id DESC) AS place FROM chg)
    SELECT event_type AS "sourceTable", op AS "operateType", event_id FROM placed WHERE place = 1""")
def rule_upsert(spark, sf):
    rules = t.changes(_events(spark, sf)).select(
        F.col("source.table").alias("sourceTable"), F.col("op").alias("operateType"), "event_id")
    return ch.latest_rules(rules, ["event_id"])


# --- Statistics ------------------------------------------------------------------------------

JUMPS = f"uj AS ({_jumps_sql('pages', HOUR_MS)}), uv AS ({_visits_sql('pages')})"
VISITOR_UNION = f"""{LG}, pages AS (SELECT * FROM lg WHERE event_type <> 'signup'), {JUMPS},
    rows AS (
    SELECT {VISITOR}, 1 AS uv_ct, 0 AS pv_ct, 0 AS sv_ct, 0 AS uj_ct, 0 AS dur_sum FROM uv
    UNION ALL SELECT {VISITOR}, 0, 0, 0, 1, 0 FROM uj
    UNION ALL {PV} FROM pages)"""


def _visitor_sources(spark, sf):
    pages = _pages(spark, sf)
    return (visits.unique_visit(pages, ORDER), visits.user_jump(pages, ORDER, HOUR_MS), pages)


def _bound_sql(ts: str, width_ms: int) -> str:
    start = f"({ts} // {width_ms}) * {width_ms}"
    return (f"strftime(make_timestamp({start} * 1000), {SECOND}) AS stt, "
            f"strftime(make_timestamp(({start} + {width_ms}) * 1000), {SECOND}) AS edt")


VISITOR_SUMS = ", ".join(f"CAST(sum({m}) AS BIGINT) AS {m}"
                         for m in ["uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum"])
DAY_MS = 24 * HOUR_MS


@query("visitor_stats", f"""
    WITH {VISITOR_UNION}
    SELECT {_bound_sql('ts', DAY_MS)}, vc, ch, ar, is_new, {VISITOR_SUMS}, min(ts) AS ts
    FROM rows GROUP BY ts // {DAY_MS}, vc, ch, ar, is_new, stt, edt""".replace(", stt, edt", ""))
def visitor_stats(spark, sf):
    return jobs.job_visitor_stats(*_visitor_sources(spark, sf), width="1 day")


PRODUCT_UNION = f"""{LG}, {DISPLAYS}, rows AS ({' UNION ALL '.join([
    CLICK_SQL, DISPLAY_SQL, FAVOR_SQL, CART_SQL, ORDER_SQL, PAYMENT_SQL, REFUND_SQL,
    COMMENT_SQL])})"""


def _product_sources(spark, sf):
    return (_pages(spark, sf), _favors(spark, sf), _carts(spark, sf), _wide_lines(spark, sf),
            _payment_wide(spark, sf), _refunds(spark, sf), _comments(spark, sf))


MONTH_MS = 30 * DAY_MS
PRODUCT_SUMS = ", ".join(
    [f"CAST(sum({m}) AS BIGINT) AS {m}" for m in products.COUNTS]
    + [f"CAST(sum({m}) AS DECIMAL(28,2)) AS {m}" for m in products.AMOUNTS]
    + [f"count(DISTINCT order_ref) FILTER (order_kind = '{kind}') AS {name}" for kind, name in
       [("order", "order_ct"), ("paid", "paid_order_ct"), ("refund", "refund_order_ct")]])
PRODUCT_GROUP = f"""SELECT {_bound_sql('ts', MONTH_MS)}, sku_id, {PRODUCT_SUMS}, min(ts) AS ts
    FROM rows GROUP BY ts // {MONTH_MS}, sku_id"""


@query("product_stats", f"WITH {PRODUCT_UNION} {PRODUCT_GROUP}")
def product_stats(spark, sf):
    return stats.product_stats(products.union_product(*_product_sources(spark, sf)), "30 days")


@query("union_product", f"WITH {PRODUCT_UNION} SELECT * FROM rows")
def union_product(spark, sf):
    return products.union_product(*_product_sources(spark, sf))


@query("union_visitor", f"WITH {VISITOR_UNION} SELECT * FROM rows")
def union_visitor(spark, sf):
    return lg.union_visitor(*_visitor_sources(spark, sf))


PROVINCE_ROWS = f"""placed AS (SELECT n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS area,
        o_orderkey, CAST(l_extendedprice AS DECIMAL(16,2)) AS amount, epoch_us(o_orderdate) // 1000 AS ts
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey)"""
PROVINCE_SQL = f"""
    WITH {PROVINCE_ROWS}
    SELECT {_bound_sql('ts', 7 * DAY_MS)}, CAST(n_nationkey AS BIGINT) AS province_id,
           n_name AS province_name, area AS province_area_code, 'CN-' || n_nationkey AS province_iso_code,
           'ISO-' || n_nationkey AS province_3166_2_code, CAST(sum(amount) AS DECIMAL(28,2)) AS order_amount,
           count(DISTINCT o_orderkey) AS order_count
    FROM placed GROUP BY ts // {7 * DAY_MS}, n_nationkey, n_name, area"""


def _province_rows(spark, sf):
    """Orders with the sum of their lines and the province of the customer, at the order's time."""
    lines, orders = t.table(spark, sf, "lineitem"), t.table(spark, sf, "orders")
    customer = t.table(spark, sf, "customer")
    # one row per order before the joins: a hot customer then has its orders, not their lines
    sums = lines.groupBy("l_orderkey").agg(F.sum(
        F.col("l_extendedprice").cast("decimal(16,2)")).cast("decimal(16,2)").alias("l_amount"))
    rows = (
        sums.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .select(F.col("c_nationkey").cast("bigint").alias("province_id"),
                F.col("o_orderkey").alias("order_id"),
                F.col("l_amount").alias("split_total_amount"),
                times.second_text(F.col("o_orderdate")).alias("create_time"))
    )
    return joins.dim_join(rows, t.dimensions(spark, sf)["dim_base_province"], "province_id", {
        "province_name": "name", "province_area_code": "area_code",
        "province_iso_code": "iso_code", "province_3166_2_code": "iso_3166_2"})


@query("province_stats", PROVINCE_SQL)
def province_stats(spark, sf):
    return stats.province_stats(_province_rows(spark, sf), "7 days").drop("ts")


@query("province_stats_sql", PROVINCE_SQL)
def province_stats_sql(spark, sf):
    _province_rows(spark, sf).withColumn(
        "row_time", times.text_to_time(F.col("create_time"))).createOrReplaceTempView("order_wide")
    return stats.province_stats_sql(spark, "order_wide", "7 days").drop("ts")


@query("stream_province_stats_sql", PROVINCE_SQL)
def stream_province_stats_sql(spark, sf):
    """The report as SQL over a stream of JSON lines, one per order line, in three rounds."""
    orders = _province_rows(spark, sf).drop("split_total_amount")
    lines = t.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_extendedprice").cast("decimal(16,2)").alias("split_total_amount"))
    wide = orders.join(lines, "order_id")
    texts = wide.select(
        F.unix_millis(times.text_to_time(F.col("create_time"))).alias("ts"),
        F.to_json(F.struct(*wide.columns)).alias("value"))

    def build(stream: DataFrame) -> DataFrame:
        src_topics.json_table(stream, schemas.ORDER_WIDE, times.text_to_time(F.col("create_time")),
                              "1 second", "order_wide_stream")
        return stats.province_stats_sql(spark, "order_wide_stream", "7 days").drop("ts")

    return _in_rounds(spark, {"lines": texts},
                      {"value": F.lit('{"create_time":"2100-01-01 00:00:00"}')}, build, "provinces")


WORDS = r"regexp_extract_all(text, '[A-Za-z0-9]+|\p{Han}+')"
KEYWORD_SQL = f"""
    WITH w AS (SELECT doc_id * 1000 AS ts, unnest({WORDS}) AS keyword FROM documents)
    SELECT {_bound_sql('ts', 10_000)}, keyword, 'SEARCH' AS source, count(*) AS ct,
           epoch_us(TIMESTAMP '{AS_OF}') // 1000 AS ts
    FROM w GROUP BY w.ts // 10000, keyword""".replace("(ts //", "(w.ts //")


@query("keyword_stats", KEYWORD_SQL)
def keyword_stats(spark, sf):
    searches = t.table(spark, sf, "documents").select(
        F.col("text").alias("full_word"), F.timestamp_seconds("doc_id").alias("row_time"))
    return stats.keyword_stats(searches, as_of=_as_of())


@query("split_words", f"""
    WITH w AS (SELECT doc_id, unnest({WORDS}) AS word FROM documents)
    SELECT doc_id, word, count(*) AS n FROM w GROUP BY doc_id, word""")
def split_words(spark, sf):
    words.register_split_words(spark)
    t.table(spark, sf, "documents").createOrReplaceTempView("search_text")
    return spark.sql("""
        SELECT d.doc_id, w.word, count(*) AS n
        FROM search_text d, LATERAL split_words(d.text) w GROUP BY d.doc_id, w.word""")


# --- Visits, batch and streams ---------------------------------------------------------------

REPAIRED_SQL = f"WITH {FIXED} SELECT event_id, repaired AS is_new FROM fixed"
VISIT_SQL = f"""WITH {LG}, pages AS (SELECT * FROM lg WHERE event_type <> 'signup')
    SELECT event_id, mid, ts FROM ({_visits_sql('pages')})"""
JUMP_SQL = f"""WITH {LG}, pages AS (SELECT * FROM lg WHERE event_type <> 'signup')
    SELECT event_id, mid, ts FROM ({_jumps_sql('pages', HOUR_MS)})"""


def _row_id(df: DataFrame) -> DataFrame:
    return df.select("event_id", F.col("common.mid").alias("mid"), "ts")


@query("repair_is_new", REPAIRED_SQL)
def repair_is_new(spark, sf):
    return visits.repair_is_new(_logs(spark, sf), ORDER).select(
        "event_id", F.col("common.is_new").alias("is_new"))


@query("unique_visit", VISIT_SQL)
def unique_visit(spark, sf):
    return _row_id(visits.unique_visit(_pages(spark, sf), ORDER))


@query("user_jump", JUMP_SQL)
def user_jump(spark, sf):
    return _row_id(visits.user_jump(_pages(spark, sf), ORDER, HOUR_MS))


@query("union_jump", f"""WITH {LG}, pages AS (SELECT * FROM lg WHERE event_type <> 'signup')
    SELECT event_id, CASE WHEN next_ts < ts + {HOUR_MS} THEN 'matched' ELSE 'timed out' END AS reason
    FROM ({_jumps_sql('pages', HOUR_MS)})""")
def union_jump(spark, sf):
    entries = visits.with_next(_pages(spark, sf), ORDER, HOUR_MS)
    return visits.matched_jumps(entries).select("event_id", F.lit("matched").alias("reason")) \
        .unionByName(visits.timed_out_jumps(entries).select(
            "event_id", F.lit("timed out").alias("reason")))


@query("stream_repair_is_new", REPAIRED_SQL)
def stream_repair_is_new(spark, sf):
    repaired = state.repair_is_new_stream(_log_stream(spark, sf), "event_id")
    return run.drain(repaired.select("event_id", F.col("common.is_new").alias("is_new")), "repair")


@query("stream_unique_visit", f"""WITH {LG}, pages AS (SELECT * FROM lg WHERE event_type <> 'signup')
    SELECT event_id, mid, strftime(t, '%Y-%m-%d') AS day FROM ({_visits_sql('pages')})""")
def stream_unique_visit(spark, sf):
    visit = state.unique_visit_stream(_page_stream(spark, sf), "event_id")
    return run.drain(visit.select(
        "event_id", F.col("common.mid").alias("mid"),
        times.day_text(F.timestamp_millis("ts")).alias("day")), "visit")


@query("stream_user_jump", f"""WITH {LG}, pages AS (SELECT * FROM lg WHERE event_type <> 'signup')
    SELECT event_id, mid, ts FROM ({_jumps_sql('pages', HOUR_MS)})""")
def stream_user_jump(spark, sf):
    return _in_rounds(
        spark, {"pages": _pages(spark, sf)},
        {"common": F.col("common").withField("mid", F.lit("sentinel"))},
        lambda pages: _row_id(state.user_jump_stream(pages, "event_id", HOUR_MS, shards=8)), "jump", 1)


def _closed(width_ms: int, delay_us: int, source: str = "events", where: str = "true") -> str:
    """Windows that a watermark ``delay_us`` behind the last event has closed."""
    return f"""
    SELECT {_bound_sql('(epoch_us(ts) // 1000)', width_ms)}, event_type, count(*) AS n
    FROM {source} WHERE {where} GROUP BY epoch_us(ts) // 1000 // {width_ms}, event_type
    HAVING (epoch_us(any_value(ts)) // 1000 // {width_ms} + 1) * {width_ms}
           <= (SELECT (max(epoch_us(ts)) - {delay_us}) // 1000 FROM events)"""


def _window_counts(events: DataFrame, width: str) -> DataFrame:
    return events.groupBy(F.window("ts", width).alias("window"), "event_type").agg(
        F.count("*").alias("n")).select(
        times.second_text(F.col("window.start")).alias("stt"),
        times.second_text(F.col("window.end")).alias("edt"), "event_type", "n")


def _drain_windows(spark, sf, delay: str, width: str, name: str) -> DataFrame:
    events = t.table_stream(spark, sf, "events").withWatermark("ts", delay)
    return run.drain(_window_counts(events, width), name)


@query("wm_bounded", _closed(HOUR_MS, 12_000_000))
def wm_bounded(spark, sf):
    return _drain_windows(spark, sf, "12 seconds", "1 hour", "wm-bounded")


@query("wm_monotonic", _closed(HOUR_MS, 0))
def wm_monotonic(spark, sf):
    return _drain_windows(spark, sf, "0 seconds", "1 hour", "wm-monotonic")


@query("win_tumbling", _closed(10_000, 2_000_000))
def win_tumbling(spark, sf):
    return _drain_windows(spark, sf, "2 seconds", "10 seconds", "tumbling")


@query("wm_sql", f"""
    WITH {LG}
    SELECT {_bound_sql('ts', DAY_MS)}, page_id, count(*) AS n FROM lg
    GROUP BY lg.ts // {DAY_MS}, page_id
    HAVING (any_value(lg.ts) // {DAY_MS} + 1) * {DAY_MS}
           <= (SELECT max(ts) // 1000 * 1000 - 2000 FROM lg)""".replace("(ts //", "(lg.ts //"))
def wm_sql(spark, sf):
    """A declared JSON table over a stream, with its row time and watermark, asked in SQL."""
    lines = sink_topics.as_json(_log_stream(spark, sf))
    src_topics.json_table(lines, schemas.PAGE_VIEW, src_topics.millis_row_time(),
                          delay="2 seconds", view="page_view_stream")
    return run.drain(spark.sql("""
        SELECT date_format(window.start, 'yyyy-MM-dd HH:mm:ss') AS stt,
               date_format(window.end, 'yyyy-MM-dd HH:mm:ss') AS edt, page_id, n
        FROM (SELECT window(row_time, '1 day') AS window, page['page_id'] AS page_id, count(*) AS n
              FROM page_view_stream GROUP BY window(row_time, '1 day'), page['page_id'])"""), "wm-sql")


@query("wm_min_policy", """SELECT stt, edt, event_type, n * 2 AS n FROM ({})""".format(
    _closed(HOUR_MS, 2 * 86_400_000_000)))
def wm_min_policy(spark, sf):
    """Two inputs with different delays: the slower watermark closes the windows."""
    fast = t.table_stream(spark, sf, "events").withWatermark("ts", "2 seconds")
    slow = t.table_stream(spark, sf, "events").withWatermark("ts", "2 days")
    return run.drain(_window_counts(fast.unionByName(slow), "1 hour"), "wm-min")


HALF = "TIMESTAMP '2024-01-16 00:00:00'"


def _halves(spark: SparkSession, sf: str, late_first: bool):
    """The whole events table as two halves of a stream folder, written one after the other; each
    is one micro-batch, of as many files as it has parts."""
    events = _events(spark, sf)
    folder = work_folder(spark, "halves")
    late = F.col("ts") >= F.expr(HALF)
    parts = [events.where(late), events.where(~late)]
    if not late_first:
        parts.reverse()

    def write(i: int) -> None:
        parts[i].write.mode("append").parquet(f"{folder}/in")

    def stream() -> DataFrame:
        return spark.readStream.schema(events.schema).parquet(f"{folder}/in")

    return folder, write, stream


@query("late_data", _closed(HOUR_MS, 2_000_000, where=f"ts >= {HALF}"))
def late_data(spark, sf):
    """The later half comes first; the earlier half is then late, and is dropped."""
    folder, write, stream = _halves(spark, sf, late_first=True)
    for part in (0, 1):
        write(part)
        run.start_to_files(_window_counts(stream().withWatermark("ts", "2 seconds"), "1 hour"),
                           f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/out")


@query("checkpoint_recovery", _closed(HOUR_MS, 2_000_000))
def checkpoint_recovery(spark, sf):
    """A stream that is stopped between two files and started again from its checkpoint."""
    folder, write, stream = _halves(spark, sf, late_first=False)
    for part in (0, 1):
        write(part)
        run.start_to_files(_window_counts(stream().withWatermark("ts", "2 seconds"), "1 hour"),
                           f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/out")


@query("side_output", f"""
    WITH {LG} SELECT event_id, CASE WHEN event_type = 'signup' THEN 'start' ELSE 'page' END AS output
    FROM lg""")
def side_output(spark, sf):
    folder = work_folder(spark, "side")

    def split(logs: DataFrame) -> dict[str, DataFrame]:
        return {"start": lg.route_start(logs), "page": lg.route_page(logs)}

    run.start_per_batch(_log_stream(spark, sf), run.side_outputs(split, f"{folder}/out"),
                        f"{folder}/checkpoint").awaitTermination()
    parts = [spark.read.parquet(f"{folder}/out/{name}").select("event_id", F.lit(name).alias("output"))
             for name in ("start", "page")]
    return parts[0].unionByName(parts[1])


#: About as many rows as a stream is fed in a round: more rows make more rounds, so that what one
#: shuffles and keeps as state does not grow with the tables.
ROUND_ROWS = 4_000_000
#: Fixed value: quantiles of the times, of which the bounds of such rounds are taken.
QUANTILES = 1000
#: A stopped stream starts again from its last batch: older states are not kept. Stores of one
#: executor share their memory, also those of a stopped stream that are not closed yet; what a
#: batch has shuffled is deleted with its end.
LAST_STATES = {"spark.sql.streaming.minBatchesToRetain": "2",
               "spark.sql.streaming.stateStore.maintenanceInterval": "10s",
               "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
               "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
               "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
               "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def _round_starts(inputs: list[DataFrame], rounds: int) -> tuple[list[int], int]:
    """Where the rounds after the first begin, and the last time: ``rounds`` of equal length, or,
    if the rows are more than ``ROUND_ROWS`` for each of them, more of about so many rows."""
    ends = reduce(DataFrame.unionByName, [df.select("ts") for df in inputs]).agg(
        F.min("ts").alias("low"), F.max("ts").alias("high"), F.count(F.lit(1)).alias("rows"),
        F.percentile_approx("ts", [i / QUANTILES for i in range(1, QUANTILES)]).alias("places")
    ).first()
    wanted = min(QUANTILES, -(-ends.rows // ROUND_ROWS))
    if wanted > rounds:
        places = [ends.places[i * QUANTILES // wanted - 1] for i in range(1, wanted)]
        return sorted(set(places) - {ends.low}), ends.high
    step = (ends.high - ends.low) // rounds + 1
    return [ends.low + i * step for i in range(1, rounds)], ends.high


def _round_of(starts: list[int], first: int = 0) -> Column:
    """The round of a row by its ``ts``; that of a null is the first."""
    if not starts:
        return F.lit(first)
    mid = len(starts) // 2
    return F.when(F.col("ts") >= starts[mid], _round_of(starts[mid + 1:], first + mid + 1)) \
        .otherwise(_round_of(starts[:mid], first))


def _in_rounds(spark: SparkSession, inputs: dict[str, DataFrame], sentinel: dict[str, Column],
               build: Callable[..., DataFrame], purpose: str, rounds: int = 3) -> DataFrame:
    """Feed inputs to a stream in rounds of time, stopping it after each and starting it again.

    The rows are staged by round; a round's files are moved below what the stream reads, and are
    deleted when it has stopped. A last round has one late row per input, with the ``sentinel``
    columns, which closes the windows of all rows before and whose own windows stay open.
    """
    folder = work_folder(spark, purpose)
    starts, high = _round_starts(list(inputs.values()), rounds)
    last = len(starts) + 1

    def staged(name: str, i: int) -> str:
        return f"{folder}/staged/{name}/_round={i}"

    def fed(name: str, i: int) -> str:
        return f"{folder}/{name}/_round={i}"

    for name, df in inputs.items():
        df.withColumn("_round", _round_of(starts)).write.partitionBy("_round") \
            .option("compression", "zstd").parquet(f"{folder}/staged/{name}")
        for i in range(last):
            if sink_tables.exists(spark, staged(name, i)):
                spark.read.schema(df.schema).parquet(staged(name, i)).limit(1) \
                    .withColumn("ts", F.lit(high + 100 * DAY_MS)).withColumns(sentinel) \
                    .write.parquet(staged(name, last))
                break
        sink_tables.make(spark, f"{folder}/{name}")
    for i in range(last + 1):
        for name in inputs:
            if sink_tables.exists(spark, staged(name, i)):
                sink_tables.rename(spark, staged(name, i), fed(name, i))
        streams = [spark.readStream.schema(StructType(
            [*df.schema.fields, StructField("_round", IntegerType())]))
            .parquet(f"{folder}/{name}").drop("_round") for name, df in inputs.items()]
        run.start_to_files(build(*streams), f"{folder}/out", f"{folder}/checkpoint",
                           settings=LAST_STATES).awaitTermination()
        for name in inputs:
            sink_tables.delete(spark, fed(name, i))
    return spark.read.parquet(f"{folder}/out")


@query("stream_visitor_stats", f"""
    WITH {VISITOR_UNION}
    SELECT {_bound_sql('ts', HOUR_MS)}, vc, ch, ar, is_new, {VISITOR_SUMS}, min(ts) AS ts
    FROM rows GROUP BY ts // {HOUR_MS}, vc, ch, ar, is_new""")
def stream_visitor_stats(spark, sf):
    """The visitor job over its three inputs, each with its own watermark."""
    names = ("visits", "jumps", "pages")
    return _in_rounds(
        spark, dict(zip(names, _visitor_sources(spark, sf))),
        {"common": F.col("common").withField("vc", F.lit("sentinel"))},
        lambda *streams: jobs.job_visitor_stats(*streams, width="1 hour"), "visitors")


WAITS, WAIT_DAYS = "TIMESTAMP '1995-01-01 00:00:00'", 64


@query("stream_dim_join", f"""
    WITH l AS (SELECT l_orderkey, l_linenumber, l_suppkey, epoch_us(CAST(l_shipdate AS TIMESTAMP)) // 1000 AS ms,
                      l_shipdate < {WAITS} AS early FROM lineitem),
    ends AS (SELECT *, ceil((ms + {WAIT_DAYS * DAY_MS}) / {WAIT_DAYS // 8 * DAY_MS}.0)
                       * {WAIT_DAYS // 8 * DAY_MS} AS due,
                    (SELECT max(ms) FROM l WHERE early) AS reached FROM l)
    SELECT l_orderkey AS id, l_linenumber AS line, s_name AS supplier_name,
           CAST(s_nationkey AS BIGINT) AS nation_id
    FROM ends LEFT JOIN supplier ON s_suppkey = l_suppkey AND s_nationkey > 4
        AND NOT (early AND due <= reached)""")
def stream_dim_join(spark, sf):
    """Lines shipped before 1995 come first and wait for their suppliers, who come in the second
    round; those that have waited too long by then, and those of missing suppliers, get none."""
    lines = t.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"), "l_suppkey",
        F.col("l_shipdate").cast("timestamp").alias("time"))
    suppliers = t.table(spark, sf, "supplier").where("s_nationkey > 4").select(
        "s_suppkey", "s_name", "s_nationkey", F.lit(1).cast("long").alias("version"))
    end = lines.limit(1).select(
        F.lit(-1).cast(lines.schema["id"].dataType).alias("id"), "line",
        F.lit(None).cast(lines.schema["l_suppkey"].dataType).alias("l_suppkey"),
        F.expr("TIMESTAMP '2100-01-01 00:00:00'").alias("time"))
    early = F.coalesce(F.col("time") < F.expr(WAITS), F.lit(False))
    folder = work_folder(spark, "waiting")
    for facts, versions in ((lines.where(early), suppliers.where("false")),
                            (lines.where(~early), suppliers), (end, suppliers.where("false"))):
        facts.write.mode("append").parquet(f"{folder}/lines")
        versions.write.mode("append").parquet(f"{folder}/suppliers")
        joined = lookups.dim_join_stream(
            spark.readStream.schema(lines.schema).parquet(f"{folder}/lines"),
            spark.readStream.schema(suppliers.schema).parquet(f"{folder}/suppliers"),
            "l_suppkey", {"supplier_name": "s_name", "nation_id": F.col("s_nationkey").cast("bigint")},
            "time", timedelta(days=WAIT_DAYS), "version", dim_key="s_suppkey", salts=2)
        run.start_to_files(joined, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{folder}/out").where("id >= 0").drop("l_suppkey", "time")


@query("stream_product_stats", f"WITH {PRODUCT_UNION} {PRODUCT_GROUP}")
def stream_product_stats(spark, sf):
    """Distinct orders in a stream over the rows of all branches: two grouped steps, no sets in
    the state."""
    return _in_rounds(
        spark, {"rows": products.union_product(*_product_sources(spark, sf))},
        {"sku_id": F.lit(-1).cast("bigint")},
        lambda rows: stats.product_stats(rows, "30 days"), "products", 1)


# --- Jobs ------------------------------------------------------------------------------------

@query("job_cdc_ods", f"""
    WITH {CHANGES} SELECT '{{"op":"' || op || '","source":{{"db":"shop","table":"' || event_type || '"}},'
        || CASE WHEN op IN ('u', 'd') THEN '"before":{{"user_id":"' || user_id || '","k":null}},' ELSE '' END
        || CASE WHEN op <> 'd' THEN '"after":{{"user_id":"' || user_id || '","k":"' || k || '","event_id":"'
           || event_id || '"}},' ELSE '' END
        || '"ts_ms":' || ts_ms || '}}' AS value FROM chg""")
def job_cdc_ods(spark, sf):
    return jobs.job_cdc_ods(t.changes(_events(spark, sf)).drop("event_id"))


def _job_lines(spark, sf):
    return t.log_lines(_events(spark, sf))


def _job_pages(spark, sf):
    return _base_log(spark, sf)[jobs.PAGE]


def _base_log(spark, sf):
    return jobs.job_base_log(_job_lines(spark, sf), ORDER, work_folder(spark, "base-log"))


@query("job_base_log", f"""
    WITH {JOB_PAGES}
    SELECT CASE WHEN event_type = 'signup' THEN 'dwd_start_log' ELSE 'dwd_page_log' END AS topic,
           event_id, repaired AS is_new, page_id, ts, CAST(NULL AS VARCHAR) AS item FROM ok
    UNION ALL SELECT 'dirty', event_id, NULL, NULL, NULL, NULL FROM lg WHERE event_type = 'error'
    UNION ALL SELECT 'dwd_display_log', NULL, NULL, 'home', NULL, i FROM (
        SELECT unnest([k, CAST(user_id AS VARCHAR), CAST(user_id AS VARCHAR)]) AS i
        FROM ok WHERE event_type = 'view')""")
def job_base_log(spark, sf):
    out = _base_log(spark, sf)

    def pick(topic, **columns):
        null = {"event_id": "bigint", "is_new": "string", "page_id": "string", "ts": "bigint",
                "item": "string"}
        return out[topic].select(F.lit(topic).alias("topic"), *[
            columns.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in null.items()])

    logs = {c: F.col(s) for c, s in [("event_id", "event_id"), ("is_new", "common.is_new"),
                                     ("page_id", "page.page_id"), ("ts", "ts")]}
    return (
        pick(jobs.START, **logs).unionByName(pick(jobs.PAGE, **logs))
        .unionByName(pick(jobs.DIRTY, event_id=F.col("event_id")))
        .unionByName(pick(jobs.DISPLAY, page_id=F.col("page_id"), item=F.col("item")))
    )


@query("stream_base_log", f"""
    WITH {JOB_PAGES}
    SELECT CASE WHEN event_type = 'signup' THEN 'dwd_start_log' ELSE 'dwd_page_log' END AS topic,
           mid, repaired AS is_new, page_id, ts FROM ok
    UNION ALL SELECT 'dwd_display_log', NULL, NULL, 'home', NULL FROM ok, range(3)
    WHERE event_type = 'view'
    UNION ALL SELECT 'dirty', NULL, NULL, NULL, NULL FROM lg WHERE event_type = 'error'""")
def stream_base_log(spark, sf):
    """Raw lines to topic lines in one stateful pass, read back from the topic files."""
    lines = jobs.base_log_lines(t.log_lines(t.table_stream(spark, sf, "events")), ORDER)
    record = F.from_json("value", schemas.LOG + ", page_id STRING")
    return run.drain(lines, "base-log").select("topic", record.alias("r")).select(
        "topic", F.col("r.common.mid").alias("mid"), F.col("r.common.is_new").alias("is_new"),
        F.coalesce("r.page.page_id", "r.page_id").alias("page_id"), F.col("r.ts").alias("ts"))


@query("job_base_db", f"""
    WITH {ROUTED} SELECT event_id, sink_type, sink_table, CASE WHEN cols = 'user_id,k' THEN 'k,user_id'
        ELSE 'event_id,user_id' END AS names FROM routed""")
def job_base_db(spark, sf):
    out = jobs.job_base_db(t.change_lines(_events(spark, sf)), t.rules(spark))
    return out["topics"].unionByName(out["dimensions"]).select(
        "event_id", "sink_type", "sink_table",
        F.array_join(F.array_sort(F.map_keys("after")), ",").alias("names"))


@query("job_unique_visit", f"""
    WITH {JOB_PAGES} SELECT event_id, mid, ts FROM ({_visits_sql('job_pages')})""")
def job_unique_visit(spark, sf):
    return _row_id(jobs.job_unique_visit(_job_pages(spark, sf), ORDER))


@query("job_user_jump", f"""
    WITH {JOB_PAGES} SELECT event_id, mid, ts FROM ({_jumps_sql('job_pages', 10_000)})""")
def job_user_jump(spark, sf):
    return _row_id(jobs.job_user_jump(_job_pages(spark, sf), ORDER))


WIDE_SQL = f"WITH {DIMS}, {_wide_sql('-5 days', '5 days')}"


def _job_wide(spark, sf):
    return jobs.job_order_wide(
        t.order_info(t.table(spark, sf, "orders")), t.order_detail(t.table(spark, sf, "lineitem")),
        t.dimensions(spark, sf), _as_of(), timedelta(days=-5), timedelta(days=5))


LOOKED_UP_SQL = ", ".join(LOOKED_UP).replace("spu_id", "sku.spu_id").replace(
    " tm_id", " sku.tm_id").replace(" category3_id", " sku.category3_id")


@query("job_order_wide", f"{WIDE_SQL} SELECT wide.*, {LOOKED_UP_SQL} FROM wide {LOOKUPS}")
def job_order_wide(spark, sf):
    return _job_wide(spark, sf).select(*WIDE, *LOOKED_UP)


@query("job_payment_wide", f"""{WIDE_SQL}
    SELECT o_orderkey AS payment_id, o_orderpriority AS subject,
           CAST(floor(o_totalprice) AS DECIMAL(16,2)) AS total_amount, detail_id, order_id,
           strftime(o_orderdate, {SECOND}) AS payment_create_time,
           create_time AS order_create_time, province_name, user_age, spu_name, tm_name, category3_name
    FROM orders JOIN wide ON order_id = o_orderkey {LOOKUPS}""")
def job_payment_wide(spark, sf):
    payments = t.payment_info(t.table(spark, sf, "orders"))
    return jobs.job_payment_wide(payments, _job_wide(spark, sf)).select(
        "payment_id", "subject", "total_amount", "detail_id", "order_id", "payment_create_time",
        "order_create_time", "province_name", "user_age", "spu_name", "tm_name", "category3_name")


@query("job_visitor_stats", f"""
    WITH {JOB_PAGES}, p AS (SELECT * REPLACE (repaired AS is_new) FROM job_pages),
    uj AS ({_jumps_sql('p', 10_000)}), uv AS ({_visits_sql('p')}), rows AS (
    SELECT {VISITOR}, 1 AS uv_ct, 0 AS pv_ct, 0 AS sv_ct, 0 AS uj_ct, 0 AS dur_sum FROM uv
    UNION ALL SELECT {VISITOR}, 0, 0, 0, 1, 0 FROM uj
    UNION ALL {PV} FROM p)
    SELECT {_bound_sql('rows.ts', 10_000)}, vc, ch, ar, is_new, {VISITOR_SUMS}, min(rows.ts) AS ts
    FROM rows GROUP BY rows.ts // 10000, vc, ch, ar, is_new""")
def job_visitor_stats(spark, sf):
    pages = _job_pages(spark, sf)
    return jobs.job_visitor_stats(jobs.job_unique_visit(pages, ORDER),
                                  jobs.job_user_jump(pages, ORDER), pages)


@query("job_product_stats", f"""
    WITH {DIMS}, {PRODUCT_UNION}, s AS ({PRODUCT_GROUP})
    SELECT s.*, sku_name, sku_price, sku.spu_id, spu_name, sku.tm_id, tm_name, sku.category3_id,
           category3_name
    FROM s LEFT JOIN sku ON sku.id = sku_id LEFT JOIN spu ON spu.id = sku.spu_id
    LEFT JOIN tm ON tm.id = sku.tm_id LEFT JOIN c3 ON c3.id = sku.category3_id""")
def job_product_stats(spark, sf):
    return jobs.job_product_stats(*_product_sources(spark, sf), t.dimensions(spark, sf), "30 days")


@query("job_province_stats", f"""{WIDE_SQL}, placed AS (
    SELECT wide.*, pv.*, epoch_us(strptime(create_time, {SECOND})) // 1000 AS ts
    FROM wide LEFT JOIN pv ON pv.id = province_id)
    SELECT {_bound_sql('ts', 10_000)}, province_id, province_name, province_area_code,
           province_iso_code, province_3166_2_code,
           CAST(sum(split_total_amount) AS DECIMAL(28,2)) AS order_amount,
           count(DISTINCT order_id) AS order_count,
           epoch_us(TIMESTAMP '{AS_OF}') // 1000 AS ts
    FROM placed GROUP BY placed.ts // 10000, province_id, province_name, province_area_code,
        province_iso_code, province_3166_2_code""".replace("(ts //", "(placed.ts //"))
def job_province_stats(spark, sf):
    return jobs.job_province_stats(_job_wide(spark, sf), as_of=_as_of())


@query("job_keyword_stats", KEYWORD_SQL)
def job_keyword_stats(spark, sf):
    return jobs.job_keyword_stats(t.search_lines(t.table(spark, sf, "documents")), as_of=_as_of())
