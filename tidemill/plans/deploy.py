"""Run the jobs as streams between topics.

``python -m tidemill.plans.deploy base_log --folder /shared/topics --state /shared/state``
reads and writes topics as text folders; ``--servers host:9092`` uses Kafka instead. ``--once``
processes what there is and ends. A job that fails is started again up to three times; one that
has stopped goes on with the same ``--state``.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemill import schemas
from tidemill.functions.records import fields_of
from tidemill.operators.logs import parse_lines
from tidemill.plans import jobs
from tidemill.sinks import committed, dimensions, tables, topics as sinks
from tidemill.sources.changes import change_envelopes, rule_table
from tidemill.sources.topics import Topics, read_records, read_topic, starting_options, with_place
from tidemill.streaming.run import stream_settings, start_per_batch, supervise
from tidemill.streaming.state import JUMP_SHARDS, user_jump_stream

# The topics the jobs read and write.
ODS_LOG, ODS_DB = "ods_base_log", "ods_base_db"
CHANGES, DIRTY_DB = "database_changes", "dirty_db"
ORDER_INFO, ORDER_DETAIL, PAYMENT = "dwd_order_info", "dwd_order_detail", "dwd_payment_info"
CART, FAVOR = "dwd_cart_info", "dwd_favor_info"
REFUND, COMMENT = "dwd_order_refund_info", "dwd_comment_info"
UNIQUE_VISIT, USER_JUMP = "dwm_unique_visit", "dwm_user_jump_detail"
ORDER_WIDE, PAYMENT_WIDE = "dwm_order_wide", "dwm_payment_wide"

# The dimension tables and the columns the lookups read.
DIMENSIONS = {
    "dim_user_info": ["id", "birthday", "gender"],
    "dim_base_province": ["id", "name", "area_code", "iso_code", "iso_3166_2"],
    "dim_sku_info": ["id", "sku_name", "price", "category3_id", "spu_id", "tm_id"],
    "dim_spu_info": ["id", "spu_name"],
    "dim_base_trademark": ["id", "tm_name"],
    "dim_base_category3": ["id", "name"],
}
FROM_LOG, FROM_DB = "base_log", "base_db"
#: Origins of topics that micro-batches commit.
BY_BATCH = (FROM_DB, DIRTY_DB, ORDER_WIDE)


@dataclass(frozen=True)
class Place:
    """Where a deployment reads, writes and keeps its state."""

    spark: SparkSession
    topics: Topics
    state: str
    once: bool = False
    jdbc: str | None = None
    starting: dict[str, str] | None = None

    def checkpoint(self, job: str) -> str:
        return f"{self.state}/checkpoints/{job}"

    @property
    def dimensions(self) -> str:
        return f"{self.state}/dimensions"

    def logs(self, topic: str, origin: str | None = None) -> DataFrame:
        return read_records(self.spark, self.topics, topic, schemas.LOG, origin=origin,
                            starting=self.starting)

    def facts(self, topic: str, schema: str, origin: str | None = FROM_DB) -> DataFrame:
        return read_records(self.spark, self.topics, topic, schema, origin=origin,
                            by_batch=origin in BY_BATCH, starting=self.starting).drop("place")

    def lines(self, topic: str, origin: str | None = None) -> DataFrame:
        return read_topic(self.spark, self.topics, topic, origin=origin, starting=self.starting)

    def kept(self, job: str, name: str, value: int) -> int:
        """A number that the job's state depends on: written at its first start, read after."""
        folder = f"{self.state}/settings/{job}/{name}"
        if not tables.exists(self.spark, folder):
            self.spark.createDataFrame([(value,)], "value INT").write.json(folder)
        return self.spark.read.schema("value INT").json(folder).first().value

    def looked_up(self) -> dict[str, DataFrame]:
        return {name: dimensions.read_dimension(self.spark, self.dimensions, name, columns)
                for name, columns in DIMENSIONS.items()}

    def to_topic(self, df: DataFrame, topic: str, job: str) -> StreamingQuery:
        with stream_settings(self.spark):
            return sinks.sink_topic(df, self.topics, topic, self.checkpoint(job), self.once)

    def to_report(self, df: DataFrame, table: str, transient: list[str] | None = None,
                  enrich: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> StreamingQuery:
        """Window results to a database table or, without one, to versioned Parquet."""
        def write(rows: DataFrame, batch_id: int) -> None:
            rows = enrich(rows)
            if self.jdbc:
                tables.sink_jdbc(rows, self.jdbc, table, transient)
            else:
                tables.sink_replacing(rows, f"{self.state}/reports/{table}", batch_id)

        return start_per_batch(df, write, self.checkpoint(table), self.once)


def base_log(at: Place) -> StreamingQuery:
    lines = with_place(at.lines(ODS_LOG))
    with stream_settings(at.spark):
        return sinks.sink_lines(jobs.base_log_lines(lines, ["place"]), at.topics, FROM_LOG,
                                at.checkpoint("base_log"), at.once)


def cdc_ods(at: Place) -> StreamingQuery:
    """Copies change lines, as they come from the change reader, to the topic of all changes."""
    lines = jobs.job_cdc_ods(at.lines(CHANGES).select("value"))
    with stream_settings(at.spark):
        return sinks.sink_lines(lines.withColumn("topic", F.lit(ODS_DB)), at.topics, ODS_DB,
                                at.checkpoint("cdc_ods"), at.once)


def compact(at: Place) -> None:
    """Delete what newer versions of the dimensions' buckets have replaced."""
    dimensions.vacuum(at.spark, at.dimensions)


def base_db(at: Place) -> StreamingQuery:
    """Routes by the rules as they stand at the first attempt of each micro-batch, read from
    ``state/rules`` as change lines. All three outputs are exactly-once, Kafka at-least-once."""
    def write(batch: DataFrame, batch_id: int) -> None:
        folder = f"{at.state}/rules"
        lines = with_place(at.spark.read.text(folder) if tables.exists(at.spark, folder)
                           else at.spark.createDataFrame([], "value STRING"))
        rules = committed.pinned(rule_table(change_envelopes(lines)[0], ["ts_ms", "place"]),
                                 f"{at.state}/rules_of_batch", batch_id)
        parsed = parse_lines(batch, schemas.CHANGE).persist()
        try:
            out = jobs.base_db_outputs(parsed, batch.columns, rules)
            dimensions.upsert_batch(out["dimensions"], at.dimensions, batch_id, "place")
            sinks.sink_topic_by_row(out["topics"], at.topics, origin=FROM_DB, batch_id=batch_id)
            sinks.sink_lines(out["dirty"].withColumn("topic", F.lit(DIRTY_DB)), at.topics,
                             DIRTY_DB, batch_id=batch_id)
        finally:
            parsed.unpersist()

    lines = with_place(at.lines(ODS_DB))
    return start_per_batch(lines, write, at.checkpoint("base_db"), at.once)


def unique_visit(at: Place) -> StreamingQuery:
    visits = jobs.job_unique_visit(at.logs(jobs.PAGE, FROM_LOG), ["place"])
    return at.to_topic(visits.drop("place"), UNIQUE_VISIT, "unique_visit")


def user_jump(at: Place) -> StreamingQuery:
    shards = at.kept("user_jump", "shards", JUMP_SHARDS)
    jumps = user_jump_stream(at.logs(jobs.PAGE, FROM_LOG), "place", shards=shards)
    return at.to_topic(jumps.drop("place"), USER_JUMP, "user_jump")


def order_wide(at: Place) -> StreamingQuery:
    """Joins the streams, then looks dimensions up per micro-batch as they stand at that
    moment. Topic lines are exactly-once, on Kafka at-least-once."""
    joined = jobs.od.join_order_detail(at.facts(ORDER_INFO, schemas.ORDER_INFO),
                                       at.facts(ORDER_DETAIL, schemas.ORDER_DETAIL),
                                       delay="0 seconds")

    def write(batch: DataFrame, batch_id: int) -> None:
        lines = sinks.as_json(jobs.od.with_dimensions(batch, at.looked_up()))
        sinks.sink_lines(lines.withColumn("topic", F.lit(ORDER_WIDE)), at.topics, ORDER_WIDE,
                         batch_id=batch_id)

    return start_per_batch(joined, write, at.checkpoint("order_wide"), at.once)


def payment_wide(at: Place) -> StreamingQuery:
    paid = jobs.job_payment_wide(at.facts(PAYMENT, schemas.PAYMENT_INFO),
                                 at.facts(ORDER_WIDE, schemas.ORDER_WIDE, ORDER_WIDE))
    return at.to_topic(paid, PAYMENT_WIDE, "payment_wide")


def visitor_stats(at: Place) -> StreamingQuery:
    stats = jobs.job_visitor_stats(at.logs(UNIQUE_VISIT), at.logs(USER_JUMP),
                                   at.logs(jobs.PAGE, FROM_LOG))
    return at.to_report(stats, "visitor_stats")


def product_stats(at: Place) -> StreamingQuery:
    """Lookups happen per micro-batch on the closed windows, with the dimensions of the moment."""
    kinds = {f.name: f.dataType.simpleString() for f in fields_of(schemas.ORDER_WIDE)}
    payment = ", ".join(f"{c} {kinds.get(c, 'bigint' if c == 'payment_id' else 'string')}"
                        for c in schemas.PAYMENT_WIDE)
    rows = jobs.products.union_product(
        at.logs(jobs.PAGE, FROM_LOG), at.facts(FAVOR, schemas.CART_OR_FAVOR),
        at.facts(CART, schemas.CART_OR_FAVOR),
        at.facts(ORDER_WIDE, schemas.ORDER_WIDE, ORDER_WIDE),
        at.facts(PAYMENT_WIDE, payment, None), at.facts(REFUND, schemas.REFUND),
        at.facts(COMMENT, schemas.COMMENT))
    return at.to_report(jobs.stats.product_stats(rows), "product_stats",
                        enrich=lambda r: jobs.with_products(r, at.looked_up()))


def province_stats(at: Place) -> StreamingQuery:
    wide = at.facts(ORDER_WIDE, schemas.ORDER_WIDE, ORDER_WIDE)
    return at.to_report(jobs.job_province_stats(wide), "province_stats")


def keyword_stats(at: Place) -> StreamingQuery:
    lines = at.lines(jobs.PAGE, FROM_LOG)
    return at.to_report(jobs.job_keyword_stats(lines), "keyword_stats")


JOBS: dict[str, Callable[[Place], StreamingQuery]] = {f.__name__: f for f in (
    cdc_ods, base_log, base_db, unique_visit, user_jump, order_wide, payment_wide,
    visitor_stats, product_stats, province_stats, keyword_stats)}


def main() -> None:
    parser = argparse.ArgumentParser(description="Run one job between topics.")
    parser.add_argument("job", choices=[*JOBS, compact.__name__])
    parser.add_argument("--folder", help="topics as text folders below this shared folder")
    parser.add_argument("--servers", help="topics on these Kafka servers")
    parser.add_argument("--state", required=True, help="shared folder of checkpoints and tables")
    parser.add_argument("--jdbc", help="database that takes the reports")
    parser.add_argument("--once", action="store_true", help="process what there is, then end")
    parser.add_argument("--zone", default="Asia/Shanghai", help="zone of days and text times")
    parser.add_argument("--start", default="earliest", help="where the first start of a Kafka job "
                        "begins: initial, earliest, latest, or a time in epoch ms")
    args = parser.parse_args()
    spark = SparkSession.builder.appName(args.job).config(
        "spark.sql.session.timeZone", args.zone).getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", args.zone)
    starting = (starting_options("timestamp", int(args.start)) if args.start.isdigit()
                else starting_options(args.start))
    place = Place(spark, Topics(args.folder, args.servers), args.state, args.once, args.jdbc,
                  starting)
    if args.job == compact.__name__:
        compact(place)
    else:
        supervise(lambda: JOBS[args.job](place))


if __name__ == "__main__":
    main()
