"""The jobs as functions of DataFrames. Each takes batches or streams and uses the fitting form."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F

from tidemill import schemas
from tidemill.operators import changes as ch
from tidemill.operators import logs as lg
from tidemill.operators import orders as od
from tidemill.operators import products, stats, visits
from tidemill.operators.joins import dim_join
from tidemill.sources.topics import json_table, millis_row_time
from tidemill.streaming import state

START, PAGE, DISPLAY, DIRTY = "dwd_start_log", "dwd_page_log", "dwd_display_log", "dirty"


def repair_is_new(logs: DataFrame, order: list[str]) -> DataFrame:
    if logs.isStreaming:
        return state.repair_is_new_stream(logs, order[-1])
    return visits.repair_is_new(logs, order)


def job_cdc_ods(changes: DataFrame) -> DataFrame:
    """Row changes as JSON text, one line per change, with every column of the envelope. Lines
    (``value``) that are envelopes already pass as they are."""
    if changes.columns == ["value"]:
        return changes
    first = [c for c in ("op", "source", "before", "after", "ts_ms") if c in changes.columns]
    rest = [c for c in changes.columns if c not in first]
    return changes.select(F.to_json(F.struct(*first, *rest)).alias("value"))


def job_base_log(lines: DataFrame, order: list[str],
                 stage: str | None = None) -> dict[str, DataFrame]:
    """Raw log lines to start, page and display logs and dirty lines, as separate frames.

    A batch may name a ``stage`` folder in shared storage: the parsed lines are written there
    once, the repaired ones beside it, and every output reads columns from them instead of
    parsing and repairing again. Displays need no repair.
    """
    if stage and not lines.isStreaming:
        lg.parse_lines(lines, schemas.LOG).write.mode("overwrite").parquet(stage)
        parsed = lines.sparkSession.read.parquet(stage)
        clean, dirty = lg.divide(parsed, lines.columns)
    else:
        clean, dirty = lg.split_dirty(lines, schemas.LOG)
    logs = repair_is_new(clean, order)
    if stage and not lines.isStreaming:
        logs.write.mode("overwrite").parquet(f"{stage}-repaired")
        logs = lines.sparkSession.read.schema(logs.schema).parquet(f"{stage}-repaired")
    return {START: lg.route_start(logs), PAGE: lg.route_page(logs),
            DISPLAY: lg.explode_display(lg.route_page(clean)), DIRTY: dirty}


def _with(fields: Column, name: str, value: Column) -> Column:
    """Fields of an object with one of them set; null stays null."""
    return F.map_concat(F.map_filter(fields, lambda k, _: k != name),
                        F.create_map(F.lit(name), value))


def base_log_lines(lines: DataFrame, order: list[str]) -> DataFrame:
    """The same outputs as ``topic, value`` lines of one pass, for a sink that routes by row.

    Lines pass whole, fields that the schema does not name included; only where the flag is
    repaired is it replaced. Displays are whole with the page's id added.
    """
    parsed = lg.parse_lines(lines, schemas.LOG)
    kept = [c for c in lines.columns if c != "value"]
    logs = repair_is_new(parsed.select("value", "is_dirty", *kept, "record.*"), order)
    whole = F.try_parse_json("value")
    fields = F.try_variant_get(whole, "$", "map<string,variant>")
    common = F.try_variant_get(whole, "$.common", "map<string,variant>")
    old = F.to_variant_object(_with(common, "is_new", F.parse_json(F.lit('"0"'))))
    repaired = (F.try_variant_get(whole, "$.common.is_new", "string") == "1") \
        & F.col("common.is_new").eqNullSafe("0")
    log_text = F.when(repaired, F.to_json(_with(fields, "common", old))).otherwise(F.col("value"))
    displays = F.try_variant_get(whole, "$.displays", "array<map<string,variant>>")
    page_id = F.col("page.page_id").cast("variant")

    def line(topic: Column | str, value: Column) -> Column:
        topic = F.lit(topic) if isinstance(topic, str) else topic
        return F.struct(topic.alias("topic"), value.alias("value"))

    log = line(F.when(lg.is_start(), START).otherwise(PAGE), log_text)
    shown = F.when(~lg.is_start(), F.transform(
        displays, lambda d: line(DISPLAY, F.to_json(_with(d, "page_id", page_id)))))
    outputs = (
        F.when(F.col("is_dirty"), F.array(line(DIRTY, F.col("value"))))
        .otherwise(F.concat(F.array(log), F.coalesce(shown, F.array().cast(
            "array<struct<topic: string, value: string>>"))))
    )
    return logs.select(F.explode(outputs).alias("o")).select("o.*")


def job_base_db(lines: DataFrame, rules: DataFrame) -> dict[str, DataFrame]:
    """Change lines to topic rows and dimension rows by rule; deletes and unruled rows go. Lines
    that do not parse, and dimension rows without a key (as JSON), are dirty."""
    return base_db_outputs(lg.parse_lines(lines, schemas.CHANGE), lines.columns, rules)


def base_db_outputs(parsed: DataFrame, columns: list[str], rules: DataFrame) -> dict[str, DataFrame]:
    """The same for change lines (of ``columns``) that are parsed already."""
    changes, dirty = lg.divide(parsed, columns)
    routed = ch.route_by_rule(ch.drop_deletes(changes), rules)
    keyless = ch.without_key(routed)
    return {"topics": ch.to_topics(routed), "dimensions": ch.to_dimensions(routed),
            "dirty": dirty.select("value").unionByName(
                keyless.select(F.to_json(F.struct(*keyless.columns)).alias("value")))}


def job_unique_visit(pages: DataFrame, order: list[str]) -> DataFrame:
    if pages.isStreaming:
        return state.unique_visit_stream(pages, order[-1])
    return visits.unique_visit(pages, order)


def job_user_jump(pages: DataFrame, order: list[str], gap_ms: int = 10_000) -> DataFrame:
    if pages.isStreaming:
        return state.user_jump_stream(pages, order[-1], gap_ms)
    return visits.user_jump(pages, order, gap_ms)


def job_order_wide(orders: DataFrame, details: DataFrame, dims: dict[str, DataFrame],
                   as_of: Column | None = None, lower: timedelta = timedelta(seconds=-5),
                   upper: timedelta = timedelta(seconds=5)) -> DataFrame:
    """Orders joined with their details in time, with user, province and product attributes."""
    delay = "0 seconds" if orders.isStreaming else None
    wide = od.join_order_detail(orders, details, lower, upper, delay)
    return od.with_dimensions(wide, dims, as_of)


def job_payment_wide(payments: DataFrame, wide: DataFrame,
                     lower: timedelta = timedelta(minutes=-15),
                     upper: timedelta = timedelta(seconds=10)) -> DataFrame:
    delay = "0 seconds" if payments.isStreaming else None
    return od.join_payment_order(payments, wide, lower, upper, delay)


def job_visitor_stats(unique_visits: DataFrame, jumps: DataFrame, pages: DataFrame,
                      width: str = stats.WIDTH) -> DataFrame:
    """Each stream has a watermark of its own; windows close by the slowest, so a bounce that is
    published late still finds its window open."""
    rows = (lg.visitor_uv(unique_visits), lg.visitor_uj(jumps), lg.visitor_pv(pages))
    return stats.visitor_stats_of(rows, width)


def job_product_stats(pages: DataFrame, favors: DataFrame, carts: DataFrame, orders: DataFrame,
                      payments: DataFrame, refunds: DataFrame, comments: DataFrame,
                      dims: dict[str, DataFrame], width: str = stats.WIDTH) -> DataFrame:
    """Product statistics with product attributes; looked up once per window, not per row."""
    rows = products.union_product(pages, favors, carts, orders, payments, refunds, comments)
    return with_products(stats.product_stats(rows, width), dims)


def with_products(reports: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    out = dim_join(reports, dims["dim_sku_info"], "sku_id", {
        "sku_name": "sku_name", "sku_price": F.col("price").try_cast("decimal(16,2)"),
        **od.sku_links()})
    return od.with_product_names(out, dims).select(*schemas.PRODUCT_STATS)


def job_province_stats(wide: DataFrame, width: str = stats.WIDTH,
                       as_of: Column | None = None) -> DataFrame:
    return stats.province_stats(wide, width, as_of=as_of).select(*schemas.PROVINCE_STATS)


def job_keyword_stats(lines: DataFrame, width: str = stats.WIDTH,
                      as_of: Column | None = None) -> DataFrame:
    views = json_table(lines, schemas.PAGE_VIEW, millis_row_time())
    return stats.keyword_stats(lg.filter_search(views), width, as_of=as_of)
