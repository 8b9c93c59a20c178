"""Log lines: dirty split, routing, displays, page-log measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructField, StructType

from tidemill import codes



def _as_text(kind: DataType) -> DataType:
    """The type with every simple part as text."""
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, _as_text(f.dataType)) for f in kind.fields])
    if isinstance(kind, ArrayType):
        return ArrayType(_as_text(kind.elementType))
    return kind if isinstance(kind, MapType) else StringType()


def is_one_object(value: str) -> Column:
    """The text is exactly one JSON object, decided by one parse.

    A parser stops after the first value, so the text is put between brackets, and what follows
    it is a key that no text can hold: its own hash. The text must be the one element of its
    array, and the key must be there: a text that closes the array early either leaves more
    elements or keys, or ends the value before that key.
    """
    key = F.concat(F.lit("h"), F.hex(F.xxhash64(value)))
    text = F.concat(F.lit('{"r":['), F.col(value), F.lit('],"'), key, F.lit('":[]}'))
    parts = F.try_variant_get(F.try_parse_json(text), "$", "map<string,array<variant>>")
    inside = F.try_element_at(parts, F.lit("r"))
    return ((F.size(parts) == 2) & F.map_contains_key(parts, key) & (F.size(inside) == 1)
            & F.try_variant_get(F.get(inside, F.lit(0)), "$", "map<string,variant>").isNotNull())


def parse_lines(df: DataFrame, schema: str, value: str = "value") -> DataFrame:
    """Add ``record`` (the parsed object) and ``is_dirty``.

    Dirty is whatever is not exactly one JSON object: broken JSON, arrays, ``null``, empty or
    missing text, text after the closing brace. Simple fields may be numbers or text; what does
    not fit its type in ``schema`` is null. Record and verdict pass an ``explode`` of one
    element, which keeps Catalyst from parsing the text again in every filter and projection
    above.
    """
    wanted = StructType.fromDDL(schema)
    parsed = F.struct(F.from_json(value, _as_text(wanted)).alias("record"),
                      (~F.coalesce(is_one_object(value), F.lit(False))).alias("is_dirty"))
    return (
        df.select("*", F.explode(F.array(parsed)).alias("_parsed"))
        .select(*df.columns, F.col("_parsed.record").try_cast(wanted).alias("record"),
                F.col("_parsed.is_dirty").alias("is_dirty"))
    )


def split_dirty(df: DataFrame, schema: str, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(records with the schema's columns, dirty lines). Other columns of ``df`` are kept."""
    return divide(parse_lines(df, schema, value), df.columns, value)


def divide(parsed: DataFrame, columns: list[str],
           value: str = "value") -> tuple[DataFrame, DataFrame]:
    """The two sides of lines that ``parse_lines`` has parsed."""
    kept = [c for c in columns if c != value]
    clean = parsed.where(~F.col("is_dirty")).select(*kept, "record.*")
    return clean, parsed.where("is_dirty").select(*columns)


def is_start() -> Column:
    return F.col("start").isNotNull()


def route_start(logs: DataFrame) -> DataFrame:
    return logs.where(is_start())


def route_page(logs: DataFrame) -> DataFrame:
    """Every log that is not a start log, with or without displays."""
    return logs.where(~is_start())


def explode_display(pages: DataFrame) -> DataFrame:
    """One row per display of a page log: the display's fields and the page's id."""
    return (
        pages.select(F.col("page.page_id").alias("page_id"), F.explode("displays").alias("d"))
        .select("d.*", "page_id")
    )


def is_session_entry(last_page: str | Column = "page.last_page_id") -> Column:
    """The page has no page before it: null or empty."""
    column = F.col(last_page) if isinstance(last_page, str) else last_page
    return F.coalesce(column, F.lit("")) == ""


_VISITOR_MEASURES = ["uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum"]


def _visitor_rows(logs: DataFrame, **measures: Column) -> DataFrame:
    return logs.select(
        *[F.col(f"common.{c}").alias(c) for c in ("vc", "ch", "ar", "is_new")],
        *[F.coalesce(measures.get(m, F.lit(0)), F.lit(0)).cast("bigint").alias(m)
          for m in _VISITOR_MEASURES],
        "ts",
    )


def visitor_uv(unique_visits: DataFrame) -> DataFrame:
    return _visitor_rows(unique_visits, uv_ct=F.lit(1))


def visitor_uj(jumps: DataFrame) -> DataFrame:
    return _visitor_rows(jumps, uj_ct=F.lit(1))


def visitor_pv(pages: DataFrame) -> DataFrame:
    return _visitor_rows(pages, pv_ct=F.lit(1), sv_ct=is_session_entry().cast("bigint"),
                         dur_sum=F.col("page.during_time"))


def union_visitor(unique_visits: DataFrame, jumps: DataFrame, pages: DataFrame) -> DataFrame:
    """The three page-log streams as measure rows, duplicates kept."""
    return (
        visitor_uv(unique_visits)
        .unionByName(visitor_uj(jumps))
        .unionByName(visitor_pv(pages))
    )


def filter_search(page_views: DataFrame, time: str = "row_time") -> DataFrame:
    """Search texts of page views whose previous page is the search page."""
    return (
        page_views
        .where((F.col("page")["last_page_id"] == codes.PAGE_SEARCH)
               & F.col("page")["item"].isNotNull())
        .select(F.col("page")["item"].alias("full_word"), time)
    )
