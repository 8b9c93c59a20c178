"""Search text to words: runs of Latin letters and digits, and runs of Han characters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

WORD_PATTERN = r"[A-Za-z0-9]+|[\p{IsHan}]+"


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD_PATTERN), F.lit(0))


def split_words(df: DataFrame, text: str, out: str = "word",
                tokenizer: Callable[[Column], Column] = words_of) -> DataFrame:
    """One row per word of ``text``. ``tokenizer`` maps a text column to an array of words."""
    return df.withColumn(out, F.explode(tokenizer(F.col(text))))


def register_split_words(spark: SparkSession, name: str = "split_words") -> None:
    """Make ``LATERAL split_words(text)`` usable in SQL; Catalyst inlines its body."""
    pattern = WORD_PATTERN.replace("\\", "\\\\")
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(txt STRING) RETURNS TABLE(word STRING) "
        f"RETURN SELECT explode(regexp_extract_all(txt, '{pattern}', 0))"
    )
