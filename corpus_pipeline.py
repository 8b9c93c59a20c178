"""From raw documents to a training mixture, in stages that each write what they keep."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemill.llm import decontaminate, minhash, mixing, quality, secrets
from tidemill.llm.queries import MAX_REPEATS
from tidemill.llm.store import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, fitted on the labels, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.good_documents(docs, quality.quality_machine(docs, labels))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near duplicates."""
    return minhash.one_of_each_group(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.without_contaminated(docs, decontaminate.contaminated(docs, benchmark))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark."""
    return secrets.redacted(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The plan of the mixture of sources: which documents, in which pass and block."""
    return mixing.mixing_plan(docs, max_repeats=MAX_REPEATS)


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_good), ("near_duplicates", keep_one_of_each_group),
    ("decontamination", keep_uncontaminated), ("secrets", redact_secrets), ("mixing", mix)]
#: The stages fit a model, link documents and lex texts, which SQL cannot say; tests compare
#: each with a brute-force form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
