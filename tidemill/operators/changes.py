"""Row changes of databases: envelopes, changelogs, current state, rule routing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemill import codes
from tidemill.operators.joins import is_small, row_salt

_EMPTY = "CAST(map() AS MAP<STRING, STRING>)"


def flat_envelope(changes: DataFrame, topic: str = "topic") -> DataFrame:
    """``database, tableName, before, after, type`` of changes read from topics named
    ``server.database.table``; a missing side becomes an empty map."""
    names = F.create_map(*[F.lit(x) for pair in codes.OPERATION_NAMES.items() for x in pair])
    parts = F.split(topic, r"\.")
    return changes.select(
        parts[1].alias("database"),
        parts[2].alias("tableName"),
        F.coalesce("before", F.expr(_EMPTY)).alias("before"),
        F.coalesce("after", F.expr(_EMPTY)).alias("after"),
        F.try_element_at(names, "op").alias("type"),
    )


def snapshot_rows(table: DataFrame, db: str, name: str, ts_ms: int = 0) -> DataFrame:
    """A table's present rows as read changes, to put before its change log."""
    pairs = [x for c in table.columns for x in (F.lit(c), F.col(c).cast("string"))]
    return table.select(
        F.lit("r").alias("op"),
        F.struct(F.lit(db).alias("db"), F.lit(name).alias("table")).alias("source"),
        F.lit(None).cast("map<string,string>").alias("before"),
        F.create_map(*pairs).alias("after"),
        F.lit(ts_ms).cast("bigint").alias("ts_ms"),
    )


def changelog_view(changes: DataFrame) -> DataFrame:
    """One row per row image: ``+I`` new, ``-U``/``+U`` before and after an update, ``-D`` gone."""
    def image(kind: str, side: str):
        return F.struct(F.lit(kind).alias("row_kind"), F.col(side).alias("row"))

    images = (
        F.when(F.col("op").isin("c", "r"), F.array(image("+I", "after")))
        .when(F.col("op") == "u", F.array(image("-U", "before"), image("+U", "after")))
        .when(F.col("op") == "d", F.array(image("-D", "before")))
    )
    others = [c for c in changes.columns if c not in ("before", "after")]
    return changes.select(*others, F.explode(images).alias("_i")).select(*others, "_i.*")


def current_state(changes: DataFrame, pk: str, order: list[str]) -> DataFrame:
    """The rows that the changes leave standing: the last image per key unless deleted."""
    row = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    keyed = changes.withColumn("row", row).withColumn("pk", F.col("row")[pk])
    last = F.row_number().over(
        Window.partitionBy("pk").orderBy(*[F.col(c).desc() for c in order]))
    return (
        keyed.withColumn("_row_no", last).where("_row_no = 1 AND NOT (op <=> 'd')")
        .select("pk", "row")
    )


def drop_deletes(changes: DataFrame) -> DataFrame:
    return changes.where("NOT (op <=> 'd')")


def prune_sink_columns(changes: DataFrame, columns: str = "sinkColumns") -> DataFrame:
    """Keep only the ``after`` entries named in the rule's comma list, compared as written."""
    wanted = F.split(F.col(columns), ",")
    return changes.withColumn(
        "after", F.map_filter("after", lambda name, _: F.array_contains(wanted, name)))


def latest_rules(rules: DataFrame, order: list[str]) -> DataFrame:
    """The last rule per source table and operation."""
    last = F.row_number().over(
        Window.partitionBy("sourceTable", "operateType")
        .orderBy(*[F.col(c).desc() for c in order]))
    return rules.withColumn("_row_no", last).where("_row_no = 1").drop("_row_no")


def route_by_rule(changes: DataFrame, rules: DataFrame,
                  max_broadcast_bytes: int = 32 << 20, salts: int = 16) -> DataFrame:
    """Changes that have a rule, pruned, with ``sink_table``, ``sink_type``, ``sink_pk`` and the
    value of that key, ``pk``, which the rule need not list among its columns.

    One rule per source table and operation is expected, see ``latest_rules``. The rules are
    broadcast while they are measured to be small. Beyond that the join is by key and salt:
    there are few tables and operations, so each change takes one of ``salts`` and the rules are
    shown to all. The result is the same.
    """
    picked = rules.select(
        "sourceTable", "operateType", "sinkColumns",
        F.col("sinkType").alias("sink_type"), F.col("sinkTable").alias("sink_table"),
        F.coalesce("sinkPk", F.lit("id")).alias("sink_pk"))
    on = ((F.col("source.table") == F.col("sourceTable"))
          & (F.col("op") == F.col("operateType")))
    if is_small(picked, max_broadcast_bytes):
        picked = F.broadcast(picked)
    else:
        changes = changes.withColumn("_salt", row_salt(changes, salts))
        picked = picked.withColumn("_rule_salt", F.explode(
            F.sequence(F.lit(0), F.lit(salts - 1))))
        on = on & (F.col("_salt") == F.col("_rule_salt"))
    joined = changes.join(picked, on, "inner").drop("_salt", "_rule_salt").withColumn(
        "pk", F.try_element_at("after", F.col("sink_pk")))
    return prune_sink_columns(joined).drop("sourceTable", "operateType", "sinkColumns")


def to_topics(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("sink_type") == codes.SINK_TOPIC)


def to_dimensions(routed: DataFrame) -> DataFrame:
    """Dimension rows that have a key."""
    return routed.where((F.col("sink_type") == codes.SINK_DIMENSION) & F.col("pk").isNotNull())


def without_key(routed: DataFrame) -> DataFrame:
    """Dimension rows whose key is null or missing: no row of the table is theirs."""
    return routed.where((F.col("sink_type") == codes.SINK_DIMENSION) & F.col("pk").isNull())
