"""Change envelopes from text, where to start in them, and rules kept as a changing table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemill import schemas
from tidemill.operators.changes import latest_rules
from tidemill.operators.logs import split_dirty


def change_envelopes(lines: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(changes, dirty lines) of change-envelope JSON."""
    return split_dirty(lines, schemas.CHANGE, value)


def start_at(changes: DataFrame, mode: str, snapshot: DataFrame | None = None,
             timestamp_ms: int | None = None, place: str | None = None,
             offset: int | None = None) -> DataFrame:
    """What a reader of stored changes sees: ``initial`` is the snapshot and then every change,
    ``earliest`` every change, ``timestamp`` the changes from that time on, ``offset`` those
    from a ``place`` on, ``latest`` those after the place that was the last at the start."""
    if mode == "initial":
        return snapshot.unionByName(changes) if snapshot is not None else changes
    if mode == "earliest":
        return changes
    if mode == "timestamp" and timestamp_ms is not None:
        return changes.where(F.col("ts_ms") >= timestamp_ms)
    if mode == "offset" and place and offset is not None:
        return changes.where(F.col(place) >= offset)
    if mode == "latest" and place and offset is not None:
        return changes.where(F.col(place) > offset)
    raise ValueError(f"unknown or incomplete start mode: {mode}")


def rule_table(rule_changes: DataFrame, order: list[str]) -> DataFrame:
    """Routing rules from the changes of the rule table: the last one per table and operation."""
    fields = [f.split()[0] for f in schemas.RULE.split(",")]
    rows = rule_changes.where("NOT (op <=> 'd')").select(
        *[F.col("after")[f].alias(f) for f in fields], *order)
    return latest_rules(rows, order).drop(*order)
