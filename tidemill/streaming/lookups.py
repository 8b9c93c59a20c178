"""Dimension lookups in streams whose rows wait for a dimension that is not there yet."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import StructType

from tidemill.operators.joins import row_salt

_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
          "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
#: Rows that are taken out of the state at a time.
_CHUNK = 10_000


class _WaitsForDimension(StatefulProcessor):
    """The newest version of one dimension key, and the rows that wait for its first one.

    A micro-batch's rows get the version that stood before it, so the order in which rows reach
    the task does not matter; if there was none, they are kept until all of the key's rows are
    read, and longer if no version came along. Timers stand at steps of an eighth of the wait, so
    a row that stays is written again a few times only.
    """

    def __init__(self, wait_ms: int):
        self._wait_ms = wait_ms
        self._step = max(1, wait_ms // 8)

    def init(self, handle) -> None:
        self._handle = handle
        self._known = handle.getValueState("known", "place LONG, found STRING")
        self._waiting = handle.getListState("waiting", "due LONG, body STRING")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        before = self._known.get() if self._known.exists() else None
        newest, earliest = before, None
        for part in rows:
            versions = part[part["found"].notna()]
            if len(versions):
                at = np.lexsort([versions["found"], versions["place"]])[-1]
                version = (int(versions["place"].iloc[at]), str(versions["found"].iloc[at]))
                newest = version if newest is None else max(newest, version, key=tuple)
            facts = part[part["body"].notna()]
            if not len(facts):
                continue
            if before is not None:
                yield pd.DataFrame({"body": facts["body"], "found": before[1]})
                continue
            due = -(-(facts["ms"].to_numpy() + self._wait_ms) // self._step) * self._step
            self._waiting.appendList(list(zip(due.tolist(), facts["body"])))
            earliest = min(int(due.min()), due.max() if earliest is None else earliest)
        if newest is not None and newest != before:
            self._known.update(newest)
        if before is None and newest is not None:
            yield from self._released(newest[1])
            self._waiting.clear()
        elif earliest is not None:
            self._handle.registerTimer(
                max(int(earliest), timerValues.getCurrentWatermarkInMs() + 1))

    def _released(self, found: str | None) -> Iterator[pd.DataFrame]:
        bodies = []
        for row in self._waiting.get():
            bodies.append(row[1])
            if len(bodies) == _CHUNK:
                yield pd.DataFrame({"body": bodies, "found": found})
                bodies = []
        if bodies:
            yield pd.DataFrame({"body": bodies, "found": found})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        given_up, left = [], []
        for row in self._waiting.get():
            (given_up if row[0] <= now else left).append((row[0], row[1]))
        if left:
            self._waiting.put(left)
            self._handle.registerTimer(min(due for due, _ in left))
        else:
            self._waiting.clear()
        if given_up:
            yield pd.DataFrame({"body": [body for _, body in given_up], "found": None})

    def close(self) -> None:
        pass


def dim_join_stream(facts: DataFrame, changes: DataFrame, key: str,
                    attributes: dict[str, str | Column], time: str, wait: timedelta,
                    place: str, dim_key: str = "id", delay: str = "0 seconds",
                    salts: int = 16) -> DataFrame:
    """Left lookup between streams: add ``attributes`` (output name -> column of ``changes``).

    A row whose dimension has not come yet waits for it, until the watermark of the rows'
    ``time``, ``delay`` behind, passes its time plus ``wait``; then its attributes are null. No
    row is lost, however late, and none is passed on twice. ``changes`` are versions of the
    dimension; the one with the greatest ``place`` (BIGINT) counts, so an older one that comes
    late changes nothing. A row gets the version that stood before its micro-batch; the first
    version of a key may also come along with it. Versions do not move the watermark, so a
    dimension that rarely changes holds nothing up.

    Rows take one of ``salts``, versions are shown to all: a hot key, known or awaited, spreads
    over that many states. ``salts`` is part of the state's keys and must stay the same for one
    checkpoint. Rows without a key pass at once with null attributes; those without a time
    wait until the next watermark only. Versions without a key or place are left out.
    """
    base = facts.drop(*attributes)
    looked_up = changes.select(*[(F.col(c) if isinstance(c, str) else c).alias(out)
                                 for out, c in attributes.items()]).schema
    text = F.lit(None).cast("string")
    rows = (
        base.withWatermark(time, delay)
        .select(F.col(key).cast("string").alias("key"), row_salt(base, salts).alias("salt"),
                F.coalesce(F.unix_millis(F.col(time).cast("timestamp")), F.lit(0)).alias("ms"),
                F.to_json(F.struct(*base.columns), _TIMES).alias("body"),
                F.lit(0).cast("long").alias("place"), text.alias("found"))
    )
    versions = (
        changes.where(F.col(dim_key).isNotNull() & F.col(place).isNotNull())
        .select(F.col(dim_key).cast("string").alias("key"),
                F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
                F.lit(0).cast("long").alias("ms"), text.alias("body"),
                F.col(place).cast("long").alias("place"),
                F.to_json(F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(out)
                                     for out, c in attributes.items()]), _TIMES).alias("found"))
    )
    # The state does not see the time column, so Spark drops no row as late.
    keyed = rows.where(F.col("key").isNotNull()).unionByName(versions)
    decided = keyed.groupBy("key", "salt").transformWithStateInPandas(
        _WaitsForDimension(wait // timedelta(milliseconds=1)), "body STRING, found STRING",
        outputMode="Append", timeMode="EventTime")
    unkeyed = rows.where(F.col("key").isNull()).select("body", "found")
    names = [*base.columns, *attributes]
    order = [c for c in facts.columns if c in names] + [
        c for c in attributes if c not in facts.columns]
    return (
        decided.unionByName(unkeyed)
        .select(F.from_json("body", _nullable(base.schema), _TIMES).alias("r"),
                F.from_json("found", _nullable(looked_up), _TIMES).alias("d"))
        .select(*[F.col(f"d.`{c}`" if c in attributes else f"r.`{c}`").alias(c) for c in order])
    )


def _nullable(schema: StructType) -> StructType:
    out = StructType()
    for field in schema.fields:
        out.add(field.name, field.dataType, True)
    return out
