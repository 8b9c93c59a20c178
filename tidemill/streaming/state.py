"""Keyed state for the two questions that streams cannot answer with built-in operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from tidemill.operators.logs import is_session_entry
from tidemill.operators.visits import show_ahead
from tidemill.session import state_partitions

_FLAG_TYPE = StructType([StructField("seen", BooleanType())])


class _FirstOfDevice(StatefulProcessor):
    """Flags the first row of each device. Holds one row while it reads a batch.

    Only keys of part 0 are devices and have state, one boolean per device; it is kept for ever, unless
    ``ttl_ms`` is set. Rows of other parts are known not to be first.
    """

    def __init__(self, ttl_ms: int | None = None):
        self._ttl_ms = ttl_ms

    def init(self, handle) -> None:
        self._seen = handle.getValueState("seen", _FLAG_TYPE, self._ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if key[1] != 0 or self._seen.exists():
            for part in rows:
                yield pd.DataFrame({"body": part["body"], "is_first": False})
            return
        best = None
        for part in rows:
            if best is not None:
                part = pd.concat([best, part], ignore_index=True)
            at = _nulls_first(part)
            best = part.iloc[at[:1]]
            if len(part) > 1:
                yield pd.DataFrame({"body": part["body"].iloc[at[1:]], "is_first": False})
        if best is not None:
            self._seen.update((True,))
            yield pd.DataFrame({"body": best["body"], "is_first": True})

    def close(self) -> None:
        pass


@F.pandas_udf(BooleanType())
def _earliest_of_batch(device: pd.Series, ts: pd.Series, place: pd.Series) -> pd.Series:
    """Whether a row is the earliest of its device within its Arrow batch."""
    rows = pd.DataFrame({"device": device, "ts": ts, "place": place})
    ordered = rows.iloc[_nulls_first(rows)]
    return (~ordered.duplicated("device")).reindex(rows.index)


def _nulls_first(rows: pd.DataFrame) -> np.ndarray:
    """The order by (ts, place), nulls first as in a batch."""
    return np.lexsort([key for name in ("place", "ts") for key in (
        rows[name].fillna(0).to_numpy(), rows[name].notna().to_numpy())])


def repair_is_new_stream(logs: DataFrame, order: str, device: str = "common.mid",
                         ttl_ms: int | None = None, parts: int | None = None) -> DataFrame:
    """Stream form of ``repair_is_new``: the first row flagged new that reaches a device stays.

    Within a micro-batch the earliest by (``ts``, ``order``) counts as first. Rows flagged old
    bypass the state. Before the shuffle each Arrow batch picks its earliest row per device;
    only those meet in the device's state, the others pass in ``parts`` groups without a
    device or state (four per state partition, whatever it was before a restart), so a hot
    device does not gather in one task. ``order`` is a BIGINT column such as the source offset.
    """
    parts = parts or 4 * state_partitions(logs.sparkSession)
    flagged = F.col("common.is_new").eqNullSafe("1")
    packed = (
        logs.where(flagged)
        .select(F.col(device).alias("device"), "ts", F.col(order).alias("place"),
                F.to_json(F.struct(*logs.columns)).alias("body"))
        .withColumn("part", F.when(_earliest_of_batch("device", "ts", "place"), 0).otherwise(
            F.pmod(F.xxhash64("ts", "place"), F.lit(parts)) + 1))
        .withColumn("device", F.when(F.col("part") == 0, F.col("device")))
    )
    decided = packed.groupBy("device", "part").transformWithStateInPandas(
        _FirstOfDevice(ttl_ms), "body STRING, is_first BOOLEAN", outputMode="Append",
        timeMode="ProcessingTime" if ttl_ms else "None")
    repaired = (
        decided.select(F.from_json("body", logs.schema).alias("r"), "is_first")
        .select("r.*", "is_first")
        .withColumn("common", F.col("common").withField(
            "is_new", F.when(F.col("is_first"), "1").otherwise("0")))
        .select(*logs.columns)
    )
    return logs.where(~flagged).unionByName(repaired)


#: Shards of devices in the state of ``user_jump_stream``.
JUMP_SHARDS = 64

_ROW_TYPE = StructType([
    StructField("device", StringType()), StructField("ts", LongType()),
    StructField("place", LongType()), StructField("entry", BooleanType()),
    StructField("body", StringType())])
_ROW = _ROW_TYPE.fieldNames()


class _JumpsOfShard(StatefulProcessor):
    """Holds the rows of some devices in one time bucket until the watermark shows that
    nothing can come between them any more.

    A row is decided once the watermark reaches its time plus the gap; then its successor
    within the gap, if there is one, has arrived. A timer stands at the earliest undecided
    row, so rows wait at most gap + watermark delay. ``body`` is set for rows that are entries
    and owned by the bucket.
    """

    def __init__(self, gap_ms: int):
        self._gap_ms = gap_ms

    def init(self, handle) -> None:
        self._handle = handle
        self._waiting = handle.getListState("waiting", _ROW_TYPE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        earliest = []
        for part in rows:
            self._waiting.appendList(list(part[_ROW].itertuples(index=False, name=None)))
            earliest.append(int(part["ts"].min()))
        if earliest:
            self._handle.registerTimer(
                max(min(earliest) + self._gap_ms, timerValues.getCurrentWatermarkInMs() + 1))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, gap = timerValues.getCurrentWatermarkInMs(), self._gap_ms
        rows = pd.DataFrame(list(self._waiting.get()), columns=_ROW).sort_values(
            ["device", "ts", "place"], ignore_index=True)
        done = rows["ts"] + gap <= now
        if not done.any():
            return
        followed = (rows["device"].shift(-1) == rows["device"]) & (
            rows["ts"].shift(-1) < rows["ts"] + gap)
        next_entry = rows["entry"].shift(-1, fill_value=False).astype(bool)
        jumped = rows[done & rows["body"].notna() & (~followed | next_entry)]
        left = rows[~done]
        if len(left):
            self._waiting.put(list(left.itertuples(index=False, name=None)))
            self._handle.registerTimer(int(left["ts"].min()) + gap)
        else:
            self._waiting.clear()
        if len(jumped):
            yield jumped[["body"]]

    def close(self) -> None:
        pass


def user_jump_stream(pages: DataFrame, order: str, gap_ms: int = 10_000,
                     delay: str = "2 seconds", device: str = "common.mid",
                     bucket_gaps: int = 30, shards: int = JUMP_SHARDS) -> DataFrame:
    """Stream form of ``user_jump``. A row is emitted after the watermark passes its gap; rows
    later than the watermark are dropped.

    State is kept per shard of devices and time bucket: shards make few calls for many quiet
    devices, buckets (as in the batch form) make several keys of a busy one; fewer
    ``bucket_gaps`` spread it further. ``shards`` is part of the state's keys: it depends on no
    setting of the session and must stay the same for one checkpoint.
    """
    name = F.coalesce(F.concat(F.lit("="), F.col(device)), F.lit(""))
    body = F.when(is_session_entry(), F.to_json(F.struct(*pages.columns)))
    packed = pages.select(
        F.timestamp_millis(F.col("ts")).alias("time"), name.alias("device"), "ts",
        F.col(order).alias("place"), is_session_entry().alias("entry"), body.alias("body"))
    shown = (
        show_ahead(packed, gap_ms, bucket_gaps)
        .withColumn("body", F.when(F.col("_own"), F.col("body"))).drop("_own")
        .withColumn("_shard", F.pmod(F.xxhash64("device"), F.lit(shards)))
        .withWatermark("time", delay)
    )
    jumps = shown.groupBy("_shard", "_bucket").transformWithStateInPandas(
        _JumpsOfShard(gap_ms), "body STRING", outputMode="Append", timeMode="EventTime")
    return jumps.select(F.from_json("body", pages.schema).alias("r")).select("r.*")


#: Shards of devices in the state of ``unique_visit_stream``.
VISIT_SHARDS = 64
_DEVICE_TYPE = StructType([StructField("device", StringType())])


class _FirstOfDay(StatefulProcessor):
    """Passes, for the devices of a shard, the earliest row of the first micro-batch that has rows
    of a device on the day. The state, a map of devices, goes when the watermark passes the day."""

    def init(self, handle) -> None:
        self._handle = handle
        self._seen = handle.getMapState("seen", _DEVICE_TYPE, _FLAG_TYPE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        parts = list(rows)
        if not parts:
            return
        part = pd.concat(parts, ignore_index=True)
        firsts = part.iloc[_nulls_first(part)].drop_duplicates("device")
        known = np.array([self._seen.containsKey((d,)) for d in firsts["device"]], bool)
        if known.all():
            return
        for device in firsts["device"][~known]:
            self._seen.updateValue((device,), (True,))
        self._handle.registerTimer(max(int(key[1]) + 86_400_000,
                                       timerValues.getCurrentWatermarkInMs() + 1))
        yield firsts[~known][["body"]]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def unique_visit_stream(pages: DataFrame, order: str, device: str = "common.mid",
                        delay: str = "1 day", shards: int = VISIT_SHARDS) -> DataFrame:
    """Stream form of ``unique_visit``: the first session-entry row per device and day.

    Within a micro-batch the earliest by (``ts``, ``order``) is first. Before the shuffle each
    Arrow batch keeps only its earliest row per device and day, so a hot device reaches its state
    as a few rows. State is kept per shard of devices and day, so many devices make few calls; a
    day's devices leave it once the watermark, ``delay`` behind, passes the day's end. ``shards``
    is part of the state's keys and must stay the same for one checkpoint.
    """
    day = F.unix_millis(F.date_trunc("day", F.timestamp_millis(F.col("ts"))))
    device_name = F.coalesce(F.concat(F.lit("="), F.col(device)), F.lit(""))
    packed = (
        pages.where(is_session_entry())
        .select(F.timestamp_millis(F.col("ts")).alias("time"), device_name.alias("device"),
                day.alias("day"), "ts", F.col(order).alias("place"),
                F.to_json(F.struct(*pages.columns)).alias("body"))
        .where(_earliest_of_batch(F.concat_ws(" ", "day", "device"), "ts", "place"))
        .withWatermark("time", delay)
    )
    firsts = packed.withColumn("_shard", F.pmod(F.xxhash64("device"), F.lit(shards))).groupBy(
        "_shard", "day").transformWithStateInPandas(
        _FirstOfDay(), "body STRING", outputMode="Append", timeMode="EventTime")
    return firsts.select(F.from_json("body", pages.schema).alias("r")).select("r.*")
