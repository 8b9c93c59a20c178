"""Substring dedup: hashes at difference-cover positions find what texts share, then it extends."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from tidemill.llm.store import written
from tidemill.llm.words import batches, binaries, each_text, window_hashes, window_hashes_at

#: Positions p with p mod 7 in the cover are hashed. Any two positions have a shift under 7
#: that brings both into the cover, so two equal runs of 13 words share an equal run of 7
#: words that starts at cover positions of both.
PERIOD, COVER = 7, (0, 1, 3)
WINDOW = 13
ANCHOR = WINDOW - PERIOD + 1
#: What occurs in this share of a sample of the documents is hot; at most the documents' mean
#: length divided by the share is.
SAMPLE, HOT_SHARE, HOT_LEAST = 64, 0.002, 8
#: Bits of the filter of exact copies: 2 MB whatever their number.
FILTER_BITS = 24
_ANCHOR_BITS = np.uint64((1 << 48) - 1)
_A, _B, _C = 0x2545F4914F6CDD1D, 0x5851F42D4C957F2D, 0x9E6C63D0876A9A47


class Hot(NamedTuple):
    """Sorted hashes of hot anchors and hot windows; the smallest id that has each window."""

    anchors: np.ndarray
    windows: np.ndarray
    least: np.ndarray


def anchors(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cover positions and the hashes of the words from there."""
    found = window_hashes(hashes, ANCHOR, _A) & _ANCHOR_BITS
    places = np.flatnonzero(np.isin(np.arange(len(found)) % PERIOD, COVER))
    return places, found[places]


def _within(sorted_values: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether and where each value is in a sorted array."""
    if not len(sorted_values):
        return np.zeros(len(values), bool), np.zeros(len(values), np.int64)
    at = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
    return sorted_values[at] == values, at


def _near(places: np.ndarray, windows: int) -> np.ndarray:
    """Windows that hold an anchor at one of the places."""
    edge = np.zeros(windows + PERIOD + 1, np.int64)
    np.add.at(edge, np.maximum(places - PERIOD + 1, 0), 1)
    np.add.at(edge, np.minimum(places + 1, windows + PERIOD), -1)
    return np.cumsum(edge)[:windows] > 0


def _tag(text: bytes) -> int:
    return xxhash.xxh32_intdigest(text) - (1 << 31)


def _words(text: bytes | None) -> list[bytes]:
    return text.split() if text else []


def hot_runs(docs: DataFrame) -> Hot:
    """Anchors and windows that very many documents share, with the first holder of each window."""
    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0)

    def sampled(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(parts, 500):
            hashes, kinds = [], []
            for words in each_text(binaries(part.column(1)), False):
                for kind, found in enumerate((anchors(words)[1], window_hashes(words, WINDOW, _B))):
                    found = np.unique(found)
                    hashes.append(found)
                    kinds.append(np.full(len(found), kind, np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(hashes or [np.empty(0, np.uint64)]).view(np.int64)),
                 pa.array(np.concatenate(kinds or [np.empty(0, np.int32)]))], ["hash", "kind"])
    least = max(HOT_LEAST, int(HOT_SHARE * sample.count()))
    rows = (sample.mapInArrow(sampled, "hash long, kind int").groupBy("hash", "kind").count()
            .where(F.col("count") >= least).select("hash", "kind").collect())
    both = [np.sort(np.array([r.hash for r in rows if r.kind == k], np.int64).view(np.uint64))
            for k in (0, 1)]
    if not len(both[1]):
        return Hot(both[0], both[1], np.empty(0, np.int64))
    hot = docs.sparkSession.sparkContext.broadcast(both[1])

    def first(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = np.full(len(hot.value), np.iinfo(np.int64).max)
        for part in batches(parts, 500):
            for doc, words in zip(part.column(0).to_pylist(),
                                  each_text(binaries(part.column(1)), False)):
                if doc is not None:
                    hit, at = _within(hot.value, window_hashes(words, WINDOW, _B))
                    np.minimum.at(low, at[hit], doc)
        seen = np.flatnonzero(low < np.iinfo(np.int64).max)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(low[seen])], ["at", "doc_id"])
    lows = np.full(len(both[1]), np.iinfo(np.int64).max)
    for at, doc in (docs.mapInArrow(first, "at long, doc_id long").groupBy("at")
                    .agg(F.min("doc_id")).collect()):
        lows[at] = doc
    return Hot(both[0], both[1], lows)


def without_repeats(docs: DataFrame) -> DataFrame:
    """Remove from every document the words of 13-word windows that also start in a document
    with a smaller id.

    Exact copies of a text are settled first. The others' anchors that two documents share
    (found by dealing anchors by hash) mark windows around them; the marked windows are dealt by
    hash, and one that a smaller id has too is removed. Anchors and windows that a share of
    the documents hold are recognised from a sample and settled without dealing them, so no
    task gets all the holders of a common passage. Anchors only propose: windows are compared
    by 96 bits, hot ones by 64. Words are compared unchanged.

    A null text has no words. A null id is neither smaller nor larger than another: such rows
    lose and cause nothing. Rows with one id are one document with several texts. Other columns
    are not read.

    Result: doc_id, n_words, n_removed, kept_sha256 and kept_text; one row per row.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    known_ids = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    sent = docs.sparkSession.sparkContext.broadcast(hot_runs(docs))

    named = known_ids.select("doc_id", F.md5("text").alias("name"))
    firsts = named.groupBy("name").agg(F.min("doc_id").alias("first"))
    copies = written(named.join(firsts, "name").where("doc_id > first")
                     .select("doc_id", "name").distinct(), "passages-copies")

    def emitted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = sent.value
        for part in batches(parts, 500):
            hashes, places, ids = [], [], []
            for doc, words in zip(part.column(0).to_pylist(),
                                  each_text(binaries(part.column(1)), False)):
                at, found = anchors(words)
                if len(found):
                    cold = ~_within(hot.anchors, found)[0]
                    hashes.append(found[cold].view(np.int64))
                    places.append(at[cold].astype(np.int32))
                    ids.append(np.full(len(places[-1]), doc, np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x or [np.empty(0, t)]).astype(t)) for x, t in (
                    (hashes, np.int64), (ids, np.int64), (places, np.int32))],
                ["hash", "doc_id", "place"])
    single = _without_copies(known_ids, copies)
    dealt = single.select("doc_id", "text").mapInArrow(
        emitted, "hash long, doc_id long, place int")
    holders = Window.partitionBy("hash")
    shared = (dealt.withColumn("low", F.min("doc_id").over(holders))
              .withColumn("high", F.max("doc_id").over(holders)).where("low < high")
              .select("doc_id", "place"))
    marks = written(shared.withColumn("name", F.lit(None).cast("string")).unionByName(
        copies.select("doc_id", F.lit(None).cast("int").alias("place"), "name"))
        .groupBy("doc_id").agg(F.collect_list("place").alias("places"),
                               F.collect_set("name").alias("copies")), "passages-marks")

    def extended(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = sent.value
        for part in batches(parts, 500):
            out: list[list] = [[] for _ in range(5)]
            texts = binaries(part.column(1))
            for doc, text, marked, copied, words in zip(
                    part.column(0).to_pylist(), texts, part.column(2),
                    part.column(3).to_pylist(), each_text(texts, False)):
                count = len(words) - WINDOW + 1
                if count <= 0 or copied and hashlib.md5(text).hexdigest() in copied:
                    continue  # a copy goes whole, and its first holder has its windows too
                marked = marked.values.to_numpy() if marked.is_valid else np.empty(0, np.int32)
                at, found = anchors(words)
                places = np.concatenate((marked, at[_within(hot.anchors, found)[0]]))
                if not len(places):
                    continue
                first = window_hashes(words, WINDOW, _B)
                pick = np.flatnonzero(_near(places.astype(np.int64), count)
                                      & ~_within(hot.windows, first)[0])
                second = window_hashes_at(words, pick, WINDOW, _C) >> np.uint64(32)
                for column, value in zip(out, (
                        first[pick].view(np.int64), second.astype(np.uint32).view(np.int32),
                        np.full(len(pick), doc, np.int64), np.full(len(pick), _tag(text), np.int32),
                        pick.astype(np.int32))):
                    column.append(value)
            types = (np.int64, np.int32, np.int64, np.int32, np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x or [np.empty(0, t)]).astype(t))
                 for x, t in zip(out, types)], ["hash", "check", "doc_id", "tag", "place"])
    windows = known_ids.join(marks, "doc_id", "left").mapInArrow(
        extended, "hash long, check int, doc_id long, tag int, place int")
    holders = Window.partitionBy("hash", "check")
    repeats = (windows.withColumn("low", F.min("doc_id").over(holders)).where("low < doc_id")
               .select("doc_id", "tag", "place"))
    copied = copies.select("doc_id", F.lit(0).alias("tag"), F.lit(-1).alias("place"), "name")
    removed = written(repeats.withColumn("name", F.lit(None).cast("string")).unionByName(copied)
                      .groupBy("doc_id").agg(
                          F.collect_list(F.struct("tag", "place")).alias("places"),
                          F.collect_set("name").alias("copies")), "passages-removed")

    def kept(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = sent.value
        for part in batches(parts, 500):
            out: list[list] = [[] for _ in range(4)]
            texts = binaries(part.column(1))
            for doc, text, places, copied, hashes in zip(
                    part.column(0).to_pylist(), texts, part.column(2),
                    part.column(3).to_pylist(), each_text(texts, False)):
                words = _words(text)
                gone = _removed(hashes, doc, text, places, copied, hot)
                left = b" ".join(w for w, g in zip(words, gone) if not g) if gone.any() else \
                    b" ".join(words)
                for column, value in zip(out, (len(words), int(gone.sum()),
                                               hashlib.sha256(left).hexdigest(), left)):
                    column.append(value)
            types = (pa.int64(), pa.int64(), pa.string(), pa.binary())
            columns = [pa.array(x, t) for x, t in zip(out, types)]
            columns[3] = columns[3].cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *columns],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])
    return docs.join(removed, "doc_id", "left").mapInArrow(
        kept, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")


def _without_copies(docs: DataFrame, copies: DataFrame) -> DataFrame:
    """Documents that are not in ``copies`` (doc_id, name); a copy is told from other texts of
    its id by its name.

    Most are told by a filter of 2^24 bits, at most 2^18 rows of 64, without a shuffle; only
    the texts that may be copies are shuffled to be compared with them.
    """
    place = F.xxhash64("doc_id", "name").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    bit = F.expr("shiftleft(1L, cast(place & 63L as int))")
    words = (copies.withColumn("place", place)
             .select(F.shiftright("place", 6).alias("word"), bit.alias("bit"))
             .groupBy("word").agg(F.bit_or("bit").alias("bits")))
    tested = (docs.withColumn("name", F.md5("text")).withColumn("place", place)
              .withColumn("word", F.shiftright("place", 6))
              .join(F.broadcast(words), "word", "left")
              .withColumn("hit", F.coalesce("bits", F.lit(0).cast("long")).bitwiseAND(bit) != 0))
    named = copies.select(F.col("doc_id").alias("copy_id"), F.col("name").alias("copy"))
    kept = tested.where("hit").select("doc_id", "text", "name").join(
        named, (F.col("doc_id") == F.col("copy_id")) & (F.col("name") == F.col("copy")),
        "left_anti").select("doc_id", "text")
    return tested.where("NOT hit").select("doc_id", "text").unionByName(kept)


def _removed(words: np.ndarray, doc: int | None, text: bytes | None, places: pa.Scalar,
             copied: list[str] | None, hot: Hot) -> np.ndarray:
    """Which words of a text go."""
    count = len(words) - WINDOW + 1
    if doc is None or count <= 0:
        return np.zeros(len(words), bool)
    if copied and hashlib.md5(text).hexdigest() in copied:
        return np.ones(len(words), bool)
    start = np.zeros(count, bool)
    if places.is_valid and len(places.values):
        tags, at = (places.values.field(i).to_numpy() for i in (0, 1))
        start[at[(tags == _tag(text)) & (at >= 0)]] = True
    if len(hot.windows):
        hit, at = _within(hot.windows, window_hashes(words, WINDOW, _B))
        start[hit] = hot.least[at[hit]] < doc
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:count] += start
    edge[WINDOW:] -= start
    return np.cumsum(edge)[:len(words)] > 0
