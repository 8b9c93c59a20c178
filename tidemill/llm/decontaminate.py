"""Benchmark decontamination: spaced seeds find candidate overlaps, aligned words verify them."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from math import ceil, comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tidemill.llm.store import bit_filter, in_filter, written
from tidemill.llm.words import WordHashes, batches, binaries, lowered, mixed

#: Masks of a family, and placements of agreeing words that are enumerated to find it, at most.
MOST_MASKS, ENUMERATED = 4, 5000
#: Filter of test-side seeds, two bits each: 2^24 bits (2 MB) whatever the size of the benchmark.
FILTER_BITS = 24


@lru_cache(maxsize=None)
def mask_family(width: int, agree: int) -> tuple[str, ...]:
    """Masks of word positions (1 must agree, 0 may differ), one of which fits inside whichever
    ``agree`` of ``width`` words agree.

    The heaviest masks of which a few are enough, found greedily over all placements; for wide
    windows the run of agreeing words that no placement of the others can break.
    """
    if agree == width:
        return ("1" * width,)
    run = "1" * ceil(agree / (width - agree + 1))
    if comb(width, agree) > ENUMERATED:
        return (run,)
    bits = lambda places: sum(1 << (width - 1 - i) for i in places)
    placements = np.array([bits(c) for c in combinations(range(width), agree)])
    for weight in range(agree, len(run), -1):
        shapes = [c for c in combinations(range(width), weight) if c[0] == 0]
        hits = np.zeros((len(shapes), len(placements)), bool)
        for i, shape in enumerate(shapes):
            for shift in range(width - shape[-1]):
                mask = bits(x + shift for x in shape)
                hits[i] |= placements & mask == mask
        chosen, open_ = [], np.ones(len(placements), bool)
        while open_.any() and len(chosen) < MOST_MASKS:
            best = int((hits & open_).sum(1).argmax())
            chosen.append("".join("1" if x in shapes[best] else "0"
                                  for x in range(shapes[best][-1] + 1)))
            open_ &= ~hits[best]
        if not open_.any():
            return tuple(chosen)
    return (run,)


def _masks(n: int, window: int, similarity: float) -> tuple[str, ...]:
    """Masks for an item of ``n`` words."""
    width = min(window, n)
    return mask_family(width, max(1, ceil(similarity * width)))


def seed_hashes(hashes: np.ndarray, mask: str) -> np.ndarray:
    """A hash of the words each placement of the mask keeps."""
    n = len(hashes) - len(mask) + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.full(n, int(mask, 2), np.uint64)
    for i, kept in enumerate(mask):
        if kept == "1":
            total *= np.uint64(0x5851F42D4C957F2D)
            total += hashes[i:i + n]
    return mixed(total)


def _second(hashes: np.ndarray) -> np.ndarray:
    """Another hash, for the second bit in the filter."""
    return mixed(hashes ^ np.uint64(0xD6E8FEB86659FD93))


def _items(benchmark: DataFrame) -> DataFrame:
    """(item_key, item_id, n, words): words as 64-bit hashes."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for part in batches(parts):
            out = []
            for item, text in zip(part.column(0).to_pylist(), binaries(part.column(1))):
                found = known.of(lowered(text))
                if len(found):
                    data = found.tobytes()
                    key = xxhash.xxh3_64_intdigest(data + str(item).encode())
                    out.append((key - (1 << 63), item, len(found), data))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate(
                    (pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
                ["item_key", "item_id", "n", "words"])
    return benchmark.select(F.col("item_id").cast("long"), "text").mapInArrow(
        run, "item_key long, item_id long, n int, words binary").distinct()


def _seeds(items: DataFrame, masks: dict[int, tuple[str, ...]], window: int) -> DataFrame:
    """(hash, second, item_key, place): every seed of every item."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            seeds, seconds, keys, places = [], [], [], []
            for key, data in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                words = np.frombuffer(data, np.uint64)
                for mask in masks[min(window, len(words))]:
                    found = seed_hashes(words, mask)
                    seeds.append(found.view(np.int64))
                    seconds.append(_second(found).view(np.int64))
                    keys.append(np.full(len(found), key, np.int64))
                    places.append(np.arange(len(found), dtype=np.int32))
            empty = [np.empty(0, np.int64)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x or empty).astype(t)) for x, t in (
                    (seeds, np.int64), (seconds, np.int64), (keys, np.int64), (places, np.int32))],
                ["hash", "second", "item_key", "place"])
    return items.select("item_key", "words").mapInArrow(
        run, "hash long, second long, item_key long, place int")


def _key(docs: DataFrame) -> Column:
    """A hash of id and text."""
    return F.xxhash64(docs["doc_id"].cast("long"), docs["text"])


def _runs(docs: DataFrame, masks: list[str], window: int, filter_bits: np.ndarray) -> DataFrame:
    """Runs of possible hits in documents, with the hashes of the words that any window around
    one of them can hold."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for part in batches(parts):
            out: list[tuple] = []
            for doc, key, text in zip(part.column(0).to_pylist(), part.column(2).to_pylist(),
                                      binaries(part.column(1))):
                words = known.of(lowered(text))
                places, seeds = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
                for mask in masks:
                    found = seed_hashes(words, mask)
                    hit = np.flatnonzero(in_filter(filter_bits, found))
                    hit = hit[in_filter(filter_bits, _second(found[hit]))]
                    places.append(hit)
                    seeds.append(found[hit])
                place, seed = np.concatenate(places), np.concatenate(seeds)
                if not len(place):
                    continue
                order = np.argsort(place, kind="stable")
                place, seed = place[order], seed[order].view(np.int64)
                cuts = np.flatnonzero(np.diff(place) > 2 * window) + 1
                for at, hashes in zip(np.split(place, cuts), np.split(seed, cuts)):
                    first = max(0, int(at[0]) - window)
                    last = int(at[-1]) + window
                    out.append((doc, key, first, words[first:last].tobytes(),
                                at.tolist(), hashes.tolist()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate(
                    (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int32()),
                     pa.list_(pa.int64())))],
                ["doc_id", "doc_key", "first", "around", "places", "hashes"])
    return docs.select(F.col("doc_id").cast("long"), "text", _key(docs)).mapInArrow(
        run, "doc_id long, doc_key long, first int, around binary, places array<int>,"
             " hashes array<long>")


def _verified(pairs: DataFrame, window: int, similarity: float) -> DataFrame:
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out = []
            for r in part.to_pylist():
                around = np.frombuffer(r["around"], np.uint64)
                item = np.frombuffer(r["words"], np.uint64)
                start = r["diagonal"] - r["first"]  # of the item within the words around
                low, high = max(0, -start), min(len(item), len(around) - start)
                width = min(window, len(item))
                if high - low < width:
                    continue
                sums = np.concatenate(([0], np.cumsum(
                    item[low:high] == around[low + start:high + start])))
                same = sums[width:] - sums[:-width]
                best = int(same.argmax())
                if same[best] >= similarity * width:
                    out.append((r["doc_id"], r["doc_key"], r["item_id"], r["diagonal"] + low + best,
                                low + best, width, int(same[best])))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], t) for i, t in enumerate(
                    (*[pa.int64()] * 3, *[pa.int32()] * 4))],
                ["doc_id", "doc_key", "item_id", "doc_start", "item_start", "n_words", "n_same"])
    return pairs.mapInArrow(run, "doc_id long, doc_key long, item_id long, doc_start int,"
                                 " item_start int, n_words int, n_same int")


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 13,
                 similarity: float = 0.75) -> DataFrame:
    """Documents that hold a passage of a benchmark item, word substitutions tolerated.

    Words are compared with A-Z lower-cased. Every placement of every mask in a document is
    hashed, and passes a filter of fixed size to an exact join with the items' seeds. A hit
    aligns document and item; the pair counts if some ``window`` consecutive words of the item
    (all, if it has fewer) agree with the aligned ones of the document in at least the share
    ``similarity``. The masks for a number of words fit into every such agreement, so each
    window that counts is seeded, whichever words are substituted.

    Null or empty texts and items match nothing. Ids may be null or repeated: an item and
    a text of an id are returned once, with their best window (then the first); ``doc_key`` tells
    the texts of an id apart. Other columns are not read.

    Result: doc_id, doc_key, item_id, doc_start, item_start, n_words, n_same (words counted from 0).
    """
    items = written(_items(benchmark), "seed-items")
    widths = items.select(F.least("n", F.lit(window)).alias("n")).distinct().collect()
    families = {r.n: _masks(r.n, window, similarity) for r in widths}
    masks = sorted({m for family in families.values() for m in family})
    seeds = _seeds(items, families, window)
    bits = bit_filter(seeds.select(F.explode(F.array("hash", "second")).alias("hash")), "hash",
                      FILTER_BITS)
    runs = written(_runs(docs, masks, window, bits), "seed-runs")
    hits = runs.select("doc_key", "first", F.explode(F.arrays_zip("places", "hashes")).alias("hit"))
    hits = hits.select("doc_key", "first", F.col("hit.places").alias("at"),
                       F.col("hit.hashes").alias("hash"))
    aligned = (hits.join(seeds.drop("second"), "hash")
               .select("doc_key", "first", "item_key", (F.col("at") - F.col("place"))
                       .alias("diagonal")).distinct())
    around = runs.select("doc_id", "doc_key", "first", "around").distinct()
    pairs = (aligned.join(around, ["doc_key", "first"])
             .join(items.select("item_key", "item_id", "words"), "item_key")
             .select("doc_id", "doc_key", "item_id", "first", "diagonal", "around", "words"))
    return _best(_verified(pairs, window, similarity), "doc_id", "doc_key", "item_id")


def _best(found: DataFrame, *names: str) -> DataFrame:
    """The best window (then the first) of all rows that agree in the names."""
    best = F.max(F.struct("n_same", (-F.col("doc_start")).alias("doc"),
                          (-F.col("item_start")).alias("item"), "n_words")).alias("best")
    return found.groupBy(*names).agg(best).select(
        *names, (-F.col("best.doc")).alias("doc_start"), (-F.col("best.item")).alias("item_start"),
        F.col("best.n_words"), F.col("best.n_same"))


def pairs_of_ids(found: DataFrame) -> DataFrame:
    """Each pair of ids once, with the best window of all texts of the document's id."""
    return _best(found, "doc_id", "item_id")


def without_contaminated(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Documents of which no passage was found, told by id (null ids compared as equal) and text."""
    bad = found.select(F.col("doc_id").alias("bad_id"), F.col("doc_key").alias("bad_key")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["bad_id"])
                     & (_key(docs) == bad["bad_key"]), "left_anti")
