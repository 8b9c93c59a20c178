"""Words, word hashes and label folds shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, functions as F

#: A run of anything but ASCII white space; ``bytes.split()`` cuts UTF-8 text in the same places.
WORD = r"[^\x20\x09-\x0D]+"
HASHED_WORDS = 500_000


def fold(column: str, parts: int) -> Column:
    """Which of ``parts`` folds a row is in, by crc32 of the id as text; null for a null id."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(parts))


def lowered(text: bytes | None) -> list[bytes]:
    """Words of a text with A-Z lower-cased (other letters stay); none for null."""
    return text.lower().split() if text else []


def binaries(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    return column.cast(pa.binary()).to_pylist()


class WordHashes(dict):
    """64-bit hashes of words; forgets them all when it holds too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= HASHED_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


#: Bytes of text whose words are hashed at a time.
BLOCK = 1 << 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTES = np.random.default_rng(7).integers(0, 1 << 64, 256, np.uint64)
_LOWERED = _BYTES.copy()
_LOWERED[0x41:0x5B] = _BYTES[0x61:0x7B]
_RATE = 0xD1342543DE82EF95


@lru_cache(maxsize=4)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the rate and of its inverse mod 2^64."""
    out = []
    for rate in (_RATE, pow(_RATE, -1, 1 << 64)):
        powers = np.ones(1, np.uint64)
        for i in range(bits):
            powers = np.concatenate((powers, powers * np.uint64(pow(rate, 1 << i, 1 << 64))))
        out.append(powers)
    return out[0], out[1]


def text_hashes(texts: list[bytes | None], lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts in a row, and how many each text has; ``lower``:
    with A-Z lower-cased.

    A word's hash is a polynomial in its bytes' random values. Those of a block come from one
    running sum over its bytes, so no word becomes an object.
    """
    data = np.frombuffer(b" ".join([t or b"" for t in texts]), np.uint8)
    sizes = np.array([len(t or b"") + 1 for t in texts], np.int64)
    values, found, first = _LOWERED if lower else _BYTES, [], []
    start = 0
    while start < len(data):
        end = start + BLOCK
        while end < len(data):  # to the last space before, or the first one after
            spaces = np.flatnonzero(_SPACE[data[max(start, end - BLOCK):end]])
            if len(spaces):
                end = max(start, end - BLOCK) + int(spaces[-1]) + 1
                break
            end += BLOCK
        part = data[start:end]
        powers, inverse = _powers(max(len(part) - 1, BLOCK - 1).bit_length())
        inside = np.concatenate(([False], ~_SPACE[part], [False]))
        starts, ends = (np.flatnonzero(inside[1:] & ~inside[:-1]),
                        np.flatnonzero(inside[:-1] & ~inside[1:]))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(values[part] * powers[:len(part)], out=sums[1:])
        found.append(mixed((sums[ends] - sums[starts]) * inverse[starts]))
        first.append(starts + start)
        start = end
    edges = np.concatenate(([0], np.cumsum(sizes)))
    places = np.concatenate(first) if first else np.empty(0, np.int64)
    return (np.concatenate(found) if found else np.empty(0, np.uint64),
            np.diff(np.searchsorted(places, edges)))


def window_hashes(hashes: np.ndarray, width: int, multiplier: int) -> np.ndarray:
    """A hash of each run of ``width`` word hashes: a polynomial in an odd multiplier mod 2^64,
    put together from runs of 1, 2, 4 ... words."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    power = lambda k: np.uint64(pow(multiplier, k, 1 << 64))
    runs, size = [hashes], 1
    while 2 * size <= width:
        last = runs[-1]
        runs.append(last[:-size] * power(size) + last[size:])
        size *= 2
    total, done = np.zeros(n, np.uint64), 0
    for k in reversed(range(len(runs))):
        if width >> k & 1:
            total = total * power(1 << k) + runs[k][done:done + n]
            done += 1 << k
    return mixed(total)


def window_hashes_at(hashes: np.ndarray, places: np.ndarray, width: int,
                     multiplier: int) -> np.ndarray:
    """Those of ``window_hashes`` that start at the places."""
    total = np.zeros(len(places), np.uint64)
    for i in range(width):
        total = total * np.uint64(multiplier) + hashes[places + i]
    return mixed(total)


def each_text(texts: list[bytes | None], lower: bool) -> list[np.ndarray]:
    """The word hashes of each text."""
    found, sizes = text_hashes(texts, lower)
    return np.split(found, np.cumsum(sizes)[:-1]) if len(texts) else []


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0x9E3779B97F4A7C15)
    return values ^ (values >> np.uint64(29))


def batches(parts: Iterator[pa.RecordBatch], rows: int = 2000) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that a batch of long texts stays small in Python."""
    for part in parts:
        for start in range(0, part.num_rows, rows):
            yield part.slice(start, rows)
