"""Byte-level BPE: the pieces of texts are merged together, in padded matrices of like length."""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

#: Bytes of a vocabulary file that may be sent to the tasks.
LARGEST_FILE = 1 << 26
#: Longest pieces, in bytes, that share a matrix; ids in one matrix.
WIDEST, CELLS = 256, 1 << 18
#: Bytes of text that are cut into pieces at a time, and pieces whose ids a task remembers.
SLICE, REMEMBERED = 1 << 21, 400_000
#: No id; stands in the padding.
NONE = np.uint32(0xFFFFFFFF)
#: The rank of a pair that does not merge.
NEVER = np.int32(0x7FFFFFFF)


class Pairs:
    """Ranks of pairs of ids in a table with open addressing."""

    def __init__(self, keys: np.ndarray, ranks: np.ndarray) -> None:
        self.bits = max(4, (2 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, np.uint64(0xFFFFFFFFFFFFFFFF))
        self.ranks = np.full(1 << self.bits, NEVER)
        self.probes, rows, place = 0, np.arange(len(keys)), self._home(keys)
        while len(rows):
            self.probes += 1
            free = np.flatnonzero(self.ranks[place] == NEVER)
            taken, first = np.unique(place[free], return_index=True)
            self.keys[taken], self.ranks[taken] = keys[rows[free[first]]], ranks[rows[free[first]]]
            left = np.ones(len(rows), bool)
            left[free[first]] = False
            rows, place = rows[left], self._next(place[left])

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _next(self, place: np.ndarray) -> np.ndarray:
        return (place + 1) & (len(self.keys) - 1)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, in the shape of ``left``."""
        keys = (left.astype(np.uint64) << np.uint64(32) | right).ravel()
        place = self._home(keys)
        out = np.where(self.keys[place] == keys, self.ranks[place], NEVER)
        rows = np.flatnonzero((self.keys[place] != keys) & (self.ranks[place] != NEVER))
        place = place[rows]
        for _ in range(self.probes - 1):
            if not len(rows):
                break
            place = self._next(place)
            found = self.keys[place] == keys[rows]
            out[rows[found]] = self.ranks[place[found]]
            going = ~found & (self.ranks[place] != NEVER)
            rows, place = rows[going], place[going]
        return out.reshape(left.shape)


class Vocabulary:
    """Tokens by rank, which is their id; two neighbours merge if their bytes are a token."""

    def __init__(self, file: bytes) -> None:
        self.ranks = {base64.b64decode(token): int(rank)
                      for token, rank in map(bytes.split, file.splitlines()) if token}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        try:
            self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.uint32)
        except KeyError as missing:
            raise ValueError(f"the vocabulary has no token for byte {missing}") from None
        splits = [(self.ranks[token[:i]], self.ranks[token[i:]], rank)
                  for token, rank in self.ranks.items() for i in range(1, len(token))
                  if token[:i] in self.ranks and token[i:] in self.ranks]
        table = np.array(splits, np.uint64).reshape(-1, 3)
        self.pairs = Pairs(table[:, 0] << np.uint64(32) | table[:, 1], table[:, 2].astype(np.int32))

    def encoded(self, pieces: Iterable[bytes]) -> dict[bytes, bytes]:
        """The ids of each piece, as the bytes of 32-bit numbers."""
        out, rest = {}, []
        for piece in set(pieces):
            rank = self.ranks.get(piece)
            if rank is not None:
                out[piece] = np.uint32(rank).tobytes()
            elif len(piece) > WIDEST:
                out[piece] = self._long(piece)
            elif piece:
                rest.append(piece)
            else:
                out[piece] = b""
        rest.sort(key=len)
        start = 0
        while start < len(rest):
            # a bucket: pieces at most half longer than its shortest
            limit, end = max(4, 3 * len(rest[start]) // 2), start
            while (end < len(rest) and len(rest[end]) <= limit
                   and (end - start) * limit <= CELLS):
                end += 1
            out.update(self._merged(rest[start:end]))
            start = end
        return out

    def _merged(self, pieces: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """All pieces at once: in each round every row merges the leftmost of its pairs of
        the smallest rank, and rows without such a pair leave."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        width = int(lengths.max())
        ids = np.full((len(pieces), width), NONE)
        ids[np.arange(width) < lengths[:, None]] = self.of_byte[
            np.frombuffer(b"".join(pieces), np.uint8)]
        ranks, names = self.pairs.of(ids[:, :-1], ids[:, 1:]), np.arange(len(pieces))
        while len(names):
            rows = np.arange(len(names))
            at = ranks.argmin(1) if width > 1 else np.zeros(len(names), np.int64)
            least = ranks[rows, at] if width > 1 else np.full(len(names), NEVER)
            ended = least == NEVER
            if ended.any():
                for name, row in zip(names[ended].tolist(), ids[ended]):
                    yield pieces[name], row[row != NONE].tobytes()
                going = ~ended
                ids, ranks, names = ids[going], ranks[going], names[going]
                at, least, rows = at[going], least[going], rows[:len(names)]
                if not len(names):
                    break
            ids[rows, at] = least
            width -= 1  # every row has lost an id, so the matrix loses a column
            column = np.arange(width)
            ids = np.take_along_axis(ids, column + (column > at[:, None]), 1)
            ranks = np.take_along_axis(ranks, column[:-1] + (column[:-1] >= at[:, None]), 1)
            for here, some in ((at - 1, at > 0), (at, at < width - 1)):
                row, left = rows[some], here[some]
                ranks[row, left] = self.pairs.of(ids[row, left], ids[row, left + 1])

    def _long(self, piece: bytes) -> bytes:
        """The same merges in the same order for one very long piece, whose rounds would each
        cost its whole length in a matrix: pairs wait in a heap by rank, then place."""
        ids = self.of_byte[np.frombuffer(piece, np.uint8)].tolist()
        n, get = len(ids), self.ranks.get
        tokens = self.tokens
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def rank(i: int) -> int | None:
            j = after[i]
            return get(tokens[ids[i]] + tokens[ids[j]]) if j < n else None

        heap = [(r, i) for i in range(n - 1) if (r := rank(i)) is not None]
        heapq.heapify(heap)
        while heap:
            least, i = heapq.heappop(heap)
            if ids[i] < 0 or rank(i) != least:
                continue  # one of the two has merged otherwise
            j = after[i]
            ids[i], ids[j], after[i] = least, -1, after[j]
            if after[j] < n:
                before[after[j]] = i
            for place in (before[i], i):
                if place >= 0 and (r := rank(place)) is not None:
                    heapq.heappush(heap, (r, place))
        return np.array([x for x in ids if x >= 0], np.uint32).tobytes()

    def decoded(self, ids: Iterable[int]) -> bytes:
        """The bytes of the tokens; an id the vocabulary does not have is an error."""
        return b"".join(map(self.tokens.__getitem__, ids))


@lru_cache(maxsize=2)
def vocabulary(file: bytes) -> Vocabulary:
    """The vocabulary, kept by the process for the tasks to come."""
    return Vocabulary(file)


def vocabulary_file(path: str) -> bytes:
    """The ranks in a file of the submitter: a token in base 64 and its rank on each line."""
    with open(path, "rb") as file:
        content = file.read(LARGEST_FILE + 1)
    if len(content) > LARGEST_FILE:
        raise ValueError(f"{path} has more than {LARGEST_FILE} bytes")
    return content


def _slices(parts: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``SLICE`` bytes of a column or one row."""
    for part in parts:
        sizes = pc.binary_length(part.column(column).cast(pa.binary())).fill_null(0)
        ends = sizes.to_numpy(zero_copy_only=False).astype(np.int64).cumsum()
        start = 0
        while start < part.num_rows:
            used = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, used + SLICE, "right")))
            yield part.slice(start, end - start)
            start = end


def encoded(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """The ids of each whole text under the byte-level BPE vocabulary at ``path``.

    ``pattern`` cuts a text into pieces; each piece that is a token is one id, others are merged
    from their bytes: the leftmost pair of the smallest rank first. Marks of special tokens are
    ordinary text. A null or empty text has no ids; ids of rows may be null or repeated, every
    row stands for itself; other columns are not read. The vocabulary (of at most 64 MB) goes
    to the tasks; a task remembers the ids of a bounded number of pieces.

    Result: doc_id, ids; one row per row. No row leaves its partition.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary_file(path))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, cut, memory = vocabulary(sent.value), regex.compile(pattern), {}
        for part in _slices(parts, 1):
            texts = [cut.findall(t) if t else [] for t in part.column(1).to_pylist()]
            new = {p for pieces in texts for p in pieces if p not in memory}
            if len(memory) + len(new) > REMEMBERED:
                memory.clear()
                new = {p for pieces in texts for p in pieces}
            memory.update((p.decode(), x) for p, x in known.encoded(map(str.encode, new)).items())
            ids = [b"".join(map(memory.__getitem__, pieces)) for pieces in texts]
            ends = np.cumsum([0, *(len(x) // 4 for x in ids)])
            yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), np.int32)))],
                ["doc_id", "ids"])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, ids array<int>")


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """Rows with ``ids``, and the bytes that these stand for as ``decoded``.

    Null ``ids`` stand for no bytes; an id that is null or not in the vocabulary is an error.
    """
    sent = rows.sparkSession.sparkContext.broadcast(vocabulary_file(path))
    names = [c for c in rows.columns if c != "decoded"]
    at = names.index("ids")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(sent.value)
        for part in parts:
            column = part.column(at)
            if column.values.null_count:
                raise ValueError("ids hold a null")
            flat, ends = column.values.to_numpy(), column.offsets.to_numpy().tolist()
            # a row at a time: as Python's numbers, all ids of a batch would take much more room
            texts = [known.decoded(flat[i:j].tolist() if valid else ())
                     for i, j, valid in zip(ends, ends[1:], column.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(texts, pa.binary())], [*names, "decoded"])
    schema = rows.select(*names).schema.add("decoded", "binary")
    return rows.select(*names).mapInArrow(run, schema)
