"""Hard negatives: exact integer scores from products of packed numbers, anchors against all rows."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidemill.llm.store import written

#: Components in a block of candidates, candidate blocks in a slice, components in a block of
#: anchors: one task compares an anchor block with a slice.
BLOCK_CELLS, SLICE_BLOCKS, ANCHOR_CELLS = 1 << 17, 2, 1 << 18
#: Scores that a task looks at together.
SCORES = 1 << 20
#: Bits of an integer that a double holds exactly, and fields of a Python integer beyond that.
EXACT_BITS, WIDE_FIELDS = 53, 16
#: No score.
LOWEST = np.int64(-1 << 63)

BLOCKS = "size int, block int, n int, ids binary, labels binary, parts binary"


def _blocks(rows: DataFrame, count: int) -> DataFrame:
    """One row per block of whole rows with ids in order; rows of one size are together."""
    def packed(group: pa.Table) -> pa.Table:
        size, block = group.column("size")[0].as_py(), group.column("block")[0].as_py()
        ids, labels = (group.column(c).to_numpy() for c in ("vec_id", "label"))
        order = np.lexsort((labels, ids))
        values = group.column("embedding").combine_chunks().flatten().to_numpy(
            zero_copy_only=False)
        parts = np.floor(values.astype(np.float64) * 256).reshape(len(ids), size)[order]
        largest = float(np.abs(parts).max(initial=1))
        if size * largest * largest >= 2.0 ** 62:
            raise OverflowError(f"scores of components of {largest / 256:g} do not fit into a long")
        kind = np.min_scalar_type(-int(largest) - 1)
        return pa.table({"size": pa.array([size], pa.int32()), "block": pa.array([block], pa.int32()),
                         "n": pa.array([len(ids)], pa.int32()),
                         "ids": [ids[order].astype(np.int64).tobytes()],
                         "labels": [labels[order].astype(np.int64).tobytes()],
                         "parts": [parts.astype(kind).tobytes()]})
    block = F.pmod(F.xxhash64("vec_id", "label", "embedding"), F.lit(count)).cast("int")
    return rows.withColumn("block", block).groupBy("size", "block").applyInArrow(packed, BLOCKS)


class Block:
    """Rows of a block, as arrays."""

    def __init__(self, size: int, n: int, ids: bytes, labels: bytes, parts: bytes) -> None:
        self.ids, self.labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
        width = len(parts) // (n * size) if size else 1
        self.parts = np.frombuffer(parts, f"i{width}").reshape(n, size).astype(np.int64)


def products(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows (anchors x candidates) by Kronecker packing.

    Components are biased to be 0 or more. Several candidates' components stand in separated
    fields of one wide integer, each as wide as a whole score can become; it is multiplied once
    with the anchor's component, and the sum over components holds the candidates' scores in its
    fields. As long as these fields fit into the 53 bits that a double holds exactly, the sums
    of products are a matrix product of doubles; beyond, of Python's integers.
    """
    (n, size), m = anchors.shape, len(candidates)
    if not size or not n or not m:
        return np.zeros((n, m), np.int64)
    low_a, low_c = int(anchors.min()), int(candidates.min())
    a, c = anchors - low_a, candidates - low_c
    bits = max(1, (size * int(a.max()) * int(c.max())).bit_length())
    fields = EXACT_BITS // bits
    exact = fields > 0
    fields = fields or WIDE_FIELDS
    columns = -(-m // fields)
    padded = np.zeros((fields * columns, size), np.int64)
    padded[:m] = c
    by_field = padded.reshape(fields, columns, size)
    if exact:
        packed = np.zeros((columns, size), np.int64)
        for field in range(fields):
            packed |= by_field[field] << np.int64(field * bits)
        wide = (a.astype(np.float64) @ packed.T.astype(np.float64)).astype(np.int64)
        mask = np.int64((1 << bits) - 1)
    else:
        wide = sum(by_field[field].astype(object) << (field * bits) for field in range(fields))
        wide = a.astype(object) @ wide.T
        mask = (1 << bits) - 1
    biased = np.concatenate([(wide >> (field * bits)) & mask for field in range(fields)], 1)[:, :m]
    # sum((a + x)(c + y)) = sum(ac) + y sum(a) + x sum(c) + n x y, for biases x and y
    rest = (low_c * a.sum(1))[:, None] + low_a * c.sum(1) + size * low_a * low_c
    return (biased + rest).astype(np.int64)


def _top(scores: np.ndarray, allowed: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's ``most`` highest allowed scores, the smaller column at ties."""
    m = scores.shape[1]
    most = min(most, m)
    if not most:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    if max(abs(int(scores.max())), abs(int(scores.min()))) < (1 << 62) // m:
        keys = np.where(allowed, scores * m + np.arange(m - 1, -1, -1), LOWEST)
        columns = np.argpartition(keys, m - most, axis=1)[:, m - most:]
    else:
        columns = np.lexsort((np.broadcast_to(np.arange(m), scores.shape), -scores, ~allowed),
                             axis=1)[:, :most]
    rows = np.repeat(np.arange(len(scores)), most)
    columns = columns.ravel()
    kept = allowed[rows, columns]
    return rows[kept], columns[kept]


def _first(names: tuple, scores: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` highest scores, then smallest ids, for each value of ``names``."""
    order = np.lexsort((ids, -scores, *names[::-1]))
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([x[order][1:] != x[order][:-1] for x in names], axis=0)
    starts = np.flatnonzero(new)
    return order[np.arange(len(order)) - np.repeat(starts, np.diff([*starts, len(order)])) < most]


def _compared(anchors: DataFrame, candidates: DataFrame, anchor_blocks: int, slices: int,
              work: Callable[[dict, list[Block]], dict], schema: str) -> DataFrame:
    """``work`` on each block of anchors with each slice of the candidates' blocks."""
    key = ["size", "anchor_block", "slice"]
    left = (anchors.withColumnRenamed("block", "anchor_block")
            .withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))))
    right = (candidates.withColumn("slice", F.pmod("block", F.lit(slices)))
             .withColumn("anchor_block", F.explode(F.sequence(F.lit(0), F.lit(anchor_blocks - 1)))))

    def run(one: pa.Table, many: pa.Table) -> pa.Table:
        names = [field.split()[0] for field in schema.split(", ")]
        blocks = [Block(**{c: row[c] for c in ("size", "n", "ids", "labels", "parts")})
                  for row in many.to_pylist()]
        out = [work(row, blocks) | {"size": row["size"], "anchor_block": row["anchor_block"]}
               for row in one.to_pylist()]
        return pa.concat_tables([pa.table({
            c: pa.array(np.broadcast_to(part[c], len(part["at"])),
                        pa.int32() if c in key else pa.int64()) for c in names})
            for part in out]) if out else pa.table({
                c: pa.array([], pa.int32() if c in key else pa.int64()) for c in names})
    return left.groupBy(key).cogroup(right.groupBy(key)).applyInArrow(run, schema)


def _joined(found: list[tuple[np.ndarray, ...]], columns: int) -> list[np.ndarray]:
    return [np.concatenate(x) for x in zip(*found)] or [np.empty(0, np.int64)] * columns


def _anchors(row: dict) -> Block:
    return Block(row["size"], row["n"], row["ids"], row["labels"], row["parts"])


def _positives(most: int) -> Callable[[dict, list[Block]], dict]:
    def work(row: dict, blocks: list[Block]) -> dict:
        a, found = _anchors(row), []
        for c in blocks:
            for label in np.intersect1d(a.labels, c.labels):
                mine, others = np.flatnonzero(a.labels == label), np.flatnonzero(c.labels == label)
                step = max(1, SCORES // len(others))
                for start in range(0, len(mine), step):
                    rows = mine[start:start + step]
                    scores = products(a.parts[rows], c.parts[others])
                    allowed = a.ids[rows][:, None] != c.ids[others]
                    i, j = _top(scores, allowed, most)
                    found.append((rows[i], scores[i, j], c.ids[others[j]]))
        at, scores, ids = _joined(found, 3)
        kept = _first((at,), scores, ids, most)
        return {"at": at[kept], "anchor_id": a.ids[at[kept]], "score": scores[kept],
                "other_id": ids[kept]}
    return work


def _negatives(places: int, most: int, low: int, high: int) -> Callable[[dict, list[Block]], dict]:
    def work(row: dict, blocks: list[Block]) -> dict:
        a, found = _anchors(row), []
        wanted = row["wanted"] or []
        at, place = (np.array([w[c] for w in wanted], np.int64) for c in ("at", "place"))
        floor = np.array([-(-low * w["score"] // 100) for w in wanted], np.int64)
        ceiling = np.array([high * w["score"] // 100 for w in wanted], np.int64)
        for c in blocks:
            step = max(1, SCORES // len(c.ids))
            for start in range(0, len(a.ids), step):
                scores = products(a.parts[start:start + step], c.parts)
                differs = a.labels[start:start + step, None] != c.labels
                for p in range(1, places + 1):
                    w = np.flatnonzero((place == p) & (at >= start) & (at < start + step))
                    if not len(w):
                        continue
                    mine = scores[at[w] - start]
                    allowed = (differs[at[w] - start] & (mine >= floor[w, None])
                               & (mine <= ceiling[w, None]))
                    i, j = _top(mine, allowed, most)
                    found.append((at[w[i]], place[w[i]], mine[i, j], c.ids[j]))
        ats, places_, scores, ids = _joined(found, 4)
        kept = _first((ats, places_), scores, ids, most)
        return {"at": ats[kept], "place": places_[kept], "score": scores[kept],
                "other_id": ids[kept]}
    return work


def hard_negatives(vectors: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3,
                   low: int = 50, high: int = 95) -> DataFrame:
    """For each anchor and positive, the rows of other labels that score nearly as high.

    A component x counts as floor(256 x); a score is the integer inner product of two rows,
    higher scores come first, ties by smaller vec_id. Anchors are the rows whose vec_id ``every``
    divides; an anchor's positives are its first ``positives`` other rows of its label, fewer
    if there are fewer; its negatives for a positive are the first ``negatives`` rows of other
    labels with a score between ``low`` and ``high`` percent of the positive's (none if that
    is negative).

    Rows with a null vec_id, label or vector, or with a component that is null or not finite,
    take no part. Rows equal in all three columns count once; rows of an id with different
    labels or vectors count each, and a row of the anchor's own id is not its positive. Only
    vectors of the anchor's size are compared. Components so large that a score might not fit
    into a long are an error. Other columns are not read.

    Rows are written in blocks of a bounded size. A task compares one block of anchors with a
    slice of the others' blocks and passes on its best rows only, in two rounds: positives,
    then negatives for the scores these set. Blocks are dealt by a hash of the row, whatever
    its label or id.

    Result: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    """
    rows = (vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"),
                           F.col("embedding").cast("array<double>"))
            .where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND NOT "
                   "exists(embedding, x -> x IS NULL OR isnan(x) OR abs(x) = double('Infinity'))")
            .withColumn("size", F.size("embedding")))
    is_anchor = F.pmod("vec_id", F.lit(every)) == 0
    cells, own = rows.agg(F.sum("size"), F.sum(F.when(is_anchor, F.col("size")))).first()
    count, anchor_blocks = (max(1, -(-(n or 0) // most)) for n, most in (
        (cells, BLOCK_CELLS), (own, ANCHOR_CELLS)))
    slices = -(-count // SLICE_BLOCKS)
    candidates = written(_blocks(rows.distinct(), count), "negative-rows")
    anchors = written(_blocks(rows.where(is_anchor).distinct(), anchor_blocks), "negative-anchors")

    anchor = ["size", "anchor_block", "at"]

    def best(found: DataFrame, by: list[str], most: int, name: str) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc("score"), "other_id")
        return found.withColumn(name, F.row_number().over(order)).where(F.col(name) <= most)

    near = written(best(
        _compared(anchors, candidates, anchor_blocks, slices, _positives(positives),
                  "size int, anchor_block int, at long, anchor_id long, score long, other_id long"),
        anchor, positives, "place"), "positives")
    wanted = near.groupBy("size", F.col("anchor_block").alias("block")).agg(
        F.collect_list(F.struct("at", "place", "score")).alias("wanted"))
    far = best(
        _compared(anchors.join(wanted, ["size", "block"]), candidates, anchor_blocks, slices,
                  _negatives(positives, negatives, low, high),
                  "size int, anchor_block int, at long, place long, score long, other_id long"),
        [*anchor, "place"], negatives, "rank")
    return (near.withColumnsRenamed({"other_id": "positive_id", "score": "positive_score"})
            .join(far.withColumnsRenamed({"other_id": "negative_id", "score": "negative_score"}),
                  [*anchor, "place"])
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                    "negative_score"))
