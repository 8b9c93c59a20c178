"""Embedding near-dedup: a pigeonhole join over rotated subspaces, candidates verified exactly."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemill.llm.components import components
from tidemill.llm.store import written
from tidemill.llm.words import batches

#: Coordinates of a subspace, and those of them that lay out its grid.
BLOCK, GRID = 8, 2
#: Vectors of a cell that one task compares with as many others.
CHUNK = 2000
#: Added to squared distances, far above what rounding can lose.
SLACK = 1e-6
#: Half of the neighbours of a cell; the other half see it as their neighbour.
AHEAD = ((0, 0), (1, 0), (-1, 1), (0, 1), (1, 1))


@cache
def rotation(size: int) -> np.ndarray:
    """A fixed random rotation, which spreads distances evenly over the subspaces."""
    random = np.random.default_rng(size)
    turned, triangle = np.linalg.qr(random.normal(size=(size, size)))
    return turned * np.sign(np.diag(triangle))


def _unit(values: list | None) -> np.ndarray | None:
    """The vector at length 1; None if it is null, empty, zero or has a component that is null
    or not finite."""
    if not values or any(v is None for v in values):
        return None
    vector = np.array(values, np.float64)
    largest = np.abs(vector).max()
    if not np.isfinite(largest) or largest == 0:
        return None
    vector = vector / largest
    return vector / np.sqrt(vector @ vector)


def _rows(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, key, unit): the key names label and vector; null where nothing can link."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(parts):
            keys, units = [], []
            for label, values in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                unit = _unit(values) if label is not None else None
                units.append(None if unit is None else unit.tobytes())
                keys.append(None if unit is None else xxhash.xxh3_128_digest(
                    f"{label}:".encode() + np.array(values, np.float64).tobytes()))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(keys, pa.binary()),
                 pa.array(units, pa.binary())], ["vec_id", "label", "key", "unit"])
    return vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"),
                          "embedding").mapInArrow(
        run, "vec_id long, label long, key binary, unit binary")


def _cells(classes: DataFrame, budget: float) -> DataFrame:
    """Each class in its cell of every subspace's grid, and as a visitor in the cells ahead.

    A subspace of k of n coordinates gets the share k / n of the squared distance; cells are as
    wide as the root of it, so vectors within it are in one cell or in neighbours.
    """
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(parts):
            out: list[list] = [[] for _ in range(8)]
            for key, label, data in zip(*(part.column(i).to_pylist() for i in range(3))):
                unit = np.frombuffer(data, np.float64)
                turned = unit @ rotation(len(unit))
                count = -(-len(unit) // BLOCK)
                for block, piece in enumerate(np.array_split(turned, count)):
                    room = budget * len(piece) / len(unit)
                    place = np.floor(piece[:GRID] / np.sqrt(room + SLACK)).astype(np.int64)
                    place = (*place, 0)[:GRID] if len(place) < GRID else tuple(place)
                    for dx, dy in AHEAD:
                        for column, value in zip(out, (
                                label, len(unit), block, int(place[0] + dx), int(place[1] + dy),
                                dx == 0 and dy == 0, key, piece.astype(np.float32).tobytes())):
                            column.append(value)
            types = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(),
                     pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(out, types)],
                ["label", "size", "block", "x", "y", "own", "key", "piece"])
    return classes.select("key", "label", "unit").mapInArrow(
        run, "label long, size int, block int, x int, y int, own boolean, key binary, piece binary")


def _candidates(cells: DataFrame, budget: float) -> DataFrame:
    """(a, b): classes of one label that are near enough in some subspace."""
    cell = ["label", "size", "block", "x", "y"]
    split = (cells.groupBy(cell).agg(F.count(F.lit(1)).alias("n"), F.max("own").alias("owned"))
             .where("owned AND n > 1")
             .select(*cell, F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks")))
    chunk = F.pmod(F.xxhash64("key"), F.col("chunks")).cast("int")
    dealt = (cells.join(split, cell).withColumn("chunk", chunk)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .withColumn("low", F.least("chunk", "other"))
             .withColumn("high", F.greatest("chunk", "other")))

    def compared(group: pa.Table) -> pa.Table:
        size, low, high = (group.column(n)[0].as_py() for n in ("size", "low", "high"))
        keys = np.array(group.column("key").to_pylist(), object)
        own = group.column("own").to_numpy()
        part = group.column("chunk").to_numpy()
        points = np.frombuffer(b"".join(group.column("piece").to_pylist()), np.float32).reshape(
            len(keys), -1).astype(np.float64)
        room = budget * points.shape[1] / size + SLACK
        lengths = (points ** 2).sum(1)
        left, right = [], []
        owners = np.flatnonzero(own)
        for start in range(0, len(owners), 512):
            rows = owners[start:start + 512]
            near = (lengths[rows][:, None] + lengths - 2 * points[rows] @ points.T) <= room
            # each pair once: a visitor, or an owner that comes later; across two chunks only
            # if it is not a pair of one of them
            near &= ~own | (np.arange(len(keys)) > rows[:, None])
            if low != high:
                near &= part != part[rows][:, None]
            i, j = np.nonzero(near)
            left.append(keys[rows[i]])
            right.append(keys[j])
        a = np.concatenate(left) if left else np.empty(0, object)
        b = np.concatenate(right) if right else np.empty(0, object)
        return pa.table({"a": pa.array(a.tolist(), pa.binary()),
                         "b": pa.array(b.tolist(), pa.binary())})
    pairs = (dealt.select(*cell, "low", "high", "chunk", "own", "key", "piece")
             .groupBy(*cell, "low", "high").applyInArrow(compared, "a binary, b binary"))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _verified(pairs: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(parts):
            cosine = [float(np.frombuffer(x, np.float64) @ np.frombuffer(y, np.float64))
                      for x, y in zip(part.column(2).to_pylist(), part.column(3).to_pylist())]
            keep = np.array(cosine, np.float64) >= least
            yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return (pairs.join(classes.select(F.col("key").alias("a"), F.col("unit").alias("p")), "a")
            .join(classes.select(F.col("key").alias("b"), F.col("unit").alias("q")), "b")
            .select("a", "b", "p", "q").mapInArrow(run, "a binary, b binary"))


def near_vectors(vectors: DataFrame, cosine: float = 0.93) -> DataFrame:
    """Groups of vectors of one label linked by a cosine of at least ``cosine``.

    At length 1 such vectors have a squared distance of at most 2 - 2 ``cosine``. Rotated and
    split into subspaces, a pair has in at least one of them no more than that subspace's
    share, so the pairs found there by a range join over a grid hold all links; their union is
    verified in double precision. Equal vectors are one class, compared once. A full cell is
    split into chunks that are compared pairwise in tasks of their own.

    Vectors that are null, empty, zero or have null or non-finite components, and rows
    without a label, link with nothing; so do vectors of different sizes. Ids may be null or
    repeated: every row counts as a vector. Other columns are not read.

    Result: vec_id, n_links, component_id, kept; one row per row.
    """
    budget = 2 - 2 * cosine
    rows = written(_rows(vectors), "vectors")
    classes = written(rows.where("key IS NOT NULL").groupBy("key").agg(
        F.first("label").alias("label"), F.first("unit").alias("unit"),
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("first")), "vector-classes")
    cells = written(_cells(classes, budget), "vector-cells")
    pairs = written(_candidates(cells, budget), "vector-pairs")
    links = written(_verified(pairs, classes, cosine), "vector-links")
    groups = components(links, "a", "b")

    sizes = classes.select("key", "copies")
    ends = links.select(F.col("a").alias("node"), F.col("b").alias("key")).unionByName(
        links.select(F.col("b").alias("node"), F.col("a").alias("key")))
    linked = (ends.join(sizes, "key").groupBy("node").agg(F.sum("copies").alias("others")))
    placed = (classes.select("key", "copies", "first")
              .join(groups, F.col("key") == groups["node"], "left").drop("node")
              .withColumn("group", F.coalesce("component", "key"))
              .join(linked, F.col("key") == linked["node"], "left")
              .select("key", "first", "group", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1)
                      .alias("n_links")))
    smallest = placed.groupBy("group").agg(F.min("first").alias("component_id"))
    known = placed.join(smallest, "group").select("key", "n_links", "component_id")
    joined = (rows.where("key IS NOT NULL").select("vec_id", "key").join(known, "key")
              .select("vec_id", "n_links", "component_id"))
    alone = rows.where("key IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                             F.col("vec_id").alias("component_id"))
    return joined.unionByName(alone).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
