"""Quality classifier: a factorisation machine over hashed words, structure and metadata."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemill.llm.words import WordHashes, batches, binaries, fold

#: Hashed words; the other inputs come after them.
WORD_SLOTS = 1 << 12
FACTORS = 8
#: At most this many labelled rows, by a hash of their ids, are fitted on the driver.
FIT_ROWS = 6000
EPOCHS, BATCH, RATE, DECAY = 20, 256, 0.1, 1e-5
KEEP = 0.7

# Classes of bytes as masks over 256 values.
_BYTES = np.arange(256)
_UPPER = (_BYTES >= 65) & (_BYTES <= 90)
_LOWER = (_BYTES >= 97) & (_BYTES <= 122)
_DIGIT = (_BYTES >= 48) & (_BYTES <= 57)
_SPACE = ((_BYTES >= 9) & (_BYTES <= 13)) | (_BYTES == 32)
_WIDE = _BYTES >= 128
_MARKS = ~(_UPPER | _LOWER | _DIGIT | _SPACE | _WIDE)
STATISTICS = 16


def statistics(text: bytes, words: list[bytes], n_chars: int | None) -> np.ndarray:
    """Structure of a text and its metadata as numbers of about 0 to 1."""
    n = max(1, len(text))
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    letters = max(1, counts[_UPPER].sum() + counts[_LOWER].sum() + counts[_WIDE].sum())
    seen = Counter(words)
    lines = [x for x in text.split(b"\n") if x]
    total = max(1, len(words))
    ended = sum(w[-1] in b".!?" for w in words)
    return np.array([
        counts[_UPPER].sum() / letters, counts[_DIGIT].sum() / n, 4 * counts[_MARKS].sum() / n,
        counts[_SPACE].sum() / n, counts[_WIDE].sum() / n, 4 * counts[33] / n, 4 * counts[124] / n,
        min(2.0, len(text) / total / 10), np.log1p(len(words)) / 10, len(seen) / total,
        max(seen.values(), default=0) / total, ended / total,
        1 - len(set(lines)) / max(1, len(lines)), min(2.0, np.log1p(n / max(1, len(lines))) / 6),
        sum(w.istitle() for w in seen) / max(1, len(seen)),
        np.log1p(max(0, n_chars if n_chars is not None else 0)) / 12])


class Vector(NamedTuple):
    slots: np.ndarray
    values: np.ndarray


def inputs(text: bytes | None, n_chars: int | None, known: WordHashes) -> Vector:
    """Nonzero inputs: word counts (dampened, of length 1 together), statistics and a constant."""
    text = text or b""
    words = text.split()
    counts = np.bincount((known.of(words) % np.uint64(WORD_SLOTS)).astype(np.int64),
                         minlength=WORD_SLOTS)
    slots = np.flatnonzero(counts)
    values = np.log1p(counts[slots])
    values /= max(1e-9, np.sqrt((values ** 2).sum()))
    return Vector(np.concatenate((slots, np.arange(WORD_SLOTS, WORD_SLOTS + STATISTICS))),
                  np.concatenate((values, statistics(text, words, n_chars))))


class Machine(NamedTuple):
    """score = bias + w.x + half the sum over factors of (sum v x)^2 - sum (v x)^2: all pairs
    of inputs in time linear in the nonzero ones."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def raw(self, x: Vector) -> float:
        v = self.factors[x.slots] * x.values[:, None]
        return float(self.bias + self.weights[x.slots] @ x.values
                     + 0.5 * ((v.sum(0) ** 2).sum() - (v ** 2).sum()))


def probability(raw: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(raw, -40, 40))))


def fitted(rows: list[Vector], labels: np.ndarray, seed: int = 7) -> Machine:
    """Logistic loss by Adagrad over small batches in a fixed order."""
    size = WORD_SLOTS + STATISTICS
    random = np.random.default_rng(seed)
    weights = np.zeros(size, np.float32)
    factors = random.normal(0, 0.01, (size, FACTORS)).astype(np.float32)
    bias = 0.0
    if not len(rows) or labels.min() == labels.max():
        share = labels.mean() if len(rows) else 1.0
        return Machine(float(np.clip(np.log((share + 1e-3) / (1 - share + 1e-3)), -3, 3)),
                       weights, factors * 0)
    dense = np.zeros((len(rows), size), np.float32)
    for i, x in enumerate(rows):
        dense[i, x.slots] = x.values
    seen_b, seen_w, seen_v = 1e-8, np.full_like(weights, 1e-8), np.full_like(factors, 1e-8)
    for _ in range(EPOCHS):
        order = random.permutation(len(rows))
        for start in range(0, len(rows), BATCH):
            pick = order[start:start + BATCH]
            x = dense[pick]
            squares = x ** 2
            sums = x @ factors
            raw = bias + x @ weights + 0.5 * (
                (sums ** 2).sum(1) - (squares @ factors ** 2).sum(1))
            error = (1 / (1 + np.exp(-np.clip(raw, -40, 40))) - labels[pick]) / len(pick)
            error = error.astype(np.float32)
            gradient_w = x.T @ error + DECAY * weights
            gradient_v = (x.T @ (error[:, None] * sums) - factors * (squares.T @ error)[:, None]
                          + DECAY * factors)
            gradient_b = float(error.sum())
            seen_b += gradient_b ** 2
            seen_w += gradient_w ** 2
            seen_v += gradient_v ** 2
            bias -= RATE * gradient_b / np.sqrt(seen_b)
            weights -= RATE * gradient_w / np.sqrt(seen_w)
            factors -= RATE * gradient_v / np.sqrt(seen_v)
    return Machine(float(bias), weights.astype(np.float64), factors.astype(np.float64))


def labelled(docs: DataFrame, labels: DataFrame, label: str, parts: int, held: int,
             limit: int) -> DataFrame:
    """(doc_id, text, n_chars, label) of at most ``limit`` labelled rows outside the held fold.

    Ids, the smaller label of repeated ids and the choice (by a hash of the id) do not depend
    on the order of rows. The chosen ids are at most ``limit`` and are sent to the documents; of
    documents that repeat an id, the one with the greatest text counts (null: the smallest).
    """
    chosen = (labels.where(F.col(label).isNotNull() & (fold("doc_id", parts) != held))
              .groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))
    size = F.col("n_chars") if "n_chars" in docs.columns else F.length("text")
    return (docs.select("doc_id", F.struct("text", size.cast("long").alias("n_chars")).alias("d"))
            .join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label")
            .agg(F.max("d").alias("d")).select("doc_id", "d.text", "d.n_chars", "label"))


def quality_machine(docs: DataFrame, labels: DataFrame, parts: int = 4, held: int = 2,
                    limit: int = FIT_ROWS) -> Machine:
    """Fit on at most ``limit`` labelled documents outside the held fold."""
    def run(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for part in batches(batches_in):
            found = [inputs(t, n, known) for t, n in zip(binaries(part.column(1)),
                                                         part.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(3),
                 pa.array([x.slots.astype(np.int16).tobytes() for x in found], pa.binary()),
                 pa.array([x.values.astype(np.float32).tobytes() for x in found], pa.binary())],
                ["doc_id", "label", "slots", "numbers"])
    rows = labelled(docs, labels, "quality", parts, held, limit).mapInArrow(
        run, "doc_id long, label int, slots binary, numbers binary")
    got = sorted((r.doc_id, r.label, bytes(r.slots), bytes(r.numbers)) for r in rows.collect())
    return fitted([Vector(np.frombuffer(s, np.int16).astype(np.int64),
                          np.frombuffer(v, np.float32).astype(np.float64)) for _, _, s, v in got],
                  np.array([r[1] for r in got], np.float64))


def quality_scores(docs: DataFrame, machine: Machine, parts: int = 4, held: int = 2) -> DataFrame:
    """The probability that each document is good.

    Inputs are the text and ``n_chars`` (missing or null: 0). A null or empty text has the score
    of its metadata. Rows stand for themselves, whatever their ids; a null id is not held out.
    Without labelled rows, or with one label only, every score is that of the label (1 if none).

    Result: doc_id, held_out, score, predicted (1 from 0.7 on); one row per row.
    """
    size = F.col("n_chars") if "n_chars" in docs.columns else F.length("text")

    def run(parts_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for part in batches(parts_in):
            scores = np.array([probability(machine.raw(inputs(t, n, known))) for t, n in zip(
                binaries(part.column(2)), part.column(3).to_pylist())])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(scores, pa.float64()),
                 pa.array((scores >= KEEP).astype(np.int32), pa.int32())],
                ["doc_id", "held_out", "score", "predicted"])
    return docs.select(
        F.col("doc_id").cast("long"),
        F.coalesce(fold("doc_id", parts) == held, F.lit(False)).alias("held_out"), "text",
        size.cast("long").alias("n_chars")).mapInArrow(
            run, "doc_id long, held_out boolean, score double, predicted int")


def good_documents(docs: DataFrame, machine: Machine) -> DataFrame:
    """The documents the machine does not reject, with all their columns."""
    names = docs.columns

    def run(parts_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for part in batches(parts_in):
            texts = binaries(part.column(names.index("text")))
            sizes = (part.column(names.index("n_chars")).to_pylist() if "n_chars" in names
                     else [len((t or b"").decode()) for t in texts])
            keep = [probability(machine.raw(inputs(t, n, known))) >= KEEP
                    for t, n in zip(texts, sizes)]
            yield part.filter(pa.array(keep, pa.bool_()))
    return docs.mapInArrow(run, docs.schema)
