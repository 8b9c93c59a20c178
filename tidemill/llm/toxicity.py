"""Toxicity: a noisy-channel decoder restores disguised words, then restored words are scored."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Mapping
from functools import cache
from math import inf, log
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemill.llm.quality import labelled, probability
from tidemill.llm.words import batches, fold

#: Symbols of the character model: 0 is anything but a letter, 1-26 a-z, the rest other letters.
SYMBOLS = 64
#: Labelled rows that are fitted, and entries of the lexicon (the most telling), at most.
FIT_ROWS, LEXICON = 12_000, 20_000
#: An entry has at least so many toxic documents and such log odds.
LEAST_DOCS, LEAST_ODDS = 5, 2.5
TOXIC = 0.5
#: A text's evidence counts up to here, so that a long text does not outweigh the fit.
MOST_EVIDENCE = 40.0
NOTHING: Mapping[str, float] = {}
REMEMBERED = 300_000

# Letters that stand-in characters are read as.
STAND_INS = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t",
             "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e",
             "£": "l", "(": "c", "¡": "i", "*": "abcdefghijklmnopqrstuvwxyz"}
EDGES = " \t\n\r\x0b\x0c.,;:!?\"'()[]{}<>«»„“”…|*_-~`"
LEADING = EDGES.replace("!", "")
JOINTS = re.compile(r"[.\-_~*/\\|,]+")
#: Three or more single characters with white space between.
SPACED = re.compile(r"(?<!\S)(?:\S\s++){2,}\S(?!\S)")
#: Two or more short pieces with white space between.
SHORT = re.compile(r"(?<!\S)\S{1,4}+(?!\S)(?:\s++\S{1,4}+(?!\S))++")
ENDS = ".,;:!?…"
RUN = re.compile(r"(.)\1+")
# Costs of the channel, as log probabilities: a letter written as another sign, or as any; one
# written twice for a run of three and more; a gap between any two characters; a sign that is
# meant; one letter written twice; a joint or blank that means nothing, a joint that ends a word.
STAND_IN, WILD, DOUBLED, GAP, LITERAL = log(0.3), log(0.02), log(0.2), log(0.02), log(0.05)
COLLAPSED, JOINED, SPLIT = log(0.005), log(0.05), log(0.5)
#: What a reading gains that is a word of the lexicon.
KNOWN = 6.0


def symbol(char: str) -> int:
    code = ord(char)
    if 97 <= code <= 122:
        return code - 96
    return 27 + code % 37 if char.isalpha() else 0


SAME = re.compile(r"(?s:(.)\1*+)")
_SYMBOL_OF = np.array([symbol(chr(c).lower()[0]) for c in range(0x250)], np.int64)


def trigram_counts(docs: DataFrame) -> DataFrame:
    """(code, n): counts of three symbols in a row over all texts; at most 64^3 rows."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS ** 3, np.int64)
        for part in batches(parts):
            for text in part.column(0).to_pylist():
                codes = np.frombuffer((text or "").encode("utf-32-le"), np.uint32).astype(np.int64)
                symbols = np.where(codes < len(_SYMBOL_OF),
                                   _SYMBOL_OF[np.minimum(codes, len(_SYMBOL_OF) - 1)],
                                   27 + codes % 37)
                symbols = np.concatenate(([0], symbols, [0]))
                symbols = symbols[1:][(symbols[1:] > 0) | (symbols[:-1] > 0)]
                if len(symbols) > 2:
                    total += np.bincount(
                        (symbols[:-2] * SYMBOLS + symbols[1:-1]) * SYMBOLS + symbols[2:],
                        minlength=SYMBOLS ** 3)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["code", "n"])
    return (docs.select("text").mapInArrow(run, "code long, n long")
            .groupBy("code").agg(F.sum("n").alias("n")))


def language_model(counts: DataFrame) -> list[float]:
    """log P(c | a, b) for all symbols, smoothed with shorter contexts, c running fastest."""
    n = np.zeros(SYMBOLS ** 3)
    for code, count in counts.collect():
        n[code] = count
    n = n.reshape((SYMBOLS,) * 3)
    pairs = n.sum(0)
    single = (pairs.sum(0) + 1) / (pairs.sum() + SYMBOLS)
    double = (pairs + 2 * single) / (pairs.sum(1, keepdims=True) + 2)
    return np.log((n + 5 * double) / (n.sum(2, keepdims=True) + 5)).ravel().tolist()


def _options(char: str, spaced: bool) -> list[tuple[str, float]]:
    """What one written character may stand for."""
    if char.isalpha():
        return [(char, 0.0)]
    letters = STAND_INS.get(char, "")
    cost = WILD if len(letters) > 2 else STAND_IN
    return [(x, cost) for x in letters] + ([] if spaced else [(char, LITERAL)])


@cache
def _readings(char: str, length: int, inner: bool, spaced: bool) -> list[tuple[str, float]]:
    """What a run of one written character may stand for; runs of three and more are alike."""
    out = []
    if inner and JOINTS.fullmatch(char):
        out = [("", JOINED)] if spaced else [("", JOINED), (" ", SPLIT)]
        if char not in STAND_INS:
            return out
    for letter, cost in _options(char, spaced):
        if length == 1:
            out.append((letter, cost))
        elif length == 2:
            out += [(letter * 2, cost * 2), (letter, cost + COLLAPSED)]
        else:
            out += [(letter, cost), (letter * 2, cost + DOUBLED)]
    return out


@cache
def _steps(char: str, length: int, inner: bool, spaced: bool, gap: bool) -> list[tuple]:
    """The readings as (symbols with their characters, cost), with a gap before them or none."""
    readings = _readings(char, length, inner, spaced)
    if gap:
        readings = readings + [(" " + text, cost + GAP) for text, cost in readings if text]
    return [([(symbol(c), c) for c in text], cost) for text, cost in readings]


def best_path(token: str, model: list[float], spaced: bool = False) -> tuple[str, float]:
    """The likeliest plain text of a disguised token, and its log probability.

    Viterbi over a lattice that has, for each run of one character, its readings: a run of two
    is two letters or one, a longer one is one or two; a joint within the token is nothing or
    ends a word. Spaced characters may have a word end between any two. States are the last two
    symbols, as one number.
    """
    runs = [(m[0][0], len(m[0])) for m in SAME.finditer(token)]
    last = len(runs) - 1
    paths: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
    for i, (char, length) in enumerate(runs):
        if length == 1 and len(paths) == 1 and not spaced and char.isalpha():
            (start, (score, back)), = paths.items()
            s = symbol(char)
            paths = {start % SYMBOLS * SYMBOLS + s: (score + model[start * SYMBOLS + s], (back, char))}
            continue
        following: dict[int, tuple[float, tuple | None]] = {}
        steps = _steps(char, min(length, 3), 0 < i < last, spaced, spaced and i > 0)
        for start, (score, back) in paths.items():
            for symbols, cost in steps:
                at, total, trail = start, score + cost, back
                for s, c in symbols:
                    total += model[at * SYMBOLS + s]
                    at, trail = at % SYMBOLS * SYMBOLS + s, (trail, c)
                if at not in following or total > following[at][0]:
                    following[at] = (total, trail)
        paths = following or paths
    score, trail = max(((score + model[at * SYMBOLS], back) for at, (score, back) in paths.items()),
                       key=lambda x: x[0])
    letters = []
    while trail:
        trail, c = trail
        letters.append(c)
    return "".join(reversed(letters)), score


def decoded(token: str, model: list[float], spaced: bool = False) -> str:
    return best_path(token, model, spaced)[0]


def _core(token: str) -> str:
    return token.rstrip(EDGES).lstrip(LEADING)


def restored(token: str, model: list[float], known: Mapping[str, float] = NOTHING) -> str:
    """A lower-cased token without its edges (a first "!" may be a letter); decoded if it looks
    disguised: a letter stands twice in a row, or letters stand with stand-ins or joints.

    Without joints and with each run as one letter, the token is a reading of its own, which wins
    over the likeliest path more often if it is a word of the lexicon (``known``).
    """
    core = _core(token)
    if core.isalpha() and not RUN.search(core):
        return core
    parts = JOINTS.split(core)
    if len(parts) > 2 and all(len(p) <= 1 for p in parts):
        core = "".join(parts)
    if not (any(c.isalpha() for c in core) and (
            len(parts) > 1 or RUN.search(core) or any(c in STAND_INS for c in core))):
        return core
    text, score = best_path(core, model)
    if not known or f"={text}" in known:
        return text
    joined = JOINTS.sub("", core)
    for other in {joined, RUN.sub(r"\1", joined)} - {core}:
        plain = other.isalpha() and not RUN.search(other)
        if plain and f"={other}" not in known:
            continue
        word, likely = best_path(other, model)
        if f"={word}" in known:
            changes = JOINED * (len(JOINTS.split(core)) - 1)
            changes += COLLAPSED * sum(len(m[0]) == 2 for m in RUN.finditer(joined)) * (
                other != joined)
            if likely + changes + KNOWN > score:
                return word
    return text


def _likelihood(text: str, model: list[float]) -> float:
    symbols = [0, 0, *map(symbol, text), 0]
    return sum(model[(x * SYMBOLS + y) * SYMBOLS + z]
               for x, y, z in zip(symbols, symbols[1:], symbols[2:]))


def beginnings(known: Iterable[str]) -> set[str]:
    """All words of the lexicon and what they begin with."""
    return {e[1:n] for e in known if e[0] == "=" for n in range(2, len(e) + 1)}


def broken_up(pieces: list[str], model: list[float], known: Mapping[str, float],
              begun: set[str]) -> list[str]:
    """Words of the lexicon that short pieces in a row make up, where one word is likelier than
    the pieces; a piece belongs to one word. ``begun`` are the ``beginnings`` of the lexicon."""
    words, start = [], 0
    while start < len(pieces):
        end, i, text = start, start, pieces[start]
        while text in begun and i + 1 < len(pieces):
            i += 1
            text += pieces[i]
            if f"={text}" in known:
                apart = _likelihood(" ".join(pieces[start:i + 1]), model)
                if _likelihood(text, model) + JOINED * (i - start) + KNOWN > apart:
                    words.append(text)
                    end = i
        start = end + 1
    return words


def _distinct(text: str) -> tuple[set[str], list[str]]:
    """Distinct lower-cased tokens of a text, and its stretches of spaced characters."""
    low = text.lower()
    spaced = SPACED.findall(low)
    return set(low.split()), spaced


def entries(word: str) -> list[str]:
    """Lexicon entries a word may meet: itself and its first letters."""
    return [f"={word}", *(f"{word[:n]}" for n in (4, 5) if len(word) >= n)] if len(word) > 2 else []


class Lexicon(NamedTuple):
    model: list[float]
    weights: dict[str, float]
    slope: np.ndarray  # of evidence, log of words, and a constant


class _Evidence(dict):
    """Evidence of tokens, remembered."""

    def __init__(self, lexicon: Lexicon) -> None:
        super().__init__()
        self.lexicon = lexicon
        self.begun = beginnings(lexicon.weights)
        self.starts = {e.removeprefix("=")[:4] for e in lexicon.weights}
        self.collapsed = {RUN.sub(r"\1", s) for s in self.starts}

    def _of(self, words: str) -> float:
        weights = self.lexicon.weights
        return sum(max((weights.get(e, 0.0) for e in entries(w)), default=0.0)
                   for w in words.split() if w[:4] in self.starts)

    def __missing__(self, token: str) -> float:
        if len(self) >= REMEMBERED:
            self.clear()
        self[token] = value = self._of(self.plain(token)) if self._may_count(token) else 0.0
        return value

    def _may_count(self, token: str) -> bool:
        """Whether any reading of the token may meet an entry: those of letters alone differ in
        doubled letters only, so the beginnings of all are alike without them."""
        core = _core(token)
        if not core.isalpha():
            return True
        once = RUN.sub(r"\1", core)
        return any(once[:n] in self.collapsed for n in (4, 3, 2, 1))

    def plain(self, token: str) -> str:
        return restored(token, self.lexicon.model, self.lexicon.weights)

    def pieces(self, low: str) -> set[str]:
        """Words of the lexicon that stand in short pieces of one phrase."""
        found: set[str] = set()
        if self.begun:
            for stretch in SHORT.findall(low):
                phrases: list[list[str]] = [[]]
                for piece in stretch.split():
                    phrases[-1].append(piece if piece.isalpha() else self.plain(piece))
                    if piece[-1] in ENDS:
                        phrases.append([])
                for pieces in phrases:
                    found.update(broken_up(pieces, self.lexicon.model, self.lexicon.weights,
                                           self.begun))
        return found

    def features(self, text: str | None) -> tuple[float, float]:
        tokens, spaced = _distinct(text or "")
        stretches = [decoded("".join(s.split()), self.lexicon.model, spaced=True) for s in spaced]
        total = sum(map(self.__getitem__, tokens)) + sum(map(self._of, stretches))
        total += sum(map(self._of, self.pieces((text or "").lower()).difference(
            w for s in stretches for w in s.split())))
        return min(total, MOST_EVIDENCE), float(np.log1p(len(tokens)))


def _set_hash(tokens: set[str]) -> bytes:
    return xxhash.xxh3_128_digest(" ".join(sorted(tokens)))


def toxicity_lexicon(docs: DataFrame, labels: DataFrame, parts: int = 5, held: int = 0,
                     limit: int = FIT_ROWS) -> Lexicon:
    """Learn the character model from all texts, the lexicon from at most ``limit`` labelled
    documents outside the held fold.

    Copies would make all their words look telling, so of the labelled documents with the same
    label and the same set of tokens only one counts.
    """
    model = language_model(trigram_counts(docs))
    rows = labelled(docs, labels, "toxic", parts, held, limit)

    def restored_rows(parts_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(parts_in):
            found, texts, sets = [], part.column(1).to_pylist(), []
            for text in texts:
                tokens, spaced = _distinct(text or "")
                words = {w for t in tokens for w in restored(t, model).split()}
                for stretch in spaced:
                    words.update(decoded("".join(stretch.split()), model, spaced=True).split())
                found.append(sorted({e for w in words for e in entries(w)}))
                sets.append(_set_hash(tokens))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(3), pa.array(found, pa.list_(pa.string())),
                 pa.array(sets, pa.binary())], ["doc_id", "label", "entries", "tokens"])
    seen = (rows.mapInArrow(restored_rows, "doc_id long, label int, entries array<string>,"
                                           " tokens binary")
            .groupBy("label", "tokens").agg(F.min_by("entries", "doc_id").alias("entries")))
    totals = {r.label: r.n for r in seen.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    counts = (seen.select("label", F.explode("entries").alias("entry")).groupBy("entry")
              .agg(F.sum("label").alias("toxic"), F.count(F.lit(1)).alias("n")))
    odds = F.log(((F.col("toxic") + 0.5) / (n1 + 1))
                 / ((F.col("n") - F.col("toxic") + 0.5) / (n0 + 1)))
    kept = (counts.where(F.col("toxic") >= LEAST_DOCS).withColumn("weight", odds)
            .where(F.col("weight") >= LEAST_ODDS)
            .orderBy(F.col("toxic") * F.col("weight"), "entry", ascending=[False, True])
            .limit(LEXICON).select("entry", "weight"))
    weights = {r.entry: r.weight for r in kept.collect()}
    unfitted = Lexicon(model, weights, np.zeros(3))

    def measured(parts_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evidence = _Evidence(unfitted)
        for part in batches(parts_in):
            got = [evidence.features(t) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(3), pa.array([g[0] for g in got], pa.float64()),
                 pa.array([g[1] for g in got], pa.float64())], ["doc_id", "label", "x", "y"])
    points = sorted(tuple(r) for r in rows.mapInArrow(
        measured, "doc_id long, label int, x double, y double").collect())
    return unfitted._replace(slope=_logistic(points))


def _logistic(points: list[tuple]) -> np.ndarray:
    """Newton steps with a small ridge; one label only gives that label, none gives 0."""
    if not points:
        return np.array([0.0, 0.0, -3.0])
    x = np.array([(p[2], p[3], 1.0) for p in points])
    y = np.array([p[1] for p in points], np.float64)
    if y.min() == y.max():
        return np.array([0.0, 0.0, 3.0 if y[0] else -3.0])
    slope, ridge = np.zeros(3), 0.05 * np.eye(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ slope, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge
        slope = slope + np.linalg.solve(hessian, x.T @ (y - p) - ridge @ slope)
    return slope


def toxicity_scores(docs: DataFrame, lexicon: Lexicon, parts: int = 5, held: int = 0) -> DataFrame:
    """The probability that each document is toxic.

    The only input is the text; null counts as empty, and an empty text has the score of no
    evidence. Rows stand for themselves, whatever their ids; a null id is not held out. Without
    labelled rows, or with one label only, every score is that of the label (0 if none).

    Result: doc_id, held_out, score, predicted (1 from 0.5 on); one row per row.
    """
    def run(parts_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evidence = _Evidence(lexicon)
        for part in batches(parts_in):
            scores = np.array([probability(float(lexicon.slope @ (*evidence.features(t), 1.0)))
                               for t in part.column(2).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(scores, pa.float64()),
                 pa.array((scores >= TOXIC).astype(np.int32), pa.int32())],
                ["doc_id", "held_out", "score", "predicted"])
    return docs.select(
        F.col("doc_id").cast("long"),
        F.coalesce(fold("doc_id", parts) == held, F.lit(False)).alias("held_out"),
        "text").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
