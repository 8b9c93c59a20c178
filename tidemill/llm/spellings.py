"""Spelling variants: range searches in k-d trees over letter counts, letter order verified."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemill.llm.store import written

#: Code points of the letters that make words, as Latin-1 bytes.
LETTERS = np.array([*range(0x61, 0x7B), *range(0xC0, 0x100)])
#: Different words that a task counts before it passes them on.
COUNTED = 300_000
#: Words whose letter counts the driver fetches to lay out the leaves that share out the
#: words (about; each is 90 bytes), words wanted in such a leaf, and points in a leaf of a task's
#: own trees.
SAMPLE, SHARE, POINTS = 50_000, 4000, 4
#: Letters compared at a time.
COMPARED = 1 << 22


def letter_counts(letters: np.ndarray) -> np.ndarray:
    """How often each of ``LETTERS`` stands in each row of a matrix of Latin-1 bytes."""
    n, width = letters.shape
    places = np.arange(n)[:, None] * 256 + letters
    return np.bincount(places.ravel(), minlength=n * 256).reshape(n, 256)[:, LETTERS].astype(
        np.uint8 if width < 256 else np.int32)


def matrix(words: list[bytes]) -> np.ndarray:
    """Words of one length as rows of bytes."""
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)


class Tree:
    """A k-d tree: each inner node parts the points by whether a letter's count is at most a
    threshold, as evenly as one letter can; ``leaf_of`` holds each point's leaf."""

    def __init__(self, points: np.ndarray, most: int) -> None:
        self.letter, self.threshold, self.child, self.leaf = [0], [0], [(0, 0)], [0]
        self.leaf_of, self.leaves = np.zeros(len(points), np.int64), 0
        waiting = [(0, np.arange(len(points)))]
        while waiting:
            node, rows = waiting.pop()
            split = self._split(points[rows]) if len(rows) > most else None
            if split is None:
                self.leaf[node], self.leaf_of[rows] = self.leaves, self.leaves
                self.leaves += 1
                continue
            low = points[rows, split[0]] <= split[1]
            first = len(self.leaf)
            self.letter[node], self.threshold[node] = split
            self.child[node], self.leaf[node] = (first, first + 1), -1
            for column, empty in ((self.letter, 0), (self.threshold, 0), (self.child, (0, 0)),
                                  (self.leaf, 0)):
                column.extend([empty, empty])
            waiting += [(first, rows[low]), (first + 1, rows[~low])]
        self.letter, self.threshold, self.child, self.leaf = map(
            np.array, (self.letter, self.threshold, self.child, self.leaf))

    @staticmethod
    def _split(points: np.ndarray) -> tuple[int, int] | None:
        """(letter, threshold) that parts the points most evenly; None if all are equal."""
        median = np.partition(points, len(points) // 2, axis=0)[len(points) // 2].astype(np.int64)
        best = None
        for threshold in (median, median - 1):
            uneven = np.abs((points <= threshold).sum(0) * 2 - len(points))
            letter = int(uneven.argmin())
            if uneven[letter] < len(points) and (best is None or uneven[letter] < best[0]):
                best = (int(uneven[letter]), letter, int(threshold[letter]))
        return best and best[1:]

    def visits(self, counts: np.ndarray, up: bool, down: bool) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) for every leaf whose box holds a point that differs from the row's counts
        by at most one letter more, if ``up``, and one letter less, if ``down``.

        A box is left out as soon as its bounds ask for more than that. ``more`` and ``less`` are
        the letters that a path has already used (-1: none yet, -2: not allowed).
        """
        row = np.arange(len(counts))
        node = np.zeros(len(row), np.int64)
        more = np.full(len(row), -1 if up else -2)
        less = np.full(len(row), -1 if down else -2)
        rows, leaves = [], []
        while len(row):
            ended = self.leaf[node] >= 0
            if ended.any():
                rows.append(row[ended])
                leaves.append(self.leaf[node[ended]])
                row, node, more, less = (x[~ended] for x in (row, node, more, less))
            letter, threshold = self.letter[node], self.threshold[node]
            count = counts[row, letter].astype(np.int64) + (more == letter) - (less == letter)
            low = count <= threshold
            over = np.flatnonzero((count == threshold) & (more == -1) & (less != letter))
            under = np.flatnonzero((count == threshold + 1) & (less == -1) & (more != letter))
            both = np.concatenate([np.arange(len(row)), over, under])
            side = np.concatenate([np.where(low, 0, 1), np.ones(len(over), np.int64),
                                   np.zeros(len(under), np.int64)])
            following = self.child[node[both], side]
            next_more, next_less = more[both], less[both]
            n = len(row)
            next_more[n:n + len(over)] = letter[over]
            next_less[n + len(over):] = letter[under]
            row, node, more, less = row[both], following, next_more, next_less
        return (np.concatenate(rows) if rows else row,
                np.concatenate(leaves) if leaves else row)


def one_replaced(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether rows of two matrices of one width differ in exactly one place."""
    return (left != right).sum(1) == 1


def one_inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether each row of ``long`` is its row of ``short`` with one letter put in."""
    width = short.shape[1]
    differs, shifted = short != long[:, :-1], short != long[:, 1:]
    first = np.where(differs.any(1), differs.argmax(1), width)
    last = np.where(shifted.any(1), width - 1 - shifted[:, ::-1].argmax(1), -1)
    return last < first


def _pairs(tree: Tree, order: np.ndarray, starts: np.ndarray, counts: np.ndarray,
           down: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, point) for each point in each leaf that a query visits, a part at a time."""
    query, leaf = tree.visits(counts, True, down)
    sizes = starts[leaf + 1] - starts[leaf]
    ends = sizes.cumsum()
    step, begin = COMPARED // 16, 0
    while begin < len(query):
        done = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + step, "right")))
        size = sizes[begin:end]
        place = np.arange(size.sum()) - np.repeat(size.cumsum() - size, size)
        yield (np.repeat(query[begin:end], size),
               order[np.repeat(starts[leaf[begin:end]], size) + place])
        begin = end


def near_pairs(points: list[bytes], visitors: list[bytes],
               shorter: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """All words, and places in them of pairs that are one edit apart: two points, a visitor and
    a point of one length, a word one shorter and a point."""
    words = points + visitors + shorter
    n, same = len(points), len(points) + len(visitors)
    letters = matrix(points)
    tree = Tree(letter_counts(letters), POINTS)
    order = np.argsort(tree.leaf_of, kind="stable")
    starts = np.searchsorted(tree.leaf_of[order], np.arange(tree.leaves + 1))
    left, right = [], []
    for others, at, down in ((points + visitors, 0, True), (shorter, same, False)):
        if not others:
            continue
        rows = matrix(others)
        test = one_replaced if down else one_inserted
        step = max(1, COMPARED // (16 * letters.shape[1])) * 16
        for query, point in _pairs(tree, order, starts, letter_counts(rows), down):
            if down:  # two points meet twice
                once = (query >= n) | (query < point)
                query, point = query[once], point[once]
            for start in range(0, len(query), step):
                q, p = query[start:start + step], point[start:start + step]
                near = test(rows[q], letters[p])
                left.append(q[near] + at)
                right.append(p[near])
    return (words, np.concatenate(left) if left else np.empty(0, np.int64),
            np.concatenate(right) if right else np.empty(0, np.int64))


def word_counts(docs: DataFrame, least_letters: int, left_out: int) -> DataFrame:
    """(word, n): how often each word of at least ``least_letters`` letters stands in the texts,
    where the run of every ``left_out``-th hash of id and run has lost a letter."""
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % least_letters)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()
        for part in parts:
            for doc, text in zip(part.column(0), part.column(1)):
                if not text.is_valid:
                    continue
                seed = zlib.crc32(f"{doc.as_py()}:".encode() if doc.is_valid else b":")
                lowered = text.cast(pa.binary()).as_py().lower().decode()
                for word, n in Counter(runs.findall(lowered)).items():
                    code = zlib.crc32(word.encode(), seed)
                    if code % left_out == 0:
                        at = code % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < least_letters:
                            continue
                    found[word] += n
                if len(found) > COUNTED:
                    yield _counted(found)
                    found.clear()
        if found:
            yield _counted(found)
    return (docs.select(F.col("doc_id").cast("long"), "text")
            .mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")))


def _counted(found: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], ["word", "n"])


def _by_length(words: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths).tolist():
        yield length, np.flatnonzero(lengths == length)


def _layout(words: DataFrame) -> dict[int, Tree]:
    """For each length of words a tree whose leaves hold about ``SHARE`` words each, laid out by
    a hash sample of at most about ``SAMPLE`` words. Lengths without a sample have one leaf."""
    total = words.count()
    every = max(1, -(-total // SAMPLE))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            sample = [w.encode("latin-1") for w in part.column(0).to_pylist()]
            lengths, counts = [], []
            for length, at in _by_length(sample):
                rows = np.minimum(letter_counts(matrix([sample[i] for i in at])), 255)
                lengths += [length] * len(at)
                counts += [row.tobytes() for row in rows.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(lengths, pa.int32()), pa.array(counts, pa.binary())],
                ["length", "counts"])
    sample = (words.where(F.pmod(F.xxhash64("word"), F.lit(every)) == 0).select("word")
              .mapInArrow(run, "length int, counts binary").toArrow())
    lengths = sample.column("length").to_numpy()
    rows = sample.column("counts").to_pylist()
    most = max(8, SHARE // every)
    trees = {}
    for length in np.unique(lengths).tolist():
        own = [rows[i] for i in np.flatnonzero(lengths == length)]
        # in a fixed order, so that the layout does not depend on how rows came
        trees[length] = Tree(matrix(sorted(own)), most)
    return trees


#: What a word is to a leaf: one of its own, a visitor of its length, or one letter shorter.
OWN, VISITOR, SHORTER = 0, 1, 2


def _dealt(words: DataFrame, trees: dict[int, Tree]) -> DataFrame:
    """(length, leaf, part, word, n): each word in its own leaf, in the leaves of its length that
    a replaced letter leads to and that come later, and in those of the length above that one
    letter more leads to."""
    sent = words.sparkSession.sparkContext.broadcast(trees)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layout = sent.value
        for batch in parts:
            coded = [w.encode("latin-1") for w in batch.column(0).to_pylist()]
            counted = batch.column(1).to_numpy()
            for length, at in _by_length(coded):
                counts = letter_counts(matrix([coded[i] for i in at]))
                for other, down in ((length, True), (length + 1, False)):
                    row, leaf, part = np.arange(len(at)), np.zeros(len(at), np.int64), SHORTER
                    if other in layout:
                        row, leaf = layout[other].visits(counts, True, down)
                    if down:
                        own = np.zeros(len(at), np.int64)
                        if other in layout:
                            here, home = layout[other].visits(counts, False, False)
                            own[here] = home
                        later = leaf >= own[row]
                        row, leaf = row[later], leaf[later]
                        part = np.where(leaf == own[row], OWN, VISITOR)
                    rows = at[row]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), other), pa.int32()),
                         pa.array(leaf, pa.int32()),
                         pa.array(np.broadcast_to(part, len(rows)), pa.int32()),
                         pa.array([coded[i] for i in rows], pa.binary()),
                         pa.array(counted[rows], pa.int64())],
                        ["length", "leaf", "part", "word", "n"])
    return words.select("word", "n").mapInArrow(
        run, "length int, leaf int, part int, word binary, n long")


def _found(dealt: DataFrame) -> DataFrame:
    """(word, n_near, near_n, near): what one leaf adds to a word: how many near words, and
    the most frequent of them."""
    def run(group: pa.Table) -> pa.Table:
        part, n = group.column("part").to_numpy(), group.column("n").to_numpy()
        given = group.column("word").to_pylist()
        rows = [np.flatnonzero(part == p) for p in (OWN, VISITOR, SHORTER)]
        out: list = [[], [], [], []]
        if len(rows[OWN]):
            words, left, right = near_pairs(*([given[i] for i in r] for r in rows))
            n = n[np.concatenate(rows)]
            one, other = np.concatenate([left, right]), np.concatenate([right, left])
            names = np.array(words, object)
            # the smallest word first: Latin-1 bytes are in the order of code points
            place = np.empty(len(words), np.int64)
            place[np.argsort(names, kind="stable")] = np.arange(len(words))
            order = np.lexsort((place[other], -n[other], one))
            one, other = one[order], other[order]
            first = np.flatnonzero(np.diff(one, prepend=-1))
            spelled = [words[i].decode("latin-1") for i in one[first].tolist()]
            out = [spelled, np.diff([*first, len(one)]), n[other[first]],
                   [words[i].decode("latin-1") for i in other[first].tolist()]]
        types = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.table([pa.array(x, t) for x, t in zip(out, types)],
                        names=["word", "n_near", "near_n", "near"])
    return dealt.groupBy("length", "leaf").applyInArrow(
        run, "word string, n_near long, near_n long, near string")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form: forms are followed to the last, twice as far each time.

    A form is several times as frequent as its word, so the chains are short.
    """
    chains = written(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = chains.select(F.col("word").alias("root"), F.col("root").alias("farther"))
        step = chains.join(ahead, "root", "left")
        if step.where("farther IS NOT NULL").isEmpty():
            return chains
        chains = written(step.select("word", F.coalesce("farther", "root").alias("root")),
                         "spelling-roots")


def spelling_groups(docs: DataFrame, least_letters: int = 7, left_out: int = 31,
                    least_count: int = 2, times: int = 10) -> DataFrame:
    """Words and the more frequent words that they are one edit away from.

    Words are runs of the letters A-Z, a-z and U+00C0 to U+00FF of whole texts, A-Z lower-cased,
    with at least ``least_letters`` letters and ``least_count`` occurrences n. So that spelling
    errors exist, a run loses the letter crc32 mod its length where ``left_out`` divides the
    crc32 of ``<doc_id>:<run>``. Words are near if one inserted, deleted or replaced letter tells
    them apart. A word's form is its most frequent near word (ties: the smallest) if that is
    at least ``times`` as frequent as the word; its root is the end of the chain of forms.

    One edit changes letter counts by one letter more, one less, or both; words of one length or of
    lengths one apart meet in the leaves of k-d trees over these counts that lie so near, and
    the order of letters decides. Leaves over the whole vocabulary share it out among tasks,
    finer trees do so within a task. What a leaf finds is summed up per word; a leaf too
    full holds anagrams only.

    Null and empty texts have no words; a null id counts as empty; repeated rows count each;
    other columns are not read. Result: word, form, root, n, n_near, form_n; a row per word.
    """
    words = written(word_counts(docs, least_letters, left_out).where(F.col("n") >= least_count),
                    "spelling-words")
    found = (_found(_dealt(words, _layout(words))).groupBy("word").agg(
        F.sum("n_near").alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("order"), F.col("near").alias("near")))
        .alias("best")))
    judged = written(
        words.join(found, "word", "left")
        .withColumn("near_n", -F.col("best.order"))
        .withColumn("near", F.when(F.col("near_n") >= times * F.col("n"), F.col("best.near")))
        .select("word", F.col("near").alias("form"), "n",
                F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                F.when(F.col("near").isNotNull(), F.col("near_n")).alias("form_n")),
        "spelling-forms")
    roots = _roots(judged.where("form IS NOT NULL"))
    return (judged.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near",
                    "form_n"))
