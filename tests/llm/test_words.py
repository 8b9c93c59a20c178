"""Byte-level BPE, hard negatives and spelling variants against plain forms."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from pyspark.sql import functions as F

from text_samples import awkward, frame, table
from tidemill.llm import bpe, negatives, spellings, words
from tidemill.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.mark.parametrize("block", [16, 1 << 20])
def test_text_hashes_tell_words_apart(monkeypatch, block):
    monkeypatch.setattr(words, "BLOCK", block)
    texts = [None if t is None else t.encode() for _, t in awkward()] + [
        b"", b" ", b"One\x1cone ONE\tone", b"x" * 100, b"x" * 101 + b" x", None]
    for lower in (False, True):
        found, sizes = words.text_hashes(texts, lower)
        plain = [(t.lower() if lower else t).split() if t else [] for t in texts]
        assert sizes.tolist() == [len(x) for x in plain]
        flat = [w for x in plain for w in x]
        by_word = dict(zip(flat, found.tolist()))
        assert [by_word[w] for w in flat] == found.tolist()
        assert len(set(by_word.values())) == len(by_word) > 100
    assert words.text_hashes([], True)[0].size == 0


def library(path=RANKS):
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts(seed=5):
    pick = random.Random(seed)
    letters = "abcdefghijklmnopqrstuvwxyz  '.,\n\t0123456789éßÀ漢字😀​ſK'S'tLL \r"
    texts = ["".join(pick.choices(letters, k=pick.randint(0, 300))) for _ in range(300)]
    long = ["a" * 20_000, "ab" * 700 + "é" * 900, "".join(pick.choices("etaoinshr", k=5000)),
            "漢" * 400, " " * 3000 + "x", "=-" * 500, "x" * bpe.WIDEST, "x" * (bpe.WIDEST + 1)]
    return [None, "", " ", "<|endoftext|>", "  \n  x", *texts, *long]


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def test_bpe_is_that_of_the_library_and_comes_back(spark, name):
    path = public_tokenizers.path(name)
    known = library(path)
    texts = odd_texts() + [t for _, t in awkward()]
    docs = frame(spark, [(i if i % 9 else None, t) for i, t in enumerate(texts)]).withColumn(
        "ids", F.lit("clash"))
    rows = bpe.encoded(docs, path, PATTERN)
    got = Counter((r.doc_id, tuple(r.ids)) for r in rows.collect())
    want = Counter((i if i % 9 else None, tuple(known.encode_ordinary(t or "")))
                   for i, t in enumerate(texts))
    assert got == want
    back = bpe.decoded(rows, path).collect()
    assert Counter((r.doc_id, bytes(r.decoded)) for r in back) == Counter(
        (i if i % 9 else None, (t or "").encode()) for i, t in enumerate(texts))


def test_bpe_rounds_and_heap_agree():
    known = bpe.vocabulary(bpe.vocabulary_file(RANKS))
    pick = random.Random(8)
    pieces = [bytes(pick.choices(b"etaoinshrdlu \xc3\xa9", k=pick.randint(2, bpe.WIDEST)))
              for _ in range(400)]
    for piece, ids in known.encoded(pieces).items():
        if piece not in known.ranks:
            assert ids == known._long(piece)


def test_bpe_query(spark):
    known = library()
    got = {r.doc_id: r for r in QUERIES["op11_byte_bpe"](spark, FOLDER).collect()}
    rows = table(FOLDER, "documents", "doc_id, text")
    assert len(got) == len(rows)
    for doc, text in rows:
        ids = known.encode_ordinary(text or "")
        assert got[doc].n_tokens == len(ids)
        assert got[doc].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[doc].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()


def test_bpe_odd_vocabularies(spark, folder):
    with pytest.raises(ValueError, match="no token for byte"):
        bpe.Vocabulary(base64.b64encode(b"a") + b" 0\n")
    # ranks out of the order in which merges build them: bytes decide, as in the library
    tokens = [bytes([b]) for b in range(256)] + [b"abc", b"bc", b"ab", b"cd", b"bcd", b"abcd"]
    path = f"{folder}/ranks"
    with open(path, "wb") as file:
        file.writelines(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(tokens))
    known, own = library(path), bpe.vocabulary(bpe.vocabulary_file(path))
    pick = random.Random(1)
    texts = ["".join(pick.choices("abcd", k=pick.randint(1, 60))) for _ in range(500)]
    ids = own.encoded([t.encode() for t in texts])
    for t in texts:
        assert np.frombuffer(ids[t.encode()], np.uint32).tolist() == known.encode_ordinary(t)
        assert own._long(t.encode()) == ids[t.encode()] or t.encode() in own.ranks
    assert bpe.encoded(frame(spark, []), path, PATTERN).count() == 0


VECTORS = "vec_id long, embedding array<float>, label int, size string, block string, score string"


def mined(rows, every=50, positives=5, negatives_=3, low=50, high=95):
    """(anchor, positive, rank, negative, scores) by brute force over distinct rows."""
    rows = {(i, label, tuple(math.floor(256 * float(np.float32(x))) for x in v))
            for i, v, label in rows if None not in (i, v, label) and all(
                x is not None and math.isfinite(x) for x in v)}
    out = []
    for i, label, v in rows:
        if i % every:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in rows
                         if len(w) == len(v)))
        near = [(-s, j) for s, j, other in scored if other == label and j != i][:positives]
        far = [(-s, j) for s, j, other in scored if other != label]
        for score, j in near:
            fit = [(s, k) for s, k in far if low * score <= 100 * s <= high * score]
            out += [(i, j, n, k, score, s) for n, (s, k) in enumerate(fit[:negatives_], 1)]
    return sorted(out)


def awkward_vectors(seed=3):
    pick = random.Random(seed)
    rows = [(i, [round(pick.gauss(0, 0.3), 3) for _ in range(6)], pick.randint(0, 2))
            for i in range(260)]
    rows += [(300 + i, [0.5, 0.25, 0.0, 0.0, 0.0, 0.125], i % 3) for i in range(60)]  # ties
    rows += [(350, None, 1), (400, [0.1] * 6, None), (None, [0.1] * 6, 1), (450, [], 1),
             (451, [], 2), (452, [], 1), (500, [0.1, None, 0.0, 0.0, 0.0, 0.0], 1),
             (550, [float("nan")] * 6, 1), (551, [float("inf")] * 6, 1), (600, [0.0] * 6, 2),
             (650, [1.0, 2.0], 0), (651, [3.0, 2.0], 0), (652, [2.0, 1.0], 1), (700, [0.2] * 6, -4)]
    return rows + rows[50:52] + [(50, [0.9] * 6, 1), (1, [0.9] * 6, 0), (1, [0.8] * 6, 0)]


@pytest.mark.parametrize("cells", [1 << 17, 200])
def test_hard_negatives(spark, monkeypatch, cells):
    """In one block, and in many."""
    monkeypatch.setattr(negatives, "BLOCK_CELLS", cells)
    monkeypatch.setattr(negatives, "ANCHOR_CELLS", min(cells, 20))
    rows = awkward_vectors()
    vectors = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], VECTORS)
    got = sorted(tuple(r) for r in negatives.hard_negatives(vectors).collect())
    assert got == mined(rows) and len(got) > 50
    few = negatives.hard_negatives(vectors, 20, 2, 1, 10, 100).collect()
    assert sorted(tuple(r) for r in few) == mined(rows, 20, 2, 1, 10, 100)


def test_hard_negatives_query_and_empty(spark):
    moved = [(i, v, (label + 1) % 10 if label is not None and i % 7 == 0 else label)
             for i, v, label in table(FOLDER, "embeddings", "vec_id, embedding, label")]
    got = sorted(tuple(r) for r in QUERIES["op12_hard_negatives"](spark, FOLDER).collect())
    assert got == mined(moved)
    assert negatives.hard_negatives(spark.createDataFrame([], VECTORS)).count() == 0


@pytest.mark.parametrize("scale", [1, 100, 1 << 22, 1 << 24, 1 << 27])
def test_products_are_exact_at_every_width(scale):
    random_ = np.random.default_rng(scale)
    a, c = (random_.integers(-scale, scale + 1, (n, 24)) for n in (7, 45))
    assert (negatives.products(a, c) == (a.astype(object) @ c.T.astype(object))).all()


def words_of(rows, least=7, left_out=31):
    found = Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % left_out == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least:
                found[run] += 1
    return {w: n for w, n in found.items() if n >= 2}


def grouped(rows):
    counts, near, by_mask = words_of(rows), defaultdict(set), defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            by_mask[w[:i], w[i + 1:]].add(w)
            if (shorter := w[:i] + w[i + 1:]) in counts:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in by_mask.values():
        for w in group:
            near[w] |= group - {w}
    forms = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda x: (-counts[x], x))
            if counts[best] >= 10 * counts[w]:
                forms[w] = best

    def root(w):
        return root(forms[w]) if w in forms else w
    return sorted((w, forms.get(w), root(w), n, len(near[w]), counts.get(forms.get(w)))
                  for w, n in counts.items())


def misspelt(seed=4):
    pick = random.Random(seed)
    letters = "abcdeÀàöé×"
    base = ["".join(pick.choices(letters, k=pick.randint(6, 9))) for _ in range(250)]
    base += ["aaaaaaa" + "a" * i for i in range(6)] + ["x" * 300, "x" * 301, "x" * 299 + "y"]
    chain = {"kettleworm": 2000, "kettleworn": 150, "kettlewern": 12, "kattlewern": 2}
    runs = [w for w, n in chain.items() for _ in range(n)]
    for w in base:
        for _ in range(pick.choice([1, 2, 3, 25])):
            runs += [w, w.upper()]
            i = pick.randrange(len(w))
            runs.append(pick.choice([w[:i] + w[i + 1:], w[:i] + pick.choice(letters) + w[i:],
                                     w[:i] + pick.choice(letters) + w[i + 1:], w]))
    pick.shuffle(runs)
    rows = [(i if i % 11 else None, pick.choice([" ", "_", "1", "\n", "ß "]).join(
        runs[40 * i:40 * i + 40])) for i in range(len(runs) // 40 + 1)]
    return rows + rows[:3] + [(1, None), (2, ""), (3, "short"), (4, "y" * 50_000 + " " + "y" * 50_000)]


@pytest.mark.parametrize("share", [4000, 12])
def test_spellings(spark, monkeypatch, share):
    """With one leaf for each length, and with many."""
    monkeypatch.setattr(spellings, "SHARE", share)
    rows = misspelt()
    got = sorted(tuple(r) for r in spellings.spelling_groups(frame(spark, rows)).collect())
    want = grouped(rows)
    assert got == want
    assert sum(r[4] for r in want) > 300 and any(r[1] not in (None, r[2]) for r in want)


def test_spellings_by_a_sample(spark, monkeypatch):
    """The leaves are laid out by few words; lengths without any have one leaf."""
    monkeypatch.setattr(spellings, "SAMPLE", 60)
    monkeypatch.setattr(spellings, "SHARE", 30)
    rows = misspelt(9)
    got = sorted(tuple(r) for r in spellings.spelling_groups(frame(spark, rows)).collect())
    assert got == grouped(rows)


def test_spellings_query_and_empty(spark):
    got = sorted(tuple(r) for r in QUERIES["op13_spellings"](spark, FOLDER).collect())
    assert got == grouped(table(FOLDER, "documents", "doc_id, text"))
    assert spellings.spelling_groups(frame(spark, [])).count() == 0
    assert spellings.spelling_groups(frame(spark, [(1, "one two")])).count() == 0
