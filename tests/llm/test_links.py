"""Near duplicates, embeddings and components against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from text_samples import awkward, frame, table, union_find
from tidemill.llm import minhash, subspaces
from tidemill.llm.components import components
from tidemill.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset([tuple(words)] if 0 < len(words) < 5 else
                     [tuple(words[i:i + 5]) for i in range(len(words) - 4)])


def groups_of(rows):
    """For each row (n_shingles, smallest id of its group)."""
    sets = [shingles(t) for _, t in rows]
    find, join = union_find(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                join(i, j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [(doc, len(s), least.get(find(i)) if s else doc)
            for i, ((doc, _), s) in enumerate(zip(rows, sets))]


def ordered(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("rows", [awkward(), table(FOLDER, "documents", "doc_id, text")],
                         ids=["awkward", "table"])
def test_near_duplicates(spark, rows):
    got = [tuple(r) for r in minhash.near_duplicates(frame(spark, rows)).collect()]
    assert ordered(r[:3] for r in got) == ordered(groups_of(rows))
    assert all(kept == (doc == component) for doc, _, component, kept in got)


def test_links_beyond_the_smallest_of_a_bucket(spark):
    """A chain: neighbours are similar, the ends are not; all are one group."""
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[8 * i:8 * i + 100])) for i in range(30)]
    got = minhash.near_duplicates(frame(spark, rows)).collect()
    assert {r.component_id for r in got} == {0}


def test_one_of_each_group(spark):
    docs = frame(spark, awkward())
    left = minhash.one_of_each_group(docs)
    assert left.columns == docs.columns
    want = {(*row,) for row, (d, _, c) in zip(awkward(), groups_of(awkward())) if d == c}
    got = [(r.doc_id, r.text) for r in left.collect()]
    assert set(got) == want and len(got) == len(want)


def test_one_of_each_group_with_null_and_repeated_ids(spark):
    base = " ".join(f"w{i}" for i in range(60))
    near, other = base + " end", " ".join(f"v{i}" for i in range(60))
    rows = [(None, "", "en"), (None, "", "de"), (5, None, "en"), (5, None, "en"), (None, base, "en"),
            (None, near, "de"), (7, other, "fr"), (7, other, "de"), (7, other, None), (7, other + " z", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = [tuple(r) for r in minhash.one_of_each_group(docs).collect()]
    assert sorted(r[2] for r in got if r[1] == "") == ["de", "en"]
    assert got.count((5, None, "en")) == 2
    assert sum(r[0] is None and r[1] != "" for r in got) == 1
    sevens = [r for r in got if r[0] == 7]
    assert len(sevens) == 1 and sevens[0][2] in (None, "a") and len(got) == 6


def test_empty_tables(spark):
    assert minhash.near_duplicates(frame(spark, [])).count() == 0
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert subspaces.near_vectors(empty).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    pick = random.Random(seed)
    links = [(pick.randrange(60), pick.randrange(60)) for _ in range(45)] + [(None, 3), (70, 70)]
    links += [(i, i + 1) for i in range(100, 160)] + [(500, 501 + i) for i in range(50)]
    find, join = union_find(range(600))
    for a, b in links:
        if a is not None:
            join(a, b)
    linked = {x for a, b in links if a is not None and a != b for x in (a, b)}
    got = components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    assert {(r.node, r.component) for r in got if r.node != r.component} == {
        (x, find(x)) for x in linked if find(x) != x}


def vectors():
    random_ = np.random.default_rng(5)
    rows = []
    for i in range(260):
        v = random_.normal(size=12)
        rows.append((i, [float(x) for x in v], i % 3))
        if i % 4 == 0:
            for k in range(3):
                near = v / np.linalg.norm(v) + random_.normal(scale=0.02 + 0.05 * k, size=12)
                rows.append((1000 + 10 * i + k, [float(x) for x in near], i % 3))
    rows += [(1, rows[0][1], 0), (None, rows[0][1], 0), (3000, None, 1), (3001, [], 1),
             (3002, [0.0] * 12, 1), (3003, [1.0, None] * 6, 1), (3004, [math.nan] * 12, 1),
             (3005, [math.inf] * 12, 1), (3006, rows[0][1], None), (3007, [1e300] * 12, 0),
             (3008, [2e300] * 12, 0), (3009, [1.0, 2.0], 0), (3010, [1.0, 2.0], 0)]
    return rows


def linked_vectors(rows, least=0.93):
    good = [r for r in rows if r[2] is not None and r[1] and None not in r[1]
            and all(map(math.isfinite, r[1])) and any(r[1])]
    find, join = union_find(range(len(good)))
    n = [0] * len(good)
    for i, (_, x, a) in enumerate(good):
        x = np.array(x) / max(map(abs, x))
        for j in range(i):
            y, b = np.array(good[j][1]), good[j][2]
            y = y / abs(y).max()
            if a == b and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= least:
                n[i] += 1
                n[j] += 1
                join(i, j)
    least_id = {}
    for i, r in enumerate(good):
        if r[0] is not None:
            least_id[find(i)] = min(r[0], least_id.get(find(i), r[0]))
    out = [(r[0], n[i], least_id.get(find(i))) for i, r in enumerate(good)]
    return out + [(r[0], 0, r[0]) for r in rows if not any(r is g for g in good)]


@pytest.mark.parametrize("chunk", [subspaces.CHUNK, 7])
def test_near_vectors(spark, monkeypatch, chunk):
    monkeypatch.setattr(subspaces, "CHUNK", chunk)
    rows = vectors()
    frame_ = spark.createDataFrame([(*r, "x", "y") for r in rows],
                                   "vec_id long, embedding array<double>, label int, key string, unit string")
    got = [tuple(r) for r in subspaces.near_vectors(frame_).collect()]
    assert ordered(r[:3] for r in got) == ordered(linked_vectors(rows))
    assert all(kept == (i == c) for i, _, c, kept in got)


def test_op1_over_the_table(spark):
    rows = table(FOLDER, "embeddings", "vec_id, embedding, label")
    got = [tuple(r)[:3] for r in QUERIES["op1_subspaces"](spark, FOLDER).collect()]
    assert ordered(got) == ordered(linked_vectors(rows))
