"""Substring dedup and decontamination against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random

import pytest

from text_samples import awkward, frame, table
from tidemill.llm import decontaminate, substrings

FOLDER = "/root/testdata/sf0.001"


def deduplicated(rows):
    texts = [(d, (t or "").encode().split()) for d, t in rows]
    low = {}
    for d, w in texts:
        for i in range(len(w) - 12 if d is not None else 0):
            key = tuple(w[i:i + 13])
            low[key] = min(d, low.get(key, d))
    out = []
    for d, w in texts:
        gone = [False] * len(w)
        for i in range(len(w) - 12 if d is not None else 0):
            if low[tuple(w[i:i + 13])] < d:
                gone[i:i + 13] = [True] * 13
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("rows", [awkward(), table(FOLDER, "documents", "doc_id, text"), []],
                         ids=["awkward", "table", "empty"])
@pytest.mark.parametrize("hot", [False, True])
def test_without_repeats(spark, monkeypatch, rows, hot):
    if hot:
        monkeypatch.setattr(substrings, "SAMPLE", 2)
        monkeypatch.setattr(substrings, "HOT_LEAST", 3)
    got = [tuple(r)[:4] for r in substrings.without_repeats(frame(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted(deduplicated(rows), key=str)


def test_copies_among_the_texts_of_an_id(spark, monkeypatch):
    """A copy and another text under one id, with no other mark than a hot passage."""
    monkeypatch.setattr(substrings, "SAMPLE", 1)
    monkeypatch.setattr(substrings, "HOT_LEAST", 2)
    passage = " ".join(f"w{i}" for i in range(13))
    other = " ".join(f"x{i}" for i in range(20))
    rows = [(1, f"{passage} one"), (3, other), (5, other), (5, f"u {passage} two")]
    got = [tuple(r)[:4] for r in substrings.without_repeats(frame(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted(deduplicated(rows), key=str)
    assert sum(r[2] for r in got) == 33


def test_cover_aligns_any_two_positions():
    for a in range(7):
        for b in range(7):
            assert any((a + k) % 7 in substrings.COVER and (b + k) % 7 in substrings.COVER
                       for k in range(7))


def overlaps(rows, items):
    """All pairs with a window of 13 item words (or all) of which three quarters agree."""
    found = set()
    for d, text in rows:
        words = (text or "").encode().lower().split()
        for item, passage in items:
            want = (passage or "").encode().lower().split()
            width = min(13, len(want))
            for start in range(len(words) - width + 1) if want else ():
                for i in range(len(want) - width + 1):
                    if 4 * sum(map(bytes.__eq__, words[start:start + width],
                                   want[i:i + width])) >= 3 * width:
                        found.add((d, item))
    return found


def benchmark(spark, items):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in items],
                                 "item_id long, text string, hash string, n int")


def test_contaminated(spark):
    pick = random.Random(3)
    words = [f"w{i}" for i in range(3000)]
    items = [(i, " ".join(pick.choices(words, k=k))) for i, k in enumerate((14, 20, 40, 90, 12, 5, 1))]
    items += [(7, None), (8, ""), (None, " ".join(pick.choices(words, k=15))), (9, items[1][1])]
    rows = [(None, items[0][1]), (1, None), (2, ""), (3, "a b c")]
    clean = [" ".join(pick.choices(words, k=60)) for _ in range(5)]
    rows += [(10 + i, t) for i, t in enumerate(clean)]
    for i, t in items:
        if t:
            rows.append((100 + (i if i is not None else 50), f"{clean[0]} {t.upper()} {clean[1]}"))
    changed = items[3][1].split()
    for k in range(0, 90, 9):
        changed[k] = "other"
    rows += [(300, " ".join(changed)), (301, " ".join(changed)), (301, " ".join(changed))]
    rows.append((302, " ".join(pick.choices(words, k=20_000)) + " " + items[2][1]))
    got = decontaminate.contaminated(frame(spark, rows), benchmark(spark, items)).collect()
    assert {(r.doc_id, r.item_id) for r in got} == overlaps(rows, items)
    assert len(got) == len({(r.doc_id, r.item_id) for r in got})
    left = decontaminate.without_contaminated(
        frame(spark, rows), decontaminate.contaminated(frame(spark, rows), benchmark(spark, items)))
    assert {r.doc_id for r in left.collect()} == {d for d, _ in rows} - {d for d, _ in overlaps(rows, items)}


def test_masks_fit_into_every_agreement():
    for width in range(1, 14):
        agree = -(-3 * width // 4)
        masks = decontaminate._masks(width, 13, 0.75)
        places = [{shift + i for i, kept in enumerate(mask) if kept == "1"} for mask in masks
                  for shift in range(width - len(mask) + 1)]
        for same in itertools.combinations(range(width), agree):
            assert any(place <= set(same) for place in places), (width, same)


def test_contaminated_by_substituted_passages(spark):
    pick = random.Random(5)
    words = [f"w{i}" for i in range(2000)]
    items = [(n, " ".join(pick.choices(words, k=n))) for n in (*range(4, 14), 26, 60)]
    rows = []
    for n, text in items:
        for k in range(8):
            changed = text.split()
            if k < 4:
                changed[k::4] = ["other"] * len(changed[k::4])
            else:
                for start in range(0, n, 13):
                    size = min(13, n - start)
                    for i in pick.sample(range(size), size // 4):
                        changed[start + i] = "other"
            clean = " ".join(pick.choices(words, k=40))
            rows.append((10 * n + k, f"{clean} {' '.join(changed)} {clean}"))
    want = overlaps(rows, items)
    assert len(want) > 80
    got = decontaminate.contaminated(frame(spark, rows), benchmark(spark, items)).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want


def test_only_the_contaminated_texts_of_an_id_are_removed(spark):
    pick = random.Random(7)
    words = [f"w{i}" for i in range(2000)]
    clean = [" ".join(pick.choices(words, k=30)) for _ in range(6)]
    items = [(1, " ".join(pick.choices(words, k=20)))]
    bad = f"{clean[0]} {items[0][1]}"
    rows = [(None, bad), (5, bad), (5, bad), *[(None, t) for t in clean[:3]], (None, None),
            *[(5, t) for t in clean[3:]], (6, clean[0])]
    docs = frame(spark, rows)
    found = decontaminate.contaminated(docs, benchmark(spark, items))
    left = decontaminate.without_contaminated(docs, found)
    assert left.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted(
        (r for r in rows if r[1] != bad), key=str)
    assert {(r.doc_id, r.item_id) for r in decontaminate.pairs_of_ids(found).collect()} == {(None, 1), (5, 1)}


def test_contaminated_tables(spark):
    rows = table(FOLDER, "documents", "doc_id, text")
    items = table(FOLDER, "benchmark", "item_id, text")
    words = [(d, set(zip(*[iter_[i:] for i in range(14)]))) for d, t in rows
             for iter_ in [(t or "").encode().lower().split()]]
    want = set()
    for i, t in items:
        w = t.encode().lower().split()
        grams = {tuple(w[k:k + 14]) for k in range(len(w) - 13)}
        want |= {(d, i) for d, s in words if grams & s}
    got = decontaminate.contaminated(frame(spark, rows), benchmark(spark, items)).collect()
    assert {(r.doc_id, r.item_id) for r in got} >= want
    assert {r.doc_id for r in got} == {d for d, _ in want}


def test_no_benchmark_and_no_documents(spark):
    some = benchmark(spark, [(1, "a b c d e f g h i j k l m n")])
    assert decontaminate.contaminated(frame(spark, []), some).count() == 0
    assert decontaminate.contaminated(frame(spark, awkward()), benchmark(spark, [])).count() == 0
