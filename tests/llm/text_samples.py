"""Literal documents with every awkward shape, and columns whose names operators use inside."""

from __future__ import annotations

import random

import duckdb

EXTRA = ("key", "hash", "row", "component", "name", "node", "u", "n", "place", "places", "word",
         "label_", "below", "copies", "first", "minima", "held_out", "score")


def frame(spark, rows):
    """Documents (doc_id, text) with the other columns and clashing extra ones."""
    schema = ("doc_id long, text string, lang string, source string, n_chars long, "
              + ", ".join(f"`{c}` string" for c in EXTRA))
    return spark.createDataFrame(
        [(d, t, None if i % 7 == 3 else "en", None if i % 5 == 2 else f"s{i % 3}",
          None if t is None else len(t), *["x"] * len(EXTRA)) for i, (d, t) in enumerate(rows)],
        schema)


def awkward(seed: int = 1) -> list[tuple]:
    """Null ids, null and empty texts, copies, near copies, shared passages, one very long text."""
    pick = random.Random(seed)
    vocabulary = [a + b for a in "bdfklmnprst" for b in ("a", "e", "i", "o", "u", "É", "ß")]

    def text(n):
        return " ".join("".join(pick.choices(vocabulary, k=pick.randint(1, 3))) for _ in range(n))

    passage, common = text(30), text(14)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one two three four"),
            (None, text(40)), (6, "ONE two Three four")]
    base = text(120)
    rows += [(10, base), (11, base), (11, base), (None, base), (12, base.replace(" ", "\n"))]
    words = base.split()
    for i in range(8):
        changed = list(words)
        for _ in range(i):
            changed[pick.randrange(len(changed))] = "changed"
        rows.append((20 + i, " ".join(changed)))
    rows += [(40 + i, f"{text(25)} {passage} {text(pick.randint(0, 50))}") for i in range(6)]
    rows += [(60 + i, f"{common} {text(20)}") for i in range(40)]
    rows += [(150, text(12)), (151, text(13)), (152, "a b c d\x0be\x1cf\x0cg " * 9)]
    rows.append((200, text(30_000) + " " + passage + " " + base))
    rows += [(201, passage), (202, passage.upper())]
    return rows


def table(folder: str, name: str, columns: str = "*") -> list[tuple]:
    return duckdb.sql(f"SELECT {columns} FROM '{folder}/{name}.parquet'").fetchall()


def union_find(ids):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(a, b):
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return find, join
