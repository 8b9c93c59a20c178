"""Mixing sources to target weights: tempered shares, dealt as budgeted permutations in blocks.

Columns and SQL expressions only. Nulls: a null source is a source of its own; a null text has
no tokens. Documents without tokens are never drawn. Rows with one id fall together: both are
in a cut or both are out. An empty table gives an empty plan.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemill.llm.store import same, written
from tidemill.llm.words import WORD

LEVELS, DEPTH = 5, 30


def _number(*parts: Column | str) -> Column:
    """60 bits of a hash of the parts."""
    text = F.concat_ws(":", *[F.lit(p) if isinstance(p, str) else p for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _measured(sources: DataFrame, exponents: list[float], budget: int) -> dict[float, tuple]:
    """For each exponent the largest repetition and the entropy of the tempered weights."""
    power = F.pow("share", "a")
    rows = (sources.select("share", "tokens", F.explode(F.array(*map(F.lit, exponents))).alias("a"))
            .groupBy("a").agg(F.sum(power).alias("z"), F.max(power / F.col("tokens")).alias("m"),
                              F.sum(power * F.ln("share")).alias("e")).collect())
    return {r.a: (r.m / r.z * budget, log(r.z) - r.a * r.e / r.z) for r in rows}


def bisected(sources: DataFrame, budget: int, max_repeats: float | None,
             entropy: float | None) -> float:
    """The exponent in [0, 1], to 2^-30: the smallest whose largest repetition stays within
    ``max_repeats`` or whose entropy is no more than ``entropy``; 1 if none does.

    Each job measures the nodes of five levels of the bisection at once, so that six jobs
    over the sources do thirty steps, and only 31 measures reach the driver.
    """
    def enough(measure: tuple) -> bool:
        repeats, spread = measure
        return repeats <= max_repeats if max_repeats is not None else spread <= entropy

    ends = _measured(sources, [0.0, 1.0], budget)
    if not ends or enough(ends[0.0]):
        return 0.0
    if not enough(ends[1.0]):
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(0, DEPTH, LEVELS):
        step = (high - low) / 2 ** LEVELS
        seen = _measured(sources, [low + step * i for i in range(1, 2 ** LEVELS)], budget)
        for _ in range(LEVELS):
            middle = (low + high) / 2
            low, high = (low, middle) if enough(seen[middle]) else (middle, high)
    return high


def _cut(rows: DataFrame, left: DataFrame, shift: int, width: int) -> DataFrame:
    """Of each source, the part of the permutation (by bits of ``u``) in which the budget ends.

    ``left`` has (source, prefix, room). Returned: (source, prefix, room) one level further, only
    where a part is cut; at the last level (width 0) the last whole ``u`` as prefix.
    """
    part = F.shiftright("u", shift) if shift else F.col("u")
    inside = rows.alias("r").join(
        left.alias("l"), same(F.col("r.source"), F.col("l.source"))
        & (F.shiftright("r.u", shift + width) == F.col("l.prefix")))
    sums = (inside.select("r.source", part.alias("part"), "l.room", "tokens")
            .groupBy("source", "part", "room").agg(F.sum("tokens").alias("tokens")))
    so_far = F.sum("tokens").over(Window.partitionBy("source").orderBy("part"))
    return sums.select("source", "part", "room", "tokens", so_far.alias("so_far"))


def mixing_plan(docs: DataFrame, max_repeats: float | None = None, entropy: float | None = None,
                budget: int | None = None, blocks: int = 1024, seed: str = "mix") -> DataFrame:
    """Which documents a mixture of ``budget`` tokens (default: all there are) draws, how often
    and in which block.

    Shares p of the sources' tokens become weights p^a / sum p^a, with a from ``bisected``.
    A source's budget gives whole passes over it and a rest; the rest is the longest beginning
    of a hashed permutation of the source that fits. The end of that beginning is found part by
    part: token sums of 1024 parts, then of 1024 parts of the part in which the budget ends,
    then of documents there, so no task sorts a source. Each pass deals its documents to blocks
    by another hash; order by ``block, position`` is the mixture's order.

    Result: doc_id, source, n_tokens, pass, block, position; a row per document and pass.
    """
    rows = written(docs.select(
        "doc_id", "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("tokens"),
        _number(seed, F.col("doc_id").cast("string")).alias("u"))
        .where("tokens > 0"), "mix-rows")
    total = rows.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    budget = total if budget is None else budget
    sources = written(rows.groupBy("source").agg(F.sum("tokens").alias("tokens"))
                      .withColumn("share", F.col("tokens") / F.lit(total or 1)), "mix-sources")
    a = bisected(sources, budget, max_repeats, entropy)
    power = F.pow("share", F.lit(a))
    whole = sources.agg(F.sum(power)).first()[0] or 1.0
    dealt = F.floor(power / F.lit(whole) * F.lit(budget)).cast("long")
    target = written(sources.withColumn("dealt", dealt).select(
        "source", F.expr("dealt div tokens").alias("passes"),
        F.expr("dealt % tokens").alias("room")), "mix-target")

    first = _cut(rows, target.select("source", F.lit(0).cast("long").alias("prefix"), "room"),
                 50, 10)
    second = _cut(rows, written(_ending(first), "mix-first"), 40, 10)
    third = _cut(rows, written(_ending(second), "mix-second"), 0, 40)
    ends = (_last(first, 50).unionByName(_last(second, 40)).unionByName(_last(third, 0))
            .groupBy("source").agg(F.max("below").alias("below")))
    # written, so that a hot source meets a plain table: sent whole if small, else split
    plan = written(target.alias("t").join(ends.alias("e"), same(F.col("t.source"), F.col("e.source")),
                                          "left")
                   .select("t.source", "passes", F.coalesce("below", F.lit(0)).alias("below")),
                   "mix-plan")
    drawn = rows.alias("r").join(plan.alias("p"), same(F.col("r.source"), F.col("p.source")))
    drawn = drawn.select(
        "doc_id", "r.source", F.col("tokens").alias("n_tokens"),
        (F.col("passes") + F.when(F.col("u") < F.col("below"), 1).otherwise(0)).alias("copies"))
    passes = drawn.where("copies > 0").select(
        "doc_id", "source", "n_tokens",
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("pass"))
    place = _number(seed, F.col("pass").cast("string"), F.col("doc_id").cast("string"))
    return passes.withColumn("place", place).select(
        "doc_id", "source", "n_tokens", "pass", F.expr(f"place % {blocks}").alias("block"),
        F.expr(f"place div {blocks}").alias("position"))


def _ending(sums: DataFrame) -> DataFrame:
    """The part in which a source's budget ends, with the room that is left there."""
    before = F.col("so_far") - F.col("tokens")
    return (sums.where((before <= F.col("room")) & (F.col("so_far") > F.col("room")))
            .select("source", F.col("part").alias("prefix"), (F.col("room") - before).alias("room")))


def _last(sums: DataFrame, shift: int) -> DataFrame:
    """Where the whole parts of each source end: an exclusive bound of ``u``."""
    return (sums.where(F.col("so_far") <= F.col("room")).groupBy("source")
            .agg(F.shiftleft(F.max("part") + 1, shift).alias("below")))


def mixing_sql(max_repeats: float, blocks: int = 1024, seed: str = "mix",
               documents: str = "documents") -> str:
    """The same plan in SQL, with the budget of all tokens."""
    return f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(text, '{WORD}')) AS n,
    ('0x' || substr(md5(concat_ws(':', '{seed}', doc_id)), 1, 15))::BIGINT AS u
  FROM {documents} WHERE len(regexp_extract_all(text, '{WORD}')) > 0),
tot AS (SELECT sum(n)::BIGINT AS t FROM d),
s AS (SELECT source, sum(n)::BIGINT AS n, sum(n)::BIGINT / (SELECT t FROM tot) AS share
  FROM d GROUP BY source),
tried AS (
  SELECT 0 AS i, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi
  UNION ALL
  SELECT i + 1, CASE WHEN ok THEN lo ELSE mid END, CASE WHEN ok THEN mid ELSE hi END
  FROM (SELECT i, lo, hi, (lo + hi) / 2 AS mid,
      (SELECT max(pow(share, (lo + hi) / 2) / n) / sum(pow(share, (lo + hi) / 2))
         * (SELECT t FROM tot) <= {max_repeats} FROM s) AS ok
    FROM tried WHERE i < {DEPTH})),
ex AS (SELECT CASE
    WHEN (SELECT max(1.0 / n) / count(*) * (SELECT t FROM tot) <= {max_repeats} FROM s) THEN 0.0
    WHEN NOT (SELECT max(share / n) / sum(share) * (SELECT t FROM tot) <= {max_repeats} FROM s)
      THEN 1.0
    ELSE (SELECT hi FROM tried WHERE i = {DEPTH}) END AS a),
w AS (SELECT source, n, floor(pow(share, a) / (SELECT sum(pow(share, a)) FROM s, ex)
    * (SELECT t FROM tot))::BIGINT AS b FROM s, ex),
c AS (SELECT d.doc_id, d.source, d.n, w.b // w.n AS passes, w.b % w.n AS room,
    sum(d.n) OVER (PARTITION BY d.source ORDER BY d.u) AS so_far
  FROM d JOIN w ON d.source IS NOT DISTINCT FROM w.source),
p AS (SELECT doc_id, source, n, unnest(range(1, passes + 1
    + CASE WHEN so_far <= room THEN 1 ELSE 0 END)) AS pass FROM c),
q AS (SELECT *, ('0x' || substr(md5(concat_ws(':', '{seed}', pass, doc_id)), 1, 15))::BIGINT
    AS place FROM p)
SELECT doc_id, source, n AS n_tokens, pass, place % {blocks} AS block,
  place // {blocks} AS position FROM q"""
