"""URL filter: a blocked Bloom filter of listed canonical URLs, then an exact hash join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemill.llm.store import same

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A block has 256 bits in four words; at most this many blocks are ever sent to executors.
BLOCKS = 1 << 18


def host_of(url: str) -> Column:
    rest = F.expr(f"substring({url}, nullif(instr({url}, '://'), 0) + 3)")
    return F.coalesce(F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER),
                      F.lit(""))


def path_of(url: str) -> Column:
    rest = F.expr(f"substring({url}, nullif(instr({url}, '://'), 0) + 3)")
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical() -> Column:
    """Host and path without scheme, query, fragment, one ending slash or ``.html``; null without
    a host."""
    return F.when(F.col("host") != "", F.concat(
        "host", F.regexp_replace("path", r"(\.html|/)\z", "")))


def _masks(key: Column) -> list[Column]:
    """Two bits in each of four words."""
    bits = F.xxhash64(key, F.lit(1))
    return [_bit(bits, 12 * i).bitwiseOR(_bit(bits, 12 * i + 6)) for i in range(4)]


def _bit(bits: Column, shift: int) -> Column:
    place = F.shiftright(bits, shift).bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def _block(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BLOCKS))


def bloom(keys: DataFrame) -> DataFrame:
    """Blocks of the filter of ``key``: no more rows than ``BLOCKS``, however many keys."""
    masks = _masks(F.col("key"))
    return (keys.select(_block(F.col("key")).alias("block"),
                        *[m.alias(f"m{i}") for i, m in enumerate(masks)])
            .groupBy("block").agg(*[F.bit_or(f"m{i}").alias(f"w{i}") for i in range(4)]))


def maybe_listed(rows: DataFrame, filter_blocks: DataFrame) -> DataFrame:
    """Rows whose ``key`` may be listed."""
    masks = _masks(F.col("key"))
    tested = rows.withColumn("block", _block(F.col("key")))
    for i, mask in enumerate(masks):
        tested = tested.withColumn(f"m{i}", mask)
    fits = F.lit(True)
    for i in range(4):
        fits = fits & (F.col(f"w{i}").bitwiseAND(F.col(f"m{i}")) == F.col(f"m{i}"))
    return (tested.join(F.broadcast(filter_blocks), "block").where(fits).select(rows.columns))


def url_verdicts(pages: DataFrame, rules: DataFrame, listed: DataFrame) -> DataFrame:
    """Judge every page's URL by rules, else by a list of canonical URLs.

    ``rules`` (host, path, verdict) fit a host and its subdomains where the path starts with the
    rule's; the longest wins. ``listed`` (url) are canonical URLs to block. Both kinds are keys of
    one blocked Bloom filter of a fixed size. Each URL asks for its canonical form and, for
    every shape of rule (labels of the host, length of the path), for its own ending and beginning
    of that shape; possible hits are joined exactly. Without any hit a URL is allowed.

    Null URLs and URLs without ``://`` have an empty host and path and are allowed. Repeated rows
    each get their row; other columns of ``pages`` are not read. An empty list or table works.

    Result: page_id, host, path, rule, verdict, listed; one row per page.
    """
    shapes = [tuple(r) for r in rules.select(
        F.size(F.split("host", r"\.")), F.length("path")).distinct().collect()]
    named = rules.select(F.concat(F.lit("r"), "host", F.lit(" "), "path").alias("key"),
                         F.concat("host", "path").alias("rule"), F.col("verdict"))
    keys = named.unionByName(
        listed.where("url IS NOT NULL").distinct()
        .select(F.concat(F.lit("u"), "url").alias("key"), F.lit(None).cast("string").alias("rule"),
                F.lit("block").alias("verdict")))
    judged = pages.select("page_id", "url", host_of("url").alias("host"),
                          path_of("url").alias("path"))
    labels = F.split("host", r"\.")
    asked = [F.concat(F.lit("u"), canonical())] + [
        F.when((F.size(labels) >= n) & (F.length("path") >= m), F.concat(
            F.lit("r"), F.substring_index("host", ".", -n), F.lit(" "),
            F.substring("path", 1, m))) for n, m in shapes]
    wanted = (judged.where("host != ''").select("host", "path", F.explode(F.array(*asked)).alias("key"))
              .where("key IS NOT NULL"))
    possible = maybe_listed(wanted, bloom(keys.select("key"))).distinct()
    best = F.max_by(F.struct("rule", "verdict"), F.when(F.col("rule").isNotNull(),
                                                       F.length("rule")))
    hits = (possible.join(keys, "key").groupBy("host", "path")
            .agg(best.alias("best"), F.bool_or(F.col("rule").isNull()).alias("listed")))
    return (judged.alias("j").join(hits.alias("h"), same(F.col("j.host"), F.col("h.host"))
                                   & same(F.col("j.path"), F.col("h.path")), "left")
            .select("page_id", "j.host", "j.path", F.col("best.rule").alias("rule"),
                    F.coalesce(F.col("best.verdict"), F.when(F.col("listed"), "block"),
                               F.lit("allow")).alias("verdict"),
                    F.coalesce("listed", F.lit(False)).alias("listed")))
