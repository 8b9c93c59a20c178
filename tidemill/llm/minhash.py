"""MinHash near-dedup: universal hash minima, bands, verified links and their components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tidemill.llm.components import components
from tidemill.llm.store import bit_filter, in_filter, removed, stored, written
from tidemill.llm.words import batches, binaries, each_text, mixed, window_hashes
from tidemill.operators.visits import first_per

#: 40 bands of 4 minima: two texts of similarity 0.75 share no band with probability 2.5e-7.
BANDS, ROWS = 40, 4
HASHES = BANDS * ROWS
SHINGLE = 5
#: Links need ``SIMILAR`` percent; pairs whose minima agree in less than ``AGREE`` of the places
#: (6.5 standard deviations below 0.75: 4 in 10^11 pairs just linked) are not compared in full.
SIMILAR = 75
AGREE = 0.75 - 6.5 * (0.75 * 0.25 / HASHES) ** 0.5
#: Rows of a bucket that one task compares with as many others.
CHUNK = 2000
#: Bits of the filter of documents to compare: 2 MB whatever their number.
FILTER_BITS = 24

_random = np.random.default_rng(20)
_FACTORS = _random.integers(1, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _random.integers(0, 1 << 63, HASHES, np.uint64)
_MULTIPLIER = 0x2545F4914F6CDD1D


def shingles(hashes: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """Distinct shingles of a text's word hashes as sorted 64-bit hashes; fewer words make one
    shingle, none make none."""
    if not len(hashes):
        return np.empty(0, np.uint64)
    if len(hashes) < width:
        return mixed(window_hashes(hashes, len(hashes), _MULTIPLIER) + np.uint64(len(hashes)))
    return np.unique(window_hashes(hashes, width, _MULTIPLIER))


def minima(found: np.ndarray) -> np.ndarray:
    """The smallest of each universal hash ((a x + b) mod 2^64) div 2^32 over the shingles."""
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(found), 4096):
        part = found[start:start + 4096]
        values = (_FACTORS[:, None] * part + _OFFSETS[:, None]) >> np.uint64(32)
        np.minimum(out, values.min(1).astype(np.uint32), out=out)
    return out


def set_key(found: np.ndarray) -> bytes | None:
    """128 bits that name a set; texts with the same shingles are one class."""
    return xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None


def signed_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, n_shingles, key, minima) of each row; the mark is a hash of the text."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: dict[bytes, bytes] = {}
        for part in batches(parts, 500):
            sizes, keys, signs = [], [], []
            for words in each_text(binaries(part.column(2)), True):
                found = shingles(words)
                key = set_key(found)
                if key is not None and key not in last:
                    if len(last) > 20_000:
                        last.clear()
                    last[key] = minima(found).tobytes()
                sizes.append(len(found))
                keys.append(key)
                signs.append(last[key] if key is not None else None)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(sizes, pa.int64()),
                 pa.array(keys, pa.binary()), pa.array(signs, pa.binary())],
                ["doc_id", "mark", "n_shingles", "key", "minima"])
    return docs.select(F.col("doc_id").cast("long"), _mark(F.col("text")).alias("mark"),
                       "text").mapInArrow(
        run, "doc_id long, mark long, n_shingles long, key binary, minima binary")


def _mark(text: Column) -> Column:
    return F.xxhash64(text)


def _sets(docs: DataFrame, wanted: DataFrame, short: bool = False) -> DataFrame:
    """(key, shingles) of the classes in ``wanted`` (key), from the texts; ``short``: 32 bits each.

    A filter of fixed size keeps most other sets from leaving the task; the join is exact.
    """
    tail = F.conv(F.hex(F.substring("key", 10, 7)), 16, 10).cast("long")
    bits = bit_filter(wanted.select(tail.alias("hash")), "hash", FILTER_BITS)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[bytes] = set()
        for part in batches(parts, 500):
            got = {}
            for words in each_text(binaries(part.column(0)), True):
                found = shingles(words)
                key = set_key(found)
                if key is not None and key not in sent and in_filter(
                        bits, np.array([int.from_bytes(key[9:], "big")], np.uint64))[0]:
                    got[key] = (np.unique(found.astype(np.uint32)) if short else found).tobytes()
                    sent.add(key)
            if len(sent) > 500_000:
                sent.clear()
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(got), pa.binary()), pa.array(list(got.values()), pa.binary())],
                ["key", "shingles"])
    found = docs.select("text").mapInArrow(run, "key binary, shingles binary")
    return (found.join(wanted, "key").groupBy("key")
            .agg(F.first("shingles").alias("shingles")))


def _buckets(signs: np.ndarray) -> np.ndarray:
    """The bucket of each row of minima in each band."""
    halves = signs.reshape(len(signs), BANDS, ROWS).astype(np.uint64)
    out = mixed(halves[:, :, 0] << np.uint64(32) | halves[:, :, 1])
    out = mixed(out + (halves[:, :, 2] << np.uint64(32) | halves[:, :, 3]))
    return mixed(out + np.arange(BANDS, dtype=np.uint64))


def _members(classes: DataFrame) -> DataFrame:
    """(bucket, band, key, n): the classes in each bucket that holds more than one.

    Buckets are counted by their hash alone; a filter of those met twice lets few other rows
    leave their task, and the join is exact.
    """
    def hashes(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(parts):
            yield pa.RecordBatch.from_arrays(
                [pa.array(_buckets(_signs(part.column(0).to_pylist())).ravel().view(np.int64))],
                ["bucket"])
    twice = written(classes.select("minima").mapInArrow(hashes, "bucket long")
                    .groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1"),
                    "minhash-shared")
    sent = classes.sparkSession.sparkContext.broadcast(
        bit_filter(twice.select("bucket"), "bucket", FILTER_BITS))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches(parts):
            buckets = _buckets(_signs(part.column(2).to_pylist()))
            row, band = np.nonzero(in_filter(sent.value, buckets))
            yield pa.RecordBatch.from_arrays(
                [pa.array(buckets[row, band].view(np.int64)), pa.array(band, pa.int32()),
                 part.column(0).take(pa.array(row)), part.column(1).take(pa.array(row))],
                ["bucket", "band", "key", "n"])
    return (classes.select("key", F.col("n_shingles").alias("n"), "minima")
            .mapInArrow(run, "bucket long, band int, key binary, n long").join(twice, "bucket"))


def _signs(minima: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(minima), np.uint32).reshape(-1, HASHES)


def _alike_in_size(n: str, m: str) -> Column:
    """Whether sets of these sizes can be similar enough."""
    return F.least(n, m) * 100 >= F.greatest(n, m) * SIMILAR


def _open_pairs(members: DataFrame) -> DataFrame:
    """(a, b): classes of one bucket and different groups that are similar enough by shingles of
    32 bits, which can only look more alike than they are.

    Rows (bucket, band, key, n, group, minima, shingles) come sorted by bucket, and a bucket's
    rows are compared in blocks: first the minima of all, then the shingles of what is left. A
    full bucket is split into chunks, each pair of which is a part of its own, so no task holds
    more than two chunks. A pair is returned from its first common band.
    """
    split = (members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
             .select("bucket", F.ceil(F.col("size") / CHUNK).cast("int").alias("chunks")))
    dealt = (members.join(split, "bucket")
             .withColumn("chunk", F.pmod(F.xxhash64("key"), F.col("chunks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .select("bucket", F.least("chunk", "other").alias("low"),
                     F.greatest("chunk", "other").alias("high"), "chunk", "band", "key", "n",
                     "group", "minima", "shingles"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for part in batches(parts, 5000):
            rows = pa.Table.from_batches([part])
            rows = pa.concat_tables([rest, rows]).combine_chunks() if rest else rows
            names = [rows.column(i).to_numpy() for i in range(3)]
            edges = np.flatnonzero(np.any([x[1:] != x[:-1] for x in names], axis=0)) + 1
            edges = [0, *edges.tolist()]
            for start, end in zip(edges, edges[1:]):
                yield from _near_pairs(rows.slice(start, end - start))
            rest = rows.slice(edges[-1])
        if rest:
            yield from _near_pairs(rest)
    return (dealt.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
            .mapInArrow(run, "a binary, b binary"))


def _near_pairs(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Pairs of one part of a bucket."""
    if len(rows) < 2:
        return
    keys, groups = rows.column("key").to_pylist(), rows.column("group").to_pylist()
    ids = {g: i for i, g in enumerate(set(groups))}
    group = np.array([ids[g] for g in groups])
    chunk, sizes = rows.column("chunk").to_numpy(), rows.column("n").to_numpy()
    across = rows.column("low")[0].as_py() != rows.column("high")[0].as_py()
    band = rows.column("band")[0].as_py()
    signs = np.frombuffer(b"".join(rows.column("minima").to_pylist()), np.uint32).reshape(
        -1, HASHES)
    places = np.ascontiguousarray(signs.T)
    sets = [np.frombuffer(x, np.uint32) for x in rows.column("shingles").to_pylist()]
    a, b = [], []
    for start in range(0, len(keys), 256):
        own = np.arange(start, min(start + 256, len(keys)))
        agreed = np.zeros((len(own), len(keys)), np.int16)
        for place in places:
            agreed += place[own][:, None] == place
        fits = (agreed >= AGREE * HASHES) & (group[own][:, None] != group)
        fits &= np.arange(len(keys)) > own[:, None]
        fits &= (np.minimum(sizes[own][:, None], sizes) * 100
                 >= np.maximum(sizes[own][:, None], sizes) * SIMILAR)
        if across:
            fits &= chunk[own][:, None] != chunk
        i, j = np.nonzero(fits)
        i = own[i]
        if len(i):
            same = (signs[i] == signs[j]).reshape(-1, BANDS, ROWS).all(2)
            first = same.argmax(1) == band
            for x, y in zip(i[first].tolist(), j[first].tolist()):
                common = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if 100 * common >= (SIMILAR - 1) * (len(sets[x]) + len(sets[y]) - common):
                    a.append(keys[x])
                    b.append(keys[y])
    if a:
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())],
                                         ["a", "b"])


def _linked(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of classes whose full sets are similar enough."""
    def agree(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            left, right = (np.frombuffer(b"".join(part.column(i).to_pylist()), np.uint32)
                           .reshape(-1, HASHES) for i in (2, 3))
            share = (left == right).mean(1) if len(left) else np.empty(0)
            yield part.select(["a", "b"]).filter(pa.array(share >= AGREE, pa.bool_()))

    def similar(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            keep = []
            for x, y in zip(part.column(2).to_pylist(), part.column(3).to_pylist()):
                left, right = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(100 * common >= SIMILAR * (len(left) + len(right) - common))
            yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def beside(rows: DataFrame, table: DataFrame, value: str) -> DataFrame:
        return (rows.join(table.select(F.col("key").alias("a"), F.col(value).alias("x")), "a")
                .join(table.select(F.col("key").alias("b"), F.col(value).alias("y")), "b")
                .select("a", "b", "x", "y"))

    spark = classes.sparkSession
    pairs, first = stored(pairs, "minhash-pairs")
    keys = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()
    signs = classes.join(keys, "key", "left_semi").select("key", "minima")
    likely, second = stored(beside(pairs, signs, "minima").mapInArrow(agree, "a binary, b binary"),
                            "minhash-likely")
    removed(spark, first)
    keys = likely.select(F.col("a").alias("key")).union(likely.select("b")).distinct()
    wanted, third = stored(keys, "minhash-wanted")
    sets, fourth = stored(_sets(docs, wanted), "minhash-sets")
    links = written(beside(likely, sets, "shingles").mapInArrow(similar, "a binary, b binary"),
                    "minhash-links")
    for folder in (second, third, fourth):
        removed(spark, folder)
    return links


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Groups of documents linked by a similarity of word shingles of 0.75 or more.

    Texts with equal shingle sets are one class, whatever the number of copies. Classes that
    share a band's four minima meet in a bucket. First each is compared with the bucket's
    center, the class that meets most others in all its buckets (of a text and its altered
    copies, the text); after the components of these links, classes of a bucket that are still
    in different components are compared with each other, in blocks. A pair is confirmed by the
    minima, then on the full sets, so a bucket of a thousand near copies costs a thousand
    comparisons, and no link between components is missed in a bucket.

    Null texts and texts without words are linked with nothing. Ids may be null or repeated: rows
    with equal sets are in one group, a null id is never a group's smallest. Other columns
    are not read.

    Result: doc_id, n_shingles, component_id, kept; one row per row.
    """
    return _grouped(docs).drop("mark", "stays")


def _grouped(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    signed, folder = stored(signed_documents(docs), "minhash-signed")
    named = written(signed.drop("minima"), "minhash-named")
    classes = written(signed.where("key IS NOT NULL").groupBy("key").agg(
        F.first("n_shingles").alias("n_shingles"), F.first("minima").alias("minima")),
        "minhash-classes")
    removed(spark, folder)
    met, folder = stored(_members(classes), "minhash-met")
    fame = met.groupBy("key").agg(F.sum("size").alias("fame"))
    centers = (met.join(fame, "key").groupBy("bucket").agg(
        F.max_by(F.struct("key", "n"), F.struct("fame", "key")).alias("center")))
    shared = written(met.drop("size").join(centers, "bucket"), "minhash-buckets")
    removed(spark, folder)
    star = (shared.where((F.col("key") != F.col("center.key"))
                         & _alike_in_size("n", "center.n"))
            .select(F.least("key", "center.key").alias("a"),
                    F.greatest("key", "center.key").alias("b")).distinct())
    links = _linked(docs, classes, star)
    groups = components(links, "a", "b")

    placed = shared.join(groups, shared["key"] == groups["node"], "left").select(
        "bucket", "band", "key", "n", "center", F.coalesce("component", "key").alias("group"))
    mixed_buckets = (placed.groupBy("bucket").agg(F.min("group").alias("low"),
                                                  F.max("group").alias("high"))
                     .where("low != high").select("bucket"))
    open_members = written(placed.where(F.col("key") != F.col("center.key"))
                           .join(mixed_buckets, "bucket").drop("center"), "minhash-open")
    keys = written(open_members.select("key").distinct(), "minhash-wanted")
    signs = classes.join(keys, "key", "left_semi").select("key", "minima")
    beside, folder = stored(signs.join(_sets(docs, keys, short=True), "key"), "minhash-beside")
    more = _linked(docs, classes, _open_pairs(open_members.join(beside, "key")))
    removed(spark, folder)
    if not more.isEmpty():
        groups = components(links.unionByName(more), "a", "b")

    grouped = (named.where("key IS NOT NULL").join(
        groups.select(F.col("node").alias("key"), "component"), "key", "left")
        .select("doc_id", "mark", "n_shingles", F.coalesce("component", "key").alias("group")))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark")
    smallest = grouped.groupBy("group").agg(F.min("doc_id").alias("component_id"),
                                            F.min(place).alias("first"))
    whole = grouped.join(smallest, "group").select(
        "doc_id", "mark", "n_shingles", "component_id", place.eqNullSafe(F.col("first")).alias("stays"))
    alone = named.where("key IS NULL").select(
        "doc_id", "mark", "n_shingles", F.col("doc_id").alias("component_id"),
        F.lit(True).alias("stays"))
    return whole.unionByName(alone).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """One row of each group, with all its columns; rows linked with nothing all stay.

    Of a group the row with the smallest id stays (null after all others), of equal ids the one
    with the smallest hash of the text, of equal texts the one whose other columns, in their
    order, come first. The others are removed by id and text.
    """
    rows = written(_grouped(docs).select("doc_id", "mark", "n_shingles", "stays"), "minhash-kept")
    gone = rows.where("NOT stays").select(F.col("doc_id").alias("gone_id"),
                                          F.col("mark").alias("gone_mark")).distinct()
    left = docs.join(gone, docs["doc_id"].eqNullSafe(gone["gone_id"])
                     & (_mark(docs["text"]) == gone["gone_mark"]), "left_anti")
    repeated = (rows.where("stays AND n_shingles > 0").groupBy("doc_id", "mark").count()
                .where("count > 1"))
    if repeated.isEmpty():
        return left
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    return left.where(~worded).unionByName(
        first_per(left.where(worded), ["doc_id", "text"], others or ["doc_id"]))
