"""SimHash fingerprints of documents, and search of fingerprints within a Hamming radius.

Terms are pairs of neighbouring words, the first word paired with the beginning of the
text. The hash of a term votes once for each occurrence, so a term weighs what it
occurs; the sign of the votes gives each of ``BITS`` bits. Texts without words have
the fingerprint of zeros.

Search cuts fingerprints into ``radius + agreeing`` blocks. Two within the radius agree
in at least ``agreeing`` of them, so one table for each choice of so many blocks, in
which those come first, finds all. What a table finds is
verified by its distance. Equal fingerprints are searched once.

Defined results: a null text is an empty one; repeated rows have equal
fingerprints; rows without id come last in the order of documents, rows of one
id in the order of their texts' hashes; the document after the last is the
first, so one document alone is its own next. Other columns are not read.
"""

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia.llm.arrays import NOT_SPACE, U64, mix, slices, span_hashes, utf8, words
from affinia.sources.workspace import written

BITS = 128
_HALVES = BITS // 64
_BLOCK = 255  # votes that fit one byte
# A byte as eight counters of one byte each.
_SPREAD = np.array(
    [int.from_bytes(bytes((b >> (7 - i)) & 1 for i in range(8)), "little") for b in range(256)], U64
)
_HALF_SEEDS = mix(np.arange(1, _HALVES + 1, dtype=U64))
ROWS_IN_BUCKET = 5_000
_REPEATED = 10_000  # output rows of one batch


def fingerprint_bits(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Fingerprints as rows of BITS / 8 bytes."""
    starts, ends, before = words(data, offsets, NOT_SPACE)
    counts = np.diff(before)
    hashes = span_hashes(data, starts, ends, lower=True)
    previous = np.empty_like(hashes)
    previous[1:] = hashes[:-1]
    previous[before[:-1][counts > 0]] = U64(1)
    terms = hashes + mix(previous) * U64(0xC2B2AE3D27D4EB4F)
    blocks = -(-counts // _BLOCK)
    doc = np.repeat(np.arange(len(counts)), blocks)
    step = np.arange(len(doc)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    at = before[doc] + step * _BLOCK
    votes = np.zeros((len(counts), BITS), np.int64)
    if len(at):
        sums = np.empty((len(at), BITS // 8), U64)
        for half in range(_HALVES):
            column = mix(terms + _HALF_SEEDS[half]).view(np.uint8).reshape(-1, 8)
            for i in range(8):
                sums[:, half * 8 + i] = np.add.reduceat(_SPREAD[column[:, i]], at)
        by_block = sums.view(np.uint8).astype(np.int64)
        first = np.flatnonzero(step == 0)
        votes[doc[first]] = np.add.reduceat(by_block, first, axis=0)
    return np.packbits(2 * votes > counts[:, None], axis=1)


def _alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 1 - np.bitwise_count(a ^ b).sum(axis=1) / BITS


def _hex(bits: np.ndarray) -> list[str]:
    flat = bits.tobytes().hex()
    width = BITS // 4
    return [flat[i : i + width] for i in range(0, len(flat), width)]


def _fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in slices(batches):
        found = pa.array(_hex(fingerprint_bits(data, offsets)), pa.string())
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), found], names=["doc_id", "fingerprint"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """Columns doc_id and fingerprint, in hexadecimal."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_fingerprint, "doc_id long, fingerprint string")


def _bits(fingerprint: Column) -> Column:
    halves = [
        F.lpad(F.conv(F.substring(fingerprint, 1 + 16 * i, 16), 16, 2), 64, "0") for i in range(_HALVES)
    ]
    return F.concat(*halves)


def _tables(fingerprints: DataFrame, name: str, radius: int, agreeing: int) -> DataFrame:
    """Each distinct fingerprint under its key in every table."""
    count = radius + agreeing
    edges = [BITS * i // count for i in range(count + 1)]
    rows = fingerprints.select(F.col("fingerprint").alias(name)).where("fingerprint IS NOT NULL").distinct()
    rows = rows.withColumn("bits", _bits(F.col(name)))
    keys = [
        F.concat(*(F.substring("bits", edges[i] + 1, edges[i + 1] - edges[i]) for i in choice))
        for choice in combinations(range(count), agreeing)
    ]
    return rows.select(name, F.posexplode(F.array(*keys)).alias("table", "key"))


def within_radius(queries: DataFrame, stored: DataFrame, radius: int, agreeing: int = 2) -> DataFrame:
    """Pairs (query, fingerprint, distance) of distinct fingerprints at most ``radius`` bits apart."""
    if not 0 <= radius <= BITS - agreeing or agreeing < 1:
        raise ValueError("radius and agreeing blocks must fit into the fingerprint")
    left = _tables(queries, "query", radius, agreeing)
    right = _tables(stored, "fingerprint", radius, agreeing)
    half = lambda name, i: F.conv(F.substring(name, 1 + 16 * i, 16), 16, -10).cast("long")
    apart = [F.bit_count(half("query", i).bitwiseXOR(half("fingerprint", i))) for i in range(_HALVES)]
    pairs = left.join(right, ["table", "key"]).select("query", "fingerprint").distinct()
    pairs = pairs.withColumn("distance", sum(apart[1:], apart[0]).cast("int"))
    return pairs.where(F.col("distance") <= radius)


def neighbours(queries: DataFrame, stored: DataFrame, radius: int) -> DataFrame:
    """For each query document: how many fingerprints, and documents with them, are within the radius.

    Both tables have doc_id and fingerprint. A query among the stored documents counts itself. Every
    query row gets one row, repeated ones and those without id too; a null fingerprint, or an empty table of
    stored ones, gives zeros.
    """
    sizes = written(stored.groupBy("fingerprint").agg(F.count("*").alias("n")), "sizes")
    pairs = within_radius(queries, sizes, radius)
    found = pairs.join(sizes, "fingerprint").groupBy("query").agg(
        F.count("*").alias("n_fingerprints"), F.sum("n").alias("n_documents")
    )
    found = written(found.withColumnRenamed("query", "fingerprint"), "neighbours")
    none = F.lit(0).cast("long")
    return queries.join(found, "fingerprint", "left").select(
        "doc_id",
        "fingerprint",
        F.coalesce("n_fingerprints", none).alias("n_fingerprints"),
        F.coalesce("n_documents", none).alias("n_documents"),
    )


_EDITED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order; every bucket ends with a row that only follows its last document.

    A row that stands for several equal ones is followed by itself but for the last time.
    """
    last = None  # the row whose next one has not been seen
    for rows, data, offsets in slices(batches):
        own = fingerprint_bits(data, offsets)
        ids, follows, times = (rows.column(name).to_pylist() for name in ("doc_id", "follows", "n"))
        texts = [text or "" for text in rows.column("text").to_pylist()]
        here = [*([last] if last else []), *zip(ids, follows, texts, own, times)]
        last = here[-1]
        pairs = [(a, b, 1) for a, b in zip(here, here[1:]) if not a[1]]
        pairs += [(a, a, a[4] - 1) for a, _, _ in pairs if a[4] > 1]
        if not pairs:
            continue
        edited = []
        for (_, _, text, _, _), (_, _, after, _, _), _ in pairs:
            cut = len(text) // 3
            edited.append(text[: len(text) - cut] + after[:cut])
        mine, following = np.stack([a[3] for a, _, _ in pairs]), np.stack([b[3] for _, b, _ in pairs])
        changed = fingerprint_bits(*utf8(pa.array(edited, pa.string())))
        columns = [
            pa.array([a[0] for a, _, _ in pairs], pa.int64()),
            pa.array([len(a[2]) for a, _, _ in pairs], pa.int64()),
            pa.array([hashlib.sha256(text.encode()).hexdigest() for text in edited]),
            pa.array(_hex(mine)),
            pa.array(_hex(changed)),
            pa.array(_alike(mine, changed)),
            pa.array(_alike(mine, following)),
        ]
        found = pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in _EDITED.split(", ")])
        each = np.repeat(np.arange(len(pairs)), [n for _, _, n in pairs])
        for begin in range(0, len(each), _REPEATED):
            yield found.take(pa.array(each[begin : begin + _REPEATED]))


def _ordered(key: np.ndarray, digest: np.ndarray) -> np.ndarray:
    """Both numbers as bytes that fall as the rows rise in order: descending keys, then hashes."""
    both = np.stack([key, digest], axis=1).astype(np.int64).view(np.uint64) ^ U64(1 << 63)
    return np.ascontiguousarray((~both).astype(">u8")).view("V16").ravel().view("S16")


_DEALT = "bucket long, follows boolean, key long, hash long, doc_id long, n long, text string"


def _dealt(tops: np.ndarray):
    """Rows with their bucket. The first row of a bucket is sent once more, to the end of the one before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            place = _ordered(rows.column("key").to_numpy(), rows.column("hash").to_numpy())
            bucket = np.searchsorted(tops, place, "right") - 1
            first = np.flatnonzero(tops[bucket] == place)
            for at, of, follows in ((None, bucket, False), (first, (bucket[first] - 1) % len(tops), True)):
                part = rows if at is None else rows.take(pa.array(at))
                columns = [pa.array(of), pa.array(np.full(len(of), follows))]
                columns += [part.column(name) for name in ("key", "hash", "doc_id", "n", "text")]
                yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in _DEALT.split(", ")])

    return run


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Every document against its edited text and the next document, in descending order of ids.

    The last third of the characters is replaced by the first characters of the next document.
    Rows are dealt to ranges of (id, hash of the text), so rows without id or of one id are spread
    like any others; rows equal in both are sent as one row with their number. One bound for each
    range of ``ROWS_IN_BUCKET`` rows passes through the driver.
    """
    doc_id, text = F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit(""))
    key = F.coalesce(doc_id, F.lit(-(2**63)).cast("long"))
    rows = docs.select(doc_id.alias("doc_id"), key.alias("key"), F.xxhash64(text).alias("hash"), text.alias("text"))
    order = written(rows.select("key", "hash").groupBy("key", "hash").agg(F.count("*").alias("n")), "order")
    count = order.count()
    if not count:
        return docs.sparkSession.createDataFrame([], _EDITED)
    ranges = -(-count // ROWS_IN_BUCKET)
    ranged = order.repartitionByRange(ranges, F.desc("key"), F.desc("hash"))
    tops = ranged.groupBy(F.spark_partition_id()).agg(F.max(F.struct("key", "hash")).alias("x")).select("x.*").toArrow()
    tops = np.sort(_ordered(tops.column("key").to_numpy(), tops.column("hash").to_numpy()))
    several = written(order.where("n > 1").select("key", "hash"), "repeated")
    single = rows.withColumn("n", F.lit(1).cast("long"))
    if not several.isEmpty():
        once = single.join(several, ["key", "hash"], "left_anti")
        again = rows.join(several, ["key", "hash"]).groupBy("key", "hash", "doc_id", "text").agg(F.count("*").alias("n"))
        single = once.unionByName(again)
    dealt = single.mapInArrow(_dealt(tops), _DEALT).repartition("bucket")
    order = ("bucket", "follows", F.desc("key"), F.desc("hash"))
    return dealt.sortWithinPartitions(*order).select("doc_id", "follows", "n", "text").mapInArrow(_edit, _EDITED)
