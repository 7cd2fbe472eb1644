"""Importance resampling of documents towards a target distribution, without replacement.

Features of a text are its runs of 1 to ``run`` consecutive words. They are hashed into ``buckets``;
one array counts the buckets of all documents, one those of all target texts, and the
logarithm of their smoothed ratio is the gain of a bucket. A document weighs the mean gain
of its features. Gumbel noise from a hash of its id is added, and the highest scores are drawn:
a sample without replacement whose chances follow the weights.

Arrays of one count per bucket are all that the driver holds. Ranks come from a distributed radix
sort (``radix``). Scores are counted in steps first: what lies below the step in which
the draw ends cannot be drawn and is not sorted.

Defined results: a null text has no features, weight 0, and is drawn only if ``least_words`` is 0; a
row without id takes the noise of the empty id and comes after all ids of its score; rows of one id
and score are ranked by their features, equal rows in no order; empty tables have no
counts. Words are lower-cased for A-Z and are runs of ASCII letters, digits and other characters than ASCII.
Other columns are not read.
"""

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia.llm import radix
from affinia.llm.arrays import ALPHANUMERIC, slices, words
from affinia.sources.workspace import written

RUN = 1
BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
DRAW_PERCENT = 10
STEP = 64  # of scores that are counted together; scores span some 10^5

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _features(data: np.ndarray, offsets: np.ndarray, run: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document and bucket of every feature, and the number of words of every document."""
    starts, ends, before = words(data, offsets, ALPHANUMERIC)
    counts = np.diff(before)
    owner = np.repeat(np.arange(len(counts)), counts)
    letters = _LOWER[data[ALPHANUMERIC[data]]]
    limits = np.r_[0, np.cumsum(ends - starts)].astype(np.int64)
    single = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(limits), pa.py_buffer(letters)]
    )
    docs, found = [], []
    for size in range(1, min(run, len(single)) + 1):
        n = len(single) - size + 1
        parts = [single.slice(i, n) for i in range(size)]
        runs = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary())) if size > 1 else single
        whole = owner[:n] == owner[size - 1 :]
        coded = runs.dictionary_encode()
        crc = np.fromiter((zlib.crc32(x) for x in coded.dictionary.to_pylist()), np.int64)
        docs.append(owner[:n][whole])
        found.append((crc % buckets)[coded.indices.to_numpy()[whole]])
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), counts
    return np.concatenate(docs), np.concatenate(found), counts


def _count(batches: Iterator[pa.RecordBatch], run: int, buckets: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(buckets, np.int64)
    for _, data, offsets in slices(batches):
        total += np.bincount(_features(data, offsets, run, buckets)[1], minlength=buckets)
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])


def bucket_counts(texts: DataFrame, run: int = RUN, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket."""
    counts = texts.select("text").mapInArrow(partial(_count, run=run, buckets=buckets), "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for row in counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row a bucket
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of the ratio of smoothed shares, rounded down."""
    n = len(source)
    above = (target + 1.0) * float(source.sum() + n)
    below = (source + 1.0) * float(target.sum() + n)
    return np.floor(1000 * np.log(above / below)).astype(np.int64)


_WEIGHED = "doc_id long, n_words long, n_features long, weight long"


def _weigh(batches: Iterator[pa.RecordBatch], gain: np.ndarray, run: int) -> Iterator[pa.RecordBatch]:
    for rows, data, offsets in slices(batches):
        docs, buckets, counts = _features(data, offsets, run, len(gain))
        n = np.bincount(docs, minlength=len(counts))
        sums = np.zeros(len(counts), np.int64)
        np.add.at(sums, docs, gain[buckets])
        weight = sums // np.maximum(n, 1)
        columns = [rows.column("doc_id"), pa.array(counts.astype(np.int64)), pa.array(n), pa.array(weight)]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight"])


def weighed(docs: DataFrame, gain: np.ndarray, run: int = RUN) -> DataFrame:
    """Rows (doc_id, n_words, n_features, weight)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(partial(_weigh, gain=gain, run=run), _WEIGHED)


def noise(doc_id: Column, seed: int) -> Column:
    """Thousandths of Gumbel noise, from a hash of the id, rounded down."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    run: int = RUN,
    buckets: int = BUCKETS,
    seed: int = SEED,
    least_words: int = LEAST_WORDS,
    draw_percent: int = DRAW_PERCENT,
) -> DataFrame:
    """Rows (doc_id, n_words, n_features, weight, score, rank); the rank is null if not drawn."""
    gain = gains(bucket_counts(docs, run, buckets), bucket_counts(target, run, buckets))
    score = (F.col("weight") + noise(F.col("doc_id"), seed)).alias("score")
    rows = written(weighed(docs, gain, run).select("*", score), "scored")
    may = F.col("n_words") >= least_words
    steps = rows.where(may).groupBy(F.floor(F.col("score") / STEP).alias("step")).agg(F.count("*").alias("n"))
    steps = sorted(((row["step"], row["n"]) for row in steps.collect()), reverse=True)  # one row a step
    draw = sum(n for _, n in steps) * draw_percent // 100
    least, above = None, 0
    for step, n in steps:
        if above < draw:
            least = step * STEP
        above += n
    none = F.lit(None).cast("long").alias("rank")
    if least is None:
        return rows.select("*", none)
    high = may & (F.col("score") >= least)
    last = F.col("doc_id").isNull().cast("long").alias("_last")
    known = F.coalesce("doc_id", F.lit(0)).alias("_known")
    order = [("score", True), ("_last", False), ("_known", False), ("n_features", False)]
    sorted_rows = radix.ranked(rows.where(high).select("*", last, known), order)
    rank = F.when(F.col(radix.PLACE) < draw, F.col(radix.PLACE) + 1).alias("rank")
    return sorted_rows.select(*rows.columns, rank).unionByName(rows.where(~high).select("*", none))


def drawn_documents(docs: DataFrame, target: DataFrame, **how) -> DataFrame:
    """The drawn documents with all their columns; a row stays if its id was drawn.

    Rows of one id are drawn with it, rows without id never are.
    """
    found = resample(docs, target, **how).where("rank IS NOT NULL AND doc_id IS NOT NULL")
    ids = found.select(F.col("doc_id").alias("_drawn")).distinct()
    return docs.join(ids, F.col("doc_id").cast("long") == F.col("_drawn"), "left_semi")
