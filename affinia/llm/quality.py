"""Quality of documents by a byte-level convolutional network.

A symbol is a byte, marked if its word is the same as the word before. Learned
filters of ``WIDTH`` symbols slide over the whole document; their positive
responses are averaged in overlapping chunks of ``CHUNK`` bytes, ``STRIDE`` apart. The
largest average of each filter over all chunks enters a logistic unit.
The first layer is a sum of one table row per symbol, so scoring is
lookups and additions.

The network is trained in numpy on a bounded sample of whole documents: in the order of a hash of
their ids, at most ``sample_rows`` of each label, and no more once these have ``sample_bytes``. How
long a document is does not decide whether it is taken, and every chunk of it takes part in the maximum. It learns
from equal shares of both labels; its intercept is then set to the shares of
all labels.

Defined results: a null or empty text is one chunk without symbols and gets the score
of no response; without labels of both kinds every score is the share of label 1
(0.5 without labels); repeated rows are scored alike; other columns are not
read.
"""

from collections.abc import Iterator
from dataclasses import dataclass, field
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia.llm.arrays import NOT_SPACE, slices, span_hashes, utf8, words
from affinia.llm.labelled import in_fold, label_sample, labelled_texts
from affinia.sources.workspace import written

FOLDS, HELD_OUT = 3, 1
SAMPLE_ROWS = 1_000
SAMPLE_BYTES = 16 << 20
CHUNK, STRIDE = 512, 256
WIDTH, FILTERS, EMBEDDED = 5, 16, 8
SYMBOLS, PAD = 513, 512
EPOCHS, BATCH, RATE, DECAY = 15, 64, 0.02, 1e-5
SLICE = 512 << 10  # bytes whose responses a task holds at once


@dataclass
class Network:
    embedding: np.ndarray
    filters: np.ndarray  # width, embedded, filters
    bias: np.ndarray
    output: np.ndarray
    intercept: float
    tables: np.ndarray = field(default=None)  # width, symbols, filters

    def tabulate(self) -> None:
        self.tables = np.einsum("se,jef->jsf", self.embedding, self.filters).astype(np.float32)


@dataclass
class Layout:
    """Documents laid out in blocks of STRIDE symbols; a chunk is two blocks, the last one of a document one."""

    symbols: np.ndarray
    blocks: np.ndarray  # first block of each document, and the number of all
    sizes: np.ndarray  # symbols of each chunk that are not padding


def layout(data: np.ndarray, offsets: np.ndarray) -> Layout:
    lengths = np.diff(offsets)
    blocks = np.concatenate([[0], np.cumsum(np.maximum(-(-lengths // STRIDE), 1))])
    symbols = np.full(blocks[-1] * STRIDE + WIDTH, PAD, np.uint16)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    place = blocks[doc] * STRIDE + np.arange(len(data)) - offsets[doc]
    symbols[place] = data.astype(np.uint16) + 256 * _repeated(data, offsets)
    real = np.add.reduceat(symbols[: blocks[-1] * STRIDE] != PAD, np.arange(0, blocks[-1] * STRIDE, STRIDE))
    return Layout(symbols, blocks, np.maximum(_chunk_sums(real.astype(np.int64), blocks), 1))


def _repeated(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each byte whether its word equals the word before in the document."""
    starts, ends, before = words(data, offsets, NOT_SPACE)
    same = np.zeros(len(data) + 1, np.int8)
    if len(starts):
        hashes = span_hashes(data, starts, ends)
        again = np.append(False, hashes[1:] == hashes[:-1])
        again[before[:-1][before[:-1] < len(starts)]] = False
        same[starts[again]] += 1
        same[ends[again]] -= 1
    return np.cumsum(same[:-1]).astype(np.uint16)


def _chunk_sums(by_block: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    sums = by_block.copy()
    sums[:-1] += by_block[1:]
    last = blocks[1:] - 1
    sums[last] = by_block[last]
    return sums


def _responses(network: Network, symbols: np.ndarray) -> np.ndarray:
    n = len(symbols) - WIDTH
    out = network.tables[0][symbols[:n]]
    for j in range(1, WIDTH):
        out += network.tables[j][symbols[j : n + j]]
    out += network.bias.astype(np.float32)
    return np.maximum(out, 0, out=out)


def _chunks(network: Network, laid: Layout) -> np.ndarray:
    """Mean response of each chunk."""
    sums = []
    step = SLICE // STRIDE
    for block in range(0, int(laid.blocks[-1]), step):
        end = min(block + step, int(laid.blocks[-1]))
        found = _responses(network, laid.symbols[block * STRIDE : end * STRIDE + WIDTH])
        found[laid.symbols[block * STRIDE : end * STRIDE] == PAD] = 0
        sums.append(found.reshape(-1, STRIDE, found.shape[1]).sum(axis=1))
    return _chunk_sums(np.concatenate(sums), laid.blocks) / laid.sizes[:, None]


def probabilities(network: Network, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    laid = layout(data, offsets)
    means = _chunks(network, laid)
    pooled = np.maximum.reduceat(means, laid.blocks[:-1], axis=0)
    return 1 / (1 + np.exp(-np.clip(pooled @ network.output + network.intercept, -700, 700)))


def _gradients(network: Network, laid: Layout, labels: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean log loss; only the chunk that wins a filter's maximum counts."""
    means = _chunks(network, laid)
    docs = len(labels)
    winners = np.empty((docs, FILTERS), np.int64)
    for d in range(docs):
        a, b = laid.blocks[d], laid.blocks[d + 1]
        winners[d] = a + np.argmax(means[a:b], axis=0)
    pooled = np.take_along_axis(means, winners, axis=0)
    p = 1 / (1 + np.exp(-(pooled @ network.output + network.intercept)))
    error = (p - labels) / docs
    d_pooled = error[:, None] * network.output / laid.sizes[winners]
    ends = np.minimum(winners * STRIDE + CHUNK, laid.blocks[1:, None] * STRIDE)
    d_tables = np.zeros((WIDTH, SYMBOLS, FILTERS))
    d_bias = np.zeros(FILTERS)
    span = np.arange(CHUNK)
    for f in range(FILTERS):
        at = winners[:, f, None] * STRIDE + span
        inside = at < ends[:, f, None]
        at = np.where(inside, at, 0)
        responses = sum(network.tables[j, :, f][laid.symbols[at + j]] for j in range(WIDTH)) + network.bias[f]
        inside &= (responses > 0) & (laid.symbols[at] != PAD)
        at, weight = at[inside], np.broadcast_to(d_pooled[:, f, None], inside.shape)[inside]
        d_bias[f] = weight.sum()
        for j in range(WIDTH):
            d_tables[j, :, f] = np.bincount(laid.symbols[at + j], weight, SYMBOLS)
    d_tables[:, PAD] = 0
    d_embedding = np.einsum("jsf,jef->se", d_tables, network.filters)
    d_filters = np.einsum("se,jsf->jef", network.embedding, d_tables)
    return [d_embedding, d_filters, d_bias, pooled.T @ error, np.array([error.sum()])]


def train(texts: list[str], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 17) -> Network:
    """Adam over shuffled batches, the same for the same texts in the same order."""
    rng = np.random.default_rng(seed)
    values = [
        rng.normal(0, 0.5, (SYMBOLS, EMBEDDED)),
        rng.normal(0, 0.5, (WIDTH, EMBEDDED, FILTERS)),
        np.full(FILTERS, -0.5),
        rng.normal(0, 1.0, FILTERS),
        np.zeros(1),
    ]
    values[0][PAD] = 0
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    laid_out = [utf8(pa.array([text], pa.string())) for text in texts]
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        for begin in range(0, len(order), BATCH):
            rows = order[begin : begin + BATCH]
            data = np.concatenate([laid_out[i][0] for i in rows])
            offsets = np.concatenate([[0], np.cumsum([len(laid_out[i][0]) for i in rows])])
            network = Network(*values[:4], float(values[4][0]))
            network.tabulate()
            slopes = _gradients(network, layout(data, offsets), labels[rows])
            step += 1
            rate = RATE * (1 - epoch / epochs)
            for i, (value, slope) in enumerate(zip(values, slopes)):
                slope = slope + DECAY * value
                first[i] = 0.9 * first[i] + 0.1 * slope
                second[i] = 0.999 * second[i] + 0.001 * slope**2
                change = first[i] / (1 - 0.9**step) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
                values[i] = value - rate * change
            values[0][PAD] = 0
    network = Network(*values[:4], float(values[4][0]))
    network.tabulate()
    return network


def _constant(share: float) -> Network:
    network = Network(
        np.zeros((SYMBOLS, EMBEDDED)),
        np.zeros((WIDTH, EMBEDDED, FILTERS)),
        np.zeros(FILTERS),
        np.zeros(FILTERS),
        log(max(share, 1e-300) / max(1 - share, 1e-300)),
    )
    network.tabulate()
    return network


def fit(
    docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_bytes: int = SAMPLE_BYTES
) -> Network:
    """A network for ``labels.quality`` from a bounded sample outside the held-out fold."""
    texts, marks, shares = [], [], {0: 0, 1: 0}
    known = labels.where(~in_fold("doc_id", FOLDS, HELD_OUT))
    for row in known.groupBy(F.col("quality").cast("int").alias("q")).count().collect():
        if row["q"] in shares:
            shares[row["q"]] = row["count"]
    order = (F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"))
    for label in (0, 1):
        sample = label_sample(labels.where(F.col("quality") == label), "quality", FOLDS, HELD_OUT, sample_rows)
        rows = labelled_texts(docs, sample).where("text <> ''").select("doc_id", "text")
        rows = written(rows.orderBy(*order).limit(sample_rows), "sample")
        sizes = [row["n"] for row in rows.orderBy(*order).select(F.octet_length("text").alias("n")).collect()]
        taken = int(np.searchsorted(np.cumsum(sizes) - sizes, sample_bytes)) if sizes else 0
        rows = rows.orderBy(*order).limit(taken).toArrow()
        texts += rows.column("text").to_pylist()
        marks += [label] * rows.num_rows
    share = (shares[1] / sum(shares.values())) if sum(shares.values()) else 0.5
    if len(set(marks)) < 2:
        return _constant(share)
    network = train(texts, np.array(marks, float))
    balanced = marks.count(1) / marks.count(0)
    network.intercept += log(max(shares[1], 1) / max(shares[0], 1)) - log(balanced)
    return network


def _score(network: Network):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches, limit=SLICE):
            found = pa.array(probabilities(network, data, offsets).astype(np.float64))
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), found], names=["doc_id", "score"])

    return run


def score(docs: DataFrame, network: Network) -> DataFrame:
    """Columns doc_id and score, the probability of label 1."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_score(network), "doc_id long, score double")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document with held_out, score and predicted."""
    scored = score(docs, fit(docs, labels))
    return scored.select(
        "doc_id",
        in_fold("doc_id", FOLDS, HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
