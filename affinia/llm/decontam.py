"""Benchmark decontamination with suffix arrays over shards of the training text.

Words get the numbers of the benchmark's vocabulary; all others are 0 and end
every match. A shard is a slice of documents. Its suffix array holds the word
positions at which a match can start at all: those followed by enough known
words inside the document. The array is sorted by the first words of each
suffix. Every benchmark suffix is searched in it by bisection, and each
occurrence is extended word by word to the longest verbatim match.

An item is matched in windows of ``WINDOW`` words; a shorter one matches as a
whole. The benchmark is dealt to numbered parts of about ``PART_BYTES`` of text, as a stored table. Each
part makes one pass, for which the driver and the tasks hold that part alone, and
no pass shuffles documents.

Defined results: a null or empty text has no words and no hits; an item without
words occurs nowhere; rows that repeat an item_id count as one item; repeated
documents are judged alike; a null item_id is left out. Other columns are
not read.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia.llm.arrays import ALPHANUMERIC, slices, span_hashes, utf8, words
from affinia.sources.workspace import written

WINDOW = 10
PART_BYTES = 32 << 20

_MATCHES = "array<struct<item_id:string, item_word:int, word:int, length:int>>"
_SCHEMA = f"doc_id long, text string, n_words long, matches {_MATCHES}"
_MATCH_TYPE = pa.list_(
    pa.struct(
        [("item_id", pa.string()), ("item_word", pa.int32()), ("word", pa.int32()), ("length", pa.int32())]
    )
)


@dataclass(frozen=True)
class Part:
    """Benchmark items as numbered words, and the windows of all items in one order."""

    items: list[str]
    vocabulary: np.ndarray  # sorted word hashes; the number of a word is its place plus one
    tokens: np.ndarray  # all items, each followed by a zero
    of_item: np.ndarray  # item of each window
    at: np.ndarray  # where each window begins in ``tokens``
    begins: np.ndarray  # where each item begins in ``tokens``
    sizes: np.ndarray  # words of each window: WINDOW, or all words of a shorter item


def _part(rows: list[tuple[str, str]]) -> Part:
    data, offsets = utf8(pa.array([text for _, text in rows], pa.string()))
    starts, ends, before = words(data, offsets, ALPHANUMERIC)
    hashes = span_hashes(data, starts, ends, lower=True)
    vocabulary = np.unique(hashes)
    numbers = (np.searchsorted(vocabulary, hashes) + 1).astype(np.uint32)
    tokens, of_item, at, begins, sizes = [], [], [], [], []
    place = 0
    for item, (begin, end) in enumerate(zip(before[:-1], before[1:])):
        count = int(end - begin)
        tokens += [numbers[begin:end], np.zeros(1, np.uint32)]
        begins.append(place)
        size = min(count, WINDOW)
        windows = count - size + 1 if count else 0
        of_item.append(np.full(windows, item))
        at.append(place + np.arange(windows))
        sizes.append(np.full(windows, size))
        place += count + 1
    whole = lambda parts, kind: np.concatenate([np.zeros(0, kind), *parts]).astype(kind)
    return Part(
        [item for item, _ in rows],
        vocabulary,
        whole(tokens, np.uint32),
        whole(of_item, np.int64),
        whole(at, np.int64),
        np.array(begins, np.int64),
        whole(sizes, np.int64),
    )


def _keys(tokens: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """The first words of suffixes as byte strings that compare like the words."""
    columns = tokens[at[:, None] + np.arange(size)].astype(">u4")
    return np.ascontiguousarray(columns).view(f"V{4 * size}").ravel().view(f"S{4 * size}")


def _found(tokens: np.ndarray, runs: np.ndarray, part: Part) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Windows and the shard positions at which they occur."""
    for size in np.unique(part.sizes).tolist():
        positions = np.flatnonzero(runs >= size)
        if not len(positions):
            continue
        keys = _keys(tokens, positions, size)
        order = np.argsort(keys, kind="stable")
        suffixes, keys = positions[order], keys[order]
        windows = np.flatnonzero(part.sizes == size)
        wanted = _keys(part.tokens, part.at[windows], size)
        low = np.searchsorted(keys, wanted, "left")
        counts = np.searchsorted(keys, wanted, "right") - low
        hit = counts > 0
        low, counts, windows = low[hit], counts[hit], windows[hit]
        step = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        yield np.repeat(windows, counts), suffixes[np.repeat(low, counts) + step]


def _known_runs(tokens: np.ndarray) -> np.ndarray:
    """How many words in a row are known, from each position on."""
    unknown = np.flatnonzero(tokens == 0)
    following = np.searchsorted(unknown, np.arange(len(tokens)))
    return np.append(unknown, len(tokens))[following] - np.arange(len(tokens))


def _matches(data: np.ndarray, offsets: np.ndarray, part: Part):
    """For each document its word count and its maximal matches."""
    starts, ends, before = words(data, offsets, ALPHANUMERIC)
    hashes = span_hashes(data, starts, ends, lower=True)
    counts = np.diff(before)
    found: list[list[tuple]] = [[] for _ in counts]
    if not len(hashes) or not len(part.vocabulary):
        return counts, found
    place = np.minimum(np.searchsorted(part.vocabulary, hashes), len(part.vocabulary) - 1)
    numbers = np.where(part.vocabulary[place] == hashes, place + 1, 0).astype(np.uint32)
    of_doc = np.repeat(np.arange(len(counts)), counts)
    tokens = np.zeros(len(numbers) + len(counts) + 1, np.uint32)  # a zero after each document
    tokens[np.arange(len(numbers)) + of_doc] = numbers
    for windows, positions in _found(tokens, _known_runs(tokens), part):
        at = part.at[windows]
        # A match that begins one word earlier in both contains this one.
        first = (at == part.begins[part.of_item[windows]]) | (positions == 0)
        first |= part.tokens[at - 1] != tokens[positions - 1]
        windows, positions, at = windows[first], positions[first], at[first]
        length = part.sizes[windows].copy()
        going = np.arange(len(windows))
        while len(going):
            x, y = tokens[positions[going] + length[going]], part.tokens[at[going] + length[going]]
            going = going[(x == y) & (x != 0)]
            length[going] += 1
        item = part.of_item[windows]
        doc = np.searchsorted(before[1:] + np.arange(1, len(counts) + 1), positions, "right")
        word = positions - before[doc] - doc
        item_word = at - part.begins[item]
        for d, i, j, w, n in zip(doc.tolist(), item.tolist(), item_word.tolist(), word.tolist(), length.tolist()):
            found[d].append((part.items[i], j, w, n))
    return counts, found


def _judge(part: Part):
    """Rows with their word count and their matches, in place of the columns that the caller does not pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = ("item_id", "item_word", "word", "length")
        for rows, data, offsets in slices(batches):
            counts, found = _matches(data, offsets, part)
            lists = pa.array([[dict(zip(fields, x)) for x in new] for new in found], _MATCH_TYPE)
            columns = [rows.column("doc_id"), rows.column("text"), pa.array(counts, pa.int64()), lists]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text", "n_words", "matches"])

    return run


def _without_hits(part: Part):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches):
            _, found = _matches(data, offsets, part)
            yield rows.filter(pa.array([not x for x in found], pa.bool_()))

    return run


def _parts(benchmark: DataFrame, part_bytes: int | None) -> tuple[int, DataFrame]:
    """The items dealt to numbered parts of about the size given, as a stored table, and how many there are."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    items = items.where("item_id IS NOT NULL AND text IS NOT NULL")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    count = max(1, -(-size // (part_bytes or PART_BYTES)))
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(count)).cast("int")
    return count, written(items.dropDuplicates().withColumn("part", number), "benchmark-parts")


def _read_part(items: DataFrame, number: int) -> Part:
    """One part, which is all of the benchmark that the driver or a task ever holds."""
    rows = items.where(F.col("part") == number).select("item_id", "text").collect()
    return _part(sorted((row["item_id"], row["text"]) for row in rows))


def matches(docs: DataFrame, benchmark: DataFrame, part_bytes: int | None = None) -> DataFrame:
    """Columns doc_id, text, n_words, and the longest matches with all benchmark items.

    A match says which item, the first word in it, the first word in the
    document, and the number of words. Each part of the benchmark makes a pass over the documents, whose
    matches are stored before the next one.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    count, items = _parts(benchmark, part_bytes)
    if count == 1:
        return rows.mapInArrow(_judge(_read_part(items, 0)), _SCHEMA)
    key = [F.col("doc_id").alias("of"), F.xxhash64("text").alias("text_id")]
    passes = []
    for number in range(count):
        found = rows.mapInArrow(_judge(_read_part(items, number)), _SCHEMA).where(F.size("matches") > 0)
        # Rows that are repeated have the same matches.
        passes.append(written(found.select(*key, F.explode("matches").alias("match")).distinct(), "matches"))
    found = reduce(DataFrame.unionByName, passes).groupBy("of", "text_id").agg(F.collect_list("match").alias("matches"))
    found = written(found, "matches")
    counted = rows.mapInArrow(_judge(_part([])), _SCHEMA).withColumn("id", F.xxhash64("text")).drop("matches")
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("id") == F.col("text_id"))
    none = F.lit([]).cast(_MATCHES)
    return counted.join(found, same, "left").select(
        "doc_id", "text", "n_words", F.coalesce("matches", none).alias("matches")
    )


def decontamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: n_words, n_hit, n_items, items, contaminated, and its matches."""
    found = matches(docs, benchmark)
    # Words covered by any match: matches in order, each adds what lies past the end so far.
    spans = F.array_sort(F.transform("matches", lambda m: F.struct(m["word"], m["length"])))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    covered = F.aggregate(
        spans,
        start,
        lambda s, m: F.struct(
            F.greatest(s["end"], m["word"] + m["length"]).alias("end"),
            (s["n"] + F.greatest(m["word"] + m["length"] - F.greatest(s["end"], m["word"]), F.lit(0))).alias("n"),
        ),
        lambda s: s["n"],
    )
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item_id"])))
    rows = found.select("doc_id", "n_words", covered.alias("n_hit"), items.alias("items"), "matches")
    return rows.withColumn("contaminated", F.col("n_hit") > 0)


def clean_documents(docs: DataFrame, benchmark: DataFrame, part_bytes: int | None = None) -> DataFrame:
    """The documents without those that a benchmark item occurs in, all columns kept.

    Rows are judged where they are, so there is no join and ids do not matter. With several parts of the
    benchmark, what a pass leaves is stored for the next one. Documents without text stay; an empty
    benchmark leaves all.
    """
    count, items = _parts(benchmark, part_bytes)
    kept = docs
    for number in range(count):
        kept = kept.mapInArrow(_without_hits(_read_part(items, number)), docs.schema)
        kept = written(kept, "clean") if number < count - 1 else kept
    return kept
