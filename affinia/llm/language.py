"""Language of documents by rank-order profiles of character n-grams.

A profile is the ranking of the most frequent n-grams of one to three characters.
Profiles of languages come from all documents to learn from; a document's own profile is
compared with each by out-of-place distance: by how many ranks every n-gram of the
document is displaced, or ``PROFILE`` if the language's profile lacks it. The
nearest language wins, and the first by name among equals.

Texts are lower-cased; runs of other characters than letters become one space, and
each text begins and ends with one. N-grams are packed into 63 bits, so counts are exact.
Tasks count n-grams of each language before the shuffle; only profiles, at most
``PROFILE`` rows for each language, reach the driver and the tasks. A document is compared with the languages that
have one of its n-grams, through lists of these, so the work does not grow with languages that share none.

Defined results: a text that is null, empty or without a letter has ``und`` and score 0;
without anything to learn from, every text has; repeated rows are judged
alike; a null language is not learned from; other columns are not read.
"""

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinia.llm.arrays import slices
from affinia.llm.labelled import in_fold

FOLDS, HELD_OUT = 5, 0
PROFILE = 400
_HELD_GRAMS = 1 << 20  # counters of a task before it sends them on
_SPACE = 32
_SHIFT = 21


@cache
def _letters() -> np.ndarray:
    return np.array([chr(code).isalpha() for code in range(0x110000)])


def _ranked(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a normalised text, ascending, and how often each occurs."""
    one = codes[codes != _SPACE].astype(np.int64)
    wide = codes.astype(np.int64)
    two = (wide[:-1] << _SHIFT) | wide[1:]
    three = (two[:-1] << _SHIFT) | wide[2:]
    grams = np.sort(np.concatenate([one, two, three]))
    first = np.flatnonzero(np.append(True, grams[1:] != grams[:-1]))
    return grams[first], np.diff(np.append(first, len(grams)))


def _normalised(text: str | None) -> np.ndarray | None:
    """Code points with single spaces for all that is no letter; None without letters."""
    if not text:
        return None
    codes = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return None
    padded = np.full(len(codes) + 2, _SPACE, np.uint32)
    padded[1:-1] = np.where(letter, codes, _SPACE)
    keep = np.ones(len(padded), bool)
    keep[1:] = (padded[1:] != _SPACE) | (padded[:-1] != _SPACE)
    return padded[keep]


def _sum(grams: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    flat, n = np.concatenate(grams), np.concatenate(counts)
    order = np.argsort(flat)
    flat, n = flat[order], n[order]
    first = np.flatnonzero(np.append(True, flat[1:] != flat[:-1]))
    return flat[first], np.add.reduceat(n, first)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, tuple[list, list]] = {}

    def send(language: str) -> pa.RecordBatch:
        grams, counts = _sum(*held.pop(language))
        columns = [pa.array([language] * len(grams), pa.string()), pa.array(grams), pa.array(counts)]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "gram", "n"])

    for rows, _, _ in slices(batches):
        for language, text in zip(rows.column("lang").to_pylist(), rows.column("text").to_pylist()):
            codes = _normalised(text)
            if codes is not None:
                grams, counts = held.setdefault(language, ([], []))
                for part, new in zip((grams, counts), _ranked(codes)):
                    part.append(new)
        for language, (grams, counts) in list(held.items()):
            held[language] = tuple([x] for x in _sum(grams, counts))
            if len(held[language][0][0]) > _HELD_GRAMS:
                yield send(language)
    for language in list(held):
        yield send(language)


def profiles(docs: DataFrame, size: int = PROFILE) -> DataFrame:
    """Rows (lang, gram, rank) of the most frequent n-grams of each language, the first with rank 0."""
    rows = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text")
    counted = rows.mapInArrow(_count, "lang string, gram long, n long")
    counted = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # A filter on the number itself lets every task drop all but so many before the shuffle.
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    first = counted.withColumn("number", F.row_number().over(order)).where(F.col("number") <= size)
    return first.select("lang", "gram", (F.col("number") - 1).alias("rank"))


def _predict(languages: list[str], grams: np.ndarray, starts: np.ndarray, holders: np.ndarray, ranks: np.ndarray, size: int):
    """For each n-gram of any profile, ``holders`` from ``starts`` on are the languages that have it, at ``ranks``."""

    def nearest(codes: np.ndarray | None) -> tuple[str, float]:
        if codes is None or not languages:
            return "und", 0.0
        own, counts = _ranked(codes)
        top = np.lexsort((own, -counts))[:size]
        place = np.minimum(np.searchsorted(grams, own[top]), len(grams) - 1)
        known = np.flatnonzero(grams[place] == own[top])
        begin, n = starts[place[known]], np.diff(starts)[place[known]]
        at = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())
        moved = np.minimum(np.abs(ranks[at] - np.repeat(known, n)), size)
        # Every n-gram is ``size`` away from a language, but for those that have it.
        nearer = np.bincount(holders[at], size - moved, len(languages)).astype(np.int64)
        distances = size * len(top) - nearer
        best = int(np.argmin(distances))
        if len(languages) == 1:
            return languages[0], 1.0
        second = np.partition(distances, 1)[1]
        return languages[best], float(second / max(second + distances[best], 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, _, _ in slices(batches):
            found = [nearest(_normalised(text)) for text in rows.column("text").to_pylist()]
            columns = [
                rows.column("doc_id"),
                pa.array([x for x, _ in found], pa.string()),
                pa.array([y for _, y in found], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score"])

    return run


def predict(docs: DataFrame, profile: DataFrame, size: int = PROFILE) -> DataFrame:
    """Columns doc_id, lang_pred and score, the share of the second distance in the two least."""
    found = profile.toArrow()
    languages = sorted(set(found.column("lang").to_pylist()))
    grams = np.unique(found.column("gram").to_numpy())
    place = np.searchsorted(grams, found.column("gram").to_numpy())
    order = np.argsort(place, kind="stable")
    names = {name: i for i, name in enumerate(languages)}
    holders = np.array([names[x] for x in found.column("lang").to_pylist()], np.int64)[order]
    ranks = found.column("rank").to_numpy().astype(np.int64)[order]
    starts = np.searchsorted(place[order], np.arange(len(grams) + 1))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, lang_pred string, score double"
    return rows.mapInArrow(_predict(languages, grams, starts, holders, ranks, size), schema)


def language(docs: DataFrame, size: int = PROFILE) -> DataFrame:
    """Every document with held_out, lang_pred and score."""
    known = docs.where("doc_id IS NOT NULL").where(~in_fold("doc_id", FOLDS, HELD_OUT))
    found = predict(docs, profiles(known, size), size)
    held = in_fold("doc_id", FOLDS, HELD_OUT).alias("held_out")
    return found.select("doc_id", held, "lang_pred", "score")
