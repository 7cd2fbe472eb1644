"""Toxic passages by maximum-scoring segment search over token log-odds.

1. For every token and for its beginnings (``PREFIXES``): in how many documents of
   each label it occurs, and for those that matter how often in the whole corpus. The two label counts
   are compared as log-odds with a Dirichlet prior that is proportional to the
   corpus counts. A word takes the log-odds of the longest form whose counts
   deviate by ``LEAST_DEVIANCE`` from those of equal shares, so inflected and
   compound forms score by their stem; without such a form it scores zero.
2. A drift is taken from every token, so that ordinary text has a
   negative expected score. One linear scan (Ruzzo and Tompa) finds all
   disjoint maximal segments of a document.
3. Segment scores follow an extreme-value law (Karlin and Altschul): lambda solves
   the equation for tokens of clean documents, K is fitted on their best segments. The sum statistic of
   the best segments of a document gives its evidence, and a
   logistic curve of the evidence its probability.

Tokens are counted by their 64-bit hash. Only those whose label counts deviate are
collected, so the model is bounded by the label sample. Corpus counts
cover all documents. Labels are learned from at most ``sample_rows`` labelled rows.

Defined results: a null or empty text has no token, no passage and the score
of no evidence; without a label of each kind nothing is evidence and
every score is the share of label 1 (0.0 without labels); repeated rows are
scored alike; other columns are not read.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from math import lgamma, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia.llm.arrays import ALPHANUMERIC, U64, distinct_sorted, mix, slices, span_hashes, words
from affinia.llm.labelled import in_fold, label_sample, labelled_texts

FOLDS, HELD_OUT = 5, 0
SAMPLE_ROWS = 30_000
FILTER_BITS = 18  # of a hash; most tokens are known by them not to be in the model
PRIOR = 20.0  # documents of each label that the prior is worth
LEAST_PRIOR = 0.5  # documents, of each token
LEAST_DEVIANCE = 25.0  # of the likelihood ratio test, as for five standard deviations
PREFIXES = (8, 6, 5, 4)  # bytes
DRIFT = 0.1
SATURATED = 60.0  # more evidence does not change the probability
EULER = 0.5772156649015329

_SCORED = (
    "doc_id long, score double, evidence double, "
    "passages array<struct<start:long, end:long, e_value:double>>"
)


@dataclass(frozen=True)
class Model:
    tokens: np.ndarray  # hashes of the significant tokens, ascending
    odds: np.ndarray  # their log-odds
    drift: float
    rate: float  # lambda
    log_k: float
    intercept: float
    slope: float


def _tokens(data: np.ndarray, offsets: np.ndarray):
    starts, ends, before = words(data, offsets, ALPHANUMERIC)
    forms = [span_hashes(data, starts, ends, lower=True)]
    for level, length in enumerate(PREFIXES, 1):
        prefix = span_hashes(data, starts, np.minimum(ends, starts + length), lower=True)
        forms.append(mix(prefix + U64(level)))
    return starts, ends, before, forms


def _finder(tokens: np.ndarray):
    """A function from hashes to the positions of those among ``tokens``, and their places there."""
    shift = U64(64 - FILTER_BITS)
    may_be = np.zeros(1 << FILTER_BITS, bool)
    may_be[(tokens >> shift).astype(np.int32)] = True

    def find(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(may_be[(hashes >> shift).astype(np.int32)])
        place = np.searchsorted(tokens, hashes[at])
        known = place < len(tokens)
        known[known] = tokens[place[known]] == hashes[at[known]]
        return at[known], place[known]

    return find


def _token_scores(forms: list[np.ndarray], model: "Model", find) -> np.ndarray:
    scores = np.zeros(len(forms[0]))
    for form in forms:
        at, place = find(form)
        new = scores[at] == 0
        scores[at[new]] = model.odds[place[new]]
    return scores - model.drift


def _count_labels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each token of a slice the documents of label 0 and 1."""
    for part, data, offsets in slices(batches):
        _, _, before, forms = _tokens(data, offsets)
        seen = [
            distinct_sorted(np.concatenate([x[begin:end] for x in forms]))
            for begin, end in zip(before[:-1], before[1:])
        ]
        labels = np.repeat(part.column("label").to_numpy(), [len(x) for x in seen])
        tokens, which = np.unique(np.concatenate(seen), return_inverse=True)
        counts = [np.bincount(which[labels == label], minlength=len(tokens)) for label in (0, 1)]
        columns = [pa.array(tokens.view(np.int64)), *(pa.array(n, pa.int64()) for n in counts)]
        yield pa.RecordBatch.from_arrays(columns, names=["token", "n0", "n1"])


def _deviance(clean: int, toxic: int) -> Column:
    """Likelihood ratio of the label counts n0 and n1 against equal shares."""
    share = toxic / (toxic + clean)
    part = lambda n, usual: F.when(F.col(n) > 0, F.col(n) * F.log(F.col(n) / usual)).otherwise(0.0)
    both = F.col("n0") + F.col("n1")
    return 2 * (part("n1", both * share) + part("n0", both * (1 - share)))


def _count_corpus(tokens: np.ndarray):
    """How often each of the tokens occurs in the documents of one task, and last all forms of all tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, counts = _finder(tokens), np.zeros(len(tokens) + 1, np.int64)
        for _, data, offsets in slices(batches):
            for form in _tokens(data, offsets)[3]:
                counts[:-1] += np.bincount(find(form)[1], minlength=len(tokens))
                counts[-1] += len(form)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["place", "n"])

    return run


def _log_odds(n: np.ndarray, n0: np.ndarray, n1: np.ndarray, total: int, clean: int, toxic: int) -> np.ndarray:
    prior = np.maximum(PRIOR * n / max(total, 1), LEAST_PRIOR)
    return np.log((n1 + prior) / (toxic + PRIOR)) - np.log((n0 + prior) / (clean + PRIOR))


def _significant(docs: DataFrame, known: DataFrame, clean: int, toxic: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes, ascending, and log-odds of the tokens whose label counts deviate."""
    counted = known.mapInArrow(_count_labels, "token long, n0 long, n1 long")
    counted = counted.groupBy("token").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    found = counted.where(_deviance(clean, toxic) >= LEAST_DEVIANCE).toArrow()
    tokens = found.column("token").to_numpy().view(U64)
    order = np.argsort(tokens)
    tokens = tokens[order]
    n0, n1 = (found.column(name).to_numpy()[order].astype(float) for name in ("n0", "n1"))
    in_corpus = docs.select("text").mapInArrow(_count_corpus(tokens), "place long, n long")
    in_corpus = in_corpus.groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    n = np.zeros(len(tokens) + 1)
    n[in_corpus.column("place").to_numpy()] = in_corpus.column("n").to_numpy()
    return tokens, _log_odds(n[:-1], n0, n1, n[-1], clean, toxic)


def _rate(scores: np.ndarray, frequencies: np.ndarray) -> float:
    """The positive root of sum(p * exp(rate * score)) = 1; the mean score is negative."""
    low, high = 0.0, 1.0
    value = lambda x: float(frequencies @ np.exp(np.minimum(x * scores, 500.0))) - 1
    while value(high) < 0 and high < 1e6:
        low, high = high, 2 * high
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if value(middle) < 0 else (low, middle)
    return (low + high) / 2


def maximal_segments(before: np.ndarray, after: np.ndarray) -> list[tuple[int, int]]:
    """All maximal scoring segments, as first and last index of runs.

    ``before`` and ``after`` are the cumulative scores at both ends of each run
    of positive tokens. Linear time: a segment remembers the nearest
    earlier one that starts lower.
    """
    low: list[float] = []
    high: list[float] = []
    first: list[int] = []
    last: list[int] = []
    lower: list[int] = []
    for i in range(len(before)):
        start, end, begin, j = before[i], after[i], i, len(low) - 1
        while True:
            while j >= 0 and low[j] >= start:
                j = lower[j]
            if j < 0 or high[j] >= end:
                break
            start, begin, k = low[j], first[j], lower[j]
            del low[j:], high[j:], first[j:], last[j:], lower[j:]
            j = k
        low.append(start), high.append(end), first.append(begin), last.append(i), lower.append(j)
    return list(zip(first, last))


def _evidence(normal: np.ndarray) -> float:
    """Karlin-Altschul sum statistic: best -log p over the top r segments."""
    best, total = 0.0, 0.0
    for r, x in enumerate(np.sort(normal[normal > 0])[::-1], 1):
        total += x
        least = total - (r - 1) * log(max(total, 1.0)) + lgamma(r + 1) + lgamma(r)
        best = max(best, least - (r - 1) * log(2))
    return best


def _segments(data, offsets, model: Model, find):
    """For each document: token count, and its segments as (byte start, byte end, score)."""
    starts, ends, before, forms = _tokens(data, offsets)
    scores = _token_scores(forms, model, find)
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    positive = scores > 0
    edge = np.zeros(len(scores) + 1, bool)
    edge[before] = True
    opens = np.flatnonzero(positive & (edge[:-1] | ~np.concatenate([[False], positive[:-1]])))
    closes = np.flatnonzero(positive & (edge[1:] | ~np.concatenate([positive[1:], [False]]))) + 1
    runs = np.searchsorted(opens, before)
    for begin, end, count in zip(runs[:-1], runs[1:], np.diff(before)):
        found = []
        if begin < end:
            o, c = opens[begin:end], closes[begin:end]
            for first, last in maximal_segments(sums[o].tolist(), sums[c].tolist()):
                found.append((starts[o[first]], ends[c[last] - 1], sums[c[last]] - sums[o[first]]))
        yield int(count), found


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _finder(model.tokens)
        for part, data, offsets in slices(batches):
            evidence, passages = [], []
            for row, (count, found) in enumerate(_segments(data, offsets, model, find)):
                raw = np.array([score for _, _, score in found])
                normal = model.rate * raw - model.log_k - log(max(count, 1))
                evidence.append(_evidence(normal))
                text = data[offsets[row] : offsets[row + 1]]
                passages.append(_in_characters(text, offsets[row], found, normal))
            x = np.array(evidence)
            score = 1 / (1 + np.exp(-(model.intercept + model.slope * np.minimum(x, SATURATED))))
            columns = [part.column("doc_id"), pa.array(score), pa.array(x)]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("e_value", pa.float64())]))
            columns.append(pa.array(passages, kind))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "evidence", "passages"])

    return run


def _in_characters(text: np.ndarray, offset: int, found: list, normal: np.ndarray) -> list[dict]:
    """Segments that are significant, in code points."""
    out = []
    for (start, end, _), x in zip(found, normal):
        if x > 0:
            lead = int(np.count_nonzero((text[: start - offset] & 0xC0) != 0x80))
            inside = int(np.count_nonzero((text[start - offset : end - offset] & 0xC0) != 0x80))
            out.append({"start": lead, "end": lead + inside, "e_value": float(np.exp(-x))})
    return out


def _score_histogram(model: Model):
    """How often each token score occurs, to a hundredth; the model has no drift yet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, counts = _finder(model.tokens), {}
        for _, data, offsets in slices(batches):
            forms = _tokens(data, offsets)[3]
            scores, n = np.unique(np.round(_token_scores(forms, model, find), 2), return_counts=True)
            for x, y in zip(scores.tolist(), n.tolist()):
                counts[x] = counts.get(x, 0) + y
        columns = [pa.array(list(counts), pa.float64()), pa.array(list(counts.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["score", "n"])

    return run


def _per_label(model: Model, value):
    """Rows (doc_id, label, value) of labelled documents; ``value`` takes the token count and all segment scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = _finder(model.tokens)
        for part, data, offsets in slices(batches):
            found = [
                value(count, np.array([score for _, _, score in segments]))
                for count, segments in _segments(data, offsets, model, find)
            ]
            columns = [part.column("doc_id"), part.column("label"), pa.array(found, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "label", "value"])

    return run


def _labelled_values(known: DataFrame, model: Model, value) -> tuple[np.ndarray, np.ndarray]:
    """Labels and values. Repeated rows count once, so no more rows come back than the sample has."""
    found = known.mapInArrow(_per_label(model, value), "doc_id long, label int, value double")
    found = found.groupBy("doc_id").agg(F.max(F.struct("label", "value")).alias("x")).select("x.*").toArrow()
    return found.column("label").to_numpy(), found.column("value").to_numpy(zero_copy_only=False).astype(float)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Intercept and slope by Newton steps with a small ridge; the slope is not negative."""
    beta, design = np.zeros(2), np.column_stack([np.ones(len(x)), x])
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ beta))
        ridge = np.diag([1e-6, 1e-3])
        hessian = design.T @ (design * (p * (1 - p))[:, None]) + ridge
        step = np.linalg.solve(hessian, design.T @ (y - p) - ridge @ beta)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), max(0.0, float(beta[1]))


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Token scores from all documents and a bounded sample of labels, then the calibration."""
    sample = label_sample(labels, "toxic", FOLDS, HELD_OUT, sample_rows)
    known = labelled_texts(docs, sample)
    sizes = {row["label"]: row["count"] for row in known.groupBy("label").count().collect()}
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not clean or not toxic:
        share = 1.0 if toxic else 0.0
        return Model(np.zeros(0, U64), np.zeros(0), DRIFT, 1.0, 0.0, 700.0 if share else -700.0, 0.0)
    tokens, odds = _significant(docs, known, clean, toxic)
    model = Model(tokens, odds, 0.0, 1.0, 0.0, 0.0, 0.0)
    usual = known.where("label = 0").mapInArrow(_score_histogram(model), "score double, n long")
    usual = usual.groupBy("score").agg(F.sum("n").alias("n")).toArrow()
    scores, n = usual.column("score").to_numpy(), usual.column("n").to_numpy()
    frequencies = n / max(n.sum(), 1)
    drift = DRIFT + max(0.0, float(frequencies @ scores))
    rate = _rate(scores - drift, frequencies) if (scores > drift).any() else 1.0
    model = Model(tokens, odds, drift, rate, 0.0, 0.0, 0.0)
    # The location of the best segment's score among clean documents, then the evidence of all segments.
    label, top = _labelled_values(
        known, model, lambda count, raw: rate * raw.max() - log(max(count, 1)) if len(raw) else None
    )
    usual = top[(label == 0) & ~np.isnan(top)]
    log_k = float(np.median(usual)) + log(log(2)) if len(usual) else -EULER
    label, x = _labelled_values(
        known, model, lambda count, raw: min(_evidence(rate * raw - log_k - log(max(count, 1))), SATURATED)
    )
    intercept, slope = _logistic(x, label.astype(float))
    return Model(tokens, odds, drift, rate, log_k, intercept, slope)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Columns doc_id, score, evidence, and the significant passages in code points."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_score(model), _SCORED)


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted to be toxic, all columns kept.

    Rows are judged where they are, so there is no join and ids do not matter. Null and empty texts
    have no evidence and stay, unless all labels are toxic; repeated rows stay or go together.
    """
    model = fit(docs, labels)
    judge = _score(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, _ in slices(batches):
            scores = next(judge(iter([part]))).column("score").to_numpy()
            yield part.filter(pa.array(scores < 0.5))

    return docs.mapInArrow(run, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document with held_out, score, predicted, evidence and passages."""
    scored = score(docs, fit(docs, labels))
    return scored.select(
        "doc_id",
        in_fold("doc_id", FOLDS, HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "evidence",
        "passages",
    )
