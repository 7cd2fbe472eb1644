"""Alignment of two tokenizers' ids over the same text, and how often their ids meet.

Byte offsets where a token of each vocabulary ends cut a text into groups. They are found by divide
and conquer: take the first vocabulary's token end near the middle of an interval, bisect the other's
ends for it, go outwards until both agree, and do the same with both halves; an interval without
such an end is a group. All intervals of one depth are worked on together.

Tokens of one group are linked, all with all. An id pair is counted by the documents that
have it linked. Documents are gathered in blocks of ``BLOCK_BYTES``. A block holds each distinct run of
text (see ``tokens``) once, aligned, and its documents as lists of runs. Only the distinct pairs of a block
are shuffled to be counted, and their counts are brought back to the block, so the traffic does not
grow with how often a common pair occurs, and no task holds more than a block or one document.

Defined results: a text that is null or empty, or that one of the vocabularies does not give back
byte for byte, has no tokens. Repeated rows are counted each; the id of a row does not matter and may be
null. An empty table gives no rows. Other columns are not read.
"""

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinia.llm import tokens
from affinia.llm.arrays import list_column, slices
from affinia.sources.workspace import written

BLOCK_BYTES = 8 << 20
_SLICE_BYTES = 1 << 20  # of text that is aligned at once
_LARGE_GROUP = 4096  # links; larger groups are linked by distinct ids


def shared_cuts(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token of both lists whether a token of the other list ends with it.

    Ends rise, and both lists end at the same byte.
    """
    a_cut, b_cut = np.zeros(len(a_ends), bool), np.zeros(len(b_ends), bool)
    a_cut[-1:], b_cut[-1:] = True, True
    frontier = np.array([[0, len(a_ends), 0, len(b_ends)]], np.int64)
    while True:
        sizes = frontier[:, 1::2] - frontier[:, ::2]
        frontier = frontier[(sizes > 1).all(axis=1)]
        if not len(frontier):
            return a_cut, b_cut
        i, j = _middle_cuts(frontier, a_ends, b_ends)
        frontier, i, j = frontier[i >= 0], i[i >= 0], j[i >= 0]
        a_cut[i], b_cut[j] = True, True
        left = np.stack([frontier[:, 0], i + 1, frontier[:, 2], j + 1], axis=1)
        right = np.stack([i + 1, frontier[:, 1], j + 1, frontier[:, 3]], axis=1)
        frontier = np.concatenate([left, right])


def _middle_cuts(intervals: np.ndarray, a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both tokens that end at the shared end nearest to the middle of each interval, or -1."""
    low, high = intervals[:, 0], intervals[:, 1] - 2  # the last token's end is the interval's own
    middle = (low + high) // 2
    found_a, found_b = np.full(len(intervals), -1), np.full(len(intervals), -1)
    open_, near, width = np.arange(len(intervals)), 0, 1
    while len(open_):
        steps = np.repeat(np.arange(near, near + width), 2)
        steps[1::2] *= -1
        at = middle[open_, None] + steps
        inside = (at >= low[open_, None]) & (at <= high[open_, None])
        ends = a_ends[np.where(inside, at, 0)]
        other = np.searchsorted(b_ends, ends)
        hit = inside & (b_ends[other] == ends)
        first = hit.argmax(axis=1)
        row = np.flatnonzero(hit.any(axis=1))
        found_a[open_[row]], found_b[open_[row]] = at[row, first[row]], other[row, first[row]]
        near += width
        width *= 2
        reach = np.maximum(middle - low, high - middle)[open_]
        open_ = open_[(found_a[open_] < 0) & (reach >= near)]
    return found_a, found_b


def _pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a << 32 | b


def _links(a_ids, b_ids, a_group, b_group) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group, id pair and number of its links, for all groups."""
    groups = int(a_group[-1]) + 1 if len(a_group) else 0
    n_a, n_b = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
    small = n_a * n_b <= _LARGE_GROUP
    taken = np.flatnonzero(small[a_group]) if groups else np.zeros(0, np.int64)
    group = a_group[taken]
    b_start = np.cumsum(n_b) - n_b
    each = n_b[group]
    b_at = np.repeat(b_start[group] - (np.cumsum(each) - each), each) + np.arange(each.sum())
    out = [(np.repeat(group, each), _pairs(np.repeat(a_ids[taken], each), b_ids[b_at]), np.ones(len(b_at), np.int64))]
    for g in np.flatnonzero(~small):
        first = [np.searchsorted(x, [g, g + 1]) for x in (a_group, b_group)]
        a, times_a = np.unique(a_ids[slice(*first[0])], return_counts=True)
        b, times_b = np.unique(b_ids[slice(*first[1])], return_counts=True)
        found = _pairs(a[:, None], b[None, :]).ravel()
        out.append((np.full(len(found), g), found, (times_a[:, None] * times_b[None, :]).ravel()))
    group, pair, times = (np.concatenate(x) for x in zip(*out))
    if len(out) > 1:
        order = np.argsort(group, kind="stable")
        group, pair, times = group[order], pair[order], times[order]
    return group, pair, times


def _owned(starts: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(starts) - 1), np.diff(starts))


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of ``values[starts[i] : starts[i + 1]]``."""
    upto = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=upto[1:])
    return upto[starts[1:]] - upto[starts[:-1]]


class _Runs:
    """Distinct runs of a block, aligned: sizes, groups in writing, links."""

    def __init__(self, first, second):
        self.first, self.second = first, second
        self.code: dict[bytes, int] = {}
        self.sizes = np.zeros((0, 5), np.int64)  # tokens of both, groups, links, whether given back
        self.groups: list[str] = []
        self.pairs, self.order = np.zeros(0, np.int64), np.zeros(0, np.int64)  # id pairs as met, and sorted
        self.pair, self.times = np.zeros(0, np.int32), np.zeros(0, np.int64)  # of each link; pairs by number
        self.starts = np.zeros(1, np.int64)
        # Ids with what follows them inside a group and at its end.
        names = lambda v, end: np.array([f"{i}{end}" for i in range(len(v.pieces))], object)
        self._names = [names(first, ","), names(first, "|"), names(second, ","), names(second, ";")]

    def codes(self, found: list[bytes]) -> np.ndarray:
        """Numbers of runs; new ones are aligned first."""
        known = self.code
        new = [x for x in found if x not in known]
        if new:
            known.update(zip(new, range(len(known), len(known) + len(new))))
            self._align(new)
        return np.fromiter(map(known.__getitem__, found), np.int64, len(found))

    def _align(self, new: list[bytes]) -> None:
        (a, a_at), (b, b_at) = self.first.encode(new), self.second.encode(new)
        faithful = self._faithful(new, a, a_at, b, b_at)
        keep = np.flatnonzero(faithful)
        a, b = (tokens.gathered(x, at, keep).astype(np.int64) for x, at in ((a, a_at), (b, b_at)))
        n_a, n_b = np.where(faithful, np.diff(a_at), 0), np.where(faithful, np.diff(b_at), 0)
        a_run, b_run = np.repeat(np.arange(len(new)), n_a), np.repeat(np.arange(len(new)), n_b)
        a_cut, b_cut = shared_cuts(np.cumsum(self.first.lengths[a]), np.cumsum(self.second.lengths[b]))
        a_group, b_group = np.cumsum(a_cut) - a_cut, np.cumsum(b_cut) - b_cut
        run_of = a_run[a_cut]
        group, pair, times = _links(a, b, a_group, b_group)
        link_run = run_of[group]
        counted = partial(np.bincount, minlength=len(new))
        sums = [n_a, n_b, counted(run_of), np.bincount(link_run, times, len(new)).astype(np.int64), faithful]
        self.sizes = np.concatenate([self.sizes, np.stack(sums, axis=1)])
        self.groups += self._written(a, b, a_cut, b_cut, a_group, b_group, n_a + n_b)
        self.starts = np.r_[self.starts, len(self.pair) + np.cumsum(counted(link_run))]
        self.pair, self.times = np.r_[self.pair, self._numbers(pair)], np.r_[self.times, times]

    def _numbers(self, pair: np.ndarray) -> np.ndarray:
        """Numbers of id pairs; new ones get the next."""
        ordered = np.sort(pair)
        ordered = ordered[np.flatnonzero(np.diff(ordered, prepend=-1))]
        known = self.pairs[self.order]
        place = np.minimum(np.searchsorted(known, ordered), max(len(known) - 1, 0))
        new = ordered[known[place] != ordered] if len(known) else ordered
        self.pairs = np.r_[self.pairs, new]
        self.order = np.argsort(self.pairs, kind="stable")
        return self.order[np.searchsorted(self.pairs[self.order], pair)].astype(np.int32)

    def _faithful(self, new, a, a_at, b, b_at) -> np.ndarray:
        """Whether both vocabularies give back the bytes of each run."""
        length = np.array([len(x) for x in new], np.int64)
        same = np.ones(len(new), bool)
        for vocabulary, ids, at in ((self.first, a, a_at), (self.second, b, b_at)):
            same &= _sums(vocabulary.lengths[ids], at) == length
        ends = np.cumsum(length[same])
        there = np.flatnonzero(same)
        text = np.frombuffer(b"".join(new[i] for i in there), np.uint8)
        for vocabulary, ids, at in ((self.first, a, a_at), (self.second, b, b_at)):
            pieces = vocabulary.pieces
            back = b"".join([pieces[i] for i in tokens.gathered(ids, at, there).tolist()])
            differs = np.flatnonzero(np.frombuffer(back, np.uint8) != text)
            same[there[np.searchsorted(ends, differs, "right")]] = False
        return same

    def _written(self, a, b, a_cut, b_cut, a_group, b_group, n) -> list[str]:
        """``a1,a2|b1;`` for all groups of each run."""
        a_before, b_before = np.cumsum(a_cut.astype(np.int64)), np.cumsum(b_cut.astype(np.int64))
        groups = int(a_before[-1]) if len(a) else 0
        n_a, n_b = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
        every = np.empty(len(a) + len(b), object)
        every[np.arange(len(a)) + (np.cumsum(n_b) - n_b)[a_group]] = np.where(a_cut, self._names[1][a], self._names[0][a])
        every[np.arange(len(b)) + np.cumsum(n_a)[b_group]] = np.where(b_cut, self._names[3][b], self._names[2][b])
        flat, ends = every.tolist(), np.cumsum(n).tolist()
        return ["".join(flat[begin:end]) for begin, end in zip([0, *ends], ends)]


_ROWS = (
    "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, runs array<int>, "
    "pairs array<long>, pair_docs array<long>, link_pairs array<int>, link_times array<long>, link_starts array<long>"
)
_NAMES = [x.split()[0] for x in _ROWS.split(", ")]
_LISTS = {"runs": pa.int32(), "pairs": pa.int64(), "pair_docs": pa.int64(), "link_pairs": pa.int32(), "link_times": pa.int64(), "link_starts": pa.int64()}


def _batch(n: int, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    """Rows with null in the columns that are not given."""
    kinds = {name: pa.list_(_LISTS[name]) if name in _LISTS else pa.int64() for name in _NAMES} | {"groups": pa.large_string()}
    return pa.RecordBatch.from_arrays([columns.get(name, pa.nulls(n, kinds[name])) for name in _NAMES], names=_NAMES)


def _documents(runs: _Runs, texts: pa.Array, ids: pa.Array, block: int) -> tuple[pa.RecordBatch, np.ndarray]:
    """Rows of documents, and for each pair of the block in how many of them it is linked."""
    data, offsets = tokens.led(texts)
    found, codes, at = tokens.runs(data, offsets)
    codes = runs.codes(found.to_pylist())[codes]
    lists = [codes[begin:end] for begin, end in zip(at[:-1].tolist(), at[1:].tolist())]
    for doc in np.flatnonzero(np.diff(offsets) == 1):
        lists[doc] = codes[:0]  # no text but the space
    # Runs that are not given back may still be part of a text that is: look at it as one run.
    unlike = np.unique(_owned(at)[runs.sizes[codes, 4] == 0])
    for doc in unlike:
        whole = runs.codes([data[offsets[doc] : offsets[doc + 1]].tobytes()])
        lists[doc] = whole[runs.sizes[whole, 4] == 1]
    codes = np.concatenate(lists)
    at = np.r_[0, np.cumsum([len(x) for x in lists])].astype(np.int64)
    sums = [pa.array(_sums(runs.sizes[codes, i], at)) for i in range(4)]
    written_runs = list(map(runs.groups.__getitem__, codes.tolist()))
    groups = ["".join(written_runs[begin:end])[:-1] for begin, end in zip(at[:-1].tolist(), at[1:].tolist())]
    n = len(lists)
    rows = _batch(n, {
        "block": pa.array(np.full(n, block)), "doc_id": ids, **dict(zip(("n_a", "n_b", "n_groups", "n_links"), sums)),
        "groups": pa.array(groups, pa.large_string()), "runs": list_column([x.astype(np.int32) for x in lists], pa.int32()),
    })
    doc, run = np.divmod(_distinct(_owned(at) * len(runs.code) + codes), max(len(runs.code), 1))
    here = tokens.gathered(runs.pair, runs.starts, run).astype(np.int64)
    owner = np.repeat(doc, np.diff(runs.starts)[run])
    n_pairs = max(len(runs.pairs), 1)
    return rows, np.bincount(_distinct(owner * n_pairs + here) % n_pairs, minlength=len(runs.pairs))


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.flatnonzero(np.diff(values, prepend=-1))]


def _blocks(
    batches: Iterator[pa.RecordBatch], first: tuple, second: tuple, block_bytes: int = BLOCK_BYTES
) -> Iterator[pa.RecordBatch]:
    """Rows of documents, and after those of a block one row with its pairs and links."""
    context = TaskContext.get()
    block = (context.partitionId() if context else 0) << 32
    runs, size, counts = None, 0, np.zeros(0, np.int64)

    def end() -> pa.RecordBatch:
        # Runs of texts that are not given back have links that no document has.
        held = runs.order[counts[runs.order] > 0]
        number = np.zeros(len(runs.pairs), np.int32)
        number[held] = np.arange(len(held))
        lists = {
            "pairs": runs.pairs[held], "pair_docs": counts[held], "link_pairs": number[runs.pair],
            "link_times": np.where(counts[runs.pair] > 0, runs.times, 0), "link_starts": runs.starts,
        }
        return _batch(1, {"block": pa.array([block])} | {k: list_column([x], _LISTS[k]) for k, x in lists.items()})

    for rows, data, _ in slices(batches, limit=_SLICE_BYTES):
        runs = runs or _Runs(tokens.load(*first), tokens.load(*second))
        out, here = _documents(runs, rows.column("text"), rows.column("doc_id"), block)
        here[: len(counts)] += counts
        counts = here
        size += len(data)
        yield out
        if size >= block_bytes:
            yield end()
            runs, size, counts, block = None, 0, np.zeros(0, np.int64), block + 1
    if runs:
        yield end()


def aligned(docs: DataFrame, first: tuple, second: tuple, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Documents with their groups, in blocks.

    ``first`` and ``second`` are a class of ``tokens`` and the path of its vocabulary. Rows with a
    document's columns n_a, n_b, n_groups, n_links and ``groups`` (ids of both as ``1,2|3;4|5``), and one
    row for each block, whose ``pairs`` are not null, for the functions below.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(partial(_blocks, first=first, second=second, block_bytes=block_bytes), _ROWS)


def pair_counts(rows: DataFrame) -> DataFrame:
    """Rows (pair, a, b, n, is_best) of all linked ids: documents that have them, and whether none of ``a`` has more."""
    found = rows.where("pairs IS NOT NULL").select(F.inline(F.arrays_zip("pairs", "pair_docs")))
    counts = found.groupBy(F.col("pairs").alias("pair")).agg(F.sum("pair_docs").alias("n"))
    a = F.shiftright("pair", 32)
    most = F.max("n").over(Window.partitionBy(a))  # as many rows as the other vocabulary has ids, at most
    return counts.select("pair", a.alias("a"), F.col("pair").bitwiseAND((1 << 32) - 1).alias("b"), "n", (F.col("n") == most).alias("is_best"))


def _list(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Entries of all lists, and where each list begins."""
    column = column.combine_chunks()
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy().astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), offsets - offsets[0]


def _looked_up(rows: pa.Table, counted: pa.Table, names: list[str]) -> pa.Table:
    """Documents of one block with the counts of their links."""
    of_block = rows.column("pairs").is_valid()
    block = rows.filter(of_block).slice(0, 1)
    docs = rows.filter(pc.invert(of_block))
    counted = counted.sort_by("pair")
    n = counted.column("n").to_numpy()
    best = counted.column("is_best").to_numpy(zero_copy_only=False).astype(np.int64)
    link, times, starts = (_list(block.column(name))[0] for name in ("link_pairs", "link_times", "link_starts"))
    runs, at = _list(docs.column("runs"))
    sums = [_sums(_sums(x[link] * times, starts)[runs], at) if len(x) else np.zeros(docs.num_rows, np.int64) for x in (best, n)]
    return pa.Table.from_arrays([*(docs.column(name) for name in names), *map(pa.array, sums)], names=[*names, "n_best", "count_sum"])


def with_counts(rows: DataFrame) -> DataFrame:
    """Documents with ``n_best``, links whose pair is counted most for its first id, and ``count_sum`` of all links.

    ``rows`` are those of ``aligned``, stored, with other columns for each document in place of ``groups`` if wanted.
    """
    needed = rows.where("pairs IS NOT NULL").select(F.col("block").alias("of"), F.explode("pairs").alias("pair"))
    counted = needed.join(pair_counts(rows).select("pair", "n", "is_best"), "pair")
    inner = {"block", *_LISTS}
    names = [name for name in rows.columns if name not in inner]
    schema = rows.select(*names, F.lit(0).cast("long").alias("n_best"), F.lit(0).cast("long").alias("count_sum")).schema
    look_up = partial(_looked_up, names=names)
    return rows.groupBy("block").cogroup(counted.groupBy("of")).applyInArrow(
        lambda left, right: look_up(left, right), schema
    )


def alignment_digests(docs: DataFrame, first: tuple, second: tuple, **how) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum."""
    rows = aligned(docs, first, second, **how)
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("").alias("groups_sha256")
    return with_counts(written(rows.select(*(name for name in _NAMES if name != "groups"), digest), "aligned"))
