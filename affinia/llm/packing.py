"""Packing of token ids into windows by minimum bin slack.

A document is its ids and the id that ends it. Whole windows are cut off it; what remains is a
piece shorter than a window. Pieces are planned by their lengths alone, so the plan needs a
histogram of ``window`` counts however many documents there are. A window takes the longest
piece that is left. A bitset of reachable sums, extended by one length after the other with as many
copies as there are, tells how close the others can fill it, and backtracking through the
bitsets gives how many of each length do. The same multiset is taken as often as the counts allow. If
it does not fill the window, the longest other piece is cut. What is less than a window in the
end goes to sequences of a power of two, so no sequence is padded.

Pieces of one length are numbered: counts per part and length, and prefix sums over the parts, give
the first number of each part. A plan row sends numbers to sequences and places; the plan is looked up in
the tasks. It has at most ``window`` rows for each multiset, and multisets are about as many as
lengths. A length that a third of all documents have is numbered in all parts at once.

Defined results: a null or empty text is the ending id alone; repeated rows are packed each; ids of
rows do not matter and may be null; an empty table gives no rows. Other columns are not read.
"""

import zlib
from collections import defaultdict, deque
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia.llm import tokens
from affinia.llm.arrays import list_column, slices, utf8
from affinia.llm.radix import part_offsets, running
from affinia.sources.workspace import written

WINDOW = 4096
END_ID = 2
PART_BYTES = 4 << 20  # of text in one part


def fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many of each length to take so that their sum is as close to ``room`` as can be, and not over it.

    Long ones are tried first, and short ones are left for later windows where the sum is the same.
    """
    mask = (1 << (room + 1)) - 1
    reached, steps = 1, []
    for length in sorted((x for x, n in counts.items() if n and x <= room), reverse=True):
        left, copies = min(counts[length], room // length), 1
        while left and not reached >> room & 1:  # 1, 2, 4 ... copies reach every number of them
            taken = min(copies, left)
            steps.append((length, taken, reached))
            reached |= reached << (length * taken) & mask
            left, copies = left - taken, copies * 2
    total, chosen = reached.bit_length() - 1, defaultdict(int)
    for length, taken, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] += taken
            total -= length * taken
    return dict(chosen)


class _Pool:
    """Pieces that are left, by length: runs (origin, first number, how many, start in the piece)."""

    def __init__(self, histogram: dict[int, int]):
        self.counts = dict(histogram)
        self.runs = defaultdict(deque, {x: deque([(x, 0, n, 0)]) for x, n in histogram.items()})

    def put(self, length: int, run: tuple[int, int, int, int]) -> None:
        self.runs[length].append(run)
        self.counts[length] = self.counts.get(length, 0) + run[2]

    def take(self, length: int, n: int) -> Iterator[tuple[int, int, int, int]]:
        self.counts[length] -= n
        runs = self.runs[length]
        while n:
            origin, first, have, start = runs.popleft()
            used = min(n, have)
            if have > used:
                runs.appendleft((origin, first + used, have - used, start))
            yield origin, first, used, start
            n -= used


def plan(histogram: dict[int, int], window: int = WINDOW) -> np.ndarray:
    """Rows (origin, first, n, start, length, index, times, offset, sequence), sorted by origin and first.

    Pieces ``first`` to ``first + n`` of the length ``origin`` give ``length`` ids from ``start`` on. The
    i-th of them is number ``index + i`` of its multiset's pieces of that length, of which each
    sequence from ``sequence`` on has ``times``, one after the other from ``offset`` on.
    """
    pool, rows, sequence = _Pool(histogram), [], 0

    def place(length: int, times: int, copies: int, offset: int) -> None:
        index = 0
        for origin, first, n, start in list(pool.take(length, times * copies)):
            rows.append((origin, first, n, start, length, index, times, offset, sequence))
            index += n

    if pool.counts.get(window):
        copies = pool.counts[window]
        place(window, 1, copies, 0)
        sequence += copies
    total = sum(length * n for length, n in pool.counts.items())
    while total >= window:
        longest = max(x for x, n in pool.counts.items() if n)
        pool.counts[longest] -= 1
        chosen = fill(pool.counts, window - longest)
        pool.counts[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        copies = min(pool.counts[length] // times for length, times in chosen.items())
        slack = window - sum(length * times for length, times in chosen.items())
        if slack:
            # Whatever is left over is longer than the slack, or it would have been taken.
            spare = {x: n - chosen.get(x, 0) for x, n in pool.counts.items()}
            cut = max(x for x, n in spare.items() if n > 0)
            copies = min(copies, pool.counts[cut] // (chosen.get(cut, 0) + 1))
        offset = 0
        for length in sorted(chosen, reverse=True):
            place(length, chosen[length], copies, offset)
            offset += length * chosen[length]
        if slack:
            index = 0
            for origin, first, n, start in list(pool.take(cut, copies)):
                rows.append((origin, first, n, start, slack, index, 1, offset, sequence))
                pool.put(cut - slack, (origin, first, n, start + slack))
                index += n
        sequence += copies
        total -= window * copies
    # The rest, one piece after the other, into sequences of falling powers of two.
    room = 1 << (total.bit_length() - 1) if total else 0
    size, offset = room, 0
    for length in sorted((x for x, n in pool.counts.items() if n), reverse=True):
        for origin, first, n, start in list(pool.take(length, pool.counts[length])):
            for number in range(first, first + n):
                at, left = start, length
                while left:
                    taken = min(left, size - offset)
                    rows.append((origin, number, 1, at, taken, 0, 1, offset, sequence))
                    at, left, offset, total = at + taken, left - taken, offset + taken, total - taken
                    if offset == size:
                        sequence, offset = sequence + 1, 0
                        size = 1 << (total.bit_length() - 1) if total else 0
    return _aligned_ranges(np.array(rows, np.int64).reshape(-1, 9))


def _aligned_ranges(rows: np.ndarray) -> np.ndarray:
    """The rows split so that ranges of numbers of one origin are equal or disjoint."""
    origin, first, n, index = rows[:, 0], rows[:, 1], rows[:, 2], rows[:, 5]
    keys = np.unique(_key(np.r_[origin, origin], np.r_[first, first + n]))
    since, until = (np.searchsorted(keys, _key(origin, x)) for x in (first, first + n))
    each = until - since
    out = np.repeat(rows, each, axis=0)
    at = np.repeat(since, each) + np.arange(len(out)) - np.repeat(np.cumsum(each) - each, each)
    begin, end = (keys[at + i] & _NUMBER for i in (0, 1)) if len(out) else (first, first)
    out[:, 5] = np.repeat(index, each) + begin - out[:, 1]
    out[:, 1], out[:, 2] = begin, end - begin
    return out[np.lexsort([out[:, 3], out[:, 1], out[:, 0]])]


_NUMBER = (1 << 48) - 1


def _key(origin: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Both in one integer; there are fewer than 2^48 pieces, and a window is shorter than 2^15."""
    return origin << 48 | number


_ENCODED = "part long, row long, doc_id long, ids binary, doc_tokens long"


def _encode(batches: Iterator[pa.RecordBatch], vocabulary: tuple, end_id: int, part_bytes: int) -> Iterator[pa.RecordBatch]:
    context = TaskContext.get()
    part = (context.partitionId() if context else 0) << 32
    row = size = 0
    model = None
    for rows, data, _ in slices(batches, limit=part_bytes):
        model = model or tokens.load(*vocabulary)
        found, codes, at = model.units(*utf8(rows.column("text")))
        flat, starts = model.encode(found.to_pylist())
        # The ending id as one more unit, after the last one of each document.
        codes = np.insert(codes, at[1:], len(starts) - 1)
        flat, starts = np.append(flat, end_id).astype(_stored(vocabulary, end_id)), np.append(starts, len(flat) + 1)
        upto = np.r_[0, np.cumsum(starts[codes + 1] - starts[codes])][at + np.arange(len(at))]
        n = rows.num_rows
        columns = [np.full(n, part), np.arange(row, row + n), None, None, np.diff(upto)]
        arrays = [None if x is None else pa.array(x, pa.int64()) for x in columns]
        ids = np.ascontiguousarray(tokens.gathered(flat, starts, codes))
        limits = pa.py_buffer(upto.astype(np.int64) * ids.itemsize)
        arrays[2] = rows.column("doc_id")
        arrays[3] = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, limits, pa.py_buffer(ids)]).cast(pa.binary())
        yield pa.RecordBatch.from_arrays(arrays, names=[x.split()[0] for x in _ENCODED.split(", ")])
        row, size = row + n, size + len(data)
        if size >= part_bytes:
            part, row, size = part + 1, 0, 0


def _stored(vocabulary: tuple, end_id: int) -> str:
    """Type of an id in stored bytes: two of them if the vocabulary allows it."""
    kind, path = vocabulary
    return "<u2" if max(tokens.load(kind, path).size, end_id + 1) <= 1 << 16 else "<u4"


def encoded(docs: DataFrame, vocabulary: tuple, end_id: int = END_ID, part_bytes: int = PART_BYTES) -> DataFrame:
    """Rows (part, row, doc_id, ids, doc_tokens), in parts of some megabytes of text or one document.

    Ids are stored as little-endian integers of two bytes, or of four if the vocabulary needs them.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(partial(_encode, vocabulary=vocabulary, end_id=end_id, part_bytes=part_bytes), _ENCODED)


_PIECES = "doc_id long, start long, length long, {ids}, doc_tokens long, sequence_id long, offset long"
_IDS, _CRC = "ids array<int>", "ids_crc32 long"


def _placed(docs: pa.Table, numbers: pa.Table, steps: np.ndarray, window: int, digest: bool) -> pa.Table:
    """Pieces of the documents of one part."""
    docs = docs.sort_by("row")
    tokens_of = docs.column("doc_tokens").to_numpy()
    # Whole windows of each document and what remains of it, in order.
    whole, rest = tokens_of // window, tokens_of % window
    n = whole + (rest > 0)
    doc = np.repeat(np.arange(len(n)), n)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    origin = np.where(nth < whole[doc], window, rest[doc])
    known, before = numbers.column("length").to_numpy(), numbers.column("before").to_numpy()
    order = np.argsort(known)
    number = before[order][np.searchsorted(known[order], origin)] + running(origin)
    # Steps of a piece: those whose numbers hold it. Without cuts that is one.
    keys = _key(steps[:, 0], steps[:, 1])
    first = np.searchsorted(keys, _key(origin, number), "right") - 1
    since = np.searchsorted(keys, keys[first])
    each = first - since + 1
    step = np.repeat(since, each) + np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    piece = np.repeat(np.arange(len(doc)), each)
    _, first_number, _, start, length, index, times, offset, sequence = steps[step].T
    at = index + number[piece] - first_number
    start = start + nth[piece] * window
    stored = docs.column("ids").cast(pa.large_binary()).combine_chunks()
    _, limits, data = stored.buffers()
    limits = np.frombuffer(limits, np.int64)[stored.offset : stored.offset + len(stored) + 1]
    width = max(int(limits[-1] - limits[0]) // max(int(tokens_of.sum()), 1), 1)
    flat = np.frombuffer(data, f"<u{width}", int(limits[-1]) // width)
    begin = limits[doc[piece]] // width + start
    lists = [flat[b:e] for b, e in zip(begin.tolist(), (begin + length).tolist())]
    if digest:
        held = pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in lists], pa.int64())
    else:
        held = list_column([x.astype(np.int32) for x in lists], pa.int32())
    columns = [
        docs.column("doc_id").take(pa.array(doc[piece])), pa.array(start), pa.array(length), held,
        pa.array(tokens_of[doc[piece]]), pa.array(sequence + at // times), pa.array(offset + at % times * length),
    ]
    return pa.Table.from_arrays(columns, names=_names(digest))


def _names(digest: bool) -> list[str]:
    return [x.split()[0] for x in _PIECES.format(ids=_CRC if digest else _IDS).split(", ")]


def pieces(
    docs: DataFrame,
    vocabulary: tuple,
    end_id: int = END_ID,
    window: int = WINDOW,
    part_bytes: int = PART_BYTES,
    digest: bool = False,
) -> DataFrame:
    """Rows (doc_id, start, length, ids, doc_tokens, sequence_id, offset), one for each piece.

    With ``digest`` there is ``ids_crc32``, of the ids as little-endian integers of 32 bits, in place of the ids.
    """
    rows = written(encoded(docs, vocabulary, end_id, part_bytes), "ids")
    whole, rest = F.col("doc_tokens").cast("long"), F.col("doc_tokens") % window
    kinds = F.array(
        F.struct(F.lit(window).cast("long").alias("length"), F.floor(whole / window).alias("n")),
        F.struct(rest.cast("long").alias("length"), F.lit(1).cast("long").alias("n")),
    )
    counts = rows.select("part", F.inline(kinds)).where("length > 0 AND n > 0")
    counts = written(counts.groupBy("part", "length").agg(F.sum("n").alias("n")), "lengths")
    totals = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()  # one row a length, at most ``window``
    steps = plan({row["length"]: row["n"] for row in totals}, window)
    numbers = part_offsets(counts, "part", "length", "n")
    place = partial(_placed, steps=steps, window=window, digest=digest)
    schema = _PIECES.format(ids=_CRC if digest else _IDS)
    return rows.groupBy("part").cogroup(numbers.groupBy("part")).applyInArrow(lambda left, right: place(left, right), schema)


def sequences(found: DataFrame) -> DataFrame:
    """Rows (sequence_id, ids, doc_ids): the ids of each sequence, and whose they are, piece by piece."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id")))
    rows = found.groupBy("sequence_id").agg(parts.alias("parts"))
    return rows.select("sequence_id", F.flatten("parts.ids").alias("ids"), F.col("parts.doc_id").alias("doc_ids"))
