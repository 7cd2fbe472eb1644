"""Distributed LSD radix sort: a global position for every row, without one task that holds all.

The keys of a row are cut into digits of ``DIGIT_BITS`` bits, those of the last key first. One pass
is a stable counting sort by one digit: rows stand in numbered parts, each task counts
the digits of its part, prefix sums over (digit, part) give the place where each part puts
its first row of each digit, and every row moves to the part of its new place. After the
pass over the leading digit the place is the rank. A digit in which all rows agree needs no pass.

Parts are ranges of places, so they are equally long whatever the keys are: a key that a third of
all rows have is spread like any other. Every pass is stored before the next one.
"""

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from affinia.sources.workspace import written

DIGIT_BITS = 12
LEAST_PART, MOST_PART = 1 << 8, 1 << 20  # rows

PLACE = "_place"
_PART, _DIGIT = "_part", "_digit"


def part_offsets(counts: DataFrame, part: str, group: str, n: str) -> DataFrame:
    """Rows (part, group, before): how many of the group are in earlier parts.

    ``counts`` has one row for each part and group, so a window holds as many rows as there are parts.
    """
    earlier = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(n).over(earlier), F.lit(0)).cast("long")
    return counts.select(part, group, before.alias("before"))


def running(groups: np.ndarray) -> np.ndarray:
    """For each entry, how many equal ones come before it."""
    order = np.argsort(groups, kind="stable")
    ordered = groups[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(groups) else order
    lengths = np.diff(np.r_[first, len(groups)])
    out = np.empty(len(groups), np.int64)
    out[order] = np.arange(len(groups)) - np.repeat(first, lengths)
    return out


def _digits(rows: pa.Table | pa.RecordBatch, keys: list[tuple], at: int) -> np.ndarray:
    """Bits ``at`` to ``at + DIGIT_BITS`` of the keys written one after the other."""
    out = np.zeros(rows.num_rows, np.uint64)
    begin = 0
    for name, low, high, falls in reversed(keys):
        width = (high - low).bit_length()
        since, until = max(at, begin), min(at + DIGIT_BITS, begin + width)
        if since < until:
            values = rows.column(name).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            bound = np.array([high if falls else low], np.int64).view(np.uint64)
            values = bound - values if falls else values - bound
            taken = (values >> np.uint64(since - begin)) & np.uint64((1 << (until - since)) - 1)
            out |= taken << np.uint64(since - at)
        begin += width
    return out.astype(np.int64)


def _first_digit(batches, keys: list[tuple]):
    for rows in batches:
        yield rows.append_column(_DIGIT, pa.array(_digits(rows, keys, 0), pa.int64()))


def _moved(rows: pa.Table, offsets: pa.Table, keys: list[tuple], part_rows: int, next_at: int) -> pa.Table:
    """Rows of one part at their places after a pass, with the digit of the next one."""
    rows = rows.sort_by(PLACE)
    digits = rows.column(_DIGIT).to_numpy()
    known, before = offsets.column(_DIGIT).to_numpy(), offsets.column("before").to_numpy()
    order = np.argsort(known)
    first = before[order][np.searchsorted(known[order], digits)]
    place = first + running(digits)
    names = [name for name in rows.column_names if name not in (PLACE, _PART, _DIGIT)]
    columns = [rows.column(name) for name in names]
    columns += [pa.array(place), pa.array(place // part_rows), pa.array(_digits(rows, keys, next_at), pa.int64())]
    return pa.Table.from_arrays(columns, names=[*names, PLACE, _PART, _DIGIT])


def _pass(rows: DataFrame, keys: list[tuple], part_rows: int, next_at: int) -> DataFrame:
    counts = rows.groupBy(_PART, _DIGIT).agg(F.count("*").alias("n"))
    counts = written(counts, "digits")
    totals = counts.groupBy(_DIGIT).agg(F.sum("n").alias("n")).collect()  # one row a digit
    smaller, upto = [], 0
    for digit, n in sorted((row[_DIGIT], row["n"]) for row in totals):
        smaller.append((digit, upto))
        upto += n
    if len(smaller) < 2:
        at = part_offsets(counts, _PART, _DIGIT, "n")
    else:
        base = rows.sparkSession.createDataFrame(smaller, f"{_DIGIT} long, smaller long")
        at = part_offsets(counts, _PART, _DIGIT, "n").join(F.broadcast(base), _DIGIT)
        at = at.select(_PART, _DIGIT, (F.col("before") + F.col("smaller")).alias("before"))
    move = partial(_moved, keys=keys, part_rows=part_rows, next_at=next_at)
    moved = rows.groupBy(_PART).cogroup(at.groupBy(_PART)).applyInArrow(
        lambda left, right: move(left, right), rows.schema
    )
    return written(moved, "pass")


def ranked(rows: DataFrame, order: list[tuple[str, bool]], n_rows: int | None = None) -> DataFrame:
    """The rows with their position, from 0, as ``_place``.

    ``order`` names columns without nulls, the leading one first, and whether each falls.
    Rows equal in all of them stand next to each other in no fixed order.
    """
    ends = rows.agg(
        F.count("*").alias("n"),
        *(F.min(name).cast("long").alias(f"low{i}") for i, (name, _) in enumerate(order)),
        *(F.max(name).cast("long").alias(f"high{i}") for i, (name, _) in enumerate(order)),
    ).first()
    if ends["n"] == 0:
        return rows.withColumn(PLACE, F.lit(0).cast("long"))
    keys = [(name, ends[f"low{i}"], ends[f"high{i}"], falls) for i, (name, falls) in enumerate(order)]
    bits = sum((high - low).bit_length() for _, low, high, _ in keys)
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part_rows = min(max(-(-ends["n"] // partitions), LEAST_PART), MOST_PART)
    place = F.monotonically_increasing_id()
    state = rows.withColumn(PLACE, place).withColumn(_PART, F.floor(F.col(PLACE) / part_rows))
    schema = state.withColumn(_DIGIT, F.lit(0).cast("long").alias(_DIGIT)).schema
    state = written(state.mapInArrow(partial(_first_digit, keys=keys), schema), "pass")
    for at in range(0, max(bits, 1), DIGIT_BITS):
        state = _pass(state, keys, part_rows, at + DIGIT_BITS)
    return state.drop(_PART, _DIGIT)
