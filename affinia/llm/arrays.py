"""Text columns of Arrow batches as flat byte arrays, and words found in them.

Everything here works on a whole slice of documents at once. A slice holds a
few megabytes, or one document when that alone is larger, so the memory of a
task is bounded by the longest document and not by the number of rows.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20

U64 = np.uint64
_MULTIPLIER = U64(0x9E3779B97F4A7C15 | 1)
_INVERSE = U64(pow(int(_MULTIPLIER), -1, 1 << 64))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each begins; one offset more than texts. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = pc.fill_null(column, "")
    _, starts, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(starts, kind)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of the batches with the bytes and offsets of one text column."""
    for batch in batches:
        data, offsets = utf8(batch.column(column))
        row = 0
        while row < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
            end = min(max(end, row + 1), batch.num_rows)
            part = offsets[row : end + 1]
            yield batch.slice(row, end - row), data[part[0] : part[-1]], part - part[0]
            row = end


def byte_set(pattern: bytes) -> np.ndarray:
    """For each byte value whether it is one of ``pattern``."""
    table = np.zeros(256, bool)
    table[list(pattern)] = True
    return table


# Words are runs of bytes other than these.
NOT_SPACE = ~byte_set(bytes([0x20, *range(0x09, 0x0E)]))
# Words are runs of ASCII letters, ASCII digits, and bytes of other characters.
ALPHANUMERIC = ~byte_set(
    bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
)


def words(
    data: np.ndarray, offsets: np.ndarray, inside: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of words before each document."""
    is_word = inside[data]
    n = len(data)
    follows = np.zeros(n + 1, bool)
    follows[1:] = is_word
    follows[offsets] = False
    starts = np.flatnonzero(is_word & ~follows[:-1])
    goes_on = np.zeros(n + 1, bool)
    goes_on[:n] = is_word
    goes_on[offsets] = False
    ends = np.flatnonzero(is_word & ~goes_on[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers; one to one."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_PLAIN = mix(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95))
_LOWER = _PLAIN.copy()
_LOWER[65:91] = _PLAIN[97:123]

_powers = {"n": 0, "up": np.zeros(0, U64), "down": np.zeros(0, U64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of the multiplier and of its inverse, modulo 2^64."""
    if n > 4 * SLICE_BYTES:
        return _powers_of(n)
    if _powers["n"] < n:
        up, down = _powers_of(max(n, SLICE_BYTES + 1))
        _powers.update(n=len(up), up=up, down=down)
    return _powers["up"][:n], _powers["down"][:n]


def _powers_of(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for factor in (_MULTIPLIER, _INVERSE):
        x = np.full(n, factor, U64)
        x[0] = 1
        out.append(np.multiply.accumulate(x))
    return out[0], out[1]


def span_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False
) -> np.ndarray:
    """A 64-bit hash of each span of bytes; equal bytes give equal hashes anywhere."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum((_LOWER if lower else _PLAIN)[data] * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64))


def shingle_hashes(
    data: np.ndarray, offsets: np.ndarray, size: int = 5
) -> tuple[np.ndarray, np.ndarray]:
    """63-bit hashes of all word shingles, and the number before each document.

    Words are lower-cased for A-Z. A document of fewer words than ``size`` has
    one shingle of all of them; one without words has none.
    """
    starts, ends, before = words(data, offsets, NOT_SPACE)
    hashes = span_hashes(data, starts, ends, lower=True)
    counts = np.diff(before)
    weights = mix(np.arange(11, 11 + size, dtype=U64))
    weights |= U64(1)
    of_doc = np.repeat(np.arange(len(counts)), counts)
    n = len(hashes)
    total = np.zeros(max(n - size + 1, 0), U64)
    for j in range(size if len(total) else 0):
        total += hashes[j : n - size + 1 + j] * weights[j]
    whole = of_doc[: len(total)] == of_doc[size - 1 :] if len(total) else np.zeros(0, bool)
    found, owner = total[whole], of_doc[: len(total)][whole]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        extra = np.zeros(len(short), U64)
        for j in range(size - 1):
            has = counts[short] > j
            extra[has] += hashes[before[short[has]] + j] * weights[j]
        extra = mix(extra + counts[short].astype(U64))
        found, owner = np.concatenate([found, extra]), np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        found, owner = found[order], owner[order]
    return mix(found) >> U64(1), np.searchsorted(owner, np.arange(len(counts) + 1))


def distinct_sorted(values: np.ndarray) -> np.ndarray:
    """Distinct values in ascending order."""
    values = np.sort(values)
    if len(values) < 2:
        return values
    keep = np.empty(len(values), bool)
    keep[0] = True
    np.not_equal(values[1:], values[:-1], out=keep[1:])
    return values[keep]


def list_column(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """Arrays as one Arrow column of lists."""
    lengths = np.array([0, *map(len, parts)])
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(np.cumsum(lengths), pa.int32()), pa.array(flat, kind))
