"""Removal of long byte strings that occur more than once, by sorted suffixes.

A document is a sequence of windows of ``LENGTH`` bytes; every window is the
beginning of a suffix. A window is repeated if it starts anywhere else too.

1. Suffixes are dealt out by content: the key of a window is the least hash
   of all ``GRAM``-byte strings in it, so equal windows meet under one key. Neighbouring
   windows with one key form a piece. Only keys, places and digests of pieces are
   shuffled, about one piece for 80 bytes.
2. A key with one piece is unique. A key whose pieces are all the same is repeated
   as a whole. Only the distinct pieces of other keys, those at the edges of
   repeated passages, are fetched.
3. Their suffixes are sorted under each key by deep-shallow sorting: multikey sorting
   by eight bytes at a time to ``SHALLOW`` bytes, then blind tries for the groups
   that remain. Suffixes that share ``LENGTH`` bytes are repeated.
4. A key with more than ``WIDE_KEY`` distinct pieces is not sorted in one task: its
   windows become rows that Spark groups by their bytes in all tasks.
5. Repeated windows are joined to their documents as spans, merged and cut out.

Pieces are compared by 64-bit hashes under a 64-bit key in step 2, windows by their bytes in steps 3
and 4. Most removed bytes are those of whole pieces, which step 2 finds; the sort decides the edges.

Defined results: a null or empty text has no bytes and keeps the digest of
nothing; texts shorter than ``LENGTH`` are never cut; each of several equal
documents of at least ``LENGTH`` bytes is removed whole; rows are told apart by their text,
so a repeated or null doc_id does not matter. Other columns are not read.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia.llm.arrays import U64, _PLAIN, list_column, mix, powers, slices, span_hashes
from affinia.sources.workspace import written

LENGTH = 200
GRAM = 40
SHALLOW = 40  # bytes sorted before blind tries take over
LONGEST_PIECE = 4096  # windows
WIDE_KEY = 1_000  # distinct pieces
BATCH_BYTES = 1 << 20  # of piece text sorted at once
WORD = 8

_PIECES = "key long, text_id long, n_bytes long, start int, windows int, digest long, folds boolean"


def _window_keys(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the string at each place, and the least of them in each window."""
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum(_PLAIN[data] * up[:-1], out=sums[1:])
    grams = mix((sums[gram:] - sums[:-gram]) * down[: len(data) + 1 - gram])
    width = length - gram + 1
    count = len(data) - length + 1
    padded = np.full(-(-len(grams) // width) * width, U64(2**64 - 1))
    padded[: len(grams)] = grams
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return grams, np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


def _pieces(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches):
            if len(data) < length:
                continue
            grams, keys = _window_keys(data, length, gram)
            count = len(keys)
            inside = np.zeros(count + 1, np.int32)
            starts, stops = offsets[:-1], np.maximum(offsets[1:] - length + 1, offsets[:-1])
            np.add.at(inside, np.minimum(starts, count), 1)
            np.add.at(inside, np.minimum(stops, count), -1)
            inside = np.cumsum(inside[:-1]) > 0
            edge = np.ones(count, bool)
            edge[1:] = (keys[1:] != keys[:-1]) | ~inside[:-1]
            edge[starts[starts < count]] = True
            begins = np.flatnonzero(edge & inside)
            if not len(begins):
                continue
            doc = np.searchsorted(offsets, begins, "right") - 1
            ends = np.minimum(np.append(begins[1:], count), stops[doc])
            # The least string leaves a window and the next has it again.
            again = np.zeros(count + 1, np.int64)
            again[1:count] = (grams[: count - 1] == keys[:-1]) & (keys[1:] == keys[:-1])
            again = np.cumsum(again)
            folds = again[ends - 1] > again[begins]
            begins, ends, doc, folds = _cut(begins, ends, doc, folds)
            text_id = rows.column("text_id").to_numpy(zero_copy_only=False)
            n_bytes = rows.column("n_bytes").to_numpy(zero_copy_only=False)
            digest = span_hashes(data, begins, ends + length - 1)
            columns = [
                keys[begins].view(np.int64),
                text_id[doc],
                n_bytes[doc],
                (begins - offsets[doc]).astype(np.int32),
                (ends - begins).astype(np.int32),
                digest.view(np.int64),
                folds,
            ]
            names = [part.split()[0] for part in _PIECES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=names)

    return run


def _cut(begins, ends, doc, folds):
    """Pieces of at most LONGEST_PIECE windows."""
    parts = -(-(ends - begins) // LONGEST_PIECE)
    if (parts == 1).all():
        return begins, ends, doc, folds
    which = np.repeat(np.arange(len(begins)), parts)
    step = np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)
    first = begins[which] + step * LONGEST_PIECE
    return first, np.minimum(first + LONGEST_PIECE, ends[which]), doc[which], folds[which]


def _texts(docs: DataFrame) -> DataFrame:
    """Texts with what identifies them."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text.alias("text"),
        F.xxhash64(text).alias("text_id"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )


def _contents(length: int):
    """The bytes of the wanted pieces of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches):
            keys, digests, parts = [], [], []
            flat = data.tobytes()
            for row, wanted in enumerate(rows.column("wanted").to_pylist()):
                for x in wanted:
                    at = int(offsets[row]) + x["start"]
                    keys.append(x["key"])
                    digests.append(x["digest"])
                    parts.append(flat[at : at + x["windows"] + length - 1])
            columns = [pa.array(keys, pa.int64()), pa.array(digests, pa.int64()), pa.array(parts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "digest", "content"])

    return run


def _words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one integer that compares like them."""
    padded = np.concatenate([data, np.zeros(WORD, np.uint8)])
    out = np.zeros(len(data), U64)
    for i in range(WORD):
        out = (out << U64(8)) | padded[i : i + len(data)]
    return out


def _regroup(order: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Members of groups with more than one, after sorting; and the number of their group."""
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        sorted_key = key[order]
        new[1:] |= sorted_key[1:] != sorted_key[:-1]
    group = np.cumsum(new) - 1
    several = np.bincount(group)[group] > 1 if len(group) else np.zeros(0, bool)
    return order[several], group[several]


def repeated_suffixes(
    data: np.ndarray, suffixes: np.ndarray, groups: np.ndarray, length: int = LENGTH, shallow: int = SHALLOW
) -> np.ndarray:
    """For each suffix whether another one of its group begins with the same ``length`` bytes.

    ``length`` and ``shallow`` are multiples of eight, and every suffix has ``length`` bytes.
    """
    words, depths = _words_at(data), length // WORD
    repeated = np.zeros(len(suffixes), bool)
    alive, group = np.arange(len(suffixes)), groups
    for depth in range(min(shallow, length) // WORD):
        word = words[suffixes[alive] + depth * WORD]
        order, group = _regroup(np.lexsort((word, group)), group, word)
        alive = alive[order]
    if shallow >= length:
        repeated[alive] = True
        return repeated
    known = np.full(len(alive), shallow // WORD)  # words that all of a group share
    while len(alive):
        # The path of a group's first member through the blind trie; where do the others leave it?
        first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        path = np.repeat(suffixes[alive[first]], np.diff(np.append(first, len(group))))
        here, leaves = suffixes[alive], known.copy()
        going = np.arange(len(alive))
        while len(going):
            at = leaves[going] * WORD
            same = words[here[going] + at] == words[path[going] + at]
            going = going[same]
            leaves[going] += 1
            going = going[leaves[going] < depths]
        whole = leaves == depths
        sharing = np.add.reduceat(whole.astype(np.int64), first)
        repeated[alive[whole & (sharing[np.cumsum(np.append(True, group[1:] != group[:-1])) - 1] > 1)]] = True
        rest = np.flatnonzero(~whole)
        alive, group, leaves = alive[rest], group[rest], leaves[rest]
        branch = words[suffixes[alive] + leaves * WORD]
        order, new_group = _regroup(np.lexsort((branch, leaves, group)), group, leaves, branch)
        alive, known, group = alive[order], leaves[order] + 1, new_group
        full = known >= depths  # they branch off with their last word, so they share all
        repeated[alive[full]] = True
        alive, known, group = alive[~full], known[~full], group[~full]
    return repeated


def _covered(repeated: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Runs of bytes covered by repeated windows, the windows given in order."""
    at = np.flatnonzero(repeated)
    if not len(at):
        return []
    gap = np.flatnonzero(np.diff(at) > length)
    starts, ends = at[np.append(0, gap + 1)], at[np.append(gap, len(at) - 1)] + length
    return list(zip(starts.tolist(), ends.tolist()))


_SPAN = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))
_SPANS = "array<struct<from:int,to:int>>"


def _sorted_keys(length: int):
    """Repeated spans of pieces; the pieces of a key arrive one after the other."""

    def flush(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        key = rows.column("key").to_numpy()
        _, offsets = _binary(rows.column("content").combine_chunks())
        data, _ = _binary(rows.column("content").combine_chunks())
        windows = np.maximum(np.diff(offsets) - length + 1, 0)
        piece = np.repeat(np.arange(len(windows)), windows)
        before = np.cumsum(windows) - windows
        suffixes = offsets[piece] + np.arange(len(piece)) - before[piece]
        groups = np.cumsum(np.append(True, key[1:] != key[:-1])) - 1
        repeated = repeated_suffixes(data, suffixes, groups[piece], length)
        spans = [
            [{"from": a, "to": b} for a, b in _covered(repeated[i : i + n], length)]
            for i, n in zip(before.tolist(), windows.tolist())
        ]
        columns = [rows.column("key").combine_chunks(), rows.column("digest").combine_chunks(), pa.array(spans, _SPAN)]
        return pa.RecordBatch.from_arrays(columns, names=["key", "digest", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            keys = batch.column("key").to_numpy()
            while len(keys):
                # Whole keys only: what follows the last change of key may go on.
                if held and keys[0] != held[-1].column("key")[-1].as_py() and size >= BATCH_BYTES:
                    yield flush(held)
                    held, size = [], 0
                changes = np.flatnonzero(keys[1:] != keys[:-1]) + 1
                _, offsets = _binary(batch.column("content"))
                room = np.searchsorted(offsets, max(BATCH_BYTES - size, 0), "left")
                later = changes[changes >= room]
                end = int(later[0]) if len(later) else len(keys)
                held.append(batch.slice(0, end))
                size += int(offsets[end])
                batch, keys = batch.slice(end), keys[end:]
        if held:
            yield flush(held)

    return run


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    _, starts, data = column.buffers()
    kind = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    offsets = np.frombuffer(starts, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def _window_rows(length: int):
    """Every window of a piece by its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(0, batch.num_rows, 25):
                part = batch.slice(row, 25)
                data, offsets = _binary(part.column("content"))
                windows = np.diff(offsets) - length + 1
                piece = np.repeat(np.arange(len(windows)), windows)
                at = np.arange(len(piece)) - np.repeat(np.cumsum(windows) - windows, windows)
                begin = offsets[piece] + at
                columns = [
                    pa.array(part.column("key").to_numpy()[piece]),
                    pa.array(part.column("digest").to_numpy()[piece]),
                    pa.array(at.astype(np.int32)),
                    pa.BinaryArray.from_buffers(
                        pa.binary(),
                        len(begin),
                        [
                            None,
                            pa.py_buffer((np.arange(len(begin) + 1) * length).astype(np.int32)),
                            pa.py_buffer(data[begin[:, None] + np.arange(length)].ravel()),
                        ],
                    ),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "digest", "at", "window"])

    return run


def _wide_spans(contents: DataFrame, length: int) -> DataFrame:
    """Repeated spans of the pieces of wide keys, window by window."""
    rows = contents.mapInArrow(_window_rows(length), "key long, digest long, at int, window binary")
    rows = written(rows, "windows")
    twice = rows.groupBy("key", "window").agg(F.count("*").alias("n")).where("n > 1").select("key", "window")
    hit = rows.join(written(twice, "repeated-windows"), ["key", "window"])
    span = F.struct(F.col("at").alias("from"), (F.col("at") + length).alias("to"))
    return hit.groupBy("key", "digest").agg(F.collect_set(span).alias("spans"))


def _cut_out(with_text: bool):
    """Documents without their repeated spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, offsets in slices(batches):
            removed, digests, kept_texts, all_spans = [], [], [], []
            for row, spans in enumerate(rows.column("spans").to_pylist()):
                text = data[offsets[row] : offsets[row + 1]].tobytes()
                merged: list[list[int]] = []
                for x in sorted(((x["from"], x["to"]) for x in spans or ())):
                    if merged and x[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], x[1])
                    else:
                        merged.append(list(x))
                at, kept = 0, []
                for start, end in merged:
                    kept.append(text[at:start])
                    at = end
                kept.append(text[at:])
                left = b"".join(kept)
                removed.append(len(text) - len(left))
                digests.append(hashlib.sha256(left).hexdigest())
                all_spans.append([{"from": a, "to": b} for a, b in merged])
                kept_texts.append(left)
            columns = {
                "doc_id": rows.column("doc_id"),
                "n_bytes": pa.array(np.diff(offsets)),
                "n_removed": pa.array(removed, pa.int64()),
                "n_spans": pa.array([len(x) for x in all_spans], pa.int64()),
                "kept_sha256": pa.array(digests, pa.string()),
                "spans": pa.array(all_spans, _SPAN),
            }
            if with_text:
                columns["kept"] = pa.array(kept_texts, pa.binary())
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, wide_key: int = WIDE_KEY) -> DataFrame:
    """Byte spans (text_id, n_bytes, spans) of texts with repeated windows; spans may overlap."""
    if length % WORD or not 0 < gram <= length:
        raise ValueError("length must be a multiple of eight, and a gram must fit into it")
    texts = _texts(docs)
    pieces = texts.where(F.col("n_bytes") >= length).mapInArrow(_pieces(length, gram), _PIECES)
    # Documents are read twice, so that counts are reduced before their shuffle and a key that a
    # third of them have is split by the join.
    keys = pieces.groupBy("key").agg(
        F.count("*").alias("n"),
        F.bool_or("folds").alias("any_folds"),
        (F.min("digest") == F.max("digest")).alias("same"),
    )
    keys = keys.where("n > 1 OR any_folds").select("key", (F.col("same") & ~F.col("any_folds")).alias("same"))
    shared = written(pieces.join(written(keys, "keys"), "key").drop("folds"), "pieces")

    mixed = shared.where("NOT same").groupBy("key", "digest").agg(
        F.min(F.struct("text_id", "n_bytes", "start", "windows")).alias("x"), F.count("*").alias("n")
    )
    mixed = written(mixed.select("key", "digest", "n", "x.*"), "mixed")
    wanted = mixed.groupBy("text_id", "n_bytes").agg(
        F.collect_list(F.struct("key", "digest", "start", "windows")).alias("wanted")
    )
    wanted = written(wanted, "wanted")
    found = texts.join(wanted, ["text_id", "n_bytes"]).select("text", "wanted")
    contents = found.mapInArrow(_contents(length), "key long, digest long, content binary")
    contents = written(contents, "contents").dropDuplicates(["key", "digest"])
    wide = written(mixed.groupBy("key").count().where(F.col("count") > wide_key).select("key"), "wide")
    narrow = contents.join(wide, "key", "left_anti").repartition("key").sortWithinPartitions("key")
    spans = narrow.mapInArrow(_sorted_keys(length), f"key long, digest long, spans {_SPANS}")
    spans = spans.unionByName(_wide_spans(contents.join(wide, "key", "left_semi"), length))
    # A piece that occurs twice is repeated as a whole; of the others, what the sorting found.
    partly = spans.join(mixed.where("n = 1").select("key", "digest"), ["key", "digest"])
    partly = written(partly.where(F.size("spans") > 0), "spans")
    whole = F.struct(
        F.col("start").alias("from"), (F.col("start") + F.col("windows") + (length - 1)).alias("to")
    )
    place = lambda df, span: df.select("text_id", "n_bytes", span.alias("span"))
    twice = mixed.where("n > 1").select("key", "digest")
    rows = place(shared.where("same"), whole)
    rows = rows.unionByName(place(shared.where("NOT same").join(written(twice, "twice"), ["key", "digest"]), whole))
    moved = F.struct(
        (F.col("start") + F.col("s.from")).alias("from"), (F.col("start") + F.col("s.to")).alias("to")
    )
    inner = shared.where("NOT same").join(partly, ["key", "digest"]).withColumn("s", F.explode("spans"))
    rows = rows.unionByName(place(inner, moved))
    return rows.groupBy("text_id", "n_bytes").agg(F.collect_set("span").alias("spans"))


def without_repeats(docs: DataFrame, length: int = LENGTH, with_text: bool = False, **how) -> DataFrame:
    """One row per document: n_bytes, n_removed, n_spans, kept_sha256, spans, and the kept bytes if asked."""
    spans = written(repeated_spans(docs, length, **how), "repeated")
    rows = _texts(docs).join(spans, ["text_id", "n_bytes"], "left").select("doc_id", "text", "spans")
    schema = (
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
        f"spans {_SPANS}" + (", kept binary" if with_text else "")
    )
    return rows.mapInArrow(_cut_out(with_text), schema)
