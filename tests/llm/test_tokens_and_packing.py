"""Resampling, alignment and packing against plain Python, and on odd inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from affinia.llm import alignment, packing, radix, resampling, tokens
from affinia.llm.arrays import utf8

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
FIRST = (tokens.ByteLevel, str(public_tokenizers.path("byte_bpe_50k.json")))
SECOND = (tokens.Pieces, str(public_tokenizers.path("piece_bpe_32k.model")))
WORDS = (tokens.WordEnds, str(public_tokenizers.path("word_bpe_49k.json")))

# What could glue two runs together, or be lost by a vocabulary.
_BITS = [
    " ", "  ", "    ", "\n", "\t", "\r\n", " ", " ", "　", "\x85", "\x1c", "\x00", "a", "B", "é", "é",
    "'s", "'", "don't", "'sup", "<|endoftext|>", "<|startoftext|>", "<s>", "<0x0A>", "漢字", "🙂", "1", "42", ".", "...", "…",
    "≠", "İ", "ΑΣ", "ﬁ", "ba", "ke-li", "mo", "http://x.y/z?a=b&c",
]


def _odd_texts(seed, count):
    rng = random.Random(seed)
    return ["".join(rng.choice(_BITS) for _ in range(rng.randint(1, 40))) for _ in range(count)]


def _whole(vocabulary, texts):
    """Ids of whole texts by the libraries themselves."""
    kind, path = vocabulary
    model = tokens.load(kind, path)
    if kind is tokens.Pieces:
        return model._model.encode(texts, num_threads=1)
    texts = [f" {x}" for x in texts] if kind is tokens.ByteLevel else texts
    return [x.ids for x in model._tokenizer.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("vocabulary", [FIRST, SECOND, WORDS], ids=["bytes", "pieces", "words"])
def test_ids_of_runs_are_those_of_whole_texts(vocabulary, prose):
    texts = _odd_texts(1, 3000) + [prose(i, 300).replace(" ka", "\nKa,") for i in range(20)]
    model = tokens.load(*vocabulary)
    cut = model.units(*utf8(pa.array(texts))) if vocabulary is WORDS else tokens.runs(*tokens.led(pa.array(texts)))
    found, codes, at = cut
    flat, starts = model.encode(found.to_pylist())
    ids = [tokens.gathered(flat, starts, codes[b:e]).tolist() for b, e in zip(at[:-1], at[1:])]
    assert ids == _whole(vocabulary, texts)


def test_byte_lengths_of_tokens():
    for vocabulary in (FIRST, SECOND):
        model = tokens.load(*vocabulary)
        text = "Ein paar Wörter, 漢字 und 🙂\n  Leerzeichen."
        assert b"".join(model.pieces[i] for i in _whole(vocabulary, [text])[0]) == f" {text}".encode()


def test_shared_cuts():
    rng = random.Random(2)
    for _ in range(500):
        n = rng.randint(1, 120)
        a = sorted(rng.sample(range(1, 2 * n + 1), n))
        b = sorted({*rng.sample(range(1, 2 * n + 1), rng.randint(1, n)), *rng.sample(a, rng.randint(0, n))})
        a, b = np.array([*a, 2 * n + 1]), np.array([*b, 2 * n + 1])
        a_cut, b_cut = alignment.shared_cuts(a, b)
        assert (a_cut == np.isin(a, b)).all() and (b_cut == np.isin(b, a)).all()
    a_cut, b_cut = alignment.shared_cuts(np.arange(2, 20_002, 2), np.r_[np.arange(1, 20_000, 2), 20_000])
    assert a_cut.sum() == b_cut.sum() == 1


def _aligned(texts):
    """Groups, links and sums of each text by walking both lists of ends."""
    models = [tokens.load(*FIRST), tokens.load(*SECOND)]
    found = []
    for text, *ids in zip(texts, *(_whole(v, [x or "" for x in texts]) for v in (FIRST, SECOND))):
        back = [b"".join(m.pieces[i] for i in x) for m, x in zip(models, ids)]
        if not text or any(x != f" {text}".encode() for x in back):
            found.append([])
            continue
        ends = [np.cumsum([len(m.pieces[i]) for i in x]).tolist() for m, x in zip(models, ids)]
        groups, begin = [], [0, 0]
        for cut in sorted({*ends[0]} & {*ends[1]}):
            upto = [e.index(cut) + 1 for e in ends]
            groups.append(tuple(tuple(x[b:u]) for x, b, u in zip(ids, begin, upto)))
            begin = upto
        found.append(groups)
    links = [[(a, b) for first, second in groups for a in first for b in second] for groups in found]
    counts = Counter(pair for doc in links for pair in set(doc))
    most = defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    for groups, doc in zip(found, links):
        names = ";".join("|".join(",".join(map(str, side)) for side in group) for group in groups)
        yield (
            sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(doc),
            hashlib.sha256(names.encode()).hexdigest() if groups else "",
            sum(counts[x] == most[x[0]] for x in doc), sum(counts[x] for x in doc),
        )


@pytest.mark.parametrize("block_bytes", [1 << 24, 3000])
def test_alignment(spark, docs_of, prose, block_bytes):
    texts = [None, "", " ", "▁", "a ▁ b", "z" * 700, " don't ", "ab " * 400, *_odd_texts(5, 300)]
    texts += [prose(i % 25, 60) for i in range(60)]
    rows = [(i, text, "en", "a") for i, text in enumerate(texts)]
    found = alignment.alignment_digests(docs_of(rows).repartition(3), FIRST, SECOND, block_bytes=block_bytes).orderBy("doc_id").collect()
    names = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum")
    assert [tuple(row[name] for name in names) for row in found] == list(_aligned(texts))


def test_groups_of_many_tokens_are_linked_by_distinct_ids():
    a, b = np.array([1, 2, 1] * 60), np.array([7, 8] * 50)
    few = [np.array([3, 4]), np.array([9])]
    group, pair, times = alignment._links(np.r_[few[0], a], np.r_[few[1], b], np.repeat([0, 1], [2, 180]), np.repeat([0, 1], [1, 100]))
    expected = Counter((g, x << 32 | y) for g, (p, q) in enumerate([few, (a, b)]) for x in p.tolist() for y in q.tolist())
    assert dict(zip(zip(group.tolist(), pair.tolist()), times.tolist())) == expected


def test_pair_counts(spark, docs_of):
    rows = alignment.aligned(docs_of([(1, "one two", "", ""), (2, "two", "", ""), (2, "two", "", "")]), FIRST, SECOND)
    found = {(row["a"], row["b"]): (row["n"], row["is_best"]) for row in alignment.pair_counts(rows).collect()}
    (a,), (b,) = (x[0] for x in (_whole(FIRST, ["two"]), _whole(SECOND, ["two"])))
    assert found[a, b] == (3, True) and len(found) == 2


def _scores(docs, items, run=1, buckets=10_000):
    def features(text):
        words = WORD.findall((text or "").translate(LOWER))
        joined = [" ".join(words[i : i + n]) for n in range(1, run + 1) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(x.encode()) % buckets for x in joined]

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text)[1])
    for text in items:
        t.update(features(text)[1])
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets))))
    for doc_id, text in docs:
        n_words, found = features(text)
        weight = sum(map(gain, found)) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        yield doc_id, n_words, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


@pytest.mark.parametrize("run", [1, 3])
def test_resampling(spark, docs_of, benchmark_of, prose, monkeypatch, run):
    monkeypatch.setattr(radix, "LEAST_PART", 16)
    docs = [(i * 1_000_003 - 10**8, prose(i % 170, 5 + i % 60).title() + " Ärger 42") for i in range(400)]
    docs += [(None, prose(3, 30)), (None, prose(4, 31)), (7, None), (8, ""), (docs[5][0], docs[5][1])]
    items = [prose(i, 40) for i in range(30)] + [None, ""]
    expected = list(_scores(docs, items, run))
    may = [x for x in expected if x[1] >= 20]
    order = sorted(may, key=lambda x: (-x[4], x[0] is None, x[0] or 0, x[2]))
    drawn = order[: len(may) * 10 // 100]
    ranks = {(x[0], x[2]): i + 1 for i, x in enumerate(drawn)}
    table = docs_of([(i, text, "en", "a") for i, text in docs]).repartition(4)
    found = resampling.resample(table, benchmark_of(list(enumerate(items))), run).collect()
    assert Counter(tuple(row)[:5] for row in found) == Counter(expected)
    assert sorted(row["rank"] for row in found if row["rank"]) == list(range(1, len(drawn) + 1))
    for row in found:
        if row["rank"] and docs[5][0] != row["doc_id"]:
            assert ranks[row["doc_id"], row["n_features"]] == row["rank"]
    kept = resampling.drawn_documents(table, benchmark_of(list(enumerate(items))), run=run).collect()
    assert {row["doc_id"] for row in kept} == {x[0] for x in drawn if x[0] is not None}


def test_radix_sort_with_one_key_on_a_third_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(radix, "LEAST_PART", 64)
    rng = random.Random(4)
    rows = [(rng.choice([5, 5, rng.randint(-(2**62), 2**62)]), rng.randint(-3, 3), i) for i in range(2000)]
    table = spark.createDataFrame(rows, "a long, b long, i long").repartition(5)
    found = radix.ranked(table, [("b", True), ("a", False), ("i", True)]).orderBy(radix.PLACE).collect()
    assert [row[radix.PLACE] for row in found] == list(range(2000))
    assert [tuple(row)[:3] for row in found] == sorted(rows, key=lambda x: (-x[1], x[0], -x[2]))
    assert radix.ranked(table.limit(0), [("a", False)]).collect() == []
    same = radix.ranked(table.where("a = 5").select("a"), [("a", False)]).collect()
    assert sorted(row[radix.PLACE] for row in same) == list(range(len(same)))


def test_bin_slack_is_least():
    rng = random.Random(6)
    for _ in range(300):
        counts = {rng.randint(1, 40): rng.randint(1, 3) for _ in range(5)}
        room = rng.randint(0, 100)
        chosen = packing.fill(counts, room)
        sums = {0}
        for length, n in counts.items():
            sums = {s + length * k for s in sums for k in range(n + 1)}
        assert sum(x * n for x, n in chosen.items()) == max(s for s in sums if s <= room)
        assert all(0 < n <= counts[x] for x, n in chosen.items())


def _packed(pieces, window):
    """Sequences of the pieces; asserts that they are gapless and not padded."""
    found = defaultdict(list)
    for row in pieces:
        found[row["sequence_id"]].append((row["offset"], row["length"], row["ids"]))
    assert sorted(found) == list(range(len(found)))
    for parts in found.values():
        size = 0
        for offset, length, ids in sorted(parts):
            assert offset == size and length == len(ids) > 0
            size += length
        assert size == window or (size < window and size & (size - 1) == 0)
    return found


@pytest.mark.parametrize("window, part_bytes", [(4096, 4 << 20), (64, 500), (512, 2000)])
def test_packing_round_trip(spark, docs_of, prose, window, part_bytes):
    texts = [None, "", "", " ", *_odd_texts(8, 60), *(prose(i, i * 3 % 97) for i in range(150)), prose(1, 9000)]
    texts += ["ba ke li mo"] * 120  # one length that a third of all documents have
    docs = docs_of([(i, text, "en", "a") for i, text in enumerate(texts)]).repartition(3)
    found = packing.pieces(docs, WORDS, window=window, part_bytes=part_bytes).collect()
    _packed(found, window)
    ids = defaultdict(list)
    for row in sorted(found, key=lambda row: (row["doc_id"], row["start"])):
        assert row["start"] == len(ids[row["doc_id"]])
        ids[row["doc_id"]] += row["ids"]
        assert row["doc_tokens"] == len(_whole(WORDS, [texts[row["doc_id"]] or ""])[0]) + 1
    expected = [[*x, packing.END_ID] for x in _whole(WORDS, [x or "" for x in texts])]
    assert [ids[i] for i in range(len(texts))] == expected
    digests = packing.pieces(docs, WORDS, window=window, digest=True).collect()
    crc = {(row["doc_id"], row["start"]): zlib.crc32(np.array(row["ids"], "<u4").tobytes()) for row in found}
    assert {(row["doc_id"], row["start"]): row["ids_crc32"] for row in digests} == crc


def test_sequences_hold_all_ids(spark, docs_of, prose):
    docs = docs_of([(i, prose(i, 200), "en", "a") for i in range(40)])
    found = packing.pieces(docs, WORDS, window=256)
    rows = packing.sequences(found).collect()
    assert sum(len(row["ids"]) for row in rows) == sum(row["length"] for row in found.collect())
    assert max(len(row["ids"]) for row in rows) == 256
    assert {i for row in rows for i in row["doc_ids"]} == set(range(40))


PER_ROW = {
    "resampling": lambda d, items: resampling.resample(d, items),
    "alignment": lambda d, items: alignment.alignment_digests(d, FIRST, SECOND),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_for_every_document(name, odd_docs, odd_rows, benchmark_of):
    items = benchmark_of([(1, "ba ke li"), (2, None), (3, "")]).withColumns({"n": F.lit(1), "bucket": F.lit(2)})
    found = PER_ROW[name](odd_docs, items).collect()
    assert sorted(str(row["doc_id"]) for row in found) == sorted(str(row[0]) for row in odd_rows)
    assert PER_ROW[name](odd_docs.limit(0), items.limit(0)).collect() == []


def test_packing_of_odd_rows(odd_docs, odd_rows):
    found = packing.pieces(odd_docs, WORDS).collect()
    _packed(found, packing.WINDOW)
    assert Counter(row["doc_id"] for row in found if row["start"] == 0) == Counter(row[0] for row in odd_rows)
    assert packing.pieces(odd_docs.limit(0), WORDS).collect() == []
