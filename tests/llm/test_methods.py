"""The methods behind trained and hashed results, step by step in plain Python; hot keys; rows without id."""

import hashlib
import random
import re
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from affinia.llm import decontam, language, mixing, neardup, pii, quality, simhash, suffixdup
from affinia.llm import toxicity, url_table, urls
from affinia.llm.arrays import utf8

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline  # noqa: E402

STAGES = dict(corpus_pipeline.STAGES)


def _flat(texts):
    return utf8(pa.array(texts, pa.string()))


def test_network_against_a_convolution_without_tables(prose):
    rng = np.random.default_rng(3)
    net = quality.Network(
        rng.normal(size=(quality.SYMBOLS, quality.EMBEDDED)),
        rng.normal(size=(quality.WIDTH, quality.EMBEDDED, quality.FILTERS)),
        rng.normal(size=quality.FILTERS),
        rng.normal(size=quality.FILTERS),
        0.3,
    )
    net.embedding[quality.PAD] = 0
    net.tabulate()
    texts = ["", "a", prose(1, 20), "x x x " * 30, prose(2, 300), prose(3, 40) * 5]
    found = quality.probabilities(net, *_flat(texts))
    for text, p in zip(texts, found):
        laid = quality.layout(*_flat([text]))
        symbols = laid.symbols[: len(text.encode()) + quality.WIDTH - 1]
        n = len(text.encode())
        response = np.zeros((max(n, 1), quality.FILTERS))
        for i in range(n):
            seen = [net.embedding[s] for s in symbols[i : i + quality.WIDTH]]
            total = sum(seen[j] @ net.filters[j] for j in range(len(seen))) + net.bias
            response[i] = np.maximum(total, 0)
        last = max(-(-n // quality.STRIDE), 1)
        chunks = []
        for block in range(last):
            end = min(block * quality.STRIDE + quality.CHUNK, max(n, 1)) if block < last - 1 else max(n, 1)
            part = response[block * quality.STRIDE : end]
            chunks.append(part.sum(axis=0) / max(min(end, n) - block * quality.STRIDE, 1))
        pooled = np.max(chunks, axis=0)
        assert p == pytest.approx(1 / (1 + np.exp(-(pooled @ net.output + net.intercept))), abs=1e-4)


def test_quality_learns_from_long_documents_alone(docs_of, labels_of, prose):
    rows, labels = [], []
    for i in range(90):
        text = prose(i, 2600)
        rows.append((i, text if i % 2 else re.sub(r"\b(\w+) (\w+)\b", r"\1 \1!!", text), None, "a"))
        labels.append((i, i % 2, 0))
    assert min(len(text) for _, text, _, _ in rows) > 9_000
    found = quality.quality(docs_of(rows), labels_of(labels)).collect()
    held = [r for r in found if r["held_out"]]
    assert np.mean([r["predicted"] == r["doc_id"] % 2 for r in held]) > 0.95
    few = quality.fit(docs_of(rows), labels_of(labels), sample_bytes=1)  # at least one document of each label
    assert np.abs(few.output).sum() > 0


def test_out_of_place_distance(docs_of, prose):
    rows = [(i, prose(i, 30).translate(str.maketrans("bklm", shift)), lang, "a")
            for lang, shift in (("aa", "bklm"), ("bb", "cdfg"), ("cc", "pqxy")) for i in range(6)]
    rows = [(n, *row[1:]) for n, row in enumerate(rows)] + [(99, "Mixed BA ké text", None, "a")]
    size = 60

    def grams(text):
        text = "".join(c if c.isalpha() else " " for c in text.lower())
        text = " " + " ".join(text.split()) + " "
        every = [c for c in text if c != " "] + [text[i : i + n] for n in (2, 3) for i in range(len(text) - n + 1)]
        return Counter(every)

    def packed(gram):
        return sum(ord(c) << (21 * i) for i, c in enumerate(reversed(gram)))

    def profile(counts):
        first = sorted(counts, key=lambda g: (-counts[g], packed(g)))[:size]
        return {gram: rank for rank, gram in enumerate(first)}

    learned = {}
    for i, text, lang, _ in rows:
        if lang and zlib.crc32(str(i).encode()) % 5:
            learned.setdefault(lang, Counter()).update(grams(text))
    profiles = {lang: profile(counts) for lang, counts in learned.items()}
    found = {r["doc_id"]: r for r in language.language(docs_of(rows), size=size).collect()}
    for i, text, _, _ in rows:
        own = profile(grams(text))
        apart = sorted(
            (sum(min(abs(p[g] - r), size) if g in p else size for g, r in own.items()), lang) for lang, p in profiles.items()
        )
        assert found[i]["lang_pred"] == apart[0][1]
        assert found[i]["score"] == pytest.approx(apart[1][0] / (apart[0][0] + apart[1][0]))


def test_ties_of_languages_and_many_languages(docs_of, prose):
    rows = [(i, prose(1, 20), f"l{i % 3}", "a") for i in range(60)]
    assert {r["lang_pred"] for r in language.language(docs_of(rows)).collect()} == {"l0"}
    rows = [(i, chr(0x4E00 + i % 2500) * 3, f"l{i % 2500:04d}", "a") for i in range(10_000)]
    found = language.language(docs_of(rows)).collect()
    right = [r["lang_pred"] == f"l{r['doc_id'] % 2500:04d}" for r in found]
    assert np.mean(right) > 0.99


def test_evidence_takes_all_segments_in_fit_and_score(docs_of, labels_of, prose):
    rows, labels = [], []
    for i in range(60):
        words = prose(i, 9_000).split()
        if i % 3 == 0:
            words[::100] = ["zzvile"] * 90
        rows.append((i, " ".join(words), None, "a"))
        labels.append((i, 1, int(i % 3 == 0)))
    model = toxicity.fit(docs_of(rows), labels_of(labels))
    find = toxicity._finder(model.tokens)
    data, offsets = _flat([text for _, text, _, _ in rows])
    most = 0
    scored = {r["doc_id"]: r for r in toxicity.score(docs_of(rows), model).collect()}
    for (i, _, _, _), (count, found) in zip(rows, toxicity._segments(data, offsets, model, find)):
        raw = np.array([s for _, _, s in found])
        most = max(most, len(raw))
        expected = toxicity._evidence(model.rate * raw - model.log_k - np.log(max(count, 1)))
        assert scored[i]["evidence"] == pytest.approx(expected)
        x = model.intercept + model.slope * min(expected, toxicity.SATURATED)
        assert scored[i]["score"] == pytest.approx(1 / (1 + np.exp(-x)))
    assert most > 64


def test_votes_of_signed_terms(prose):
    texts = ["", "one", "a b a b a b", prose(1, 40), prose(2, 700), "ß é 漢字 a"]
    bits = simhash.fingerprint_bits(*_flat(texts))
    from affinia.llm.arrays import NOT_SPACE, U64, mix, span_hashes, words

    for text, row in zip(texts, bits):
        data, offsets = _flat([text])
        starts, ends, _ = words(data, offsets, NOT_SPACE)
        hashes = [int(x) for x in span_hashes(data, starts, ends, lower=True)]
        mixed = lambda x: int(mix(np.array([x], U64))[0])
        votes = Counter()
        for before, word in zip([1, *hashes], hashes):
            term = (word + mixed(before) * 0xC2B2AE3D27D4EB4F) % 2**64
            for half in range(simhash.BITS // 64):
                value = mixed((term + int(simhash._HALF_SEEDS[half])) % 2**64).to_bytes(8, "little")
                for place, byte in enumerate(value):
                    for bit in range(8):
                        votes[half * 64 + place * 8 + bit] += 1 if byte >> (7 - bit) & 1 else -1
        expected = [int(votes[i] > 0) for i in range(simhash.BITS)]
        assert np.unpackbits(row).tolist() == expected


def test_edits_of_rows_without_id_and_of_equal_rows(docs_of, prose, monkeypatch):
    monkeypatch.setattr(simhash, "ROWS_IN_BUCKET", 5)
    rows = [(None, prose(i, 9), "en", "a") for i in range(40)] + [(7, prose(i, 9), "en", "a") for i in range(20)]
    rows += [(3, "same text here", "en", "a")] * 30 + [(None, None, "en", "a")] * 5
    found = simhash.edited_fingerprints(docs_of(rows).repartition(3)).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(r[0] for r in rows)
    edit = lambda a, b: hashlib.sha256((a[: len(a) - len(a) // 3] + b[: len(a) // 3]).encode()).hexdigest()
    same = [r["edited_sha256"] for r in found if r["doc_id"] == 3]
    assert sorted(Counter(same).values()) == [1, 29]
    assert edit("same text here", "same text here") in same
    # Every document is the next one of as many as there are of it.
    texts = [t or "" for _, t, _, _ in rows]
    possible = {edit(a, b) for a in texts for b in texts}
    assert all(r["edited_sha256"] in possible for r in found)
    assert simhash.edited_fingerprints(docs_of([])).collect() == []


def test_neighbours_of_odd_rows(odd_docs, odd_rows):
    prints = simhash.fingerprints(odd_docs)
    found = simhash.neighbours(prints, prints, 3).collect()
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(r[0]) for r in odd_rows)
    assert all(r["n_documents"] >= r["n_fingerprints"] >= 1 for r in found)
    assert simhash.neighbours(prints.limit(0), prints, 3).collect() == []
    assert {r["n_documents"] for r in simhash.neighbours(prints, prints.limit(0), 3).collect()} == {0}


_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    doubled = [int(d) * (2 if i % 2 else 1) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def _by_patterns(text):
    for kind, pattern in _PATTERNS.items():
        for match in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", match[0])
            good = {
                "email": True,
                "ip": all(int(part) <= 255 for part in match[0].split(".")) if kind == "ip" else False,
                "card": 16 <= len(digits) <= 19 and _luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                yield kind, match.start(), match.end()


def test_base_findings_are_those_of_the_patterns():
    rng = random.Random(13)
    pieces = ["@", ".", "-", "+", " ", "  ", "(", ")", "a", "b.c", "x@y.z", "1", "255", "256", "1.2.3.4", "00", "é", "_%",
              "4111111111111111", "4111 1111 1111 1111", "+4912345", "+1 (499) 555", "@a-.b", "..", "0001", "\n"]
    found = 0
    for _ in range(20_000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 14)))
        expected = list(_by_patterns(text))
        assert pii.plain(text) == expected, text
        found += len(expected)
    assert found > 5_000


def test_default_table_of_urls_owes_nothing_to_the_pages(spark):
    hosts = {host for host, _, _ in url_table.rows()}
    assert len(hosts) > 400
    names = {label for host in hosts for label in host.split(".")[:-1]} - {"www", "web"}
    words = {word for topics in (url_table.BLOCKED, url_table.ALLOWED) for names, _ in topics.values() for word in names.split()}
    for folder in ("sf0.001", "sf0.01"):
        pages = spark.read.parquet(f"/root/testdata/{folder}/pages.parquet")
        seen = pages.select(urls.host_of(F.col("url")).alias("host")).distinct().collect()
        for row in seen:
            labels = row["host"].split(".")
            assert row["host"] not in hosts
            assert not set(labels) & (names | words), row["host"]


def test_urls_of_hosts_not_learned(spark):
    measured = urls.held_out(url_table.labelled(spark)).first()
    assert measured["n"] == len(url_table.rows())
    assert measured["precision"] > 0.9 and measured["recall"] > 0.85
    own = spark.createDataFrame(
        [(f"http://{name}{i}.test/a", float(name == "red")) for name in ("red", "blue") for i in range(40)] + [("http://x", None)],
        "url string, label double",
    )
    pages = spark.createDataFrame([(1, "http://red99.test/b"), (2, "http://blue99.test/b")], "page_id long, url string")
    found = urls.verdicts(pages, table=own).orderBy("page_id").collect()
    assert [row["verdict"] for row in found] == ["block", "allow"]


def test_a_group_of_copies_without_id_leaves_one(spark, docs_of, prose):
    base = prose(1, 200).split()
    near = lambda i: " ".join([*base[: 30 + i], "edited", *base[31 + i :]])
    other = prose(2, 100)
    rows = [(None, " ".join(base), "en", "a")] * 4 + [(None, near(i), "en", "a") for i in range(3)]
    rows += [(None, other, "en", "a"), (None, "", "en", "a"), (5, prose(3, 90), "en", "a"), (5, prose(4, 90), "en", "a")]
    rows += [(6, near(10), "en", "b"), (6, near(20), "en", "b"), (6, prose(8, 80), "en", "b")]
    kept = STAGES["near_duplicates"](spark, docs_of(rows), "").collect()
    texts = Counter(row["text"] for row in kept)
    copies = {" ".join(base), *map(near, (0, 1, 2, 10, 20))}
    assert sum(texts[text] for text in copies) == 1
    for text in (other, "", prose(3, 90), prose(4, 90), prose(8, 80)):
        assert texts[text] == 1


def test_names_that_clash_in_stages(spark, docs_of, prose):
    rows = [(i // 2, prose(i // 2, 60), "en", "ab"[i % 2]) for i in range(20)]
    names = ("_doc_id", "_text_id", "_plan", "_of", "key", "_key", "plan", "of", "shared", "_shared", "Copies")
    docs = docs_of(rows).withColumns({name: F.concat(F.lit("own"), "doc_id") for name in names})
    kept = neardup.kept_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(row["doc_id"] for row in kept.collect()) == list(range(10))
    assert all(row["_doc_id"] == row["key"] == f"own{row['doc_id']}" for row in kept.collect())
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == [name for name in docs.columns if name != "Copies"] + ["copies", "taken"]
    assert all(row["_plan"] == row["_of"] == f"own{row['doc_id']}" for row in mixed.collect())


def test_empty_documents_of_a_full_source_are_not_taken_more_often(docs_of, prose):
    rows = [(i, prose(i, 40), "en", "big") for i in range(80)] + [(100 + i, prose(i, 3), "en", "aa") for i in range(4)]
    rows += [(200 + i, "", "en", "aa") for i in range(30)] + [(300, None, "en", "empty")]
    found = mixing.mixed_documents(docs_of(rows)).collect()
    assert max(row["copies"] for row in found) <= mixing.MOST_REPEATS
    assert {row["copies"] for row in found if row["doc_id"] >= 200 and row["source"] == "aa"} == {2}


def test_a_key_with_many_pieces_is_cut_by_windows(docs_of, prose):
    passage = prose(77, 30)[:150]
    rows = [(i, f"{prose(i, 40)} {passage} {prose(500 + i, 40)}", "en", "a") for i in range(120)]
    rows += [(1000 + i, rows[i][1][20:400] + f" end {i}", "en", "a") for i in range(0, 120, 7)]
    wide = suffixdup.without_repeats(docs_of(rows), wide_key=5).drop("spans").collect()
    usual = suffixdup.without_repeats(docs_of(rows)).drop("spans").collect()
    assert sorted(map(tuple, wide)) == sorted(map(tuple, usual))
    assert any(row["n_removed"] for row in usual)


def test_many_parts_of_a_benchmark(docs_of, benchmark_of, prose):
    items = [(i, prose(i, 25)) for i in range(30)] + [(31, "short item"), (32, None), (None, prose(99, 20)), (3, prose(50, 30))]
    rows = [(i, f"{prose(100 + i, 20)} {prose(i % 40, 25)} tail", "en", "a") for i in range(60)]
    rows += [(i, None, "en", "a") for i in (70, 70)] + [(None, prose(4, 25), "en", "a")] * 2 + [(5, "a short item here", "en", "a")]
    docs, benchmark = docs_of(rows), benchmark_of(items).withColumns({"part": F.lit(1), "matches": F.lit(2)})
    one = decontam.decontamination(docs, benchmark).drop("matches").collect()
    clean = decontam.clean_documents(docs, benchmark).collect()
    old, decontam.PART_BYTES = decontam.PART_BYTES, 500
    try:
        many = decontam.decontamination(docs, benchmark).drop("matches").collect()
        cleaned = decontam.clean_documents(docs, benchmark).collect()
    finally:
        decontam.PART_BYTES = old
    assert Counter(map(str, many)) == Counter(map(str, one))
    assert Counter(map(str, cleaned)) == Counter(map(str, clean))
    assert any(row["n_hit"] for row in one) and not all(row["n_hit"] for row in one)


def _folders(spark):
    return set(Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")).iterdir())


def test_near_duplicates_leave_nothing_but_their_result(spark, docs_of, prose):
    rows = [(i, prose(i // 2, 80) + (" end" if i % 2 else ""), "en", "a") for i in range(40)]
    before = _folders(spark)
    found = neardup.near_duplicates(docs_of(rows))
    assert len(_folders(spark) - before) == 1
    assert sum(row["kept"] for row in found.collect()) == 20
    before = _folders(spark)
    kept = STAGES["near_duplicates"](spark, docs_of(rows), "")
    assert len(_folders(spark) - before) <= 2  # what the lazy result reads
    assert kept.count() == 20
