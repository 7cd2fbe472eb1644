"""Operators without SQL against plain Python on small tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from affinia.llm import decontam, language, mixing, neardup, pii, quality, simhash, suffixdup
from affinia.llm import toxicity

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _edited(words, rng, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(40)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def copies(prose):
    """A large loose group of near copies, exact copies, a passage that all share, and short texts."""
    rng = random.Random(5)
    base, passage = prose(1, 150).split(), prose(2, 45)
    rows = [(1000 + i, _edited(base, rng, rng.randrange(6)), "en", "a") for i in range(150)]
    rows += [(2000 + i, f"{prose(100 + i, 60)} {passage} {prose(400 + i, 60)}", "en", "a") for i in range(120)]
    rows += [(3000 + i, " ".join(base).upper(), "en", "a") for i in range(30)]
    rows += [(4000 + i, "one two three", "en", "a") for i in range(3)] + [(4010, "one two", "en", "a")]
    for i in range(20):
        words = prose(900 + i, 90).split()
        rows += [(5000 + 10 * i + j, _edited(words, rng, j), "en", "a") for j in range(4)]
    return rows


def _shingles(text):
    words = SPACED.findall(text.translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def test_near_duplicates(spark, docs_of, copies):
    sets = {i: _shingles(text) for i, text, _, _ in copies}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    expected = {(i, len(sets[i]), find(i), find(i) == i) for i in ids}
    rows = neardup.near_duplicates(docs_of(copies)).drop("text_id").collect()
    assert {tuple(row) for row in rows} == expected
    kept = neardup.kept_documents(docs_of(copies + copies[:5])).collect()
    assert sorted(row["doc_id"] for row in kept) == [i for i in ids if find(i) == i]


def _repeats(texts, length):
    windows = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    for text in texts:
        covered = np.zeros(len(text) + 1, int)
        for i in range(len(text) - length + 1):
            if windows[text[i : i + length]] > 1:
                covered[i] += 1
                covered[i + length] -= 1
        gone = np.cumsum(covered)[:-1] > 0
        left = bytes(b for b, g in zip(text, gone) if not g)
        runs = int(np.count_nonzero(gone & ~np.append(False, gone[:-1])[: len(gone)]))
        yield len(text), int(gone.sum()), runs, hashlib.sha256(left).hexdigest()


@pytest.mark.parametrize("wide_key", [1, 30_000])
def test_repeated_strings(docs_of, prose, wide_key):
    rng = random.Random(8)
    passage = prose(7, 60)
    texts = [f"{prose(i, 40)} {passage[rng.randrange(40) :]} {prose(50 + i, 30)}" for i in range(25)]
    texts += ["abc" * 200, "abc" * 90, "x" * 700, "é" * 150, "é" * 150, prose(3, 80), prose(3, 80), "", passage]
    texts += [prose(5, 50) * 2, passage[:199], passage[:200]]
    rows = [(i, t, "en", "a") for i, t in enumerate(texts)]
    expected = list(_repeats([t.encode() for t in texts], 200))
    found = suffixdup.without_repeats(docs_of(rows), with_text=True, wide_key=wide_key).collect()
    names = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert [tuple(row[n] for n in names) for row in sorted(found, key=lambda r: r["doc_id"])] == expected
    assert all(hashlib.sha256(row["kept"]).hexdigest() == row["kept_sha256"] for row in found)


def test_suffixes_share_a_prefix_only_if_equal():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 99, 4000).astype(np.uint8)
    data[1000:1400] = data[200:600]
    data[2000:2300] = data[1100:1400]
    suffixes = np.arange(len(data) - 64)
    groups = np.zeros(len(suffixes), int)
    text = data.tobytes()
    for length, shallow in ((64, 16), (64, 64), (24, 8)):
        counts = Counter(text[i : i + length] for i in suffixes)
        expected = [counts[text[i : i + length]] > 1 for i in suffixes]
        assert suffixdup.repeated_suffixes(data, suffixes, groups, length, shallow).tolist() == expected


@pytest.mark.parametrize("part_bytes", [200, 1 << 20])
def test_decontamination(docs_of, benchmark_of, prose, part_bytes):
    rng = random.Random(4)
    items = [(i, prose(i, rng.randrange(12, 40))) for i in range(20)] + [(30, "Ba ke"), (31, None), (32, prose(1, 15))]
    rows = []
    for i in range(60):
        words = prose(100 + i, 80).split()
        item = items[rng.randrange(20)][1].split()
        cut = item[rng.randrange(3) : rng.randrange(8, len(item) + 1)]
        rows.append((i, " ".join(words[:30] + [w.upper() for w in cut] + words[30:]) + ",Ba-KE" * (i % 7 == 0), "en", "a"))
    rows.append((100, None, "en", "a"))
    windows = {}
    for item, text in items:
        words = ALNUM.findall((text or "").translate(LOWER))
        size = min(10, len(words))
        for i in range(len(words) - size + 1 if words else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add(str(item))
    expected = {}
    for i, text, _, _ in rows:
        words = ALNUM.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for size in {len(w) for w in windows}:
            for j in range(len(words) - size + 1):
                if got := windows.get(tuple(words[j : j + size])):
                    found |= got
                    hit |= set(range(j, j + size))
        expected[i] = (len(words), len(hit), sorted(found), bool(hit))
    old, decontam.PART_BYTES = decontam.PART_BYTES, part_bytes
    try:
        found = decontam.decontamination(docs_of(rows), benchmark_of(items)).collect()
        clean = decontam.clean_documents(docs_of(rows), benchmark_of(items)).collect()
    finally:
        decontam.PART_BYTES = old
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in found} == expected
    assert {r["doc_id"] for r in clean} == {i for i, x in expected.items() if not x[3]}


def test_edited_texts_and_search(docs_of, prose, monkeypatch):
    monkeypatch.setattr(simhash, "ROWS_IN_BUCKET", 7)
    rows = [(i * 3, prose(i, 5 + i), "en", "a") for i in range(40)] + [(500, None, "en", "a")]
    found = {r["doc_id"]: r for r in simhash.edited_fingerprints(docs_of(rows)).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    alike = lambda a, b: 1 - (int(a, 16) ^ int(b, 16)).bit_count() / simhash.BITS
    for (i, text, _, _), (j, after, _, _) in zip(order, order[1:] + order[:1]):
        text, after = text or "", after or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        row = found[i]
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert row["n_chars"] == len(text)
        assert row["near_next"] == alike(row["fingerprint"], found[j]["fingerprint"])
        assert row["near_edited"] == alike(row["fingerprint"], row["edited_fingerprint"])
    near = np.mean([r["near_edited"] > r["near_next"] for r in found.values()])
    assert near > 0.9
    prints = simhash.fingerprints(docs_of(rows))
    values = {r["fingerprint"] for r in prints.collect()}
    for radius, agreeing in ((0, 1), (3, 2), (20, 2)):
        pairs = simhash.within_radius(prints, prints, radius, agreeing)
        pairs = {(r["query"], r["fingerprint"]) for r in pairs.collect()}
        assert pairs == {(a, b) for a in values for b in values if alike(a, b) >= 1 - radius / simhash.BITS}
    some = prints.where("doc_id % 2 = 0")
    for row in simhash.neighbours(some, prints.unionByName(prints), 20).collect():
        near = [v for v in values if alike(v, row["fingerprint"]) >= 1 - 20 / simhash.BITS]
        assert (row["n_fingerprints"], row["n_documents"]) == (len(near), 2 * len(near))


def test_personal_data():
    plain = {
        "Mail a.b@c.de, or x@y.zz@q.rs": [("email", 5, 13), ("email", 18, 24)],
        "1.2.3.4.5.6.7.8 and 1.2.3.256": [("ip", 0, 7), ("ip", 8, 15)],
        "4111 1111-1111 1111 and 4111111111111112": [("card", 0, 19)],
        "+1 (499) 555-6503. +12": [("phone", 0, 17)],
        "@b.c 12345": [],
    }
    for text, expected in plain.items():
        assert pii.plain(text) == expected, text
        assert pii.disguised(text, pii.plain(text)) == []
    hidden = {
        "to bob [at] example [dot] com.": "bob [at] example [dot] com",
        "jane at mail dot example dot org": "jane at mail dot example dot org",
        "bоb@exаmple.com": "bоb@exаmple.com",
        "call plus four nine one seven six five five five one two three!": (
            "plus four nine one seven six five five five one two three"
        ),
        "é １９２.168.0.1": "１９２.168.0.1",
        "192[.]168[.]0[.]1": "192[.]168[.]0[.]1",
        "one nine two dot one six eight dot zero dot one": "one nine two dot one six eight dot zero dot one",
        "jane.doe at example.com": "jane.doe at example.com",
        "BOB@example DOT com": "BOB@example DOT com",
    }
    for text, expected in hidden.items():
        (found,) = pii.disguised(text, pii.plain(text))
        assert text[found[1] : found[2]] == expected
        assert expected not in pii.masked(text)
    for text in ("we met at noon", "one of two or three six times", "at home dot com", "meet at example.com"):
        assert pii.disguised(text, []) == []


def test_spoken_signs_without_adjacent_spelled_digits():
    hidden = {
        "host is 192 dot 168 dot 1 dot 10": ("ip", "192 dot 168 dot 1 dot 10"),
        "eight dot eight dot eight dot eight": ("ip", "eight dot eight dot eight dot eight"),
        "at one nine two.168.zero.one now": ("ip", "one nine two.168.zero.one"),
        "one[dot]two[dot]three[dot]four": ("ip", "one[dot]two[dot]three[dot]four"),
        "call plus 49 176 5551 2345": ("phone", "plus 49 176 5551 2345"),
    }
    for text, (kind, expected) in hidden.items():
        ((found, start, end),) = pii.disguised(text, pii.plain(text))
        assert (found, text[start:end]) == (kind, expected)
        assert expected not in pii.masked(text)
    assert pii.normalised("five five fıve fİve").text == "5555"
    for text in ("plus 3 dot 5", "one dot two dot three", "plus one two three", "3 plus 4 dot 5"):
        assert pii.disguised(text, []) == []


def test_the_gate_passes_all_that_spelled_runs_would_rewrite():
    rng = random.Random(11)
    words = ["one", "Sıx", "ZÉRO", "7", "42", "dot", "plus", "Dot", "one2", "x", "a1", "3b", "é", "_"]
    signs = [" ", " ", " ", " ", "-", ".", "", "/", ", ", "(", " dot ", "\n"]
    rewritten = 0
    for _ in range(50_000):
        text = "".join(rng.choice(words) + rng.choice(signs) for _ in range(rng.randrange(2, 8)))
        edits = [edit for m in pii._SPELLED_RUN.finditer(text) for edit in pii._spell(m)]
        rewritten += bool(edits)
        assert pii._has_spelled_run(text) or not edits, text
    assert rewritten > 5_000


def test_rewriting_keeps_the_source():
    rng = random.Random(1)
    for _ in range(200):
        source = "".join(rng.choice("abcd") for _ in range(30))
        mapped = pii.Mapped(source)
        for letter, new in (("a", "y"), ("b", ""), ("y", "z"), ("dd", "x")):
            edits = [(m.start(), m.end(), new) for m in re.finditer(letter, mapped.text)]
            mapped = mapped.rewrite(edits)
        assert mapped.text == source.replace("a", "z").replace("b", "").replace("dd", "x")
        for i, c in enumerate(mapped.text):
            start, end, touched = mapped.source(i, i + 1)
            assert source[start:end].replace("b", "") == {"x": "dd", "z": "a"}.get(c, c)
            assert touched == (c in "xz")


def test_segments_are_those_of_the_quadratic_search():
    rng = random.Random(2)
    for _ in range(100):
        scores = [rng.choice([-3, -2, -1, 1, 2, 3]) for _ in range(40)]
        sums = np.concatenate([[0], np.cumsum(scores)])
        runs = [i for i in range(40) if scores[i] > 0]
        found = toxicity.maximal_segments([sums[i] for i in runs], [sums[i + 1] for i in runs])
        # Every maximal segment: all of its proper prefixes and suffixes have positive sums.
        spans = [(runs[a], runs[b] + 1) for a, b in found]
        good = {
            (i, j)
            for i in range(40)
            for j in range(i + 1, 41)
            if all(sums[k] > sums[i] for k in range(i + 1, j + 1)) and all(sums[k] < sums[j] for k in range(i, j))
        }
        largest = {s for s in good if not any(t != s and t[0] <= s[0] and s[1] <= t[1] for t in good)}
        assert set(spans) == largest


def _held(doc_id, folds, remainder):
    return zlib.crc32(str(doc_id).encode()) % folds == remainder


def test_classifiers_on_held_out_rows(docs_of, labels_of, prose):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(400):
        words = prose(i, 60).split()
        toxic, bad = i % 4 == 0, i % 3 == 0
        if toxic:
            for _ in range(3):
                words[rng.randrange(60)] = rng.choice(["vileness", "vilely", "rotter"])
        text = " ".join(w.upper() + "!!" for w in words) if bad else " ".join(words)
        rows.append((i, text, None, "a"))
        labels.append((i, int(not bad), int(toxic)))
    truth = {i: (q, t) for i, q, t in labels}
    found = quality.quality(docs_of(rows), labels_of(labels)).collect()
    assert all(r["held_out"] == _held(r["doc_id"], 3, 1) for r in found)
    assert np.mean([r["predicted"] == truth[r["doc_id"]][0] for r in found if r["held_out"]]) > 0.95
    found = toxicity.toxicity(docs_of(rows), labels_of(labels)).collect()
    assert all(r["held_out"] == _held(r["doc_id"], 5, 0) for r in found)
    assert np.mean([r["predicted"] == truth[r["doc_id"]][1] for r in found if r["held_out"]]) > 0.95
    texts = {i: t for i, t, _, _ in rows}
    for r in found:
        for span in r["passages"]:
            assert "vile" in texts[r["doc_id"]][span["start"] : span["end"]].lower() or "rotter" in (
                texts[r["doc_id"]][span["start"] : span["end"]].lower()
            )


def test_clean_words_do_not_hide_a_toxic_one(docs_of, labels_of, prose):
    # The hash of each clean word begins with the same 18 bits as one of the forms of the toxic word.
    toxic, clean = "vq", "btba xdfy ksyj uqkh oqnm"
    hashes = lambda text: toxicity._tokens(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))[3]
    assert [x[0] >> np.uint64(46) for x in hashes(toxic)] == list(hashes(clean)[0] >> np.uint64(46))
    rows = [(i, f"{prose(i, 20)} {clean if i % 4 else toxic} {prose(1000 + i, 20)}", None, "a") for i in range(160)]
    found = toxicity.toxicity(docs_of(rows), labels_of([(i, 1, int(i % 4 == 0)) for i in range(160)])).collect()
    assert {r["doc_id"] for r in found if r["predicted"]} == {i for i in range(160) if i % 4 == 0}
    for r in found:
        text = rows[r["doc_id"]][1]
        assert r["predicted"] == any(toxic in text[p["start"] : p["end"]] for p in r["passages"])


def test_language_of_held_out_rows(docs_of, prose):
    swap = str.maketrans("bklmnrstvz", "pgwxyfdhcq")
    rows = []
    for i in range(120):
        text = prose(i, 8)
        rows.append((i, text.translate(swap) if i % 2 else text, "zz" if i % 2 else "yy", "a"))
    rows.append((200, "123 .,", "yy", "a"))
    found = {r["doc_id"]: r for r in language.language(docs_of(rows), size=50).collect()}
    assert (found[200]["lang_pred"], found[200]["score"]) == ("und", 0.0)
    assert all(found[i]["lang_pred"] == lang for i, _, lang, _ in rows[:-1])
    assert all(found[i]["held_out"] == _held(i, 5, 0) for i in found)


def test_mix_comes_near_its_targets(docs_of, prose):
    rng = random.Random(9)
    rows = [(i, prose(i, rng.randrange(1, 30)), "en", "abcd"[min(rng.randrange(9), 3)]) for i in range(600)]
    rows += [(1000 + i, prose(i, 5), "en", None) for i in range(50)]
    found = mixing.mix(docs_of(rows)).collect()
    sizes = {i: len(SPACED.findall(t)) for i, t, _, _ in rows}
    assert all(r["size"] == sizes[r["doc_id"]] and 0 <= r["taken"] <= 2 * r["size"] for r in found)
    by_source = {}
    for r in found:
        by_source.setdefault(r["source"], []).append(r)
    targets = {s: rs[0]["target"] for s, rs in by_source.items()}
    assert sum(targets.values()) == pytest.approx(1.5 * sum(sizes.values()))
    for source, group in by_source.items():
        assert targets[source] <= 2 * group[0]["source_size"] + 1e-6
        assert abs(sum(r["taken"] for r in group) - targets[source]) <= 15
    taken = mixing.mixed_documents(docs_of(rows)).collect()
    expected = {(r["doc_id"], r["copies"], r["taken"]) for r in found if r["copies"]}
    assert {(r["doc_id"], r["copies"], r["taken"]) for r in taken} == expected
