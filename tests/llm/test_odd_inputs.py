"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

import sys
from math import comb
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from affinia.llm import decontam, language, mixing, neardup, pii, quality, simhash, suffixdup
from affinia.llm import toxicity, urls

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline  # noqa: E402

LABELS = [(4, 1, 0), (4, 1, 0), (5, 0, 1), (5, 1, 0), (8, 0, 1), (None, 1, 1), (9, None, None), (10, 0, 0)]
ITEMS = [(1, "ba ke li"), (1, "mo nu"), (2, None), (3, ""), (None, "ra se"), (4, "x")]

PER_ROW = {
    "quality": lambda d, labels, items: quality.quality(d, labels),
    "language": lambda d, labels, items: language.language(d),
    "neardup": lambda d, labels, items: neardup.near_duplicates(d),
    "toxicity": lambda d, labels, items: toxicity.toxicity(d, labels),
    "decontam": lambda d, labels, items: decontam.decontamination(d, items),
    "mixing": lambda d, labels, items: mixing.mix(d),
    "simhash": lambda d, labels, items: simhash.edited_fingerprints(d),
    "fingerprints": lambda d, labels, items: simhash.fingerprints(d),
    "suffixdup": lambda d, labels, items: suffixdup.without_repeats(d, with_text=True),
    "pii": lambda d, labels, items: pii.findings(d),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_for_every_document(name, odd_docs, odd_rows, labels_of, benchmark_of):
    found = PER_ROW[name](odd_docs, labels_of(LABELS), benchmark_of(ITEMS)).collect()
    assert sorted(str(row["doc_id"]) for row in found) == sorted(str(row[0]) for row in odd_rows)


@pytest.mark.parametrize("name", PER_ROW)
def test_empty_tables(name, odd_docs, labels_of, benchmark_of):
    none = odd_docs.limit(0)
    assert PER_ROW[name](none, labels_of([]), benchmark_of([])).collect() == []


@pytest.mark.parametrize("name", ["quality", "toxicity"])
def test_without_labels_all_scores_are_equal(name, odd_docs, labels_of):
    found = PER_ROW[name](odd_docs, labels_of([]), None).collect()
    assert len({row["score"] for row in found}) == 1


def test_scores_stay_in_range_and_equal_texts_agree(odd_docs, odd_rows, labels_of):
    for name in ("quality", "toxicity", "language"):
        scores = [row["score"] for row in PER_ROW[name](odd_docs, labels_of(LABELS), None).collect()]
        assert all(0 <= score <= 1 for score in scores)


def test_pages_with_odd_urls(spark):
    rows = [(1, None), (1, None), (None, "http://a.com/x"), (2, ""), (3, "x://" + "y" * 50_000), (4, "://")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    pages = pages.withColumns({name: F.lit(1) for name in ("host", "path", "label", "grams", "features")})
    found = {(row["page_id"], row["host"][:3], row["path"], row["verdict"]) for row in urls.verdicts(pages).collect()}
    assert found == {
        (1, "", "", "allow"), (2, "", "", "allow"), (3, "yyy", "", "allow"), (4, "", "", "allow"),
        (None, "a.c", "/x", "allow"),
    }
    assert urls.verdicts(pages.limit(0)).collect() == []


def _write(spark, folder, **tables):
    for name, table in tables.items():
        table.write.parquet(f"{folder}/{name}.parquet")


def test_pipeline_stages(spark, tmp_path, odd_docs, labels_of, benchmark_of):
    items = benchmark_of([(1, "x"), (2, None)])
    clean = labels_of([(i, 1, 0) for i in range(1, 12)])
    _write(spark, tmp_path, documents=odd_docs, labels=clean, benchmark=items)
    docs = odd_docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.schema.names == odd_docs.schema.names, name
    left = corpus_pipeline.run(spark, str(tmp_path))
    ids = [row["doc_id"] for row in left.collect()]
    assert 9 not in ids and None in ids
    assert len([i for i in ids if i == 4]) <= 1


def test_the_stage_for_copies_takes_four_fifths(spark, docs_of, prose):
    rows = []
    for i in range(0, 60, 2):
        words = prose(i, 200).split()
        edited = ["edited" if at in (30, 80, 130, 180) else word for at, word in enumerate(words)]
        rows += [(i, " ".join(words), "en", "a"), (i + 1, " ".join(edited), "en", "a")]
    # 176 of 216 shingles are common: 0.81.
    kept = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs_of(rows), "").collect()
    assert sorted(row["doc_id"] for row in kept) == list(range(0, 60, 2))
    assert all(row["kept"] for row in neardup.near_duplicates(docs_of(rows)).collect())
    for s in (0.8, 0.85, 0.9):
        for values in (neardup.LISTED, neardup.SKETCH):
            least = neardup._least_common(values, s)
            below = [comb(values, n) * s**n * (1 - s) ** (values - n) for n in range(least + 1)]
            assert sum(below[:-1]) <= neardup.RISK < sum(below)


def test_pipeline_stages_on_empty_tables(spark, tmp_path, odd_docs, labels_of, benchmark_of):
    none = odd_docs.limit(0)
    _write(spark, tmp_path, documents=none, labels=labels_of([]), benchmark=benchmark_of([]))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_rules_for_urls(spark):
    expected = {
        "https://shop.example.com/en/1": ("example.com/en/", "block"),
        "https://www.example.com/en/1": ("www.example.com/en/", "allow"),
        "http://a.www.EXAMPLE.com/en/?q#f": ("www.example.com/en/", "allow"),
        "http://example.com/de/": ("com/", "allow"),
        "http://x.net/es/": ("net/es/", "block"),
        "http://net/fr/1": ("net/fr/", "block"),
        "http://xnet/fr/1": (None, None),
        "http://a.com": (None, None),
        "http://a.com?/en/": (None, None),
    }
    pages = spark.createDataFrame(list(enumerate(expected)), "page_id long, url string")
    found = urls.verdicts(pages).orderBy("page_id").collect()
    for row, (rule, verdict) in zip(found, expected.values()):
        assert row["rule"] == rule and (verdict is None or row["verdict"] == verdict)
    casino = spark.createDataFrame([(1, "http://best-casino-slots.org/x"), (2, "http://city-museum.org/x")], "page_id long, url string")
    assert [r["verdict"] for r in urls.verdicts(casino).orderBy("page_id").collect()] == ["block", "allow"]
