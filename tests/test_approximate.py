"""Similar items by hashing against the exact search."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from affinia import schemas as S
from affinia.operators import approximate, grid, nearest
from tests.conftest import tuples


def _clustered(seed, count, dims, copies=0):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(count // 25, dims))
    vectors = centres[draw.integers(0, len(centres), count)] + 0.25 * draw.normal(size=(count, dims))
    vectors[:copies] = vectors[0]
    return [(i * 7 % 10_007, [float(x) for x in v.astype(np.float32)]) for i, v in enumerate(vectors)]


@pytest.mark.parametrize("most", [2000, 40])
def test_recall_and_exact_scores(factors_of, most):
    factors = factors_of(_clustered(1, 1200, 12))
    found = approximate.top_n_approx(factors, 10, most=most)
    exact = grid.top_n(factors, factors, 10, cosine=True, skip_self=True)
    measured = approximate.recall(found, exact, ["left", "right"]).first()
    assert measured["n_exact"] == 12_000 == found.count()
    assert measured["recall"] >= 0.9
    both = found.join(exact.withColumnRenamed("score", "expected"), ["left", "right"])
    assert both.where(F.abs(F.col("score") - F.col("expected")) > 1e-12).count() == 0
    ranks = found.groupBy("left").agg(F.sort_array(F.collect_list(S.RANK)).alias("r")).select("r").distinct()
    assert tuples(ranks) == [(list(range(1, 11)),)]


def test_a_third_of_equal_vectors(factors_of):
    rows = _clustered(2, 900, 8, copies=300)
    factors = factors_of(rows)
    found = approximate.top_n_approx(factors, 5, most=100)
    exact = grid.top_n(factors, factors, 5, cosine=True, skip_self=True)
    same = {i for i, v in rows if v == rows[0][1]}
    ours, theirs = ({tuple(row) for row in x.where(F.col("left").isin(*same)).select("left", "right", "rank").collect()} for x in (found, exact))
    assert ours == theirs
    assert found.count() == exact.count() == 4500


def test_short_and_odd_tables_are_searched_exactly(factors_of, catalog_of):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, None), (6, [-1.0, 0.0])]
    factors = factors_of(rows)
    found = approximate.top_n_approx(factors, 10)
    usable = factors_of([row for row in rows if row[0] in (1, 2, 3, 6)])
    exact = grid.top_n(usable, usable, 10, cosine=True, skip_self=True)
    assert tuples(found.select("left", "right", "rank")) == tuples(exact.select("left", "right", "rank"))
    assert approximate.top_n_approx(factors_of([]), 10).count() == 0
    catalog = catalog_of([(i, f"t{i}", "g") for i in (1, 2, 6)])
    titles = approximate.similar_items_approx(factors, catalog, 2)
    assert tuples(titles.select("target_id", S.ITEM)) == [(1, 2), (1, 6), (2, 1), (2, 6), (6, 1), (6, 2)]


def test_buckets_give_short_lists_and_no_pairs(monkeypatch):
    """Buckets of 1, 2, 40 and 600 items, cut at odd places into batches."""
    monkeypatch.setattr(nearest, "CHUNK", 64)
    draw = np.random.default_rng(5)
    buckets = np.repeat(np.array([-7, 3, 9, 4], dtype=np.int64), [1, 2, 40, 600])
    ids = draw.permutation(len(buckets)).astype(np.int32)
    vectors = draw.normal(size=(len(ids), 4)).astype(np.float32)
    vectors[100:160] = vectors[100]
    rows = pa.record_batch({"bucket": buckets, "rep": ids, "features": pa.array(list(vectors))})
    cuts = [0, 2, 2, 30, 44, 300, len(ids)]
    batches = [rows.slice(lo, hi - lo) for lo, hi in zip(cuts, cuts[1:])]
    found = pa.Table.from_batches(nearest.search_buckets(iter(batches), 5)).to_pylist()
    expected = set()
    unit = vectors.astype(np.float64) / np.linalg.norm(vectors.astype(np.float64), axis=1)[:, None]
    for i in range(len(ids)):
        same = [j for j in np.flatnonzero(buckets == buckets[i]) if j != i]
        best = sorted(same, key=lambda j: (-round(float(unit[i] @ unit[j]), 9), ids[j]))[:5]
        expected |= {(int(ids[i]), int(ids[j])) for j in best}
    assert {(row["rep"], row["other"]) for row in found} == expected
    assert len(found) == len(expected) == 2 + 40 * 5 + 600 * 5


def _blocks_of(user_ids, users, item_ids, items):
    """A row of a block of users and one of items, as a task gets them."""
    columns = (user_ids.astype(np.int32), users.ravel(), item_ids.astype(np.int32), items.ravel())
    return [pa.RecordBatch.from_arrays([pa.array([c]) for c in columns], names=["a", "b", "c", "d"])]


def _lists(batches):
    return sorted(zip(*(c.to_pylist() for c in pa.Table.from_batches(list(batches)).columns)))


@pytest.mark.parametrize("kind", ["spread", "odd", "random"])
def test_exact_search_skips_cells_and_loses_nothing(kind, monkeypatch):
    """Lists equal those of all pairs, ties and vectors of length 0 included, from fewer pairs where directions allow it."""
    draw = np.random.default_rng(9)
    dims = 64 if kind == "random" else 4
    vectors = draw.normal(size=(12_000, dims)).astype(np.float32)
    if kind == "odd":
        vectors[:40], vectors[3000:5000], vectors[5000:5050] = 0, vectors[3000], vectors[5000:5050] * np.float32(1e-30)
    ids = draw.permutation(len(vectors)) * 3
    users = np.concatenate([np.arange(0, 12_000, 20), np.arange(10), np.arange(3000, 3010)])
    products = [0]
    visit = nearest.Cells._visit

    def visited(items, found, rows, lo, hi):
        products[0] += len(rows) * (hi - lo)
        visit(items, found, rows, lo, hi)

    monkeypatch.setattr(nearest.Cells, "_visit", visited)
    blocks, parts = ([x[i : i + step] for i in range(0, len(x), step)] for x, step in ((users, 300), (np.arange(len(ids)), 5000)))
    rows = [row for mine in blocks for part in parts for row in _blocks_of(ids[mine], vectors[mine], ids[part], vectors[part])]
    found = _lists(nearest.search_blocks(iter(rows), 10, dims, True, True))
    expected = []
    for mine in blocks:
        best = nearest._Best(ids[mine], vectors[mine], 10)
        best.add(nearest.ItemSlice(ids, vectors, True), True)
        expected.append(best.found())
    assert found == _lists(expected) and len(found) == 10 * len(users)
    if kind == "spread":
        assert 0 < products[0] < 0.25 * len(users) * len(ids)


def test_blocks_of_users_with_other_items(monkeypatch):
    """A task keeps the items of one block of users for the next, which may meet fewer, others or more of them."""
    monkeypatch.setattr(nearest, "_CELL", 16)
    draw = np.random.default_rng(4)
    ids, vectors = draw.permutation(900), draw.normal(size=(900, 3)).astype(np.float32)
    meets = [(0, 1, 2), (0, 1, 2), (0, 1), (0, 2), (1,), (1, 2, 0), (1, 2, 0)]
    rows, expected = [], []
    for number, parts in enumerate(meets):
        mine = np.arange(number * 50, number * 50 + 50)
        items = np.concatenate([np.arange(300 * k, 300 * k + 300) for k in parts])
        for k in parts:
            part = np.arange(300 * k, 300 * k + 300)
            rows += _blocks_of(ids[mine], vectors[mine], ids[part], vectors[part])
        best = nearest._Best(ids[mine], vectors[mine], 5)
        best.add(nearest.ItemSlice(ids[items], vectors[items], True), True)
        expected.append(best.found())
    assert _lists(nearest.search_blocks(iter(rows), 5, 3, True, True)) == _lists(expected)


def test_query_searches_all_pairs_once(spark, monkeypatch):
    """Recall and exactness read one result of the exact search, which is most of the query's work."""
    import __spark_entry__ as entry

    labels, keep = [], entry.written
    monkeypatch.setattr(entry, "written", lambda df, label, *how: labels.append(label) or keep(df, label, *how))
    row = entry.queries()["similar_items_approx"](spark, entry.SMOKE_DIR).first()
    assert row["n_rows"] > 0 and row["exact_scores"]
    assert labels.count("exact") == 1
