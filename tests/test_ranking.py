import math

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from affinia import schemas as S
from affinia.operators import activity, candidates, grid, lookup, nearest, recommend, scoring, similar
from affinia.plans import payloads
from tests.conftest import tuples

USERS = [(1, [1.0, 0.0]), (2, [0.0, 1.0])]
ITEMS = [(10, [3.0, 0.0]), (11, [2.0, 1.0]), (12, [2.0, 5.0]), (13, [0.0, 4.0])]
CATALOG = [(10, "ten", "A|B"), (11, "eleven", "A"), (12, "twelve", None)]
RATED = [(1, 10, 4.0, 1)]
VECTORS = [
    (1, [1.0, 0.0]),
    (2, [2.0, 0.0]),
    (3, [0.0, 1.0]),
    (4, [-1.0, 0.0]),
    (5, [0.0, 0.0]),
    (6, [1.0, 1.0]),
]


@pytest.fixture
def small(ratings_of, catalog_of, factors_of):
    return ratings_of(RATED), catalog_of(CATALOG), factors_of(USERS), factors_of(ITEMS)


def random_factors(seed, count, dims, first_id=0, copies=0):
    draw = np.random.default_rng(seed)
    vectors = draw.normal(size=(count, dims)).astype(np.float32)
    if copies:
        vectors[draw.choice(count, copies, replace=False)] = vectors[0]
    return [(first_id + i, v.tolist()) for i, v in enumerate(vectors)]


def brute_force(users, items, n, seen=frozenset(), cosine=False, skip_self=False):
    found = []
    for user, u in users:
        scored = []
        for item, v in items:
            if (user, item) in seen or (skip_self and user == item):
                continue
            score = 0.0
            for a, b in zip(u, v):
                score += a * b
            if cosine:
                length = math.sqrt(sum(a * a for a in u)) * math.sqrt(sum(b * b for b in v))
                score = score / length if length else 0.0
            scored.append((-score, item))
        for rank, (score, item) in enumerate(sorted(scored)[:n], 1):
            found.append((user, item, round(-score, 9), rank))
    return sorted(found)


def rounded(df):
    return sorted((r["left"], r["right"], round(r["score"], 9), r["rank"]) for r in df.collect())


def test_history_and_unseen(small):
    ratings, catalog, _, _ = small
    assert tuples(candidates.user_history(ratings, 1)) == [(10,)]
    assert tuples(candidates.unseen_items(ratings, catalog.union(catalog), 1)) == [(1, 11), (1, 12)]
    assert candidates.unseen_items(ratings, catalog, 99).count() == 3


def test_one_user(small):
    ratings, catalog, users, items = small
    top = recommend.top_n_for_user(ratings, catalog, users, items, 1, 2)
    assert [tuple(r) for r in top.collect()] == [
        (1, 11, "eleven", "A", 2.0),
        (2, 12, "twelve", None, 2.0),
    ]
    assert recommend.top_n_for_user(ratings, catalog, users, items, 99, 2).count() == 0


def test_repeated_catalogue_rows_do_not_repeat_items(small, catalog_of):
    ratings, catalog, users, items = small
    twice = catalog.union(catalog_of([(11, "another", "Z")]))
    top = recommend.top_n_for_user(ratings, twice, users, items, 1, 2)
    assert [r[S.TITLE] for r in top.collect()] == ["another", "twelve"]
    every = recommend.recommend_all_users(users, items, twice, 3)
    assert every.count() == 6


def test_all_users(small):
    ratings, catalog, users, items = small
    found = recommend.recommend_all_users(users, items, catalog, 2)
    columns = [S.USER, S.RANK, S.ITEM, "predicted_rating"]
    assert tuples(found.select(columns)) == [(1, 1, 10, 3.0), (1, 2, 11, 2.0), (2, 1, 12, 5.0), (2, 2, 11, 1.0)]
    unseen = recommend.recommend_all_users(users, items, catalog, 2, seen=ratings)
    assert tuples(unseen.select(columns)) == [(1, 1, 11, 2.0), (1, 2, 12, 2.0), (2, 1, 12, 5.0), (2, 2, 11, 1.0)]
    nested = {r[S.USER]: r["recommendations"] for r in recommend.nested_recommendations(found).collect()}
    assert [tuple(e) for e in nested[1]] == [(10, 3.0), (11, 2.0)]


def test_similar(factors_of, catalog_of):
    factors = factors_of(VECTORS)
    catalog = catalog_of([(i, f"t{i}", "g") for i, _ in VECTORS])
    found = similar.similar_items(factors, catalog, 1).collect()
    assert [r[S.ITEM] for r in found] == [2, 6, 3, 5, 4]
    assert [r[S.SIMILARITY] for r in found] == [1.0, pytest.approx(math.sqrt(0.5)), 0.0, 0.0, -1.0]
    assert similar.similar_items(factors, catalog, 99).count() == 0
    every = similar.similar_items_all(factors, catalog)
    assert tuples(every.filter("target_id = 1").select(S.RANK, S.ITEM, S.SIMILARITY)) == tuples(
        similar.similar_items(factors, catalog, 1).select(S.RANK, S.ITEM, S.SIMILARITY)
    )
    assert every.count() == 30


def test_values_that_are_no_numbers_take_no_part(factors_of, catalog_of, ratings_of):
    items = factors_of([(1, [1.0, 0.0]), (2, [float("nan"), 1.0]), (3, [2.0, 0.0])])
    catalog = catalog_of([(i, "t", "g") for i in (1, 2, 3)])
    users = factors_of([(7, [1.0, 1.0])])
    ratings = ratings_of([])
    one = recommend.top_n_for_user(ratings, catalog, users, items, 7)
    assert [(r[S.RANK], r[S.ITEM]) for r in one.collect()] == [(1, 3), (2, 1)]
    every = recommend.recommend_all_users(users, items, catalog)
    assert tuples(every.select(S.RANK, S.ITEM)) == [(1, 3), (2, 1)]


@pytest.mark.parametrize("slice_bytes", [grid.SLICE_BYTES, 40 * 4 * 6])
@pytest.mark.parametrize("cosine", [False, True])
def test_grid_against_brute_force(spark, ratings_of, factors_of, slice_bytes, cosine):
    """One and several columns; a third of the items are copies of one vector."""
    users, items = random_factors(1, 90, 6), random_factors(2, 150, 6, copies=50)
    draw = np.random.default_rng(3)
    pairs = {(int(u), int(i)) for u, i in zip(draw.integers(0, 95, 3000), draw.integers(0, 160, 3000))}
    pairs |= {(5, i) for i in range(150)} | {(6, i) for i in range(148)}
    seen = ratings_of([(u, i, 1.0, 1) for u, i in pairs] * 2)
    found = grid.top_n(factors_of(users), factors_of(items), 7, seen, cosine, slice_bytes=slice_bytes)
    assert rounded(found) == brute_force(users, items, 7, pairs, cosine)
    free = grid.top_n(factors_of(users), factors_of(items), 7, None, cosine, slice_bytes=slice_bytes)
    assert rounded(free) == brute_force(users, items, 7, cosine=cosine)


def test_unusable_vectors_are_left_out_everywhere(factors_of, catalog_of, ratings_of):
    bad = [(3, [float("inf"), 1.0]), (4, [float("nan"), 1.0]), (5, None)]
    items = factors_of([(1, [1.0, 0.0]), (2, [0.5, 1.0]), *bad])
    users = factors_of([(1, [1.0, 1.0])])
    catalog = catalog_of([(i, "t", "g") for i in range(1, 7)])
    none = ratings_of([])
    one = recommend.top_n_for_user(none, catalog, users, items, 1)
    every = recommend.recommend_all_users(users, items, catalog)
    pairs = ratings_of([(1, i, 1.0, 0) for i in range(1, 7)]).select(S.USER, S.ITEM)
    scored = scoring.score_pairs(pairs, users, items)
    like = similar.similar_items(items, catalog, 1)
    for found, expected in ((one, {1, 2}), (every, {1, 2}), (scored, {1, 2}), (like, {2})):
        assert {row[S.ITEM] for row in found.collect()} == expected


def test_seen_ids_that_are_no_items(ratings_of, factors_of):
    items = factors_of([(i, [1.0, i / 10]) for i in range(20)])
    users = factors_of([(1, [1.0, 1.0]), (2, [1.0, 1.0])])
    seen = ratings_of([(1, i, 1.0, 0) for i in range(10, 3000)])
    found = grid.top_n(users, items, 3, seen).collect()
    best = {(row["left"], row["rank"]): row["right"] for row in found}
    assert [best[1, r] for r in (1, 2, 3)] == [9, 8, 7]
    assert [best[2, r] for r in (1, 2, 3)] == [19, 18, 17]


def test_ids_of_different_types_meet(spark, factors_of):
    users, items = random_factors(6, 30, 3), random_factors(7, 30, 3)
    pairs = {(u, i) for u in range(30) for i in range(0, 30, 2)}
    wide = "id bigint, features array<float>"
    seen = spark.createDataFrame(list(pairs), "userId int, movieId bigint")
    found = grid.top_n(
        spark.createDataFrame(users, wide), factors_of(items), 4, seen, slice_bytes=10 * 4 * 3
    )
    assert rounded(found) == brute_force(users, items, 4, pairs)


@pytest.mark.parametrize(("records", "chunk", "most_seen"), [(7, 512, 10**6), (7, 8, 10**6), (10, 5, 3), (1000, 20, 1)])
def test_grid_with_small_batches(spark, monkeypatch, ratings_of, factors_of, records, chunk, most_seen):
    """Seen items and their user fall into different batches and chunks.

    Users 40 to 79 have seen items but no factors; lists are cut at every
    fourth item id.
    """
    monkeypatch.setattr(nearest, "CHUNK", chunk)
    monkeypatch.setattr(nearest, "_MOST_SEEN", most_seen)
    monkeypatch.setattr(grid, "_SEEN_RANGE_BITS", 2)
    users, items = random_factors(4, 40, 3), random_factors(5, 60, 3)
    pairs = {(u, i) for u in range(0, 80, 3) for i in range(0, 60, 2)}
    seen = ratings_of([(u, i, 1.0, 1) for u, i in pairs] + [(None, 3, 1.0, 1), (3, None, 1.0, 1)])
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, records)
    try:
        found = rounded(grid.top_n(factors_of(users), factors_of(items), 4, seen))
        free = rounded(grid.top_n(factors_of(users), factors_of(items), 4))
    finally:
        spark.conf.set(key, before)
    assert found == brute_force(users, items, 4, pairs)
    assert free == brute_force(users, items, 4)


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 2**31), st.integers(1, 60), st.integers(1, 12), st.integers(1, 5), st.booleans())
def test_search_of_a_slice(seed, count, n, dims, cosine):
    """Small whole numbers make many equal scores; tiles of five make many tiles."""
    draw = np.random.default_rng(seed)
    items = draw.integers(-2, 3, (count, dims)).astype(np.float32)
    users = draw.integers(-2, 3, (9, dims)).astype(np.float32)
    banned = draw.random((9, count)) < 0.3
    tile, nearest.TILE = nearest.TILE, 5
    try:
        part = nearest.ItemSlice(np.arange(count), items, cosine)
        row, item = np.nonzero(banned)
        at = part.positions(item)
        order = np.argsort(at, kind="stable")
        rows, at, score, rank = part.best(users, n, row[order], at[order])
    finally:
        nearest.TILE = tile
    got = sorted(zip(rows.tolist(), part.ids[at].tolist(), score.round(9).tolist(), (rank + 1).tolist()))
    expected = brute_force(
        list(enumerate(users.tolist())),
        list(enumerate(items.tolist())),
        n,
        set(zip(*(x.tolist() for x in np.nonzero(banned)))),
        cosine,
    )
    assert got == expected


@pytest.mark.parametrize("size", [1e-30, 1e30])
def test_very_long_and_very_short_vectors(factors_of, size):
    users = [(i, [size * x for x in v]) for i, v in random_factors(8, 20, 4)]
    items = [(i, [size * x for x in v]) for i, v in random_factors(9, 40, 4)]
    users, items = ([(i, np.float32(v).tolist()) for i, v in side] for side in (users, items))
    for cosine in (False, True):
        found = grid.top_n(factors_of(users), factors_of(items), 5, cosine=cosine)
        got = sorted((r["left"], r["right"], r["rank"]) for r in found.collect())
        assert got == [(u, i, rank) for u, i, _, rank in brute_force_order(users, items, 5, cosine)]


def brute_force_order(users, items, n, cosine):
    """Like ``brute_force``, with scores too small to survive its rounding."""
    unit = max(abs(x) for _, v in users + items for x in v)
    small = [[(i, [x / unit for x in v]) for i, v in side] for side in (users, items)]
    return brute_force(*small, n, cosine=cosine)


def test_grid_rejects_mixed_lengths(factors_of):
    with pytest.raises(ValueError, match="dimensions"):
        grid.top_n(factors_of([(1, [1.0])]), factors_of([(1, [1.0, 2.0])]), 3)
    with pytest.raises(ValueError, match="dimensions"):
        grid.top_n(factors_of([(1, [1.0]), (2, [1.0, 2.0])]), factors_of([(1, [1.0])]), 3)


def test_grid_without_users_or_items(factors_of):
    some, none = factors_of(USERS), factors_of([])
    assert grid.top_n(some, none, 3).count() == 0
    assert grid.top_n(none, some, 3).count() == 0


def test_score_pairs(spark, factors_of):
    users, items = factors_of(USERS + [(3, None)]), factors_of(ITEMS)
    pairs = spark.createDataFrame([(1, 10), (2, 13), (1, 99), (98, 10), (3, 10)], "userId int, movieId int")
    assert tuples(scoring.score_pairs(pairs, users, items)) == [(1, 10, 3.0), (2, 13, 4.0)]
    kept = scoring.score_pairs(pairs, users, items, keep_unknown=True)
    assert kept.count() == 5 and kept.na.drop().count() == 2
    assert tuples(scoring.item_norms(items))[0] == (10, 3.0)


def test_lookup(spark, catalog_of):
    catalog = catalog_of(CATALOG)
    assert [tuple(r) for r in lookup.catalog_lookup(catalog, 10).collect()] == [(10, "ten", ["A", "B"])]
    assert lookup.catalog_lookup(catalog.union(catalog), 10).count() == 1
    assert lookup.catalog_lookup(catalog, 99).count() == 0
    wanted = spark.createDataFrame([(12,), (12,), (99,)], "movieId int")
    assert [tuple(r) for r in lookup.catalog_lookup(catalog, wanted).collect()] == [(12, "twelve", [])]
    assert tuples(lookup.genres_display(catalog))[0] == (10, "ten", "A, B")


def test_payloads(spark, small):
    ratings, catalog, users, items = small
    found = recommend.recommend_all_users(users, items, catalog, 60, seen=ratings)
    rows = payloads.recommend_payload(found, 1)
    assert tuples(rows) == [(1, 1, 11, "eleven", "A", 2.0, 1), (2, 1, 12, "twelve", None, 5.0, 1)]
    asked = spark.createDataFrame([(1,), (99,)], "userId int")
    answers = {r["user_id"]: r for r in payloads.recommend_answers(found, 10, asked).collect()}
    assert answers[1]["count"] == 2
    assert [e.asDict() for e in answers[1]["recommendations"]] == [
        {"movie_id": 11, "title": "eleven", "genres": "A", "predicted_rating": 2.0},
        {"movie_id": 12, "title": "twelve", "genres": None, "predicted_rating": 2.0},
    ]
    assert (answers[99]["count"], answers[99]["recommendations"]) == (0, [])


def test_answers_for_one(small, factors_of, catalog_of):
    ratings, catalog, users, items = small
    top = recommend.top_n_for_user(ratings, catalog, users, items, 1, 50)
    answer = payloads.recommend_answer(top, 1, 0).collect()
    assert [(r["user_id"], r["count"]) for r in answer] == [(1, 1)]
    assert answer[0]["recommendations"][0].asDict() == {
        "movie_id": 11, "title": "eleven", "genres": "A", "predicted_rating": 2.0
    }
    nobody = recommend.top_n_for_user(ratings, catalog, users, items, 99)
    assert [tuple(r) for r in payloads.recommend_answer(nobody, 99).collect()] == [(99, [], 0)]

    catalog = catalog_of([(i, f"t{i}", "g") for i, _ in VECTORS])
    near = similar.similar_items(factors_of(VECTORS), catalog, 1)
    answer = payloads.similar_answer(near, 1, 2).first()
    assert (answer["movie_id"], answer["count"]) == (1, 2)
    assert [tuple(e) for e in answer["similar_movies"]] == [(2, "t2", "g", 1.0), (6, "t6", "g", 0.7071)]
    unknown = similar.similar_items(factors_of(VECTORS), catalog, 99)
    assert payloads.similar_answer(unknown, 99).count() == 0


def test_stats_answer(ratings_of, catalog_of):
    stats = activity.service_stats(ratings_of(RATED), catalog_of(CATALOG), 20)
    answer = payloads.stats_answer(stats).first().asDict(recursive=True)
    assert answer["dataset"] == {"ratings": 1, "users": 1, "movies": 3}
    assert answer["model"]["rank"] == 20


def test_similar_answers(factors_of, catalog_of):
    catalog = catalog_of([(i, f"t{i}", "g") for i, _ in VECTORS])
    found = similar.similar_items_all(factors_of(VECTORS), catalog)
    answers = {r["movie_id"]: r for r in payloads.similar_answers(found, 2).collect()}
    assert len(answers) == 6
    assert [tuple(e) for e in answers[1]["similar_movies"]] == [(2, "t2", "g", 1.0), (6, "t6", "g", 0.7071)]
    assert answers[1]["count"] == 2


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 1000))
def test_properties(factors_of, ratings_of, seed):
    users, items = random_factors(seed, 12, 3), random_factors(seed + 1, 15, 3)
    seen = {(u, (u * 7 + seed) % 15) for u in range(12)}
    ratings = ratings_of([(u, i, 1.0, 1) for u, i in seen])
    found = grid.top_n(factors_of(users), factors_of(items), 5, ratings).collect()
    assert not seen & {(r["left"], r["right"]) for r in found}
    for user in range(12):
        assert sorted(r["rank"] for r in found if r["left"] == user) == [1, 2, 3, 4, 5]
    near = grid.top_n(factors_of(items), factors_of(items), 15, cosine=True, skip_self=True).collect()
    cosines = {(r["left"], r["right"]): r["score"] for r in near}
    assert len(cosines) == 15 * 14
    assert all(-1 - 1e-12 <= c <= 1 + 1e-12 for c in cosines.values())
    assert all(cosines[b, a] == pytest.approx(c, abs=1e-12) for (a, b), c in cosines.items())


def test_seen_items_of_users_without_vectors_do_not_wait():
    items = nearest.ItemSlice(np.arange(50), np.ones((50, 2), np.float32), cosine=False)
    waiting = nearest._Waiting(items)
    keys = [3, 4, 5, 5, 6, 7]  # 5 has a vector, that of 7 may be in the next batch
    seen = [[1, 2], [3], [4, 99], None, [5, 6, 7], [8]]
    vectors = [None, None, None, [1.0, 2.0], None, None]
    columns = [pa.array(keys, pa.int32()), pa.array(seen, pa.list_(pa.int32())), pa.array(vectors, pa.list_(pa.float32()))]
    waiting.add(pa.RecordBatch.from_arrays(columns, names=["key", "seen", "features"]), 2)
    assert np.concatenate(waiting.seen_user).tolist() == [5, 7]
    assert waiting.n_seen == 2 and waiting.n_users == 1


@pytest.mark.parametrize("slice_bytes", [grid.SLICE_BYTES, 300 * 4 * 8])
@pytest.mark.parametrize("cosine", [False, True])
def test_large_tables_are_searched_without_copies(spark, monkeypatch, factors_of, slice_bytes, cosine):
    """More than the bytes that are copied, in several blocks of users and of items; a third of the items are copies."""
    monkeypatch.setattr(grid, "_USER_BLOCK", 200 * 4 * 8)
    monkeypatch.setattr(grid, "_ITEM_BLOCK", 150 * 4 * 8)
    monkeypatch.setattr(nearest, "CHUNK", 64)
    users, items = random_factors(11, 1100, 8), random_factors(12, 1300, 8, copies=400)
    items += [(2000, [float("nan")] * 8), (2001, None)]
    found = grid.top_n(factors_of(users), factors_of(items), 6, cosine=cosine, skip_self=True, slice_bytes=slice_bytes)
    same = {(i, i) for i, _ in users}
    assert rounded(found) == brute_force(users, items[:-2], 6, same, cosine)
    plan = found._jdf.queryExecution().executedPlan().toString()
    # No vector is repeated before a shuffle, and nothing goes through the driver.
    assert "Generate" not in plan and "CartesianProduct" in plan and "Broadcast" not in plan
