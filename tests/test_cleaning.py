import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from affinia import schemas as S
from affinia.operators import activity, cleaning, splitting
from affinia.settings import Preset
from tests.conftest import tuples


def test_nulls_then_latest(ratings_of):
    ratings = ratings_of(
        [
            (1, 1, 3.0, 100),
            (1, 1, 4.0, 200),
            (1, 2, 2.0, 100),
            (1, 2, 5.0, 100),
            (1, 3, None, 300),
            (1, 3, 1.5, 50),
            (2, 1, 4.0, None),
        ]
    )
    latest = cleaning.latest_ratings(cleaning.drop_nulls(ratings))
    assert tuples(latest) == [(1, 1, 4.0, 200), (1, 2, 5.0, 100), (1, 3, 1.5, 50)]


def test_user_threshold_is_inclusive(ratings_of):
    rows = [(user, item, 3.0, 1) for user, n in ((1, 19), (2, 20), (3, 21)) for item in range(n)]
    ratings = ratings_of(rows)
    assert tuples(cleaning.active_users(ratings, 20)) == [(2,), (3,)]
    assert cleaning.keep_active_users(ratings, 20).count() == 41


def test_items_are_counted_after_users_are_filtered(ratings_of):
    # Item 10 has ten ratings, but only nine of them by active users.
    rows = [(user, item, 3.0, 1) for user in range(9) for item in (10, 11, 12)]
    rows += [(9, 11, 3.0, 1), (9, 12, 3.0, 1), (10, 12, 3.0, 1), (10, 13, 3.0, 1), (11, 10, 3.0, 1)]
    kept = cleaning.clean(ratings_of(rows), Preset(2, 10, rank=1))
    assert {(r[S.ITEM]) for r in kept.collect()} == {11, 12}
    assert kept.count() == 10 + 11


def test_small_preset_has_no_item_filter(ratings_of):
    rows = [(1, item, 3.0, 1) for item in range(5)] + [(2, item, 3.0, 1) for item in range(4)]
    kept = cleaning.clean(ratings_of(rows), Preset(5, 0, rank=1))
    assert {r[S.USER] for r in kept.collect()} == {1}
    assert kept.count() == 5


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.integers(1, 3), st.integers(1, 3), st.sampled_from([1.0, 2.5, 5.0]), st.integers(0, 4)
        ),
        min_size=1,
        max_size=40,
    )
)
def test_latest_agrees_with_a_loop_and_is_idempotent(ratings_of, rows):
    expected = {}
    for user, item, rating, time in rows:
        expected[user, item] = max(expected.get((user, item), (-1, 0.0)), (time, rating))
    latest = cleaning.latest_ratings(ratings_of(rows))
    assert tuples(latest) == sorted(
        ((u, i, rating, time) for (u, i), (time, rating) in expected.items()), key=repr
    )
    assert tuples(cleaning.latest_ratings(latest)) == tuples(latest)


def test_a_pair_with_a_third_of_all_rows_is_reduced_before_the_shuffle(spark):
    rows = spark.range(30000).selectExpr(
        "CAST(IF(id % 3 = 0, 7, id) AS INT) AS userId",
        "CAST(IF(id % 3 = 0, 7, id % 11) AS INT) AS movieId",
        "CAST(id % 10 AS FLOAT) AS rating",
        "CAST(id AS INT) AS timestamp",
    )
    latest = cleaning.latest_ratings(rows)
    # 20,000 other rows, of which row 7 has the same pair as the repeated one.
    assert latest.count() == 20000
    assert latest.filter("userId = 7 AND movieId = 7").first()[S.TIMESTAMP] == 29997
    plan = latest._jdf.queryExecution().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_split_does_not_depend_on_partitions(ratings_of):
    ratings = ratings_of([(u, i, 3.0, 1) for u in range(40) for i in range(25)])
    train, test = splitting.split_holdout(ratings)
    again, _ = splitting.split_holdout(ratings.repartition(7))
    assert tuples(train) == tuples(again)
    assert train.count() + test.count() == 1000
    assert train.join(test, [S.USER, S.ITEM]).count() == 0
    assert 740 < train.count() < 860


def test_random_split_and_unknown_method(ratings_of):
    ratings = ratings_of([(u, i, 3.0, 1) for u in range(40) for i in range(25)])
    train, test = splitting.split_holdout(ratings, method="random")
    assert train.count() + test.count() == 1000
    with pytest.raises(ValueError, match="by-guess"):
        splitting.split_holdout(ratings, method="by-guess")


def test_folds_are_even_on_both_sides(ratings_of):
    ratings = splitting.with_split(ratings_of([(u, i, 3.0, 1) for u in range(60) for i in range(50)]))
    counts = splitting.with_fold(ratings, 3).groupBy(S.SPLIT, "fold").count().collect()
    assert len(counts) == 6
    assert all(700 < r["count"] < 900 for r in counts if r[S.SPLIT] == S.TRAIN)


def test_statistics(ratings_of, catalog_of):
    ratings = ratings_of([(1, 1, 3.0, 1), (1, 2, 4.0, 1), (2, 1, None, 1)])
    assert tuples(activity.dataset_stats(ratings)) == [(3, 2, 2, 3.5)]
    assert tuples(activity.user_activity(ratings)) == [(1, 2), (2, 0)]
    catalog = catalog_of([(i, "t", "g") for i in range(5)])
    stats = activity.service_stats(ratings, catalog, 20).first()
    assert (stats["ratings"], stats["users"], stats["movies"], stats["rank"]) == (3, 2, 5, 20)


def test_statistics_of_ids_far_apart_null_and_repeated(ratings_of, catalog_of):
    ids = [-(2**31), -1, 0, 1, 2**15, 2**15 + 1, 2**31 - 1, None]
    rows = [(user, item, 1.0, 1) for user in ids for item in ids[::2]] * 2
    found = activity.dataset_stats(ratings_of(rows)).first()
    assert tuple(found) == (len(rows), 7, 4, 1.0)
    assert tuples(activity.dataset_stats(ratings_of([]))) == [(0, 0, 0, None)]
    empty = activity.service_stats(ratings_of([]), catalog_of([]), 3).first()
    assert (empty["ratings"], empty["users"], empty["movies"]) == (0, 0, 0)


def test_latest_of_equal_and_missing_times(ratings_of):
    rows = [(1, 1, 2.0, 5), (1, 1, 4.5, 5), (1, 1, 5.0, 4), (2, 1, 1.0, None), (2, 1, 3.0, None), (3, 1, 2.5, None), (3, 1, 1.0, -7)]
    assert tuples(cleaning.latest_ratings(ratings_of(rows))) == [(1, 1, 4.5, 5), (2, 1, 3.0, None), (3, 1, 1.0, -7)]
