"""Shapes of the plans that have to hold on large tables."""

import re

import pytest
from pyspark.sql import functions as F

from affinia import schemas as S
from affinia.operators import activity, candidates, cleaning, lookup, recommend, scoring, similar
from affinia.operators import splitting
from affinia.settings import Preset
from affinia.sources import landing, workspace


@pytest.fixture(scope="module")
def stored(spark):
    """Ratings, catalogue and factors as files, and no broadcasts."""
    ids = spark.range(400)
    ratings = ids.select(
        (F.col("id") % 40).cast("int").alias(S.USER),
        (F.col("id") % 30).cast("int").alias(S.ITEM),
        (F.col("id") % 5).cast("float").alias(S.RATING),
        F.col("id").cast("int").alias(S.TIMESTAMP),
    )
    catalog = ids.limit(30).select(
        F.col("id").cast("int").alias(S.ITEM), F.lit("t").alias(S.TITLE), F.lit("g").alias(S.GENRES)
    )
    vector = F.array(*[F.sin(F.col("id") * d).cast("float") for d in range(1, 5)])
    factors = ids.limit(40).select(F.col("id").cast("int").alias(S.ID), vector.alias(S.FEATURES))
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, "-1")
    yield [workspace.written(t, "plans") for t in (ratings, catalog, factors)]
    for key in keys:
        spark.conf.unset(key)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan_of(df):
    df.collect()
    return plan_of(df).split("== Initial Plan ==")[0]


def all_plans(stored):
    ratings, catalog, factors = stored
    return {
        "stats": activity.dataset_stats(ratings),
        "service": activity.service_stats(ratings, catalog, 4),
        "clean": splitting.with_split(cleaning.clean(ratings)),
        "unseen": candidates.unseen_items(ratings, catalog, 7),
        "scores": scoring.score_pairs(ratings, factors, factors),
        "one user": recommend.top_n_for_user(ratings, catalog, factors, factors, 7),
        "all users": recommend.recommend_all_users(factors, factors, catalog, seen=ratings),
        "one item": similar.similar_items(factors, catalog, 7),
        "all items": similar.similar_items_all(factors, catalog),
    }


def test_no_cross_joins_and_no_row_functions(stored):
    for name, df in all_plans(stored).items():
        plan = plan_of(df)
        assert not re.search("Cartesian|NestedLoop|EvalPython|InPandas", plan), name
        assert ("MapInArrow" in plan) == (name in ("all users", "all items")), name


def test_scans_read_what_they_need(stored):
    ratings, _, _ = stored
    plan = plan_of(candidates.user_history(ratings, 7))
    assert f"EqualTo({S.USER},7)" in plan
    assert f"ReadSchema: struct<{S.USER}:int,{S.ITEM}:int>" in plan
    plan = plan_of(cleaning.drop_nulls(ratings))
    assert all(f"IsNotNull({name})" in plan for name in ratings.columns)
    assert f"ReadSchema: struct<{S.USER}:int,{S.RATING}:float>" in plan_of(activity.user_activity(ratings))


def test_branches_of_cleaning_share_the_deduplication(stored):
    ratings, _, _ = stored
    plan = final_plan_of(cleaning.clean(ratings, Preset(2, 2, rank=1)))
    executed = re.findall(r"- Exchange hashpartitioning\(userId#\d+, movieId#\d+, timestamp#\d+", plan)
    assert len(executed) == 1
    assert plan.count("ReusedExchange") >= 2


def test_counts_are_reduced_before_the_shuffle(stored):
    ratings, _, _ = stored
    for df in (activity.user_activity(ratings), activity.item_popularity(ratings)):
        assert "partial_count" in plan_of(df)


def test_distinct_ids_are_counted_without_sending_ids(stored):
    ratings, catalog, _ = stored
    for df in (activity.dataset_stats(ratings), activity.service_stats(ratings, catalog, 4)):
        plan = plan_of(df)
        assert "Expand" not in plan and "distinct" not in plan and "bitmap_construct_agg" in plan
        keys = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
        assert keys and all(S.USER not in key and S.ITEM not in key for key in keys)


def test_deduplication_hashes_and_does_not_sort(stored):
    plan = plan_of(cleaning.latest_ratings(stored[0]))
    assert "Sort" not in plan and plan.count("HashAggregate") >= 4


def test_short_lists_are_cut_before_titles_are_joined(stored):
    ratings, catalog, factors = stored
    for df in (
        recommend.top_n_for_user(ratings, catalog, factors, factors, 7),
        similar.similar_items(factors, catalog, 7),
    ):
        plan = plan_of(df)
        assert plan.count("TakeOrderedAndProject") == 2
        assert "Subquery" in plan


def test_one_partition_is_one_cell(stored, monkeypatch):
    from affinia.operators import grid

    _, _, factors = stored
    monkeypatch.setattr(grid, "_MIN_USERS", 10)
    found = grid.top_n(factors, factors, 3, slice_bytes=10 * 4 * 4)
    # Forty items in slices of ten, forty users in four rows.
    assert re.search(r"shufflepartitionidpassthrough\(.*, 16\), REPARTITION_BY_NUM", plan_of(found))
    assert found.count() == 120


def test_small_slices_do_not_multiply_the_cells(stored):
    from affinia.operators import grid

    _, _, factors = stored
    found = grid.top_n(factors, factors, 3, cosine=True, skip_self=True, slice_bytes=4 * 4)
    # Forty slices of one item: each vector is sent to eight cells, not to forty, and no cell is lost.
    assert re.search(r"shufflepartitionidpassthrough\(.*, 64\), REPARTITION_BY_NUM", plan_of(found))
    whole = grid.top_n(factors, factors, 3, cosine=True, skip_self=True)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, whole.collect()))


def test_a_trained_model_cleans_step_by_step(spark, monkeypatch):
    import __spark_entry__ as entry

    plans, clean = [], cleaning.clean

    def noted(*args):
        found = clean(*args)
        plans.append(plan_of(found))
        return found

    monkeypatch.setattr(entry.cleaning, "clean", noted)
    monkeypatch.setattr(entry, "_MODELS", {})
    _, split = entry._trained(spark, entry.SMOKE_DIR)
    # The last threshold reads what the one before has stored, and does not clean anew.
    assert "lineitem" not in plans[0] and "HashAggregate" not in plans[0]
    assert split.count() == clean(entry.tables.ratings(spark, entry.SMOKE_DIR), entry.CLEANING).count() > 0


def test_unseen_lists_are_compared_without_a_second_join_of_orders(spark, stored, monkeypatch):
    import __spark_entry__ as entry

    monkeypatch.setattr(entry, "_MODELS", {})
    found = entry._als_recommend_all_unseen(spark, entry.SMOKE_DIR)
    rows = found.collect()
    assert rows and all(row["exact"] for row in rows)
    plan = plan_of(found).split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet \[l_orderkey", plan)) == 1 and "ReusedExchange" in plan
    # The window stands on the join with users, which has each list in one place.
    below = plan[plan.index("Window [lag(") :]
    assert below.index("SortMergeJoin [userId") < below.index("Exchange")


@pytest.fixture
def small_skew_limits(spark, stored):
    limits = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {key: spark.conf.get(key) for key in limits}
    for key, value in limits.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def _with_hot_key(spark, hot: str, other: str):
    """Distinct pairs, a third of them with one ``hot`` key."""
    n = F.col("id")
    rows = spark.range(30_000).select(
        F.when(n % 3 == 0, 0).otherwise(n % 1000).cast("int").alias(hot),
        n.cast("int").alias(other),
        F.lit(1.0).cast("float").alias(S.RATING),
        n.cast("int").alias(S.TIMESTAMP),
    )
    return workspace.written(rows.select(S.USER, S.ITEM, S.RATING, S.TIMESTAMP), "hot")


def test_hot_keys_are_split_after_deduplication(spark, small_skew_limits):
    users = cleaning.latest_ratings(_with_hot_key(spark, S.USER, S.ITEM))
    assert "skew=true" in final_plan_of(cleaning.keep_active_users(users, 2))
    items = cleaning.latest_ratings(_with_hot_key(spark, S.ITEM, S.USER))
    assert "skew=true" in final_plan_of(cleaning.keep_popular_items(items, 2))


def test_ratings_of_dropped_users_do_not_reach_the_shuffle(spark, stored):
    ratings = _with_hot_key(spark, S.USER, S.ITEM)
    limits = {
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    }
    for key, value in limits.items():
        spark.conf.set(key, value)
    try:
        with workspace.staging(spark) as store:
            kept = cleaning.clean(ratings, Preset(100, 0, rank=1), store)
            plan = plan_of(kept)
            assert "might_contain" in plan and "bloom_filter_agg" in plan
            exchange = re.search(r"Exchange hashpartitioning\(userId.*?might_contain", plan, re.S)
            assert exchange  # the filter stands below the shuffle of the ratings
            assert {row[S.USER] for row in kept.select(S.USER).distinct().collect()} == {0}
            assert kept.count() == 10_020
    finally:
        for key in limits:
            spark.conf.unset(key)


def test_a_title_in_most_lists_is_split(spark, stored, small_skew_limits):
    ranked = _with_hot_key(spark, S.ITEM, S.USER)
    assert "skew=true" in final_plan_of(lookup.with_titles(ranked, stored[1]))


def test_landed_ratings_are_sorted_for_reads_of_one_user(spark, stored, tmp_path):
    stored[0].coalesce(1).write.option("header", True).csv(str(tmp_path / "ratings.csv"))
    landing.land_raw(spark, str(tmp_path), str(tmp_path / "base"))
    landed = landing.landed_ratings(spark, str(tmp_path / "base"))
    users = [row[S.USER] for row in landed.coalesce(1).collect()]
    assert users == sorted(users)
