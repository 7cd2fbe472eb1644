"""Cleaning of ratings."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from affinia import schemas as S
from affinia.operators.activity import item_popularity, user_activity
from affinia.settings import ENGINE_DEFAULTS, Preset


def drop_nulls(ratings: DataFrame) -> DataFrame:
    """Keep rows in which every column has a value, and a number where it is a float.

    The conditions are written out: they reach the file scan that way, and
    every branch of a plan filters alike, so the branches can share a shuffle.
    """
    for field in ratings.schema:
        column = F.col(field.name)
        ratings = ratings.filter(column.isNotNull())
        if isinstance(field.dataType, T.FractionalType):
            ratings = ratings.filter(~F.isnan(column.cast("double")))
    return ratings


def latest_ratings(ratings: DataFrame) -> DataFrame:
    """One rating for each user and item: the latest, the highest of equal times.

    Aggregates rather than a window: each task first reduces its own rows, so a
    pair that is repeated very often never gathers in one task. The first one leaves the highest rating of
    each time, the second the latest time. Both keep numbers only, so they hash and nothing is sorted.
    """
    time = F.coalesce(S.TIMESTAMP, F.lit(-(2**31)))  # a missing time is the earliest
    highest = ratings.groupBy(S.USER, S.ITEM, S.TIMESTAMP).agg(F.max(S.RATING).alias(S.RATING))
    return (
        highest.groupBy(S.USER, S.ITEM)
        .agg(
            F.max_by(F.col(S.RATING), time).alias(S.RATING),
            F.max(S.TIMESTAMP).alias(S.TIMESTAMP),
        )
        .select(S.USER, S.ITEM, S.RATING, S.TIMESTAMP)
    )


def active_users(ratings: DataFrame, minimum: int) -> DataFrame:
    """Users with at least ``minimum`` ratings."""
    return _reaching(user_activity(ratings), minimum, S.USER)


def popular_items(ratings: DataFrame, minimum: int) -> DataFrame:
    """Items with at least ``minimum`` ratings."""
    return _reaching(item_popularity(ratings), minimum, S.ITEM)


def _reaching(counts: DataFrame, minimum: int, key: str) -> DataFrame:
    return counts.filter(F.col("n") >= minimum).select(key)


def _kept(ratings: DataFrame, counts: DataFrame, minimum: int, key: str, stored: bool) -> DataFrame:
    """Ratings whose key is counted at least ``minimum`` times.

    Rebalancing puts a shuffle of the few keys between the count and the join. Only then may Spark split a
    key with very many ratings over several tasks. Counts that are ``stored`` need none: they are read with
    a filter, so where the kept keys are few Spark makes a bloom filter of them, and drops ratings of others
    where they are read, before the shuffle.
    """
    keys = _reaching(counts, minimum, key)
    return ratings.join(keys if stored else keys.hint("rebalance"), key, "left_semi")


def keep_active_users(ratings: DataFrame, minimum: int, counts: DataFrame | None = None) -> DataFrame:
    """Ratings of active users; ``counts`` is the stored activity, if there is one."""
    found = user_activity(ratings) if counts is None else counts
    return _kept(ratings, found, minimum, S.USER, counts is not None)


def keep_popular_items(ratings: DataFrame, minimum: int, counts: DataFrame | None = None) -> DataFrame:
    """Ratings of popular items, in the same way."""
    found = item_popularity(ratings) if counts is None else counts
    return _kept(ratings, found, minimum, S.ITEM, counts is not None)


def clean(
    ratings: DataFrame,
    preset: Preset = ENGINE_DEFAULTS,
    store: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """Complete, latest ratings of active users for popular items.

    Nulls go first, so an incomplete copy never hides a complete one. Items
    are counted after inactive users are gone, and each threshold is applied
    once.

    Each threshold reads the ratings twice, to count and to filter. With
    ``store``, for which see ``workspace.staging``, the table and its counts are written before
    each threshold, so that no step runs twice.
    """
    stored = lambda counts, label: store(counts, label) if store else None
    kept = latest_ratings(drop_nulls(ratings))
    if preset.min_user_ratings > 1:
        kept = store(kept, "latest") if store else kept
        counts = stored(user_activity(kept), "user-activity")
        kept = keep_active_users(kept, preset.min_user_ratings, counts)
    if preset.min_item_ratings > 1:
        kept = store(kept, "active") if store else kept
        counts = stored(item_popularity(kept), "item-popularity")
        kept = keep_popular_items(kept, preset.min_item_ratings, counts)
    return kept.select(S.USER, S.ITEM, S.RATING, S.TIMESTAMP)
