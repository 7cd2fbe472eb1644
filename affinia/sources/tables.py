"""Ratings and factors taken from tables with other column names and types."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia import schemas as S
from affinia.functions.ids import int_id


def as_ratings(table: DataFrame, user: str, item: str, rating: Column, timestamp: Column) -> DataFrame:
    """Any table of user-item events in the shape of ratings.

    Keys that do not fit an id become null, so ``drop_nulls`` removes their
    rows; ``rejected_ids`` shows them.
    """
    return table.select(
        int_id(table, user).alias(S.USER),
        int_id(table, item).alias(S.ITEM),
        rating.cast("float").alias(S.RATING),
        timestamp.try_cast("int").alias(S.TIMESTAMP),
    )


def rejected_ids(table: DataFrame, user: str, item: str) -> DataFrame:
    """The rows whose user or item key does not fit an id."""
    return table.filter(int_id(table, user).isNull() | int_id(table, item).isNull())


def as_factors(table: DataFrame, key: str, features: Column) -> DataFrame:
    """Any table of keyed vectors in the shape of factors."""
    return table.select(int_id(table, key).alias(S.ID), features.alias(S.FEATURES)).filter(
        F.col(S.ID).isNotNull()
    )
