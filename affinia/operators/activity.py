"""Counts over ratings and catalogue."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia import schemas as S
from affinia.settings import ALGORITHM, FRAMEWORK


def user_activity(ratings: DataFrame) -> DataFrame:
    """Number of ratings of each user."""
    return ratings.groupBy(S.USER).agg(F.count(S.RATING).alias("n"))


def item_popularity(ratings: DataFrame) -> DataFrame:
    """Number of ratings of each item."""
    return ratings.groupBy(S.ITEM).agg(F.count(S.RATING).alias("n"))


USERS, ITEMS = 0, 1


def _id_range(kind: int, name: str, *values: Column) -> Column:
    """One id as a range of 2^15 ids, whose number also tells the kind, and its place in it, with values to add up."""
    number = (F.bitmap_bucket_number(name) * 2 + kind).alias("range")
    return F.struct(number, F.bitmap_bit_position(name).alias("place"), *values)


def _per_range(marks: DataFrame) -> DataFrame:
    """Distinct ids in each range. Tasks send one bitmap of 4 KiB for a range instead of its ids."""
    sums = [F.sum(name).alias(name) for name in marks.columns if name not in ("range", "place")]
    marked = marks.groupBy("range").agg(F.bitmap_construct_agg("place").alias("ids"), *sums)
    # Ids that are null have a range of their own, without ids.
    n = F.when(F.col("range").isNull(), 0).otherwise(F.bitmap_count("ids"))
    return marked.withColumn("n", n).drop("ids")


def _distinct(kind: int) -> Column:
    return F.coalesce(F.sum(F.when(F.pmod("range", F.lit(2)) == kind, F.col("n"))), F.lit(0))


def dataset_stats(ratings: DataFrame) -> DataFrame:
    """Ratings, users, rated items and mean rating, in one pass.

    Distinct ids are counted exactly, as bits: no id leaves the task that read it.
    """
    rating = F.col(S.RATING).cast("double")
    counted = [F.lit(1).alias("rows"), rating.isNotNull().cast("int").alias("rated"), rating.alias("total")]
    nothing = [F.lit(0).alias("rows"), F.lit(0).alias("rated"), F.lit(None).cast("double").alias("total")]
    marks = F.array(_id_range(USERS, S.USER, *counted), _id_range(ITEMS, S.ITEM, *nothing))
    return _per_range(ratings.select(F.inline(marks))).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("ratings"),
        _distinct(USERS).alias("users"),
        _distinct(ITEMS).alias("movies"),
        F.try_divide(F.sum("total"), F.sum("rated")).alias("avg_rating"),
    )


def service_stats(ratings: DataFrame, catalog: DataFrame, rank: int | None) -> DataFrame:
    """Size of the data, with the whole catalogue, and the kind of model."""
    movies = catalog.agg(F.count("*")).scalar()
    marks = ratings.select(_id_range(USERS, S.USER, F.lit(1).alias("rows")).alias("x")).select("x.*")
    return _per_range(marks).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("ratings"), _distinct(USERS).alias("users")
    ).select(
        "ratings",
        "users",
        movies.alias("movies"),
        F.lit(ALGORITHM).alias("algorithm"),
        F.lit(rank).cast("int").alias("rank"),
        F.lit(FRAMEWORK).alias("framework"),
    )
