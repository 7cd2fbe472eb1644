"""Top-n recommendations."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia import schemas as S
from affinia.functions.vectors import dot, norm
from affinia.operators.candidates import user_history
from affinia.operators.grid import top_n
from affinia.operators.lookup import in_catalog, with_titles, with_titles_of_few
from affinia.operators.ranking import best
from affinia.settings import TOP_N


def length_of(factors: DataFrame) -> Column:
    """Length of each vector, as the table has it if it was stored for reads by id."""
    return F.col(S.LENGTH) if S.LENGTH in factors.columns else norm(F.col(S.FEATURES))


def vector_of(factors: DataFrame, key: int) -> Column:
    """Vector and length of one id as a constant; null for an unknown id."""
    found = F.struct(F.col(S.FEATURES).alias("vector"), length_of(factors).alias("length"))
    return factors.filter(F.col(S.ID) == key).agg(F.max(found)).scalar()


def top_n_for_user(
    ratings: DataFrame,
    catalog: DataFrame,
    user_factors: DataFrame,
    item_factors: DataFrame,
    user_id: int,
    n: int = TOP_N,
) -> DataFrame:
    """The n best catalogue items that one user has not rated, best first.

    An unknown user gives no rows. A vector that is not of finite numbers gives no finite
    score, so it is left out with that.
    """
    items = in_catalog(item_factors, catalog).withColumnRenamed(S.ID, S.ITEM)
    unseen = items.join(user_history(ratings, user_id), S.ITEM, "left_anti")
    user = unseen.withColumn("user", vector_of(user_factors, user_id))
    score = dot(F.col("user.vector"), F.col(S.FEATURES)).alias(S.PREDICTION)
    return (
        with_titles_of_few(best(user.select(S.ITEM, score), S.PREDICTION, n), catalog)
        .select(S.RANK, S.ITEM, S.TITLE, S.GENRES, S.PREDICTION)
        .orderBy(S.RANK)
        .limit(n)
    )


def recommend_all_users(
    user_factors: DataFrame,
    item_factors: DataFrame,
    catalog: DataFrame,
    n: int = TOP_N,
    seen: DataFrame | None = None,
) -> DataFrame:
    """The n best catalogue items for every user.

    Items a user has rated may be among them, unless ``seen`` gives the
    ratings to leave out. Only catalogue items are ranked, so a user gets
    fewer than n only if fewer are left.
    """
    found = top_n(user_factors, in_catalog(item_factors, catalog), n, seen)
    ranked = found.select(
        F.col("right").alias(S.ITEM),
        F.col("left").alias(S.USER),
        S.RANK,
        F.col("score").alias("predicted_rating"),
    )
    return with_titles(ranked, catalog)


def nested_recommendations(recommendations: DataFrame) -> DataFrame:
    """One row for each user, with its items and scores best first."""
    items = F.collect_list(F.struct(S.RANK, S.ITEM, F.col("predicted_rating").alias(S.RATING)))
    without_rank = F.transform(
        F.sort_array("items"), lambda item: F.struct(item[S.ITEM].alias(S.ITEM), item[S.RATING].alias(S.RATING))
    )
    return (
        recommendations.groupBy(S.USER)
        .agg(items.alias("items"))
        .select(S.USER, without_rank.alias("recommendations"))
    )
