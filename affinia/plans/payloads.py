"""Answers in the shape that a service returns."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from affinia import schemas as S
from affinia.functions.rounding import METRIC_DIGITS, PREDICTION_DIGITS, SIMILARITY_DIGITS, rounded
from affinia.settings import TOP_N, clamp_top_n


def _with_count(rows: DataFrame, key: str) -> DataFrame:
    # A key has at most TOP_N_MAX rows here.
    return rows.withColumn("count", F.count("*").over(W.partitionBy(key)))


def _entries(fields: list[str]) -> Column:
    """The rows of one answer as a list, best first."""
    return F.sort_array(F.collect_list(F.struct(S.RANK, *fields)))


def _answer(lists: DataFrame, name: str, fields: list[str]) -> DataFrame:
    """Drop the ranks from the list called ``name``, and count its entries."""
    plain = F.transform(F.col(name), lambda e: F.struct(*[e[f].alias(f) for f in fields]))
    return lists.withColumn(name, plain).withColumn("count", F.size(name))


# Names of the fields in answers.
_RECOMMENDED = ["movie_id", S.TITLE, S.GENRES, "predicted_rating"]
_SIMILAR = ["movie_id", S.TITLE, S.GENRES, "similarity"]


def recommend_payload(recommendations: DataFrame, n: int = TOP_N) -> DataFrame:
    """Rows of the answer for each user in a table of ranked recommendations."""
    score = "predicted_rating" if "predicted_rating" in recommendations.columns else S.PREDICTION
    rows = recommendations.filter(F.col(S.RANK) <= clamp_top_n(n)).select(
        F.col(S.USER).alias("user_id"),
        S.RANK,
        F.col(S.ITEM).alias("movie_id"),
        S.TITLE,
        S.GENRES,
        rounded(F.col(score), PREDICTION_DIGITS).alias("predicted_rating"),
    )
    return _with_count(rows, "user_id")


def recommend_answers(
    recommendations: DataFrame, n: int = TOP_N, users: DataFrame | None = None
) -> DataFrame:
    """One answer for each user: a list of items, and its length.

    With a table of ``users`` who ask, those without any item get an empty list.
    """
    rows = recommend_payload(recommendations, n)
    lists = rows.groupBy("user_id").agg(_entries(_RECOMMENDED).alias("recommendations"))
    answers = _answer(lists, "recommendations", _RECOMMENDED)
    if users is None:
        return answers
    asked = users.select(F.col(S.USER).alias("user_id")).distinct()
    empty = F.array().cast(answers.schema["recommendations"].dataType)
    return asked.join(answers, "user_id", "left").select(
        "user_id",
        F.coalesce("recommendations", empty).alias("recommendations"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def recommend_answer(recommendations: DataFrame, user_id: int, n: int = TOP_N) -> DataFrame:
    """The answer for one user, from that user's ranked items; the list may be empty."""
    rows = recommend_payload(recommendations.withColumn(S.USER, F.lit(user_id).cast("int")), n)
    lists = rows.agg(_entries(_RECOMMENDED).alias("recommendations"))
    answer = lists.select(F.lit(user_id).cast("int").alias("user_id"), "recommendations")
    return _answer(answer, "recommendations", _RECOMMENDED)


def similar_payload(similar: DataFrame, n: int = TOP_N) -> DataFrame:
    """Rows of the answer for each target in a table of ranked similar items."""
    rows = similar.filter(F.col(S.RANK) <= clamp_top_n(n)).select(
        F.col("target_id"),
        S.RANK,
        F.col(S.ITEM).alias("movie_id"),
        S.TITLE,
        S.GENRES,
        rounded(F.col(S.SIMILARITY), SIMILARITY_DIGITS).alias("similarity"),
    )
    return _with_count(rows, "target_id")


def similar_answers(similar: DataFrame, n: int = TOP_N) -> DataFrame:
    """One answer for each item: a list of similar items, and its length."""
    rows = similar_payload(similar, n)
    lists = rows.groupBy("target_id").agg(_entries(_SIMILAR).alias("similar_movies"))
    return _answer(lists, "similar_movies", _SIMILAR).withColumnRenamed("target_id", "movie_id")


def similar_answer(similar: DataFrame, movie_id: int, n: int = TOP_N) -> DataFrame:
    """The answer for one item, from its ranked similar items; no row if there are none."""
    rows = similar_payload(similar.withColumn("target_id", F.lit(movie_id).cast("int")), n)
    lists = rows.agg(_entries(_SIMILAR).alias("similar_movies"))
    answer = lists.select(F.lit(movie_id).cast("int").alias("movie_id"), "similar_movies")
    return _answer(answer, "similar_movies", _SIMILAR).filter(F.col("count") > 0)


def metrics_answer(metrics: DataFrame) -> DataFrame:
    """Errors of a model as they are reported."""
    errors = {name: rounded(F.col(name), METRIC_DIGITS) for name in ("rmse", "mae")}
    return metrics.withColumns(errors)


def stats_answer(stats: DataFrame) -> DataFrame:
    """Service statistics as two groups of fields."""
    return stats.select(
        F.struct("ratings", "users", "movies").alias("dataset"),
        F.struct("algorithm", "rank", "framework").alias("model"),
    )
