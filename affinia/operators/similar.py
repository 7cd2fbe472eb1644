"""Items with similar factor vectors."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia import schemas as S
from affinia.functions.vectors import cosine_from, dot
from affinia.operators.grid import top_n
from affinia.operators.lookup import in_catalog, with_titles, with_titles_of_few
from affinia.operators.ranking import best
from affinia.operators.recommend import length_of, vector_of
from affinia.settings import TOP_N


def similar_items(
    item_factors: DataFrame,
    catalog: DataFrame,
    movie_id: int,
    n: int = TOP_N,
) -> DataFrame:
    """The n catalogue items most similar to one item, without the item itself.

    An unknown item gives no rows, and a vector that is not of finite numbers none of its own.
    """
    others = in_catalog(item_factors.filter(F.col(S.ID) != movie_id), catalog)
    product = dot(F.col(S.FEATURES), F.col("target.vector"))
    similarity = cosine_from(product, F.col("target.length"), length_of(item_factors))
    scored = others.withColumn("target", vector_of(item_factors, movie_id))
    scored = scored.select(F.col(S.ID).alias(S.ITEM), similarity.alias(S.SIMILARITY))
    return (
        with_titles_of_few(best(scored, S.SIMILARITY, n), catalog)
        .select(S.RANK, S.ITEM, S.TITLE, S.GENRES, S.SIMILARITY)
        .orderBy(S.RANK)
        .limit(n)
    )


def similar_items_all(item_factors: DataFrame, catalog: DataFrame, n: int = TOP_N) -> DataFrame:
    """The n most similar catalogue items for every item that has factors."""
    found = top_n(
        item_factors, in_catalog(item_factors, catalog), n, cosine=True, skip_self=True
    )
    ranked = found.select(
        F.col("left").alias("target_id"),
        S.RANK,
        F.col("right").alias(S.ITEM),
        F.col("score").alias(S.SIMILARITY),
    )
    return with_titles(ranked, catalog)
