"""Ratings, catalogue and factors read from a folder of order tables.

Every order line is a rating that a customer gives to a part; every part is a
catalogue item. The embedding table serves as factors: as it is for items, and
with its dimensions reversed for users, so that no user equals an item.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affinia import schemas as S
from affinia.functions.ids import int_id
from affinia.sources.tables import as_factors, as_ratings

EMBEDDING_RANK = 64


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _order_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = _table(spark, folder, "lineitem")
    orders = _table(spark, folder, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey)


def _stars() -> Column:
    return F.ceil(F.col("l_quantity") / 5) / 2


def _ordered_at() -> Column:
    since_1970 = F.col("o_orderdate") - F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")
    return since_1970.cast("interval second").cast("bigint")


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    lines = _order_lines(spark, folder)
    return as_ratings(lines, "o_custkey", "l_partkey", _stars(), _ordered_at())


def ratings_with_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """The same ratings, without a value where the line has no discount."""
    lines = _order_lines(spark, folder)
    rating = F.when(F.col("l_discount") != 0, _stars())
    return as_ratings(lines, "o_custkey", "l_partkey", rating, _ordered_at())


def catalog(spark: SparkSession, folder: str) -> DataFrame:
    parts = _table(spark, folder, "part")
    return parts.select(
        int_id(parts, "p_partkey").alias(S.ITEM),
        F.col("p_name").alias(S.TITLE),
        F.concat_ws("|", "p_type", "p_brand").alias(S.GENRES),
    )


def item_factors(spark: SparkSession, folder: str) -> DataFrame:
    return as_factors(_table(spark, folder, "embeddings"), "vec_id", F.col("embedding"))


def user_factors(spark: SparkSession, folder: str) -> DataFrame:
    return as_factors(_table(spark, folder, "embeddings"), "vec_id", F.reverse("embedding"))
