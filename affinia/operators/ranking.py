"""Short ranked lists."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from affinia import schemas as S


def best(scored: DataFrame, score: str, n: int) -> DataFrame:
    """The n rows with the highest score, numbered from 1; equal scores by item id.

    Rows whose score is null or not finite sort last and are dropped after the limit:
    dropped before it, the filter would move down and compute scores twice.
    """
    number = F.when(F.abs(score) < float("inf"), F.col(score))
    order = [F.col(score).desc_nulls_last(), F.col(S.ITEM)]
    top = scored.withColumn(score, number).orderBy(*order).limit(n)
    # The window sees the n rows of the limit, not the table.
    ranked = top.withColumn(S.RANK, F.row_number().over(W.orderBy(*order)))
    return ranked.filter(F.col(score).isNotNull())
