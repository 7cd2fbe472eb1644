"""Division of ratings into a training and a test part."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinia import schemas as S
from affinia.settings import SEED, TRAIN_PERCENT


def _hashed_pair() -> Column:
    """A number from 0 to 2**32 - 1 that depends on user and item only."""
    digest = F.md5(F.concat_ws(":", S.USER, S.ITEM))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def with_split(ratings: DataFrame, train_percent: int = TRAIN_PERCENT) -> DataFrame:
    """Mark every rating as ``train`` or ``test``.

    The side depends on the pair alone, so it is the same however the rows
    are partitioned and whichever task runs again.
    """
    side = F.when(_hashed_pair() % 100 < train_percent, S.TRAIN).otherwise(S.TEST)
    return ratings.withColumn(S.SPLIT, side)


def side(split: DataFrame, name: str) -> DataFrame:
    """The rows of one side of a marked table."""
    return split.filter(F.col(S.SPLIT) == name).drop(S.SPLIT)


def split_holdout(
    ratings: DataFrame,
    train_percent: int = TRAIN_PERCENT,
    method: str = "hash",
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """Training and test ratings.

    ``method="random"`` draws rows with Spark's random split, which depends on
    how the rows are partitioned.
    """
    if method == "random":
        train, test = ratings.randomSplit([train_percent / 100, 1 - train_percent / 100], seed)
        return train, test
    if method != "hash":
        raise ValueError(f"unknown split method: {method}")
    split = with_split(ratings, train_percent)
    return side(split, S.TRAIN), side(split, S.TEST)


def with_fold(ratings: DataFrame, folds: int, column: str = "fold") -> DataFrame:
    """Number every rating with its cross-validation fold.

    Digits that the train/test split does not use decide, so folds are spread
    over both sides evenly.
    """
    fold = F.floor(_hashed_pair() / 100).cast("bigint") % folds
    return ratings.withColumn(column, fold.cast("int"))


def split_stats(split: DataFrame) -> DataFrame:
    """Number of ratings on each side of a marked table."""
    return split.groupBy(S.SPLIT).agg(F.count("*").alias("n"))
