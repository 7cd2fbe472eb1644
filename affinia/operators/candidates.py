"""What a user has rated, and what is left."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinia import schemas as S


def user_history(ratings: DataFrame, user_id: int) -> DataFrame:
    """Items that one user has rated, each once."""
    return ratings.filter(F.col(S.USER) == user_id).select(S.ITEM).distinct()


def unseen_items(ratings: DataFrame, catalog: DataFrame, user_id: int) -> DataFrame:
    """Catalogue items that one user has not rated, paired with the user.

    The user is a constant column, so no join is needed to form the pairs.
    Seen items come from all ratings, also from those held out for testing.
    """
    items = catalog.select(S.ITEM).distinct()
    unseen = items.join(user_history(ratings, user_id), S.ITEM, "left_anti")
    return unseen.select(F.lit(user_id).cast("int").alias(S.USER), S.ITEM)
