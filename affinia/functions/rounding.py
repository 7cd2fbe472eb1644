"""Rounding of numbers in answers."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Digits kept in answers.
METRIC_DIGITS = 4
PREDICTION_DIGITS = 3
SIMILARITY_DIGITS = 4


def rounded(value: Column, digits: int) -> Column:
    return F.round(value.cast("double"), digits)
