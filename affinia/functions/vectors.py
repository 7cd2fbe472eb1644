"""Arithmetic on factor vectors as column expressions.

Products are added in ``double``, from the first dimension to the last, so a
score is the same number in every plan that computes it.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Inner product of two arrays; null if their lengths differ or a value is null."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def norm(a: Column) -> Column:
    """Euclidean length of an array."""
    return F.sqrt(dot(a, a))


def cosine_from(dot_ab: Column, norm_a: Column, norm_b: Column) -> Column:
    """Cosine from its three parts; a vector of length zero is similar to nothing."""
    length = norm_a * norm_b
    return F.when(length == 0, F.lit(0.0)).otherwise(dot_ab / length)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two arrays, 0.0 where either has length zero."""
    return cosine_from(dot(a, b), norm(a), norm(b))
