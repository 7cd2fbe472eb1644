"""Checked conversion of keys to the 32-bit ids that factor models need."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def int_id(table: DataFrame, name: str) -> Column:
    """The key as ``int``, or null where it is missing, fractional or too large.

    A plain cast would cut a fraction off, or stop the job on an overflow.
    """
    key = table[name]
    if isinstance(table.schema[name].dataType, T.IntegralType):
        return key.try_cast("int")
    number = key.try_cast("double")
    return F.when(number == F.floor(number), number.try_cast("int"))
