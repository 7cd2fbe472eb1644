"""Labelled rows to learn from: folds, and a bounded sample of them."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_fold(doc_id: str | Column, folds: int, held_out: int) -> Column:
    """Whether crc32 of the id as text leaves ``held_out``; false for a null id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string")) % folds == held_out, F.lit(False))


def label_sample(
    labels: DataFrame, column: str, folds: int, held_out: int, rows: int
) -> DataFrame:
    """At most ``rows`` labels (doc_id, label) outside the held-out fold, chosen by hash of the id.

    Rows without id or label are left out. Several labels of one document
    count as their majority, and as 1 when they are as many.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).alias("label"))
    known = known.where("doc_id IS NOT NULL AND label IS NOT NULL")
    known = known.where(~in_fold("doc_id", folds, held_out))
    one = known.groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def labelled_texts(docs: DataFrame, sample: DataFrame, how: str = "inner") -> DataFrame:
    """Texts with their label. The sample has a fixed number of rows, so it is broadcast."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.join(F.broadcast(sample), "doc_id", how)
