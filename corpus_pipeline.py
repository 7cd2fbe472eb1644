"""Raw documents to a training mix, in five stages.

Every stage reads what the one before wrote and takes (spark, docs, sf_dir). All columns pass through all
stages, whatever they are called; only the last one adds ``copies`` and ``taken`` and replaces columns of
these names. An empty table stays empty. Null and empty texts are not toxic, like nothing else, hold no
benchmark passage and no personal data, and are in the mix as often as their source is. Rows need no id:
rows equal in id and text are one document to the second stage, all others are told apart. What a
stage writes on the way is deleted when its result is stored.
"""

from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession

from affinia.llm import decontam, mixing, neardup, pii, toxicity
from affinia.sources.workspace import temporary

NEAR_COPY = Fraction(80, 100)  # op3's 85/100 binds that query alone


def _without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be toxic go. Learns from ``labels``."""
    return toxicity.clean_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def _without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return neardup.kept_documents(docs, NEAR_COPY)


def _without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of ``benchmark`` go."""
    return decontam.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def _without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced by the name of its kind."""
    return pii.masked_documents(docs)


def _mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the mix, with the number of copies and the words they give."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("toxicity", _without_toxic),
    ("near_duplicates", _without_copies),
    ("decontamination", _without_benchmark),
    ("personal_data", _without_personal_data),
    ("mixing", _mixed),
]

# Stages learn and hash in ways that SQL cannot express; tests compare them with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of ``documents``; every stage but the last is stored before the next begins."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with temporary(spark) as keep:
            docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
