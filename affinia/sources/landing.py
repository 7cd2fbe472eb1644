"""Landing of the input files as Parquet, and the tables kept next to them."""

import logging
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from affinia import schemas as S
from affinia.sources.csv_files import FILE, REJECTED, read_csv
from affinia.sources.workspace import exists

log = logging.getLogger(__name__)

# Layout below the base folder.
RAW = "raw"
PROCESSED = "processed"

_SCHEMAS = {
    S.RATINGS_FILE: S.RATINGS,
    S.CATALOG_FILE: S.CATALOG,
    S.TAGS_FILE: None,
    S.LINKS_FILE: None,
}


def _table(base: str, file_name: str) -> str:
    return f"{base.rstrip('/')}/{RAW}/{file_name.removesuffix('.csv')}"


def land_raw(spark: SparkSession, source_dir: str, base: str) -> str:
    """Copy every input file into ``base``/raw as Parquet; return that folder.

    A table that is complete is left as it is. One that an earlier run did not
    finish has no success marker and is written again. A file that is missing
    from the source is reported and skipped. Rows that did not fit their types are landed with
    their line and file, for ``landed_rejects``.
    """
    for file_name, schema in _SCHEMAS.items():
        target = _table(base, file_name)
        if exists(spark, f"{target}/_SUCCESS"):
            log.info("already landed: %s", target)
            continue
        try:
            rows = read_csv(spark, f"{source_dir.rstrip('/')}/{file_name}", schema, keep_rejected=schema is not None)
        except FileNotFoundError as error:
            log.warning("not landed: %s", error)
            continue
        if file_name == S.RATINGS_FILE:
            # A read for one user then skips the row groups of others.
            rows = rows.hint("rebalance", S.USER).sortWithinPartitions(S.USER, S.ITEM)
        rows.write.mode("overwrite").parquet(target)
    return f"{base.rstrip('/')}/{RAW}"


def _must_exist(spark: SparkSession, base: str, file_name: str) -> None:
    """A table without which nothing can go on; name it to the caller."""
    if not exists(spark, _table(base, file_name)):
        raise FileNotFoundError(f"{file_name} was not among the input files and is not landed in {base}")


def landed_ratings(spark: SparkSession, base: str) -> DataFrame:
    _must_exist(spark, base, S.RATINGS_FILE)
    return spark.read.schema(S.RATINGS).parquet(_table(base, S.RATINGS_FILE))


def landed_catalog(spark: SparkSession, base: str) -> DataFrame:
    _must_exist(spark, base, S.CATALOG_FILE)
    return spark.read.schema(S.CATALOG).parquet(_table(base, S.CATALOG_FILE))


def _rejects(spark: SparkSession, base: str, file_name: str, schema: StructType) -> DataFrame:
    kept = [StructField(name, StringType()) for name in (REJECTED, FILE)]
    rows = spark.read.schema(StructType([*schema, *kept])).parquet(_table(base, file_name))
    empty = F.concat_ws(",", *(F.when(F.col(field.name).isNull(), F.lit(field.name)) for field in schema))
    return rows.where(F.col(REJECTED).isNotNull()).select(
        F.lit(file_name).alias("source"),
        F.element_at(F.split(FILE, "/"), -1).alias("file"),
        F.when(empty == "", "number of cells").otherwise(F.concat(F.lit("no value for "), empty)).alias("cause"),
        F.col(REJECTED).alias("line"),
    )


def landed_rejects(spark: SparkSession, base: str) -> DataFrame:
    """Rows (source, file, cause, line) that were landed with a cell that did not fit.

    They are read from the landed tables, which keep them next to what could be read of them; the
    files are not parsed again, and row groups without any are skipped.
    """
    found = [
        _rejects(spark, base, name, schema)
        for name, schema in _SCHEMAS.items()
        if schema is not None and exists(spark, _table(base, name))
    ]
    if not found:
        return spark.createDataFrame([], "source string, file string, cause string, line string")
    return reduce(DataFrame.unionByName, found)


def write_processed(split: DataFrame, base: str) -> DataFrame:
    """Keep cleaned, split ratings, one folder for each side of the split.

    Files are sorted by user, so a read for one user skips the row groups of
    others. Rebalancing keeps the files of similar size, and spreads a very
    active user over several of them.
    """
    path = f"{base.rstrip('/')}/{PROCESSED}"
    ordered = split.hint("rebalance", S.USER).sortWithinPartitions(S.SPLIT, S.USER, S.ITEM)
    ordered.write.mode("overwrite").partitionBy(S.SPLIT).parquet(path)
    return split.sparkSession.read.schema(split.schema).parquet(path)
