"""Readers for the delimited input files."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StringType, StructType

from affinia import schemas as S


# Columns that landed tables have besides those of the file.
REJECTED = "_rejected"  # the line, if a cell of it did not fit or their number was wrong
FILE = "_file"  # where that line is


def read_csv(
    spark: SparkSession, path: str, schema: StructType | None = None, keep_rejected: bool = False
) -> DataFrame:
    """Read a CSV file with a header line.

    Quotes inside a quoted cell are doubled. The header must name the columns
    of ``schema`` in the same order: a file with swapped columns is an error
    rather than a table with swapped values. Cells that do not fit their type
    become null. Without a schema every column is text. With ``keep_rejected`` two more columns
    hold the line and the file of rows that did not fit; both are null in the others.
    """
    reader = spark.read.option("header", True).option("escape", '"')
    if schema is not None:
        reader = reader.option("enforceSchema", False)
        reader = reader.schema(StructType([*schema, StructField(REJECTED, StringType())]) if keep_rejected else schema)
        if keep_rejected:
            reader = reader.option("columnNameOfCorruptRecord", REJECTED)
    try:
        rows = reader.csv(path)
        if keep_rejected and schema is not None:
            rows = rows.withColumn(FILE, F.when(F.col(REJECTED).isNotNull(), F.col("_metadata.file_path")))
        return rows
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            folder, _, name = path.rpartition("/")
            raise FileNotFoundError(f"{name} not found in {folder}") from error
        raise


def read_ratings(spark: SparkSession, data_dir: str) -> DataFrame:
    return read_csv(spark, f"{data_dir.rstrip('/')}/{S.RATINGS_FILE}", S.RATINGS)


def read_catalog(spark: SparkSession, data_dir: str) -> DataFrame:
    return read_csv(spark, f"{data_dir.rstrip('/')}/{S.CATALOG_FILE}", S.CATALOG)
