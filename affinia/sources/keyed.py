"""Tables of which single keys are read: factors for one user or item, answers for one user.

Rows are dealt to folders by the remainder of their key and sorted by it, in row groups of
about a megabyte. A read by key opens the one folder that the key can be in, and the least and
greatest keys that Parquet keeps of each row group rule out all but one. The cost of a read does not grow
with the table.
"""

from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinia.sources.published import current, publish
from affinia.sources.workspace import hadoop

ROWS_IN_FOLDER = 250_000
ROW_GROUP_BYTES = 1 << 20
_FOLDERS, _FOLDER = "_folders", "_folder"


def write_keyed(
    table: DataFrame, path: str, key: str, *order: str, rows_in_folder: int = ROWS_IN_FOLDER
) -> None:
    """Write a table to a new folder for reads by an integer column; rows of one key come in ``order``.

    Rows without a key are in the table, but no read by key finds them.
    """
    count = table.count()
    if not count:
        table.write.parquet(path)  # without folders, but with the schema
        return
    folders = ceil(count / rows_in_folder)
    folder = F.coalesce(F.pmod(F.col(key), F.lit(folders)), F.lit(0)).cast("int")
    rows = table.withColumns({_FOLDERS: F.lit(folders), _FOLDER: folder})
    # One task per folder: it is bounded by the rows of a folder, or of one key.
    rows = rows.repartition(folders, _FOLDER).sortWithinPartitions(_FOLDER, key, *order)
    writer = rows.write.partitionBy(_FOLDERS, _FOLDER)
    writer.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)


def publish_keyed(table: DataFrame, base: str, key: str, *order: str, **how) -> str:
    """The same in place of an older table, which is read until the new one is complete."""
    return publish(table.sparkSession, base, lambda path: write_keyed(table, path, key, *order, **how))


def read_keyed(spark: SparkSession, base: str) -> DataFrame:
    """The whole table."""
    return spark.read.parquet(current(spark, base.rstrip('/'))).drop(_FOLDERS, _FOLDER)


def read_key(spark: SparkSession, base: str, key: str, value: int) -> DataFrame:
    """The rows of one key."""
    path, files = hadoop(spark, current(spark, base.rstrip('/')))
    counts = [s.getPath().getName() for s in files.listStatus(path) if s.getPath().getName().startswith(_FOLDERS)]
    if not counts:  # a table without rows
        return read_keyed(spark, base).where(F.col(key) == value)
    folders = int(counts[0].partition("=")[2])
    folder, _ = hadoop(spark, f"{path}/{counts[0]}/{_FOLDER}={value % folders}")
    if not files.exists(folder):
        return read_keyed(spark, base).limit(0)
    return spark.read.parquet(str(folder)).where(F.col(key) == value)
