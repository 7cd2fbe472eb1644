"""The shared folder that holds checkpoints and tables written between steps."""

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, as the session names it.

    Only a local session, which has no other machines, may fall back to a
    temporary folder.
    """
    folder = spark.conf.get(_CHECKPOINT_DIR, None)
    if folder:
        return folder
    sc = spark.sparkContext
    folder = sc.getCheckpointDir()
    if folder:
        return folder
    if not sc.master.startswith("local"):
        raise ValueError(f"set {_CHECKPOINT_DIR} to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="affinia-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def ensure_checkpoints(spark: SparkSession) -> None:
    """Let iterative jobs cut their lineage."""
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)


def new_folder(spark: SparkSession, label: str) -> str:
    """Path below the shared folder that no other run uses."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


# Folders that ``written`` has made since the innermost ``temporary`` began.
_OWNED: ContextVar[list[str] | None] = ContextVar("owned", default=None)


def written(df: DataFrame, label: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Later steps then start from files: they do not repeat the work before the
    write, and a lost executor does not cause it to be repeated either. The table is deleted when the
    session's driver ends, or with the ``temporary`` block it was written in.
    """
    folder = new_folder(df.sparkSession, label)
    delete_at_exit(df.sparkSession, folder)
    owned = _OWNED.get()
    if owned is not None:
        owned.append(folder)
    return _written_to(df, folder, partition_by)


def delete_at_exit(spark: SparkSession, folder: str) -> None:
    """Let the driver delete a folder of this session when it ends."""
    path, files = hadoop(spark, folder)
    files.deleteOnExit(path)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Delete what ``written`` writes inside, at the end; the function given keeps a table.

    A result that is still to be computed from these tables has to be kept, which writes it.
    """
    outer, owned, kept = _OWNED.get(), [], []
    token = _OWNED.set(owned)

    def keep(df: DataFrame, label: str) -> DataFrame:
        result = written(df, label)
        kept.append(owned.pop())
        return result

    try:
        yield keep
    finally:
        _OWNED.reset(token)
        if outer is not None:
            outer += kept
        for folder in owned:
            path, files = hadoop(spark, folder)
            files.delete(path, True)


@contextmanager
def staging(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A function like ``written`` whose tables are deleted at the end.

    Whatever reads them has to be stored before that.
    """
    folder = new_folder(spark, "staging")
    try:
        yield lambda df, label: _written_to(df, f"{folder}/{label}")
    finally:
        path, files = hadoop(spark, folder)
        files.delete(path, True)


def _written_to(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hadoop(spark: SparkSession, path: str):
    """A path, and the file system it is on."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists on any file system Spark can reach."""
    hadoop_path, files = hadoop(spark, path)
    return files.exists(hadoop_path)
