"""Stored results in versions, of which readers see the last complete one.

A version is written to a folder of its own. When it is complete, a small file next to the
versions, whose name never changes, is replaced in one step by one that names it. A
writer that dies half-way leaves that file as it was, so readers never meet a missing or half-written
result. The version before stays for readers that have begun with it; older ones, and
what dead writers left, are deleted.
"""

import time
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from affinia.sources.workspace import exists, hadoop

KEPT = 2
_POINTER, _VERSIONS = "CURRENT", "versions"


def publish(spark: SparkSession, base: str, write: Callable[[str], object], kept: int = KEPT) -> str:
    """Let ``write`` fill a new folder, then make it the current version; return its path."""
    base = base.rstrip("/")
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex}"  # names sort by time
    write(f"{base}/{_VERSIONS}/{version}")
    _point(spark, base, version)
    _forget(spark, base, kept)
    return f"{base}/{_VERSIONS}/{version}"


def current(spark: SparkSession, base: str) -> str:
    """Path of the current version; ``base`` itself if nothing was published there."""
    base = base.rstrip("/")
    if not exists(spark, f"{base}/{_POINTER}"):
        return base
    path, files = hadoop(spark, f"{base}/{_POINTER}")
    stream = files.open(path)
    try:
        version = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return f"{base}/{_VERSIONS}/{version}"


def versions(spark: SparkSession, base: str) -> list[str]:
    """Names of all versions, complete or not, oldest first."""
    path, files = hadoop(spark, f"{base.rstrip('/')}/{_VERSIONS}")
    return sorted(status.getPath().getName() for status in files.listStatus(path)) if files.exists(path) else []


def _point(spark: SparkSession, base: str, version: str) -> None:
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    new, files = hadoop(spark, f"{base}/.{_POINTER}-{version}")
    stream = files.create(new)
    try:
        stream.write(bytearray(version.encode()))
    finally:
        stream.close()
    # A rename that overwrites replaces the file in one step.
    pointer, _ = hadoop(spark, f"{base}/{_POINTER}")
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), conf)
    context.rename(files.makeQualified(new), files.makeQualified(pointer), how)


def _forget(spark: SparkSession, base: str, kept: int) -> None:
    current_name = current(spark, base).rpartition("/")[2]
    for name in versions(spark, base)[: -max(kept, 1)]:
        if name != current_name:
            path, files = hadoop(spark, f"{base}/{_VERSIONS}/{name}")
            files.delete(path, True)
