"""Paths on whatever file system Spark is set up for.

Reading needs Spark's own readers only. Deleting and moving have none; the two functions that do
it are all there is to replace for a session without a local JVM.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def stored_bytes(spark: SparkSession, *paths: str) -> int:
    """Size of all files under the paths, which may be patterns. A missing path counts as nothing."""
    total = 0
    for path in paths:
        try:
            files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
        else:
            total += files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    return total


def _locate(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    target, system = _locate(spark, path)
    system.delete(target, True)


def replace(spark: SparkSession, new: str, path: str) -> None:
    """Put a finished folder in the place of another, which is kept until the new one is there."""
    target, system = _locate(spark, path)
    finished, _ = _locate(spark, new)
    old, _ = _locate(spark, f"{new}.old")
    if system.exists(target) and not system.rename(target, old):
        raise OSError(f"could not move {path} aside")
    if not system.rename(finished, target):
        if system.exists(old):
            system.rename(old, target)
        raise OSError(f"could not move {new} to {path}")
    system.delete(old, True)


def publish_part(spark: SparkSession, folder: str, path: str) -> None:
    """Make the only part file of a finished folder the file at `path`; the folder goes."""
    source, system = _locate(spark, folder)
    parts = [f.getPath() for f in system.listStatus(source) if f.getPath().getName().startswith("part-")]
    if len(parts) != 1:
        raise OSError(f"{folder} has {len(parts)} part files, not one")
    replace(spark, parts[0].toString(), path)
    system.delete(source, True)
