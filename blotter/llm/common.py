"""What several of the operators need: document keys, shared storage and size-checked joins."""

from __future__ import annotations

import gc
import os
import shutil
import tempfile
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Workers are kept for later tasks; with the system's allocator they give memory of a batch back.
pa.set_memory_pool(pa.system_memory_pool())

# The bytes [\x20\x09-\x0D]; bytes.split() and bytes.strip() use just these.
SPACES = " \t\n\x0b\x0c\r"

# A null id takes part as this one, so that ids sort and join; results give it back as null.
NULL_ID = -(1 << 63)

# A table of at most this many narrow rows may be broadcast.
BROADCAST_ROWS = 200_000


def doc_key(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """`_id` and `_th`: rows that agree in both are the same document, repeated."""
    return [
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(NULL_ID)).alias("_id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_th"),
    ]


def given_id(column: str = "_id", name: str = "doc_id") -> Column:
    return F.when(F.col(column) != NULL_ID, F.col(column)).alias(name)


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`_id`, `_th` and `_text` (null as empty). Other columns are left behind."""
    text = F.coalesce(F.col(text_col), F.lit("")).alias("_text")
    return docs.select(*doc_key(id_col, text_col), text)


def with_key(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The key beside the whole row as one struct, so that no column name can clash."""
    return docs.select(*doc_key(id_col, text_col), F.struct("*").alias("_row"))


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        root, name = os.path.split(package)
        archive = os.path.join(tempfile.mkdtemp(), name)
        context.addPyFile(shutil.make_archive(archive, "zip", root, name))
        _shipped.add(context.applicationId)


# Rows that travel to a Python worker at once: of whole texts, a few megabytes.
BATCH_ROWS = 2000


def prepare(spark: SparkSession) -> SparkSession:
    """What the operators need of a session: their package on the workers, and small batches."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; a folder of this process only in a local session that names none."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = os.path.join(tempfile.gettempdir(), f"blotter-{os.getpid()}")
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a copy in the shared folder, which outlives lost executors."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def stored(df: DataFrame, **options: str) -> DataFrame:
    """Write a table to the shared folder and read it back: each reader loads its columns only."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/blotter-llm/{uuid4().hex}"
    df.write.options(**({"compression": "zstd"} | options)).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Delete a table of stored() that nobody reads any more."""
    spark = table.sparkSession
    for path in {os.path.dirname(file) for file in table.inputFiles()}:
        if "/blotter-llm/" not in path:
            raise ValueError(f"{path} is no table of stored()")
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of results that were stored since.

    It does so when the driver has collected their last references, which may be long after.
    """
    gc.collect()
    spark._jvm.System.gc()


def small_enough(table: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a checkpointed table for broadcast if its rows, counted, are at most `limit`.

    Beyond the limit Spark shuffles both sides and splits skewed partitions by itself.
    """
    return F.broadcast(table) if table.count() <= limit else table
