"""Session settings the transforms rely on, and shuffle sizing."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the transforms rely on, for results first and then for speed.
RUNTIME_SETTINGS = {
    # Hours and dates of a trade are UTC, whatever the machine's zone is.
    "spark.sql.session.timeZone": "UTC",
    # The JVM does not compile a method above 8000 bytes of bytecode but interprets it. Plans
    # with many expressions run several times faster when Spark splits such a method up.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(app_name: str = "blotter", cores: str = "*") -> SparkSession:
    """A session for development. On a cluster, pass the cluster's own session instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .config("spark.ui.enabled", "false")
    )
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere. Its resources stay as they are."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The cluster's shared folder. Only a local session may go without one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="blotter-")
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """Compute a DataFrame once, into the shared folder: what is built on it outlives lost executors."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(checkpoint_folder(df.sparkSession))
    return df.checkpoint()


@contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int, partition_bytes: int) -> Iterator[int]:
    """For one job, enough shuffle partitions that each holds about `partition_bytes`.

    Adaptive execution merges partitions that turn out small but cannot split a plain
    shuffle that was given too few, so the count is only ever raised. Afterwards the session
    has the count it had before.
    """
    before = spark.conf.get("spark.sql.shuffle.partitions")
    wanted = max(int(before), -(-input_bytes // partition_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    try:
        yield wanted
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
