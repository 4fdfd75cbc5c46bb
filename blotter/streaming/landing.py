"""Incremental ingest of a landing folder, with the rules of the batch ingest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from blotter.config import Config
from blotter.operators.validate import LOAD
from blotter.plans.jobs import ingest_lines, load_name
from blotter.session import prepare


def stream_ingest(
    spark: SparkSession,
    folder: str,
    cfg: Config,
    checkpoint: str,
    name: str,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Ingest every file not seen yet, then stop.

    Every file is a load of its own, known by the stream's `name` and its path, so what a file adds
    does not depend on how files fall into batches: replayed after a failure, or from the start
    with another checkpoint, a file replaces its own lines in the quarantine and nobody else's,
    and Bronze takes a trade_id once.
    """
    prepare(spark)
    reader = spark.readStream.schema("value STRING").format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    file = F.xxhash64(F.col("_metadata.file_path"))
    load = F.concat(F.lit(load_name(name) + "-"), F.lower(F.hex(file))).alias(LOAD)

    def take_in(batch: DataFrame, _: int) -> None:
        ingest_lines(batch, cfg)

    return (
        reader.load(folder)
        .select("value", load)
        .writeStream.foreachBatch(take_in)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
