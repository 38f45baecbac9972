"""The event log as a stream: the batch jobs, run on every micro-batch."""

from __future__ import annotations

import zlib
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.lanes import SkewPolicy
from ..params import Params
from ..plans import jobs
from ..sources import files, normalize
from ..sources.tables import Warehouse


def read_lines(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """New files of one JSON event per line, with each row's file and block."""
    return (
        spark.readStream.schema(files.EVENT_SCHEMA)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(path)
        .select("*", F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("block"))
    )


def ingest(wh: Warehouse, stream: DataFrame, checkpoint: str, first_batch: int | None = None,
           params: Params | None = None, as_of: datetime | None = None,
           policy: SkewPolicy = SkewPolicy(), **trigger) -> StreamingQuery:
    """Append unseen events; with ``params`` also bring dimensions and facts up to date.

    A micro-batch is stored under its own batch number, counted from ``first_batch``; by default
    the checkpoint's path gives the first one, so streams do not share numbers, among themselves
    or with batch loads, and a micro-batch that Spark repeats gets its old number. Events that
    are stored already are left out, so every event is stored once.
    """
    if first_batch is None:
        first_batch = (1 << 62) + (zlib.crc32(checkpoint.encode()) << 28)

    def step(rows: DataFrame, epoch: int) -> None:
        place = F.struct("file", "block", F.monotonically_increasing_id().alias("row"))
        typed = normalize.events(rows.withColumn("pos", place))
        jobs.store_events(wh, typed, first_batch + epoch)
        if params is not None:
            jobs.transform(wh, params, as_of, policy)

    return (
        stream.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
