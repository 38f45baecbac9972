"""Session settings the jobs are written for."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    # Zoned input strings become UTC wall-clock times, whatever the host's zone.
    "spark.sql.session.timeZone": "UTC",
    # Strict casts fail instead of turning bad values into NULL.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rewriting one batch must leave the other batches of a table alone.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``SETTINGS`` to a session that already runs."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str | None:
    """The folder the cluster names for data all executors must see; None where it names none."""
    return spark.conf.get("spark.checkpoint.dir", None)


def new_folder(spark: SparkSession, tag: str) -> str:
    """A name no one else uses in the shared folder; in local mode, where none is named, a temporary one."""
    shared = shared_dir(spark)
    if not shared:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors see")
        shared = "file://" + tempfile.mkdtemp(prefix="sojourn-")
    return f"{shared.rstrip('/')}/{tag}-{uuid.uuid4().hex}"
