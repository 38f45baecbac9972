"""One nested record per run, written at its start and again at its end."""

from __future__ import annotations

from dataclasses import asdict
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import first_per_key
from ..params import Params

SCHEMA = (
    "run_id bigint, started_at string, finished_at string, duration_seconds double,"
    " status string, config struct<environment:string, default_minutes:int,"
    " group_a:array<string>, group_b:array<string>, window_days:int,"
    " max_orphan_rate:double, max_minutes:int, known_tiers:array<string>,"
    " warehouse:string>, new_users_ingested bigint,"
    " new_events_ingested bigint, dq_checks_passed boolean, warnings array<string>,"
    " error_message string"
)
TIME_FORMAT = "%Y-%m-%dT%H:%M:%SZ"


def started(run_id: int, params: Params, at: datetime | None = None) -> dict:
    """The record of a run that begins ``at``."""
    at = at or datetime.now(timezone.utc)
    return {
        "run_id": run_id,
        "started_at": at.strftime(TIME_FORMAT),
        "finished_at": None,
        "duration_seconds": None,
        "status": "running",
        "config": asdict(params),
        "new_users_ingested": 0,
        "new_events_ingested": 0,
        "dq_checks_passed": False,
        "warnings": [],
        "error_message": None,
        "_at": at,
    }


def finished(entry: dict, status: str, at: datetime | None = None, **facts) -> dict:
    """The same record at its end; ``facts`` are counts, warnings and an error text."""
    at = at or datetime.now(timezone.utc)
    return {
        **entry,
        "finished_at": at.strftime(TIME_FORMAT),
        "duration_seconds": round((at - entry["_at"]).total_seconds(), 1),
        "status": status,
        **facts,
    }


def append(spark: SparkSession, path: str, entry: dict) -> None:
    row = {k: v for k, v in entry.items() if not k.startswith("_")}
    (
        spark.createDataFrame([row], SCHEMA)
        .withColumn("day", F.lit(row["started_at"][:10]))
        .coalesce(1)
        .write.mode("append")
        .partitionBy("day")
        .json(path)
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """All records of all days; empty when there is no log yet."""
    try:
        return spark.read.schema(SCHEMA).option("recursiveFileLookup", True).json(path)
    except AnalysisException:
        return spark.createDataFrame([], SCHEMA)


def next_run_id(spark: SparkSession, path: str) -> int:
    return (read(spark, path).agg(F.max("run_id")).first()[0] or 0) + 1


def latest(log: DataFrame) -> DataFrame:
    """One record per run: its end if it has one, else its start."""
    return first_per_key(log, ["run_id"], [F.col("finished_at").desc_nulls_last()])


def history(log: DataFrame, page: int | None = None, page_size: int = 20) -> DataFrame:
    """Flat run history, newest first; ``page`` counts from 0."""
    config = F.col("config")
    flat = latest(log).select(
        "run_id",
        "started_at",
        "status",
        F.col("duration_seconds").alias("duration_s"),
        F.array_join(config["group_a"], "/").alias("group_a"),
        F.array_join(config["group_b"], "/").alias("group_b"),
        config["window_days"].alias("window_days"),
        F.col("new_users_ingested").alias("new_users"),
        F.col("dq_checks_passed").alias("dq_passed"),
        F.coalesce(F.size("warnings"), F.lit(0)).alias("warnings"),
    ).orderBy(F.desc("started_at"), F.desc("run_id"))
    return flat if page is None else flat.offset(page * page_size).limit(page_size)
