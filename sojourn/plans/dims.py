"""Staging views and dimensions of users and mentors."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import hash_key, wall_time
from ..operators.dedup import first_per_key


def now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def stamp(as_of: datetime | None):
    return wall_time(as_of or now()).alias("inserted_at")


def stg_users(raw_users: DataFrame) -> DataFrame:
    """One row per user: the earliest signup."""
    typed = raw_users.select(
        F.col("user_id").cast("bigint").alias("user_id"),
        F.col("company_id").cast("bigint").alias("company_id"),
        F.col("signup_date").cast("date").alias("signup_date"),
        "status",
    )
    order = [F.col(c).asc_nulls_last() for c in ("signup_date", "company_id", "status")]
    return first_per_key(typed, ["user_id"], order)


def stg_mentors(raw_mentors: DataFrame) -> DataFrame:
    return raw_mentors.select(
        F.trim("mentor_id").alias("mentor_id"),
        "tier",
        F.col("hourly_rate").cast("int").alias("hourly_rate"),
    )


def users(staged: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """User dimension rows; a user's attributes are taken once and not tracked."""
    return staged.select(
        hash_key(F.col("user_id"), F.col("company_id"), F.col("signup_date")).alias("user_hk"),
        "user_id",
        "company_id",
        "signup_date",
        "status",
        F.col("signup_date").alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        stamp(as_of),
    )


def mentors(snapshot: DataFrame) -> DataFrame:
    """Mentor dimension over a snapshot: one row per mentor, start date and tier."""
    day = F.to_date("dbt_valid_from")
    keyed = snapshot.withColumn("valid_from", day)
    latest = first_per_key(
        keyed, ["mentor_id", "valid_from", "tier"], [F.col("dbt_valid_from").desc_nulls_last()]
    )
    return latest.select(
        hash_key(F.col("mentor_id"), F.col("tier"), F.col("valid_from")).alias("mentor_hk"),
        "mentor_id",
        "tier",
        "hourly_rate",
        "valid_from",
        F.to_date("dbt_valid_to").alias("valid_to"),
        F.col("dbt_valid_from").alias("inserted_at"),
    )


def current(dim: DataFrame, key: str = "mentor_id") -> DataFrame:
    """The open row of each key; of several open ones the latest."""
    order = [F.col("valid_from").desc_nulls_last(), F.col("tier").asc()]
    return first_per_key(dim.filter(F.col("valid_to").isNull()), [key], order)
