"""Fact rows from paired events."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import hash_key, minutes_between
from .dims import stamp


def sessions(pairs: DataFrame, default_minutes: int = 30,
             as_of: datetime | None = None) -> DataFrame:
    """Session facts; a missing end becomes start plus the default, and is flagged."""
    usual = F.col("started_at") + F.make_dt_interval(mins=F.lit(int(default_minutes)))
    return pairs.select(
        hash_key(F.col("user_id"), F.col("mentor_id"), F.col("started_at")).alias("session_hk"),
        F.col("session_start_event_id").alias("session_id"),
        "user_id",
        "mentor_id",
        "started_at",
        F.coalesce("ended_at", usual).alias("ended_at"),
        F.col("ended_at").isNull().alias("is_duration_estimated"),
        minutes_between(F.col("started_at"), F.coalesce("ended_at", usual)).alias(
            "duration_minutes"
        ),
        F.to_date("started_at").alias("session_date"),
        stamp(as_of),
    )


def bookings(pairs: DataFrame, as_of: datetime | None = None) -> DataFrame:
    confirmed = F.col("outcome_type") == "booking_confirmed"
    return pairs.select(
        hash_key(F.col("user_id"), F.col("mentor_id"), F.col("requested_at")).alias("booking_hk"),
        F.col("booking_request_event_id").alias("booking_id"),
        "user_id",
        "mentor_id",
        "requested_at",
        "outcome_at",
        "first_session_at",
        F.when(confirmed & F.col("had_session_started"), "confirmed_attended")
        .when(confirmed, "no_show")
        .when(F.col("outcome_type") == "booking_cancelled", "cancelled")
        .otherwise("pending")
        .alias("outcome_status"),
        "is_orphan_request",
        stamp(as_of),
    )
