"""Raw text rows to typed rows, with the lenient or strict casts each field calls for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.columns import lenient_time, strip, title_case, whole_number
from ..operators.dedup import first_per_key
from ..params import EVENT_TYPES


def _strict_number(name: str) -> Column:
    number = whole_number(F.col(name))
    fail = F.raise_error(F.concat(F.lit(f"{name} is not a whole number: "), F.col(name)))
    return F.when(F.col(name).isNotNull() & number.isNull(), fail.cast("bigint")).otherwise(number)


def keep_first(df: DataFrame, key: str) -> DataFrame:
    """The first row of each key in source order."""
    return first_per_key(df, [key], [F.col("pos").asc()])


def _with_user(raw: DataFrame, seen: Observation | None) -> DataFrame:
    """Parse ``user_id`` and drop rows without one; ``seen`` counts both in the same pass."""
    df = raw.withColumn("user_id", whole_number(F.col("user_id")))
    if seen is not None:
        no_user = F.col("user_id").isNull()
        counts = [F.count("*").alias("rows"), F.count_if(no_user).alias("dropped")]
        if "event_type" in df.columns:
            booking = F.lower(strip(F.col("event_type"))).startswith("booking_")
            counts.append(F.count_if(no_user & booking).alias("booking_dropped"))
        df = df.observe(seen, *counts)
    return df.filter(F.col("user_id").isNotNull())


def users(raw: DataFrame, seen: Observation | None = None) -> DataFrame:
    return keep_first(_with_user(raw, seen), "user_id").select(
        "user_id",
        _strict_number("company_id").alias("company_id"),
        lenient_time(F.col("signup_date")).alias("signup_date"),
        F.lower(strip(F.col("status"))).alias("status"),
    )


def mentors(raw: DataFrame) -> DataFrame:
    return raw.select(
        strip(F.col("mentor_id")).alias("mentor_id"),
        title_case(strip(F.col("tier"))).alias("tier"),
        F.coalesce(whole_number(F.col("hourly_rate")), F.lit(0)).alias("hourly_rate"),
    )


def events(raw: DataFrame, seen: Observation | None = None) -> DataFrame:
    return keep_first(_with_user(raw, seen), "event_id").select(
        "event_id",
        "user_id",
        strip(F.col("mentor_id")).alias("mentor_id"),
        lenient_time(F.col("timestamp")).alias("timestamp"),
        F.lower(strip(F.col("event_type"))).alias("event_type"),
    )


def unknown_types(events: DataFrame) -> DataFrame:
    """Event types outside the vocabulary with their number, most frequent first."""
    return (
        events.filter(~F.col("event_type").isin(list(EVENT_TYPES)))
        .groupBy("event_type")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "event_type")
    )


def booking_null_users(raw: DataFrame) -> DataFrame:
    """Booking events whose user does not parse, by type; to be run before they are dropped."""
    kind = F.lower(strip(F.col("event_type")))
    return (
        raw.filter(kind.startswith("booking_") & whole_number(F.col("user_id")).isNull())
        .groupBy(kind.alias("event_type"))
        .agg(F.count("*").alias("n"))
    )
