"""Rebuild sessions and bookings from an unordered event log.

Each start (or request) owns the open interval up to the next start (or request) of the same
user and mentor; the first matching event strictly inside it is its end (or outcome).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import lanes
from .lanes import SkewPolicy, hot_timelines  # noqa: F401  (part of this module's surface)


def _timeline(events: DataFrame, kinds: list[str], hot) -> tuple:
    """Events of ``kinds`` with keys and lanes, those of hot timelines, and what can match.

    ``kind`` is the position in ``kinds``: the anchor is 0, and of two events at the same
    time the one with the lower kind does not match the other.
    """
    rows = events.filter(F.col("event_type").isin(kinds)).select(
        "event_id",
        F.col("user_id").cast("bigint").alias("user_id"),
        F.trim("mentor_id").alias("mentor_id"),
        F.col("timestamp").cast("timestamp_ntz").alias("at"),
        (F.array_position(F.lit(kinds), F.col("event_type")) - 1).cast("tinyint").alias("kind"),
    )
    # A row without a key or a time matches nothing; an anchor is still reported.
    usable = (
        F.col("user_id").isNotNull() & F.col("mentor_id").isNotNull() & F.col("at").isNotNull()
    )
    rows = rows.filter(usable | (F.col("kind") == 0))
    return *lanes.assign(rows, hot, usable), usable


def _at(kind: int):
    return F.when(F.col("kind") == kind, F.col("at"))


def sessions(events: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """One row per ``session_started``; ``ended_at`` is NULL when no end lies inside it.

    ``hot`` comes from :func:`hot_timelines` and only changes how the work is spread.
    """
    start, end = 0, 1
    rows, side, usable = _timeline(events, ["session_started", "session_ended"], hot)
    seen, _ = lanes.next_of(
        rows, side, {"next_start": _at(start), "next_end": _at(end)}, anchor="next_start"
    )
    inside = usable & (
        F.col("next_start").isNull() | (F.col("next_end") < F.col("next_start"))
    )
    return seen.filter(F.col("kind") == start).select(
        F.col("event_id").alias("session_start_event_id"),
        "user_id",
        "mentor_id",
        F.col("at").alias("started_at"),
        F.when(inside, F.col("next_end")).alias("ended_at"),
    )


def bookings(events: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """One row per ``booking_requested`` with its outcome and, if confirmed, first session.

    Outcome time and type are two independent minima: a confirmation that is cancelled later
    counts as cancelled, at the time of the confirmation.
    """
    request, confirm, cancel, session = range(4)
    rows, side, usable = _timeline(
        events,
        ["booking_requested", "booking_confirmed", "booking_cancelled", "session_started"],
        hot,
    )
    rows, side = lanes.next_of(
        rows,
        side,
        {
            "next_request": _at(request),
            "next_cancel": _at(cancel),
            "next_session": _at(session),
        },
        anchor="next_request",
    )
    # A confirmation brings along the first session after it.
    confirmation = F.struct(F.col("at").alias("at"), F.col("next_session").alias("session"))
    seen, _ = lanes.next_of(
        rows, side, {"confirm": F.when(F.col("kind") == confirm, confirmation)}
    )

    def inside(t):
        bound = F.col("next_request")
        return F.when(usable & (bound.isNull() | (t < bound)), t)

    paired = (
        seen.filter(F.col("kind") == request)
        .withColumn("cancelled_at", inside(F.col("next_cancel")))
        .withColumn("confirmed_at", inside(F.col("confirm.at")))
        .withColumn(
            "outcome_type",
            F.when(F.col("cancelled_at").isNotNull(), "booking_cancelled").when(
                F.col("confirmed_at").isNotNull(), "booking_confirmed"
            ),
        )
        .withColumn(
            "first_session_at",
            F.when(
                F.col("outcome_type") == "booking_confirmed", inside(F.col("confirm.session"))
            ),
        )
    )
    return paired.select(
        F.col("event_id").alias("booking_request_event_id"),
        "user_id",
        "mentor_id",
        F.col("at").alias("requested_at"),
        F.least("cancelled_at", "confirmed_at").alias("outcome_at"),
        "outcome_type",
        "first_session_at",
        F.col("first_session_at").isNotNull().alias("had_session_started"),
        F.col("outcome_type").isNull().alias("is_orphan_request"),
    )
