"""The analytical questions: repeat rate, booking reliability, intent to return."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import days_after, percent, wilson
from ..operators.dedup import first_per_key
from ..params import TIERS
from .dims import current


def _with_tier(facts: DataFrame, dim: DataFrame) -> DataFrame:
    """Facts with the mentor's current tier; Spark broadcasts the dimension if it is small
    by its own size check, and else joins by shuffle with its skew handling."""
    return facts.join(current(dim).select("mentor_id", "tier"), "mentor_id")


def rebooking(sessions: DataFrame, dim: DataFrame, group_a=("Gold",),
              group_b=("Silver", "Bronze"), window_days: int | None = 30) -> DataFrame:
    """Share of users with another session within ``window_days`` of their first one.

    Only sessions in the configured tiers count; a user belongs to the group of the first.
    Whether some later session lies in the window is decided by the second one alone, so two
    rows per user are enough and a user with very many sessions costs no more than others.
    """
    a, b = list(group_a), list(group_b)
    group = F.when(F.col("tier").isin(a), F.lit("/".join(a))).otherwise(F.lit("/".join(b)))
    ours = _with_tier(
        sessions.select("user_id", "mentor_id", "started_at", "session_id"),
        dim.filter(F.col("valid_to").isNull()),
    ).filter(F.col("tier").isin(a + b))
    two = first_per_key(
        ours.select("user_id", "started_at", "session_id", group.alias("mentor_tier")),
        ["user_id"],
        [F.col("started_at").asc_nulls_last(), F.col("session_id").asc_nulls_last()],
        n=2,
        rank="place",
    )
    first, second = F.col("place") == 1, F.col("place") == 2
    users = two.groupBy("user_id").agg(
        F.max(F.when(first, F.col("mentor_tier"))).alias("mentor_tier"),
        F.max(F.when(first, F.col("started_at"))).alias("first_at"),
        F.max(F.when(second, F.col("started_at"))).alias("second_at"),
        F.max("place").alias("places"),
    )
    again = (F.col("places") == 2) & F.col("user_id").isNotNull()
    if window_days is not None:
        again = again & (F.col("second_at") <= days_after(F.col("first_at"), window_days))
    return (
        users.select("mentor_tier", F.when(again, 1).otherwise(0).alias("rebooked"))
        .groupBy("mentor_tier")
        .agg(
            F.count("*").alias("total_users"),
            F.sum("rebooked").alias("users_rebooked"),
            F.round(F.avg("rebooked") * 100, 1).alias("rebooking_rate_pct"),
        )
        .orderBy(F.desc("rebooking_rate_pct"))
    )


def return_gaps(sessions: DataFrame, dim: DataFrame, tier_sets: list[list[str]]) -> DataFrame:
    """(tier_set, mentor_tier, days, users): how many users come back after how many days at the earliest.

    A user counts once for each set of tiers with a session in it, under the tier of the first of
    those sessions. ``days`` is the smallest window that holds the second one, null if there is
    none. The first two sessions in each tier decide about every set, so the log is read once, and
    a user takes at most two rows for each tier.
    """
    ours = _with_tier(
        sessions.select("user_id", "mentor_id", "started_at", "session_id"),
        dim.filter(F.col("valid_to").isNull()),
    ).filter(F.col("tier").isin(sorted({t for tiers in tier_sets for t in tiers})))
    order = [F.col("started_at").asc_nulls_last(), F.col("session_id").asc_nulls_last()]
    two = first_per_key(ours.select("user_id", "started_at", "session_id", "tier"), ["user_id", "tier"], order, n=2)
    visit = F.struct(
        F.col("started_at").isNull().alias("no_time"),
        F.unix_micros(F.col("started_at").cast("timestamp")).alias("at"),
        F.col("session_id").isNull().alias("no_id"),
        "session_id",
        "tier",
    )
    users = two.groupBy("user_id").agg(F.sort_array(F.collect_list(visit)).alias("visits"))

    def among(tiers: list[str]):
        return F.filter("visits", lambda v: v["tier"].isin(tiers))

    in_set = [F.struct(F.lit(i).alias("tier_set"), among(tiers).alias("v")) for i, tiers in enumerate(tier_sets)]
    first, second = F.get("v", F.lit(0)), F.get("v", F.lit(1))
    day = F.expr("86400000000L")
    gap = F.when(F.col("user_id").isNotNull(), second["at"] - first["at"])
    return (
        users.select("user_id", F.inline(F.array(*in_set)))
        .filter(F.size("v") > 0)
        .select("tier_set", first["tier"].alias("mentor_tier"), F.ceil(gap / day).alias("days"))
        .groupBy("tier_set", "mentor_tier", "days")
        .agg(F.count("*").alias("users"))
    )


def what_if(sessions: DataFrame, dim: DataFrame, groupings: list[tuple], windows: range) -> DataFrame:
    """What :func:`rebooking` gives for every window of days and every pair (group_a, group_b) of tiers.

    All of it comes from one table of gaps, which has at most a row for each set, tier and day; the
    users who came back within a window are those with a gap up to it. Adds ``grouping``, the
    place in ``groupings``, and ``window_days``.
    """
    spark = sessions.sparkSession
    rows = [
        (i, tier, "/".join(group))
        for i, pair in enumerate(groupings)
        for group in reversed(pair)
        for tier in group
    ]
    # A tier in both groups belongs to the first.
    labels = {(i, tier): label for i, tier, label in rows}
    named = spark.createDataFrame(
        [(*k, v) for k, v in labels.items()], "tier_set int, mentor_tier string, label string"
    )
    gaps = return_gaps(sessions, dim, [[*a, *b] for a, b in groupings])
    grouped = (
        gaps.join(F.broadcast(named), ["tier_set", "mentor_tier"])
        .groupBy("tier_set", "label", F.col("days"))
        .agg(F.sum("users").alias("users"))
    )
    within = F.array(*[F.struct(F.lit(w).alias("window_days")) for w in windows])
    soon = F.when(F.col("days") <= F.col("window_days"), F.col("users")).otherwise(0)
    return (
        grouped.select("*", F.inline(within))
        .groupBy(F.col("tier_set").alias("grouping"), "window_days", F.col("label").alias("mentor_tier"))
        .agg(F.sum("users").alias("total_users"), F.sum(soon).alias("users_rebooked"))
        .withColumn("rebooking_rate_pct", F.round(F.col("users_rebooked") / F.col("total_users") * 100, 1))
    )


def with_wilson(df: DataFrame, k: str = "users_rebooked", n: str = "total_users",
                z: float = 1.96) -> DataFrame:
    low, high = wilson(F.col(k), F.col(n), z)
    return df.withColumns({"ci_lower_pct": low, "ci_upper_pct": high})


def with_sanity(df: DataFrame, rate: str = "rebooking_rate_pct", n: str = "total_users",
                min_users: int = 30) -> DataFrame:
    """Add ``warning``: too few users to rely on, or a rate of exactly 0 or 100 percent."""
    return df.withColumn(
        "warning",
        F.when(F.col(n) < min_users, "directional only")
        .when(F.col(rate) == 100.0, "rate is 100%")
        .when(F.col(rate) == 0.0, "rate is 0%"),
    )


# The headings reports are shown with.
HEADINGS = {
    "mentor_tier": "Tier",
    "total_users": "Total Users",
    "users_rebooked": "Rebooked",
    "rebooking_rate_pct": "Rate (%)",
    "ci_lower_pct": "95% CI Lower",
    "ci_upper_pct": "95% CI Upper",
    "confirmation_rate_pct": "Confirmed (%)",
    "no_show_rate_pct": "No-show (%)",
    "cancellation_rate_pct": "Cancelled (%)",
}


def titled(report: DataFrame) -> DataFrame:
    """The columns of a report that have a heading, under that heading."""
    return report.select(
        *[F.col(c).alias(HEADINGS[c]) for c in report.columns if c in HEADINGS]
    )


_COUNTS = ["total_bookings", "confirmed_count", "cancelled_count", "no_show_count",
           "pending_count"]


def reliability(bookings: DataFrame, dim: DataFrame) -> DataFrame:
    """Booking outcomes per current tier. Bookings shrink to one row per mentor first."""
    status = F.col("outcome_status")
    per_mentor = bookings.groupBy("mentor_id").agg(
        F.count("*").alias("total_bookings"),
        F.count_if(status.isin("confirmed_attended", "no_show")).alias("confirmed_count"),
        F.count_if(status == "cancelled").alias("cancelled_count"),
        F.count_if(status == "no_show").alias("no_show_count"),
        F.count_if(status == "pending").alias("pending_count"),
    )
    per_tier = (
        _with_tier(per_mentor, dim)
        .groupBy(F.col("tier").alias("mentor_tier"))
        .agg(*[F.sum(c).alias(c) for c in _COUNTS])
    )
    total, confirmed = F.col("total_bookings"), F.col("confirmed_count")
    return per_tier.select(
        "*",
        percent(confirmed, total).alias("confirmation_rate_pct"),
        percent(F.col("no_show_count"), confirmed).alias("no_show_rate_pct"),
        percent(F.col("cancelled_count"), total).alias("cancellation_rate_pct"),
    ).orderBy(F.desc("total_bookings"))


def reliability_total(report: DataFrame) -> DataFrame:
    """One row over all tiers: counts, and their shares."""
    total = F.col("total_bookings")
    return report.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _COUNTS]).select(
        *_COUNTS,
        percent(F.col("confirmed_count"), total).alias("confirmed_pct"),
        percent(F.col("cancelled_count"), total).alias("cancelled_pct"),
        percent(
            F.col("no_show_count"), F.greatest(F.col("confirmed_count"), F.lit(1))
        ).alias("no_show_pct"),
        percent(F.col("pending_count"), total).alias("pending_pct"),
    )


def reliability_pivot(report: DataFrame, tiers=TIERS) -> DataFrame:
    """The report turned: one row per metric, one column per tier."""
    metrics = [c for c in report.columns if c != "mentor_tier"]
    doubles = report.select("mentor_tier", *[F.col(c).cast("double").alias(c) for c in metrics])
    return (
        doubles.unpivot("mentor_tier", metrics, "metric", "value")
        .groupBy("metric")
        .pivot("mentor_tier", list(tiers))
        .agg(F.first("value"))
    )


def intent(sessions: DataFrame, bookings: DataFrame, dim: DataFrame, group_a=("Gold",),
           label_b: str = "Silver/Bronze", window_days: int = 30) -> DataFrame:
    """Users who request a booking within ``window_days`` after their first session.

    A user counts in every outcome one of these requests reached. Requests shrink to one row
    per user, outcome and day before they meet the first session: with the earliest and
    latest request of the day at hand, a window of whole days loses nothing by that.
    """
    if window_days < 1:
        raise ValueError("window_days must be a whole number of days")
    a = list(group_a)
    firsts = first_per_key(
        _with_tier(
            sessions.filter(F.col("user_id").isNotNull()).select(
                "user_id", "mentor_id", "started_at", "session_id"
            ),
            dim,
        ),
        ["user_id"],
        [F.col("started_at").asc_nulls_last(), F.col("session_id").asc_nulls_last()],
    ).select(
        "user_id",
        F.col("started_at").alias("first_at"),
        F.when(F.col("tier").isin(a), F.lit("/".join(a))).otherwise(F.lit(label_b)).alias(
            "tier_group"
        ),
    )
    daily = (
        bookings.filter(F.col("user_id").isNotNull() & F.col("requested_at").isNotNull())
        .groupBy(
            F.col("user_id").alias("booker"), "outcome_status", F.to_date("requested_at")
        )
        .agg(F.min("requested_at").alias("earliest"), F.max("requested_at").alias("latest"))
    )
    in_window = (
        (F.col("booker") == F.col("user_id"))
        & (F.col("latest") > F.col("first_at"))
        & (F.col("earliest") <= days_after(F.col("first_at"), window_days))
    )

    def reached(status):
        return F.coalesce(F.bool_or(F.col("outcome_status") == status), F.lit(False))

    users = (
        firsts.join(daily, in_window, "left")
        .groupBy("user_id", "tier_group")
        .agg(
            (F.count("booker") > 0).alias("intends"),
            reached("confirmed_attended").alias("attended"),
            reached("no_show").alias("noshow"),
            reached("cancelled").alias("cancelled"),
        )
    )
    total, intends = F.col("total_users"), F.col("users_with_intent")
    attended = F.col("users_intent_attended")
    return (
        users.groupBy("tier_group")
        .agg(
            F.count("*").alias("total_users"),
            F.count_if("intends").alias("users_with_intent"),
            F.count_if("attended").alias("users_intent_attended"),
            F.count_if("noshow").alias("users_intent_noshow"),
            F.count_if("cancelled").alias("users_intent_cancelled"),
        )
        .select(
            "*",
            percent(intends, total).alias("intent_rate_pct"),
            percent(attended, total).alias("intent_attended_pct"),
            percent(attended, intends).alias("commitment_rate_pct"),
        )
        .orderBy("tier_group")
    )
