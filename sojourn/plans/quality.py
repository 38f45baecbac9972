"""Data-quality checks. Every check is one row:
``(check, table, column, severity, violations, passed, detail)``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..params import EVENT_TYPES, OUTCOMES, TIERS, Params

HALT, WARN = "halt", "warn"

# The declared column checks of every table, as
# table -> (never NULL, unique, allowed values, references).
RULES = {
    "raw_users": (["user_id", "company_id", "signup_date"], None, {}, []),
    "raw_mentors": (["mentor_id", "tier", "hourly_rate"], None, {"tier": TIERS}, []),
    "raw_events": (
        ["event_id", "user_id", "mentor_id"],
        "event_id",
        {"event_type": EVENT_TYPES},
        [],
    ),
    "stg_users": (["user_id", "company_id", "signup_date", "status"], "user_id", {}, []),
    "stg_mentors": (["mentor_id", "tier", "hourly_rate"], "mentor_id", {"tier": TIERS}, []),
    "stg_session_pairs": (
        ["session_start_event_id", "user_id", "mentor_id", "started_at"],
        "session_start_event_id",
        {},
        [],
    ),
    "stg_booking_pairs": (
        ["booking_request_event_id", "user_id", "mentor_id", "requested_at",
         "had_session_started", "is_orphan_request"],
        "booking_request_event_id",
        {},
        [],
    ),
    "dim_users": (
        ["user_hk", "user_id", "company_id", "signup_date", "valid_from", "inserted_at"],
        "user_hk",
        {},
        [],
    ),
    "dim_mentors": (
        ["mentor_hk", "mentor_id", "tier", "valid_from"],
        "mentor_hk",
        {"tier": TIERS},
        [],
    ),
    "fct_bookings": (
        ["booking_hk", "booking_id", "user_id", "mentor_id", "requested_at",
         "outcome_status", "is_orphan_request", "inserted_at"],
        "booking_hk",
        {"outcome_status": OUTCOMES},
        [("user_id", "dim_users", WARN), ("mentor_id", "dim_mentors", HALT)],
    ),
    "fct_sessions": (
        ["session_hk", "session_id", "user_id", "mentor_id", "started_at",
         "duration_minutes", "is_duration_estimated", "inserted_at"],
        "session_hk",
        {},
        [("user_id", "dim_users", HALT), ("mentor_id", "dim_mentors", HALT)],
    ),
}


class CheckFailed(ValueError):
    """A halting check found violations."""


class CheckBroken(RuntimeError):
    """A check could not be evaluated, which says nothing about the data."""


def _row(check, table, column, severity, violations, passed=None, detail=None):
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(table).alias("table"),
        F.lit(column).alias("column"),
        F.lit(severity).alias("severity"),
        violations.cast("bigint").alias("violations"),
        (violations == 0 if passed is None else passed).alias("passed"),
        (F.lit(None).cast("string") if detail is None else detail).alias("detail"),
    )


def _one_pass(df: DataFrame, table: str, tests: list[tuple]) -> DataFrame:
    """Several ``(check, column, predicate, severity)`` row tests in one aggregate."""
    sums = df.agg(*[F.count_if(bad).alias(f"t{i}") for i, (_, _, bad, _) in enumerate(tests)])
    rows = [
        _row(check, table, column, severity, F.col(f"t{i}"))
        for i, (check, column, _, severity) in enumerate(tests)
    ]
    return sums.select(F.inline(F.array(*rows)))


def _null_tests(columns):
    return [("not_null", c, F.col(c).isNull(), HALT) for c in columns]


def _value_tests(allowed):
    return [
        ("accepted_values", c, ~F.col(c).isin(list(values)), HALT)
        for c, values in allowed.items()
    ]


def not_null(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    return _one_pass(df, table, _null_tests(columns))


def accepted(df: DataFrame, table: str, allowed: dict) -> DataFrame:
    """Values outside the allowed ones; NULL passes."""
    return _one_pass(df, table, _value_tests(allowed))


def unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Number of values that occur more than once; NULL passes."""
    repeated = (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n"))
        .agg(F.count_if(F.col("n") > 1).alias("v"))
    )
    return repeated.select(F.inline(F.array(_row("unique", table, column, HALT, F.col("v")))))


def relationships(child: DataFrame, table: str, column: str, parent: DataFrame,
                  severity: str = HALT) -> DataFrame:
    """Child rows whose key the parent does not hold; NULL passes.

    Child keys are counted before the join: a frequent key is one row in it.
    """
    keys = (
        child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    )
    lost = keys.join(parent.select(column), column, "left_anti").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("v")
    )
    return lost.select(
        F.inline(F.array(_row("relationships", table, column, severity, F.col("v"))))
    )


def declared(frames: dict[str, DataFrame]) -> DataFrame:
    """The declared checks of every given table: one row pass plus one key pass each."""
    out = []
    for table, df in frames.items():
        nulls, key, allowed, refs = RULES[table]
        out.append(_one_pass(df, table, _null_tests(nulls) + _value_tests(allowed)))
        if key:
            out.append(unique(df, table, key))
        for column, parent, severity in refs:
            if parent in frames:
                out.append(relationships(df, table, column, frames[parent], severity))
    return reduce(DataFrame.unionByName, out)


def business(sessions: DataFrame, bookings: DataFrame | None = None,
             dim: DataFrame | None = None, params: Params | None = None) -> DataFrame:
    """Rules over durations, orphan bookings and configured tiers.

    Without ``bookings``, or with none in it, the orphan rule passes; without ``params`` or
    ``dim`` the tier rule is left out.
    """
    limits = params or Params()
    minutes = F.col("duration_minutes")
    out = [
        _one_pass(
            sessions,
            "fct_sessions",
            [
                ("negative_duration", "duration_minutes", minutes < 0, HALT),
                ("long_duration", "duration_minutes", minutes > limits.max_minutes, WARN),
            ],
        )
    ]
    if bookings is not None:
        orphans = bookings.agg(
            F.count("*").alias("n"), F.count_if("is_orphan_request").alias("v")
        )
        share = F.try_divide(F.col("v").cast("double"), F.col("n"))
        fine = F.coalesce(share <= limits.max_orphan_rate, F.lit(True))
        out.append(
            orphans.select(
                F.inline(F.array(_row("orphan_rate", "fct_bookings", "is_orphan_request",
                                      WARN, F.col("v"), fine)))
            )
        )
    if params is not None and dim is not None:
        tiers = dim.sparkSession.createDataFrame(
            [(t,) for t in params.group_a + params.group_b], "tier string"
        )
        missing = tiers.join(dim.select("tier").distinct(), "tier", "left_anti").agg(
            F.count("*").alias("v"), F.array_sort(F.collect_list("tier")).alias("names")
        )
        named = F.when(F.col("v") > 0, F.array_join("names", ","))
        out.append(
            missing.select(
                F.inline(F.array(_row("configured_tiers", "dim_mentors", "tier", HALT,
                                      F.col("v"), None, named)))
            )
        )
    return reduce(DataFrame.unionByName, out)


def available_tiers(dim: DataFrame) -> DataFrame:
    return dim.select("tier").distinct().orderBy("tier")


def evaluate(checks: DataFrame) -> list[str]:
    """Run the checks; raise on halting ones that failed, return the warnings.

    What comes to the driver is one row per check.
    """
    try:
        rows = checks.collect()
    except Exception as error:
        raise CheckBroken(f"checks could not be evaluated: {error}") from error
    if any(r.violations is None or r.passed is None for r in rows):
        raise CheckBroken("a check came back without a result")

    def text(r):
        what = f"{r.check} on {r.table}.{r.column}: {r.violations} violation(s)"
        return f"{what} ({r.detail})" if r.detail else what

    failed = [text(r) for r in rows if not r.passed and r.severity == HALT]
    if failed:
        raise CheckFailed("; ".join(failed))
    return [text(r) for r in rows if not r.passed]
