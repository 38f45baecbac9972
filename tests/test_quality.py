from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from sojourn.params import Params
from sojourn.plans import quality

T = datetime(2024, 1, 1)


@pytest.fixture
def clean(spark):
    """Three good sessions, four bookings without an orphan, and two mentors."""
    sessions = spark.createDataFrame(
        [(f"h{i}", f"S{i}", 1, "M01", T, T, 30, False, date(2024, 1, 1), T) for i in range(1, 4)],
        "session_hk string, session_id string, user_id bigint, mentor_id string, started_at"
        " timestamp_ntz, ended_at timestamp_ntz, duration_minutes int, is_duration_estimated"
        " boolean, session_date date, inserted_at timestamp_ntz")
    bookings = spark.createDataFrame(
        [(f"b{i}", f"B{i}", 1, "M02", T, T, None, "cancelled", False, T) for i in range(4)],
        "booking_hk string, booking_id string, user_id bigint, mentor_id string, requested_at"
        " timestamp_ntz, outcome_at timestamp_ntz, first_session_at timestamp_ntz,"
        " outcome_status string, is_orphan_request boolean, inserted_at timestamp_ntz")
    mentors = spark.createDataFrame(
        [("m1", "M01", "Gold", 9, date(2024, 1, 1), None, T),
         ("m2", "M02", "Silver", 9, date(2024, 1, 1), None, T)],
        "mentor_hk string, mentor_id string, tier string, hourly_rate int, valid_from date,"
        " valid_to date, inserted_at timestamp_ntz")
    users = spark.createDataFrame(
        [("u1", 1, 5, date(2024, 1, 1), "active", date(2024, 1, 1), None, T)],
        "user_hk string, user_id bigint, company_id bigint, signup_date date, status string,"
        " valid_from date, valid_to date, inserted_at timestamp_ntz")
    return {"fct_sessions": sessions, "fct_bookings": bookings, "dim_mentors": mentors,
            "dim_users": users}


GS = Params(group_a=("Gold",), group_b=("Silver",))


def business(f, params=GS, **other):
    f = {**f, **other}
    return quality.business(f["fct_sessions"], f["fct_bookings"], f["dim_mentors"], params)


def test_clean_data_passes(clean):
    assert quality.evaluate(business(clean)) == []
    assert quality.evaluate(quality.declared(clean)) == []


def minutes(clean, n):
    m = F.when(F.col("session_id") == "S1", n).otherwise(F.col("duration_minutes"))
    return clean["fct_sessions"].withColumn("duration_minutes", m)


def test_negative_duration_halts(clean):
    with pytest.raises(quality.CheckFailed, match="negative_duration.* 1 violation"):
        quality.evaluate(business(clean, fct_sessions=minutes(clean, -10)))


def test_long_duration_warns(clean):
    out = quality.evaluate(business(clean, fct_sessions=minutes(clean, 300)))
    assert len(out) == 1 and "long_duration" in out[0]
    assert quality.evaluate(business(clean, Params(group_b=("Silver",), max_minutes=300),
                                     fct_sessions=minutes(clean, 300))) == []


@pytest.mark.parametrize("orphans,limit,warned", [(0, 0.05, 0), (1, 0.25, 0), (1, 0.2, 1)])
def test_orphan_rate_warns(clean, orphans, limit, warned):
    b = clean["fct_bookings"].withColumn(
        "is_orphan_request", F.col("booking_id") < F.lit(f"B{orphans}"))
    p = Params(group_b=("Silver",), max_orphan_rate=limit)
    assert len(quality.evaluate(business(clean, p, fct_bookings=b))) == warned


def test_orphan_rate_without_bookings(clean):
    assert quality.evaluate(business(clean, fct_bookings=clean["fct_bookings"].limit(0))) == []
    assert quality.business(clean["fct_sessions"]).count() == 2


def test_unknown_configured_tier_halts(clean):
    p = Params(group_a=("Diamond",), group_b=("Silver",))
    with pytest.raises(quality.CheckFailed, match="Diamond"):
        quality.evaluate(business(clean, p))
    assert quality.business(clean["fct_sessions"], None, clean["dim_mentors"]).count() == 2


def test_declared_rules(clean):
    bad = clean["fct_bookings"].withColumns({
        "booking_hk": F.lit("same"), "mentor_id": F.lit("M99"), "user_id": F.lit(99),
        "outcome_status": F.when(F.col("booking_id") == "B0", "lost"), "inserted_at": F.lit(None)})
    rows = {
        (r["check"], r["column"]): (r.violations, r.severity, r.passed)
        for r in quality.declared({**clean, "fct_bookings": bad}).collect()
        if r.table == "fct_bookings"
    }
    assert rows["unique", "booking_hk"] == (1, "halt", False)
    assert rows["not_null", "inserted_at"] == (4, "halt", False)
    assert rows["not_null", "outcome_status"] == (3, "halt", False)
    assert rows["accepted_values", "outcome_status"] == (1, "halt", False)
    assert rows["relationships", "mentor_id"] == (4, "halt", False)
    assert rows["relationships", "user_id"] == (4, "warn", False)


def test_number_of_declared_rules():
    rules = quality.RULES.values()
    assert sum(len(nulls) for nulls, *_ in rules) == 52
    assert sum(key is not None for _, key, *_ in rules) == 9
    assert sum(len(values) for *_, values, _ in rules) == 5
    assert sum(len(refs) for *_, refs in rules) == 4


def test_broken_checks_are_told_apart(spark, clean):
    broken = clean["fct_sessions"].withColumn(
        "duration_minutes", F.raise_error(F.lit("no disk")).cast("int"))
    with pytest.raises(quality.CheckBroken, match="could not be evaluated"):
        quality.evaluate(quality.business(broken))
    empty = quality.business(clean["fct_sessions"]).withColumn(
        "passed", F.lit(None).cast("boolean"))
    with pytest.raises(quality.CheckBroken, match="without a result"):
        quality.evaluate(empty)


def test_available_tiers(clean):
    assert [r.tier for r in quality.available_tiers(clean["dim_mentors"]).collect()] == [
        "Gold", "Silver"]
