"""Versioned dimensions, staging views and facts."""

from datetime import date, datetime

import pytest

from sojourn.operators import scd2
from sojourn.plans import dims, facts

D = [datetime(2024, m, 1) for m in range(1, 7)]


def sheet(spark, *rows):
    return spark.createDataFrame(list(rows), "mentor_id string, tier string, hourly_rate int")


def step(before, source, when, **kw):
    return scd2.apply(before, source, "mentor_id", ["tier"], when, **kw)


def history(df):
    return sorted(
        (r.mentor_id, r.tier, r.hourly_rate, r.dbt_valid_from, r.dbt_valid_to)
        for r in df.collect()
    )


def test_history_over_several_batches(spark):
    one = step(None, sheet(spark, ("A", "Gold", 1), ("B", "Silver", 2)), D[0])
    assert history(one) == [("A", "Gold", 1, D[0], None), ("B", "Silver", 2, D[0], None)]
    # B changes tier, A only its rate, C is new.
    two = step(one, sheet(spark, ("A", "Gold", 9), ("B", "Gold", 2), ("C", "Bronze", 3)), D[1])
    assert history(two) == [
        ("A", "Gold", 1, D[0], None),
        ("B", "Gold", 2, D[1], None),
        ("B", "Silver", 2, D[0], D[1]),
        ("C", "Bronze", 3, D[1], None),
    ]
    # A leaves; the rest stays.
    three = step(two, sheet(spark, ("B", "Gold", 2), ("C", "Bronze", 3)), D[2])
    assert [r for r in history(three) if r[0] == "A"] == [("A", "Gold", 1, D[0], D[2])]
    # A replay writes nothing new.
    again = step(three, sheet(spark, ("B", "Gold", 2), ("C", "Bronze", 3)), D[3])
    assert history(again) == history(three)
    # A returns and opens another version.
    back = step(again, sheet(spark, ("A", "Gold", 4), ("B", "Gold", 2), ("C", "Bronze", 3)), D[4])
    assert [r[2:] for r in history(back) if r[0] == "A"] == [(1, D[0], D[2]), (4, D[4], None)]
    assert len({r.dbt_scd_id for r in back.collect()}) == 5


def test_missing_keys_may_stay_open(spark):
    one = step(None, sheet(spark, ("A", "Gold", 1)), D[0])
    two = step(one, sheet(spark, ("B", "Gold", 1)), D[1], close_missing=False)
    assert history(two) == [("A", "Gold", 1, D[0], None), ("B", "Gold", 1, D[1], None)]


def test_null_tier_counts_as_a_value(spark):
    one = step(None, sheet(spark, ("A", None, 1)), D[0])
    assert len(history(step(one, sheet(spark, ("A", None, 1)), D[1]))) == 1
    assert len(step(one, sheet(spark, ("A", "Gold", 1)), D[1]).collect()) == 2


def test_dim_mentors_and_current(spark):
    one = step(None, sheet(spark, ("A", "Gold", 1), ("B", "Gold", 1)), D[0])
    two = step(one, sheet(spark, ("A", "Silver", 1)), D[1])
    dim = dims.mentors(two)
    assert dim.columns == ["mentor_hk", "mentor_id", "tier", "hourly_rate", "valid_from",
                           "valid_to", "inserted_at"]
    assert [(r.mentor_id, r.tier, r.valid_from) for r in dims.current(dim).collect()] == [
        ("A", "Silver", date(2024, 2, 1))]


def test_dim_mentors_keeps_one_row_per_day_and_tier(spark):
    rows = [("A", "Gold", 1, "x", D[0].replace(hour=h), D[0].replace(hour=h), None)
            for h in (1, 5)]
    snap = spark.createDataFrame(
        rows, "mentor_id string, tier string, hourly_rate int, dbt_scd_id string, dbt_updated_at"
        " timestamp_ntz, dbt_valid_from timestamp_ntz, dbt_valid_to timestamp_ntz")
    assert [r.inserted_at.hour for r in dims.mentors(snap).collect()] == [5]


def test_earliest_signup_wins_and_nulls_come_last(spark):
    raw = spark.createDataFrame(
        [(1, 5, None, "a"), (1, 6, datetime(2024, 2, 1), "b"), (1, 7, datetime(2024, 1, 1), "c")],
        "user_id bigint, company_id bigint, signup_date timestamp_ntz, status string")
    row = dims.users(dims.stg_users(raw), D[0]).first()
    assert (row.company_id, row.valid_from, row.valid_to) == (7, date(2024, 1, 1), None)
    import hashlib
    assert row.user_hk == hashlib.sha256(b"1|7|2024-01-01").hexdigest()


def test_session_facts(spark):
    pairs = spark.createDataFrame(
        [("a", 1, "M", datetime(2024, 1, 1, 10, 0, 59), datetime(2024, 1, 1, 10, 1, 1)),
         ("b", 1, "M", datetime(2024, 1, 1, 23, 45), None), ("c", 1, None, D[0], None)],
        "session_start_event_id string, user_id bigint, mentor_id string,"
        " started_at timestamp_ntz, ended_at timestamp_ntz")
    rows = {r.session_id: r for r in facts.sessions(pairs, 45, D[0]).collect()}
    assert (rows["a"].duration_minutes, rows["a"].is_duration_estimated) == (1, False)
    assert (rows["b"].duration_minutes, rows["b"].is_duration_estimated) == (45, True)
    assert rows["b"].ended_at == datetime(2024, 1, 2, 0, 30)
    assert rows["b"].session_date == date(2024, 1, 1)
    assert rows["c"].session_hk is None


@pytest.mark.parametrize(
    "kind,attended,status",
    [("booking_confirmed", True, "confirmed_attended"), ("booking_confirmed", False, "no_show"),
     ("booking_cancelled", False, "cancelled"), (None, False, "pending")],
)
def test_booking_status(spark, kind, attended, status):
    pairs = spark.createDataFrame(
        [("a", 1, "M", D[0], None, kind, None, attended, kind is None)],
        "booking_request_event_id string, user_id bigint, mentor_id string, requested_at"
        " timestamp_ntz, outcome_at timestamp_ntz, outcome_type string, first_session_at"
        " timestamp_ntz, had_session_started boolean, is_orphan_request boolean")
    assert facts.bookings(pairs, D[0]).first().outcome_status == status
