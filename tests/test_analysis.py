"""Analyses against brute force, and their plans."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sojourn.functions.columns import wilson
from sojourn.plans import analysis

T0 = datetime(2024, 1, 1)
TIER = {"G": "Gold", "S": "Silver", "B": "Bronze", "X": "Iron"}


@pytest.fixture(scope="module")
def world(spark):
    rng = random.Random(5)
    when = lambda: T0 + timedelta(minutes=rng.randint(0, 40) * 720)
    # User 0 holds a third of all rows, user None is unknown.
    user = lambda: rng.choice([0] * 15 + list(range(1, 30)) + [None])
    mentor = lambda: rng.choice("GSBXQ")
    sessions = [(f"s{i:04d}", user(), mentor(), when()) for i in range(250)]
    status = ["confirmed_attended", "no_show", "cancelled", "pending"]
    bookings = [
        (f"b{i:04d}", user(), mentor(), None if i % 50 == 0 else when(), rng.choice(status))
        for i in range(120)
    ]
    dim = [(m, t, date(2024, 1, 1), None) for m, t in TIER.items()]
    # An older version, a closed one, and a second open one: only the latest open row counts.
    dim += [("G", "Bronze", date(2023, 1, 1), None), ("S", "Gold", date(2024, 2, 1), date(2024, 3, 1)),
            ("Q", "Gold", date(2023, 1, 1), date(2024, 1, 1))]
    return {
        "sessions": sessions, "bookings": bookings,
        "s": spark.createDataFrame(
            sessions, "session_id string, user_id bigint, mentor_id string, started_at timestamp_ntz"),
        "b": spark.createDataFrame(
            bookings, "booking_id string, user_id bigint, mentor_id string, requested_at"
            " timestamp_ntz, outcome_status string"),
        "dim": spark.createDataFrame(
            dim, "mentor_id string, tier string, valid_from date, valid_to date"),
    }


def ratio(a, b):
    return round(100 * a / b, 1) if b else None


@pytest.mark.parametrize("a,b,days", [
    (["Gold"], ["Silver", "Bronze"], 3), (["Gold"], ["Silver", "Bronze"], None),
    (["Iron"], ["Gold"], 1), (["Silver", "Iron"], ["Bronze"], 30)])
def test_rebooking(world, a, b, days):
    ranked = {}
    for sid, user, mentor, at in sorted(world["sessions"], key=lambda r: (r[3], r[0])):
        if TIER.get(mentor) in a + b:
            ranked.setdefault(user, []).append((at, TIER[mentor]))
    groups = {}
    for user, visits in ranked.items():
        first, tier = visits[0]
        again = user is not None and any(
            days is None or at <= first + timedelta(days=days) for at, _ in visits[1:])
        label = "/".join(a if tier in a else b)
        groups.setdefault(label, []).append(again)
    want = {g: (len(v), sum(v), ratio(sum(v), len(v))) for g, v in groups.items()}
    got = analysis.rebooking(world["s"], world["dim"], a, b, days).collect()
    assert {r[0]: tuple(r[1:]) for r in got} == want
    rates = [r.rebooking_rate_pct for r in got]
    assert rates == sorted(rates, reverse=True)


def test_reliability(world):
    per = {}
    for _, _, mentor, _, status in world["bookings"]:
        if mentor in TIER:
            per.setdefault(TIER[mentor], []).append(status)
    want = {}
    for tier, st in per.items():
        n, c, x, gone = len(st), sum(s in ("confirmed_attended", "no_show") for s in st), \
            st.count("cancelled"), st.count("no_show")
        want[tier] = (n, c, x, gone, st.count("pending"), ratio(c, n), ratio(gone, c), ratio(x, n))
    report = analysis.reliability(world["b"], world["dim"])
    assert {r[0]: tuple(r[1:]) for r in report.collect()} == want
    total = analysis.reliability_total(report).first()
    assert total.total_bookings == sum(v[0] for v in want.values())
    assert total.no_show_pct == ratio(total.no_show_count, total.confirmed_count)
    pivot = {r.metric: r for r in analysis.reliability_pivot(report).collect()}
    assert pivot["no_show_rate_pct"].Gold == want["Gold"][6]
    assert pivot["total_bookings"].Bronze == want["Bronze"][0]


@pytest.mark.parametrize("days", [1, 3, 30])
def test_intent(world, days):
    firsts = {}
    for sid, user, mentor, at in sorted(world["sessions"], key=lambda r: (r[3], r[0])):
        if user is not None and mentor in TIER:
            firsts.setdefault(user, (at, TIER[mentor]))
    want = {}
    for user, (first, tier) in firsts.items():
        reached = {st for _, u, _, at, st in world["bookings"]
                   if u == user and at and first < at <= first + timedelta(days=days)}
        row = want.setdefault("Gold" if tier == "Gold" else "Silver/Bronze", [0] * 5)
        hits = [True, bool(reached), "confirmed_attended" in reached, "no_show" in reached,
                "cancelled" in reached]
        for i, hit in enumerate(hits):
            row[i] += hit
    got = analysis.intent(world["s"], world["b"], world["dim"], window_days=days).collect()
    assert {r[0]: list(r[1:6]) for r in got} == want
    for r in got:
        assert r.commitment_rate_pct == ratio(r.users_intent_attended, r.users_with_intent)


def test_no_bookings(world):
    assert analysis.reliability(world["b"].limit(0), world["dim"]).count() == 0
    total = analysis.reliability_total(analysis.reliability(world["b"].limit(0), world["dim"]))
    assert tuple(total.first()) == (0, 0, 0, 0, 0, None, None, 0.0, None)
    row = analysis.intent(world["s"], world["b"].limit(0), world["dim"]).first()
    assert (row.users_with_intent, row.intent_rate_pct, row.commitment_rate_pct) == (0, 0.0, None)


def test_wilson_and_sanity(spark):
    rows = [("a", 42, 26, 61.9), ("b", 0, 0, None), ("c", 40, 40, 100.0), ("d", 29, 0, 0.0),
            ("e", 30, 0, 0.0)]
    df = spark.createDataFrame(
        rows, "mentor_tier string, total_users bigint, users_rebooked bigint,"
        " rebooking_rate_pct double")
    out = {r.mentor_tier: r for r in analysis.with_sanity(analysis.with_wilson(df)).collect()}
    assert (out["a"].ci_lower_pct, out["a"].ci_upper_pct) == (46.8, 75.0)
    assert (out["b"].ci_lower_pct, out["b"].ci_upper_pct) == (0.0, 0.0)
    assert (out["c"].ci_lower_pct, out["c"].ci_upper_pct) == (91.2, 100.0)
    assert out["d"].ci_lower_pct == 0.0
    assert [out[k].warning for k in "abcde"] == [
        None, "directional only", "rate is 100%", "directional only", "rate is 0%"]
    low, _ = wilson(F.lit(5), F.lit(10), 2.58)
    assert spark.range(1).select(low).first()[0] < 23.7


def test_rank_is_limited_before_the_shuffle(world):
    """Each map task passes on two rows per user, however many the user has."""
    plan = analysis.rebooking(world["s"], world["dim"])._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 2, Partial" in plan


def test_all_windows_at_once_equal_single_ones(spark):
    """Repeated tiers, users without id or time, ties: as one question for each window and grouping."""
    rng = random.Random(4)
    rows = [
        (rng.choice([None, *range(25)]), f"m{rng.randint(1, 4)}",
         None if rng.random() < 0.05 else datetime(2025, 1, 1) + timedelta(hours=12 * rng.randint(0, 80)),
         rng.choice([None, "a", "b", f"s{i}"]))
        for i in range(160)
    ]
    facts = spark.createDataFrame(rows, "user_id bigint, mentor_id string, started_at timestamp_ntz, session_id string")
    dim = spark.createDataFrame(
        [("m1", "Gold", None), ("m2", "Silver", None), ("m3", "Bronze", None), ("m4", "Gold", None)],
        "mentor_id string, tier string, valid_to timestamp",
    ).withColumn("valid_from", F.lit("2020-01-01").cast("timestamp"))
    groupings = [(["Gold"], ["Silver", "Bronze"]), (["Bronze", "Gold"], ["Silver"]), (["Silver"], ["Gold", "Silver"])]
    columns = ["mentor_tier", "total_users", "users_rebooked", "rebooking_rate_pct"]
    table = analysis.what_if(facts, dim, groupings, range(1, 12)).collect()
    for i, (a, b) in enumerate(groupings):
        for days in (1, 2, 5, 11):
            want = analysis.rebooking(facts, dim, a, b, days).select(columns).collect()
            got = [tuple(r[c] for c in columns) for r in table if (r.grouping, r.window_days) == (i, days)]
            assert sorted(got) == sorted(map(tuple, want))
