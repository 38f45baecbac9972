"""Pairing against brute force, with ties, missing keys and times, and hot timelines."""

import random
import re
from datetime import datetime, timedelta

import pytest

from sojourn.operators.lanes import SkewPolicy, hot_timelines
from sojourn.operators.pairing import bookings, sessions
from sojourn.params import EVENT_TYPES

SCHEMA = "event_id string, user_id bigint, mentor_id string, timestamp timestamp_ntz, event_type string"
T0 = datetime(2024, 1, 1)


def at(minutes):
    return T0 + timedelta(minutes=minutes)


def brute_sessions(events):
    out = []
    for e in events:
        if e[4] != "session_started":
            continue
        inside = interval(events, e)
        ends = [x[3] for x in inside if x[4] == "session_ended"]
        out.append((e[0], e[1], key(e), e[3], min(ends, default=None)))
    return out


def brute_bookings(events):
    out = []
    for e in events:
        if e[4] != "booking_requested":
            continue
        inside = interval(events, e)
        outcomes = [x for x in inside if x[4] in ("booking_confirmed", "booking_cancelled")]
        when = min((x[3] for x in outcomes), default=None)
        kind = min((x[4] for x in outcomes), default=None)
        first = None
        if kind == "booking_confirmed":
            starts = [x[3] for x in inside if x[4] == "session_started" and x[3] > when]
            first = min(starts, default=None)
        out.append((e[0], e[1], key(e), e[3], when, kind, first, first is not None, kind is None))
    return out


def key(e):
    return None if e[2] is None else e[2].strip(" ")


def interval(events, anchor):
    """Events strictly between an anchor and the next anchor of its timeline."""
    if None in (anchor[1], anchor[2], anchor[3]):
        return []
    same = [
        e for e in events
        if e[1] == anchor[1] and key(e) == key(anchor) and e[3] is not None
    ]
    later = [
        e[3] for e in same
        if e[4] == anchor[4] and (e[3], e[0]) > (anchor[3], anchor[0])
    ]
    end = min(later, default=None)
    return [e for e in same if e[3] > anchor[3] and (end is None or e[3] < end)]


def mixed_log(seed, timelines=150):
    rng = random.Random(seed)
    rows = []
    kinds = [*EVENT_TYPES, "page_view"]

    def add(user, mentor, when, kind=None):
        rows.append((f"e{len(rows):06d}", user, mentor, when, kind or rng.choice(kinds)))

    for i in range(timelines):
        user = None if i % 20 == 0 else i
        mentor = None if i % 21 == 0 else rng.choice(["m", " m", "m "]) + "x"
        for _ in range(rng.randint(1, 14)):
            add(user, mentor, None if rng.random() < 0.05 else at(rng.randint(0, 12)))
    # One timeline holds about half of all rows, and one of its instants a fifth of those.
    for _ in range(len(rows)):
        add(7777, "hot", at(500) if rng.random() < 0.2 else at(rng.randint(0, 1500)))
    rng.shuffle(rows)
    return rows


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    rows = mixed_log(seed)
    log = spark.createDataFrame(rows, SCHEMA)
    assert result(sessions(log)) == sorted(brute_sessions(rows), key=repr)
    assert result(bookings(log)) == sorted(brute_bookings(rows), key=repr)


@pytest.mark.parametrize(
    "seed,policy",
    [
        (3, SkewPolicy(50)),
        (4, SkewPolicy(7, "10 minutes")),
        (5, SkewPolicy(20, "7 days")),
    ],
)
def test_hot_timelines_give_the_same(spark, seed, policy):
    rows = mixed_log(seed)
    log = spark.createDataFrame(rows, SCHEMA).repartition(7).cache()
    hot = hot_timelines(log, policy)
    layout = [r for r in hot.collect() if r.user_id == 7777][0]
    assert sum(map(len, layout.chunks)) >= 8, "the hot timeline is cut into slices"
    assert max(layout.salts) > 1, "the crowded instant is salted"
    assert result(sessions(log, hot)) == sorted(brute_sessions(rows), key=repr)
    assert result(bookings(log, hot)) == sorted(brute_bookings(rows), key=repr)
    log.unpersist()


def test_no_hot_timeline(spark):
    log = spark.createDataFrame(mixed_log(6), SCHEMA)
    assert hot_timelines(log) is None
    assert hot_timelines(log.limit(0)) is None


@pytest.mark.parametrize("times", [1, 8])
def test_lanes_stay_as_small_when_the_log_grows(spark, times):
    """The largest lane is bounded by the target alone, and lanes are not cut for nothing."""
    from pyspark.sql import functions as F

    from sojourn.operators import pairing

    rows = [r for r in mixed_log(8) if r[3] is not None]
    rows = [(f"{k}{r[0]}", *r[1:3], r[3] + timedelta(days=k), r[4]) for k in range(times) for r in rows]
    log, target = spark.createDataFrame(rows, SCHEMA), 60
    spread, _, usable = pairing._timeline(log, list(EVENT_TYPES), hot_timelines(log, SkewPolicy(target)))
    lanes = spread.filter(usable).groupBy("user_id", "mentor_id", "lane").count()
    sizes = [r["count"] for r in lanes.filter(F.col("user_id") == 7777).collect()]
    assert max(sizes) <= 2 * target
    assert len(sizes) <= 3 * sum(sizes) / target + 1


def test_instants_of_a_hot_timeline_are_counted_in_many_tasks(spark):
    """Where Spark finds the hot pairs too many to broadcast by itself, rows still go by instant."""
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        hot = hot_timelines(spark.createDataFrame(mixed_log(8), SCHEMA), SkewPolicy(60))
        plan = hot._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(threshold, before)
    assert re.search(r"hashpartitioning\(user_id#\w+, mentor_id#\w+, at#\w+, ", plan)


def one_timeline(spark, *steps):
    rows = [(f"e{i}", 1, "M1", at(m), kind) for i, (m, kind) in enumerate(steps)]
    return spark.createDataFrame(rows, SCHEMA)


REQ, CONF, CANC, START, END = EVENT_TYPES


@pytest.mark.parametrize(
    "steps,expected",
    [
        ([(0, REQ), (1, CONF), (2, START)], [("booking_confirmed", at(1), at(2))]),
        ([(0, REQ), (1, CONF)], [("booking_confirmed", at(1), None)]),
        ([(0, REQ), (1, CANC)], [("booking_cancelled", at(1), None)]),
        ([(0, REQ), (1, CONF), (2, CANC)], [("booking_cancelled", at(1), None)]),
        ([(0, REQ)], [(None, None, None)]),
        ([(0, REQ), (1, REQ), (2, CONF)],
         [(None, None, None), ("booking_confirmed", at(2), None)]),
        ([(0, REQ), (1, START), (2, CONF)], [("booking_confirmed", at(2), None)]),
        ([(0, REQ), (1, CONF), (2, REQ), (3, START)],
         [("booking_confirmed", at(1), None), (None, None, None)]),
        ([(0, REQ), (0, CONF)], [(None, None, None)]),
    ],
)
def test_booking_cases(spark, steps, expected):
    rows = bookings(one_timeline(spark, *steps)).orderBy("requested_at").collect()
    assert [(r.outcome_type, r.outcome_at, r.first_session_at) for r in rows] == expected


@pytest.mark.parametrize(
    "steps,expected",
    [
        ([(0, START), (30, END)], [at(30)]),
        ([(0, START)], [None]),
        ([(0, START), (60, START), (90, END)], [None, at(90)]),
    ],
)
def test_session_cases(spark, steps, expected):
    rows = sessions(one_timeline(spark, *steps)).orderBy("started_at").collect()
    assert [r.ended_at for r in rows] == expected


def test_one_shuffle(spark):
    """The plan moves every event once, and sorts it once."""
    log = spark.createDataFrame(mixed_log(9), SCHEMA)
    for pairs in (sessions(log), bookings(log)):
        plan = pairs._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1
        assert plan.count("Sort [") == 1
