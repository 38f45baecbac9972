"""State and timers: sessions, repeats and windows of a stream, against a batch and across restarts."""

import random
from datetime import datetime, timedelta

import pytest

from sojourn.operators import pairing
from sojourn.streaming import sessions as streamed

SCHEMA = "event_id string, user_id bigint, mentor_id string, timestamp timestamp_ntz, event_type string"
T0 = datetime(2024, 1, 1)
MINUTE = 60_000_000


def at(minutes):
    return T0 + timedelta(minutes=minutes)


def test_advance_reads_only_what_is_final():
    start, end = streamed._START, streamed._END
    waiting = [(30, start, "b"), (10, start, "a"), (20, end, "x"), (40, end, "y"), (90, end, "z")]
    out, rest = streamed.advance(waiting, 30, None)
    assert out == [("a", 10, 20)]
    assert sorted(rest) == [(30, streamed._OPEN, "b"), (40, end, "y"), (90, end, "z")]
    out, rest = streamed.advance(rest, 50, None)
    assert out == [("b", 30, 40)] and rest == [(90, end, "z")]


@pytest.mark.parametrize("seed", range(20))
def test_advance_in_steps_gives_what_one_step_gives(seed):
    rng = random.Random(seed)
    rows = [(rng.randint(0, 40), rng.choice([streamed._START, streamed._END]), f"e{i}") for i in range(30)]
    for patience in (None, 0, 3, 100):
        whole, _ = streamed.advance(rows, 10_000, patience)
        found, held, before = [], [], -1
        for until in sorted(rng.sample(range(200), 12)) + [10_000]:
            # Everything up to ``until`` has come, and some of what lies later.
            ahead = until + rng.randint(0, 5)
            held += [r for r in rows if before < r[0] <= ahead]
            before = max(before, ahead)
            out, held = streamed.advance(held, until, patience)
            found += out
        key = lambda r: (r[1], r[0])
        assert sorted(found, key=key) == sorted(whole, key=key)


def log(rng, n):
    kinds = ["session_started", "session_ended", "booking_requested"]
    rows = [
        (f"e{i:04d}", rng.choice([1, 2, 3, None]), rng.choice([" m", "m", "k", None]),
         None if rng.random() < 0.03 else at(rng.randint(0, 600)), rng.choice(kinds))
        for i in range(n)
    ]
    return rows


def deliver(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/inbox")


def run(spark, folder, step):
    stream = spark.readStream.schema(SCHEMA).parquet(f"{folder}/inbox")
    return streamed.drained(step(stream), f"{folder}/out", f"{folder}/checkpoint")


@pytest.fixture
def stateful(spark):
    before = {k: spark.conf.get(k, None) for k in (*streamed.STATE_STORE, "spark.sql.shuffle.partitions")}
    streamed.with_state_store(spark).conf.set("spark.sql.shuffle.partitions", "2")
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_sessions_equal_the_batch_over_restarts(stateful, tmp_path):
    spark, folder, rng = stateful, f"file://{tmp_path}", random.Random(3)
    rows = log(rng, 120)
    order = sorted(rows, key=lambda r: (r[3] or T0) + timedelta(minutes=rng.randint(-20, 20)))
    beat = ("beat", None, None, at(60 * 24 * 900), streamed.HEARTBEAT)
    step = lambda s: streamed.sessions(s, "45 minutes", 60 * 24 * 400)
    for part in (order[:50], order[50:90], [*order[90:], beat]):
        deliver(spark, folder, part)
        late = streamed.late_rows(run(spark, folder, step))
        assert late == 0
    run(spark, folder, step)  # nothing new: no row twice
    got = spark.read.parquet(f"{folder}/out").collect()
    want = pairing.sessions(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, want))


@pytest.mark.parametrize("shards", [1, 7])
def test_timelines_share_shards_of_state(stateful, tmp_path, shards):
    """Keys of state do not grow with the timelines, and a shard may hold several blocks."""
    spark, folder, rng = stateful, f"file://{tmp_path}", random.Random(5)
    rows = [
        (None if i % 50 == 0 else f"e{i:05d}", rng.randint(1, 1000), rng.choice("kmn"), at(rng.randint(0, 6000)),
         rng.choice(["session_started", "session_started", "session_ended"]))
        for i in range(12_000)
    ]
    rows += [(f"n{i}", *rng.choice([(None, "m"), (i, None)]), at(i), "session_started") for i in range(50)]
    beat = ("beat", None, None, at(60 * 24 * 900), streamed.HEARTBEAT)
    step = lambda s: streamed.sessions(s, "1 day", None, shards)
    # Without an end of waiting, every timeline's last session stays in state.
    closing = [(f"z{u}{m}", u, m, at(60 * 24 * 950), "session_started") for u in range(1, 1001) for m in "kmn"]
    deliver(spark, folder, [*rows, beat])
    query = run(spark, folder, step)
    state = query.recentProgress[-1]["stateOperators"][0]
    assert state["numRowsTotal"] <= 8 * shards
    deliver(spark, folder, [*closing, (*beat[:3], at(60 * 24 * 1900), beat[4])])
    run(spark, folder, step)
    got = spark.read.parquet(f"{folder}/out").collect()
    log = spark.createDataFrame(rows + closing, SCHEMA)
    want = [r for r in pairing.sessions(log).collect() if r.started_at < at(60 * 24 * 950)]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_open_sessions_are_given_up_and_late_rows_counted(stateful, tmp_path):
    spark, folder = stateful, f"file://{tmp_path}"
    step = lambda s: streamed.sessions(s, "10 minutes", 30)
    deliver(spark, folder, [("a", 1, "m", at(0), "session_started"), ("b", 1, "m", at(25), "session_ended"),
                            ("c", 2, "m", at(0), "session_started"), ("d", 2, "m", at(31), "session_ended"),
                            ("h", None, None, at(100), streamed.HEARTBEAT)])
    run(spark, folder, step)
    rows = {r.session_start_event_id: r.ended_at for r in spark.read.parquet(f"{folder}/out").collect()}
    assert rows == {"a": at(25), "c": None}
    deliver(spark, folder, [("late", 3, "m", at(5), "session_started"), ("e", 3, "m", at(99), "session_started")])
    assert streamed.late_rows(run(spark, folder, step)) == 1


def test_open_sessions_of_one_shard_are_given_up_in_turn(stateful, tmp_path):
    """One timer serves all timelines of a shard; an earlier event takes its place."""
    spark, folder = stateful, f"file://{tmp_path}"
    step = lambda s: streamed.sessions(s, "10 minutes", 30, 1)
    ended = lambda: {
        r.session_start_event_id: r.ended_at for r in spark.read.parquet(f"{folder}/out").collect()
    }
    deliver(spark, folder, [(f"s{u}", u, "m", at(10 * u), "session_started") for u in range(5)]
            + [("h", None, None, at(45), streamed.HEARTBEAT)])
    run(spark, folder, step)
    assert ended() == {"s0": None}
    deliver(spark, folder, [("e1", 1, "m", at(38), "session_ended"), ("e2", 2, "m", at(51), "session_ended"),
                            ("h", None, None, at(100), streamed.HEARTBEAT)])
    run(spark, folder, step)
    assert ended() == {"s0": None, "s1": at(38), "s2": None, "s3": None, "s4": None}


def test_repeats_are_left_out_across_batches(stateful, tmp_path):
    spark, folder = stateful, f"file://{tmp_path}"
    one = [(f"e{i}", 1, "m", at(i), "session_started") for i in range(10)]
    step = lambda s: streamed.deduplicated(s, "1 hour")
    deliver(spark, folder, one + one[:3])
    run(spark, folder, step)
    deliver(spark, folder, one[5:] + [("new", 1, "m", at(12), "session_started")])
    run(spark, folder, step)
    ids = [r.event_id for r in spark.read.parquet(f"{folder}/out").collect()]
    assert sorted(ids) == sorted([r[0] for r in one] + ["new"])


def test_windows_are_handed_on_once(stateful, tmp_path):
    spark, folder = stateful, f"file://{tmp_path}"
    rows = [(f"e{i}", 1, "m", at(i * 7), "session_started") for i in range(20)]
    beat = ("beat", None, None, at(100_000), streamed.HEARTBEAT)
    step = lambda s: streamed.counts(s, "1 hour", delay="30 minutes")
    for part in (rows[:9], [*rows[9:], beat]):
        deliver(spark, folder, part)
        run(spark, folder, step)
    got = {r.window_start: r.n for r in spark.read.parquet(f"{folder}/out").collect()}
    assert got == {at(0): 9, at(60): 9, at(120): 2}


def test_a_shard_is_one_row_of_state(stateful, tmp_path):
    """A shard's rows come and go in columns; large ids stay whole beside missing ones."""
    spark, folder, big = stateful, f"file://{tmp_path}", 2**53 + 1
    rows = [(f"s{i}", big + i, "m", at(i), "session_started") for i in range(40)]
    rows += [(f"e{i}", big + i, "m", at(i + 5), "session_ended") for i in range(0, 40, 2)]
    rows += [("u", None, "m", at(3), "session_started"), ("t", big, "m", None, "session_started"),
             (None, big, None, at(4), "session_started"), (None, big, "m", at(0), "session_started")]
    step = lambda s: streamed.sessions(s, "1 day", 60 * 24, 5)
    deliver(spark, folder, rows)
    query = run(spark, folder, step)
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] <= 5
    deliver(spark, folder, [("beat", None, None, at(60 * 24 * 9), streamed.HEARTBEAT)])
    query = run(spark, folder, step)
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] == 0
    got = spark.read.parquet(f"{folder}/out").collect()
    want = pairing.sessions(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, want))
