"""Source files to reports, in one go and in steps."""

from datetime import datetime

import pytest

from fixtures import MENTORS, events, write_all, write_csv, write_json
from sojourn.params import Params
from sojourn.plans import analysis, jobs, quality
from sojourn.sources import runlog
from sojourn.sources.tables import Warehouse

AT = datetime(2025, 8, 1)
GOLD_SILVER = Params(group_b=("Silver",))


def make(spark, name, folder):
    return Warehouse(spark, name, str(folder / "warehouse"))


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("full")
    wh = make(spark, "full_run", folder)
    log = str(folder / "log")
    out = jobs.run(wh, Params(), write_all(folder), log_path=log, as_of=AT)
    return wh, out, log


def rates(wh, params):
    rows = jobs.analyse(wh, params)["rebooking"].collect()
    return {r.mentor_tier: (r.total_users, r.users_rebooked, r.rebooking_rate_pct) for r in rows}


def test_full_run(built):
    wh, out, _ = built
    assert (out["new_users"], out["new_events"], out["dq_passed"]) == (9, 28, True)
    counts = {r.table: r.rows for r in out["row_counts"].collect()}
    assert counts == {"dim_users": 9, "dim_mentors": 4, "fct_sessions": 15, "fct_bookings": 0}
    assert wh.read("fct_sessions").filter("is_duration_estimated").count() == 2
    assert len(out["warnings"]) == 2 and all("directional" in w for w in out["warnings"])
    assert out["reliability"].count() == 0
    intent = {r.tier_group: tuple(r[1:3]) for r in out["intent"].collect()}
    assert intent == {"Gold": (3, 0), "Silver/Bronze": (6, 0)}


def test_rates_for_any_groups_and_windows(built):
    wh = built[0]
    assert rates(wh, GOLD_SILVER) == {"Gold": (3, 1, 33.3), "Silver": (4, 2, 50.0)}
    assert rates(wh, Params()) == {"Gold": (3, 1, 33.3), "Silver/Bronze": (6, 2, 33.3)}
    assert rates(wh, Params(window_days=None)) == {
        "Gold": (3, 2, 66.7), "Silver/Bronze": (6, 3, 50.0)}


def test_second_run_adds_nothing(built, tmp_path):
    wh, _, log = built
    out = jobs.run(wh, Params(), write_all(tmp_path), log_path=log, as_of=AT)
    assert (out["new_users"], out["new_events"]) == (0, 0)
    assert jobs.events_to_pair(wh)[1] is not None, "no bookings, and still built"
    assert {r.table: r.rows for r in out["row_counts"].collect()} == {
        "dim_users": 9, "dim_mentors": 4, "fct_sessions": 15, "fct_bookings": 0}


def test_analysis_only(built):
    out = jobs.run(built[0], GOLD_SILVER, mode="analysis-only")
    assert out["dq_passed"] and out["rebooking"].count() == 2


def test_command_line(built, spark, tmp_path, capsys):
    from sojourn.__main__ import main

    settings = tmp_path / "settings.yaml"
    settings.write_text("rebooking: {tiers_group_b: [Silver], window_days: null}")
    main(["--mode", "analysis-only", "--database", "full_run", "--settings", str(settings)])
    shown = capsys.readouterr().out
    assert "|Gold       |3          |2             |66.7" in shown
    assert "warning: Silver: directional only" in shown
    with pytest.raises(SystemExit):
        main(["--mode", "full"])


def test_run_log(built, spark):
    _, _, log = built
    rows = runlog.history(runlog.read(spark, log)).collect()
    assert rows[-1].run_id == 1 and rows[-1].status == "success"
    assert (rows[-1].group_a, rows[-1].group_b, rows[-1].window_days) == (
        "Gold", "Silver/Bronze", 30)
    assert (rows[-1].new_users, rows[-1].dq_passed, rows[-1].warnings) == (9, True, 2)
    assert len({r.run_id for r in rows}) == len(rows)


def test_failed_run_is_recorded(spark, tmp_path):
    log = str(tmp_path / "log")
    src = write_all(tmp_path) | {"events": str(tmp_path / "none.json")}
    with pytest.raises(ValueError, match="not found"):
        jobs.run(make(spark, "failing", tmp_path), Params(), src, log_path=log)
    row = runlog.read(spark, log).filter("status = 'failed'").first()
    assert "not found" in row.error_message and row.new_users_ingested == 9
    assert runlog.history(runlog.read(spark, log)).first().status == "failed"
    assert runlog.next_run_id(spark, log) == 2
    assert runlog.next_run_id(spark, str(tmp_path / "nolog")) == 1


def test_history_pages(spark, tmp_path):
    log = str(tmp_path / "log")
    for i in range(1, 4):
        runlog.append(spark, log, runlog.started(i, Params(window_days=None), datetime(2025, 1, i)))
    page = lambda p: [r.run_id for r in runlog.history(
        runlog.read(spark, log), page=p, page_size=2).collect()]
    assert (page(0), page(1)) == ([3, 2], [1])


def test_bad_calls(spark, tmp_path):
    wh = make(spark, "bad_calls", tmp_path)
    with pytest.raises(ValueError, match="mode"):
        jobs.run(wh, mode="nothing")
    with pytest.raises(ValueError, match="exclusive"):
        jobs.run(wh, Params(group_b=("Gold",)))


def booking_log():
    def e(i, user, minute, kind, mentor="K7"):
        return {"event_id": f"x{i}", "user_id": user, "mentor_id": mentor, "event_type": kind,
                "timestamp": f"2025-01-01T10:{minute:02d}:00Z"}

    return [
        e(1, 1, 0, "session_started"), e(2, 1, 20, "booking_requested"),
        e(3, 2, 0, "session_started"), e(4, 2, 10, "session_ended"),
        e(5, 2, 20, "booking_requested"), e(6, 2, 21, "booking_confirmed"),
        e(7, 2, 40, "session_started"),
    ], [e(8, 1, 30, "session_ended"), e(9, 1, 31, "booking_cancelled"),
        e(10, 1, 50, "session_started"), e(11, 3, 5, "booking_requested", "K8")]


def test_late_events_change_no_stored_row(spark, tmp_path):
    wh = make(spark, "late", tmp_path)
    early, late = booking_log()
    src = write_all(tmp_path, early)
    jobs.run(wh, Params(), src, "ingest-only")
    jobs.transform(wh, Params(), AT)

    def stored(table, key, *cols):
        return {r[0]: tuple(r[1:]) for r in wh.read(table).select(key, *cols).collect()}

    sessions = stored("fct_sessions", "session_id", "duration_minutes", "is_duration_estimated")
    assert sessions == {"x1": (30, True), "x3": (10, False), "x7": (30, True)}
    bookings = stored("fct_bookings", "booking_id", "outcome_status")
    assert bookings == {"x2": ("pending",), "x5": ("confirmed_attended",)}

    jobs.ingest_events(wh, write_json(tmp_path / "late.json", early + late))
    jobs.transform(wh, Params(), AT)
    assert stored("fct_sessions", "session_id", "duration_minutes", "is_duration_estimated") == {
        **sessions, "x10": (30, True)}
    assert stored("fct_bookings", "booking_id", "outcome_status") == {
        **bookings, "x11": ("pending",)}

    # A transform that is run again, even with other settings, changes no stored row.
    jobs.transform(wh, Params(default_minutes=5), datetime(2026, 1, 1))
    assert wh.read("fct_sessions").filter("is_duration_estimated AND duration_minutes <> 30"
                                          ).count() == 0
    assert {r.inserted_at for r in wh.read("fct_bookings").collect()} == {AT}
    assert wh.read("fct_sessions").count() == 4 and wh.read("fct_bookings").count() == 3

    # Only timelines with news are paired again.
    more = [{"event_id": "z", "user_id": 3, "mentor_id": "K8", "event_type": "session_started",
             "timestamp": "2025-01-02T10:00:00Z"}]
    jobs.ingest_events(wh, write_json(tmp_path / "more.json", more))
    jobs.transform(wh, Params(), AT)
    jobs.transform(wh, Params(), AT)
    assert {r.user_id for r in wh.latest("touched_events").collect()} == {3}
    assert wh.read("fct_sessions").count() == 5


def test_checks_on_pairs_need_no_pairing(spark):
    log = spark.createDataFrame([], "event_id string, user_id bigint, mentor_id string,"
                                " timestamp timestamp_ntz, event_type string")
    from sojourn.operators import pairing

    for name, pairs in (("stg_session_pairs", pairing.sessions(log)),
                        ("stg_booking_pairs", pairing.bookings(log))):
        plan = quality.declared({name: pairs})._jdf.queryExecution().optimizedPlan().toString()
        assert "Window" not in plan


def test_tier_change_moves_users(spark, tmp_path):
    wh = make(spark, "tiers", tmp_path)
    src = write_all(tmp_path)
    jobs.run(wh, GOLD_SILVER, src, as_of=AT)
    write_csv(tmp_path / "mentors.csv", ["mentor_id", "tier", "hourly_rate"],
              [("K7", "Silver", 1), *MENTORS[1:]])
    out = jobs.run(wh, GOLD_SILVER, src, as_of=datetime(2025, 7, 1))
    assert wh.latest("dim_mentors").count() == 5
    assert [r.mentor_tier for r in out["rebooking"].collect()] == ["Silver"]
    history = analysis.rebooking(wh.read("fct_sessions"), wh.latest("dim_mentors"),
                                 ["Silver"], ["Bronze"]).collect()
    assert {r.mentor_tier: r.total_users for r in history} == {"Silver": 7, "Bronze": 2}


def test_unknown_type_fails_the_gate(spark, tmp_path):
    wh = make(spark, "gate", tmp_path)
    log = events() + [{"event_id": "u", "user_id": 101, "mentor_id": "K7",
                       "timestamp": "2025-01-01T00:00:00Z", "event_type": "ping"}]
    with pytest.raises(quality.CheckFailed, match="accepted_values on raw_events.event_type"):
        jobs.run(wh, Params(), write_all(tmp_path, log))
    assert wh.read("raw_events").count() == 29


def test_unknown_tier_names_the_known_ones(built):
    with pytest.raises(quality.CheckFailed, match="Diamond.*available tiers.*Bronze"):
        jobs.validate(built[0], Params(group_a=("Diamond",)))


def test_failed_checks_leave_dimensions_and_facts_alone(spark, tmp_path):
    """A repeated key in new rows: nothing of them is published, and what was there stays."""
    wh = make(spark, "audit", tmp_path)
    jobs.run(wh, Params(), write_all(tmp_path), as_of=AT)
    tables = ("snap_mentors", "dim_users", "dim_mentors", "fct_sessions", "fct_bookings")
    before = {t: (wh.batches(t), wh.read(t).count()) for t in tables}
    twice = [{"event_id": f"twice{i}", "user_id": 101, "mentor_id": "K7",
              "timestamp": "2025-03-01T00:00:00Z", "event_type": "session_started"} for i in range(2)]
    write_csv(tmp_path / "mentors.csv", ["mentor_id", "tier", "hourly_rate"],
              [("K7", "Silver", 1), *MENTORS[1:]])
    (tmp_path / "new").mkdir()
    src = write_all(tmp_path / "new", events() + twice)
    with pytest.raises(quality.CheckFailed, match="unique on fct_sessions.session_hk"):
        jobs.run(wh, Params(), src | {"mentors": str(tmp_path / "mentors.csv")}, as_of=AT)
    assert {t: (wh.batches(t), wh.read(t).count()) for t in tables} == before
