"""Readers, pre-flight checks, normalisation and loading."""

import json
from datetime import datetime

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from fixtures import MENTORS, events, write_all, write_csv, write_json
from sojourn.functions.columns import minutes_between, strip, title_case, whole_number
from sojourn.operators.append import unseen
from sojourn.plans import jobs
from sojourn.sources import files, normalize, preflight
from sojourn.sources.tables import Warehouse, row_counts


@pytest.fixture
def wh(spark, request, tmp_path_factory):
    name = f"db_{abs(hash(request.node.nodeid)) % 10**9}"
    yield Warehouse(spark, name, str(tmp_path_factory.mktemp("warehouse")))
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x string")


def apply(spark, fn, values):
    return [r[0] for r in texts(spark, values).select(fn(F.col("x"))).collect()]


def test_columns(spark):
    assert apply(spark, strip, ["\t a b \n", " x ", None]) == ["a b", "x", None]
    assert apply(spark, title_case, ["gold", "GOLD-plus 2nd", "", None]) == [
        "Gold", "Gold-Plus 2nd", "", None]
    assert apply(spark, whole_number, ["12", "+5", "-7", "12.5", " 12 ", "12\n", "x", "", None,
                                       "99999999999999999999"]) == [
        12, 5, -7, None, None, None, None, None, None, None]


def test_minutes_between_counts_boundaries(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 10:00:59' a, TIMESTAMP_NTZ '2024-01-01 "
                   "10:01:01' b, TIMESTAMP_NTZ '1969-12-31 23:59:59' c")
    row = df.select(minutes_between(F.col("a"), F.col("b")),
                    minutes_between(F.col("b"), F.col("a")),
                    minutes_between(F.col("a"), F.col("a")),
                    minutes_between(F.col("c"), F.col("c") + F.expr("INTERVAL 2 SECOND"))).first()
    assert tuple(row) == (1, -1, 0, 1)


# --- pre-flight --------------------------------------------------------------------------


def test_csv_issues(spark, tmp_path):
    good = write_csv(tmp_path / "a.csv", ["user_id", "x"], [(1, 2)])
    assert preflight.csv_issues(spark, good, {"user_id"}) == []
    assert "missing columns ['tier']" in preflight.csv_issues(spark, good, {"tier", "x"})[0]
    empty = write_csv(tmp_path / "b.csv", ["user_id"], [])
    assert "no data rows" in preflight.csv_issues(spark, empty, {"user_id"})[0]
    assert "not found" in preflight.csv_issues(spark, str(tmp_path / "c.csv"), set())[0]
    bad = tmp_path / "d.csv"
    bad.write_bytes(b"user_id\n\xff\xfe\n")
    assert "not UTF-8" in preflight.csv_issues(spark, str(bad), {"user_id"})[0]


@pytest.mark.parametrize(
    "text,issue,layout",
    [
        ('[{"event_id": "a"}, {"event_id": "b"}]', None, "records"),
        ('[\n{"event_id": "a"}\n]\n', None, "records"),
        ('{"event_id": "a"}\n{"event_id": "b"}\n', None, "records"),
        ('[{"event_id": "a}b"}, {"event_id": "c"}]', None, "array"),
        ('[{"event_id": "a", "more": {"x": 1}}]', None, "array"),
        ("[]", "empty JSON array", "records"),
        ('[{"event_id": "a"},]', "not valid JSON", "array"),
        ('[{"event_id": "a"} {"event_id": "b"}]', "not valid JSON", "array"),
        ('[{"event_id": "a"}', "not valid JSON", "array"),
        ('{"event_id": {"x": 1}}', None, "lines"),
        ('{"event_id": "a"}\n[1]', "must be a JSON array", "array"),
        ("not json", "not valid JSON", "array"),
    ],
)
def test_json_report(spark, tmp_path, text, issue, layout):
    f = tmp_path / "e.json"
    f.write_text(text)
    issues, found = preflight.json_report(spark, str(f))
    assert found == layout
    assert (issue in issues[0]) if issue else issues == []


def test_json_report_names_missing_and_badly_encoded_files(spark, tmp_path):
    assert "not found" in preflight.json_report(spark, str(tmp_path / "x.json"))[0][0]
    f = tmp_path / "y.json"
    f.write_bytes(b'[{"event_id": "\xff"}]')
    assert "not UTF-8" in preflight.json_report(spark, str(f))[0][0]


def test_duplicate_keys(spark, tmp_path):
    f = write_csv(tmp_path / "a.csv", ["user_id", "x"], [(1, 1), (1, 2), (None, 3), (None, 4)])
    row = preflight.duplicate_keys(files.read_users(spark, f), "user_id").first()
    assert tuple(row) == (4, 2)


# --- readers and normalisation -----------------------------------------------------------


@pytest.mark.parametrize("layout", ["records", "array"])
def test_read_events_keeps_mixed_user_ids(spark, tmp_path, layout):
    records = events() + [
        {"event_id": "f", "user_id": 1.0, "mentor_id": "M1", "timestamp": "x", "event_type": "y"},
        {"event_id": "n", "user_id": None, "mentor_id": "M1", "timestamp": "x", "event_type": "y"},
    ]
    raw = files.read_events(spark, write_json(tmp_path / "e.json", records), layout)
    ids = {r.event_id: r.user_id for r in raw.collect()}
    assert len(ids) == 30
    assert (ids["e01"], ids["e05"], ids["n"]) == ("101", "102", None)
    assert normalize.events(raw).count() == 28


def test_position_survives_small_blocks(spark, tmp_path):
    """The first delivery of an event wins, however the file is cut for reading."""
    records = [
        {"event_id": f"k{i % 40}", "user_id": i, "mentor_id": " M ", "timestamp":
         "2025-01-01T00:00:00Z", "event_type": "Session_Started "} for i in range(400)
    ]
    path = write_json(tmp_path / "e.json", records)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        raw = files.read_events(spark, path)
        assert raw.select(F.spark_partition_id()).distinct().count() > 4
        kept = normalize.events(raw).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r.event_id, r.user_id) for r in kept) == sorted(
        (f"k{i}", i) for i in range(40))
    assert {(r.mentor_id, r.event_type) for r in kept} == {("M", "session_started")}


def test_normalise_users(spark, tmp_path):
    rows = [("1", 7, "2024-01-01", " Active"), ("x", 8, "2024-01-01", "a"),
            ("1", 9, "2024-01-02", "b"), ("2", None, "never", None)]
    raw = files.read_users(spark, write_csv(
        tmp_path / "u.csv", ["user_id", "company_id", "signup_date", "status"], rows))
    seen = Observation()
    out = sorted(tuple(r) for r in normalize.users(raw, seen).collect())
    assert out == [(1, 7, datetime(2024, 1, 1), "active"), (2, None, None, None)]
    assert seen.get == {"rows": 4, "dropped": 1}


def test_bad_company_id_fails(spark, tmp_path):
    raw = files.read_users(spark, write_csv(
        tmp_path / "u.csv", ["user_id", "company_id", "signup_date", "status"],
        [("1", "seven", "2024-01-01", "a")]))
    with pytest.raises(Exception, match="company_id is not a whole number"):
        normalize.users(raw).collect()


def test_normalise_mentors(spark, tmp_path):
    raw = files.read_mentors(spark, write_csv(
        tmp_path / "m.csv", ["tier", "mentor_id", "hourly_rate"],
        [(" gOLD", " M1", "200"), ("silver", "M2", "abc"), ("bronze ", "M3", None)]))
    assert [tuple(r) for r in normalize.mentors(raw).orderBy("mentor_id").collect()] == [
        ("M1", "Gold", 200), ("M2", "Silver", 0), ("M3", "Bronze", 0)]


def test_timestamps_are_utc(spark):
    raw = spark.createDataFrame(
        [("a", "1", "M", "2025-01-01T10:00:00Z", "x", 1), ("b", "1", "M",
         "2025-01-01T10:00:00+02:00", "x", 2), ("c", "1", "M", "soon", "x", 3)],
        "event_id string, user_id string, mentor_id string, timestamp string,"
        " event_type string, pos int")
    rows = {r.event_id: r.timestamp for r in normalize.events(raw).collect()}
    assert rows == {"a": datetime(2025, 1, 1, 10), "b": datetime(2025, 1, 1, 8), "c": None}


# --- loading -----------------------------------------------------------------------------


def test_unseen_null_keys(spark):
    staged = spark.createDataFrame([(1, "a"), (None, "b"), (None, "c"), (3, "d")], "k int, v string")
    held = spark.createDataFrame([(1,), (None,)], "k int")
    vs = lambda df: sorted(r.v for r in df.collect())
    assert vs(unseen(staged, held, "k")) == ["b", "c", "d"]
    assert vs(unseen(staged, held, "k", null_keys=False)) == ["d"]


def test_ingest_is_idempotent(wh, tmp_path):
    src = write_all(tmp_path)
    assert jobs.ingest_users(wh, src["users"]) == 9
    assert jobs.ingest_users(wh, src["users"]) == 0
    assert jobs.ingest_events(wh, src["events"]) == 28
    assert jobs.ingest_events(wh, src["events"]) == 0
    assert wh.read("raw_users").count() == 9
    assert wh.read("raw_events").filter("user_id IS NULL").count() == 0
    assert wh.read("raw_events").columns == [
        "event_id", "user_id", "mentor_id", "timestamp", "event_type"]


def test_a_batch_can_be_repeated(wh, tmp_path):
    src = write_all(tmp_path)
    assert jobs.ingest_events(wh, src["events"], batch=1) == 28
    assert jobs.ingest_events(wh, src["events"], batch=1) == 0
    more = write_json(tmp_path / "more.json", events() + [
        {"event_id": "new", "user_id": 1, "mentor_id": "M1",
         "timestamp": "2025-05-01T00:00:00Z", "event_type": "session_started"}])
    assert jobs.ingest_events(wh, more, batch=2) == 1
    assert jobs.ingest_events(wh, more, batch=2) == 0
    assert wh.read("raw_events").count() == 29
    assert wh.batches("raw_events") == [1, 2]


def test_leftovers_of_a_lost_job_are_overwritten(spark, wh, tmp_path):
    src = write_all(tmp_path)
    jobs.ingest_events(wh, src["events"], batch=1)
    # A job that died before its partition was registered leaves files behind.
    where = spark.sql(f"DESCRIBE FORMATTED {wh.name('raw_events')}").filter(
        "col_name = 'Location'").first().data_type
    wh.read("raw_events").write.parquet(f"{where}/batch=2")
    assert wh.batches("raw_events") == [1]
    more = write_json(tmp_path / "more.json", [
        {"event_id": "new", "user_id": 1, "mentor_id": "M1",
         "timestamp": "2025-05-01T00:00:00Z", "event_type": "session_started"}])
    assert jobs.ingest_events(wh, more, batch=2) == 1
    assert wh.read("raw_events").count() == 29


def test_mentors_are_replaced(wh, tmp_path):
    path = write_all(tmp_path)["mentors"]
    assert jobs.ingest_mentors(wh, path) == 4
    write_csv(tmp_path / "mentors.csv", ["mentor_id", "tier", "hourly_rate"], MENTORS[:2])
    for _ in range(3):
        assert jobs.ingest_mentors(wh, path) == 2
    assert wh.latest("raw_mentors").count() == 2
    assert len(wh.batches("raw_mentors")) == 2


def test_replacing_with_nothing_leaves_nothing(spark, wh):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    assert wh.replace(df, "t", batch=1) == 1
    assert wh.replace(df.limit(0), "t", batch=2) == 0
    assert wh.latest("t").count() == 0
    assert wh.replace(wh.latest("t").union(df), "t", batch=3) == 1
    assert wh.batches("t") == [2, 3] and wh.latest("t").first().v == 1


def test_first_rows_after_an_empty_load(spark, wh):
    df = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    assert wh.append_new(df.limit(0), "t", "k", null_keys=False, batch=1) == 0
    assert wh.append_new(df, "t", "k", null_keys=False, batch=2) == 2
    assert wh.append_new(df, "t", "k", null_keys=False, batch=3) == 0


def test_mentors_without_tier_change_nothing(wh, tmp_path):
    path = write_all(tmp_path)["mentors"]
    jobs.ingest_mentors(wh, path)
    write_csv(tmp_path / "mentors.csv", ["mentor_id", "hourly_rate"], [("M1", 1)])
    with pytest.raises(ValueError, match="tier"):
        jobs.ingest_mentors(wh, path)
    write_csv(tmp_path / "mentors.csv", ["mentor_id", "tier", "hourly_rate"], [("M1", None, 1)])
    with pytest.raises(ValueError, match="null tier"):
        jobs.ingest_mentors(wh, path)
    assert wh.latest("raw_mentors").count() == 4


def test_missing_sources_are_rejected(wh, tmp_path):
    for job in (jobs.ingest_users, jobs.ingest_mentors, jobs.ingest_events):
        with pytest.raises(ValueError, match="not found"):
            job(wh, str(tmp_path / "none"))
    assert not any(wh.exists(t) for t in jobs.TABLES)


def test_unknown_types_are_stored_and_reported(wh, tmp_path, caplog):
    log = events() + [{"event_id": "u", "user_id": 1, "mentor_id": "M1",
                       "timestamp": "2025-01-01T00:00:00Z", "event_type": "Ping"},
                      {"event_id": "v", "user_id": "?", "mentor_id": "M1",
                       "timestamp": "2025-01-01T00:00:00Z", "event_type": "booking_requested"}]
    with caplog.at_level("WARNING"):
        assert jobs.ingest_events(wh, write_json(tmp_path / "e.json", log)) == 29
        assert jobs.ingest_events(wh, str(tmp_path / "e.json")) == 0
    assert caplog.text.count("'ping': 1") == 2, "on a replay too"
    assert "event_id" not in caplog.text and "1 of the dropped events are bookings" in caplog.text


def test_reports_are_whole(wh, tmp_path, caplog):
    kind = lambda i: {"event_id": f"k{i}", "user_id": 101, "mentor_id": "K7",
                      "timestamp": "2025-01-01T00:00:00Z", "event_type": f"odd{i % 130}"}
    with caplog.at_level("WARNING"):
        jobs.ingest_events(wh, write_json(tmp_path / "e.json", [kind(i) for i in range(135)] + [kind(0)]))
    assert caplog.text.count("unknown event_type") == 130
    assert "1 of 136 rows repeat an event_id" in caplog.text


def test_mentors_named_twice_change_nothing(wh, tmp_path):
    path = write_all(tmp_path)["mentors"]
    jobs.ingest_mentors(wh, path)
    write_csv(tmp_path / "mentors.csv", ["mentor_id", "tier", "hourly_rate"], [*MENTORS, ("K7 ", "Silver", 1)])
    with pytest.raises(ValueError, match="1 of 5 rows repeat a mentor_id"):
        jobs.ingest_mentors(wh, path)
    assert wh.latest("raw_mentors").count() == 4


def test_quotes_and_headers(spark, tmp_path):
    f = tmp_path / "q.csv"
    f.write_text('user_id,company_id,status\n1,2,"on ""hold"", late"\n')
    assert files.read_users(spark, str(f)).first().status == 'on "hold", late'
    assert preflight.csv_issues(spark, str(f), {"user_id"}) == []
    f.write_text('user_id,company_id,status\n1,2,"on\nhold"\n')
    assert "unbalanced quote" in preflight.csv_issues(spark, str(f), {"user_id"})[0]
    folder = tmp_path / "two"
    folder.mkdir()
    (folder / "a.csv").write_text("user_id,company_id\n1,2\n")
    (folder / "b.csv").write_text("company_id,user_id\n1,2\n")
    assert "different headers" in preflight.csv_issues(spark, str(folder), {"user_id"})[0]


def test_lines_with_braces_in_texts(spark, tmp_path):
    f = tmp_path / "e.json"
    rows = [{"event_id": "a}1", "user_id": 1, "mentor_id": "M}", "timestamp": "t", "event_type": "x", "more": {"y": {}}},
            {"event_id": "b", "user_id": "2", "mentor_id": None, "timestamp": "t", "event_type": "x"}]
    f.write_text("\n".join(json.dumps(r) for r in rows) + "\n")
    assert preflight.json_report(spark, str(f)) == ([], "lines")
    got = files.read_events(spark, str(f), "lines").orderBy("pos").collect()
    assert [(r.event_id, r.user_id, r.mentor_id) for r in got] == [("a}1", "1", "M}"), ("b", "2", None)]


def test_tables_live_in_the_shared_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("sojourn.sources.tables.shared_dir", lambda _: str(tmp_path))
    wh = Warehouse(spark, "shared_db")
    jobs.ingest_mentors(wh, write_all(tmp_path)["mentors"], batch=1)
    assert (tmp_path / "shared_db" / "raw_mentors" / "batch=1").is_dir()
    spark.sql("DROP DATABASE shared_db CASCADE")


def test_reset_and_counts(wh, tmp_path):
    src = write_all(tmp_path)
    jobs.ingest_users(wh, src["users"])
    jobs.ingest_mentors(wh, src["mentors"])
    frames = {t: wh.read(t) for t in ("raw_users", "raw_mentors")}
    assert {r.table: r.rows for r in row_counts(frames).collect()} == {
        "raw_users": 9, "raw_mentors": 4}
    assert wh.warn_if_exists("raw_users") and not wh.warn_if_exists("fct_sessions")
    assert wh.reset(jobs.TABLES, "empty") == ["raw_users", "raw_mentors"]
    assert wh.exists("raw_users") and wh.read("raw_users").count() == 0
    assert jobs.ingest_users(wh, src["users"]) == 9
    assert wh.reset(jobs.TABLES) == ["raw_users", "raw_mentors"]
    assert not wh.exists("raw_users")
