"""The jobs a scheduler calls: ingest, transform, validate, analyse, or all of them."""

from __future__ import annotations

import logging
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..operators import pairing, scd2
from ..operators.lanes import SkewPolicy
from ..params import EVENT_TYPES, Params
from ..sources import files, normalize, preflight, runlog
from ..sources.tables import Warehouse, row_counts
from . import analysis, dims, facts, quality

log = logging.getLogger(__name__)

TABLES = ["raw_users", "raw_mentors", "raw_events", "snap_mentors", "dim_users",
          "dim_mentors", "fct_sessions", "fct_bookings", "touched_events", "paired_batches",
          "new_dim_users", "new_snap_mentors", "new_fct_sessions", "new_fct_bookings"]
MODES = ("full", "ingest-only", "transform-only", "analysis-only")


def _dropped(seen: Observation, what: str) -> None:
    counts = seen.get
    if counts["dropped"]:
        log.warning("dropped %s of %s %s without a parseable user_id",
                    counts["dropped"], counts["rows"], what)


def ingest_users(wh: Warehouse, path: str, batch: int | None = None) -> int:
    """Add users not seen before; return their number."""
    preflight.gate(path, preflight.csv_issues(wh.spark, path, {"user_id"}))
    raw = files.read_users(wh.spark, path)
    dup = preflight.duplicate_keys(raw, "user_id").first()
    if dup.duplicate_rows:
        log.warning("%s: %s of %s rows repeat a user_id", path, dup.duplicate_rows,
                    dup.total_rows)
    seen = Observation()
    new = wh.append_new(normalize.users(raw, seen), "raw_users", "user_id", batch=batch)
    _dropped(seen, "users")
    return new


def ingest_mentors(wh: Warehouse, path: str, batch: int | None = None) -> int:
    """Replace the mentor sheet, unless a tier is missing or a mentor is named twice."""
    required = {"mentor_id", "tier", "hourly_rate"}
    preflight.gate(path, preflight.csv_issues(wh.spark, path, required))
    sheet = normalize.mentors(files.read_mentors(wh.spark, path))
    dup = preflight.duplicate_keys(sheet, "mentor_id").first()
    if dup.duplicate_rows:
        raise preflight.SourceRejected(
            f"{path}: {dup.duplicate_rows} of {dup.total_rows} rows repeat a mentor_id")
    without = sheet.filter(F.col("tier").isNull()).count()
    if without:
        raise preflight.SourceRejected(f"{path}: {without} rows with null tier")
    for message in wh.warn_if_exists("raw_mentors"):
        log.info(message)
    return wh.replace(sheet, "raw_mentors", batch=batch)


def ingest_events(wh: Warehouse, path: str, batch: int | None = None) -> int:
    """Add events not seen before; unknown types are stored, reported here and fail validation."""
    issues, layout = preflight.json_report(wh.spark, path)
    preflight.gate(path, issues)
    raw = files.read_events(wh.spark, path, layout)
    dup = preflight.duplicate_keys(raw.filter("event_id IS NOT NULL"), "event_id").first()
    if dup.duplicate_rows:
        log.warning("%s: %s of %s rows repeat an event_id", path, dup.duplicate_rows, dup.total_rows)
    seen = Observation()
    new = store_events(wh, normalize.events(raw, seen), batch)
    _dropped(seen, "events")
    if seen.get["booking_dropped"]:
        log.warning("%s of the dropped events are bookings", seen.get["booking_dropped"])
    # About the whole file, so a replay says the same; streamed to the log, however many there are.
    for row in normalize.unknown_types(normalize.events(raw)).toLocalIterator():
        log.warning("unknown event_type %r: %s events", row.event_type, row.n)
    return new


def store_events(wh: Warehouse, typed: DataFrame, batch: int | None = None) -> int:
    """Add events not seen before. A batch that is added to later counts as not paired again."""
    if batch is not None and wh.batches("paired_batches"):
        paired = [r.event_batch for r in wh.latest("paired_batches").collect()]
        if batch in paired:
            mark_paired(wh, [b for b in paired if b != batch])
    return wh.append_new(typed, "raw_events", "event_id", batch=batch)


def events_to_pair(wh: Warehouse) -> tuple[DataFrame, list[int] | None]:
    """Events of every timeline that got events since the facts were last built.

    The other timelines have all their rows in the facts already, and stored rows never
    change. Which event batches the facts were built from is kept in ``paired_batches``, so
    batches may be numbered in any order; the last one paired counts as new once more, in case
    it was added to. The second value lists the batches that count as new, or is None if all
    events are to be paired.
    """
    events = wh.read("raw_events", with_batch=True)
    if not all(wh.batches(t) for t in ("fct_sessions", "fct_bookings", "paired_batches")):
        return events.drop("batch"), None
    done = wh.latest("paired_batches").collect()
    old = {r.event_batch for r in done if not r.last}
    since = [b for b in wh.batches("raw_events") if b not in old]
    pair = [F.col("user_id").cast("bigint"), F.trim("mentor_id")]
    fresh = (
        events.filter(F.col("batch").isin(since) & F.col("event_type").isin(list(EVENT_TYPES)))
        .select(pair[0].alias("u"), pair[1].alias("m"))
        .distinct()
    )
    touched = events.join(fresh, (pair[0] == F.col("u")) & (pair[1] == F.col("m")), "left_semi")
    # Read several times below, so the join is paid for once.
    wh.replace(touched.drop("batch"), "touched_events")
    return wh.latest("touched_events"), since


def mark_paired(wh: Warehouse, batches: list[int]) -> None:
    """Record that the facts hold what these event batches give."""
    last = max(batches, default=None)
    rows = [(b, b == last) for b in batches]
    frame = wh.spark.createDataFrame(rows, "event_batch bigint, last boolean")
    wh.replace(frame, "paired_batches")


def new_between(wh: Warehouse, since: list[int] | None, kind: str, column: str,
                most: int = 32) -> Column | None:
    """Ranges of ``column`` that new facts of ``kind`` lie in; None for no limit.

    The days with new events, joined over their smallest gaps to ``most`` ranges: one very old
    event adds its own day, not all that lies between.
    """
    if since is None:
        return None
    days = [
        r.day for r in wh.read("raw_events", with_batch=True)
        .filter(F.col("batch").isin(since) & (F.col("event_type") == kind))
        .select(F.to_date("timestamp").alias("day")).distinct()
        .filter("day IS NOT NULL").orderBy("day").collect()
    ]
    gaps = sorted(range(1, len(days)), key=lambda i: days[i - 1] - days[i])[: most - 1]
    cuts = [0, *sorted(gaps), len(days)]
    ranges = [(days[a], days[b - 1] + timedelta(days=1)) for a, b in zip(cuts, cuts[1:]) if a < b]
    within = F.lit(False)
    for low, high in ranges:
        at = [F.lit(str(d)).cast("timestamp_ntz") for d in (low, high)]
        within = within | ((F.col(column) >= at[0]) & (F.col(column) < at[1]))
    return within


def transform(wh: Warehouse, params: Params, as_of: datetime | None = None,
              policy: SkewPolicy = SkewPolicy(), audited: bool = False) -> DataFrame:
    """Build dimensions and facts from the raw tables; return the row counts.

    New rows are written aside first. With ``audited`` they are checked there, and a failed check
    leaves snapshot, dimensions and facts as they were: stored facts never change, so a bad row
    would stay for good.
    """
    as_of = as_of or dims.now()
    known = wh.batches("raw_events")
    since = build(wh, params, as_of, policy)
    if audited:
        audit(wh, params)
    publish(wh, known, since)
    return row_counts(marts(wh))


def build(wh: Warehouse, params: Params, as_of: datetime, policy: SkewPolicy) -> list[int] | None:
    """Write what would be added to ``new_...`` tables; return the event batches it is about."""
    wh.replace(dims.users(dims.stg_users(wh.read("raw_users")), as_of), "new_dim_users")
    sheet = dims.stg_mentors(wh.latest("raw_mentors"))
    before = wh.latest("snap_mentors") if wh.exists("snap_mentors") else None
    wh.replace(scd2.apply(before, sheet, "mentor_id", ["tier"], as_of), "new_snap_mentors")
    events, since = events_to_pair(wh)
    hot = pairing.hot_timelines(events, policy)
    sessions = facts.sessions(pairing.sessions(events, hot), params.default_minutes, as_of)
    wh.replace(sessions, "new_fct_sessions")
    wh.replace(facts.bookings(pairing.bookings(events, hot), as_of), "new_fct_bookings")
    return since


def audit(wh: Warehouse, params: Params) -> None:
    """Raise if what :func:`build` wrote, or the raw tables it came from, breaks a halting check."""
    new = {t: wh.latest(f"new_{t}") for t in ("dim_users", "fct_sessions", "fct_bookings")}
    new["dim_mentors"] = dims.mentors(wh.latest("new_snap_mentors"))
    _evaluate(checks(wh, params, new), new["dim_mentors"])


def publish(wh: Warehouse, known: list[int], since: list[int] | None) -> None:
    """Add what :func:`build` wrote to snapshot, dimensions and facts."""
    newest = max(known, default=None)
    wh.append_new(wh.latest("new_dim_users"), "dim_users", "user_hk", null_keys=False)
    wh.replace(wh.latest("new_snap_mentors"), "snap_mentors")
    wh.replace(dims.mentors(wh.latest("snap_mentors")), "dim_mentors")
    wh.append_new(wh.latest("new_fct_sessions"), "fct_sessions", "session_hk", null_keys=False, batch=newest,
                  within=new_between(wh, since, "session_started", "started_at"))
    wh.append_new(wh.latest("new_fct_bookings"), "fct_bookings", "booking_hk", null_keys=False, batch=newest,
                  within=new_between(wh, since, "booking_requested", "requested_at"))
    mark_paired(wh, known)


def marts(wh: Warehouse) -> dict[str, DataFrame]:
    return {
        "dim_users": wh.read("dim_users"),
        "dim_mentors": wh.latest("dim_mentors"),
        "fct_sessions": wh.read("fct_sessions"),
        "fct_bookings": wh.read("fct_bookings"),
    }


def checks(wh: Warehouse, params: Params, m: dict[str, DataFrame] | None = None) -> DataFrame:
    """All declared and business checks over the warehouse, or over dimensions and facts ``m`` in it.

    The checks on pairs are about the anchors alone; Spark drops the pairing from their plan.
    """
    events = wh.read("raw_events")
    m = m or marts(wh)
    frames = {
        "raw_users": wh.read("raw_users"),
        "raw_mentors": wh.latest("raw_mentors"),
        "raw_events": events,
        "stg_users": dims.stg_users(wh.read("raw_users")),
        "stg_mentors": dims.stg_mentors(wh.latest("raw_mentors")),
        "stg_session_pairs": pairing.sessions(events),
        "stg_booking_pairs": pairing.bookings(events),
        **m,
    }
    rules = quality.business(m["fct_sessions"], m["fct_bookings"], m["dim_mentors"], params)
    return quality.declared(frames).unionByName(rules)


def validate(wh: Warehouse, params: Params) -> list[str]:
    """Raise on failed checks, with the tiers at hand if it is about tiers; return warnings."""
    return _evaluate(checks(wh, params), wh.latest("dim_mentors"))


def _evaluate(found: DataFrame, mentors: DataFrame) -> list[str]:
    try:
        return quality.evaluate(found)
    except quality.CheckFailed as failure:
        if "configured_tiers" in str(failure):
            names = [r.tier for r in quality.available_tiers(mentors).toLocalIterator()]
            raise quality.CheckFailed(f"{failure}; available tiers: {names}") from failure
        raise


def analyse(wh: Warehouse, params: Params) -> dict[str, DataFrame]:
    """The reports, unevaluated."""
    m = marts(wh)
    rate = analysis.rebooking(m["fct_sessions"], m["dim_mentors"], params.group_a,
                              params.group_b, params.window_days)
    report = analysis.reliability(m["fct_bookings"], m["dim_mentors"])
    return {
        "rebooking": analysis.with_sanity(analysis.with_wilson(rate)),
        "reliability": report,
        "reliability_total": analysis.reliability_total(report),
        "reliability_pivot": analysis.reliability_pivot(report, params.known_tiers),
        "intent": analysis.intent(m["fct_sessions"], m["fct_bookings"], m["dim_mentors"]),
    }


def run(wh: Warehouse, params: Params | None = None, sources: dict[str, str] | None = None,
        mode: str = "full", log_path: str | None = None, as_of: datetime | None = None) -> dict:
    """Run the steps of ``mode`` and record the run.

    ``sources`` names the ``users``, ``mentors`` and ``events`` files. The result holds
    counts, warnings and the reports as DataFrames.
    """
    params = (params or Params()).check()
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")
    spark = wh.spark
    entry = None
    if log_path:
        entry = runlog.started(runlog.next_run_id(spark, log_path), params)
        runlog.append(spark, log_path, entry)
    out = {"mode": mode, "params": params, "new_users": 0, "new_events": 0,
           "dq_passed": False, "warnings": []}

    def close(status, error=None):
        if entry:
            runlog.append(spark, log_path, runlog.finished(
                entry, status, new_users_ingested=out["new_users"],
                new_events_ingested=out["new_events"], dq_checks_passed=out["dq_passed"],
                warnings=out["warnings"], error_message=error))

    try:
        if mode in ("full", "ingest-only"):
            out["new_users"] = ingest_users(wh, sources["users"])
            ingest_mentors(wh, sources["mentors"])
            out["new_events"] = ingest_events(wh, sources["events"])
        if mode in ("full", "transform-only"):
            out["row_counts"] = transform(wh, params, as_of, audited=True)
            # What was added has passed; rules that only warn are about all that is stored.
            m = marts(wh)
            rules = quality.business(m["fct_sessions"], m["fct_bookings"], m["dim_mentors"], params)
            out["warnings"] += _evaluate(rules, m["dim_mentors"])
        # Reports over tables that are already built trust the checks of that build.
        out["dq_passed"] = mode != "ingest-only"
        if mode in ("full", "analysis-only"):
            out.update(analyse(wh, params))
            # At most one row per configured group.
            for row in out["rebooking"].filter("warning IS NOT NULL").collect():
                out["warnings"].append(f"{row.mentor_tier}: {row.warning}")
    except Exception as error:
        close("failed", str(error))
        raise
    close("success")
    return out
