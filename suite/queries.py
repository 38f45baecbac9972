"""The registered queries: every operator over the whole of the given tables."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sojourn.operators import pairing, scd2
from sojourn.operators.append import unseen
from sojourn.params import EVENT_TYPES, Params
from sojourn.plans import analysis, dims, facts, quality
from sojourn.session import configure
from sojourn.sources import normalize, preflight, runlog
from sojourn.sources.tables import row_counts
from sojourn.streaming import sessions as streamed

from . import model as m

QUERIES = {}


def query(fn):
    @wraps(fn)
    def ready(spark, sf_dir):
        return fn(configure(spark), sf_dir)

    QUERIES[fn.__name__] = ready
    return ready


# --- pairing and facts -------------------------------------------------------------------


@query
def sessions_paired(spark, sf_dir):
    return pairing.sessions(*m.probed_log(spark, sf_dir))


@query
def bookings_paired(spark, sf_dir):
    return pairing.bookings(*m.probed_log(spark, sf_dir))


@query
def sessions_hot(spark, sf_dir):
    """Sessions where one timeline has a third of the log, cut into many slices."""
    log = m.hot_log(spark, sf_dir)
    return pairing.sessions(log, pairing.hot_timelines(log, m.SMALL_SLICES))


@query
def bookings_hot(spark, sf_dir):
    log = m.hot_log(spark, sf_dir)
    return pairing.bookings(log, pairing.hot_timelines(log, m.SMALL_SLICES))


@query
def fct_sessions(spark, sf_dir):
    return m.fct_sessions(*m.probed_log(spark, sf_dir)).drop("inserted_at")


@query
def fct_bookings(spark, sf_dir):
    return m.fct_bookings(*m.probed_log(spark, sf_dir)).drop("inserted_at")


# --- dimensions --------------------------------------------------------------------------


@query
def stg_users(spark, sf_dir):
    return dims.stg_users(m.user_export(spark, sf_dir))


@query
def dim_users(spark, sf_dir):
    return dims.users(dims.stg_users(m.user_export(spark, sf_dir)), m.AS_OF)


@query
def stg_mentors(spark, sf_dir):
    return dims.stg_mentors(m.supplier_sheet(spark, sf_dir))


@query
def dim_mentors(spark, sf_dir):
    return dims.mentors(m.supplier_snapshot(spark, sf_dir))


@query
def dim_current(spark, sf_dir):
    return dims.current(dims.mentors(m.supplier_snapshot(spark, sf_dir)))


@query
def scd2_snapshot(spark, sf_dir):
    return m.supplier_snapshot(spark, sf_dir)


@query
def scd2_replay_noop(spark, sf_dir):
    """The second sheet applied once more: nothing may change."""
    _, two = m.supplier_versions(spark, sf_dir)
    return scd2.apply(m.supplier_snapshot(spark, sf_dir), two, "mentor_id", ["tier"], m.LAST)


@query
def scd2_returned(spark, sf_dir):
    """The first sheet comes back: mentors return, joined ones leave, tiers revert."""
    one, _ = m.supplier_versions(spark, sf_dir)
    return scd2.apply(m.supplier_snapshot(spark, sf_dir), one, "mentor_id", ["tier"], m.LAST)


@query
def scd2_duplicate_keys(spark, sf_dir):
    """Sheets that name every mentor twice, the second time with a higher rate, three times in a row."""
    doubled = [
        v.unionByName(v.withColumn("hourly_rate", F.col("hourly_rate") + 1))
        for v in m.supplier_versions(spark, sf_dir)
    ]
    rows = scd2.apply(None, doubled[0], "mentor_id", ["tier"], m.AS_OF)
    for at in (m.LATER, m.LAST):
        rows = scd2.apply(rows, doubled[1], "mentor_id", ["tier"], at)
    return rows


# --- analyses ----------------------------------------------------------------------------


def _rate(spark, sf_dir, a, b, days):
    return analysis.rebooking(
        m.fct_sessions(*m.probed_log(spark, sf_dir)), m.dim_mentors(spark, sf_dir), a, b, days
    )


@query
def rebooking_rate(spark, sf_dir):
    return _rate(spark, sf_dir, ["Gold"], ["Silver", "Bronze"], 3)


@query
def rebooking_unlimited(spark, sf_dir):
    return _rate(spark, sf_dir, ["Gold"], ["Silver", "Bronze"], None)


@query
def rebooking_custom_groups(spark, sf_dir):
    return _rate(spark, sf_dir, ["Silver"], ["Gold"], 1)


def _order_visits(spark, sf_dir):
    """Orders as sessions and their priority as the tier."""
    orders = m.table(spark, sf_dir, "orders")
    visits = orders.select(
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderpriority").alias("mentor_id"),
        F.col("o_orderdate").alias("started_at"),
        F.col("o_orderkey").alias("session_id"),
    )
    desks = orders.select(F.col("o_orderpriority").alias("mentor_id")).distinct().select(
        "mentor_id",
        F.col("mentor_id").alias("tier"),
        F.lit("1990-01-01").cast("date").alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
    )
    return visits, desks


@query
def rebooking_orders(spark, sf_dir):
    """Repeat purchases in 30 days."""
    return analysis.rebooking(*_order_visits(spark, sf_dir), ["1-URGENT", "2-HIGH"],
                              ["3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"], 30)


@query
def rebooking_windows(spark, sf_dir):
    """Repeat purchases in 1 to 90 days, for several groupings at once, with their intervals."""
    rates = analysis.what_if(*_order_visits(spark, sf_dir), m.GROUPINGS, range(1, 91))
    return analysis.with_wilson(rates)


@query
def rebooking_ci(spark, sf_dir):
    return analysis.with_wilson(_rate(spark, sf_dir, ["Gold"], ["Silver", "Bronze"], 3))


@query
def rebooking_titled(spark, sf_dir):
    rate = _rate(spark, sf_dir, ["Bronze"], ["Gold", "Silver"], 1)
    return analysis.titled(analysis.with_sanity(rate))


@query
def rebooking_sanity(spark, sf_dir):
    return analysis.with_sanity(
        _rate(spark, sf_dir, ["Gold"], ["Bronze"], None).select(
            "mentor_tier", "total_users", "rebooking_rate_pct"
        )
    )


def _reliability(spark, sf_dir):
    return analysis.reliability(m.fct_bookings(*m.probed_log(spark, sf_dir)), m.dim_mentors(spark, sf_dir))


@query
def booking_reliability(spark, sf_dir):
    return _reliability(spark, sf_dir)


@query
def reliability_total(spark, sf_dir):
    return analysis.reliability_total(_reliability(spark, sf_dir))


@query
def reliability_pivot(spark, sf_dir):
    return analysis.reliability_pivot(_reliability(spark, sf_dir))


@query
def booking_intent(spark, sf_dir):
    log, hot = m.probed_log(spark, sf_dir)
    return analysis.intent(
        m.fct_sessions(log, hot),
        m.fct_bookings(log, hot),
        m.dim_mentors(spark, sf_dir),
        window_days=3,
    )


# --- incremental loads -------------------------------------------------------------------


def _first_batch(log: DataFrame) -> DataFrame:
    return log.filter(F.col("timestamp") < F.lit(m.FIRST_BATCH_ENDS).cast("timestamp_ntz"))


@query
def incremental_append(spark, sf_dir):
    """Events a second, cumulative delivery adds to a table that holds the first one."""
    log = m.event_log(spark, sf_dir)
    return unseen(log, _first_batch(log), "event_id")


@query
def late_events_frozen(spark, sf_dir):
    """Session facts after two deliveries: ends that came late change no stored row."""
    log, hot = m.probed_log(spark, sf_dir)
    stored = m.fct_sessions(_first_batch(log), hot)
    new = unseen(m.fct_sessions(log, hot), stored, "session_hk", null_keys=False)
    return stored.unionByName(new).drop("inserted_at")


@query
def dedup_keep_first(spark, sf_dir):
    orders = m.table(spark, sf_dir, "orders").withColumn("pos", F.col("o_orderkey"))
    return normalize.keep_first(orders, "o_custkey").drop("pos")


@query
def duplicate_key_count(spark, sf_dir):
    return preflight.duplicate_keys(m.table(spark, sf_dir, "orders"), "o_custkey")


@query
def event_duplicate_count(spark, sf_dir):
    """Events delivered once, and those with errors once more."""
    events = m.table(spark, sf_dir, "events")
    return preflight.duplicate_keys(events.unionByName(events.filter("event_type = 'error'")), "event_id")


# --- normalisation -----------------------------------------------------------------------


@query
def normalise_events(spark, sf_dir):
    return normalize.events(m.dirty_events(spark, sf_dir))


@query
def normalise_users(spark, sf_dir):
    orders = m.table(spark, sf_dir, "orders")
    customer = m.table(spark, sf_dir, "customer")
    raw = orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("c"), "o_custkey"))
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("user_id"),
        F.col("c_nationkey").cast("string").alias("company_id"),
        F.when(F.col("o_orderpriority") == "2-HIGH", "unknown")
        .otherwise(F.substring(F.col("o_orderdate").cast("string"), 1, 10))
        .alias("signup_date"),
        F.concat(F.lit("\t "), "o_orderstatus", F.lit(" ")).alias("status"),
        F.col("o_orderkey").alias("pos"),
    )
    return normalize.users(raw)


@query
def normalise_mentors(spark, sf_dir):
    sheet = m.supplier_sheet(spark, sf_dir)
    raw = sheet.select(
        F.concat(F.lit("  "), "mentor_id", F.lit("\t")).alias("mentor_id"),
        F.concat(F.lit(" "), F.upper("tier"), F.lit("-plus tier\n")).alias("tier"),
        F.when(F.col("s_acctbal") > 0, F.col("hourly_rate").cast("string"))
        .otherwise("n/a")
        .alias("hourly_rate"),
    )
    return normalize.mentors(raw)


@query
def unknown_event_types(spark, sf_dir):
    return normalize.unknown_types(normalize.events(m.dirty_events(spark, sf_dir)))


@query
def booking_null_users(spark, sf_dir):
    return normalize.booking_null_users(m.dirty_events(spark, sf_dir))


# --- data quality ------------------------------------------------------------------------


@query
def dq_not_null(spark, sf_dir):
    cols = ["booking_hk", "outcome_at", "first_session_at", "outcome_status"]
    return quality.not_null(m.fct_bookings(*m.probed_log(spark, sf_dir)), "fct_bookings", cols)


@query
def dq_unique(spark, sf_dir):
    sessions = m.fct_sessions(*m.probed_log(spark, sf_dir))
    return quality.unique(sessions, "fct_sessions", "session_hk").unionByName(
        quality.unique(sessions, "fct_sessions", "user_id")
    )


@query
def dq_accepted(spark, sf_dir):
    log = m.event_log(spark, sf_dir)
    return quality.accepted(log, "raw_events", {"event_type": EVENT_TYPES}).unionByName(
        quality.accepted(log, "raw_events", {"event_type": EVENT_TYPES[:3]})
    )


@query
def dq_relationships(spark, sf_dir):
    sessions = m.fct_sessions(*m.probed_log(spark, sf_dir))
    users = dims.stg_users(m.user_export(spark, sf_dir))
    orders = m.table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "user_id")
    return quality.relationships(sessions, "fct_sessions", "user_id", users).unionByName(
        quality.relationships(orders, "orders", "user_id", sessions, quality.WARN)
    )


@query
def dq_declared(spark, sf_dir):
    """All declared checks over the model: tables, staging views, dimensions and facts."""
    log, hot = m.probed_log(spark, sf_dir)
    sessions, bookings = pairing.sessions(log, hot), pairing.bookings(log, hot)
    raw_users = m.user_export(spark, sf_dir)
    staged = dims.stg_users(raw_users)
    sheet = m.supplier_sheet(spark, sf_dir)
    return quality.declared(
        {
            "raw_users": raw_users,
            "raw_mentors": sheet,
            "raw_events": log,
            "stg_users": staged,
            "stg_mentors": dims.stg_mentors(sheet),
            "stg_session_pairs": sessions,
            "stg_booking_pairs": bookings,
            "dim_users": dims.users(staged, m.AS_OF),
            "dim_mentors": dims.mentors(m.supplier_snapshot(spark, sf_dir)),
            "fct_sessions": facts.sessions(sessions, 30, m.AS_OF),
            "fct_bookings": facts.bookings(bookings, m.AS_OF),
        }
    )


@query
def dq_business(spark, sf_dir):
    log, hot = m.probed_log(spark, sf_dir)
    return quality.business(
        m.fct_sessions(log, hot),
        m.fct_bookings(log, hot),
        m.dim_mentors(spark, sf_dir),
        Params(group_a=("Diamond",), group_b=("Silver",)),
    )


@query
def available_tiers(spark, sf_dir):
    return quality.available_tiers(dims.mentors(m.supplier_snapshot(spark, sf_dir)))


# --- bookkeeping -------------------------------------------------------------------------


@query
def table_row_counts(spark, sf_dir):
    log, hot = m.probed_log(spark, sf_dir)
    return row_counts(
        {
            "raw_users": m.user_export(spark, sf_dir),
            "raw_mentors": m.supplier_sheet(spark, sf_dir),
            "raw_events": log,
            "fct_sessions": m.fct_sessions(log, hot),
            "fct_bookings": m.fct_bookings(log, hot),
        }
    )


def _run_log(spark, sf_dir):
    """A run per hour of events, logged at its start and, if it had no error, at its end."""
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    runs = m.table(spark, sf_dir, "events").groupBy(hour.alias("at")).agg(
        F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("errors")
    )
    stamp = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    config = F.struct(
        F.array(F.lit("Gold")).alias("group_a"),
        F.array(F.lit("Silver"), F.lit("Bronze")).alias("group_b"),
        F.lit(30).alias("window_days"),
    )
    start = runs.select(
        F.unix_seconds("at").alias("run_id"),
        F.date_format("at", stamp).alias("started_at"),
        F.lit(None).cast("string").alias("finished_at"),
        F.lit(None).cast("double").alias("duration_seconds"),
        F.lit("running").alias("status"),
        config.alias("config"),
        F.lit(0).cast("bigint").alias("new_users_ingested"),
        F.lit(False).alias("dq_checks_passed"),
        F.array().cast("array<string>").alias("warnings"),
        F.col("errors"),
        F.col("n"),
        "at",
    )
    end = start.filter(F.col("errors") < 6).withColumns(
        {
            "finished_at": F.date_format(F.col("at") + F.expr("INTERVAL 90 SECOND"), stamp),
            "duration_seconds": F.lit(90.0),
            "status": F.lit("success"),
            "new_users_ingested": F.col("n"),
            "dq_checks_passed": F.col("errors") == 0,
            "warnings": F.array_repeat(F.lit("w"), F.col("errors").cast("int")),
        }
    )
    return start.unionByName(end).drop("errors", "n", "at")


@query
def run_history(spark, sf_dir):
    return runlog.history(_run_log(spark, sf_dir))


@query
def run_history_page(spark, sf_dir):
    """The third page of the history."""
    return runlog.history(_run_log(spark, sf_dir), page=2, page_size=10)



# --- streams -----------------------------------------------------------------------------

DAYS = 24 * 60


def _sessions_streamed(spark, sf_dir, patience_minutes):
    """Sessions of the log as a stream in several deliveries, out of order inside the watermark."""
    rows = m.deliveries(m.event_log(spark, sf_dir))
    pairs = m.through_stream(rows, lambda s: streamed.sessions(s, m.DELAY, patience_minutes))
    return facts.sessions(pairs, 30, m.AS_OF).drop("inserted_at")


@query
def sessions_streamed(spark, sf_dir):
    """Every session waits for its end longer than the log is: what one batch gives."""
    return _sessions_streamed(spark, sf_dir, 400 * DAYS)


@query
def sessions_streamed_impatient(spark, sf_dir):
    """Sessions that have not ended after two days count as open."""
    return _sessions_streamed(spark, sf_dir, 2 * DAYS)


@query
def events_deduplicated_streamed(spark, sf_dir):
    """The log as a stream that brings half of its types twice, in the same delivery or the next."""
    log = m.event_log(spark, sf_dir)
    rows = m.deliveries(log, log.filter(F.col("event_type").isin(["session_started", "session_ended"])))
    out = m.through_stream(rows, lambda s: streamed.deduplicated(s, m.DELAY))
    return out.filter(F.col("event_type") != streamed.HEARTBEAT)


@query
def event_counts_daily(spark, sf_dir):
    rows = m.deliveries(m.event_log(spark, sf_dir))
    return m.through_stream(rows, lambda s: streamed.counts(s, "1 day", delay=m.DELAY))


@query
def event_counts_sliding(spark, sf_dir):
    rows = m.deliveries(m.event_log(spark, sf_dir))
    return m.through_stream(rows, lambda s: streamed.counts(s, "2 days", "1 day", m.DELAY))


@query
def user_visits(spark, sf_dir):
    """Runs of a user's events with at most 12 hours between neighbours."""
    rows = m.deliveries(m.event_log(spark, sf_dir))
    return m.through_stream(rows, lambda s: streamed.visits(s, "12 hours", m.DELAY))
