"""The given tables seen as the inputs of the lifecycle jobs.

``events`` is the event log, ``nation`` the mentor sheet behind it, ``supplier`` a mentor sheet
that grows with the data, and ``orders`` the user export, one line per order.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sojourn.operators import lanes, pairing, scd2
from sojourn.plans import dims, facts
from sojourn.session import new_folder
from sojourn.streaming import sessions as streamed

# Which given event type stands for which lifecycle event.
LIFECYCLE = {
    "signup": "booking_requested",
    "click": "booking_confirmed",
    "error": "booking_cancelled",
    "view": "session_started",
    "purchase": "session_ended",
}
MENTORS = 25
AS_OF = datetime(2024, 2, 1)
LATER = datetime(2024, 3, 1)
LAST = datetime(2024, 4, 1)
#: Groups of order priorities to compare.
GROUPINGS = [
    (["1-URGENT", "2-HIGH"], ["3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]),
    (["1-URGENT"], ["5-LOW"]),
    (["3-MEDIUM"], ["1-URGENT", "4-NOT SPECIFIED"]),
    (["2-HIGH", "5-LOW"], ["3-MEDIUM"]),
]
FIRST_BATCH_ENDS = "2024-01-16"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lifecycle(kind: Column) -> Column:
    out = None
    for given, ours in LIFECYCLE.items():
        out = F.when(kind == given, ours) if out is None else out.when(kind == given, ours)
    return out


def event_log(spark, sf_dir) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        "user_id",
        F.concat(F.lit("M"), (k % MENTORS).cast("string")).alias("mentor_id"),
        F.col("ts").alias("timestamp"),
        _lifecycle(F.col("event_type")).alias("event_type"),
    )


def _tier(n: Column) -> Column:
    return F.when(n <= 1, "Gold").when(n <= 3, "Silver").otherwise("Bronze")


def mentor_sheet(spark, sf_dir) -> DataFrame:
    """The mentors of the event log."""
    return table(spark, sf_dir, "nation").select(
        F.concat(F.lit("M"), F.col("n_nationkey").cast("string")).alias("mentor_id"),
        _tier(F.col("n_regionkey")).alias("tier"),
        (F.lit(50) + F.col("n_nationkey")).cast("int").alias("hourly_rate"),
    )


def supplier_sheet(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("M"), F.col("s_suppkey").cast("string")).alias("mentor_id"),
        _tier(F.col("s_nationkey") % 5).alias("tier"),
        (F.lit(50) + F.col("s_nationkey")).cast("int").alias("hourly_rate"),
        "s_acctbal",
    )


def supplier_versions(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The sheet, and a later one: some mentors left or joined, some tiers or rates changed."""
    base = supplier_sheet(spark, sf_dir)
    balance = F.col("s_acctbal")
    moved = (
        F.when(balance <= 6000, F.col("tier"))
        .when(F.col("tier") == "Gold", "Silver")
        .when(F.col("tier") == "Silver", "Bronze")
        .otherwise("Gold")
    )
    stayed = base.filter(balance >= 0).select(
        "mentor_id",
        moved.alias("tier"),
        F.when(balance < 3000, F.col("hourly_rate") + 5)
        .otherwise(F.col("hourly_rate"))
        .alias("hourly_rate"),
    )
    joined = base.filter(balance.between(2000, 4000)).select(
        F.concat(F.lit("N"), "mentor_id").alias("mentor_id"), "tier", "hourly_rate"
    )
    return base.drop("s_acctbal"), stayed.unionByName(joined)


def supplier_snapshot(spark, sf_dir) -> DataFrame:
    one, two = supplier_versions(spark, sf_dir)
    first = scd2.apply(None, one, "mentor_id", ["tier"], AS_OF)
    return scd2.apply(first, two, "mentor_id", ["tier"], LATER)


def user_export(spark, sf_dir) -> DataFrame:
    """Raw users with repeats: each order is one line about its customer."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.col("o_custkey").alias("user_id"),
        F.col("c_nationkey").cast("bigint").alias("company_id"),
        F.col("o_orderdate").alias("signup_date"),
        F.lower("o_orderstatus").alias("status"),
    )


def dim_mentors(spark, sf_dir) -> DataFrame:
    return dims.mentors(
        scd2.apply(None, mentor_sheet(spark, sf_dir), "mentor_id", ["tier"], AS_OF)
    )


def probed_log(spark, sf_dir) -> tuple[DataFrame, DataFrame | None]:
    """The event log and its hot timelines, looked for once per query."""
    log = event_log(spark, sf_dir)
    return log, pairing.hot_timelines(log)


#: Rows in a slice of a timeline where slices are to be seen on little data.
SMALL_SLICES = lanes.SkewPolicy(target_rows=100)


def hot_log(spark, sf_dir) -> DataFrame:
    """The event log with a third of its rows in one timeline, and a tenth of those at one instant a day."""
    log = event_log(spark, sf_dir)
    n = F.col("event_id").cast("bigint")
    hot = n % 3 == 0
    return log.select(
        "event_id",
        F.when(hot, F.lit(1).cast("bigint")).otherwise(F.col("user_id")).alias("user_id"),
        F.when(hot, "M1").otherwise(F.col("mentor_id")).alias("mentor_id"),
        F.when(hot & (n % 30 == 0), F.col("timestamp").cast("date").cast("timestamp_ntz"))
        .otherwise(F.col("timestamp"))
        .alias("timestamp"),
        "event_type",
    )


def fct_sessions(log: DataFrame, hot: DataFrame | None) -> DataFrame:
    return facts.sessions(pairing.sessions(log, hot), 30, AS_OF)


def fct_bookings(log: DataFrame, hot: DataFrame | None) -> DataFrame:
    return facts.bookings(pairing.bookings(log, hot), AS_OF)


def dirty_events(spark, sf_dir) -> DataFrame:
    """The event log as messy text: odd user ids, blanks, capitals, bad times, repeats."""
    k = F.get_json_object("props", "$.k").cast("int")
    joined = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        "user_id",
        F.concat(F.lit("M"), (k % MENTORS).cast("string")).alias("mentor_id"),
        F.col("ts").alias("timestamp"),
        _lifecycle(F.col("event_type")).alias("event_type"),
        F.col("event_id").alias("pos"),
        "value",
    )
    user = F.col("user_id").cast("string")
    text = joined.select(
        "event_id",
        F.when(F.col("value") < 2, F.concat(F.lit("u"), user))
        .when(F.col("value") < 4, F.concat(user, F.lit(".5")))
        .when(F.col("value") < 6, F.concat(F.lit("+"), user))
        .otherwise(user)
        .alias("user_id"),
        F.concat(F.lit(" \t"), "mentor_id", F.lit("\n ")).alias("mentor_id"),
        F.when(F.col("value") > 60, "soon")
        .otherwise(
            F.concat(F.regexp_replace(F.col("timestamp").cast("string"), " ", "T"), F.lit("Z"))
        )
        .alias("timestamp"),
        F.when(F.col("value").between(10, 11), "  Page_View ")
        .otherwise(F.concat(F.lit(" "), F.upper("event_type")))
        .alias("event_type"),
        "pos",
    )
    # Half of the vocabulary is delivered twice; the second delivery has another mentor.
    again = text.filter(F.col("event_type").contains("SESSION")).select(
        "event_id",
        "user_id",
        F.lit("M-again").alias("mentor_id"),
        "timestamp",
        "event_type",
        (F.col("pos") + 1_000_000_000_000).alias("pos"),
    )
    return text.unionByName(again)


#: How many deliveries the log comes in, how far out of order, and how late a row may be.
DELIVERIES, OUT_OF_ORDER_HOURS, DELAY = 3, 5, "12 hours"


def deliveries(log: DataFrame, again: DataFrame | None = None) -> DataFrame:
    """The log's rows with the ``delivery`` each comes in: by time, but hours out of order.

    Rows of ``again`` come once more, out of order in their own way. The last delivery ends with
    a heartbeat long after the log.
    """
    us = F.unix_micros(F.col("timestamp").cast("timestamp"))

    def late(df: DataFrame, salt: int) -> DataFrame:
        most = OUT_OF_ORDER_HOURS * 3_600_000_000
        shift = F.pmod(F.xxhash64("event_id", F.lit(salt)), F.lit(2 * most)) - most
        return df.withColumn("_at", us + shift)

    rows = late(log, 0) if again is None else late(log, 0).unionByName(late(again, 1))
    span = log.agg(F.min(us).alias("_lo"), F.max(us).alias("_hi"))  # one row
    part = F.floor((F.col("_at") - F.col("_lo")) * DELIVERIES / (F.col("_hi") - F.col("_lo") + 1))
    placed = rows.crossJoin(F.broadcast(span)).select(
        *log.columns, F.least(F.greatest(part, F.lit(0)), F.lit(DELIVERIES - 1)).alias("delivery")
    )
    beat = span.select(
        F.lit(None).cast("string").alias("event_id"),
        F.lit(None).cast("bigint").alias("user_id"),
        F.lit(None).cast("string").alias("mentor_id"),
        F.timestamp_micros(F.col("_hi") + F.lit(800 * 86_400_000_000)).cast("timestamp_ntz").alias("timestamp"),
        F.lit(streamed.HEARTBEAT).alias("event_type"),
        F.lit(DELIVERIES - 1).cast("bigint").alias("delivery"),
    )
    return placed.unionByName(beat)


def through_stream(rows: DataFrame, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``step`` makes of ``rows`` as a stream: each delivery is a run from the checkpoint of the last one."""
    spark = streamed.with_state_store(rows.sparkSession)
    place = new_folder(spark, "stream")
    rows.write.partitionBy("delivery").parquet(f"{place}/rows")
    kept = spark.read.parquet(f"{place}/rows").drop("delivery")
    for k in range(DELIVERIES):
        spark.read.parquet(f"{place}/rows/delivery={k}").write.mode("append").parquet(f"{place}/inbox")
        out = step(spark.readStream.schema(kept.schema).parquet(f"{place}/inbox"))
        streamed.drained(out, f"{place}/out", f"{place}/checkpoint")
    return spark.read.schema(out.schema).parquet(f"{place}/out")
