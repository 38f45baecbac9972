"""Splitting the timeline of a hot group over many tasks.

"What comes next" questions are window scans over one (user, mentor) timeline. A timeline
with very many rows would be one task, so hot ones are cut into slices of a set number of rows
along time. A single instant too big for a slice is spread over salts. Every
(slice, salt) is a *lane*: a scan runs per lane, and one small row per lane carries what lies
in later slices back into it. All other timelines use lane 0 and need none of this.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PAIR = ["user_id", "mentor_id"]
_SALTS = 1 << 20  # lane = slice * _SALTS + salt


@dataclass(frozen=True)
class SkewPolicy:
    """When a timeline counts as hot, and how finely the hot ones are cut.

    A timeline with more than ``target_rows`` rows is cut into slices of about that many, at most
    twice as many, however long the log is; an instant with more is spread over salts. Instants are
    counted in stretches of ``grain`` time and the stretches added up, so no task sees all instants
    of a timeline. There are at most 3 slices for every ``target_rows`` rows of the log.
    """

    target_rows: int = 1_000_000
    grain: str = "1 hour"


def hot_timelines(events: DataFrame, policy: SkewPolicy = SkewPolicy()) -> DataFrame | None:
    """Slices for the hot (user, mentor) timelines of ``events``; None when there is none.

    Rows are counted by timeline, then those of hot ones by instant; where the running number of
    rows passes a multiple of the target, a slice begins. All of it is grouping and shuffling; the
    driver learns only whether a timeline is hot.
    """
    target = policy.target_rows
    if events.count() <= target:  # no timeline has more rows than the log
        return None
    rows = events.select(
        F.col("user_id").cast("bigint").alias("user_id"),
        F.trim("mentor_id").alias("mentor_id"),
        F.col("timestamp").cast("timestamp_ntz").alias("at"),
    ).dropna()
    counts = rows.groupBy(*PAIR).agg(F.count("*").alias("rows")).filter(F.col("rows") > target)
    if counts.isEmpty():
        return None
    stretch = F.window("at", policy.grain)["start"]
    # At most a row for every target's worth of the log. A shuffled join would leave all rows of a
    # timeline in one task, and the grouping after it there as well.
    instants = (
        rows.join(F.broadcast(counts.select(*PAIR)), PAIR, "left_semi")
        .groupBy(*PAIR, "at")
        .agg(F.count("*").alias("n"))
        .withColumn("stretch", stretch)
    )
    in_pair = Window.partitionBy(*PAIR).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*PAIR, "stretch").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    stretches = (
        instants.groupBy(*PAIR, "stretch")
        .agg(F.sum("n").alias("n"))
        .select(*PAIR, "stretch", F.coalesce(F.sum("n").over(in_pair), zero).alias("earlier"))
    )
    bounds = (
        instants.withColumn("before", F.coalesce(F.sum("n").over(inside), zero))
        .join(stretches, [*PAIR, "stretch"])
        .withColumns(
            {
                "part": F.floor((F.col("earlier") + F.col("before")) / target),
                "salts": F.ceil(F.col("n") / target).cast("int"),
            }
        )
        # An instant of several salts is a slice of its own; the next one lies in a later part.
        .groupBy(*PAIR, "part", F.col("salts") > 1)
        .agg(F.min("at").alias("at"), F.max("salts").alias("salts"))
    )
    return (
        bounds.groupBy(*PAIR)
        .agg(F.sort_array(F.collect_list(F.struct("at", "salts"))).alias("b"))
        .withColumn("width", F.greatest(F.lit(1), F.floor(F.sqrt(F.size("b")))).cast("int"))
        .withColumn("starts", F.sequence(F.lit(0), F.size("b") - 1, F.col("width")))
        .select(
            *PAIR,
            F.transform("starts", lambda i: F.get(F.col("b"), i)["at"]).alias("heads"),
            F.transform("starts", lambda i: F.slice("b.at", i + 1, F.col("width"))).alias("chunks"),
            "starts",
            F.concat(F.array(F.lit(1)), F.col("b.salts")).alias("salts"),
        )
    )


def _place(joined: DataFrame) -> DataFrame:
    """``slice`` and ``salted`` of rows joined to their timeline's slices; NULL without any.

    Step by step, so that each list is searched once per row.
    """
    at = F.col("at")
    return (
        joined.withColumn("block", F.size(F.filter("heads", lambda b: b <= at)))
        .withColumn(
            "slice",
            F.when(F.col("heads").isNull(), None)
            .when(F.col("block") == 0, 0)
            .otherwise(
                F.element_at("starts", F.col("block"))
                + F.size(F.filter(F.element_at("chunks", F.col("block")), lambda b: b <= at))
            ),
        )
        .withColumn("pieces", F.element_at("salts", F.col("slice") + 1))
    )


def assign(df: DataFrame, hot: DataFrame | None, usable: Column):
    """Give every row its ``lane``; return the rows, and those of hot timelines once more.

    Rows that cannot match anything get spread-out negative lanes.
    """
    spread = F.xxhash64("event_id", "at", *PAIR)
    aside = -1 - F.pmod(spread, F.lit(4096))
    zero = F.lit(0).cast("bigint")
    if hot is None:
        return df.withColumn("lane", F.when(usable, zero).otherwise(aside)), None
    lane = F.col("slice").cast("bigint") * _SALTS + F.pmod(spread, F.col("pieces"))
    # A row for each hot timeline and three entries for every target's worth of the log's rows, at most.
    slices = F.broadcast(hot)
    rows = _place(df.join(slices, PAIR, "left")).select(
        *df.columns, F.when(~usable, aside).otherwise(F.coalesce(lane, zero)).alias("lane")
    )
    side = _place(df.filter(usable).join(slices, PAIR)).select(
        *df.columns, lane.alias("lane"), (F.col("pieces") > 1).alias("salted")
    )
    return rows, side


def next_of(rows: DataFrame, side: DataFrame | None, wanted: dict[str, Column],
            anchor: str | None = None):
    """For every row, the nearest strictly later value of each ``wanted`` expression.

    ``wanted`` values are the row's time, or a struct that starts with it, on rows of the
    wanted kind and NULL elsewhere. Time runs backwards through a running frame, so each
    timeline is read once. At equal times rows of a lower ``kind`` come first, hence do not
    see the rows after them. Only the entry named ``anchor`` looks further: rows of that
    kind see the one of equal time with the next higher event id.

    Takes and returns both frames of :func:`assign`.
    """
    if side is None:
        return _scan(rows, wanted), None
    # One row per lane of a hot timeline: bounded like the slices are.
    carried = F.broadcast(_carry(side, wanted, anchor))

    def complete(df: DataFrame) -> DataFrame:
        joined = _scan(df, wanted).join(carried, [*PAIR, "lane"], "left")
        filled = [F.coalesce(F.col(k), F.col(f"{k}__carry")).alias(k) for k in wanted]
        return joined.select(*df.columns, *filled)

    return complete(rows), complete(side)


def _scan(df: DataFrame, wanted: dict[str, Column]) -> DataFrame:
    order = [F.col("at").desc(), F.col("kind").asc(), F.col("event_id").desc_nulls_first()]
    w = Window.partitionBy(*PAIR, "lane").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1
    )
    return df.select(
        "*", *[F.last(v, ignorenulls=True).over(w).alias(k) for k, v in wanted.items()]
    )


def _carry(side: DataFrame, wanted: dict[str, Column], anchor: str | None) -> DataFrame:
    """What lies in later slices, for every lane of a hot timeline."""
    lanes = (
        side.groupBy(*PAIR, "lane")
        .agg(*[F.min(v).alias(k) for k, v in wanted.items()])
        .withColumn("slice", F.floor(F.col("lane") / _SALTS))
    )
    later = Window.partitionBy(*PAIR).orderBy(-F.col("slice")).rangeBetween(
        Window.unboundedPreceding, -1
    )
    carry = {k: F.min(k).over(later) for k in wanted}
    if anchor:
        # In a salted instant an anchor also precedes the higher ids in the other lanes.
        last = F.max(F.coalesce(F.col("event_id"), F.lit("\U0010ffff"))).alias("last_id")
        salted = side.filter(F.col("salted") & wanted[anchor].isNotNull())
        lanes = lanes.join(salted.groupBy(*PAIR, "lane").agg(last), [*PAIR, "lane"], "left")
        peers = Window.partitionBy(*PAIR, "slice")
        carry[anchor] = F.when(
            F.col("last_id") < F.max("last_id").over(peers), F.max(anchor).over(peers)
        ).otherwise(carry[anchor])
    return lanes.select(*PAIR, "lane", *[v.alias(f"{k}__carry") for k, v in carry.items()])
