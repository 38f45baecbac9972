"""Sessions from a stream of events: timelines of users and mentors in state, with timers.

Events wait in state until the watermark has passed them, so that none before them can come any
more; then they are read in order of time. A session is handed on as soon as it is known: with its
end, at the next start, or, if it stays open, when the watermark has passed its start by the time
that sessions are waited for. Nothing is kept of it afterwards, so state is bounded by what lies
within the watermark's delay and by one open session for each timeline.

Timelines share shards of state: a key of state has a price in every micro-batch that touches it,
whatever it holds. A shard is one row, and its timelines are paired at once, column by column.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..params import EVENT_TYPES

#: The event type of rows that carry nothing but the time; they let the watermark pass idle hours.
HEARTBEAT = "heartbeat"

_START, _END, _OPEN = range(3)
_KINDS = ["session_started", "session_ended"]

#: Keeps state in files that change with it instead of whole in memory.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

Waiting = tuple[int, int, str | None]  # microseconds, kind, event id

#: What a shard holds.
_HELD = pa.schema([("at_us", pa.int64()), ("kind", pa.int32()), ("event_id", pa.string()),
                   ("user_id", pa.int64()), ("mentor_id", pa.string())])
#: What a row may lack, as bits; such rows match nothing.
_NO_USER, _NO_MENTOR, _NO_TIME = 1, 2, 4
_SESSION = {"session_start_event_id": "string", "user_id": "bigint", "mentor_id": "string",
            "started": "bigint", "ended": "bigint"}


def advance(waiting: Iterable[Waiting], until: int, patience: int | None) -> tuple[list[tuple], list[Waiting]]:
    """Sessions (event id, start, end or None) of one timeline known once all events up to ``until`` are there.

    Also returns what still waits. A session ends at the first end strictly between its start and
    the next one, at most ``patience`` later. Of starts at one time all but the highest id, a null
    one being the highest, own an empty interval.
    """
    held = _table([(*w, 0, "") for w in waiting])
    found, rest = _advanced(held, until, patience)
    columns = (found[c] for c in ("session_start_event_id", "started", "ended"))
    return list(zip(*columns)), list(zip(*(rest[c].to_pylist() for c in _HELD.names[:3])))


def _advanced(held: pa.Table, until: int, patience: int | None) -> tuple[pd.DataFrame, pa.Table]:
    """``advance`` for all timelines of a shard at once: sessions, and what still waits."""
    rank = np.array([1, 2, 0], dtype=np.int8)[held["kind"].to_numpy()]  # open sessions, starts, ends
    keys = ["user_id", "mentor_id", "at_us", "rank", "event_id"]
    order = pc.sort_indices(held.append_column("rank", pa.array(rank)), [(k, "ascending") for k in keys])
    held = held.take(order).combine_chunks()
    at, kind, user = (held[c].to_numpy() for c in ("at_us", "kind", "user_id"))
    mentor = held["mentor_id"].combine_chunks().dictionary_encode().indices.to_numpy()
    timeline = np.cumsum(_changes(user) | _changes(mentor))
    # A timeline's open session lies before all that waits, and what is known before the rest.
    known = np.flatnonzero((kind == _OPEN) | (at <= until))
    time, line, start = at[known], timeline[known], kind[known] != _END
    first = _changes(line) | _changes(time)
    last = start & np.append(first[1:] | ~start[1:], True)[: len(start)]
    # Where the next instant of all begins, and whether it is one of the same timeline.
    instants = np.append(np.flatnonzero(first), len(known))
    following = instants[np.cumsum(first)]
    there = np.append(line, -1)[following] == line
    then = np.append(time, 0)[following]
    ended = last & there & ~np.append(start, False)[following]
    if patience is not None:
        ended &= then <= time + patience
    stays = last & ~there
    if patience is not None:
        stays &= time + patience > until
    found = held.take(pa.array(known[start & ~stays]))
    ends = np.where(ended, then.astype(object), None)[start & ~stays]
    columns = [found[c].to_numpy() for c in ("event_id", "user_id", "mentor_id", "at_us")]
    rest = np.ones(len(at), dtype=bool)
    rest[known] = stays
    opened = kind.copy()
    opened[known[stays]] = _OPEN
    held = held.set_column(1, _HELD.field("kind"), pa.array(opened)).filter(pa.array(rest))
    return pd.DataFrame(dict(zip(_SESSION, (c.astype(object) for c in (*columns, ends))))), held


def _changes(values: np.ndarray) -> np.ndarray:
    """Where a value differs from the one before."""
    return np.append(True, values[1:] != values[:-1])[: len(values)]


class _Shard:
    """Many timelines of a user and mentor each: events that wait, the open sessions among them.

    Rows, results and state go in columns, since a row that is an object of its own costs much more
    than its values.
    """

    def __init__(self, patience: int | None) -> None:
        self.patience = patience

    def __call__(self, key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        until = state.getCurrentWatermarkMs() * 1000
        blocks, wake = [], None
        if state.exists:
            held, wake = state.get
            blocks.append(_read(held))
        if not state.hasTimedOut:
            for frame in frames:
                lacks = frame["lacks"].to_numpy()
                new = frame if not lacks.any() else frame[lacks == 0]
                if len(new):
                    blocks.append(_columns(new))
                    wake = _first(wake, self._wakes(blocks[-1]))
                # Rows that match nothing.
                aside = frame[(lacks != 0) & (frame["kind"].to_numpy() == _START)]
                if len(aside):
                    yield _aside(aside)
        if not blocks:
            return
        held = pa.concat_tables(blocks)
        if wake is not None and wake <= until:
            found, held = _advanced(held, until, self.patience)
            yield found
            wake = _first(None, self._wakes(held))
        if not held.num_rows:
            state.remove()
            return
        state.update((_written(held), wake))
        if wake is not None:
            # A group is woken once the watermark is beyond the time that is set.
            state.setTimeoutTimestamp(max(-(-wake // 1000) - 1, 1))

    def _wakes(self, held: pa.Table) -> np.ndarray:
        """When something may become known by rows that wait."""
        at, opened = held["at_us"].to_numpy(), held["kind"].to_numpy() == _OPEN
        return at[~opened] if self.patience is None else np.where(opened, at + self.patience, at)


def _first(wake: int | None, others: np.ndarray) -> int | None:
    """The earliest time; None is none."""
    if not len(others):
        return wake
    return int(others.min()) if wake is None else min(wake, int(others.min()))


def _table(rows: list[tuple]) -> pa.Table:
    columns = zip(*rows) if rows else [()] * len(_HELD)
    return pa.Table.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, _HELD)], schema=_HELD)


def _columns(frame: pd.DataFrame) -> pa.Table:
    columns = [pa.array(frame[f.name], type=f.type, from_pandas=True) for f in _HELD]
    return pa.Table.from_arrays(columns, schema=_HELD)


def _aside(frame: pd.DataFrame) -> pd.DataFrame:
    """Starts that match nothing as sessions without an end."""
    lacks = frame["lacks"].to_numpy()
    columns = [
        frame["event_id"].to_numpy(),
        np.where(lacks & _NO_USER, None, frame["user_id"].astype(object)),
        frame["mentor_id"].to_numpy(),
        np.where(lacks & _NO_TIME, None, frame["at_us"].astype(object)),
        np.full(len(frame), None),
    ]
    return pd.DataFrame(dict(zip(_SESSION, columns)))


def _read(held: bytes) -> pa.Table:
    return pa.ipc.open_stream(held).read_all()


def _written(held: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _HELD) as writer:
        writer.write_table(held.combine_chunks())
    return sink.getvalue().to_pybytes()


def _minutes(n: int | None) -> int | None:
    return None if n is None else n * 60_000_000


def sessions(events: DataFrame, delay: str = "1 hour", patience_minutes: int | None = None,
             shards: int = 4096) -> DataFrame:
    """A row per ``session_started`` of a stream of events, as ``pairing.sessions`` gives for a batch.

    ``delay`` is how far events may come out of order; later ones are dropped and counted, see
    ``late_rows``. ``patience_minutes`` is how long after its start a session waits for its end,
    None for as long as it takes. Starts without a user, mentor or time match nothing and are handed
    on at once. ``heartbeat`` rows only move the watermark. The session's state store must keep its
    state in files (``STATE_STORE``). Timelines are dealt to ``shards`` keys of state, which a
    checkpoint fixes; one task holds a shard at a time, and rewrites it when something in it is due.
    """
    typed = events.select(
        "event_id",
        F.col("user_id").cast("bigint").alias("user_id"),
        F.trim("mentor_id").alias("mentor_id"),
        F.col("timestamp").cast("timestamp").alias("at"),
        "event_type",
    ).withWatermark("at", delay)
    # Spark moves a filter before the watermark unless it is about the time, and heartbeats with it.
    wanted = F.when(F.col("at").isNull(), F.col("event_type") == _KINDS[_START]).otherwise(
        F.col("event_type").isin(_KINDS)
    )
    bits = {"user_id": _NO_USER, "mentor_id": _NO_MENTOR, "at": _NO_TIME}
    lacks = reduce(add, [F.when(F.col(c).isNull(), bit).otherwise(0) for c, bit in bits.items()])
    shard, zero = _Shard(_minutes(patience_minutes)), F.lit(0).cast("bigint")
    place = F.when(lacks == 0, F.xxhash64("user_id", "mentor_id")).otherwise(F.xxhash64("event_id", "at"))
    seen = (
        typed.filter(wanted)
        .select(
            F.pmod(place, F.lit(shards)).alias("shard"),
            "event_id",
            # Numbers with gaps would become floating-point ones.
            F.coalesce("user_id", zero).alias("user_id"),
            "mentor_id",
            "at",  # carries the watermark
            (F.array_position(F.lit(_KINDS), F.col("event_type")) - 1).cast("int").alias("kind"),
            F.coalesce(F.unix_micros("at"), zero).alias("at_us"),
            lacks.alias("lacks"),
        )
        .groupBy("shard")
        .applyInPandasWithState(
            shard.__call__,
            ", ".join(f"{name} {kind}" for name, kind in _SESSION.items()),
            "held binary, wake long",
            "append",
            GroupStateTimeout.EventTimeTimeout,
        )
    )

    def time(micros: str):
        return F.timestamp_micros(micros).cast("timestamp_ntz")

    return seen.select(
        "session_start_event_id",
        "user_id",
        "mentor_id",
        time("started").alias("started_at"),
        time("ended").alias("ended_at"),
    )


def deduplicated(events: DataFrame, delay: str = "1 hour", key: str = "event_id") -> DataFrame:
    """A stream without repeats of ``key`` that come at most ``delay`` apart in event time.

    Keys are kept in state until the watermark has passed them, so nothing that is stored is read,
    and the state does not grow with the stream. Rows behind the watermark are dropped and counted,
    see ``late_rows``: a repeat from there cannot be told from a new event without a look at what is
    stored, which ``events.ingest`` takes.
    """
    timed = events.withColumn("_at", F.col("timestamp").cast("timestamp")).withWatermark("_at", delay)
    return timed.dropDuplicatesWithinWatermark([key]).drop("_at")


def _counted(windows: DataFrame) -> DataFrame:
    time = {n: F.col(f"window.{n}").cast("timestamp_ntz").alias(f"window_{n}") for n in ("start", "end")}
    keys = [c for c in windows.columns if c not in ("window", "n")]
    return windows.select(*time.values(), *keys, "n")


def _timed(events: DataFrame, delay: str) -> DataFrame:
    timed = events.withColumn("at", F.col("timestamp").cast("timestamp")).withWatermark("at", delay)
    # About the time as well, so that Spark does not move it before the watermark.
    return timed.filter(F.when(F.col("at").isNotNull(), F.col("event_type").isin(list(EVENT_TYPES))))


def counts(events: DataFrame, length: str, step: str | None = None, delay: str = "1 hour") -> DataFrame:
    """Events of each type by window of event time: tumbling, or sliding with a ``step``.

    A window is handed on once, when the watermark has passed its end.
    """
    window = F.window("at", length, step)
    return _counted(_timed(events, delay).groupBy(window.alias("window"), "event_type").agg(F.count("*").alias("n")))


def visits(events: DataFrame, gap: str, delay: str = "1 hour") -> DataFrame:
    """Runs of a user's events with at most ``gap`` between neighbours; an end lies ``gap`` behind the last."""
    rows = _timed(events, delay).filter(F.when(F.col("at").isNotNull(), F.col("user_id").isNotNull()))
    window = F.session_window("at", gap)
    return _counted(rows.groupBy(window.alias("window"), "user_id").agg(F.count("*").alias("n")))


def drained(stream: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Run ``stream`` over all there is and add what it gives to parquet files; returns when done.

    Files and their log are written once for each micro-batch, so a restart adds no row twice. State
    gets a partition for each core at most, as every micro-batch opens all of them; a restart keeps
    the number that the first run chose.
    """
    spark, partitions = stream.sparkSession, "spark.sql.shuffle.partitions"
    before = spark.conf.get(partitions)
    spark.conf.set(partitions, min(int(before), spark.sparkContext.defaultParallelism))
    try:
        query = (
            stream.writeStream.format("parquet")
            .option("path", folder)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.set(partitions, before)
    query.awaitTermination()
    return query


def late_rows(query: StreamingQuery) -> int:
    """Rows that came behind the watermark and were left out, over the query's recent micro-batches."""
    return sum(
        state["numRowsDroppedByWatermark"] for p in query.recentProgress for state in p["stateOperators"]
    )


def with_state_store(spark: SparkSession) -> SparkSession:
    """Set ``STATE_STORE`` on a session that already runs."""
    for key, value in STATE_STORE.items():
        spark.conf.set(key, value)
    return spark
