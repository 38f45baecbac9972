"""Column expressions shared by the jobs; all of them stay in the JVM."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(c: Column) -> Column:
    """Remove every kind of leading and trailing whitespace, not only spaces."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def title_case(c: Column) -> Column:
    """Capitalise each run of letters and digits: ``gold-plus`` becomes ``Gold-Plus``."""
    runs = F.regexp_extract_all(
        F.lower(c), F.lit(r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"), F.lit(0)
    )
    capital = F.transform(
        runs, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))
    )
    return F.when(c.isNotNull(), F.array_join(capital, ""))


def whole_number(c: Column) -> Column:
    """Parse a plain signed integer; anything else, blanks around it included, is NULL."""
    return F.when(c.rlike(r"^[+-]?\d+\z"), c.try_cast("bigint"))


def lenient_time(c: Column) -> Column:
    """Parse a date-time to a zone-less UTC time; NULL when it does not parse."""
    return F.try_to_timestamp(c).cast("timestamp_ntz")


def hash_key(*parts: Column) -> Column:
    """SHA-256 of the ``|``-joined parts; NULL as soon as one part is NULL."""
    texts = [p.cast("string") for p in parts]
    joined = [texts[0]]
    for text in texts[1:]:
        joined += [F.lit("|"), text]
    return F.sha2(F.concat(*joined), 256)


def minutes_between(start: Column, end: Column) -> Column:
    """Number of minute boundaries crossed: 10:00:59 to 10:01:01 is 1."""

    def minute(t: Column) -> Column:
        us = F.unix_micros(t.cast("timestamp"))
        return us - F.pmod(us, F.lit(60_000_000))

    return ((minute(end) - minute(start)) / F.lit(60_000_000)).cast("long")


def wall_time(t: datetime | None) -> Column:
    """A zone-less time as it stands, whatever the zone of the host or the session."""
    return F.lit(t and t.isoformat(sep=" ")).cast("timestamp_ntz")


def days_after(t: Column, days: int) -> Column:
    return t + F.make_dt_interval(F.lit(int(days)))


def percent(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` to one decimal, in double; NULL when ``whole`` is 0."""
    return F.round(
        F.lit(100.0) * part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)), 1
    )


def wilson(k: Column, n: Column, z: float = 1.96) -> tuple[Column, Column]:
    """Wilson score interval of ``k`` out of ``n`` in percent, 0..100, one decimal."""
    k, n = k.cast("double"), n.cast("double")
    total = n + z * z
    centre = (k + z * z / 2) / total
    spread = F.lit(z) * F.sqrt(k * (n - k) / F.nullif(n, F.lit(0.0)) + z * z / 4) / total
    low = F.round(F.greatest(F.lit(0.0), centre - spread) * 100, 1)
    high = F.round(F.least(F.lit(100.0), (centre + spread) * 100), 1)
    none = F.lit(0.0)
    return F.when(n == 0, none).otherwise(low), F.when(n == 0, none).otherwise(high)
