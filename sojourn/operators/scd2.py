"""Versioned dimension rows (slowly changing dimension, type 2)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import wall_time
from .dedup import first_per_key

_META = ["dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"]


def apply(snapshot: DataFrame | None, source: DataFrame, key: str, check_cols: list[str],
          as_of: datetime, close_missing: bool = True) -> DataFrame:
    """The snapshot after seeing ``source`` at ``as_of``.

    A key without an open row opens one; a change in ``check_cols`` closes the open row and
    opens another; a key missing from the source closes its open row. Changes in the other
    columns alone leave the stored row as it is. Of a key's several rows in ``source`` the
    least one counts, and of several open rows in the snapshot the newest; the others are closed.
    """
    source = first_per_key(source, [key], [F.col(c) for c in source.columns if c != key])
    now = wall_time(as_of)
    fields = source.columns
    fresh = [
        F.md5(F.concat_ws("|", F.col(key).cast("string"), now.cast("string"))).alias(_META[0]),
        now.alias(_META[1]),
        now.alias(_META[2]),
        F.lit(None).cast("timestamp_ntz").alias(_META[3]),
    ]
    opened = source.select(*fields, *fresh)
    if snapshot is None:
        return opened

    cols = [*fields, *_META]
    old = snapshot.select(F.col(key).alias("old_key"), F.struct(*cols).alias("old"))
    new = opened.select(F.col(key).alias("new_key"), F.struct(*cols).alias("new"))
    # Closed versions match nothing and pass through, so history is read only once.
    match = (F.col("old_key") == F.col("new_key")) & F.col("old.dbt_valid_to").isNull()
    is_open = F.col("old").isNotNull() & F.col("old.dbt_valid_to").isNull()
    same = F.lit(True)
    for c in check_cols:
        same = same & F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))
    closed = F.struct(
        *[F.col(f"old.{c}").alias(c) for c in cols if c != "dbt_valid_to"],
        now.alias("dbt_valid_to"),
    )
    gone = closed if close_missing else F.col("old")
    rows = (
        F.when(F.col("old").isNull(), F.array("new"))
        .when(~is_open, F.array("old"))
        .when(F.col("new").isNull(), F.array(gone))
        .when(same, F.array("old"))
        .otherwise(F.array(closed, F.col("new")))
    )
    return old.join(new, match, "full_outer").select(F.inline(rows)).select(*cols)
