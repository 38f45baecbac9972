"""Rows a table does not hold yet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unseen(staged: DataFrame, existing: DataFrame, key: str, null_keys: bool = True,
           distinct: bool = False) -> DataFrame:
    """Staged rows whose key is not in ``existing``.

    A NULL key equals nothing: such rows are all new, or with ``null_keys=False`` never.
    Many of them would meet in one task of the join, so they carry a salt into it; with
    ``distinct`` the caller says that no key repeats, and the join can use the distribution
    that an earlier step by the same key left behind.
    """
    if not null_keys:
        staged = staged.filter(F.col(key).isNotNull())
    if distinct or not null_keys:
        return staged.join(existing.select(key), key, "left_anti").select(*staged.columns)
    spread = F.pmod(F.xxhash64(*staged.columns), F.lit(4096)) + 1
    salted = staged.withColumn("__salt", F.when(F.col(key).isNull(), spread).otherwise(0))
    held = existing.select(key, F.lit(0).cast("bigint").alias("__salt"))
    return salted.join(held, [key, "__salt"], "left_anti").select(*staged.columns)
