"""Warehouse tables in the session's catalog, written one batch at a time.

Every table is partitioned by ``batch``. A batch becomes visible when Spark registers its
finished partition; what a lost job left behind before that is overwritten by the next one.
So a job that was lost is simply run again, and one that was not adds nothing.
"""

from __future__ import annotations

import time
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.append import unseen
from ..session import shared_dir


class Warehouse:
    def __init__(self, spark: SparkSession, database: str = "lifecycle",
                 location: str | None = None):
        """``location`` is where a new database keeps its tables: storage all executors see.

        Without it, the shared folder the cluster names, else the catalog's own place.
        """
        self.spark, self.database = spark, database
        shared = shared_dir(spark)
        if location is None and shared:
            location = f"{shared.rstrip('/')}/{database}"
        if location is None and not spark.sparkContext.master.startswith("local"):
            raise ValueError("name a location, or set spark.checkpoint.dir: all executors must see the tables")
        where = " LOCATION '" + location.replace("\\", "\\\\").replace("'", "\\'") + "'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def warn_if_exists(self, table: str) -> list[str]:
        return [f"{self.name(table)} already exists and will be replaced"] * self.exists(table)

    def read(self, table: str, with_batch: bool = False) -> DataFrame:
        """All batches of an append table."""
        df = self.spark.table(self.name(table))
        return df if with_batch else df.drop("batch")

    def batches(self, table: str) -> list[int]:
        """Batches of a table, from the catalog alone."""
        if not self.exists(table):
            return []
        rows = self.spark.sql(f"SHOW PARTITIONS {self.name(table)}").collect()
        return sorted(int(r[0].split("=")[1]) for r in rows)

    def latest(self, table: str) -> DataFrame:
        """The newest batch, which is the content of a replaced table."""
        df = self.spark.table(self.name(table))
        newest = self.batches(table)
        if newest:
            df = df.filter(F.col("batch") == newest[-1])
        return df.drop("batch")

    def _write(self, df: DataFrame, table: str, batch: int, overwrite: bool) -> int:
        seen = Observation()
        rows = df.withColumn("batch", F.lit(batch)).observe(seen, F.count("*").alias("n"))
        if self.exists(table):
            # By name: a source may list its columns in another order.
            target = self.spark.table(self.name(table)).columns
            rows.select(*target).write.insertInto(self.name(table), overwrite=overwrite)
        else:
            rows.write.partitionBy("batch").format("parquet").saveAsTable(self.name(table))
        n = seen.get["n"]
        if not n:  # a batch without rows is a batch too
            self.spark.sql(
                f"ALTER TABLE {self.name(table)} ADD IF NOT EXISTS PARTITION (batch = {batch})"
            )
        return n

    def append_new(self, staged: DataFrame, table: str, key: str, null_keys: bool = True,
                   batch: int | None = None, within: Column | None = None) -> int:
        """Add staged rows whose key the table does not hold; return how many.

        ``staged`` holds each key once where ``null_keys`` are kept. The first load takes
        every row. Stored rows never change, also not when a batch is repeated.

        ``within`` is a range that all new rows lie in, over a column their key determines:
        stored rows outside need not be read to find out what is new.
        """
        batch = new_batch() if batch is None else batch
        stored = self.batches(table)
        if stored and not self.read(table).isEmpty():
            held = self.read(table)
            if within is not None:
                staged, held = staged.filter(within), held.filter(within)
            staged = unseen(staged, held, key, null_keys, distinct=True)
        return self._write(staged, table, batch, overwrite=batch not in stored)

    def replace(self, df: DataFrame, table: str, batch: int | None = None) -> int:
        """Make ``df`` the table's content; ``df`` may read the table itself.

        The previous content stays until the next replacement, for readers under way.
        """
        batch = new_batch() if batch is None else batch
        before = [b for b in self.batches(table) if b != batch]
        rows = self._write(df, table, batch, overwrite=True)
        for old in before[:-1]:
            self.spark.sql(f"ALTER TABLE {self.name(table)} DROP PARTITION (batch = {old})")
        return rows

    def reset(self, tables: list[str], mode: str = "drop") -> list[str]:
        """``drop`` the tables, or ``empty`` them and keep their schema; return those found."""
        if mode not in ("drop", "empty"):
            raise ValueError(f"unknown mode {mode!r}")
        found = [t for t in tables if self.exists(t)]
        for t in found:
            verb = "DROP TABLE" if mode == "drop" else "TRUNCATE TABLE"
            self.spark.sql(f"{verb} {self.name(t)}")
        return found


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """``(table, rows)`` for several frames in one job."""
    counts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def new_batch() -> int:
    """A number above all earlier ones."""
    return time.time_ns() // 1000
