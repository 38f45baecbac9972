"""Helpers shared by the operators: reading, staging, batches, word bytes and 64-bit hashes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sojourn.session import configure

#: Words of ``[^\x20\x09-\x0D]+``, as a Java pattern for native expressions.
SPACED_WORD = r"[^\x20\x09-\x0D]+"
#: Rows that a Python task holds as objects at a time.
SLICE_ROWS = 256

_U = np.uint64
_own_folder: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a given table."""
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet").select(*columns or "*")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``; in local mode a temporary one if unset."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors see")
    if not _own_folder:
        _own_folder.append("file://" + tempfile.mkdtemp(prefix="stage-"))
    return _own_folder[0]


def stage(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later steps neither repeat nor lose its work."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a side that is joined by a sort at every size: what it takes grows evenly with the input."""
    return df.hint("merge")


def arrow_map(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``fn(iterator of record batches)`` over the partitions of ``df``."""
    return df.mapInArrow(fn, schema)


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of a few rows, so that few texts are Python objects at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, type=f.type)
            for c, f in zip(columns, schema)
        ],
        schema=schema,
    )


def carried(df: DataFrame, *needed: str) -> DataFrame:
    """``needed`` columns as they are, and all others in one column ``_row``, whatever their names."""
    others = [named(c) for c in df.columns if c not in needed]
    row = F.struct(*others) if others else F.lit(None).cast("struct<_: int>")
    return df.select(*[c for c in df.columns if c in needed], row.alias("_row"))


def unpacked(columns: list[str], *needed: str) -> list[Column]:
    """The ``columns`` of a frame that was ``carried``, in their order."""
    return [named(c) if c in needed else F.col("_row").getField(c).alias(c) for c in columns]


def named(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def word_count(text: Column) -> Column:
    """Number of words of ``[^\\x20\\x09-\\x0D]+``; null counts 0. No array of words is built."""
    squeezed = F.regexp_replace(F.coalesce(text, F.lit("")), SPACED_WORD, "w")
    return F.length(F.regexp_replace(squeezed, "[^w]+", "")).cast("long")


def spaced_words(text: str | None) -> list[bytes]:
    """Words of ``[^\\x20\\x09-\\x0D]+`` as UTF-8, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


# --- hashes ------------------------------------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64) of unsigned integers."""
    x = x + _U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class RangeHash:
    """Polynomial hashes of any byte ranges of a text, from one running sum."""

    BASE = 0x5851F42D4C957F2D

    def __init__(self) -> None:
        self.values = mix(np.arange(256, dtype=np.uint64))
        self.up = np.ones(1, dtype=np.uint64)
        self.down = np.ones(1, dtype=np.uint64)

    def _grow(self, n: int) -> None:
        if n > len(self.up):
            size = 1 << n.bit_length()
            for name, base in (("up", self.BASE), ("down", pow(self.BASE, -1, 1 << 64))):
                powers = np.full(size, base, dtype=np.uint64)
                powers[0] = 1
                setattr(self, name, np.multiply.accumulate(powers))

    def of(self, data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        self._grow(len(data) + 1)
        raw = np.frombuffer(data, dtype=np.uint8)
        total = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum(self.values[raw] * self.up[: len(raw)], out=total[1:])
        return mix((total[ends] - total[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def word_bounds(joined: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a text whose words are joined by single spaces."""
    gaps = np.flatnonzero(np.frombuffer(joined, dtype=np.uint8) == 32)
    return np.append(0, gaps + 1), np.append(gaps, len(joined))


def shingles(words: list[bytes], size: int, hasher: RangeHash) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words; fewer words make one run."""
    if not words:
        return np.empty(0, dtype=np.uint64)
    data = b" ".join(words)
    starts, ends = word_bounds(data)
    size = min(size, len(words))
    found = np.sort(hasher.of(data, starts[: len(words) - size + 1], ends[size - 1 :]))
    return found[np.append(True, found[1:] != found[:-1])]
