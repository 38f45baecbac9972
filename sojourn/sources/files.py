"""Raw readers: every field as text, plus ``pos``, the row's place in the source.

``pos`` orders rows by file, block of the file and place inside the block, so "first in the
file" keeps its meaning when Spark reads the blocks in parallel.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_SCHEMA = (
    "event_id string, user_id string, mentor_id string, timestamp string, event_type string"
)


def with_position(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "pos",
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ),
    )


def _csv(spark: SparkSession, path: str) -> DataFrame:
    # A quote inside a quoted field is doubled.
    return with_position(spark.read.csv(path, header=True, inferSchema=False, escape='"'))


def read_users(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path)


def read_mentors(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path)


def read_events(spark: SparkSession, path: str, layout: str = "records") -> DataFrame:
    """Read events as text fields, numbers in ``user_id`` included.

    ``records``: a JSON array of flat objects or one object per line, read in blocks.
    ``lines``: one object per line, whatever it holds, read in blocks.
    ``array``: any JSON array, one task per file; for text that holds a ``}``.
    """
    if layout == "lines":
        return with_position(spark.read.schema(EVENT_SCHEMA).json(path))
    if layout == "array":
        df = spark.read.schema(EVENT_SCHEMA).json(path, multiLine=True)
        return with_position(df)
    if layout != "records":
        raise ValueError(f"unknown layout {layout!r}")
    chunks = with_position(record_chunks(spark, path))
    fields = F.from_json(record_text(F.col("value")), EVENT_SCHEMA)
    return chunks.filter(F.col("value").contains("{")).select(fields.alias("e"), "pos").select(
        "e.*", "pos"
    )


def record_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The file's text between closing braces: one flat JSON object per row, less its brace."""
    return spark.read.text(path, lineSep="}")


def record_text(chunk):
    """The object inside a chunk: without the array's bracket or comma, with its brace."""
    return F.concat(F.regexp_replace(chunk, r"^\s*[\[,]?\s*", ""), F.lit("}"))
