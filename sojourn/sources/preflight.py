"""Checks on source files before anything is written. An issue is one line of text."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import EVENT_SCHEMA, record_chunks, record_text, with_position


class SourceRejected(ValueError):
    """A source failed its pre-flight checks; nothing was written."""


def gate(path: str, issues: list[str]) -> None:
    if issues:
        raise SourceRejected(f"{path} failed pre-flight checks: " + "; ".join(issues))


def encoding_issues(spark: SparkSession, path: str) -> list[str]:
    """Lines that are not valid UTF-8."""
    bad = spark.read.text(path).filter(~F.is_valid_utf8("value")).count()
    return [f"[encoding] {path}: {bad} line(s) are not UTF-8"] if bad else []


def _missing(spark: SparkSession, path: str) -> list[str]:
    try:
        spark.read.text(path)
        return []
    except AnalysisException:
        return [f"[file] {path}: not found"]


def csv_issues(spark: SparkSession, path: str, required: set[str]) -> list[str]:
    issues = _missing(spark, path) or encoding_issues(spark, path)
    if issues:
        return issues
    lines = spark.read.text(path)
    quotes = F.length(F.regexp_replace("value", '[^"]', ""))
    # A file's first line is its header: one row per file, then one row.
    first = with_position(lines).groupBy("pos.file").agg(F.min_by("value", "pos").alias("header"))
    headers = first.agg(F.count_distinct("header").alias("n")).first().n
    if headers > 1:
        issues.append(f"[file] {path}: files with {headers} different headers")
    torn = lines.filter(quotes % 2 == 1).count()
    if torn:
        issues.append(f"[file] {path}: {torn} line(s) with an unbalanced quote; fields must not span lines")
    df = spark.read.csv(path, header=True, escape='"')
    absent = sorted(set(required) - set(df.columns))
    if absent:
        issues.append(f"[file] {path}: missing columns {absent}")
    if df.isEmpty():
        issues.append(f"[file] {path}: no data rows")
    return issues


def json_report(spark: SparkSession, path: str) -> tuple[list[str], str]:
    """Issues of an event file, and the layout to read it with.

    The block-wise reading splits at closing braces. A split inside a text value always
    leaves a piece that does not parse, so a file without such pieces is read correctly. Other
    files are read by lines if every line is an object; what is left is parsed as a whole
    before it is called broken.
    """
    issues = _missing(spark, path)
    if issues:
        return issues, "records"
    raw = F.col("value")
    chunk = F.regexp_replace(raw, r"^\s+|\s+$", "")
    kind = (
        F.when(chunk == "", "blank")
        .when(chunk == "]", "close")
        .when(chunk.rlike(r"^\[\s*\]$"), "empty")
        .when(chunk.rlike(r"^\[\s*\{"), "open")
        .when(chunk.rlike(r"^,\s*\{"), "next")
        .when(chunk.rlike(r"^\{"), "line")
    )
    parsed = F.from_json(
        record_text(raw),
        EVENT_SCHEMA + ", bad string",
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad"},
    )
    pieces = with_position(record_chunks(spark, path)).select(
        kind.alias("kind"),
        (raw.contains("{") & parsed["bad"].isNotNull()).alias("broken"),
        chunk.startswith("[").alias("bracket"),
        (~F.is_valid_utf8(raw)).alias("bad_text"),
        "pos",
    )
    # One row per file, then one row: how many files have a sound structure of either form.
    per_file = pieces.groupBy("pos.file").agg(
        F.min_by("bracket", "pos").alias("is_array"),
        F.count_if("bad_text").alias("bad_text"),
        *[
            F.count_if(F.col("kind") == k).alias(k)
            for k in ("open", "close", "next", "line", "empty")
        ],
        F.count_if(F.col("kind").isNull() | F.col("broken")).alias("odd"),
    )
    records = F.col("open") + F.col("next") + F.col("line")
    array = (F.col("open") == 1) & (F.col("close") == 1) & (F.col("line") == 0)
    lines = (F.col("line") > 0) & (F.col("open") + F.col("close") + F.col("next") == 0)
    empty = (F.col("empty") == 1) & (records + F.col("close") == 0)
    found = per_file.agg(
        F.sum(records).alias("records"),
        F.count_if((F.col("odd") > 0) | ~(array | lines | empty)).alias("odd_files"),
        F.count_if(~F.col("is_array")).alias("other_files"),
        F.sum("bad_text").alias("bad_text"),
    ).first()
    if found.bad_text:
        return [f"[encoding] {path}: {found.bad_text} record(s) are not UTF-8"], "records"
    if not found.odd_files:
        if found.records:
            return [], "records"
        return [f"[file] {path}: empty JSON array"], "records"
    if _all_lines_are_objects(spark, path):
        return [], "lines"
    whole = (
        spark.read.schema(EVENT_SCHEMA + ", bad string")
        .option("columnNameOfCorruptRecord", "bad")
        .json(path, multiLine=True)
    )
    # Spark wants a parsed column next to the corrupt-record one.
    size = whole.agg(
        F.count_if(F.col("bad").isNotNull()).alias("bad"),
        F.sum(F.length(F.coalesce("event_id", F.lit(""))) + 1).alias("content"),
    ).first()
    if size.bad:
        issues.append(f"[file] {path}: not valid JSON")
    elif found.other_files:
        issues.append(f"[file] {path}: must be a JSON array")
    elif not size.content:
        issues.append(f"[file] {path}: empty JSON array")
    return issues, "array"


def _all_lines_are_objects(spark: SparkSession, path: str) -> bool:
    """Whether every line that is not blank is a JSON object of its own."""
    line = F.regexp_replace("value", r"^\s+|\s+$", "")
    parsed = F.from_json(
        line, EVENT_SCHEMA + ", bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad"}
    )
    rows = spark.read.text(path).select(line.alias("line"), parsed["bad"].isNull().alias("sound"))
    odd = F.col("line").rlike(r"^[^{]") | ~F.col("sound")
    seen = rows.filter("line <> ''").agg(F.count("*").alias("n"), F.count_if(odd).alias("odd")).first()
    return bool(seen.n) and not seen.odd


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """``total_rows`` and ``duplicate_rows``; a missing key counts as the empty text."""
    k = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return df.agg(
        F.count("*").alias("total_rows"),
        (F.count("*") - F.count_distinct(k)).alias("duplicate_rows"),
    )
