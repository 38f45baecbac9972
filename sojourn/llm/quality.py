"""Host-level quality rules: failures by host, shrunk by a beta prior fitted to all hosts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import RangeHash, arrow_map, carried, slices, unpacked, word_bounds

#: Hard rules: words at least; share of words in repeated 3-word windows at most, percent.
MIN_WORDS, MAX_REPEAT = 50, 50
#: Soft rules, percent: symbols per word, repeated lines per line with a word, words in repeated windows.
MAX_SYMBOLS, MAX_DUP_LINES, SOFT_REPEAT = 30, 30, 25
#: Soft rules: characters per word, percent.
WORD_CHARS = (200, 2000)
#: From this shrunk failure rate of its host on, one soft failure rejects a document; else two do.
HOST_RATE = 0.05

METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
_IS_SYMBOL = np.isin(np.arange(256), [*b"#*$%&|<>"])


def _measure(text: str | None, hasher: RangeHash) -> tuple[int, ...]:
    """The METRICS of a text."""
    data = (text or "").encode("utf-8", "surrogatepass")
    raw = np.frombuffer(data, dtype=np.uint8)
    symbols = int(_IS_SYMBOL[raw].sum())
    words = data.split()
    if not words:
        return 0, 0, symbols, 0, 0, 0
    joined = b" ".join(words)
    starts, ends = word_bounds(joined)
    repeated = 0
    if len(words) > 3:
        window = hasher.of(joined, starts[:-2], ends[2:])
        order = np.argsort(window)
        equal = np.diff(window[order]) == 0
        again = order[np.append(equal, False) | np.append(False, equal)]
        covered = np.zeros(len(words), dtype=bool)
        for step in range(3):
            covered[again + step] = True
        repeated = int(covered.sum())
    lines = [x for x in data.split(b"\n") if x.strip()]
    bytes_ = np.frombuffer(joined, dtype=np.uint8)
    chars = int(((bytes_ & 0xC0) != 0x80).sum()) - (len(words) - 1)
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated, len(lines)


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the METRICS of its text appended; columns of these names are replaced."""
    kept = docs.drop(*METRICS)

    def run(batches):
        hasher = RangeHash()
        for batch in slices(batches):
            rows = [_measure(t, hasher) for t in batch["text"].to_pylist()]
            added = [pa.array(c, type=pa.int64()) for c in zip(*rows)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, *METRICS])

    return arrow_map(kept, run, StructType([*kept.schema, *(StructField(c, LongType()) for c in METRICS)]))


def base_failed() -> Column:
    return F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT} * n_words")


def soft_failures() -> Column:
    """How many soft rules a document fails."""
    rules = [
        f"100 * n_symbols > {MAX_SYMBOLS} * n_words",
        f"100 * n_dup_lines > {MAX_DUP_LINES} * n_lines",
        f"100 * n_repeat_words > {SOFT_REPEAT} * n_words",
        f"100 * word_chars < {WORD_CHARS[0]} * n_words OR 100 * word_chars > {WORD_CHARS[1]} * n_words",
    ]
    return F.expr(" + ".join(f"CAST({r} AS INT)" for r in rules))


def host_rates(metrics: DataFrame, host: str = "source") -> DataFrame:
    """(host, n, failed, rate): each host's failure rate, shrunk towards the rate of all hosts.

    A document fails if it fails any rule. The prior Beta(a, b) has the mean and the variance of
    the hosts' rates (method of moments, each host one observation, its sampling variance taken
    off); hosts with few documents stay near the mean. Without variance left the mean holds alone.
    """
    failed = (base_failed() | (soft_failures() > 0)).cast("long")
    hosts = metrics.groupBy(F.col(host).alias("host")).agg(F.count("*").alias("n"), F.sum(failed).alias("failed"))
    prior = hosts.agg(
        (F.sum("failed") / F.sum("n")).alias("mean"),
        F.count("*").alias("hosts"),
        F.sum(F.expr("failed * 1D / n")).alias("s1"),
        F.sum(F.expr("(failed * 1D / n) * (failed * 1D / n)")).alias("s2"),
        F.sum(F.expr("1D / n")).alias("inverse"),
    ).selectExpr(
        "mean",
        "greatest(s2 / hosts - (s1 / hosts) * (s1 / hosts) - mean * (1 - mean) * inverse / hosts, 0D) AS spread",
    )
    # One row joins every host: the strength of the prior in documents, null where hosts do not differ.
    prior = prior.selectExpr("mean", "greatest(mean * (1 - mean) / nullif(spread, 0D) - 1, 1D) AS strength")
    return hosts.join(F.broadcast(prior)).selectExpr(
        "host",
        "n",
        "failed",
        "coalesce((failed + mean * strength) / (n + strength), mean) AS rate",
    )


def judged(metrics: DataFrame, hosts: DataFrame, host: str = "source", limit: float = HOST_RATE) -> DataFrame:
    """``metrics`` with base_failed, host_rate and kept appended.

    A document that fails a hard rule goes. One that fails soft rules goes if its host is suspect
    (its shrunk rate is at least ``limit``) or if it fails two of them. One that fails none stays,
    whatever its host. Null hosts are one host. Null text counts as no words and goes.
    """
    verdict = hosts.select(F.col("host").alias("_host"), F.col("rate").alias("_rate"))
    soft = soft_failures()
    columns = [F.col(c) for c in metrics.columns if c not in ("base_failed", "host_rate", "kept")]
    return metrics.join(verdict, F.col(host).eqNullSafe(F.col("_host")), "left").select(
        *columns,
        base_failed().alias("base_failed"),
        F.col("_rate").alias("host_rate"),
        (~base_failed() & (soft < F.when(F.col("_rate") >= limit, 1).otherwise(2))).alias("kept"),
    )


def good(docs: DataFrame, host: str = "source") -> DataFrame:
    """The rows of ``docs`` that are kept, columns as they are; metrics are taken twice, not stored.

    Rows with null text go, null hosts are one host, and equal rows are judged alike. Columns may have
    any names and types. No rows give no rows.
    """
    metrics = measured(carried(docs, host, "text"))
    hosts = host_rates(measured(docs.select(host, "text")), host)
    return judged(metrics, hosts, host).where("kept").select(unpacked(docs.columns, host, "text"))
