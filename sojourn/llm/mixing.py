"""Mixing sources to target weights along a time-varying curriculum, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import carried, named, stage, unpacked, word_count

#: The columns that are read; all others are carried.
_READ = ("doc_id", "text", "source")

#: Weights of the sources in order, repeating; the mix's words, percent of all; uses of a source at most.
WEIGHTS, SHARE, MOST = (5, 2, 1), 150, 2
#: The schedule of each source's weight over training time 0..1, in the same order: start and end.
SCHEDULES = ((1.0, 1.0), (1.5, 0.5), (0.5, 1.5))
#: Pieces a source is cut into for running sums; a piece is what one task sums in order.
PIECES = 256


def targets(
    sizes: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    schedules: tuple[tuple[float, float], ...] = SCHEDULES,
    share: int = SHARE,
    most: int = MOST,
) -> DataFrame:
    """(source, source_size, target, w0, w1) for ``sizes`` (source, size).

    Sources in order of code points, null last, take the weights in turn. What a source's target
    exceeds ``most`` times its size is shared by weight among the others until none exceeds: one
    round caps all sources that exceed, so there are few rounds, each one total of one row.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turn = F.row_number().over(order) - 1

    def pick(values) -> Column:
        listed = F.array(*map(F.lit, values))
        return F.element_at(listed, (turn % len(values) + 1).cast("int"))

    sources = stage(
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .select(
            "source",
            "source_size",
            pick([float(w) for w in weights]).alias("weight"),
            pick([float(a) for a, _ in schedules]).alias("w0"),
            pick([float(b) for _, b in schedules]).alias("w1"),
        ),
        "sources",
    )
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("n")).first().n * share / 100
    rate = None
    while True:
        full = F.lit(False) if rate is None else F.lit(rate) * F.col("weight") >= most * F.col("source_size")
        now = sources.agg(
            F.coalesce(F.sum(F.when(full, most * F.col("source_size"))), F.lit(0)).alias("taken"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("weight"),
        ).first()
        left = (total - now.taken) / now.weight if now.weight else rate
        if left == rate or not now.weight:
            rate = left or 0.0
            break
        rate = left
    target = F.least(F.lit(rate) * F.col("weight"), (most * F.col("source_size")).cast("double"))
    return sources.select("source", "source_size", target.alias("target"), "w0", "w1")


def mixed(docs: DataFrame, pieces: int = PIECES, **settings) -> DataFrame:
    """``docs`` (doc_id, text, source) with size, source_size, target, taken and position appended.

    A source's documents stand in the order of their ids' hashes. With a target of q whole passes
    over the source and a rest, every document is taken q times, and once more those before the
    rest is reached; so a source's words miss its target by less than one document. ``position``
    (array, one entry for each time a document is taken) is where in training, 0 to 1, it is due:
    the source's cumulative demand, the integral of its schedule, is inverted at the words taken
    before the document's middle. Columns of the appended names are replaced.

    Null text counts 0 words; documents without words are taken 0 words, with positions like others.
    Null sources are one source, the last. Null ids hash alike; equal rows stand next to each
    other. No rows give no rows.
    """
    made = ("size", "source_size", "target", "taken", "position", "times")
    columns = [c for c in docs.columns if c not in made]
    kept = carried(docs.select(*map(named, columns)), *_READ)
    sized = kept.withColumn("size", word_count(F.col("text"))).withColumn(
        "_order", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    )
    sized = sized.withColumn("_piece", F.conv(F.substring("_order", 1, 4), 16, 10).cast("int") % pieces)
    narrow = sized.select("source", "size", "_piece")
    parts = stage(narrow.groupBy("source", "_piece").agg(F.sum("size").alias("size")), "mix-pieces")
    # At most ``pieces`` rows a source stand in one window here.
    before = F.coalesce(
        F.sum("size").over(
            Window.partitionBy("source").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
        ),
        F.lit(0),
    )
    plan = parts.join(
        targets(parts.select("source", "size"), **settings).withColumnRenamed("source", "_s"),
        F.col("source").eqNullSafe(F.col("_s")),
    )
    plan = stage(
        plan.withColumn("before", before).select(
            F.col("source").alias("_s"),
            F.col("_piece").alias("_p"),
            "before",
            "source_size",
            "target",
            "w0",
            "w1",
        ),
        "mix-plan",
    )
    inside = Window.partitionBy("source", "_piece").orderBy("_order", "doc_id", "size")
    running = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size")
    placed = (
        sized.withColumn("_in", running)
        .join(plan, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_piece") == F.col("_p")))
        .withColumn("_before", F.col("before") + F.col("_in"))
    )
    passes = F.floor(F.coalesce(F.col("target") / F.expr("nullif(source_size, 0)"), F.lit(0.0)))
    rest = F.col("target") - passes * F.col("source_size")
    placed = placed.withColumn(
        "times", (passes + F.when(F.col("_before") < rest, 1).otherwise(0)).cast("int")
    )
    middle = "(_before + size / 2D + pass * source_size) / nullif(target, 0D)"
    # Demand up to t is (w0 t + (w1 - w0) t^2 / 2) / ((w0 + w1) / 2); its inverse, free of cancellation.
    due = f"least(1D, coalesce(({middle}) * (w0 + w1) / (w0 + sqrt(greatest(w0 * w0 + (w1 - w0) * (w0 + w1) * ({middle}), 0D))), 0D))"
    return placed.select(
        *kept.columns,
        "size",
        "source_size",
        "target",
        (F.col("times") * F.col("size")).alias("taken"),
        F.expr(f"transform(sequence(0, times), pass -> {due})").alias("_all"),
        "times",
    ).select(
        *unpacked(columns, *_READ),
        "size",
        "source_size",
        "target",
        "taken",
        F.expr("slice(_all, 1, times)").alias("position"),
    )


def curriculum(docs: DataFrame, **settings) -> DataFrame:
    """The training order: each document once for each time it is taken, columns as they are, range-sorted.

    Documents without words, null texts among them, are not lost: they come as often as their place says.
    Equal rows stand together; null ids come first among equals. Columns may have any names and types.
    No rows give no rows.
    """
    own = carried(docs, *_READ)
    due = mixed(own, **settings).select(*own.columns, F.explode("position").alias("_due"))
    due = due.repartitionByRange("_due", "doc_id").sortWithinPartitions("_due", "doc_id")
    return due.select(unpacked(docs.columns, *_READ))


def places(docs: DataFrame, **settings) -> DataFrame:
    """``mixed`` rows (doc_id, size, source_size, target, taken, position), range-sorted by first position.

    Null ``doc_id`` sort first among equals; documents that are not taken have no position and stand last.
    """
    rows = mixed(docs, **settings).select("doc_id", "size", "source_size", "target", "taken", "position")
    rows = stage(rows.withColumn("_due", F.try_element_at("position", F.lit(1))), "mix-places")
    order = [F.col("_due").asc_nulls_last(), F.col("doc_id")]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("_due")
