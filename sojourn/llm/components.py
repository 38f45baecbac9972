"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every id in ``edges`` (a, b): the smallest id it is connected to.

    Least labels run along the edges and then jump to their label's own label, until nothing
    changes; chains shorten by at least half a round. Labels are written each round. Joins read
    plain tables on both sides, so Spark can split a hot hub or a hot label over tasks.
    """
    both = stage(
        edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).where("a <> b").distinct(), "edges"
    )
    labels = stage(
        both.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("component")), "labels"
    )
    while True:
        heard = (
            both.join(labels, both.b == labels.id)
            .groupBy(both.a.alias("id"))
            .agg(F.min("component").alias("heard"))
        )
        told = stage(
            labels.join(heard, "id", "left").select(
                "id", F.least("component", "heard").alias("label"), F.col("component").alias("old")
            ),
            "told",
        )
        own = told.select(F.col("id").alias("label"), F.col("label").alias("jump"))
        jumped = stage(
            told.join(own, "label").select("id", F.least("label", "jump").alias("component"), "old"), "labels"
        )
        labels = jumped.select("id", "component")
        if jumped.where("component <> old").isEmpty():
            return labels
