"""Connected components of a table of links, by rounds of least labels and label look-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch, written


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, label)`` for every node of ``links``; nodes share a label when links join them.

    Each round gives a node the least label among itself and its neighbours and then the label of
    that label, so paths shorten by more than half; each round is written, so a lost executor
    repeats one round at most. Labels are node ids; null ends are ignored.
    """
    with scratch() as keep:
        return keep(_components(links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")))


def _components(known: DataFrame) -> DataFrame:
    both = written(known.union(known.select("b", "a")).distinct().toDF("node", "other"), "links")
    labels = written(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("other"), F.col("label").alias("near")), "other") \
            .groupBy("node").agg(F.min("near").alias("near"))
        step = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        moved = written(step.join(jump, "next", "left").select(
            "node", F.col("label").alias("old"), F.least("next", F.coalesce("far", "next")).alias("label")), "labels")
        same = moved.filter("old <> label").isEmpty()
        labels = moved.select("node", "label")
        labels.scratch = moved.scratch
        if same:
            return labels
