"""Choices that depend on order (first come, first kept) without a loop over a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convograph.workers import written


def kept_first(rivals: DataFrame) -> DataFrame:
    """(node, kept) of every node of (later, earlier): a node is kept unless one of its earlier rivals is kept, as a loop over nodes in order decides.

    In each round all nodes without an undecided earlier rival are kept and the later rivals of those go, so that rounds are as many as the longest
    chain of decisions that hang on each other, not as nodes; for rivals in no special order that is about the logarithm of their number."""
    live = written(rivals.select("later", "earlier").distinct())
    open_ = written(live.select(F.explode(F.array("later", "earlier")).alias("node")).distinct())
    done = []
    while not open_.isEmpty():
        keep = open_.join(live.select(F.col("later").alias("node")), "node", "left_anti")
        out = live.join(keep.withColumnRenamed("node", "earlier"), "earlier").select(F.col("later").alias("node")).distinct()
        decided = written(keep.withColumn("kept", F.lit(True)).unionByName(out.withColumn("kept", F.lit(False))))
        done.append(decided)
        for end in ("later", "earlier"):
            live = live.join(decided.select(F.col("node").alias(end)), end, "left_anti")
        live, open_ = written(live), written(open_.join(decided, "node", "left_anti"))
    whole = open_.withColumn("kept", F.lit(True))
    for part in done:
        whole = whole.unionByName(part)
    return whole
