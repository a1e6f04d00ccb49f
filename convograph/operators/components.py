"""Connected components of an undirected edge table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convograph import workers

#: Edges of a task, and tasks that even a small table is dealt over.
ROWS, LEAST = 50_000, 8


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of a proper edge; component is the least node reachable.

    Each round hangs larger neighbours on the least neighbour (large star), then smaller ones
    (small star); the number of rounds grows with the logarithm of the longest chain.  Minima are
    pre-aggregated before the shuffle, no group is gathered, and each round is checkpointed, so lost executors
    cost one round.  Before each shuffle a table has a task for every ``ROWS`` edges, whatever the number of shuffle partitions: tasks, files
    and messages of a round follow the edges.  Self-loops, repeated edges and nulls add no nodes."""
    workers.checkpoints(edges.sparkSession)
    a, b = F.col("a"), F.col("b")
    now = edges.select(F.greatest(src, dst).alias("a"), F.least(src, dst).alias("b")).where(F.col(src).isNotNull() & F.col(dst).isNotNull() & (a != b)).distinct().checkpoint()
    mark, tasks = None, _tasks(now.count())
    now = now.coalesce(tasks)
    for _ in range(max_rounds):
        both = now.unionByName(now.select(b.alias("a"), a.alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.where(b > a).join(least, "a").select(b.alias("a"), F.col("m").alias("b")).coalesce(tasks).distinct().coalesce(tasks)
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(small, "a").where(b != F.col("m")).select(b.alias("a"), F.col("m").alias("b"))
        now = moved.unionByName(small.select("a", F.col("m").alias("b"))).coalesce(tasks).distinct().coalesce(tasks).checkpoint()
        seen = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if seen == mark:
            break
        mark, tasks = seen, _tasks(seen[0])
    else:
        raise RuntimeError(f"no fixpoint after {max_rounds} rounds")
    roots = now.select(b.alias("a")).distinct().coalesce(tasks)
    return now.select(a.alias("node"), b.alias("component")).unionByName(roots.select(a.alias("node"), a.alias("component")))


def _tasks(edges: int) -> int:
    return max(LEAST, -(-edges // ROWS))
