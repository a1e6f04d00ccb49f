"""Operators on weighted graphs and on vectors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from convograph import workers
from convograph.operators.tiles import nearest


def pairs_within(rows: DataFrame, group: str, item: str) -> DataFrame:
    """(src, dst, weight): unordered pairs of items and how many groups hold both."""
    g = rows.groupBy(group).agg(F.array_sort(F.collect_set(item)).alias("_e")).where("size(_e) > 1")
    return g.select(F.posexplode("_e").alias("_i", "src"), "_e").select("src", F.explode(F.slice("_e", F.col("_i") + 2, F.size("_e"))).alias("dst")).groupBy("src", "dst").agg(F.count("*").alias("weight"))


def degrees(edges: DataFrame) -> DataFrame:
    """(node, degree, strength) of an undirected edge table."""
    both = edges.select(F.col("src").alias("node"), "weight").unionByName(edges.select(F.col("dst").alias("node"), "weight"))
    return both.groupBy("node").agg(F.count("*").alias("degree"), F.sum("weight").alias("strength"))


def peripheral(edges: DataFrame, mention_counts: DataFrame, top: int = 20) -> DataFrame:
    """Concepts of few links that are mentioned at least twice; potential = 0.3 degree + 0.7 mentions."""
    d = degrees(edges).join(mention_counts, "node").where("degree > 0 and degree < 3 and mentions >= 2")
    return d.withColumn("potential", F.col("degree") * 0.3 + F.col("mentions") * 0.7).orderBy(F.desc("potential"), "node").limit(top)


def modularity(edges: DataFrame, communities: DataFrame, resolution: float = 1.0) -> DataFrame:
    """Weighted modularity of an assignment (node, community)."""
    m = edges.agg(F.sum("weight").cast("double").alias("m"))
    c = communities
    inside = edges.join(c.select(F.col("node").alias("src"), F.col("community").alias("a")), "src").join(c.select(F.col("node").alias("dst"), F.col("community").alias("b")), "dst").where("a = b").groupBy(F.col("a").alias("community")).agg(F.sum("weight").alias("l"))
    total = degrees(edges).join(c, "node").groupBy("community").agg(F.sum("strength").alias("d"))
    q = total.join(inside, "community", "left").join(F.broadcast(m))
    return q.agg(F.sum(F.coalesce("l", F.lit(0)) / F.col("m") - resolution * F.pow(F.col("d") / (2 * F.col("m")), F.lit(2.0))).alias("modularity"))


def _unlinked(names: DataFrame, linked: DataFrame, top: int) -> DataFrame:
    """The first ``top`` pairs (a, b), a < b, of ``names`` that ``linked`` does not have, in order.

    The first names are paired with all later ones until there are enough pairs.  Names that yield none are linked with all later ones, so
    this takes as many rows as there are links, and ``top`` times the names."""
    found, after, block = [], None, top
    while True:
        rest = names if after is None else names.where(F.col("community") > after)
        first = [r.community for r in rest.orderBy("community").limit(block).collect()]  # bounded: a block of names
        if not first:
            break
        pairs = names.select(F.explode(F.array(*map(F.lit, first))).alias("a"), F.col("community").alias("b")).where("a < b")
        found.append(pairs.join(linked, ["a", "b"], "left_anti").orderBy("a", "b").limit(top).checkpoint())
        if sum(f.count() for f in found) >= top:
            break
        after, block = first[-1], 2 * block
    return reduce(DataFrame.unionByName, found).orderBy("a", "b").limit(top) if found else linked.select("a", "b").limit(0)


def gaps(edges: DataFrame, communities: DataFrame, few: int = 3, top: int = 10) -> DataFrame:
    """The ``top`` pairs of communities with the fewest edges between them, of those with less than ``few``; pairs of communities are not listed for it."""
    workers.checkpoints(edges.sparkSession)
    c = communities
    cross = edges.join(c.select(F.col("node").alias("src"), F.col("community").alias("x")), "src").join(c.select(F.col("node").alias("dst"), F.col("community").alias("y")), "dst").where("x <> y").groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(F.count("*").alias("connections")).checkpoint()
    # three representatives of each, ranked before they are gathered
    first = c.withColumn("_rn", F.row_number().over(W.partitionBy("community").orderBy("node"))).where(F.col("_rn") <= 3).groupBy("community").agg(F.array_sort(F.collect_list("node")).alias("members"))
    size = c.groupBy("community").agg(F.count("*").alias("size")).checkpoint()
    none = _unlinked(size.select("community"), cross.select("a", "b"), top).withColumn("connections", F.lit(0).cast("long"))
    found = cross.where(F.col("connections") < few).unionByName(none).orderBy("connections", "a", "b").limit(top)
    known = size.join(first, "community")
    for end in ("a", "b"):
        found = found.join(known.select(F.col("community").alias(end), F.col("size").alias(f"size_{end}"), F.col("members").alias(f"members_{end}")), end)
    found = found.select(F.col("a").alias("community_a"), F.col("b").alias("community_b"), "connections", (1 - F.col("connections") / few).alias("gap_score"), "size_a", "size_b", "members_a", "members_b")
    return found.orderBy("connections", "community_a", "community_b")


def gap_evolution(now: DataFrame, before: DataFrame, step: float = 0.1) -> DataFrame:
    """State of each gap (key, score) against an earlier run: new, bridged, widened or stable."""
    j = now.select("key", F.col("score").alias("now")).join(before.select("key", F.col("score").alias("then")), "key", "full_outer")
    return j.withColumn("state", F.when(F.col("then").isNull(), "new").when(F.col("now").isNull(), "bridged").when(F.col("now") > F.col("then") + step, "widened").otherwise("stable"))


def distances(edges: DataFrame, source: Column | int | str, most: int = 10) -> DataFrame:
    """(node, hops) from a source over undirected edges, breadth first; each hop is one join with the last frontier only.

    Nodes that are more than ``most`` hops away are left out."""
    workers.checkpoints(edges.sparkSession)
    both = edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    front = both.select(F.col("src").alias("node")).where(F.col("node") == source).distinct()
    seen = front.withColumn("hops", F.lit(0)).checkpoint()
    front = seen.select("node")
    for hop in range(1, most + 1):
        step = front.join(both, front["node"] == both["src"]).select(F.col("dst").alias("node")).distinct().join(seen, "node", "left_anti").checkpoint()
        if step.isEmpty():
            break
        seen, front = seen.unionByName(step.withColumn("hops", F.lit(hop))), step
    return seen


# ---- vectors

def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Zero if a norm is zero."""
    m = norm(a) * norm(b)
    return F.when(m > 0, dot(a, b) / m).otherwise(F.lit(0.0))


def centroids(vectors: DataFrame, group: str, vector: str = "embedding") -> DataFrame:
    """(group, centroid, size): means by dimension, pre-aggregated before the shuffle."""
    d = vectors.select(group, F.posexplode(vector).alias("_d", "_x")).groupBy(group, "_d").agg(F.avg(F.col("_x").cast("double")).alias("_m"), F.count("*").alias("_n"))
    return d.groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct("_d", "_m"))), lambda s: s["_m"]).alias("centroid"), F.max("_n").alias("size"))


def most_similar(queries: DataFrame, vectors: DataFrame, top: int = 5, least: float = -1.0) -> DataFrame:
    """(query, id, similarity, rank): best of (id, v) for each (query, q), itself left out; ties go to the smaller id.

    Queries and vectors meet as products of bounded matrices (``tiles``)."""
    return nearest(queries, vectors, top, least)
