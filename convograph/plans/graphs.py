"""Queries over graphs and embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from convograph.operators import graph as G
from convograph.operators import mentions as M
from convograph.operators.centrality import centralities
from convograph.operators.communities import louvain
from convograph.operators.components import connected_components
from convograph.operators.pairs import sums_within, within
from convograph.plans.base import Book, n, r6, table
from convograph.sources.adapters import MENTIONS_SQL, concepts, segments

book = Book()
PAIRS = "li AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem), e AS (SELECT a.l_partkey AS src, b.l_partkey AS dst, count(*) AS weight FROM li a JOIN li b ON a.l_orderkey = b.l_orderkey AND a.l_partkey < b.l_partkey GROUP BY 1, 2)"
COMM = "c AS (SELECT p_partkey AS node, p_brand AS community FROM part)"


def part_edges(spark, sf):
    return G.pairs_within(table(spark, sf, "lineitem").select("l_orderkey", "l_partkey"), "l_orderkey", "l_partkey")


def brands(spark, sf):
    return table(spark, sf, "part").select(F.col("p_partkey").alias("node"), F.col("p_brand").alias("community"))


@book.add(f"WITH {PAIRS} SELECT weight, CAST(count(*) AS BIGINT) AS pairs FROM e GROUP BY 1")
def part_cooccurrence(spark, sf):
    return part_edges(spark, sf).groupBy("weight").agg(F.count("*").alias("pairs"))


@book.add(f"WITH {PAIRS} SELECT node, CAST(count(*) AS BIGINT) AS degree, CAST(sum(weight) AS BIGINT) AS strength FROM (SELECT src AS node, weight FROM e UNION ALL SELECT dst, weight FROM e) GROUP BY 1")
def node_degrees(spark, sf):
    return G.degrees(part_edges(spark, sf))


HEAVY = "h AS (SELECT * FROM e WHERE weight >= 2), deg AS (SELECT node, count(*) AS degree FROM (SELECT src AS node FROM h UNION ALL SELECT dst FROM h) GROUP BY 1), men AS (SELECT l_partkey AS node, count(*) AS mentions FROM lineitem GROUP BY 1)"


@book.add(f"WITH {PAIRS}, {HEAVY} SELECT node, CAST(degree AS BIGINT) AS degree, mentions, round(degree * 0.3 + mentions * 0.7, 6)::DOUBLE AS potential FROM deg JOIN men USING (node) WHERE degree < 3 AND mentions >= 2 ORDER BY degree * 0.3 + mentions * 0.7 DESC, node LIMIT 20")
def peripheral_concepts(spark, sf):
    mentions = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("node")).agg(F.count("*").alias("mentions"))
    return G.peripheral(part_edges(spark, sf).where("weight >= 2"), mentions).select("node", "degree", "mentions", r6(F.col("potential")).alias("potential"))


@book.add(f"WITH {PAIRS}, {COMM}, m AS (SELECT sum(weight)::DOUBLE AS m FROM e), ins AS (SELECT a.community, sum(weight) AS l FROM e JOIN c a ON a.node = src JOIN c b ON b.node = dst AND a.community = b.community GROUP BY 1), d AS (SELECT community, sum(weight) AS d FROM (SELECT src AS node, weight FROM e UNION ALL SELECT dst, weight FROM e) JOIN c USING (node) GROUP BY 1) SELECT round(sum(coalesce(l, 0) / m - pow(d / (2 * m), 2)), 6) AS modularity FROM d LEFT JOIN ins USING (community), m")
def community_modularity(spark, sf):
    return G.modularity(part_edges(spark, sf), brands(spark, sf)).select(r6(F.col("modularity")).alias("modularity"))


@book.add(f"WITH {PAIRS}, {COMM}, h AS (SELECT * FROM e WHERE weight >= 2), x AS (SELECT least(a.community, b.community) AS a, greatest(a.community, b.community) AS b, count(*) AS k FROM h JOIN c a ON a.node = src JOIN c b ON b.node = dst WHERE a.community <> b.community GROUP BY 1, 2), s AS (SELECT community, count(*) AS size FROM c GROUP BY 1) SELECT p.community AS community_a, q.community AS community_b, CAST(coalesce(k, 0) AS BIGINT) AS connections, round(1 - coalesce(k, 0) / 10, 6) AS gap_score, p.size AS size_a, q.size AS size_b FROM s p JOIN s q ON p.community < q.community LEFT JOIN x ON x.a = p.community AND x.b = q.community WHERE coalesce(k, 0) < 10 ORDER BY connections, community_a, community_b LIMIT 10")
def structural_gaps(spark, sf):
    return G.gaps(part_edges(spark, sf).where("weight >= 2"), brands(spark, sf), few=10).select("community_a", "community_b", "connections", r6(F.col("gap_score")).alias("gap_score"), "size_a", "size_b")


@book.add(f"WITH {PAIRS}, {COMM}, x AS (SELECT a.community || '_' || b.community AS key, weight, count(*) AS k FROM e JOIN c a ON a.node = src JOIN c b ON b.node = dst WHERE a.community < b.community GROUP BY 1, 2), now AS (SELECT key, 1 - k / 5000 AS s FROM x WHERE weight = 1), old AS (SELECT key, 1 - k / 50 AS s FROM x WHERE weight = 2) SELECT coalesce(now.key, old.key) AS key, CASE WHEN old.s IS NULL THEN 'new' WHEN now.s IS NULL THEN 'bridged' WHEN now.s > old.s + 0.1 THEN 'widened' ELSE 'stable' END AS state FROM now FULL JOIN old ON now.key = old.key")
def gap_evolution(spark, sf):
    c = brands(spark, sf)
    x = part_edges(spark, sf).join(c.select(F.col("node").alias("src"), F.col("community").alias("a")), "src").join(c.select(F.col("node").alias("dst"), F.col("community").alias("b")), "dst").where("a < b").groupBy(F.concat_ws("_", "a", "b").alias("key"), "weight").agg(F.count("*").alias("k"))
    return G.gap_evolution(x.where("weight = 1").select("key", (1 - F.col("k") / 5000).alias("score")), x.where("weight = 2").select("key", (1 - F.col("k") / 50).alias("score"))).select("key", "state")


@book.add(f"WITH RECURSIVE {PAIRS}, h AS (SELECT * FROM e WHERE weight >= 3), b AS (SELECT src AS x, dst AS y FROM h UNION SELECT dst, src FROM h), r AS (SELECT x AS node, x AS reach FROM b UNION SELECT b.y, r.reach FROM r JOIN b ON b.x = r.node) SELECT node, min(reach) AS component FROM r GROUP BY 1")
def part_components(spark, sf):
    return connected_components(part_edges(spark, sf).where("weight >= 3"))


NEXT = "b AS (SELECT n_nationkey AS x, 100 + n_regionkey AS y FROM nation UNION SELECT 100 + n_regionkey, n_nationkey FROM nation)"


@book.add(f"WITH RECURSIVE {NEXT}, r AS (SELECT 0 AS node, 0 AS hops UNION SELECT b.y, r.hops + 1 FROM r JOIN b ON b.x = r.node WHERE r.hops < 6) SELECT node, CAST(min(hops) AS BIGINT) AS hops FROM r GROUP BY 1")
def shortest_paths(spark, sf):
    e = table(spark, sf, "nation").select(F.col("n_nationkey").alias("src"), (F.col("n_regionkey") + 100).alias("dst"))
    return G.distances(e, F.lit(0)).select("node", n(F.col("hops")).alias("hops"))


def mention_rows(spark, sf):
    """Mentions as members (segments) of the keys (entities) of groups (episodes)."""
    m = M.mentions(segments(table(spark, sf, "conversations")), concepts(table(spark, sf, "documents")))
    return m.select(F.col("episode_id").alias("group"), F.col("segment_index").alias("member"), F.col("entity_id").alias("key"), F.lit(1).alias("size"))


def episode_edges(spark, sf):
    e = within(mention_rows(spark, sf))
    return e.select(F.col("group").alias("episode_id"), F.col("a").alias("src"), F.col("b").alias("dst"), F.col("common").alias("weight"))


@book.add()
def episode_centralities(spark, sf):
    return centralities(episode_edges(spark, sf), "episode_id")


@book.add()
def episode_communities(spark, sf):
    return louvain(episode_edges(spark, sf), "episode_id", (0.5, 1.0, 2.0))


def corpus_edges(spark, sf):
    return M.co_occurrences(M.mentions(segments(table(spark, sf, "conversations")), concepts(table(spark, sf, "documents"))))


@book.add()
def corpus_centralities(spark, sf):
    """Measures of the graph of all episodes, by all tasks where one cannot hold it."""
    return centralities(corpus_edges(spark, sf))


@book.add()
def corpus_communities(spark, sf):
    """Communities of the graph of all episodes, with the modularity of each resolution's (at resolution 1)."""
    edges = corpus_edges(spark, sf).checkpoint()
    found = louvain(edges, None, (0.5, 1.0, 2.0)).checkpoint()
    parts = []
    for r in (0.5, 1.0, 2.0):
        own = found.where(F.col("resolution") == r)
        parts.append(own.join(F.broadcast(G.modularity(edges, own.select("node", "community"))), how="cross"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).withColumn("modularity", r6(F.col("modularity")))


@book.add(f"WITH {MENTIONS_SQL}, x AS (SELECT a.episode_id, a.entity_id AS src, b.entity_id AS dst, count(*) AS weight FROM men a JOIN men b ON a.episode_id = b.episode_id AND a.segment_index = b.segment_index AND a.entity_id < b.entity_id GROUP BY 1, 2, 3) SELECT episode_id, CAST(count(*) AS BIGINT) AS edges, CAST(sum(weight) AS BIGINT) AS weight, round(count(*) / count(DISTINCT src), 6) AS per_source FROM x GROUP BY 1")
def episode_graphs(spark, sf):
    g = sums_within(mention_rows(spark, sf))
    return g.select(F.col("group").alias("episode_id"), "edges", "weight", r6(F.col("edges") / F.col("sources")).alias("per_source"))


V = "v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings)"
COS = "list_dot_product({0}, {1}) / sqrt(list_dot_product({0}, {0}) * list_dot_product({1}, {1}))"


def vectors(spark, sf):
    return table(spark, sf, "embeddings")


@book.add(f"WITH {V}, p AS (SELECT a.vec_id AS query, b.vec_id AS id, {COS.format('a.e', 'b.e')} AS s FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0) SELECT query, id, round(s, 6) AS similarity, CAST(rank AS BIGINT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY s DESC, id) AS rank FROM p) WHERE rank <= 5")
def embedding_topk(spark, sf):
    v = vectors(spark, sf)
    q = v.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query"), F.col("embedding").alias("q"))
    return G.most_similar(q, v.select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))).select("query", "id", r6(F.col("similarity")).alias("similarity"), n(F.col("rank")).alias("rank"))


CENT = V + ", u AS (SELECT label, unnest(range(1, 65)) AS d, unnest(e) AS x FROM v), m AS (SELECT label, d, avg(x) AS x, count(*) AS size FROM u GROUP BY 1, 2), cen AS (SELECT label, list(x ORDER BY d) AS c, max(size) AS size FROM m GROUP BY 1)"


@book.add(f"WITH {CENT} SELECT v.vec_id, round(1 - {COS.format('v.e', 'cen.c')}, 6) AS distance, 1 - {COS.format('v.e', 'cen.c')} < 0.3 AS is_key FROM v JOIN cen USING (label)")
def centroid_distance(spark, sf):
    v = vectors(spark, sf)
    d = 1 - G.cosine(F.col("embedding"), F.col("centroid"))
    return v.join(F.broadcast(G.centroids(v, "label")), "label").select("vec_id", r6(d).alias("distance"), (d < 0.3).alias("is_key"))


@book.add(f"WITH {CENT} SELECT a.label AS community_a, b.label AS community_b, round(1 - {COS.format('a.c', 'b.c')}, 6) AS centroid_distance, CASE WHEN 1 - {COS.format('a.c', 'b.c')} < 0.3 THEN 'close' WHEN 1 - {COS.format('a.c', 'b.c')} < 0.5 THEN 'related' WHEN 1 - {COS.format('a.c', 'b.c')} < 0.7 THEN 'distant' ELSE 'far' END AS reading FROM cen a JOIN cen b ON a.label < b.label")
def semantic_distances(spark, sf):
    c = G.centroids(vectors(spark, sf), "label")
    d = 1 - G.cosine(F.col("a.centroid"), F.col("b.centroid"))
    return c.alias("a").join(c.alias("b"), F.col("a.label") < F.col("b.label")).select(F.col("a.label").alias("community_a"), F.col("b.label").alias("community_b"), r6(d).alias("centroid_distance"), F.when(d < 0.3, "close").when(d < 0.5, "related").when(d < 0.7, "distant").otherwise("far").alias("reading"))


@book.add(f"WITH {V}, s AS (SELECT label, count(*) AS n, list_sum(list_transform(range(1, 65), lambda d: 0.0)) AS z FROM v GROUP BY 1), u AS (SELECT label, unnest(range(1, 65)) AS d, unnest(list_transform(e, lambda x: x / sqrt(list_dot_product(e, e)))) AS x FROM v), m AS (SELECT label, d, sum(x) AS x FROM u GROUP BY 1, 2), q AS (SELECT label, sum(x * x) AS q FROM m GROUP BY 1) SELECT label, round((q - n) / (n * (n - 1)), 6) AS coherence, n AS size FROM q JOIN s USING (label)")
def cluster_coherence(spark, sf):
    """Mean cosine of all pairs, from the sum of unit vectors, so no pair is formed: |sum|^2 = n + twice the sum of the pairs' cosines."""
    unit = F.transform("embedding", lambda x: x.cast("double") / G.norm(F.col("embedding")))
    v = vectors(spark, sf).select("label", F.posexplode(unit).alias("d", "x"))
    m = v.groupBy("label", "d").agg(F.sum("x").alias("x"), F.count("*").alias("size"))
    g = m.groupBy("label").agg(F.sum(F.col("x") * F.col("x")).alias("q"), F.max("size").alias("size"))
    return g.select("label", r6((F.col("q") - F.col("size")) / (F.col("size") * (F.col("size") - 1))).alias("coherence"), "size")


@book.add(f"WITH {CENT}, p AS (SELECT vec_id, 2 * least({COS.format('v.e', 'a.c')}, {COS.format('v.e', 'b.c')}) AS score FROM v, cen a, cen b WHERE a.label = 0 AND b.label = 1 AND v.label NOT IN (0, 1)) SELECT vec_id, round(score, 6) AS score FROM p ORDER BY p.score DESC, vec_id LIMIT 5")
def bridge_candidates(spark, sf):
    """Vectors outside two communities that are nearest to both centroids."""
    v = vectors(spark, sf)
    c = G.centroids(v.where("label in (0, 1)"), "label").groupBy().agg(F.max_by("centroid", -F.col("label")).alias("a"), F.max_by("centroid", "label").alias("b"))
    score = 2 * F.least(G.cosine(F.col("embedding"), F.col("a")), G.cosine(F.col("embedding"), F.col("b")))
    return v.where("label not in (0, 1)").join(F.broadcast(c)).select("vec_id", score.alias("s")).orderBy(F.desc("s"), "vec_id").limit(5).select("vec_id", r6(F.col("s")).alias("score"))


@book.add(f"WITH {CENT} SELECT vec_id, round(({COS.format('e', 't')} * nt / n + 1) / 2, 6) AS centrality FROM (SELECT vec_id, e, t, sqrt(list_dot_product(t, t)) AS nt, n FROM v, (SELECT list(x ORDER BY d) AS t, max(n) AS n FROM (SELECT d, sum(x) AS x, count(*) AS n FROM (SELECT unnest(range(1, 65)) AS d, unnest(list_transform(e, lambda x: x / sqrt(list_dot_product(e, e)))) AS x FROM v) GROUP BY d)))")
def semantic_centrality(spark, sf):
    """Mean cosine to all vectors, itself included, from the sum of unit vectors."""
    unit = F.transform("embedding", lambda x: x.cast("double") / G.norm(F.col("embedding")))
    v = vectors(spark, sf).select("vec_id", unit.alias("u"))
    t = v.select(F.posexplode("u").alias("d", "x")).groupBy("d").agg(F.sum("x").alias("x"), F.count("*").alias("n")).agg(F.transform(F.array_sort(F.collect_list(F.struct("d", "x"))), lambda s: s["x"]).alias("t"), F.max("n").alias("n"))
    return v.join(F.broadcast(t)).select("vec_id", r6((G.dot(F.col("u"), F.col("t")) / F.col("n") + 1) / 2).alias("centrality"))


QUERIES, SQL = book.queries, book.sql
