"""Queries over gaps, topics and edges that enrich a graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from convograph.functions import lexicons as L
from convograph.operators import gaps as P
from convograph.operators import mentions as M
from convograph.plans.base import Book, n, quote, r6, table
from convograph.plans.flow import parts
from convograph.plans.graphs import COS, V, vectors
from convograph.sources.adapters import MENTIONS_SQL
from convograph.workers import written

book = Book()

PAIRED = "(SELECT vec_id AS a, vec_id + 7 AS b FROM embeddings WHERE vec_id % 50 = 0)"


@book.add(f"WITH {V}, p AS (SELECT x.vec_id AS a, y.vec_id AS b, x.e AS ea, y.e AS eb FROM {PAIRED} q JOIN v x ON x.vec_id = q.a JOIN v y ON y.vec_id = q.b), s AS (SELECT a, b, v.vec_id AS via, {COS.format('ea', 'v.e')} AS s, {COS.format('eb', 'v.e')} AS t FROM p JOIN v ON v.vec_id <> a AND v.vec_id <> b) SELECT a, b, via, round((s + t) / 2, 6) AS score, CAST(row_number() OVER (PARTITION BY a, b ORDER BY s + t DESC, via) AS BIGINT) AS rank FROM s WHERE s > 0.1 AND t > 0.1 QUALIFY rank <= 3")
def conceptual_paths(spark, sf):
    """Single steps between vectors whose ids differ by seven, for one id in fifty against all."""
    v = vectors(spark, sf).select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))
    pairs = v.where("id % 50 = 0").select(F.col("id").alias("a"), (F.col("id") + 7).alias("b"))
    return P.paths(pairs, v, least=0.1).select("a", "b", "via", r6(F.col("score")).alias("score"), n(F.col("rank")).alias("rank"))


def gap_rows(spark, sf):
    """Gaps between neighbouring customers; their nations are the names, their distance follows from the balance."""
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    k, a = F.col("c_custkey"), F.col("c_nationkey")
    name = lambda x: F.concat(F.lit("NATION_"), (x % 25).cast("string"))
    return c.select(k.alias("pos"), (k % 50).alias("community_a"), (k % 50 + 50).alias("community_b"), F.array(name(a), name(a + 1)).alias("names_a"), F.array(name(a + 1), name(a + 2)).alias("names_b"), (F.col("c_acctbal") / 10000).alias("distance"), F.when(k % 3 > 0, F.array("c_mktsegment", name(a), name(k), F.lit("x"))).otherwise(F.array().cast("array<string>")).alias("bridges"))


NAME = "'NATION_' || ({}) % 25"
GAPS = f"gp AS (SELECT c_custkey AS pos, c_custkey % 50 AS community_a, c_custkey % 50 + 50 AS community_b, [{NAME.format('c_nationkey')}, {NAME.format('c_nationkey + 1')}] AS names_a, [{NAME.format('c_nationkey + 1')}, {NAME.format('c_nationkey + 2')}] AS names_b, c_acctbal / 10000 AS distance, CASE WHEN c_custkey % 3 > 0 THEN [c_mktsegment, {NAME.format('c_nationkey')}, {NAME.format('c_custkey')}, 'x'] ELSE [] END AS bridges FROM customer)"


@book.add(f"WITH {GAPS} SELECT pos, 'community_' || community_a || '_to_' || community_b AS gap_id, array_to_string(bridges[1:3], ',') AS recommended, CASE WHEN len(bridges) > 0 THEN replace({quote(L.GAP_SUGGESTIONS['bridge'])}, '%s', bridges[1]) || '; ' ELSE '' END || CASE WHEN distance < 0.5 THEN {quote(L.GAP_SUGGESTIONS['close'])} ELSE {quote(L.GAP_SUGGESTIONS['distant'])} END AS suggestions FROM gp")
def gap_reports(spark, sf):
    d = P.reports(gap_rows(spark, sf))
    return d.select("pos", "gap_id", F.array_join("recommended", ",").alias("recommended"), F.array_join("suggestions", "; ").alias("suggestions"))


@book.add(f"WITH {GAPS}, g AS (SELECT * FROM gp WHERE pos < 50), s AS (SELECT community_a, community_b, unnest(names_a) AS name, 'a' AS side FROM g UNION ALL SELECT community_a, community_b, unnest(names_b), 'b' FROM g) SELECT community_a, community_b, n_nationkey AS entity_id, min(side) AS side FROM s JOIN nation ON n_name = name GROUP BY 1, 2, 3")
def gap_members(spark, sf):
    e = table(spark, sf, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    return P.members(gap_rows(spark, sf).where("pos < 50"), e)


@book.add(f"WITH {GAPS}, s AS (SELECT pos, 'a' AS k, community_a AS community, names_a AS names FROM gp UNION ALL SELECT pos, 'b', community_b, names_b FROM gp) SELECT 'community' AS kind, community AS key, array_to_string(arg_min(names, (pos, k)), ',') AS shown FROM s GROUP BY community UNION ALL SELECT 'bridges', community_a, CAST(sum(least(3, len(bridges))) AS VARCHAR) FROM gp GROUP BY community_a HAVING sum(len(bridges)) > 0")
def gap_picture(spark, sf):
    communities, bridges = P.picture(gap_rows(spark, sf))
    shown = communities.select(F.lit("community").alias("kind"), F.col("community").alias("key"), F.array_join("names", ",").alias("shown"))
    return shown.unionByName(bridges.groupBy("community_a").agg(F.count("*").alias("k")).select(F.lit("bridges").alias("kind"), F.col("community_a").alias("key"), F.col("k").cast("string").alias("shown")))


@book.add("WITH a AS (SELECT 1 AS level, p_partkey AS node, p_brand AS community FROM part UNION ALL SELECT 2, p_partkey, p_type FROM part), d AS (SELECT level, community, p_name AS name, node, row_number() OVER (PARTITION BY level, community ORDER BY p_name, node) AS rn FROM a JOIN part ON p_partkey = node WHERE p_partkey % 10 > 0) SELECT 'level_' || level || '-' || community AS id, 'level_' || level AS level, min(name) AS name, CAST(count(*) AS BIGINT) AS members, string_agg(name, ',' ORDER BY rn) FILTER (WHERE rn <= 5) AS concepts FROM d GROUP BY level, community")
def hierarchical_topics(spark, sf):
    """Brands as the first level and types as the second; one part in ten has no name."""
    p = table(spark, sf, "part")
    level = lambda k, c: p.select(F.lit(k).alias("level"), F.col("p_partkey").alias("node"), F.col(c).alias("community"))
    names = p.where("p_partkey % 10 > 0").select(F.col("p_partkey").alias("node"), F.col("p_name").alias("name"))
    return P.topics(level(1, "p_brand").unionByName(level(2, "p_type")), names).withColumn("concepts", F.array_join("concepts", ","))


@book.add("SELECT event_id, CASE event_type WHEN 'view' THEN 'Multiple distinct topic clusters' WHEN 'signup' THEN 'Organic, exploratory conversation' ELSE 'Unknown discourse structure' END AS description FROM events")
def discourse_descriptions(spark, sf):
    kind = F.when(F.col("event_type") == "view", "modular").when(F.col("event_type") == "signup", "emergent").otherwise("none")
    return table(spark, sf, "events").select("event_id", P.description(kind).alias("description"))


@book.add(f"WITH {V} SELECT a.vec_id AS \"left\", b.vec_id AS \"right\", round({COS.format('a.e', 'b.e')}, 6) AS similarity FROM v a, v b WHERE a.vec_id % 50 = 0 AND {COS.format('a.e', 'b.e')} > 0.2")
def batch_similarities(spark, sf):
    """One vector in fifty against all."""
    v = vectors(spark, sf)
    left = v.where("vec_id % 50 = 0").select(F.col("vec_id").alias("left"), F.col("embedding").alias("u"))
    return P.similarities(left, v.select(F.col("vec_id").alias("right"), F.col("embedding").alias("v")), 0.2).withColumn("similarity", r6(F.col("similarity")))


@book.add(f"WITH {MENTIONS_SQL} SELECT m.entity_id AS src, m.episode_id || '_segment_' || m.segment_index AS dst, CASE WHEN s.word_count > 40 THEN 0.5 ELSE 0 END::DOUBLE AS weight, CASE WHEN s.word_count % 3 = 0 THEN 'positive' ELSE 'neutral' END AS polarity FROM men m JOIN seg s USING (episode_id, segment_index) WHERE s.word_count % 3 < 2")
def sentiment_edges(spark, sf):
    s, m = parts(spark, sf)
    named = m.groupBy("episode_id", "segment_index").agg(F.collect_list("name").alias("names"), F.max("word_count").alias("w"))
    w = F.col("w")
    rows = named.withColumns({"sentiment": F.when(w % 3 == 0, "positive").when(w % 3 == 1, "neutral"), "score": F.when(w > 40, 0.5)})
    return P.sentiment_edges(rows, m.select("episode_id", F.col("entity_id").alias("id"), "name").distinct()).drop("type")


@book.add(f"WITH {MENTIONS_SQL}, co AS (SELECT a.entity_id AS src, b.entity_id AS dst, count(*) AS w FROM men a JOIN men b ON a.episode_id = b.episode_id AND a.segment_index = b.segment_index AND a.entity_id < b.entity_id GROUP BY 1, 2), c AS (SELECT episode_id AS dst, entity_id AS src, count(*) AS w FROM men GROUP BY 1, 2) SELECT src, dst, 'CO_OCCURS_WITH' AS type, w::DOUBLE AS weight FROM co UNION ALL SELECT src, dst, 'SEMANTICALLY_SIMILAR', round(w / (w + 1), 6) FROM co WHERE w / (w + 1) > 0.7 UNION ALL SELECT src, CAST(dst AS VARCHAR), 'CONTRIBUTES_TO', w::DOUBLE FROM c")
def enriched_entity_edges(spark, sf):
    m = written(parts(spark, sf)[1].select("episode_id", "segment_index", "entity_id"))
    co = M.co_occurrences(m).withColumn("alike", r6(F.col("weight") / (F.col("weight") + 1)))
    given = m.groupBy(F.col("entity_id").alias("src"), F.col("episode_id").cast("string").alias("dst")).agg(F.count("*").alias("weight"))
    return P.entity_edges(co, given)


@book.add("SELECT vec_id FROM embeddings WHERE vec_id % 3 = 0 ORDER BY vec_id LIMIT 100")
def without_vectors(spark, sf):
    """The next hundred rows to embed; a third has no vector or an empty one."""
    k = F.col("vec_id")
    v = table(spark, sf, "embeddings").select("vec_id", F.when(k % 6 == 0, F.slice("embedding", 1, 0)).when(k % 3 > 0, F.col("embedding")).alias("v"))
    return P.without_vector(v, "v", "vec_id").select("vec_id")


QUERIES, SQL = book.queries, book.sql
