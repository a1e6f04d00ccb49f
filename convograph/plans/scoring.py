"""Queries over scores, lookups and validations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from convograph.functions import lexicons as L
from convograph.functions import scores as S
from convograph.functions import text as T
from convograph.operators import graph as G
from convograph.plans.base import Book, n, quote, r6, sql_any, table
from convograph.plans.episodes import SOURCES, scored
from convograph.plans.graphs import CENT, COS, V
from convograph.plans.flow import parts
from convograph.sources.adapters import MENTIONS_SQL, SEGMENTS_SQL, segments

book = Book()


@book.add("SELECT event_id, round(greatest(0.0, least(100.0, value)), 6)::DOUBLE AS score, greatest(0.0, least(1.0, round(coalesce(TRY_CAST(CASE WHEN event_id % 5 = 0 THEN event_type ELSE CAST(CAST(user_id AS DOUBLE) / 50 AS VARCHAR) END AS DOUBLE), 0.5), 6)))::DOUBLE AS ratio FROM events")
def clamped_metrics(spark, sf):
    text = F.when(F.col("event_id") % 5 == 0, F.col("event_type")).otherwise((F.col("user_id").cast("double") / 50).cast("string"))
    return table(spark, sf, "events").select("event_id", r6(S.clamped(F.col("value"), 0, 100)).alias("score"), r6(S.clamped(text, 0, 1, 0.5)).alias("ratio"))


@book.add("SELECT o_orderkey, strftime(date_trunc('day', o_orderdate), '%Y-%m-%d') AS day, CASE o_orderkey % 4 WHEN 0 THEN 'date' WHEN 1 THEN 'other' WHEN 2 THEN 'iso' ELSE 'epoch' END AS form, o_orderkey % 4 <> 3 AS parsed FROM orders")
def parsed_dates(spark, sf):
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 4
    text = F.when(k == 0, F.date_format(d, "yyyy-MM-dd")).when(k == 1, F.date_format(d, "yyyy/MM/dd")).when(k == 2, F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(F.lit("1234567890"))
    at = S.parsed_date(text)
    return table(spark, sf, "orders").select("o_orderkey", F.date_format(F.coalesce(at, d.cast("timestamp")), "yyyy-MM-dd").alias("day"), S.date_format_of(text).alias("form"), at.isNotNull().alias("parsed"))


@book.add("SELECT event_type, CASE event_type WHEN 'signup' THEN 'person' WHEN 'purchase' THEN 'product' WHEN 'view' THEN 'concept' ELSE 'other' END AS mapped, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1, 2")
def mapped_types(spark, sf):
    name = F.when(F.col("event_type") == "signup", " People ").when(F.col("event_type") == "purchase", "Product").when(F.col("event_type") == "view", "CONCEPT").otherwise("x")
    return table(spark, sf, "events").groupBy("event_type", S.entity_type(name).alias("mapped")).agg(F.count("*").alias("n"))


ENDING = MENTIONS_SQL + ", lst AS (SELECT *, row_number() OVER (PARTITION BY episode_id ORDER BY segment_index DESC) AS r FROM seg), en AS (SELECT episode_id, string_agg(lower(text), ' ' ORDER BY segment_index) AS t FROM lst WHERE r <= 2 GROUP BY 1), fm AS (SELECT m.episode_id, entity_id, count(l.segment_index) AS m FROM men m LEFT JOIN lst l ON l.episode_id = m.episode_id AND l.segment_index = m.segment_index AND r <= 5 GROUP BY 1, 2), k AS (SELECT episode_id, entity_id, m, CASE WHEN m = 0 THEN 'abandoned' WHEN " + sql_any("t", ["therefore", "conclude"]) + " THEN 'answered' WHEN " + sql_any("t", ["future", "next time"]) + " THEN 'deferred' WHEN " + sql_any("t", ["partially", "some aspects"]) + " THEN 'partial' WHEN " + sql_any("t", ["instead", "actually"]) + " THEN 'transformed' ELSE 'partial' END AS kind FROM fm JOIN en USING (episode_id))"


@book.add(f"WITH {ENDING} SELECT episode_id, entity_id, kind, CASE kind WHEN " + " WHEN ".join(f"{quote(k)} THEN {quote(v)}" for k, v in S.STATES.items()) + " END AS state, round(CASE WHEN m > 2 THEN least(1.0, q + 0.1) ELSE q END, 6)::DOUBLE AS quality FROM (SELECT *, CASE kind WHEN " + " WHEN ".join(f"{quote(k)} THEN {v}" for k, v in L.RESOLUTION_SCORES.items()) + " END AS q FROM k)")
def concept_resolutions(spark, sf):
    """Each concept of an episode by its mentions in the last five segments and the words of the last two."""
    s, m = parts(spark, sf)
    ranked = s.withColumn("r", F.row_number().over(Window.partitionBy("episode_id").orderBy(F.desc("segment_index")))).where("r <= 5")
    e = ranked.where("r <= 2").groupBy("episode_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("segment_index", "text"))), lambda x: x["text"]), " ").alias("t"))
    final = m.join(ranked.select("episode_id", "segment_index", "r"), ["episode_id", "segment_index"], "left").groupBy("episode_id", "entity_id").agg(F.count("r").alias("m"))
    # the ending's words are looked for once an episode, not once a concept and use
    e = e.select("episode_id", S.resolution(F.col("t"), F.lit(1)).alias("ending"))
    k = final.join(e, "episode_id").select("episode_id", "entity_id", "m", F.when(F.col("m") > 0, F.col("ending")).otherwise("abandoned").alias("kind"))
    kind = F.col("kind")
    return k.select("episode_id", "entity_id", "kind", T.looked_up(kind, S.STATES, "Unknown resolution state").alias("state"), r6(S.resolution_quality(kind, F.col("m"))).alias("quality"))


@book.add(f"WITH {V}, x AS (SELECT a.vec_id AS src, b.vec_id AS dst, {COS.format('a.e', 'b.e')} AS s, a.label <> b.label AS changed FROM v a JOIN v b ON b.vec_id = a.vec_id + 1), k AS (SELECT *, CASE WHEN s > 0.8 THEN 'continuation' WHEN s > 0.6 THEN 'expansion' WHEN s > 0.4 AND changed THEN 'pivot' WHEN s > 0.4 THEN 'return' ELSE 'jump' END AS kind FROM x) SELECT src, dst, round(s, 6) AS similarity, kind, round((CASE kind WHEN 'continuation' THEN 0.9 WHEN 'expansion' THEN 0.8 WHEN 'return' THEN 0.7 WHEN 'pivot' THEN 0.6 ELSE 0.3 END + s) / 2, 6) AS smoothness, CASE WHEN s > 0.9 THEN 'STRONGLY_RELATED_TO' WHEN s > 0.85 THEN 'RELATED_TO' ELSE 'ASSOCIATED_WITH' END AS relation FROM k")
def embedding_transitions(spark, sf):
    """Vectors in order of their ids stand for adjacent segments, labels for speakers."""
    v = table(spark, sf, "embeddings")
    j = v.alias("a").join(v.withColumn("vec_id", F.col("vec_id") - 1).alias("b"), "vec_id")
    s = G.cosine(F.col("a.embedding"), F.col("b.embedding"))
    x = j.select(F.col("vec_id").alias("src"), (F.col("vec_id") + 1).alias("dst"), s.alias("s"), (F.col("a.label") != F.col("b.label")).alias("changed"))
    kind = S.transition_kind(F.col("s"), F.col("changed"))
    return x.select("src", "dst", r6(F.col("s")).alias("similarity"), kind.alias("kind"), r6(S.smoothness(kind, F.col("s"), F.lit(None).cast("string"))).alias("smoothness"), S.similarity_relation(F.col("s")).alias("relation"))


@book.add("SELECT p_partkey, p_type || ': ' || p_name || CASE WHEN p_partkey % 2 = 0 THEN ' | Description: ' || p_brand ELSE '' END || CASE WHEN p_partkey % 3 = 0 THEN ' | Also known as: ' || p_brand || ', ' || p_type ELSE '' END AS text FROM part")
def entity_texts(spark, sf):
    k = F.col("p_partkey")
    aliases = F.when(k % 3 == 0, F.array("p_brand", "p_type")).otherwise(F.array().cast("array<string>"))
    return table(spark, sf, "part").select("p_partkey", S.entity_text(F.col("p_type"), F.col("p_name"), F.when(k % 2 == 0, F.col("p_brand")), aliases).alias("text"))


@book.add(f"WITH {CENT}, x AS (SELECT a.label AS a, b.label AS b, 1 - {COS.format('a.c', 'b.c')} AS d, a.size AS sa, b.size AS sb FROM cen a JOIN cen b ON a.label < b.label) SELECT a AS community_a, b AS community_b, round((1 - d) * 0.3 + 0.5 * 0.4 + least(sa, sb) / greatest(sa, sb) * 0.2 + least(1.0, (a % 3) / 3) * 0.1, 6)::DOUBLE AS bridgeability, round(least(1.0, (sa + sb) / 20) * 0.25 + 0.5 * 0.35 + ((1 - d) * 0.3 + 0.5 * 0.4 + least(sa, sb) / greatest(sa, sb) * 0.2 + least(1.0, (a % 3) / 3) * 0.1) * 0.25 + d * 0.15, 6)::DOUBLE AS priority FROM x")
def gap_priorities(spark, sf):
    c = G.centroids(table(spark, sf, "embeddings"), "label")
    d = 1 - G.cosine(F.col("a.centroid"), F.col("b.centroid"))
    x = c.alias("a").join(c.alias("b"), F.col("a.label") < F.col("b.label")).select(F.col("a.label").alias("a"), F.col("b.label").alias("b"), d.alias("d"), F.col("a.size").alias("sa"), F.col("b.size").alias("sb"))
    bridge = S.bridgeability(F.col("d"), F.lit(0.5), F.col("sa"), F.col("sb"), F.col("a") % 3)
    return x.select(F.col("a").alias("community_a"), F.col("b").alias("community_b"), r6(bridge).alias("bridgeability"), r6(S.priority(F.col("sa") + F.col("sb"), F.lit(0.5), bridge, F.col("d"))).alias("priority"))


@book.add("WITH v AS (SELECT value / 100.0::DOUBLE AS x FROM events), b AS (SELECT least(4, (x >= 0.2)::INT + (x >= 0.4)::INT + (x >= 0.6)::INT + (x >= 0.8)::INT + (x >= 1)::INT) AS b FROM v WHERE x BETWEEN 0 AND 1) SELECT round(b * 0.2, 6)::DOUBLE AS low, round((b + 1) * 0.2, 6)::DOUBLE AS high, CAST(count(*) AS BIGINT) AS count FROM b GROUP BY b")
def score_histogram(spark, sf):
    v = table(spark, sf, "events").select((F.col("value") / 100.0).alias("x"))
    return S.bins(v, "x", [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]).select(r6(F.col("low")).alias("low"), r6(F.col("high")).alias("high"), "count")


@book.add(f"{SOURCES}, x AS (SELECT source, doc_id, score, lag(score) OVER w AS a, lead(score) OVER w AS b FROM l WINDOW w AS (PARTITION BY source ORDER BY doc_id)), y AS (SELECT *, CASE WHEN score > a AND score > b THEN 'peak' WHEN score < a AND score < b THEN 'valley' END AS kind, least(abs(score - a), abs(score - b)) AS p FROM x), z AS (SELECT *, row_number() OVER (PARTITION BY source, kind ORDER BY p DESC, doc_id) AS r FROM y WHERE kind IS NOT NULL) SELECT source, doc_id, kind, round(p, 6) AS prominence FROM z WHERE r <= 3")
def complexity_peaks(spark, sf):
    return S.extremes(scored(spark, sf), "source", "doc_id", "score").select("source", "doc_id", "kind", r6(F.col("prominence")).alias("prominence"))


@book.add("SELECT event_type AS component, CAST(count(*) AS BIGINT) AS runs, round(sum(value), 4) AS seconds, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS added, round((sum(CAST(json_extract(props, '$.k') AS BIGINT)) + count(*) * 0.5) / sum(value), 2)::DOUBLE AS impact, count(*) > 10 AND avg(value) < 0.1 AS redundant FROM events GROUP BY 1")
def component_impacts(spark, sf):
    k = F.get_json_object("props", "$.k").cast("long")
    g = table(spark, sf, "events").groupBy(F.col("event_type").alias("component")).agg(F.count("*").alias("runs"), F.sum("value").alias("s"), F.sum(k).alias("added"), F.avg("value").alias("mean"))
    return g.select("component", "runs", F.round("s", 4).alias("seconds"), "added", S.impact(F.col("added"), F.col("runs"), F.col("s")).alias("impact"), ((F.col("runs") > 10) & (F.col("mean") < 0.1)).alias("redundant"))


@book.add("WITH a AS (SELECT DISTINCT event_type AS t FROM events), e AS (SELECT unnest(['click', 'view', 'refund']) AS t) SELECT coalesce(a.t, e.t) AS type, CASE WHEN a.t IS NULL THEN 'missing' WHEN e.t IS NULL THEN 'unexpected' ELSE 'present' END AS state FROM a FULL JOIN e ON a.t = e.t")
def schema_differences(spark, sf):
    a = table(spark, sf, "events").select(F.col("event_type").alias("type")).distinct().withColumn("is", F.lit(True))
    e = spark.createDataFrame([("click",), ("view",), ("refund",)], "type string").withColumn("wanted", F.lit(True))
    return a.join(e, "type", "full_outer").select("type", F.when(F.col("is").isNull(), "missing").when(F.col("wanted").isNull(), "unexpected").otherwise("present").alias("state"))


@book.add("SELECT CASE WHEN n_nationkey % 2 = 0 THEN n_regionkey END AS region, CAST(count(*) AS BIGINT) AS nations, CAST(count(*) FILTER (WHERE n_nationkey % 2 <> 0) AS BIGINT) AS orphans FROM nation GROUP BY 1")
def migrated_rows(spark, sf):
    """Rows whose parent is missing stay with a null and are counted."""
    nation = table(spark, sf, "nation").withColumn("key", F.when(F.col("n_nationkey") % 2 == 0, F.col("n_regionkey")).otherwise(-1))
    j = nation.join(table(spark, sf, "region").select(F.col("r_regionkey").alias("region")), F.col("key") == F.col("region"), "left")
    return j.groupBy("region").agg(F.count("*").alias("nations"), F.count_if(F.col("region").isNull()).alias("orphans"))


@book.add(f"WITH {V}, c AS (SELECT label, count(*) AS size FROM v GROUP BY 1) SELECT CAST(count(*) AS BIGINT) AS communities, round(count(*) / sum(size), 6) AS diversity, round(-sum(size / (SELECT count(*) FROM v) * ln(size / (SELECT count(*) FROM v))), 6) AS entropy FROM c")
def diversity_metrics(spark, sf):
    c = table(spark, sf, "embeddings").groupBy("label").agg(F.count("*").alias("size"))
    t = c.agg(F.count("*").alias("communities"), F.sum("size").alias("n"), F.sum(F.col("size") * F.log("size")).alias("sl"))
    return t.select("communities", r6(F.col("communities") / F.col("n")).alias("diversity"), r6(F.log("n") - F.col("sl") / F.col("n")).alias("entropy"))


QUERIES, SQL = book.queries, book.sql
__all__ = ["QUERIES", "SQL", "n"]
