"""Queries over the property graph that the star schema makes."""

from __future__ import annotations

from pyspark.sql import functions as F

from convograph.functions import text as T
from convograph.operators import store as S
from convograph.plans.base import Book, n, r6, sql_words, table
from convograph.sources.adapters import SEGMENTS_SQL, segments

book = Book()


def graph(spark, sf) -> S.Graph:
    """Regions, nations, customers, orders as nodes and their keys as edges."""
    t = lambda name: table(spark, sf, name)
    no = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    node = lambda d, key, kind, name, props=no: d.select(F.concat(F.lit(kind[0] + "-"), F.col(key).cast("string")).alias("id"), F.lit(kind).alias("type"), F.col(name).alias("name"), props.alias("props"))
    edge = lambda d, a, ka, b, kb, kind, w: d.select(F.concat(F.lit(a + "-"), F.col(ka).cast("string")).alias("src"), F.concat(F.lit(b + "-"), F.col(kb).cast("string")).alias("dst"), F.lit(kind).alias("type"), w.cast("double").alias("weight"))
    nodes = node(t("region"), "r_regionkey", "region", "r_name").unionByName(node(t("nation"), "n_nationkey", "nation", "n_name")).unionByName(node(t("customer"), "c_custkey", "customer", "c_name", F.create_map(F.lit("segment"), F.col("c_mktsegment")))).unionByName(node(t("orders"), "o_orderkey", "order", "o_orderpriority", F.create_map(F.lit("status"), F.col("o_orderstatus"))))
    edges = edge(t("nation"), "n", "n_nationkey", "r", "n_regionkey", "IN_REGION", F.lit(1)).unionByName(edge(t("customer"), "c", "c_custkey", "n", "c_nationkey", "IN_NATION", F.lit(1))).unionByName(edge(t("orders"), "o", "o_orderkey", "c", "o_custkey", "PLACED_BY", F.col("o_totalprice")))
    return S.Graph(nodes, edges)


NODES = "nodes AS (SELECT 'r-' || r_regionkey AS id, 'region' AS type, r_name AS name, NULL AS p FROM region UNION ALL SELECT 'n-' || n_nationkey, 'nation', n_name, NULL FROM nation UNION ALL SELECT 'c-' || c_custkey, 'customer', c_name, c_mktsegment FROM customer UNION ALL SELECT 'o-' || o_orderkey, 'order', o_orderpriority, o_orderstatus FROM orders), edges AS (SELECT 'n-' || n_nationkey AS src, 'r-' || n_regionkey AS dst, 'IN_REGION' AS type, 1.0 AS weight FROM nation UNION ALL SELECT 'c-' || c_custkey, 'n-' || c_nationkey, 'IN_NATION', 1.0 FROM customer UNION ALL SELECT 'o-' || o_orderkey, 'c-' || o_custkey, 'PLACED_BY', o_totalprice FROM orders)"


@book.add(f"WITH {NODES} SELECT 'node' AS kind, type, CAST(count(*) AS BIGINT) AS n FROM nodes GROUP BY type UNION ALL SELECT 'edge', type, CAST(count(*) AS BIGINT) FROM edges GROUP BY type")
def label_counts(spark, sf):
    return graph(spark, sf).counts()


@book.add("SELECT 'd-' || d.doc_id AS id, coalesce(source, '') AS name FROM documents d WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def orphan_checks(spark, sf):
    """Documents that no label refers to, by an anti join."""
    doc = lambda: F.concat(F.lit("d-"), F.col("doc_id").cast("string"))
    nodes = table(spark, sf, "documents").select(doc().alias("id"), F.lit("document").alias("type"), F.coalesce("source", F.lit("")).alias("name"))
    edges = table(spark, sf, "labels").where("doc_id IS NOT NULL").select(doc().alias("src"), F.concat(F.lit("q-"), F.col("quality").cast("string")).alias("dst"), F.lit("HAS_LABEL").alias("type"), F.lit(1.0).alias("weight"))
    return S.Graph(nodes, edges).orphans("document", "HAS_LABEL").select("id", "name")


@book.add(f"WITH {NODES} SELECT src, dst, type FROM edges WHERE dst NOT IN (SELECT id FROM nodes) OR src NOT IN (SELECT id FROM nodes) UNION ALL SELECT 'x', 'y', 'TEST'")
def dangling_edges(spark, sf):
    """A planted edge between unknown nodes is found at both ends."""
    g = graph(spark, sf)
    bad = S.Graph(g.nodes, g.edges.unionByName(spark.createDataFrame([("x", "y", "TEST", 1.0)], g.edges.schema)))
    return bad.dangling().select("src", "dst", "type").distinct()


@book.add("SELECT l_orderkey, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def duplicate_ids(spark, sf):
    d = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id"), F.lit("line").alias("type"))
    return S.Graph(d, d).duplicates().select(F.col("id").alias("l_orderkey"), "n")


@book.add(f"WITH {NODES}, e AS (SELECT src AS id, dst AS nb FROM edges UNION ALL SELECT dst, src FROM edges) SELECT id, CAST(count(*) AS BIGINT) AS neighbours FROM e WHERE id LIKE 'n-%' GROUP BY 1")
def neighbour_counts(spark, sf):
    return graph(spark, sf).neighbours("nation").groupBy("id").agg(F.count("*").alias("neighbours"))


@book.add("SELECT CAST(count(*) AS BIGINT) AS n FROM customer WHERE c_mktsegment = 'BUILDING' AND contains(lower(c_name), '1')")
def intent_queries(spark, sf):
    return graph(spark, sf).find({"action": "count", "type": "customer", "properties": {"segment": "BUILDING"}, "text_contains": "1"})


@book.add(f"WITH {NODES} SELECT type, CAST(count(*) AS BIGINT) AS n FROM nodes WHERE id <> 'n-3' GROUP BY 1 UNION ALL SELECT type, CAST(count(*) AS BIGINT) FROM edges WHERE src <> 'n-3' AND dst <> 'n-3' GROUP BY 1")
def detach_delete(spark, sf):
    g = graph(spark, sf)
    return g.delete(g.nodes.where("id = 'n-3'")).counts().select("type", "n")


@book.add(f"WITH {NODES} SELECT id, coalesce(p, '') AS segment, CASE WHEN id LIKE '%7' THEN 'yes' ELSE '' END AS flagged FROM nodes WHERE type = 'customer'")
def node_updates(spark, sf):
    g = graph(spark, sf)
    change = g.nodes.where("type = 'customer' and id like '%7'").select("id", F.create_map(F.lit("flagged"), F.lit("yes")).alias("props"))
    out = g.update(change).nodes.where("type = 'customer'")
    get = lambda k: F.coalesce(F.element_at("props", F.lit(k)), F.lit(""))
    return out.select("id", get("segment").alias("segment"), get("flagged").alias("flagged"))


@book.add("SELECT CAST(p_partkey AS VARCHAR) AS id, 'Part' AS _type, p_name AS name, p_brand AS category, 'unknown' AS owner FROM part")
def standardized_nodes(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), "p_name", "p_brand")
    return S.standardized(S.schemaless(p, "Part"), {"name": ["title", "p_name"], "category": ["p_brand", "p_type"], "owner": ["owner", "holder"]}, {"owner": "unknown"})


@book.add("SELECT s_suppkey, CASE s_suppkey % 2 WHEN 0 THEN '1.1.0' ELSE '1.0.0' END AS schema_version FROM supplier")
def schema_migration(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey")
    up = S.migrate(s.where("s_suppkey % 2 = 0"), "0.0.0", "1.1.0").drop("migrated")
    down = S.migrate(S.migrate(s.where("s_suppkey % 2 <> 0"), "0.0.0", "1.1.0"), "1.1.0", "1.0.0")
    return up.unionByName(down)


@book.add("WITH a AS (SELECT o_orderpriority AS label, count(*) AS n FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1), b AS (SELECT o_orderpriority AS label, count(*) AS n FROM orders GROUP BY 1) SELECT coalesce(a.label, b.label) AS label, CAST(coalesce(b.n, 0) - coalesce(a.n, 0) AS BIGINT) AS difference, coalesce(b.n, 0) < coalesce(a.n, 0) AS lost FROM a FULL JOIN b ON a.label = b.label")
def migration_compare(spark, sf):
    c = lambda d: d.groupBy(F.col("o_orderpriority").alias("label")).agg(F.count("*").alias("n"))
    o = table(spark, sf, "orders")
    j = c(o.where("o_orderkey % 2 = 0")).withColumnRenamed("n", "before").join(c(o).withColumnRenamed("n", "after"), "label", "full_outer").na.fill(0)
    return j.select("label", (F.col("after") - F.col("before")).alias("difference"), (F.col("after") < F.col("before")).alias("lost"))


@book.add("SELECT o_orderkey, unnest(list_filter([CASE WHEN o_totalprice < 1000 THEN 'price: low' END, CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'status: unknown' END, CASE WHEN o_custkey IS NULL THEN 'customer: missing' END], lambda x: x IS NOT NULL)) AS violation FROM orders")
def rule_violations(spark, sf):
    rules = {"price: low": F.col("o_totalprice") < 1000, "status: unknown": ~F.col("o_orderstatus").isin("F", "O"), "customer: missing": F.col("o_custkey").isNull()}
    return S.violations(table(spark, sf, "orders"), rules).select("o_orderkey", "violation")


@book.add("SELECT len(embedding) AS dimension, CAST(count(*) AS BIGINT) AS n FROM embeddings GROUP BY 1")
def embedding_dims(spark, sf):
    return table(spark, sf, "embeddings").groupBy(n(F.size("embedding")).alias("dimension")).agg(F.count("*").alias("n"))


@book.add(f"WITH {SEGMENTS_SQL} SELECT episode_id, segment_index, '[SEGMENT: s' || segment_index || '] [EPISODE: ' || episode_id || '] [TIME: ' || printf('%.1f', start_time) || '-' || printf('%.1f', start_time + word_count * 60 / 150.0) || 's] [SPEAKER: ' || speaker || '] ' || trim(regexp_replace(text, '\\s+', ' ', 'g')) AS enriched, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS clean, 's' || segment_index AS segment, speaker FROM seg")
def enriched_segments(spark, sf):
    s = segments(table(spark, sf, "conversations"))
    e = s.withColumn("enriched", S.enriched(F.col("text"), F.concat(F.lit("s"), F.col("segment_index").cast("string")), F.col("episode_id").cast("string"), F.col("start_time"), F.col("end_time"), F.col("speaker")))
    m = S.markers(F.col("enriched"))
    return e.select("episode_id", "segment_index", "enriched", m["clean"].alias("clean"), m["segment"].alias("segment"), m["speaker"].alias("speaker"))


@book.add(f"WITH d AS (SELECT doc_id, text FROM documents), b AS (SELECT item_id, text AS q, {sql_words()} AS w FROM benchmark), p AS (SELECT doc_id, item_id FROM d JOIN b ON contains(d.text, b.q)) SELECT item_id, CAST(count(doc_id) AS BIGINT) AS sources FROM b LEFT JOIN p USING (item_id) GROUP BY 1")
def quote_sources(spark, sf):
    """In how many texts each quote stands word for word; the quotes are the small side and are counted first."""
    from convograph.operators.mentions import mentions

    d = table(spark, sf, "documents").select("doc_id", "text")
    b = table(spark, sf, "benchmark").select("item_id", F.col("text").alias("name"))
    hits = mentions(d, b).where(F.contains("text", F.col("name")))
    return b.join(hits.groupBy("item_id").agg(F.count("*").alias("k")), "item_id", "left").select("item_id", F.coalesce("k", F.lit(0)).alias("sources"))


@book.add("SELECT c_custkey, 'c-' || c_custkey AS id, r_name AS region, CAST(count(o_orderkey) AS BIGINT) AS orders, round(coalesce(sum(o_totalprice), 0), 2) AS spent FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL")
def linked_customers(spark, sf):
    t = lambda name: table(spark, sf, name)
    o = t("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("orders"), F.sum("o_totalprice").alias("spent"))
    c = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).join(o, "c_custkey", "left")
    return c.select("c_custkey", F.concat(F.lit("c-"), F.col("c_custkey").cast("string")).alias("id"), F.col("r_name").alias("region"), F.coalesce("orders", F.lit(0)).alias("orders"), F.round(F.coalesce("spent", F.lit(0.0)), 2).alias("spent"))


QUERIES, SQL = book.queries, book.sql
__all__ = ["QUERIES", "SQL", "T", "r6"]
