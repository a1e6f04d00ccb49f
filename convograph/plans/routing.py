"""Queries over query routing, migrations and their checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from convograph.operators import routing as R
from convograph.operators import storing as S
from convograph.operators.store import Graph
from convograph.plans.base import Book, n, table
from convograph.plans.stores import graph

book = Book()


@book.add("""WITH q AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'MATCH (n:Entity) RETURN COUNT(DISTINCT n)' WHEN 1 THEN 'MATCH (n) WHERE n:Episode RETURN n' WHEN 2 THEN 'MATCH (n:Node) RETURN n' END AS q FROM events)
SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'MATCH (n:Entity) RETURN COUNT(DISTINCT n.id)' WHEN 1 THEN 'MATCH (n) WHERE n._type = "Episode" RETURN n' ELSE q END AS query, event_id % 4 < 2 AS fixed FROM q""")
def special_queries(spark, sf):
    i = F.col("event_id") % 4
    q = F.when(i == 0, "MATCH (n:Entity) RETURN COUNT(DISTINCT n)").when(i == 1, "MATCH (n) WHERE n:Episode RETURN n").when(i == 2, "MATCH (n:Node) RETURN n")
    return table(spark, sf, "events").select("event_id", R.special(q).alias("query"), R.is_fixed(q).alias("fixed"))


@book.add("SELECT 'ask' AS way, CAST(n_nationkey AS VARCHAR) AS id FROM nation WHERE contains(lower(n_name), '_1') UNION ALL SELECT 'typed', CAST(n_nationkey AS VARCHAR) FROM nation UNION ALL SELECT 'generic', CAST(n_nationkey AS VARCHAR) FROM nation")
def routed_queries(spark, sf):
    """One query on both layouts, and a canned question."""
    typed, generic = S.dual(S.nodes(table(spark, sf, "nation"), "Episode", F.col("n_nationkey"), F.col("n_name")), "Episode")
    none = spark.createDataFrame([], "src string, dst string, type string, weight double")
    a, b = Graph(typed, none), Graph(generic, none)
    ask = R.ask(a, "text_search", text="_1").select(F.lit("ask").alias("way"), "id")
    out = ask.unionByName(R.run(a, b, "MATCH (e:Episode) RETURN e", mode="fixed").select(F.lit("typed").alias("way"), "id"))
    return out.unionByName(R.run(a, b, "MATCH (e:Episode) RETURN e").select(F.lit("generic").alias("way"), "id"))


@book.add("WITH e AS (SELECT o_custkey AS c, count(*) AS n FROM orders GROUP BY 1) SELECT 'customer' AS type, CAST(count(*) AS BIGINT) AS n FROM customer UNION ALL SELECT 'nation', count(*) FROM nation UNION ALL SELECT 'order', count(*) FROM orders UNION ALL SELECT 'region', count(*) FROM region")
def canned_counts(spark, sf):
    d = R.ask(graph(spark, sf), "count_by_type")
    return d.select(F.lower("type").alias("type"), "n")


@book.add("SELECT event_id, CASE event_id % 3 WHEN 0 THEN '3' WHEN 1 THEN '2' ELSE '1' END AS version FROM events")
def checkpoint_versions(spark, sf):
    i = F.col("event_id") % 3
    data = F.when(i == 0, '{"version": "3", "extraction_mode": "x"}').when(i == 1, '{"extraction_mode": "x"}').otherwise('{"stage": "a"}')
    return table(spark, sf, "events").select("event_id", R.checkpoint_version(data).alias("version"))


@book.add("WITH v AS (SELECT '1.' || event_id % 3 || '.0' AS version, ts, event_id FROM events) SELECT arg_max(version, (ts, event_id)) AS version, arg_max(version, (ts, event_id)) = '1.1.0' AS complete FROM v")
def migration_complete(spark, sf):
    v = table(spark, sf, "events").select(F.concat(F.lit("1."), (F.col("event_id") % 3).cast("string"), F.lit(".0")).alias("version"), F.struct("ts", "event_id").alias("applied_at"))
    return R.latest_version(v, "1.1.0")


@book.add("SELECT CAST(2 AS BIGINT) AS held, CAST(3 AS BIGINT) AS constraints, false AS ready")
def migration_readiness(spark, sf):
    """Keys of customers and suppliers hold; orders have several a customer."""
    kind = lambda t, c, k: table(spark, sf, t).select(F.lit(k).alias("type"), F.col(c).cast("long").alias("key"))
    rows = kind("customer", "c_custkey", "Customer").unionByName(kind("supplier", "s_suppkey", "Supplier")).unionByName(kind("orders", "o_custkey", "Order"))
    return R.readiness(S.duplicated(rows, {"Customer": ["key"], "Supplier": ["key"], "Order": ["key"]}), least=3)


@book.add("SELECT CAST(s AS BIGINT) AS place, step, CAST(n AS BIGINT) AS n FROM (SELECT 0 AS s, 'region' AS step, (SELECT count(*) FROM region WHERE r_regionkey % 2 = 0) AS n UNION ALL SELECT 1, 'nation', (SELECT count(*) FROM nation) UNION ALL SELECT 2, 'customer', (SELECT count(*) FROM customer))")
def migration_steps(spark, sf):
    """What is left of each step, in the order in which they depend on each other; odd regions are done."""
    ids = lambda t, c: table(spark, sf, t).select(F.col(c).cast("long").alias("id"))
    done = ids("region", "r_regionkey").where("id % 2 = 1").select(F.lit("region").alias("step"), "id")
    steps = R.migration_plan({"customer": (ids("customer", "c_custkey"), ["nation"]), "nation": (ids("nation", "n_nationkey"), ["region"]), "region": (ids("region", "r_regionkey"), [])}, done)
    parts = [rows.agg(F.count("*").alias("n")).select(F.lit(i).cast("long").alias("place"), F.lit(k).alias("step"), "n") for i, (k, rows) in enumerate(steps)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@book.add("SELECT doc_id, CAST(length(text) AS BIGINT) AS \"before\", CAST(length(text) + length('[SEGMENT: s' || doc_id || '] ') + CASE WHEN doc_id % 2 = 0 THEN length('[SPEAKER: x] ') ELSE 0 END AS BIGINT) AS \"after\", CAST(1 + (doc_id + 1) % 2 AS BIGINT) AS markers, CASE WHEN doc_id % 2 = 0 THEN 'SEGMENT,SPEAKER' ELSE 'SEGMENT' END AS kinds FROM documents WHERE text IS NOT NULL AND NOT regexp_matches(text, '\\[[A-Z]+: ')")
def marker_metrics(spark, sf):
    d = table(spark, sf, "documents").where(F.col("text").isNotNull() & ~F.col("text").rlike(r"\[[A-Z]+: "))
    after = F.concat(F.lit("[SEGMENT: s"), F.col("doc_id").cast("string"), F.lit("] "), F.when(F.col("doc_id") % 2 == 0, "[SPEAKER: x] ").otherwise(""), F.col("text"))
    m = R.marker_metrics(F.col("text"), after)
    return d.select("doc_id", n(m["before"]).alias("before"), n(m["after"]).alias("after"), n(m["markers"]).alias("markers"), F.array_join(m["kinds"], ",").alias("kinds"))


@book.add(r"""WITH t AS (SELECT doc_id, text || CASE doc_id % 3 WHEN 0 THEN ' She said "this is quite long" and I think so' ELSE '' END AS t FROM documents WHERE text IS NOT NULL) SELECT doc_id, CAST(len(regexp_extract_all(t, '"[^"]{10,}"')) AS BIGINT) AS quoted, CAST(len(regexp_extract_all(t, '(?i)\b(said|says|told|asked)\b')) AS BIGINT) AS reported, CAST(len(regexp_extract_all(t, '(?i)\bI (think|believe|feel)\b')) AS BIGINT) AS personal FROM t""")
def quote_previews(spark, sf):
    """All texts, some with a quote added."""
    t = F.concat("text", F.when(F.col("doc_id") % 3 == 0, ' She said "this is quite long" and I think so').otherwise(""))
    d = table(spark, sf, "documents").where(F.col("text").isNotNull())
    return d.select("doc_id", *[n(c).alias(k) for k, c in R.quote_preview(t).items()])


@book.add(r"SELECT page_id, array_to_string(regexp_extract_all(url, '[a-z]+\.[a-z]+'), ',') AS found FROM pages")
def found_patterns(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.array_join(R.found(F.col("url"), r"[a-z]+\.[a-z]+"), ",").alias("found"))


QUERIES, SQL = book.queries, book.sql
