"""Queries over entities: matching, merging, validation, importance."""

from __future__ import annotations

from pyspark.sql import functions as F

from convograph.functions import lexicons as L
from convograph.functions import text as T
from convograph.operators import entities as E
from convograph.operators import mentions as M
from convograph.operators import store as S
from convograph.operators.names import greedy_resolve
from convograph.plans.base import Book, n, quote, r6, table
from convograph.sources.adapters import MENTIONS_SQL, SEGMENTS_SQL, concepts, segments

book = Book()
NAMES = ["AI", "ai", "Artificial Intelligence", "ML", "machine learning", "Machine Learning", "CEO", "Chief Executive Officer", "child", "children", "system", "systems", "NASA", "Solid State Drive", "SSD", "nothing alike"]
#: Names dealt over events by id, so that every name has many occurrences.
DEALT_SQL = "nm AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, {quote(x)})" for i, x in enumerate(NAMES)) + f") t(i, name)), ent AS (SELECT event_id AS pos, name, CASE WHEN event_id % 3 = 0 THEN 'ORG' ELSE 'org' END AS type, (event_id % 10) / 10.0::DOUBLE AS confidence FROM events JOIN nm ON nm.i = event_id % {len(NAMES)})"


def dealt(spark, sf):
    name = F.element_at(F.array(*[F.lit(x) for x in NAMES]), (F.col("event_id") % len(NAMES) + 1).cast("int"))
    return table(spark, sf, "events").select(F.col("event_id").alias("pos"), name.alias("name"), F.when(F.col("event_id") % 3 == 0, "ORG").otherwise("org").alias("type"), ((F.col("event_id") % 10) / 10).alias("confidence"))


FOUND = {("AI", "Artificial Intelligence"): ("alias", 0.9), ("AI", "ai"): ("case", 0.95), ("Artificial Intelligence", "ai"): ("alias", 0.9), ("ML", "Machine Learning"): ("alias", 0.9), ("ML", "machine learning"): ("alias", 0.9), ("Machine Learning", "machine learning"): ("case", 0.95), ("CEO", "Chief Executive Officer"): ("abbreviation", 0.9), ("child", "children"): ("singular_plural", 0.9), ("system", "systems"): ("singular_plural", 0.9), ("SSD", "Solid State Drive"): ("alias", 0.9)}


@book.add("SELECT * FROM (VALUES " + ", ".join(f"({quote(a)}, {quote(b)}, {quote(k)}, {c}::DOUBLE)" for (a, b), (k, c) in FOUND.items()) + ") t(a, b, kind, confidence)")
def entity_match_cascade(spark, sf):
    """The expected pairs are listed by hand from the rules."""
    return E.matches(dealt(spark, sf))


CLUSTERS = [["AI", "Artificial Intelligence", "ai"], ["ML", "Machine Learning", "machine learning"], ["CEO", "Chief Executive Officer"], ["child", "children"], ["system", "systems"], ["SSD", "Solid State Drive"], ["NASA"], ["nothing alike"]]


@book.add(f"WITH {DEALT_SQL}, cl AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, {quote(x)})" for i, c in enumerate(CLUSTERS) for x in c) + ") t(cluster, name)), g AS (SELECT cluster, name, count(*) AS n FROM ent JOIN cl USING (name) GROUP BY 1, 2), h AS (SELECT cluster, arg_max(name, (n, length(name), name)) AS canonical, list_sort(list(name)) AS names, sum(n) AS occurrences FROM g GROUP BY 1) SELECT canonical, array_to_string(list_filter(names, lambda x: x <> canonical), ',') AS aliases, CAST(occurrences AS BIGINT) AS occurrences FROM h")
def canonical_merge(spark, sf):
    return E.resolve(dealt(spark, sf)).select("canonical", F.array_join("aliases", ",").alias("aliases"), "occurrences")


@book.add(f"WITH {DEALT_SQL} SELECT lower(trim(name)) AS key, upper(type) AS type, arg_min(name, pos) AS name, max(confidence) AS confidence, CAST(count(*) AS BIGINT) AS mentions FROM ent GROUP BY 1, 2")
def merged_entities(spark, sf):
    return E.merged_by_name(dealt(spark, sf))


@book.add()
def name_similarity(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", E.similarity(F.lower("p_name"), F.lower("p_type")).alias("s"))
    return p.select("p_partkey", r6(F.col("s")).alias("similarity"))


@book.add()
def greedy_resolution(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_brand").alias("brand"), F.col("p_partkey").alias("pos"), F.col("p_name").alias("name"))
    return greedy_resolve(p, "brand")


@book.add("""WITH b AS (SELECT item_id, text AS q FROM benchmark), d AS (SELECT doc_id, text AS t FROM documents WHERE lang IS NOT NULL), w AS (SELECT item_id, q, list_filter(regexp_split_to_array(lower(q), '\\s+'), lambda x: x <> '') AS w FROM b)
SELECT l.doc_id, item_id, CASE WHEN len(w) > 3 THEN len(list_filter(w, lambda x: contains(lower(t), x))) / len(w) >= 0.7 ELSE contains(lower(t), lower(trim(q))) END AS supported FROM labels l JOIN d ON d.doc_id = l.doc_id JOIN w ON w.item_id = l.doc_id % 40""")
def quote_validation(spark, sf):
    """Each labelled document against the item its id names."""
    d = table(spark, sf, "documents").where("lang is not null").select("doc_id", F.col("text").alias("t")).join(table(spark, sf, "labels").select("doc_id"), "doc_id")
    b = table(spark, sf, "benchmark").select("item_id", F.col("text").alias("q"))
    return d.withColumn("item_id", F.col("doc_id") % 40).join(b, "item_id").select("doc_id", "item_id", E.supported(F.col("q"), F.col("t")).alias("supported"))


@book.add(f"""WITH {MENTIONS_SQL}, t AS (SELECT episode_id, count(*) AS ns, max(start_time + word_count * 60 / 150.0::DOUBLE) AS total FROM seg GROUP BY 1), g AS (SELECT episode_id, entity_id, count(*) AS k, max(total) AS total, count(*) FILTER (WHERE segment_index <= floor(0.2 * ns)) / count(*) AS intro, count(*) FILTER (WHERE segment_index >= floor(0.8 * ns)) / count(*) AS concl, least(1.0, count(*) / max(ns) * 2) AS spread, CASE WHEN count(*) > 1 THEN least(1.0, (max(segment_index) - min(segment_index)) / (count(*) - 1) / greatest(1, max(ns) * 0.1)) ELSE 0 END AS bridge FROM men JOIN t USING (episode_id) GROUP BY 1, 2),
f AS (SELECT *, CASE WHEN total > 0 THEN least(1.0, greatest(0, ln(1 + k / (total / 60)) / ln(1 + k))) ELSE 0 END AS frequency FROM g), c AS (SELECT *, least(1.0, greatest(0, frequency * 0.15::DOUBLE + (intro + concl + spread + bridge) / 4 * 0.20::DOUBLE)) AS importance FROM f)
SELECT episode_id, entity_id, round(frequency, 6) AS frequency, round(bridge, 6)::DOUBLE AS bridge, round(importance, 6) AS importance, CAST(rank AS BIGINT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY episode_id ORDER BY round(importance, 9) DESC, entity_id) AS rank FROM c) WHERE rank <= 5""")
def importance_factors(spark, sf):
    s = segments(table(spark, sf, "conversations"))
    t = s.groupBy("episode_id").agg(F.count("*").alias("ns"), F.max("end_time").alias("total"))
    i, ns = F.col("segment_index"), F.col("ns")
    g = M.mentions(s, concepts(table(spark, sf, "documents"))).join(t, "episode_id").groupBy("episode_id", "entity_id").agg(F.count("*").alias("k"), F.max("total").alias("total"), F.avg((i <= F.floor(ns * 0.2)).cast("double")).alias("intro"), F.avg((i >= F.floor(ns * 0.8)).cast("double")).alias("concl"), F.least(F.lit(1.0), F.count("*") / F.max("ns") * 2).alias("spread"), E.bridge_role(F.count("*"), F.max(i) - F.min(i), F.max("ns")).alias("bridge"))
    g = g.withColumn("frequency", E.frequency_factor(F.col("k"), F.col("total")))
    g = g.withColumn("importance", E.importance({"frequency": F.col("frequency"), "discourse_function": (F.col("intro") + F.col("concl") + F.col("spread") + F.col("bridge")) / 4}))
    return E.top_by(g, ["episode_id"], [F.desc(F.round("importance", 9)), F.col("entity_id")], 5).select("episode_id", "entity_id", r6(F.col("frequency")).alias("frequency"), r6(F.col("bridge")).alias("bridge"), r6(F.col("importance")).alias("importance"), n(F.col("rank")).alias("rank"))


@book.add("SELECT n_nationkey, r_regionkey, CASE WHEN n_nationkey % 3 = 0 AND r_regionkey % 2 = 0 THEN 'AFFILIATED_WITH' WHEN n_nationkey % 3 = 1 AND r_regionkey % 2 = 0 THEN 'USES' ELSE 'RELATED_TO' END AS relation FROM nation JOIN region ON n_regionkey = r_regionkey")
def relationship_types(spark, sf):
    j = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    a = F.when(F.col("n_nationkey") % 3 == 0, "person").when(F.col("n_nationkey") % 3 == 1, "technology").otherwise("concept")
    b = F.when(F.col("r_regionkey") % 2 == 0, "organization").otherwise("place")
    return j.select("n_nationkey", "r_regionkey", S.relationship(a, b, {("organization", "person"): "AFFILIATED_WITH", ("organization", "technology"): "USES"}).alias("relation"))


INSIGHTS = " ".join(f"WHEN {'(' + ' OR '.join(f'contains(lower(text), {quote(p)})' for p in ps) + ')'} THEN {quote(k)}" for k, ps in {**L.PATTERN_KEYWORDS, "test": ["tion"]}.items())


@book.add(f"WITH {SEGMENTS_SQL}, k AS (SELECT CASE {INSIGHTS} ELSE 'none' END AS pattern FROM seg) SELECT pattern, CAST(count(*) AS BIGINT) AS segments FROM k GROUP BY 1")
def cross_cluster_patterns(spark, sf):
    low, out = F.lower("text"), F.lit("none")
    for k, ps in reversed({**L.PATTERN_KEYWORDS, "test": ["tion"]}.items()):
        out = F.when(T.has_any(low, ps), k).otherwise(out)
    return segments(table(spark, sf, "conversations")).groupBy(out.alias("pattern")).agg(F.count("*").alias("segments"))


@book.add(f"WITH {DEALT_SQL}, i AS (SELECT pos, name || ': ' || name AS content, confidence * 2 - 0.5 AS c FROM ent WHERE length(name || ': ' || name) >= 10) SELECT pos, split_part(content, ':', 1) AS title, trim(split_part(content, ':', 2)) AS description, round(greatest(0, least(1, c)), 6) AS confidence FROM i")
def validated_insights(spark, sf):
    d = dealt(spark, sf).select("pos", F.concat("name", F.lit(": "), "name").alias("content"), (F.col("confidence") * 2 - 0.5).alias("c")).where("length(content) >= 10")
    p = F.split("content", ":", 2)
    return d.select("pos", F.get(p, F.lit(0)).alias("title"), F.trim(F.get(p, F.lit(1))).alias("description"), r6(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("c")))).alias("confidence"))


@book.add("SELECT p_partkey, 16 AS dimension, substr(md5(p_name), 1, 2) AS head FROM part")
def mock_embeddings(spark, sf):
    p = table(spark, sf, "part").withColumn("e", E.mock_embedding(F.col("p_name")))
    first = (F.get("e", F.lit(0)) * 0).isNotNull()
    return p.select("p_partkey", F.when(first, F.size("e")).cast("int").alias("dimension"), F.substring(F.md5("p_name"), 1, 2).alias("head"))


QUERIES, SQL = book.queries, book.sql
