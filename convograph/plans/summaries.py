"""Queries over summaries of episodes' flow and of runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from convograph.operators import mentions as M
from convograph.operators import summaries as S
from convograph.plans.base import Book, n, r6, table
from convograph.plans.flow import KIND, SETS, TIMELINE, concept_lifecycle, concept_momentum, discourse_patterns, flow_patterns, narrative_arcs, parts, patterns_of, totals
from convograph.plans.flow import SQL as FLOW_SQL
from convograph.sources.adapters import MENTIONS_SQL
from convograph.workers import written

book = Book()


def inner(name: str) -> str:
    """The SQL of a flow query as a table expression."""
    return f"({FLOW_SQL[name]})"


@book.add(f"WITH {MENTIONS_SQL}, g AS (SELECT episode_id, entity_id, count(*) AS n, max(segment_index) - min(segment_index) + 1 AS span FROM men GROUP BY 1, 2 HAVING count(*) > 2) SELECT episode_id, round(avg((span > 4)::INT), 6) AS share FROM g GROUP BY 1")
def closing_concepts(spark, sf):
    return S.closing(parts(spark, sf)[1]).withColumn("share", r6(F.col("share")))


def scores(patterns, found):
    p = patterns.join(S.closing(found), "episode_id", "left")
    return p.select("episode_id", F.col("linear").alias("linear_progression"), F.col("hub").alias("hub_and_spoke"), F.col("parallel").alias("parallel_development"), "convergence", r6(F.coalesce("share", F.lit(0.0))).alias("circular"))


CLOSING = f"(WITH {MENTIONS_SQL}, g AS (SELECT episode_id, entity_id, max(segment_index) - min(segment_index) + 1 AS span FROM men GROUP BY 1, 2 HAVING count(*) > 2) SELECT episode_id, round(avg((span > 4)::INT), 6) AS share FROM g GROUP BY 1)"
REPORTED = f"""(SELECT episode_id, unnest(['linear_progression', 'hub_and_spoke', 'parallel_development', 'convergence', 'circular']) AS pattern_type, unnest([linear::DOUBLE, hub::DOUBLE, parallel::DOUBLE, convergence::DOUBLE, coalesce(share, 0)::DOUBLE]) AS confidence, unnest([0.6::DOUBLE, 0.5, 0.6, 0.5, 0.5]) AS least FROM {inner('discourse_patterns')} d LEFT JOIN {CLOSING} c USING (episode_id))"""


@book.add(f"SELECT episode_id, pattern_type, round(confidence, 6) AS confidence FROM {REPORTED} WHERE confidence > least")
def reported_patterns(spark, sf):
    return S.reported(scores(discourse_patterns(spark, sf), parts(spark, sf)[1])).withColumn("confidence", r6(F.col("confidence")))


def pieces(spark, sf):
    """Introductions, transitions, resolutions and returns; a concept of several mentions ends as its last one does."""
    s, m = parts(spark, sf)
    t = M.timeline(m, totals(s))
    first = t.where("mention_type = 'introduction'").select("episode_id", "entity_id", "segment_index")
    last = t.groupBy("episode_id", "entity_id").agg(F.max_by("mention_type", "segment_index").alias("kind"), F.max("segment_index").alias("segment_index"))
    res = last.select("episode_id", "entity_id", "segment_index", F.when(F.col("kind") == "conclusion", "answered").when(F.col("kind") == "callback", "partial").when(F.col("kind") == "introduction", "abandoned").otherwise("deferred").alias("resolution_type"))
    return s, m, first, M.transitions(s, m), res, M.circular(m, gap=1)


RESOLUTION = "CASE kind WHEN 'conclusion' THEN 'answered' WHEN 'callback' THEN 'partial' WHEN 'introduction' THEN 'abandoned' ELSE 'deferred' END"
PIECES = TIMELINE + ", " + SETS[len(MENTIONS_SQL) + 2 :] + f""", trn AS (SELECT episode_id, segment_index, {KIND} AS kind, CASE WHEN x = 0 OR y = 0 THEN 0.5 ELSE b / (x + y - b) END AS smoothness FROM tr),
res AS (SELECT episode_id, entity_id, segment_index, {RESOLUTION} AS resolution_type FROM (SELECT episode_id, entity_id, arg_max(mention_type, segment_index) AS kind, max(segment_index) AS segment_index FROM tl GROUP BY 1, 2)),
ret AS (SELECT episode_id, entity_id, total - n + 1 >= 2 AS closure FROM (SELECT episode_id, entity_id, row_number() OVER w AS n, count(*) OVER (PARTITION BY episode_id, entity_id) AS total, segment_index - lag(segment_index) OVER w AS gap FROM men WINDOW w AS (PARTITION BY episode_id, entity_id ORDER BY segment_index)) WHERE gap > 1),
eps AS (SELECT DISTINCT episode_id FROM tl), coh AS (SELECT episode_id, list_avg(list_filter([(SELECT avg(smoothness) FROM trn WHERE trn.episode_id = eps.episode_id)::DOUBLE, (SELECT avg((resolution_type IN ('answered', 'partial'))::INT) FROM res WHERE res.episode_id = eps.episode_id)::DOUBLE, (SELECT avg(closure::INT) FROM ret WHERE ret.episode_id = eps.episode_id)::DOUBLE], lambda x: x IS NOT NULL)) AS coherence FROM eps)"""


@book.add(f"""WITH {PIECES}, rough AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY episode_id ORDER BY segment_index) AS rn FROM trn WHERE kind = 'pivot' OR smoothness < 0.5) WHERE rn <= 5)
SELECT episode_id, coalesce((SELECT array_to_string(list_sort(list(entity_id)), ',') FROM tl WHERE tl.episode_id = eps.episode_id AND mention_type = 'introduction' AND segment_index < 3), '') AS opening, coalesce((SELECT array_to_string(list_sort(list(segment_index)), ',') FROM rough WHERE rough.episode_id = eps.episode_id), '') AS transitions,
 coalesce((SELECT array_to_string(list_sort(list(entity_id)), ',') FROM res WHERE res.episode_id = eps.episode_id AND resolution_type IN ('abandoned', 'deferred')), '') AS unresolved, coalesce((SELECT array_to_string(list_sort(list(DISTINCT entity_id)), ',') FROM ret WHERE ret.episode_id = eps.episode_id AND closure), '') AS circular,
 coalesce(f.flow_pattern, 'unknown') AS flow_pattern, round(coherence, 6) AS coherence FROM eps JOIN coh USING (episode_id) LEFT JOIN {inner('flow_patterns')} f USING (episode_id)""")
def episode_flow_summaries(spark, sf):
    _, _, first, trn, res, ret = pieces(spark, sf)
    d = S.flow_summary(first, trn, res, ret, flow_patterns(spark, sf))
    text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    return d.select("episode_id", text("opening_concepts").alias("opening"), text("key_transitions").alias("transitions"), text("unresolved_threads").alias("unresolved"), text("circular_themes").alias("circular"), "flow_pattern", r6(F.col("coherence")).alias("coherence"))


@book.add(f"""WITH {PIECES}, f AS (SELECT episode_id, segment_index, [CASE WHEN EXISTS (SELECT 1 FROM tl WHERE tl.episode_id = seg.episode_id AND tl.segment_index = seg.segment_index AND mention_type = 'introduction') THEN 1.0::DOUBLE END, CASE WHEN EXISTS (SELECT 1 FROM trn WHERE trn.episode_id = seg.episode_id AND trn.segment_index = seg.segment_index AND kind = 'pivot') THEN 0.8::DOUBLE END,
 CASE WHEN EXISTS (SELECT 1 FROM res WHERE res.episode_id = seg.episode_id AND res.segment_index = seg.segment_index) THEN 0.9::DOUBLE END, CASE WHEN (SELECT count(DISTINCT entity_id) FROM men WHERE men.episode_id = seg.episode_id AND men.segment_index = seg.segment_index) >= 4 THEN 0.7::DOUBLE END, CASE WHEN word_count > 80 THEN 0.8::DOUBLE END] AS x FROM seg)
SELECT episode_id, segment_index, round(coalesce(list_avg(list_filter(x, lambda v: v IS NOT NULL)), 0.3), 6) AS importance FROM f""")
def segment_flow_importance(spark, sf):
    """Segments of four concepts or more bridge, long ones turn."""
    s, m, first, trn, res, _ = pieces(spark, sf)
    bridges = m.groupBy("episode_id", "segment_index").agg(F.countDistinct("entity_id").alias("k")).where("k >= 4")
    return S.segment_importance(s, first, trn, res, bridges, s.where("word_count > 80")).withColumn("importance", r6(F.col("importance")))


@book.add(f"""WITH {MENTIONS_SQL}, k AS (SELECT episode_id, entity_id, count(*) AS k FROM men GROUP BY 1, 2), m AS (SELECT episode_id, entity_id, avg(momentum) AS momentum FROM {inner('concept_momentum')} GROUP BY 1, 2)
SELECT episode_id, entity_id, l.pattern AS lifecycle, round(m.momentum, 4) AS momentum, CASE l.pattern WHEN 'introduce-develop-conclude' THEN 'main_theme' WHEN 'recurring-theme' THEN 'connecting_thread' WHEN 'brief-mention' THEN 'supporting_detail' ELSE CASE WHEN k.k >= 4 THEN 'central_concept' ELSE 'participant' END END AS role
FROM {inner('concept_lifecycle')} l JOIN m USING (episode_id, entity_id) JOIN k USING (episode_id, entity_id)""")
def entity_flow_roles(spark, sf):
    m = parts(spark, sf)[1]
    g = m.groupBy("episode_id", "entity_id").agg(F.count("*").alias("k"))
    d = S.with_flow(g.select("episode_id", "entity_id"), concept_lifecycle(spark, sf), concept_momentum(spark, sf), g.where("k >= 4"))
    return d.select("episode_id", "entity_id", "lifecycle", F.round("momentum", 4).alias("momentum"), "role")


@book.add(f"""WITH {PIECES}, p AS (SELECT episode_id, entity_id, segment_index, n_segments, CASE mention_type WHEN 'development' THEN 'elaboration' ELSE mention_type END AS phase FROM tl), q AS (SELECT *, (phase <> coalesce(lag(phase) OVER (PARTITION BY episode_id, entity_id ORDER BY segment_index), '')) AS new FROM p),
g AS (SELECT episode_id, entity_id, min(segment_index) AS f, count(*) FILTER (WHERE new) AS ph, list(segment_index ORDER BY segment_index) FILTER (WHERE phase = 'elaboration') AS e, max(n_segments) AS ns FROM q GROUP BY 1, 2)
SELECT episode_id, entity_id, round(f / ns, 6) AS introduction, ph * 10.0::DOUBLE AS duration, round(coalesce(e[len(e) // 2 + 1], 0) / ns, 6) AS peak, resolution_type AS resolution FROM g JOIN res USING (episode_id, entity_id)""")
def entity_flow_positions(spark, sf):
    s, m, _, _, res, _ = pieces(spark, sf)
    t = M.timeline(m, totals(s))
    p = t.select("episode_id", "entity_id", "segment_index", F.when(F.col("mention_type") == "development", "elaboration").otherwise(F.col("mention_type")).alias("phase"))
    d = S.positions(p, res, totals(s))
    return d.withColumns({c: r6(F.col(c)) for c in ("introduction", "peak")})


@book.add(f"""WITH {PIECES}, p AS (SELECT episode_id, arg_max(pattern_type, (confidence, pattern_type)) AS pt, max(confidence) AS c FROM {REPORTED} WHERE confidence > least GROUP BY 1), v AS (SELECT episode_id, count(*) FILTER (WHERE kind = 'pivot') AS pivots FROM trn GROUP BY 1), l AS (SELECT episode_id, count(*) FILTER (WHERE pattern = 'introduce-develop-conclude') AS f FROM {inner('concept_lifecycle')} GROUP BY 1)
SELECT a.episode_id, array_to_string(list_filter([CASE WHEN pt IS NOT NULL THEN 'The discussion follows a ' || replace(pt, '_', ' ') || ' pattern (' || CAST(round(c * 100) AS INT) || '% confidence).' END, CASE WHEN debate > 0.5 THEN 'The narrative structure is primarily a debate arc, with ' || resolution || ' resolution.' ELSE 'The narrative structure is primarily a problem solution arc, with ' || resolution || ' resolution.' END, CASE WHEN pivots > 0 THEN 'The conversation includes ' || pivots || ' major topic shifts.' END, CASE WHEN f > 0 THEN f || ' concepts are fully developed from introduction to conclusion.' END], lambda x: x IS NOT NULL), ' ') AS summary
FROM {inner('narrative_arcs')} a LEFT JOIN p USING (episode_id) LEFT JOIN v USING (episode_id) LEFT JOIN l USING (episode_id)""")
def flow_texts(spark, sf):
    arcs = narrative_arcs(spark, sf).select("episode_id", F.when(F.col("debate") > 0.5, "debate").otherwise("problem_solution").alias("arc"), "resolution")
    s, m = parts(spark, sf)
    # mentions are found once, written without texts and read by each part
    t = written(M.timeline(m, totals(s)).select("episode_id", "entity_id", "pos", "segment_index", "n_segments", "mention_type", "density"))
    return S.flow_text(S.reported(scores(patterns_of(t), t)), arcs, M.transitions(s, t), M.lifecycle(t))


@book.add(f"WITH {MENTIONS_SQL}, e AS (SELECT episode_id, count(*) AS e, list_sort(list(DISTINCT entity_type)) AS t FROM men GROUP BY 1), r AS (SELECT episode_id, count(*) AS r FROM seg GROUP BY 1) SELECT episode_id, CAST(coalesce(e, 0) AS BIGINT) AS entities, CAST(r AS BIGINT) AS relationships, coalesce(array_to_string(t, ','), '') AS types FROM r LEFT JOIN e USING (episode_id)")
def schemaless_counts(spark, sf):
    s, m = parts(spark, sf)
    d = S.per_episode(m.select("episode_id", F.col("entity_type").alias("type")), s.select("episode_id"))
    return d.withColumn("types", F.array_join("types", ","))


@book.add("WITH e AS (SELECT source, count(*) AS n, list_distinct(list(lang)) AS t, bool_or(lang IS NULL) AS failed FROM documents GROUP BY source, doc_id % 7) SELECT CAST(count(DISTINCT source) AS BIGINT) AS sources, CAST(count(*) AS BIGINT) AS episodes, CAST(count(*) FILTER (WHERE failed) AS BIGINT) AS failed, CAST(sum(n) AS BIGINT) AS entities, CAST(sum(n * 2) AS BIGINT) AS relationships, array_to_string(list_sort(list_distinct(flatten(list(t)))), ',') AS types FROM e")
def run_summary(spark, sf):
    d = table(spark, sf, "documents").groupBy("source", F.col("doc_id") % 7).agg(F.count("*").alias("entities"), F.collect_set("lang").alias("types"), F.max(F.col("lang").isNull()).alias("failed"))
    return S.run_summary(d.select("source", "entities", (F.col("entities") * 2).alias("relationships"), "types", "failed")).withColumn("types", F.array_join("types", ","))


@book.add(f"WITH {MENTIONS_SQL}, f AS (SELECT episode_id, count(DISTINCT entity_id) AS f FROM men WHERE entity_type = 'concept' GROUP BY 1), s AS (SELECT episode_id, count(*) AS s FROM men GROUP BY 1) SELECT episode_id, CAST(coalesce(f, 0) AS BIGINT) AS fixed, CAST(coalesce(s, 0) AS BIGINT) AS schemaless, CAST(coalesce(s, 0) - coalesce(f, 0) AS BIGINT) AS difference FROM f FULL JOIN s USING (episode_id)")
def side_by_side(spark, sf):
    m = parts(spark, sf)[1]
    fixed = m.where("entity_type = 'concept'").groupBy("episode_id").agg(F.countDistinct("entity_id").alias("entities"))
    return S.side_by_side(fixed, m.groupBy("episode_id").agg(F.count("*").alias("entities")))


@book.add("SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_orderkey % 4 DESC, o_orderkey) - 1 AS BIGINT) AS place, CAST((row_number() OVER (ORDER BY o_orderkey % 4 DESC, o_orderkey) - 1) // 10 AS BIGINT) AS batch FROM orders")
def priority_batches(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", (F.col("o_orderkey") % 4).alias("p"))
    return S.in_priority(o, "p", "o_orderkey", 10).select("o_orderkey", n(F.col("place")).alias("place"), n(F.col("batch")).alias("batch"))


@book.add("SELECT event_type AS type, array_to_string(list_sort(list(DISTINCT k)), ',') AS properties, CAST(count(DISTINCT event_id) AS BIGINT) AS nodes FROM (SELECT event_id, event_type, unnest(['k', 'p' || event_id % 3]) AS k FROM events) GROUP BY 1")
def evolution_report(spark, sf):
    i = F.col("event_id")
    e = table(spark, sf, "events").select(F.col("event_type").alias("type"), F.create_map(F.lit("k"), F.lit("v"), F.concat(F.lit("p"), (i % 3).cast("string")), F.lit("v")).alias("props"))
    return S.discovered(e).withColumn("properties", F.array_join("properties", ","))


QUERIES, SQL = book.queries, book.sql
__all__ = ["QUERIES", "SQL"]
