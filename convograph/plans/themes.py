"""Queries over emergent themes."""

from __future__ import annotations

from pyspark.sql import functions as F

from convograph.functions import lexicons as L
from convograph.operators import themes as H
from convograph.plans.base import Book, listed, n, quote, r6, table
from convograph.sources.adapters import SEGMENTS_SQL, segments

book = Book()
TOPICS = ["economy brass", "the STANDARD", "growth"]

#: Ten themes to an episode, made of the parts; the last ones have narrower lists of concepts.
THEMES_SQL = f"""th AS (SELECT p_partkey // 10 AS episode_id, p_partkey AS theme, p_type || CASE p_partkey % 7 WHEN 0 THEN ' system' WHEN 1 THEN ' good growth' WHEN 2 THEN ' risk' ELSE '' END AS field,
 list_transform(range(1, 2 + p_partkey % 10 + p_partkey % 3), lambda i: 'c' || i * (1 + p_partkey % 2)) AS concepts, CASE WHEN p_partkey % 4 > 0 THEN p_partkey % 15 END AS segments, CASE p_partkey % 5 WHEN 0 THEN 'emergence' WHEN 1 THEN 'tension' WHEN 2 THEN 'synthesis' END AS pattern_type,
 p_partkey % 6 = 0 AS named, CASE WHEN p_partkey % 3 = 0 THEN 'war' END AS metaphor, CASE p_partkey % 4 WHEN 0 THEN 'crescendo' WHEN 1 THEN 'steady' END AS evolution, (p_partkey % 10) / 10.0::DOUBLE AS validation, CASE WHEN p_partkey % 8 > 0 THEN (p_partkey % 9) / 8.0::DOUBLE END AS confidence FROM part),
tm AS (SELECT *, list_filter(string_split(lower(field), ' '), lambda t: t <> '') AS terms FROM th),
em AS (SELECT *, list_avg(list_filter([1 - len(list_filter(terms, lambda t: len(list_filter({listed([t.lower() for t in TOPICS])}, lambda x: contains(x, t))) > 0)) / len(terms), CASE WHEN segments IS NOT NULL THEN least(segments / 10, 1.0::DOUBLE) END, CASE WHEN pattern_type IN ('emergence', 'synthesis') THEN 0.9 ELSE 0.5 END::DOUBLE, CASE WHEN named THEN 0 ELSE 1 END::DOUBLE], lambda x: x IS NOT NULL)) AS emergence,
 list_avg(list_filter([least(len(concepts) / 20, 1.0::DOUBLE), CASE WHEN segments > 0 THEN least(segments / 10, 1.0::DOUBLE) END, CASE WHEN contains(lower(field), 'system') THEN 0.8 ELSE 0.4 END::DOUBLE, CASE WHEN pattern_type IN ('emergence', 'synthesis') THEN 0.9 ELSE 0.5 END::DOUBLE], lambda x: x IS NOT NULL)) AS scope FROM tm),
rk AS (SELECT *, row_number() OVER (PARTITION BY episode_id ORDER BY round(emergence * coalesce(confidence, 0.5), 9) DESC, theme) AS rank FROM em)"""


def made(spark, sf):
    k = F.col("p_partkey")
    t = table(spark, sf, "part").select(
        F.floor(k / 10).alias("episode_id"), k.alias("theme"), F.concat("p_type", F.when(k % 7 == 0, " system").when(k % 7 == 1, " good growth").when(k % 7 == 2, " risk").otherwise("")).alias("field"),
        F.transform(F.sequence(F.lit(1).cast("long"), 1 + k % 10 + k % 3), lambda i: F.concat(F.lit("c"), (i * (1 + k % 2)).cast("string"))).alias("concepts"), F.when(k % 4 > 0, k % 15).alias("segments"),
        F.when(k % 5 == 0, "emergence").when(k % 5 == 1, "tension").when(k % 5 == 2, "synthesis").alias("pattern_type"), (k % 6 == 0).alias("named"), F.when(k % 3 == 0, "war").alias("metaphor"),
        F.when(k % 4 == 0, "crescendo").when(k % 4 == 1, "steady").alias("evolution"), ((k % 10) / 10).alias("validation"), F.when(k % 8 > 0, (k % 9) / 8).alias("confidence"),
    )
    return H.detect(t, TOPICS)


@book.add(f"""WITH {THEMES_SQL}, u AS (SELECT episode_id, theme, scope, len(concepts) AS size, unnest(concepts) AS c FROM em), l AS (SELECT a.episode_id, a.theme, b.theme AS up, b.scope AS up_scope FROM u a JOIN u b ON a.episode_id = b.episode_id AND a.c = b.c AND a.theme <> b.theme GROUP BY 1, 2, 3, 4, a.size HAVING count(*) > a.size * 0.7)
SELECT em.theme, round(emergence, 6) AS emergence, round(scope, 6) AS scope, CASE WHEN scope > 0.8 THEN 'meta' WHEN scope > 0.6 THEN 'primary' WHEN scope > 0.4 THEN 'sub' ELSE 'micro' END AS level,
 (SELECT arg_min(up, (up_scope, -up)) FROM l WHERE l.theme = em.theme) AS parent, coalesce((SELECT array_to_string(list_sort(list(l.theme)), ',') FROM l WHERE l.up = em.theme), '') AS children FROM em""")
def theme_hierarchy(spark, sf):
    return made(spark, sf).select("theme", r6(F.col("emergence")).alias("emergence"), r6(F.col("scope")).alias("scope"), "level", "parent", F.array_join("children", ",").alias("children"))


SAID = L.THEME_SENTENCES


@book.add(f"""WITH {THEMES_SQL} SELECT episode_id, CAST(rank AS BIGINT) AS rank, field AS theme, round(emergence, 6) AS emergence, array_to_string(concepts[1:5], ',') AS supporting, coalesce(nullif(array_to_string(list_filter([CASE pattern_type WHEN 'emergence' THEN {quote(SAID['emergence'])} WHEN 'tension' THEN {quote(SAID['tension'])} END,
 CASE WHEN metaphor IS NOT NULL THEN {quote(SAID['metaphor'] % 'war')} END, CASE evolution WHEN 'crescendo' THEN {quote(SAID['crescendo'])} WHEN 'steady' THEN {quote(SAID['steady'])} END, CASE WHEN validation > 0.8 THEN {quote(SAID['validated'])} END], lambda x: x IS NOT NULL), '. '), ''), {quote(SAID['none'])}) AS interpretation FROM rk WHERE rank <= 5""")
def major_themes(spark, sf):
    m = H.major(made(spark, sf))
    return m.select("episode_id", n(F.col("rank")).alias("rank"), "theme", r6(F.col("emergence")).alias("emergence"), F.array_join("supporting", ",").alias("supporting"), "interpretation")


TOLD = L.NARRATIVE_PARTS


@book.add(f"""WITH {THEMES_SQL}, g AS (SELECT episode_id, max(field) FILTER (WHERE rank = 1) AS field, bool_or(coalesce(evolution = 'crescendo', false)) FILTER (WHERE rank <= 3) AS up, bool_or(coalesce(evolution = 'steady', false)) FILTER (WHERE rank <= 3) AS even, count(*) AS n, avg(emergence) FILTER (WHERE rank <= 3) AS mean FROM rk GROUP BY 1)
SELECT episode_id, {quote(TOLD['dominant'][:-2])} || field || CASE WHEN up THEN {quote(' ' + TOLD['crescendo'])} WHEN even THEN {quote(' ' + TOLD['steady'])} ELSE '' END || CASE WHEN n > 1 THEN {quote(' ' + TOLD['connected'].split('%d')[0])} || n || {quote(TOLD['connected'].split('%d')[1])} ELSE '' END || CASE WHEN round(mean, 9) > 0.7 THEN {quote(' ' + TOLD['implicit'])} ELSE '' END || '.' AS narrative FROM g""")
def theme_narratives(spark, sf):
    return H.narrative(made(spark, sf))


@book.add(f"""WITH {THEMES_SQL}, c AS (SELECT *, list_concat(concepts, [field]) AS k FROM th), s AS (SELECT *, len(list_filter({listed(L.POSITIVE_INDICATORS)}, lambda w: len(list_filter(k, lambda c: contains(lower(c), w))) > 0)) AS good, len(list_filter({listed(L.NEGATIVE_INDICATORS)}, lambda w: len(list_filter(k, lambda c: contains(lower(c), w))) > 0)) AS bad FROM c),
m AS (SELECT episode_id, 'Optimistic view of ' || field AS message, 0.7::DOUBLE AS confidence FROM s WHERE good > bad * 2 UNION ALL SELECT episode_id, 'Cautionary stance on ' || field, 0.7 FROM s WHERE bad > good * 2 AND NOT good > bad * 2 UNION ALL SELECT episode_id, 'Normative stance on ' || field, confidence FROM s WHERE confidence > 0.7 AND contains(lower(field), 'good'))
SELECT episode_id, message, round(max(confidence), 6) AS confidence FROM m GROUP BY 1, 2""")
def implicit_messages(spark, sf):
    t = made(spark, sf).withColumn("concepts", F.concat("concepts", F.array("field")))
    return H.messages(t).withColumn("confidence", r6(F.col("confidence")))


@book.add("SELECT p_partkey, CASE WHEN p_size >= 5 THEN 'strong ' ELSE 'moderate ' END || CASE p_partkey % 3 " + " ".join(f"WHEN {i} THEN {quote(x)}" for i, x in enumerate((L.METAPHOR_MEANINGS["war"], L.METAPHOR_MEANINGS["game"], L.METAPHOR_DEFAULT))) + " END AS meaning FROM part")
def metaphor_meanings(spark, sf):
    k = F.col("p_partkey") % 3
    return table(spark, sf, "part").select("p_partkey", H.metaphor(F.when(k == 0, "war").when(k == 1, "game").otherwise("sea"), F.col("p_size")).alias("meaning"))


@book.add(f"WITH {SEGMENTS_SQL}, t AS (SELECT DISTINCT episode_id, k AS theme, ['The', 'TION', 'qqq', 'w' || k] AS concepts FROM seg, (VALUES (1), (2)) v(k)), f AS (SELECT s.episode_id, theme, segment_index, list_filter(concepts, lambda c: contains(lower(text), lower(c))) AS c FROM seg s JOIN t USING (episode_id)) SELECT episode_id, theme, segment_index, array_to_string(c, ',') AS concepts, len(c) / 4 AS strength FROM f WHERE len(c) > 0")
def theme_contributions(spark, sf):
    s = segments(table(spark, sf, "conversations"))
    t = s.select("episode_id").distinct().select("episode_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("theme"))
    t = t.withColumn("concepts", F.array(F.lit("The"), F.lit("TION"), F.lit("qqq"), F.concat(F.lit("w"), F.col("theme").cast("string"))))
    return H.contributions(t, s).withColumn("concepts", F.array_join("concepts", ","))


@book.add("WITH e AS (SELECT n_regionkey AS r, CASE WHEN n_regionkey <> 2 THEN c_mktsegment END AS type FROM customer JOIN nation ON n_nationkey = c_nationkey), g AS (SELECT r, type, count(*) AS n FROM e GROUP BY 1, 2) SELECT r AS region, coalesce(lower(arg_min(type, (-n, type))) || ' concepts', 'related concepts') AS description FROM g GROUP BY 1")
def field_descriptions(spark, sf):
    """Fields of customers by region; those of one region have no type."""
    c = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    return H.dominant_kind(c.select(F.col("n_regionkey").alias("region"), F.when(F.col("n_regionkey") != 2, F.col("c_mktsegment")).alias("type")), "region")


QUERIES, SQL = book.queries, book.sql
