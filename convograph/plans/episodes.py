"""Queries over whole episodes."""

from __future__ import annotations

from pyspark.sql import functions as F

from convograph.operators import episodes as P
from convograph.operators import mentions as M
from convograph.plans import texts
from convograph.plans.base import Book, n, r6, table
from convograph.plans.flow import TIMELINE, parts, totals
from convograph.sources.adapters import MENTIONS_SQL, SEGMENTS_SQL, segments

book = Book()


def seg(spark, sf):
    return segments(table(spark, sf, "conversations"))


@book.add(f"""WITH {SEGMENTS_SQL}, s AS (SELECT *, start_time + word_count * 60 / 150.0::DOUBLE AS end_time FROM seg), q AS (SELECT *, least(10, greatest(1, floor((end_time - start_time) / 0.5)::INT)) AS k FROM s),
p AS (SELECT episode_id, segment_index, i, start_time + (end_time - start_time) / k * (i + 0.5::DOUBLE) AS t FROM (SELECT *, unnest(range(k)) AS i FROM q)), tu AS (SELECT episode_id, speaker, start_time + 0.3::DOUBLE AS start, end_time + 0.3::DOUBLE AS stop FROM s),
v AS (SELECT episode_id, segment_index, i, arg_min(speaker, (gap, start, speaker)) AS speaker FROM (SELECT p.*, speaker, start, greatest(0, start - t, t - stop) AS gap FROM p JOIN tu USING (episode_id)) WHERE gap < 1 GROUP BY 1, 2, 3), c AS (SELECT episode_id, segment_index, speaker, count(*) AS n, min(i) AS i FROM v GROUP BY 1, 2, 3)
SELECT episode_id, segment_index, arg_max(speaker, (n, -i)) AS aligned_speaker FROM c GROUP BY 1, 2""")
def speaker_alignment(spark, sf):
    """Turns that lag the segments by 0.3 seconds."""
    s = seg(spark, sf)
    return P.align(s, s.select("episode_id", "speaker", (F.col("start_time") + 0.3).alias("start"), (F.col("end_time") + 0.3).alias("stop")))


@book.add(f"""WITH {TIMELINE} SELECT a.episode_id, a.segment_index, a.entity_id AS src, b.entity_id AS dst, CASE WHEN a.nth = 1 AND b.nth = 1 THEN 'co_introduction' WHEN b.nth = 1 AND a.nth > 1 THEN 'causal_link' ELSE 'contrast' END AS interaction FROM tl a JOIN tl b ON a.episode_id = b.episode_id AND a.segment_index = b.segment_index AND a.entity_id < b.entity_id""")
def concept_interactions(spark, sf):
    s, m = parts(spark, sf)
    return P.interactions(M.timeline(m, totals(s)))


@book.add(f"""WITH {MENTIONS_SQL}, p AS (SELECT a.episode_id, a.segment_index, a.entity_id AS src, b.entity_id AS dst, 1 - abs(instr(lower(a.text), lower(a.name)) - instr(lower(a.text), lower(b.name))) / length(a.text) AS base, len(list_filter(string_split(lower(a.text), '.'), lambda s: contains(s, lower(a.name)) AND contains(s, lower(b.name)))) > 0 AS shared FROM men a JOIN men b ON a.episode_id = b.episode_id AND a.segment_index = b.segment_index AND a.entity_id < b.entity_id)
SELECT episode_id, segment_index, src, dst, round(CASE WHEN shared THEN least(1.0, base + 0.2) ELSE base END, 6)::DOUBLE AS confidence FROM p WHERE CASE WHEN shared THEN least(1.0, base + 0.2) ELSE base END > 0.5""")
def entity_relationships(spark, sf):
    s, m = parts(spark, sf)
    c = P.relationship_confidence(F.col("a"), F.col("b"))
    j = M.paired(m, s, P.RELATION).select("episode_id", "segment_index", F.col("a.entity_id").alias("src"), F.col("b.entity_id").alias("dst"), c.alias("c"))
    return j.where("c > 0.5").withColumn("confidence", r6(F.col("c"))).drop("c")


@book.add(f"""WITH {MENTIONS_SQL}, g AS (SELECT episode_id, segment_index, count(DISTINCT pos % 3) AS communities, count(*) AS mentioned FROM men GROUP BY 1, 2 HAVING count(DISTINCT pos % 3) > 1) SELECT episode_id, segment_index, CAST(communities AS BIGINT) AS communities, CAST(mentioned AS BIGINT) AS mentioned, round(communities / mentioned, 6) AS score FROM g ORDER BY communities / mentioned DESC, mentioned DESC, episode_id, segment_index LIMIT 20""")
def bridge_insights(spark, sf):
    from convograph.sources.adapters import concepts

    c = concepts(table(spark, sf, "documents")).select("entity_id", (F.col("pos") % 3).alias("community"))
    return P.bridge_insights(parts(spark, sf)[1], c).withColumn("score", r6(F.col("score")))


@book.add(f"""WITH {MENTIONS_SQL}, g AS (SELECT episode_id, entity_id, count(*) AS k FROM men GROUP BY 1, 2), p AS (SELECT *, k / sum(k) OVER (PARTITION BY episode_id) AS p FROM g), e AS (SELECT episode_id, -sum(p * ln(p)) AS e FROM p GROUP BY 1) SELECT episode_id, round(e, 6) + 0.0 AS entropy, CASE WHEN e < 1.0 THEN 'hierarchical' WHEN e < 1.6 THEN 'modular' ELSE 'emergent' END AS structure FROM e""")
def discourse_structure(spark, sf):
    g = parts(spark, sf)[1].groupBy("episode_id", "entity_id").agg(F.count("*").alias("k"))
    e = P.entropy(g, "episode_id", "k")
    return e.select("episode_id", (r6(F.col("entropy")) + 0.0).alias("entropy"), F.when(F.col("entropy") < 1.0, "hierarchical").when(F.col("entropy") < 1.6, "modular").otherwise("emergent").alias("structure"))


@book.add(f"""WITH {SEGMENTS_SQL}, q AS (SELECT *, length(text) - length(replace(text, '?', '')) AS q, len(list_filter(regexp_split_to_array(text, '[.!?]+'), lambda x: trim(x) <> '')) AS st, CASE WHEN speaker IS NOT DISTINCT FROM lag(speaker) OVER (PARTITION BY episode_id ORDER BY segment_index) THEN 0 ELSE 1 END AS begun FROM seg),
g AS (SELECT episode_id, speaker, count(*) AS segments, sum(q) AS questions, sum(greatest(st - q, 0)) AS statements, sum(begun) AS turns, sum(word_count) AS words FROM q GROUP BY 1, 2)
SELECT episode_id, speaker, CAST(segments AS BIGINT) AS segments, CAST(questions AS BIGINT) AS questions, CAST(statements AS BIGINT) AS statements, CAST(turns AS BIGINT) AS turns, CAST(words AS BIGINT) AS words, round(questions / greatest(questions + statements, 1), 6) AS question_ratio, CASE WHEN questions / greatest(questions + statements, 1) > 0.5 THEN 'interviewer' WHEN turns > 5 THEN 'moderator' ELSE 'participant' END AS role FROM g""")
def speaker_contributions(spark, sf):
    return P.speakers(seg(spark, sf)).withColumn("question_ratio", r6(F.col("question_ratio")))


THEMES = {"t1": ["that", "with"], "t2": ["tion", "this", "from"], "t3": ["absent"]}
THEME_SQL = SEGMENTS_SQL + ", th AS (SELECT * FROM (VALUES " + ", ".join(f"('{k}', {v!r})" for k, v in THEMES.items()) + ") t(theme, concepts)), st AS (SELECT episode_id, segment_index, theme, len(list_filter(concepts, lambda c: contains(lower(text), c))) AS hits, least(1.0, len(list_filter(concepts, lambda c: contains(lower(text), c))) / (len(concepts) * greatest(word_count / 100.0::DOUBLE, 1))) AS strength FROM seg, th)"


def theme_rows(spark, sf):
    themes = spark.createDataFrame(list(THEMES.items()), "theme string, concepts array<string>")
    return P.theme_strength(seg(spark, sf), themes)


@book.add(f"WITH {THEME_SQL} SELECT episode_id, segment_index, theme, round(strength, 6)::DOUBLE AS strength FROM st")
def theme_strengths(spark, sf):
    return theme_rows(spark, sf).select("episode_id", "segment_index", "theme", r6(F.col("strength")).alias("strength"))


@book.add(f"""WITH {THEME_SQL}, i AS (SELECT *, count(*) OVER (PARTITION BY episode_id, theme) AS n, row_number() OVER (PARTITION BY episode_id, theme ORDER BY segment_index) - 1 AS i FROM st),
g AS (SELECT episode_id, theme, min(segment_index) FILTER (WHERE hits > 0) AS first, max(n) AS n, avg(strength) FILTER (WHERE i < n // 3) AS early, avg(strength) FILTER (WHERE i >= n - ceil(n / 3)) AS late, arg_max(i, (strength, -i)) / max(n) AS peak FROM i GROUP BY 1, 2)
SELECT episode_id, theme, first, round(early, 6) AS early, round(late, 6) AS late, CASE WHEN n < 3 THEN 'brief' WHEN late > early * 1.5 THEN 'crescendo' WHEN early > late * 1.5 THEN 'diminuendo' WHEN peak < 0.3 THEN 'front-loaded' WHEN peak > 0.7 THEN 'climactic' ELSE 'steady' END AS pattern FROM g""")
def theme_evolution(spark, sf):
    e = P.theme_evolution(theme_rows(spark, sf))
    return e.select("episode_id", "theme", "first", r6(F.col("early")).alias("early"), r6(F.col("late")).alias("late"), "pattern")


SOURCES = f"WITH {texts.COMPLEXITY.replace('SELECT doc_id, text,', 'SELECT doc_id, source, text,')}, l AS (SELECT source, doc_id, score, {texts.LEVEL} AS level FROM c)"


def scored(spark, sf):
    return texts.complexity(table(spark, sf, "documents").select("source", "doc_id", "text")).select("source", "doc_id", "score", "level")


@book.add(f"{SOURCES}, g AS (SELECT source, level, count(*) AS n, min(doc_id) AS first FROM l GROUP BY 1, 2), dm AS (SELECT source, arg_max(level, (n, -first)) AS dominant FROM g GROUP BY 1) SELECT source, round(avg(score), 5) AS mean, round(coalesce(var_samp(score), 0), 4) AS variance, any_value(dominant) AS dominant FROM l JOIN dm USING (source) GROUP BY 1")
def complexity_rollup(spark, sf):
    return P.rolled_up(scored(spark, sf), "source", "doc_id").select("source", F.round("mean", 5).alias("mean"), F.round("variance", 4).alias("variance"), "dominant")


@book.add(f"{SOURCES}, ch AS (SELECT source, doc_id, score - lag(score) OVER (PARTITION BY source ORDER BY doc_id) AS change FROM l) SELECT source, doc_id, round(change, 6) AS change, CASE WHEN abs(change) < 10 THEN 'smooth' WHEN abs(change) < 20 THEN 'moderate' ELSE 'abrupt' END AS kind, CASE WHEN change > 0 THEN 'increasing' WHEN change < 0 THEN 'decreasing' ELSE 'stable' END AS direction FROM ch WHERE change IS NOT NULL")
def complexity_transitions(spark, sf):
    return P.score_changes(scored(spark, sf), "source", "doc_id", "score").select("source", "doc_id", r6(F.col("change")).alias("change"), "kind", "direction")


@book.add(f"WITH {SEGMENTS_SQL} SELECT episode_id, substr(string_agg('[' || upper(speaker) || ' ' || lpad(CAST(floor(start_time)::BIGINT // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(floor(start_time)::BIGINT % 60 AS VARCHAR), 2, '0') || '] ' || text, chr(10) || chr(10) ORDER BY segment_index), 1, 2000) AS transcript FROM seg GROUP BY 1")
def transcripts(spark, sf):
    return P.transcript(seg(spark, sf))


@book.add("SELECT page_id, 'Page ' || page_id AS title, CASE WHEN page_id % 3 = 0 THEN 'http://a/' || page_id || '.mp3' ELSE 'http://b/' || page_id || '.ogg' END AS audio, substr(sha256(CASE WHEN page_id % 2 = 0 THEN 'g' || page_id ELSE 'Page ' || page_id || '_http://b/' || page_id || CASE WHEN page_id % 3 = 2 THEN '.html' ELSE '.ogg' END END), 1, 32) AS episode_id, CAST(60 + page_id % 60 AS BIGINT) AS seconds FROM pages WHERE page_id % 3 <> 2")
def feed_episodes(spark, sf):
    """Feeds made of the pages: a third have an enclosure, a third only a link to audio, a third neither."""
    i = F.col("page_id")
    s = i.cast("string")
    xml = F.concat(F.lit("<rss><item><title>Page "), s, F.lit("</title>"), F.when(i % 3 == 0, F.concat(F.lit("<enclosure type='audio/mpeg' url='http://a/"), s, F.lit(".mp3'/>"))).otherwise(""), F.lit("<link>http://b/"), s, F.when(i % 3 == 2, ".html").otherwise(".ogg"), F.lit("</link>"), F.when(i % 2 == 0, F.concat(F.lit("<guid>g"), s, F.lit("</guid>"))).otherwise(""), F.lit("<duration>1:"), F.lpad((i % 60).cast("string"), 2, "0"), F.lit("</duration></item></rss>"))
    return P.feed_items(table(spark, sf, "pages").select(i.alias("feed"), xml.alias("xml"))).select(F.col("feed").alias("page_id"), "title", "audio", "episode_id", n(F.col("seconds")).alias("seconds"))


@book.add("SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url ELSE 'Feed ' || page_id END AS title, CASE WHEN page_id % 2 = 0 THEN 'about ' || page_id ELSE '' END AS description, CAST(least(2, page_id % 4) AS BIGINT) AS episodes FROM pages")
def feed_records(spark, sf):
    """Feeds of up to three items, every third of them untitled, and how many of two are kept."""
    i = F.col("page_id")
    s = i.cast("string")
    item = F.concat(F.lit("<item><title>t</title><enclosure type='audio/mpeg' url='http://a/"), s, F.lit(".mp3'/></item>"))
    xml = F.concat(F.lit("<rss><channel><title>"), F.when(i % 3 > 0, F.concat(F.lit("Feed "), s)).otherwise(" "), F.lit("</title>"), F.when(i % 2 == 0, F.concat(F.lit("<description>about "), s, F.lit("</description>"))).otherwise(""), F.lit("<item><title>no audio</title></item>"), F.repeat(item, (i % 4).cast("int")), F.lit("</channel></rss>"))
    feeds = table(spark, sf, "pages").select(i.alias("feed"), F.col("url").alias("name"), xml.alias("xml"))
    kept = P.feed_items(feeds, most=2).groupBy("feed").agg(F.count("*").alias("k"))
    return P.feed_record(feeds).join(kept, "feed", "left").select(F.col("feed").alias("page_id"), "title", "description", n(F.coalesce("k", F.lit(0))).alias("episodes"))


QUERIES, SQL = book.queries, book.sql
