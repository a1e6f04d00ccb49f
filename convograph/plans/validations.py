"""Queries over validations of themes and insights."""

from __future__ import annotations

from pyspark.sql import functions as F

from convograph.operators import validation as X
from convograph.plans.base import Book, n, r6, sql_how_many, table
from convograph.plans.episodes import THEME_SQL, THEMES, theme_rows
from convograph.plans.flow import parts
from convograph.sources.adapters import MENTIONS_SQL, SEGMENTS_SQL, segments

book = Book()
CONTRARY = ["however", "not", "inth"]


@book.add(f"""WITH {THEME_SQL}, s AS (SELECT *, abs(strength - lag(strength) OVER (PARTITION BY episode_id, theme ORDER BY segment_index)) AS step FROM st), g AS (SELECT episode_id, theme, avg((hits > 0)::INT) AS presence, coalesce(avg(step), 0) AS step, avg((strength > 0.1)::INT) AS strong FROM s GROUP BY 1, 2),
c AS (SELECT episode_id, theme, sum({sql_how_many('lower(text)', CONTRARY)}) AS k FROM seg, th WHERE len(list_filter(concepts, lambda c: contains(lower(text), c))) > 0 GROUP BY 1, 2), z AS (SELECT theme, len(concepts) AS size FROM th),
x AS (SELECT g.episode_id, g.theme, presence, (presence + greatest(0, 1 - step / 0.5)) / 2 AS coherence, greatest(0, 1 - coalesce(k, 0) / 5) AS agreement, (least(1.0, size / 10) + 0.8::DOUBLE + strong) / 3 AS significance FROM g LEFT JOIN c ON c.episode_id = g.episode_id AND c.theme = g.theme JOIN z ON z.theme = g.theme)
SELECT episode_id, theme, round(coherence, 6)::DOUBLE AS coherence, round(agreement, 6)::DOUBLE AS agreement, round(significance, 6)::DOUBLE AS significance, round(((presence > 0)::INT / 3 + 1 / 3) * 0.3::DOUBLE + coherence * 0.3::DOUBLE + agreement * 0.2::DOUBLE + significance * 0.2::DOUBLE, 6)::DOUBLE AS score FROM x""")
def theme_validation(spark, sf):
    themes = spark.createDataFrame(list(THEMES.items()), "theme string, concepts array<string>")
    contrary = X.contradictions(segments(table(spark, sf, "conversations")), themes, CONTRARY)
    sizes = themes.select("theme", F.size("concepts").alias("size"), F.lit(0.8).alias("confidence"))
    v = X.theme_checks(theme_rows(spark, sf), contrary, sizes)
    return v.select("episode_id", "theme", *[r6(F.col(c)).alias(c) for c in ("coherence", "agreement", "significance", "score")])


@book.add(f"WITH {MENTIONS_SQL} SELECT entity_id AS dst, CAST(count(*) AS BIGINT) AS insights, round(count(*) * 0.5, 6)::DOUBLE AS weight FROM men GROUP BY 1")
def insight_graph(spark, sf):
    return X.insight_edges(parts(spark, sf)[1]).groupBy("dst").agg(F.count("*").alias("insights"), r6(F.sum("weight")).alias("weight"))


@book.add("WITH i AS (SELECT o_orderkey AS pos, o_orderpriority AS title, repeat('x', CAST(o_orderkey % 40 AS INT)) AS description, CASE WHEN o_orderkey % 2 = 0 THEN 'factual' ELSE 'odd' END AS kind FROM orders), k AS (SELECT *, row_number() OVER (PARTITION BY lower(title) ORDER BY pos) AS r FROM i WHERE length(description) >= 20) SELECT pos, title, CASE kind WHEN 'factual' THEN 'factual' ELSE 'observation' END AS kind FROM k WHERE r = 1")
def kept_insights(spark, sf):
    k = F.col("o_orderkey")
    i = table(spark, sf, "orders").select(k.alias("pos"), F.col("o_orderpriority").alias("title"), F.repeat(F.lit("x"), (k % 40).cast("int")).alias("description"), F.when(k % 2 == 0, "factual").otherwise("odd").alias("kind"))
    return X.kept_insights(i).select("pos", "title", "kind")


@book.add(rf"WITH {SEGMENTS_SQL}, q AS (SELECT episode_id, segment_index, unnest(regexp_extract_all(regexp_replace(text, '[^\x00-\x7F]', '_', 'g'), '(?i)\b(?:the|of)\s+([^.!?]+)', 1)) AS quote FROM seg), k AS (SELECT *, len(list_filter(regexp_split_to_array(quote, '\s+'), lambda w: w <> '')) AS words FROM q) SELECT episode_id, segment_index, quote, CAST(words AS BIGINT) AS words FROM k WHERE words BETWEEN 10 AND 50")
def stated_quotes(spark, sf):
    from convograph.functions import text as T

    s = segments(table(spark, sf, "conversations")).withColumn("text", T.plain(F.col("text")))
    return X.stated_quotes(s, ["the", "of"]).withColumn("words", n(F.col("words")))


QUERIES, SQL = book.queries, book.sql
