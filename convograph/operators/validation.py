"""Validation of themes and insights against the segments they come from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from convograph.functions import text as T
from convograph.operators.blocks import against


def theme_checks(strength: DataFrame, contrary: DataFrame, sizes: DataFrame) -> DataFrame:
    """Checks of each theme of an episode: coherence (presence, and steadiness of its strength), contradictions, significance and the weighted score.

    strength: (episode_id, segment_index, theme, strength, hits); contrary: (episode_id, theme, contradictions); sizes: (theme, size, confidence)."""
    w = W.partitionBy("episode_id", "theme").orderBy("segment_index")
    s = strength.withColumn("step", F.abs(F.col("strength") - F.lag("strength").over(w)))
    g = s.groupBy("episode_id", "theme").agg(F.avg((F.col("hits") > 0).cast("double")).alias("presence"), F.coalesce(F.avg("step"), F.lit(0.0)).alias("step"), F.avg((F.col("strength") > 0.1).cast("double")).alias("strong"))
    j = g.join(contrary, ["episode_id", "theme"], "left").join(sizes, "theme")
    coherence = (F.col("presence") + F.greatest(F.lit(0.0), 1 - F.col("step") / 0.5)) / 2
    agreement = F.greatest(F.lit(0.0), 1 - F.coalesce("contradictions", F.lit(0)) / 5)
    significance = (F.least(F.lit(1.0), F.col("size") / 10) + F.col("confidence") + F.col("strong")) / 3
    evidence = (F.col("presence") > 0).cast("double") / 3 + F.lit(1 / 3)
    return j.select("episode_id", "theme", coherence.alias("coherence"), agreement.alias("agreement"), significance.alias("significance"), (evidence * 0.3 + coherence * 0.3 + agreement * 0.2 + significance * 0.2).alias("score"))


def contradictions(segments: DataFrame, themes: DataFrame, keywords: list[str]) -> DataFrame:
    """(episode_id, theme, contradictions): contrary keywords in segments that have a term of the theme."""
    low = F.lower("text")
    j = against(segments, themes).where(F.exists("concepts", lambda c: F.contains(low, F.lower(c))))
    return j.groupBy("episode_id", "theme").agg(F.sum(T.how_many(low, keywords)).alias("contradictions"))


def insight_edges(found: DataFrame, weight: float = 0.5) -> DataFrame:
    """Edges from the text that stands for an insight to the entities it mentions."""
    return found.select(F.concat_ws("-", F.lit("i"), F.col("episode_id").cast("string"), F.col("segment_index").cast("string")).alias("src"), F.col("entity_id").alias("dst"), F.lit(float(weight)).alias("weight"))


def kept_insights(insights: DataFrame, least: int = 20) -> DataFrame:
    """Insights (pos, title, description, kind) long enough, the first of each title; unknown kinds are observations."""
    i = insights.where((F.trim("title") != "") & (F.length("description") >= least))
    i = i.withColumn("kind", F.when(F.col("kind").isin("factual", "conceptual", "prediction", "recommendation", "key_point", "technical"), F.col("kind")).otherwise("observation"))
    return i.withColumn("_rn", F.row_number().over(W.partitionBy(F.lower("title")).orderBy("pos"))).where("_rn = 1").drop("_rn")


def stated_quotes(segments: DataFrame, frames: list[str], low: int = 10, high: int = 50) -> DataFrame:
    """Statements that follow a frame such as "I think", of 10 to 50 words, up to the end of the sentence."""
    pattern = r"(?i)\b(?:" + "|".join(frames) + r")\s+([^.!?]+)"
    q = segments.select("episode_id", "segment_index", F.explode(F.regexp_extract_all("text", F.lit(pattern), F.lit(1))).alias("quote"))
    k = F.size(T.words(F.col("quote")))
    return q.where(k.between(low, high)).withColumn("words", k)
