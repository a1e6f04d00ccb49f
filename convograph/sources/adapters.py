"""Tables read as the engine's concepts: segments of episodes, entities, nodes and edges, metric samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from convograph.functions import text as T

#: Words spoken in a minute.
WORDS_PER_MINUTE = 150
#: A name in a text: a capital and four small letters or more.
NAME = "[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]{4,}"


def spread(rows: DataFrame) -> DataFrame:
    """Rows dealt over all cores where they come from fewer files than there are cores, which would leave the others idle; with many files nothing moves."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if len(rows.inputFiles()) < cores else rows


def segments(turns: DataFrame) -> DataFrame:
    """(episode_id, segment_index, speaker, text, word_count, start_time, end_time) of conversation turns; times follow from the words spoken before."""
    s = turns.select(F.col("conv_id").alias("episode_id"), F.col("turn").alias("segment_index"), F.col("role").alias("speaker"), "text", F.size(T.words(F.col("text"))).cast("long").alias("word_count"))
    before = F.coalesce(F.sum("word_count").over(W.partitionBy("episode_id").orderBy("segment_index").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    s = s.withColumn("start_time", before * 60 / WORDS_PER_MINUTE)
    return s.withColumn("end_time", F.col("start_time") + F.col("word_count") * 60 / WORDS_PER_MINUTE)


def concepts(docs: DataFrame) -> DataFrame:
    """(entity_id, name, entity_type, pos) of the names that documents begin with, in small letters; a name has the place of its first document."""
    names = docs.select(F.lower(F.regexp_extract("text", NAME, 0)).alias("name"), "doc_id").where("name <> ''").groupBy("name").agg(F.min("doc_id").alias("pos"))
    return names.select(F.concat(F.lit("e"), F.col("pos").cast("string")).alias("entity_id"), "name", F.when(F.col("pos") % 2 == 0, "concept").otherwise("topic").alias("entity_type"), "pos")


#: The same in SQL.
SEGMENTS_SQL = r"""seg0 AS (SELECT conv_id AS episode_id, turn AS segment_index, role AS speaker, text, len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) AS word_count FROM conversations),
seg AS (SELECT *, coalesce(sum(word_count) OVER (PARTITION BY episode_id ORDER BY segment_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) * 60 / 150.0::DOUBLE AS start_time FROM seg0)"""
CONCEPTS_SQL = f"ent AS (SELECT 'e' || min(doc_id) AS entity_id, name, CASE min(doc_id) % 2 WHEN 0 THEN 'concept' ELSE 'topic' END AS entity_type, min(doc_id) AS pos FROM (SELECT doc_id, lower(regexp_extract(text, '{NAME}')) AS name FROM documents) WHERE name <> '' GROUP BY name)"
MENTIONS_SQL = SEGMENTS_SQL + ", " + CONCEPTS_SQL + ", men AS (SELECT s.*, e.entity_id, e.name, e.entity_type, e.pos FROM seg s JOIN ent e ON contains(lower(s.text), lower(e.name)))"
