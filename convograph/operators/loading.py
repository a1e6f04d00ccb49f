"""Rows of a processed episode as nodes and edges, and migrations of whole graphs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convograph.functions import text as T


def segment_rows(segments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges): a node for each segment, named by episode and place, and the edge from its episode with the place as its weight."""
    i = F.concat_ws("_segment_", F.col("episode_id").cast("string"), F.col("segment_index").cast("string"))
    nodes = segments.select(i.alias("id"), F.lit("segment").alias("type"), F.substring("text", 1, 50).alias("name"), F.create_map(F.lit("speaker"), F.col("speaker")).alias("props"))
    edges = segments.select(F.col("episode_id").cast("string").alias("src"), i.alias("dst"), F.lit("HAS_SEGMENT").alias("type"), F.col("segment_index").cast("double").alias("weight"))
    return nodes, edges


def mention_rows(found: DataFrame) -> DataFrame:
    """Edges from entities to the segments that mention them."""
    return found.select(F.col("entity_id").alias("src"), F.concat_ws("_segment_", F.col("episode_id").cast("string"), F.col("segment_index").cast("string")).alias("dst"), F.lit("MENTIONED_IN").alias("type"), F.lit(1.0).alias("weight"))


def speaker_rows(segments: DataFrame) -> DataFrame:
    """(speaker, episode_id, segments, seconds) of who speaks in what."""
    return segments.groupBy("speaker", "episode_id").agg(F.count("*").alias("segments"), F.sum(F.col("end_time") - F.col("start_time")).alias("seconds"))


def generic_edges(edges: DataFrame) -> DataFrame:
    """Edges of one kind with their type as a property in the normal form."""
    return edges.select("src", "dst", F.lit("RELATIONSHIP").alias("type"), F.create_map(F.lit("_type"), T.relation_type(F.col("type"))).alias("props"))


def stamped(rows: DataFrame, version: str, at: Column, done: DataFrame | None = None, key: str = "id") -> DataFrame:
    """Rows with the stamps of a migration; those already done are left out."""
    todo = rows.join(done.select(key), key, "left_anti") if done is not None else rows
    return todo.withColumns({"migration_version": F.lit(version), "migrated_at": at})


def rolled_back(rows: DataFrame, since: Column) -> DataFrame:
    """Clears the stamps that are newer than a time."""
    new = F.col("migrated_at") > since
    return rows.withColumns({"migration_version": F.when(~new, F.col("migration_version")), "migrated_at": F.when(~new, F.col("migrated_at"))})


def unstamped(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count_if(F.col("migrated_at").isNull()).alias("missing"), F.count("*").alias("rows"))


def exported(rows: DataFrame) -> DataFrame:
    """Each row as a line of JSON, for ``write.text``."""
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))
