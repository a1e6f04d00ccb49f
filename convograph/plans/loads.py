"""Queries over what is loaded into the graph store."""

from __future__ import annotations

from pyspark.sql import functions as F

from convograph.operators import loading as X
from convograph.plans.base import Book, r6, table
from convograph.plans.flow import parts
from convograph.plans.stores import graph
from convograph.sources.adapters import MENTIONS_SQL, SEGMENTS_SQL, segments

book = Book()


@book.add(f"WITH {SEGMENTS_SQL} SELECT CAST(episode_id AS VARCHAR) AS src, episode_id || '_segment_' || segment_index AS dst, 'HAS_SEGMENT' AS type, segment_index::DOUBLE AS weight FROM seg")
def loaded_segments(spark, sf):
    return X.segment_rows(segments(table(spark, sf, "conversations")))[1]


@book.add(f"WITH {MENTIONS_SQL} SELECT entity_id AS src, CAST(count(DISTINCT episode_id || '_segment_' || segment_index) AS BIGINT) AS segments FROM men GROUP BY 1")
def loaded_mentions(spark, sf):
    return X.mention_rows(parts(spark, sf)[1]).groupBy("src").agg(F.countDistinct("dst").alias("segments"))


@book.add(f"WITH {SEGMENTS_SQL} SELECT speaker, episode_id, CAST(count(*) AS BIGINT) AS segments, round(sum(word_count * 60 / 150.0::DOUBLE), 4) AS seconds FROM seg GROUP BY 1, 2")
def speaker_links(spark, sf):
    return X.speaker_rows(segments(table(spark, sf, "conversations"))).withColumn("seconds", F.round("seconds", 4))


@book.add("SELECT 'RELATIONSHIP' AS type, kind, CAST(count(*) AS BIGINT) AS n FROM (SELECT 'IN_REGION' AS kind FROM nation UNION ALL SELECT 'IN_NATION' FROM customer UNION ALL SELECT 'PLACED_BY' FROM orders) GROUP BY 2")
def generic_relationships(spark, sf):
    e = X.generic_edges(graph(spark, sf).edges)
    return e.groupBy("type", F.element_at("props", F.lit("_type")).alias("kind")).agg(F.count("*").alias("n"))


@book.add("SELECT CAST(count(*) FILTER (WHERE s_suppkey % 2 = 0) AS BIGINT) AS missing, CAST(count(*) FILTER (WHERE s_suppkey % 5 <> 0) AS BIGINT) AS rows FROM supplier WHERE s_suppkey % 5 <> 0")
def migration_rollback(spark, sf):
    """A fifth of the rows was done before; stamps of even keys are newer than the time that is gone back to."""
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"))
    at = F.when(F.col("id") % 2 == 0, F.lit("2024-02-01")).otherwise(F.lit("2024-01-01")).cast("timestamp")
    done = X.stamped(s, "1.1.0", at, s.where("id % 5 = 0"))
    return X.unstamped(X.rolled_back(done, F.lit("2024-01-15").cast("timestamp")))


@book.add("SELECT '{\"r_regionkey\":' || r_regionkey || ',\"r_name\":\"' || r_name || '\"}' AS value FROM region")
def exported_rows(spark, sf):
    return X.exported(table(spark, sf, "region").select("r_regionkey", "r_name"))


@book.add("WITH e AS (SELECT *, max(ts) OVER () AS mx FROM events), w AS (SELECT * FROM (VALUES ('1h', 1), ('24h', 24), ('7d', 168), ('30d', 720)) t(name, h)) SELECT w.name, CAST(count(*) AS BIGINT) AS total, round(avg((event_type <> 'error')::INT), 6) AS availability, avg((event_type <> 'error')::INT) >= 0.8 AS met FROM w JOIN e ON epoch(mx) - epoch(ts) <= h * 3600 GROUP BY 1")
def slo_report(spark, sf):
    """Windows that end at the last event; one pass with a conditional sum for each."""
    hours = {"1h": 1, "24h": 24, "7d": 168, "30d": 720}
    e = table(spark, sf, "events").withColumn("s", F.col("ts").cast("timestamp").cast("double"))
    last = e.agg(F.max("s").alias("m"))
    e = e.join(F.broadcast(last))
    g = e.agg(*[c for k, h in hours.items() for c in (F.count_if(F.col("m") - F.col("s") <= h * 3600).alias(f"t{k}"), F.avg(F.when(F.col("m") - F.col("s") <= h * 3600, (F.col("event_type") != "error").cast("double"))).alias(f"a{k}"))])
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("name"), F.col(f"t{k}").alias("total"), F.col(f"a{k}").alias("a")) for k in hours]))
    return g.select(rows.alias("x")).select("x.name", "x.total", r6(F.col("x.a")).alias("availability"), (F.col("x.a") >= 0.8).alias("met"))


QUERIES, SQL = book.queries, book.sql
