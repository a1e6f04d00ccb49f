"""Queries over matching and merging entities."""

from __future__ import annotations

from pyspark.sql import functions as F

from convograph.operators import entities as E
from convograph.operators import merging as R
from convograph.operators.components import connected_components
from convograph.plans.base import Book, quote, r6, table
from convograph.plans.resolution import CLUSTERS, DEALT_SQL, dealt

book = Book()


@book.add("""WITH n AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'NATION_' || event_id % 30 WHEN 1 THEN 'nation_' || event_id % 30 || ' Inc' WHEN 2 THEN 'alias ' || event_id % 30 ELSE 'none' END AS name, CASE WHEN event_id % 5 = 0 THEN 'other' ELSE 'nation' END AS type, CASE event_id % 4 WHEN 0 THEN 'exact_normalized' WHEN 1 THEN 'exact_normalized' WHEN 2 THEN 'alias_match' END AS kind FROM events)
SELECT event_id AS new_id, n_nationkey AS id, CASE WHEN kind = 'alias_match' THEN 0.95 ELSE 1 END::DOUBLE AS similarity, kind AS match_type, 1 AS rank FROM n JOIN nation ON n_nationkey = event_id % 30 WHERE type = 'nation' AND kind IS NOT NULL""")
def potential_matches(spark, sf):
    """Names as events spell them, against the nations and an alias of each; names alike but not equal are left to a test."""
    i = F.col("event_id")
    k = (i % 30).cast("string")
    name = F.when(i % 4 == 0, F.concat(F.lit("NATION_"), k)).when(i % 4 == 1, F.concat(F.lit("nation_"), k, F.lit(" Inc"))).when(i % 4 == 2, F.concat(F.lit("alias "), k)).otherwise("none")
    new = table(spark, sf, "events").select(i.alias("new_id"), name.alias("name"), F.when(i % 5 == 0, "other").otherwise("nation").alias("type"))
    known = table(spark, sf, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.lit("nation").alias("type"), F.array(F.concat(F.lit("Alias "), F.col("n_nationkey").cast("string"))).alias("aliases"))
    return R.candidates(new, known, least=1.01)


@book.add("""WITH e AS (SELECT user_id % 50 AS cluster, event_id AS pos, 'Name ' || user_id % 3 AS name, CASE WHEN event_id % 6 < 5 THEN 'd' || event_id % 6 END AS description, 'a' || event_id % 2 AS alias, (event_id % 10) / 10.0::DOUBLE AS confidence, 'v' || event_id % 2 AS v FROM events),
f AS (SELECT cluster, arg_min(name, (-confidence, pos)) AS name, max(confidence) AS confidence FROM e GROUP BY 1),
d AS (SELECT cluster, string_agg(description, '. ' ORDER BY c, p) AS description FROM (SELECT cluster, description, min(-confidence) AS c, arg_min(pos, (-confidence, pos)) AS p FROM e WHERE description IS NOT NULL GROUP BY 1, 2) GROUP BY 1),
a AS (SELECT e.cluster, list_sort(list(DISTINCT x)) AS aliases FROM (SELECT cluster, unnest([name, alias]) AS x FROM e) e JOIN f USING (cluster) WHERE lower(x) <> lower(f.name) GROUP BY 1),
m AS (SELECT cluster, arg_min(v, (-confidence, pos)) AS v, bool_or(pos % 3 = 0) AS extra FROM e GROUP BY 1)
SELECT cluster, name, round(confidence, 6) AS confidence, coalesce(description, '') AS description, array_to_string(aliases, ',') AS aliases, v AS first_v, CASE WHEN extra THEN 'x' ELSE '' END AS extra FROM f LEFT JOIN d USING (cluster) LEFT JOIN a USING (cluster) JOIN m USING (cluster)""")
def merged_clusters(spark, sf):
    i = F.col("event_id")
    both = F.create_map(F.lit("v"), F.concat(F.lit("v"), (i % 2).cast("string")))
    e = table(spark, sf, "events").select(
        (F.col("user_id") % 50).alias("cluster"), i.alias("pos"), F.concat(F.lit("Name "), (F.col("user_id") % 3).cast("string")).alias("name"), F.when(i % 6 < 5, F.concat(F.lit("d"), (i % 6).cast("string"))).alias("description"),
        F.array(F.concat(F.lit("a"), (i % 2).cast("string"))).alias("aliases"), ((i % 10) / 10).alias("confidence"), F.when(i % 3 == 0, F.map_concat(both, F.create_map(F.lit("e"), F.lit("x")))).otherwise(both).alias("metadata"),
    )
    m = R.merged(e)
    return m.select("cluster", "name", r6(F.col("confidence")).alias("confidence"), "description", F.array_join(F.array_sort("aliases"), ",").alias("aliases"), F.try_element_at("metadata", F.lit("v")).alias("first_v"), F.coalesce(F.try_element_at("metadata", F.lit("e")), F.lit("")).alias("extra"))


def clustered(spark, sf):
    e = dealt(spark, sf)
    m = E.matches(e)
    c = connected_components(m.select(F.col("a").alias("src"), F.col("b").alias("dst"))).withColumnRenamed("node", "name")
    return e.join(c, "name", "left").withColumn("cluster", F.coalesce("component", "name"))


VALUES = "(VALUES " + ", ".join(f"({i}, {quote(x)})" for i, c in enumerate(CLUSTERS) for x in c) + ") t(cluster, name)"


@book.add(f"WITH {DEALT_SQL}, g AS (SELECT cluster, count(*) AS n FROM ent JOIN {VALUES} USING (name) GROUP BY 1), s AS (SELECT sum(n) AS b, count(*) AS a FROM g) SELECT CAST(b AS BIGINT) AS entities_before, CAST(a AS BIGINT) AS entities_after, CAST(b - a AS BIGINT) AS merges, round((1 - a / b) * 100, 6) AS reduction FROM s")
def resolution_metrics(spark, sf):
    return R.reduction(clustered(spark, sf), "cluster").withColumn("reduction", r6(F.col("reduction")))


@book.add(f"WITH {DEALT_SQL}, g AS (SELECT cluster, name, count(*) AS n FROM ent JOIN {VALUES} USING (name) GROUP BY 1, 2) SELECT array_to_string(list_sort(list(name)), ',') AS names, CAST(sum(n) AS BIGINT) AS entities, arg_max(name, (length(name), name)) AS canonical FROM g GROUP BY cluster HAVING sum(n) > 1")
def resolution_preview(spark, sf):
    return R.preview(clustered(spark, sf), "cluster", "name").withColumn("names", F.array_join("names", ","))


QUERIES, SQL = book.queries, book.sql
__all__ = ["QUERIES", "SQL"]
