"""Matching new entities against known ones, and merging clusters of the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from convograph.functions import text as T
from convograph.operators.entities import similarity


def bigrams(name: Column) -> Column:
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(name) - 1, F.lit(1))), lambda i: F.substring(name, i, F.lit(2))))


def candidates(new: DataFrame, known: DataFrame, least: float = 0.85) -> DataFrame:
    """(new_id, id, similarity, match_type, rank) of known entities of the type of a new one that may be the same: 1.0 for equal
    normal forms, 0.95 for an alias, else the similarity of the names if it is ``least`` or more.

    new: (new_id, name, type); known: (id, name, type, aliases ARRAY).  Equal names and aliases are found by joins on the normal form.  Names that are
    0.85 alike are of similar length and share two characters in a row, so only such pairs of distinct names are compared."""
    n = new.withColumn("_norm", T.normalize_name(F.col("name")))
    k = known.withColumn("_norm", T.normalize_name(F.col("name")))
    key = ["type", "_norm"]
    exact = n.select("new_id", *key).join(k.select("id", *key), key).select("new_id", "id", F.lit(1.0).alias("similarity"), F.lit("exact_normalized").alias("match_type"), F.lit(0).alias("_way"))
    also = k.select("id", "type", F.explode("aliases").alias("_alias")).select("id", "type", T.normalize_name(F.col("_alias")).alias("_norm"))
    alias = n.select("new_id", *key).join(also, key).select("new_id", "id", F.lit(0.95).alias("similarity"), F.lit("alias_match").alias("match_type"), F.lit(1).alias("_way"))
    found = exact.unionByName(alias)
    if least <= 1:
        one = lambda d, c: d.select("type", F.lower("name").alias(c)).distinct().select("type", c, F.explode(bigrams(F.col(c))).alias("_two"))
        a, b = F.col("a"), F.col("b")
        short = F.least(F.length(a), F.length(b)) * 2 >= least * (F.length(a) + F.length(b))
        pairs = one(n, "a").join(one(k, "b"), ["type", "_two"]).where(short).select("type", "a", "b").distinct()
        alike = pairs.withColumn("similarity", similarity(a, b)).where(F.col("similarity") >= least)
        low = lambda d, c: d.withColumn(c, F.lower("name"))
        fuzzy = low(n, "a").select("new_id", "type", "a").join(alike, ["type", "a"]).join(low(k, "b").select("id", "type", "b"), ["type", "b"])
        found = found.unionByName(fuzzy.select("new_id", "id", "similarity", F.lit("fuzzy_match").alias("match_type"), F.lit(2).alias("_way")))
    best = found.groupBy("new_id", "id").agg(F.min_by(F.struct("similarity", "match_type"), "_way").alias("_b")).select("new_id", "id", "_b.*")
    return best.withColumn("rank", F.row_number().over(W.partitionBy("new_id").orderBy(F.desc("similarity"), "id")))


def merged(entities: DataFrame) -> DataFrame:
    """One entity for each cluster of (cluster, pos, name, description, aliases, confidence, metadata): that of most confidence, the first of several.

    Others add their descriptions, unless it has them already, their names and aliases, once for each normal form, and metadata under
    keys that those of more confidence lack.  Rows that differ in confidence alone are one before a cluster is gathered, so a cluster is as large as its
    variants, not as its rows."""
    same = ["cluster", "name", "description", "aliases", "metadata"]
    packed = entities.withColumn("metadata", F.array_sort(F.map_entries("metadata")))
    variants = packed.groupBy(*same).agg(F.min(F.struct((-F.col("confidence")).alias("less"), "pos")).alias("_at"))
    g = variants.groupBy("cluster").agg(F.array_sort(F.collect_list(F.struct("_at", "name", "description", "aliases", "metadata"))).alias("_all"))
    first = F.get("_all", F.lit(0))
    norm = T.normalize_name

    def add(text: Column, x: Column) -> Column:
        d = F.coalesce(x["description"], F.lit(""))
        return F.when((d == "") | F.contains(text, d), text).when(text == "", d).otherwise(F.concat(text, F.lit(". "), d))

    def once(acc: Column, name: Column) -> Column:
        new = ~F.exists(acc, lambda a: norm(a) == norm(name)) & (norm(name) != norm(first["name"]))
        return F.when(F.coalesce(new, F.lit(False)), F.concat(acc, F.array(name))).otherwise(acc)

    own = lambda x: F.coalesce(x["aliases"], F.array().cast("array<string>"))
    names = F.flatten(F.transform("_all", lambda x, i: F.when(i == 0, own(x)).otherwise(F.concat(F.array(x["name"]), own(x)))))
    entries = F.flatten(F.transform("_all", lambda x: F.coalesce(x["metadata"], F.array())))
    keyed = F.aggregate(entries, F.filter(entries, lambda e: F.lit(False)), lambda acc, e: F.when(F.exists(acc, lambda a: a["key"] == e["key"]), acc).otherwise(F.concat(acc, F.array(e))))
    return g.select(
        "cluster", first["name"].alias("name"), (-first["_at"]["less"]).alias("confidence"), F.aggregate("_all", F.lit(""), add).alias("description"),
        F.aggregate(names, F.array().cast("array<string>"), once).alias("aliases"), F.map_from_entries(keyed).alias("metadata"), F.size("_all").alias("variants"),
    )


def reduction(before: DataFrame, cluster: str) -> DataFrame:
    """How many entities there were, how many are left, how many merges that takes, and the reduction in percent."""
    g = before.groupBy(cluster).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("entities_before"), F.count("*").alias("entities_after"))
    b, a = F.col("entities_before"), F.col("entities_after")
    return g.select(b, a, (b - a).alias("merges"), F.when(b > 0, (1 - a / b) * 100).otherwise(0.0).alias("reduction"))


def preview(named: DataFrame, cluster: str, name: str) -> DataFrame:
    """What a merge would do, without doing it: the distinct names of each cluster of several, and the longest as its name."""
    g = named.groupBy(cluster, name).agg(F.count("*").alias("n")).groupBy(cluster).agg(F.array_sort(F.collect_list(name)).alias("names"), F.sum("n").alias("entities"), F.max(F.struct(F.length(name).alias("len"), F.col(name).alias("name")))["name"].alias("canonical"))
    return g.where("entities > 1").select("names", "entities", "canonical")
