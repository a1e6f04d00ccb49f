"""Entity resolution, validation of extractions, and importance."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from convograph.functions import lexicons as L
from convograph.functions import text as T
from convograph.operators.components import connected_components


@F.pandas_udf(DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratio of matching characters (longest common blocks, recursively); no built-in function computes it."""
    return pd.Series([SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b, strict=True)])


def initials(name: Column) -> Column:
    return F.array_join(F.transform(T.words(name), lambda w: F.upper(F.left(w, F.lit(1)))), "")


def is_acronym(short: Column, full: Column) -> Column:
    upper = (short == F.upper(short)) & (short != F.lower(short))
    return upper & F.contains(full, F.lit(" ")) & (short == initials(full))


def alias_group(name: Column) -> Column:
    """Numbers of the alias groups that have the name."""
    low = F.lower(name)
    groups = F.array(*[F.when(low.isin(g), F.lit(i)) for i, g in enumerate(L.ALIASES)])
    return F.filter(groups, lambda x: x.isNotNull())


def are_plural(a: Column, b: Column) -> Column:
    out = (F.concat(a, F.lit("s")) == b) | (F.concat(b, F.lit("s")) == a)
    for one, many in L.IRREGULAR_PLURALS.items():
        out = out | ((F.lower(a) == one) & (F.lower(b) == many)) | ((F.lower(a) == many) & (F.lower(b) == one))
    return out


def abbreviation_of(name: Column) -> Column:
    return T.looked_up(name, {k: v.lower() for k, v in L.ABBREVIATIONS.items()}, None)


def match(a: Column, b: Column) -> Column:
    """struct(kind, confidence) of two names by the first rule that fits: exact, case, alias, abbreviation, plural; null if none does."""
    rules = [
        ("exact", a == b, 1.0), ("case", F.lower(a) == F.lower(b), 0.95), ("alias", F.arrays_overlap(alias_group(a), alias_group(b)), 0.9),
        ("abbreviation", F.coalesce(abbreviation_of(a) == F.lower(b), F.lit(False)) | F.coalesce(abbreviation_of(b) == F.lower(a), F.lit(False)) | is_acronym(a, b) | is_acronym(b, a), 0.9),
        ("singular_plural", are_plural(a, b), 0.9),
    ]
    out = None
    for kind, test, confidence in rules:
        value = F.struct(F.lit(kind).alias("kind"), F.lit(confidence).alias("confidence"))
        out = F.when(test, value) if out is None else out.when(test, value)
    return out


def block_keys(name: Column) -> Column:
    """Keys of which names that match by a rule share one: the lower-case name without a final s, initials, alias groups, abbreviations, plurals."""
    low = F.lower(name)
    stem = F.regexp_replace(low, "s$", "")
    irregular = T.looked_up(low, {m: o for o, m in L.IRREGULAR_PLURALS.items()}, None)
    return F.array_distinct(F.filter(F.concat(
        F.array(F.concat(F.lit("n:"), stem), F.concat(F.lit("n:"), F.regexp_replace(F.coalesce(irregular, low), "s$", "")), F.concat(F.lit("n:"), F.regexp_replace(F.coalesce(abbreviation_of(name), low), "s$", "")),
                F.when(F.contains(name, F.lit(" ")), F.concat(F.lit("a:"), initials(name))), F.when((name == F.upper(name)) & (name != low), F.concat(F.lit("a:"), name))),
        F.transform(alias_group(name), lambda g: F.concat(F.lit("g:"), g.cast("string"))),
    ), lambda k: k.isNotNull()))


def matches(entities: DataFrame) -> DataFrame:
    """(a, b, kind, confidence) of the pairs of distinct names that match, candidates by shared block key.

    Work is per distinct name, so repeated entities cost nothing."""
    names = entities.select("name").where("name is not null").distinct().select("name", F.explode(block_keys(F.col("name"))).alias("key"))
    left, right = names.select(F.col("name").alias("a"), "key"), names.select(F.col("name").alias("b"), "key")
    p = left.join(right, "key").where("a < b").select("a", "b").distinct()
    return p.withColumn("m", match(F.col("a"), F.col("b"))).where("m is not null").select("a", "b", "m.kind", "m.confidence")


def resolve(entities: DataFrame) -> DataFrame:
    """Entities (pos, name, type, confidence) merged over chains of matches: canonical name (most frequent, then longest), aliases, occurrences, mean confidence."""
    m = matches(entities)
    c = connected_components(m.select(F.col("a").alias("src"), F.col("b").alias("dst"))).withColumnRenamed("node", "name")
    e = entities.join(c, "name", "left").withColumn("cluster", F.coalesce("component", "name"))
    by = e.groupBy("cluster", "name").agg(F.count("*").alias("n"), F.min(F.struct("pos", "type")).alias("first"), F.sum("confidence").alias("conf"))
    g = by.groupBy("cluster").agg(F.max(F.struct("n", F.length("name").alias("len"), "name"))["name"].alias("canonical"), F.array_sort(F.collect_set("name")).alias("names"), F.sum("n").alias("occurrences"), F.min("first")["type"].alias("type"), (F.sum("conf") / F.sum("n")).alias("confidence"))
    return g.select("canonical", F.array_remove("names", F.col("canonical")).alias("aliases"), "occurrences", "type", "confidence")


def merged_by_name(entities: DataFrame) -> DataFrame:
    """Entities with one normalised name and type: the first name, most confidence, all counts."""
    e = entities.withColumn("key", F.lower(F.trim("name")))
    return e.groupBy("key", F.upper("type").alias("type")).agg(F.min(F.struct("pos", "name"))["name"].alias("name"), F.max("confidence").alias("confidence"), F.count("*").alias("mentions"))


def supported(quote: Column, text: Column, share: float = 0.7) -> Column:
    """Whether a quote is borne out by a text: word for word up to three words, else by that share of its words."""
    w = T.words(F.lower(quote))
    inside = F.size(F.filter(w, lambda x: F.contains(F.lower(text), x)))
    return F.when(F.size(w) > 3, inside / F.size(w) >= share).otherwise(F.contains(F.lower(text), F.lower(F.trim(quote))))


def importance(factors: dict[str, Column], weights: dict[str, float] = L.IMPORTANCE_WEIGHTS) -> Column:
    """Weighted sum of factors in [0, 1]; weights are scaled to one."""
    total = sum(weights.values())
    scale = total if abs(total - 1) > 0.001 else 1.0
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), sum((factors[k] * (w / scale) for k, w in weights.items() if k in factors), F.lit(0.0))))


def frequency_factor(mentions: Column, seconds: Column) -> Column:
    """ln(1 + mentions per minute) over ln(1 + mentions)."""
    rate = mentions / (seconds / 60)
    return F.when((mentions > 0) & (seconds > 0), F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.log1p(rate) / F.log1p(mentions)))).otherwise(F.lit(0.0))


def bridge_role(mentions: Column, span: Column, segments: Column) -> Column:
    """Mean gap between the segments of an entity over a tenth of the episode, at most 1; the gaps of mentions in order add up to their span."""
    return F.when(mentions > 1, F.least(F.lit(1.0), F.try_divide(span, mentions - 1) / F.greatest(F.lit(1.0), segments * 0.1))).otherwise(F.lit(0.0))


def top_by(rows: DataFrame, group: list[str], order: list[Column], k: int) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(W.partitionBy(*group).orderBy(*order))).where(F.col("rank") <= k)


def mock_embedding(text: Column, dimension: int = 16) -> Column:
    """A deterministic unit vector from the MD5 of a text; blank texts give zeros."""
    digest = F.md5(F.coalesce(text, F.lit("")))
    raw = F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: F.conv(F.substring(digest, i * 2 + 1, F.lit(2)), 16, 10).cast("double") / 127.5 - 1)
    size = F.sqrt(F.aggregate(raw, F.lit(0.0), lambda a, x: a + x * x))
    padded = F.concat(F.transform(raw, lambda x: x / size), F.array_repeat(F.lit(0.0), max(0, dimension - 16)))
    return F.when(F.trim(F.coalesce(text, F.lit(""))) == "", F.array_repeat(F.lit(0.0), dimension)).otherwise(F.slice(padded, 1, dimension))


def embedded_once(rows: DataFrame, text_col: str, dimension: int = 16) -> DataFrame:
    """(text, embedding) of each distinct text; rows that share a text share the work."""
    return rows.select(text_col).where(F.col(text_col).isNotNull()).distinct().withColumn("embedding", mock_embedding(F.col(text_col), dimension))
