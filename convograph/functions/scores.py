"""Scores, lookups and validations as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from convograph.functions import lexicons as L
from convograph.functions import text as T

# The date forms and type names that are understood.
DATE_FORMATS = ["yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "yyyy/MM/dd", "dd/MM/yyyy", "MM-dd-yyyy"]
ENTITY_TYPES = {"person": "person", "people": "person", "company": "organization", "organization": "organization", "product": "product", "technology": "technology", "concept": "concept", "location": "location", "event": "event"}
STATES = {"answered": "Concept fully addressed and concluded", "partial": "Some aspects resolved, others remain open", "deferred": "Explicitly marked for future discussion", "abandoned": "Dropped without explicit resolution", "transformed": "Evolved into different question or concept"}


def clamped(x: Column, low: float, high: float, default: float | None = None) -> Column:
    """A number in a range; what is no number becomes the default."""
    v = F.coalesce(x.try_cast("double"), F.lit(default)) if default is not None else x.try_cast("double")
    return F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), v))


def parsed_date(text: Column, now: Column | None = None) -> Column:
    """A timestamp by the first form that fits; ``now`` where none does."""
    t = F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in DATE_FORMATS])
    return F.coalesce(t, now) if now is not None else t


def date_format_of(text: Column) -> Column:
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}T"), "iso").when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), "date").when(text.rlike(r"^\d+$"), "epoch").otherwise("other")


def entity_type(name: Column) -> Column:
    return T.looked_up(F.lower(F.trim(name)), ENTITY_TYPES, "other")


def resolution(ending: Column, mentions: Column) -> Column:
    """How a concept ends, by the words of the last segments."""
    low = F.lower(ending)
    kind = F.when(T.has_any(low, ["therefore", "conclude"]), "answered").when(T.has_any(low, ["future", "next time"]), "deferred").when(T.has_any(low, ["partially", "some aspects"]), "partial").when(T.has_any(low, ["instead", "actually"]), "transformed").otherwise("partial")
    return F.when(mentions > 0, kind).otherwise("abandoned")


def resolution_quality(kind: Column, mentions: Column) -> Column:
    base = T.looked_up(kind, L.RESOLUTION_SCORES, 0.5)
    return F.when(mentions > 2, F.least(F.lit(1.0), base + 0.1)).otherwise(base)


def similarity_relation(s: Column) -> Column:
    return F.when(s > 0.9, "STRONGLY_RELATED_TO").when(s > 0.85, "RELATED_TO").otherwise("ASSOCIATED_WITH")


def transition_kind(s: Column, speaker_changed: Column) -> Column:
    """Kind of a transition by the similarity of its sides."""
    return F.when(s > 0.8, "continuation").when(s > 0.6, "expansion").when((s > 0.4) & speaker_changed, "pivot").when(s > 0.4, "return").otherwise("jump")


def smoothness(kind: Column, s: Column, marker: Column) -> Column:
    x = (T.looked_up(kind, L.SMOOTHNESS, 0.5) + s) / 2
    return F.when(marker.isNotNull(), F.least(F.lit(1.0), x + 0.1)).otherwise(x)


def entity_text(kind: Column, name: Column, description: Column, aliases: Column) -> Column:
    """``type: name | Description: … | Also known as: …``, without what is missing."""
    some = F.when(F.size(aliases) > 0, F.concat(F.lit("Also known as: "), F.array_join(aliases, ", ")))
    return F.concat_ws(" | ", F.concat(kind, F.lit(": "), name), F.concat(F.lit("Description: "), F.nullif(description, F.lit(""))), some)


def bridgeability(distance: Column, best: Column, size_a: Column, size_b: Column, connections: Column) -> Column:
    """How easily a gap closes: nearness, bridges, balance of sizes, and links there are."""
    balance = F.least(size_a, size_b) / F.greatest(size_a, size_b)
    return (1 - distance) * 0.3 + best * 0.4 + balance * 0.2 + F.least(F.lit(1.0), connections / 3) * 0.1


def priority(size: Column, importance: Column, bridge: Column, novelty: Column) -> Column:
    return F.least(F.lit(1.0), size / 20) * 0.25 + importance * 0.35 + F.coalesce(bridge, F.lit(0.5)) * 0.25 + novelty * 0.15


def bins(values: DataFrame, value: str, edges: list[float]) -> DataFrame:
    """(low, high, count) of values between edges; the last bin takes its upper edge too."""
    b = F.least(F.lit(len(edges) - 2), F.size(F.filter(F.array(*[F.lit(e) for e in edges[1:]]), lambda e: F.col(value) >= e)))
    g = values.where(F.col(value).between(edges[0], edges[-1])).groupBy(b.alias("bin")).agg(F.count("*").alias("count"))
    e = F.array(*[F.lit(float(x)) for x in edges])
    return g.select(F.get(e, F.col("bin")).alias("low"), F.get(e, F.col("bin") + 1).alias("high"), "count")


def extremes(scores: DataFrame, group: str, order: str, score: str, top: int = 3) -> DataFrame:
    """The most prominent local peaks and valleys of a sequence."""
    w = W.partitionBy(group).orderBy(order)
    s, a, b = F.col(score), F.lag(score).over(w), F.lead(score).over(w)
    x = scores.withColumns({"_a": a, "_b": b})
    kind = F.when((s > F.col("_a")) & (s > F.col("_b")), "peak").when((s < F.col("_a")) & (s < F.col("_b")), "valley")
    x = x.withColumns({"kind": kind, "prominence": F.least(F.abs(s - F.col("_a")), F.abs(s - F.col("_b")))}).where("kind is not null")
    r = F.row_number().over(W.partitionBy(group, "kind").orderBy(F.desc("prominence"), order))
    return x.withColumn("rank", r).where(F.col("rank") <= top).drop("_a", "_b")


def impact(added: Column, modified: Column, seconds: Column) -> Column:
    """Items a second, a changed one counting half."""
    return F.when(seconds > 0, F.round((added + modified * 0.5) / seconds, 2)).otherwise(F.lit(0.0))
