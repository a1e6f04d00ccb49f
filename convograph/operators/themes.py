"""Emergent themes of episodes: scores, hierarchy, implicit messages and summaries.

themes: (episode_id, theme, field, concepts ARRAY, segments, pattern_type, named, metaphor, evolution, validation, confidence); ``segments`` is
how many segments bear a theme out, null where that is not known."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from convograph.functions import lexicons as L


def mean_of(*factors: Column) -> Column:
    """Mean of the factors that are known; null if none is."""
    known = F.filter(F.array(*factors), lambda x: x.isNotNull())
    return F.try_divide(F.aggregate(known, F.lit(0.0), lambda a, x: a + x), F.size(known))


def from_interaction(pattern_type: Column) -> Column:
    return F.coalesce(pattern_type.isin(L.INTERACTION_PATTERNS), F.lit(False))


def emergence(field: Column, topics: Column, segments: Column, pattern_type: Column, named: Column) -> Column:
    """How little a theme was said outright, from 0 to 1: absence of its terms from the topics, spread over segments, rise from interaction, not being named."""
    terms = F.filter(F.split(F.lower(field), r"\s+"), lambda t: t != "")
    said = F.size(F.filter(terms, lambda t: F.exists(topics, lambda x: F.contains(F.lower(x), t))))
    absent = F.when(F.size(terms) > 0, 1 - said / F.size(terms)).otherwise(F.lit(0.5))
    return mean_of(absent, F.when(segments.isNotNull(), F.least(segments / 10, F.lit(1.0))), F.when(from_interaction(pattern_type), 0.9).otherwise(0.5), F.when(F.coalesce(named, F.lit(False)), 0.0).otherwise(1.0))


def scope(concepts: Column, segments: Column, field: Column, pattern_type: Column) -> Column:
    """How broad a theme is, from 0 to 1."""
    low = F.lower(field)
    abstract = F.exists(F.array(*[F.lit(x) for x in L.ABSTRACT_TERMS]), lambda t: F.contains(low, t))
    return mean_of(F.least(F.size(concepts) / 20, F.lit(1.0)), F.when(segments > 0, F.least(segments / 10, F.lit(1.0))), F.when(abstract, 0.8).otherwise(0.4), F.when(from_interaction(pattern_type), 0.9).otherwise(0.5))


def level(scope_score: Column) -> Column:
    return F.when(scope_score > 0.8, "meta").when(scope_score > 0.6, "primary").when(scope_score > 0.4, "sub").otherwise("micro")


def hierarchy(themes: DataFrame) -> DataFrame:
    """Adds scope, level, children and parent.

    A theme is the parent of those over 0.7 of whose concepts it has; of several parents the narrowest is kept.  Candidates share
    a concept within an episode, so themes that have none in common never meet."""
    t = themes.withColumn("scope", scope(F.col("concepts"), F.col("segments"), F.col("field"), F.col("pattern_type")))
    one = t.select("episode_id", "theme", F.size(F.array_distinct("concepts")).alias("size"), "scope", F.explode(F.array_distinct("concepts")).alias("concept"))
    up = one.select("episode_id", "concept", F.col("theme").alias("up"), F.col("scope").alias("up_scope"))
    links = one.join(up, ["episode_id", "concept"]).where("theme <> up").groupBy("episode_id", "theme", "size", "up", "up_scope").agg(F.count("*").alias("shared")).where("shared > size * 0.7")
    parent = links.groupBy("episode_id", "theme").agg(F.min_by("up", F.struct("up_scope", F.negative("up"))).alias("parent"))
    children = links.groupBy("episode_id", F.col("up").alias("theme")).agg(F.array_sort(F.collect_set(F.col("theme"))).alias("children"))
    d = t.join(parent, ["episode_id", "theme"], "left").join(children, ["episode_id", "theme"], "left")
    return d.withColumns({"level": level(F.col("scope")), "children": F.coalesce("children", F.array().cast(children.schema["children"].dataType))})


def metaphor(family: Column, count: Column) -> Column:
    """What a family of metaphors stands for, and how strongly."""
    known = F.create_map(*[F.lit(x) for kv in L.METAPHOR_MEANINGS.items() for x in kv])
    return F.concat_ws(" ", F.when(count >= 5, "strong").otherwise("moderate"), F.coalesce(F.try_element_at(known, family), F.lit(L.METAPHOR_DEFAULT)))


def messages(fields: DataFrame) -> DataFrame:
    """(…, kind, message, confidence) of fields (field, concepts, confidence): an optimistic or cautionary undertone where words of one kind are more than twice those of the
    other, and a normative stance in the names of sure fields; each message once."""
    low = F.transform("concepts", lambda c: F.lower(c))
    count = lambda words: F.size(F.filter(F.array(*[F.lit(w) for w in words]), lambda w: F.exists(low, lambda c: F.contains(c, w))))
    good, bad = count(L.POSITIVE_INDICATORS), count(L.NEGATIVE_INDICATORS)
    judged = F.exists(F.array(*[F.lit(x) for x in L.VALUE_TERMS]), lambda t: F.contains(F.lower("field"), t))
    one = lambda test, kind, confidence: F.when(test, F.struct(F.lit(kind).alias("kind"), confidence.alias("confidence")))
    found = F.filter(F.array(
        one(good > bad * 2, "Optimistic view of", F.lit(0.7)), one((bad > good * 2) & ~(good > bad * 2), "Cautionary stance on", F.lit(0.7)), one((F.col("confidence") > 0.7) & judged, "Normative stance on", F.col("confidence")),
    ), lambda x: x.isNotNull())
    d = fields.withColumn("_m", F.explode(found))
    return d.select("episode_id", F.concat_ws(" ", "_m.kind", "field").alias("message"), F.col("_m.confidence").alias("confidence")).groupBy("episode_id", "message").agg(F.max("confidence").alias("confidence"))


def contributions(themes: DataFrame, segments: DataFrame) -> DataFrame:
    """(episode_id, theme, segment_index, concepts, strength): the key concepts of a theme that each segment of its episode names."""
    j = segments.select("episode_id", "segment_index", F.lower("text").alias("_low")).join(themes.select("episode_id", "theme", F.col("concepts").alias("_c")), "episode_id")
    found = F.filter("_c", lambda c: F.contains(F.col("_low"), F.lower(c)))
    return j.select("episode_id", "theme", "segment_index", found.alias("concepts"), (F.size(found) / F.size("_c")).alias("strength")).where("size(concepts) > 0")


def interpretation(pattern_type: Column, family: Column, evolution: Column, validation: Column) -> Column:
    """Up to four sentences on a theme."""
    s = L.THEME_SENTENCES
    said = F.concat_ws(
        ". ", F.when(pattern_type == "emergence", s["emergence"]).when(pattern_type == "tension", s["tension"]), F.when(F.coalesce(family, F.lit("")) != "", F.format_string(s["metaphor"], family)),
        F.when(evolution == "crescendo", s["crescendo"]).when(evolution == "steady", s["steady"]), F.when(validation > 0.8, s["validated"]),
    )
    return F.coalesce(F.nullif(said, F.lit("")), F.lit(s["none"]))


def ranked(themes: DataFrame) -> DataFrame:
    """Adds the rank of each theme in its episode by emergence times confidence."""
    value = F.coalesce("emergence", F.lit(0.5)) * F.coalesce("confidence", F.lit(0.5))
    return themes.withColumn("rank", F.row_number().over(W.partitionBy("episode_id").orderBy(F.desc(F.round(value, 9)), "theme")))


def major(themes: DataFrame, k: int = 5) -> DataFrame:
    """The first ``k`` themes of each episode with five concepts each and what they mean."""
    d = ranked(themes).where(F.col("rank") <= k)
    return d.select("episode_id", "rank", F.coalesce("field", F.lit("Unknown theme")).alias("theme"), F.coalesce("emergence", F.lit(0.5)).alias("emergence"), F.slice("concepts", 1, 5).alias("supporting"), interpretation(F.col("pattern_type"), F.col("metaphor"), F.col("evolution"), F.col("validation")).alias("interpretation"))


def narrative(themes: DataFrame) -> DataFrame:
    """(episode_id, narrative): the first theme, how the first three evolve, how many there are, and whether they are implicit."""
    s = L.NARRATIVE_PARTS
    top = F.col("rank") <= 3
    g = ranked(themes).groupBy("episode_id").agg(F.max(F.when(F.col("rank") == 1, F.col("field"))).alias("field"), F.max(F.coalesce(top & (F.col("evolution") == "crescendo"), F.lit(False))).alias("up"), F.max(F.coalesce(top & (F.col("evolution") == "steady"), F.lit(False))).alias("even"), F.count("*").alias("n"), F.avg(F.when(top, F.coalesce("emergence", F.lit(0.5)))).alias("mean"))
    text = F.concat_ws(" ", F.format_string(s["dominant"], F.coalesce("field", F.lit("complex themes"))), F.when(F.col("up"), s["crescendo"]).when(F.col("even"), s["steady"]), F.when(F.col("n") > 1, F.format_string(s["connected"], F.col("n"))), F.when(F.round("mean", 9) > 0.7, s["implicit"]))
    return g.select("episode_id", F.concat(text, F.lit(".")).alias("narrative"))


def dominant_kind(entities: DataFrame, group: str) -> DataFrame:
    """(group, description): the most frequent type of a group's entities, the first of several, in words."""
    g = entities.where("type is not null").groupBy(group, "type").agg(F.count("*").alias("n")).groupBy(group).agg(F.min(F.struct(F.negative("n").alias("n"), "type"))["type"].alias("type"))
    all_groups = entities.select(group).distinct()
    return all_groups.join(g, group, "left").select(group, F.coalesce(F.concat(F.lower("type"), F.lit(" concepts")), F.lit("related concepts")).alias("description"))


def detect(themes: DataFrame, topics: list[str]) -> DataFrame:
    """Themes with their emergence and place in the hierarchy: what summaries and narratives start from."""
    said = F.array(*[F.lit(t) for t in topics]).cast("array<string>")
    return hierarchy(themes.withColumn("emergence", emergence(F.col("field"), said, F.col("segments"), F.col("pattern_type"), F.col("named"))))
