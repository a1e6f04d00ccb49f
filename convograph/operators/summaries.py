"""Summaries of how concepts move through an episode, and of whole runs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from convograph.operators.themes import mean_of


def closing(found: DataFrame) -> DataFrame:
    """(episode_id, share): of the concepts with over two mentions, those that span over four segments and come back in the last quarter of their span."""
    g = found.groupBy("episode_id", "entity_id").agg(F.count("*").alias("n"), F.min("segment_index").alias("lo"), F.max("segment_index").alias("hi")).where("n > 2")
    return g.groupBy("episode_id").agg(F.avg(((F.col("hi") - F.col("lo") + 1) > 4).cast("double")).alias("share"))


#: The least confidence at which each pattern of discourse is reported.
THRESHOLDS = {"linear_progression": 0.6, "hub_and_spoke": 0.5, "parallel_development": 0.6, "convergence": 0.5, "circular": 0.5}


def reported(scores: DataFrame, thresholds: dict[str, float] = THRESHOLDS) -> DataFrame:
    """(episode_id, pattern_type, confidence) of the patterns, a column each, that exceed their thresholds."""
    rows = F.array(*[F.when(F.col(k) > t, F.struct(F.lit(k).alias("pattern_type"), F.col(k).cast("double").alias("confidence"))) for k, t in thresholds.items()])
    return scores.select("episode_id", F.explode(F.filter(rows, lambda x: x.isNotNull())).alias("x")).select("episode_id", "x.*")


def coherence(transitions: DataFrame, resolutions: DataFrame, returns: DataFrame) -> DataFrame:
    """(episode_id, coherence): mean of what is known of an episode: smoothness of transitions, share of resolutions that answer, share of returns that close; 0.5 if nothing is.

    transitions: (episode_id, smoothness); resolutions: (episode_id, resolution_type); returns: (episode_id, closure)."""
    a = transitions.groupBy("episode_id").agg(F.avg(F.coalesce("smoothness", F.lit(0.5))).alias("a"))
    b = resolutions.groupBy("episode_id").agg(F.avg(F.col("resolution_type").isin("answered", "partial").cast("double")).alias("b"))
    c = returns.groupBy("episode_id").agg(F.avg(F.col("closure").cast("double")).alias("c"))
    d = a.join(b, "episode_id", "full_outer").join(c, "episode_id", "full_outer")
    return d.select("episode_id", F.coalesce(mean_of(F.col("a"), F.col("b"), F.col("c")), F.lit(0.5)).alias("coherence"))


def opening(introductions: DataFrame, before: int = 3) -> DataFrame:
    """Concepts that come up in the first segments."""
    return introductions.where(F.col("segment_index") < before)


def flow_summary(introductions: DataFrame, transitions: DataFrame, resolutions: DataFrame, returns: DataFrame, pattern: DataFrame, key: int = 5) -> DataFrame:
    """Per episode: opening concepts, first key transitions (pivots and rough ones), unresolved threads, themes that came full circle, pattern and coherence."""
    rough = transitions.where((F.col("kind") == "pivot") | (F.coalesce("smoothness", F.lit(1.0)) < 0.5))
    rough = rough.withColumn("_rn", F.row_number().over(W.partitionBy("episode_id").orderBy("segment_index"))).where(F.col("_rn") <= key)
    gather = lambda d, c, name: d.groupBy("episode_id").agg(F.array_sort(F.collect_set(c)).alias(name))
    parts = [
        gather(opening(introductions), "entity_id", "opening_concepts"), gather(rough, "segment_index", "key_transitions"),
        gather(resolutions.where("resolution_type in ('abandoned', 'deferred')"), "entity_id", "unresolved_threads"), gather(returns.where("closure"), "entity_id", "circular_themes"),
        pattern.select("episode_id", "flow_pattern"), coherence(transitions, resolutions, returns),
    ]
    d = reduce(lambda a, b: a.join(b, "episode_id", "full_outer"), parts)
    lists = {c: F.coalesce(c, F.array().cast(d.schema[c].dataType)) for c in ("opening_concepts", "key_transitions", "unresolved_threads", "circular_themes")}
    return d.withColumns({**lists, "flow_pattern": F.coalesce("flow_pattern", F.lit("unknown")), "coherence": F.coalesce("coherence", F.lit(0.5))})


def segment_importance(segments: DataFrame, introductions: DataFrame, transitions: DataFrame, resolutions: DataFrame, bridges: DataFrame, turns: DataFrame) -> DataFrame:
    """(episode_id, segment_index, importance): mean over what a segment does: introduce 1.0, pivot 0.8, resolve 0.9, bridge 0.7, turn 0.8; 0.3 if nothing.  The others are (episode_id, segment_index) tables."""
    key = ["episode_id", "segment_index"]
    d = segments.select(*key)
    for i, (part, score) in enumerate([(introductions, 1.0), (transitions.where("kind = 'pivot'"), 0.8), (resolutions, 0.9), (bridges, 0.7), (turns, 0.8)]):
        d = d.join(part.select(*key).distinct().withColumn(f"_{i}", F.lit(score)), key, "left")
    return d.select(*key, F.coalesce(mean_of(*[F.col(f"_{i}") for i in range(5)]), F.lit(0.3)).alias("importance"))


def role(pattern: Column, hub: Column) -> Column:
    """What part a concept plays, from the pattern of its mentions and whether others turn around it."""
    return F.when(pattern == "introduce-develop-conclude", "main_theme").when(pattern == "recurring-theme", "connecting_thread").when(pattern == "brief-mention", "supporting_detail").when(hub, "central_concept").otherwise("participant")


def with_flow(entities: DataFrame, lifecycles: DataFrame, momentum: DataFrame, hubs: DataFrame) -> DataFrame:
    """Entities (episode_id, entity_id) with the pattern and intensity of their mentions, mean momentum and role; null where they have none."""
    key = ["episode_id", "entity_id"]
    l = lifecycles.select(*key, F.col("pattern").alias("lifecycle"), F.col("development").alias("intensity"))  # noqa: E741
    m = momentum.groupBy(*key).agg(F.avg("momentum").alias("momentum"))
    d = entities.join(l, key, "left").join(m, key, "left").join(hubs.select(*key).distinct().withColumn("_hub", F.lit(True)), key, "left")
    return d.withColumn("role", role(F.col("lifecycle"), F.coalesce("_hub", F.lit(False)))).drop("_hub")


def positions(phases: DataFrame, resolutions: DataFrame, totals: DataFrame) -> DataFrame:
    """(episode_id, entity_id, introduction, duration, peak, resolution): first mention and middle elaboration as shares of the episode, ten for each change of phase, and how the concept ends.

    phases: (episode_id, entity_id, segment_index, phase); totals: (episode_id, n_segments)."""
    key = ["episode_id", "entity_id"]
    order = W.partitionBy(*key).orderBy("segment_index")
    changed = F.coalesce(F.col("phase") != F.lag("phase").over(order), F.lit(True))
    elaborated = F.array_sort(F.collect_list(F.when(F.col("phase") == "elaboration", F.col("segment_index"))))
    g = phases.withColumn("_new", changed).groupBy(*key).agg(F.min("segment_index").alias("first"), F.count_if("_new").alias("phases"), elaborated.alias("_e")).join(totals, "episode_id").join(resolutions.select(*key, "resolution_type"), key, "left")
    middle = F.coalesce(F.get("_e", F.floor(F.size("_e") / 2).cast("int")), F.lit(0))
    return g.select(*key, (F.col("first") / F.col("n_segments")).alias("introduction"), (F.col("phases") * 10.0).alias("duration"), (middle / F.col("n_segments")).alias("peak"), F.coalesce("resolution_type", F.lit("unknown")).alias("resolution"))


def flow_text(patterns: DataFrame, arcs: DataFrame, transitions: DataFrame, lifecycles: DataFrame) -> DataFrame:
    """(episode_id, summary): the surest pattern, the arc, how many pivots there are and how many concepts develop fully, in words."""
    words = lambda c: F.replace(c, F.lit("_"), F.lit(" "))
    first = patterns.groupBy("episode_id").agg(F.max_by(F.struct("pattern_type", "confidence"), F.struct("confidence", "pattern_type")).alias("p"))
    pivots = transitions.groupBy("episode_id").agg(F.count_if(F.col("kind") == "pivot").alias("pivots"))
    full = lifecycles.groupBy("episode_id").agg(F.count_if(F.col("pattern") == "introduce-develop-conclude").alias("full"))
    d = first.join(arcs, "episode_id", "full_outer").join(pivots, "episode_id", "full_outer").join(full, "episode_id", "full_outer")
    said = F.concat_ws(
        " ", F.when(F.col("p").isNotNull(), F.format_string("The discussion follows a %s pattern (%d%% confidence).", words(F.col("p.pattern_type")), F.round(F.col("p.confidence") * 100).cast("int"))),
        F.when(F.col("arc").isNotNull(), F.format_string("The narrative structure is primarily a %s arc, with %s resolution.", words(F.col("arc")), F.coalesce("resolution", F.lit("unknown")))),
        F.when(F.col("pivots") > 0, F.format_string("The conversation includes %d major topic shifts.", F.col("pivots"))), F.when(F.col("full") > 0, F.format_string("%d concepts are fully developed from introduction to conclusion.", F.col("full"))),
    )
    return d.select("episode_id", F.coalesce(F.nullif(said, F.lit("")), F.lit("Unable to generate flow summary.")).alias("summary"))


def run_summary(episodes: DataFrame) -> DataFrame:
    """One row over (source, entities, relationships, types ARRAY, failed) of processed episodes: sums and the sorted union of types.  An empty run has zeros."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    types = F.array_sort(F.array_distinct(F.flatten(F.collect_set("types"))))
    return episodes.agg(F.countDistinct("source").alias("sources"), F.count("*").alias("episodes"), F.count_if("failed").alias("failed"), total("entities"), total("relationships"), types.alias("types"))


def per_episode(entities: DataFrame, relationships: DataFrame) -> DataFrame:
    """(episode_id, entities, relationships, types) of a schemaless extraction."""
    e = entities.groupBy("episode_id").agg(F.count("*").alias("entities"), F.array_sort(F.collect_set("type")).alias("types"))
    r = relationships.groupBy("episode_id").agg(F.count("*").alias("relationships"))
    d = e.join(r, "episode_id", "full_outer")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return d.select("episode_id", zero("entities"), zero("relationships"), F.coalesce("types", F.array().cast("array<string>")).alias("types"))


def side_by_side(fixed: DataFrame, schemaless: DataFrame) -> DataFrame:
    """Counts of two extractions of the same episodes, and what one has more than the other."""
    f = fixed.select("episode_id", F.col("entities").alias("fixed"))
    s = schemaless.select("episode_id", F.col("entities").alias("schemaless"))
    d = f.join(s, "episode_id", "full_outer").select("episode_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("fixed", "schemaless")])
    return d.withColumn("difference", F.col("schemaless") - F.col("fixed"))


def in_priority(items: DataFrame, priority: str, position: str, size: int) -> DataFrame:
    """Items with their batch of ``size``: more urgent first, in order of position among equals.

    Urgencies are few, so only their sizes are summed over all items; within one, positions are ranked in ranges of ``size * 64``."""
    block = F.floor(F.col(position) / (size * 64))
    count = items.groupBy(priority, block.alias("_block")).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.orderBy(F.desc(priority), "_block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ahead = count.select(priority, "_block", before.alias("_before"))
    own = items.withColumn("_block", block).withColumn("_rn", F.row_number().over(W.partitionBy(priority, "_block").orderBy(position)))
    place = F.col("_before") + F.col("_rn") - 1
    return own.join(ahead, [priority, "_block"]).withColumn("place", place).withColumn("batch", F.floor(place / size)).drop("_block", "_rn", "_before")


def discovered(nodes: DataFrame) -> DataFrame:
    """(type, properties, nodes): what properties each type turned out to have."""
    return nodes.groupBy("type").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.array_sort(F.map_keys("props")))))).alias("properties"), F.count("*").alias("nodes"))


def flow_picture(timeline: DataFrame, transitions: DataFrame, most: int = 10) -> tuple[DataFrame, DataFrame]:
    """What a drawing of an episode's flow shows: streams, (episode_id, entity_id, points) in order, and the pivots and expansions among the first transitions.

    Transitions are ranked before they are kept; a stream is as long as its concept's mentions."""
    points = F.array_sort(F.collect_list(F.struct("segment_index", "density", "mention_type")))
    streams = timeline.groupBy("episode_id", "entity_id").agg(points.alias("points"))
    first = transitions.withColumn("_rn", F.row_number().over(W.partitionBy("episode_id").orderBy("segment_index"))).where(F.col("_rn") <= most)
    return streams, first.where(F.col("kind").isin("pivot", "expansion")).select("episode_id", "segment_index", "kind")
