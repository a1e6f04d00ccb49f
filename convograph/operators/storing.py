"""What an extraction found, as nodes and edges of the graph store, and nodes with the metadata of where they come from.

nodes: (id, type, name, props MAP<STRING, STRING>); edges: (src, dst, type, weight), as in ``store``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convograph.functions import text as T

STRINGS = "map<string,string>"


def props(**values: Column) -> Column:
    """Properties as text; those that are null are left out."""
    if not values:
        return F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in values.items()])
    return F.map_from_entries(F.filter(pairs, lambda p: p["value"].isNotNull()))


def nodes(rows: DataFrame, kind: str, key: Column, name: Column, /, **values: Column) -> DataFrame:
    return rows.select(key.cast("string").alias("id"), F.lit(kind).alias("type"), name.alias("name"), props(**values).alias("props"))


def edges(rows: DataFrame, src: Column, dst: Column, kind: str | Column, weight: Column | float = 1.0) -> DataFrame:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    weight = F.lit(weight) if isinstance(weight, float) else weight
    return rows.select(src.cast("string").alias("src"), dst.cast("string").alias("dst"), kind.alias("type"), weight.cast("double").alias("weight"))


def podcasts(rows: DataFrame) -> DataFrame:
    """Nodes of (id, name, description, rss_url); a podcast without a name is named by its id."""
    return nodes(rows, "Podcast", F.col("id"), F.coalesce("name", F.col("id").cast("string")), description=F.coalesce("description", F.lit("")), rss_url=F.coalesce("rss_url", F.lit("")))


def episodes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes of (id, podcast_id, title, description, flow struct<pattern, quality, transitions>) and their HAS_EPISODE edges.

    The flow of an episode, where one is known, becomes properties with defaults."""
    flow = F.col("flow")
    known = lambda c, default: F.when(flow.isNotNull(), F.coalesce(c.cast("string"), F.lit(default)))
    made = nodes(rows, "Episode", F.col("id"), F.col("title"), description=F.coalesce("description", F.lit("")), discourse_flow_pattern=known(flow["pattern"], "unknown"), flow_quality=known(flow["quality"], "0.5"), key_transitions_count=known(flow["transitions"], "0"))
    return made, edges(rows, F.col("podcast_id"), F.col("id"), "HAS_EPISODE")


def entities(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes of (episode_id, id, name, kind, confidence, importance, flow struct<introduction, duration, peak, resolution>) and MENTIONS edges that weigh their confidence.

    An entity is one node, whatever number of episodes mention it: that of the smallest episode."""
    confidence, flow = F.coalesce("confidence", F.lit(1.0)), F.col("flow")
    known = lambda c, default: F.when(flow.isNotNull(), F.coalesce(c.cast("string"), F.lit(default)))
    first = rows.groupBy("id").agg(F.min_by(F.struct(*[c for c in rows.columns if c != "id"]), "episode_id").alias("_e")).select("id", "_e.*")
    made = nodes(
        first, "Entity", F.col("id"), F.col("name"), entity_type=F.col("kind"), confidence=confidence, importance_score=F.coalesce("importance", F.lit(0.5)),
        flow_introduction_point=known(flow["introduction"], "0"), flow_development_duration=known(flow["duration"], "0"), flow_peak_discussion=known(flow["peak"], "0"), flow_resolution_status=known(flow["resolution"], "unknown"),
    )
    return made, edges(rows, F.col("episode_id"), F.col("id"), "MENTIONS", confidence)


def insights(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes of (episode_id, id, title, description, confidence) and HAS_INSIGHT edges."""
    return nodes(rows, "Insight", F.col("id"), F.col("title"), description=F.col("description"), confidence=F.col("confidence")), edges(rows, F.col("episode_id"), F.col("id"), "HAS_INSIGHT")


def quotes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes of (episode_id, text, speaker), identified by a hash of the text that is the same in every process, and CONTAINS_QUOTE edges; equal quotes of an episode are one."""
    rows = rows.dropDuplicates(["episode_id", "text"]).withColumn("_id", F.concat_ws("_quote_", F.col("episode_id").cast("string"), F.substring(F.sha2("text", 256), 1, 16)))
    return nodes(rows, "Quote", F.col("_id"), F.substring("text", 1, 100), speaker=F.col("speaker")), edges(rows, F.col("episode_id"), F.col("_id"), "CONTAINS_QUOTE")


def key_concepts(themes: DataFrame, known: DataFrame, most: int = 5) -> DataFrame:
    """(theme row id, entity id) of the first ``most`` key concepts of each theme (id, concepts) that an entity (episode_id, id, name, pos) of its episode has as its
    name, in any case; of several the one of the least ``pos``."""
    asked = themes.select("id", "episode_id", F.explode(F.slice("concepts", 1, most)).alias("_name")).select("id", "episode_id", F.lower("_name").alias("_key")).distinct()
    first = known.groupBy("episode_id", F.lower("name").alias("_key")).agg(F.min_by("id", "pos").alias("entity_id"))
    return asked.join(first, ["episode_id", "_key"]).select("id", "entity_id")


def themes(rows: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes of (episode_id, theme, field, emergence, confidence, concepts), HAS_EMERGENT_THEME edges that weigh the confidence, and COMPOSED_OF edges to key concepts."""
    half = lambda c: F.coalesce(F.col(c), F.lit(0.5))
    rows = rows.withColumn("id", F.concat_ws("_theme_", F.col("episode_id").cast("string"), F.coalesce("theme", F.substring(F.sha2("field", 256), 1, 16))))
    made = nodes(rows, "EmergentTheme", F.col("id"), F.coalesce("field", F.lit("Unknown")), emergence_score=half("emergence"), confidence=half("confidence"))
    return made, edges(rows, F.col("episode_id"), F.col("id"), "HAS_EMERGENT_THEME", half("confidence")).unionByName(edges(key_concepts(rows, known), F.col("id"), F.col("entity_id"), "COMPOSED_OF"))


def relationships(rows: DataFrame) -> DataFrame:
    """Edges between entities of (source_id, target_id, type, weight), their type in the normal form."""
    return edges(rows, F.col("source_id"), F.col("target_id"), T.relation_type(F.col("type")), F.coalesce("weight", F.lit(1.0)))


def everything(parts: list[tuple[DataFrame | None, DataFrame | None]]) -> tuple[DataFrame, DataFrame]:
    """All nodes and all edges of some (nodes, edges), in the order given; one write of each stores an episode whole."""
    n, e = [x for x, _ in parts if x is not None], [x for _, x in parts if x is not None]
    return reduce(DataFrame.unionByName, n), reduce(DataFrame.unionByName, e)


def duplicated(rows: DataFrame, constraints: dict[str, list[str]], kind: str = "type") -> DataFrame:
    """(constraint, n): how many groups of rows break each uniqueness constraint {type: columns}.  Tables need no indexes; this is what a schema set-up has to promise."""
    out = [rows.where(F.col(kind) == k).groupBy(*cols).agg(F.count("*").alias("_n")).agg(F.count_if(F.col("_n") > 1).alias("n")).select(F.lit(k).alias("constraint"), "n") for k, cols in constraints.items()]
    return reduce(DataFrame.unionByName, out)


def clock(seconds: Column) -> Column:
    """Seconds as H:MM:SS, or MM:SS below an hour."""
    s = F.floor(seconds).cast("int")
    short = F.format_string("%02d:%02d", (s / 60).cast("int"), s % 60)
    return F.when(s >= 3600, F.format_string("%02d:%02d:%02d", (s / 3600).cast("int"), ((s % 3600) / 60).cast("int"), s % 60)).otherwise(short)


def temporal(start: Column, end: Column) -> dict[str, Column]:
    """When a node was talked about; what is not known is null."""
    return {"start_time": start, "end_time": end, "duration": end - start, "timestamp_formatted": clock(start)}


def extraction(method: str, version: str, at: Column | None = None) -> dict[str, Column]:
    return {"extracted_at": F.current_timestamp() if at is None else at, "extraction_method": F.lit(method), "extractor_version": F.lit(version)}


def described(found: DataFrame, segments: DataFrame, sources: DataFrame, method: str, version: str, at: Column | None = None) -> DataFrame:
    """Nodes found in segments (episode_id, segment_index, ...) with when and where they were said and from which source.

    segments: (episode_id, segment_index, speaker, text, start_time, end_time); sources: (episode_id, episode_title, podcast_id, podcast_name).  Both
    are joined by key; a node of an unknown segment or episode keeps nulls."""
    s = segments.select("episode_id", "segment_index", *[c.alias(k) for k, c in temporal(F.col("start_time"), F.col("end_time")).items()], F.col("speaker").alias("mentioned_by"), F.concat_ws("_segment_", F.col("episode_id").cast("string"), F.col("segment_index").cast("string")).alias("segment_id"), F.size(T.words(F.col("text"))).alias("segment_word_count"))
    return found.join(s, ["episode_id", "segment_index"], "left").join(sources, "episode_id", "left").withColumns(extraction(method, version, at))


def described_relationships(found: DataFrame, segments: DataFrame, confidence: float = 0.75) -> DataFrame:
    """Relationships found in segments with when they were said; those without a confidence get the default."""
    s = segments.select("episode_id", "segment_index", F.col("start_time").alias("mentioned_at"), F.concat_ws("_segment_", F.col("episode_id").cast("string"), F.col("segment_index").cast("string")).alias("segment_id"))
    return found.join(s, ["episode_id", "segment_index"], "left").withColumn("confidence", F.coalesce("confidence", F.lit(confidence)))


def embedding_text(name: Column, description: Column) -> Column:
    """What of a node is embedded."""
    return F.concat_ws(" ", name, description)


def renamed(properties: Column, names: dict[str, str]) -> Column:
    """Property names by a mapping, else by the mapping read backwards, else as they are."""
    back = {v: k for k, v in names.items()}
    table = F.create_map(*[F.lit(x) for kv in {**back, **names}.items() for x in kv])
    return F.transform_keys(properties, lambda k, v: F.coalesce(F.try_element_at(table, k), k))


def coerced(properties: Column, kinds: dict[str, str], defaults: dict[str, str]) -> Column:
    """Properties with defaults for those required, numbers and booleans in one spelling, and lists where single values stand.

    kinds: number, boolean or array by property; what cannot be read as its kind is left as it is."""
    keyed = F.map_concat(F.map_filter(F.create_map(*[F.lit(x) for kv in defaults.items() for x in kv]).cast(STRINGS), lambda k, v: ~F.map_contains_key(properties, k)), properties) if defaults else properties

    def one(k: Column, v: Column) -> Column:
        of = lambda kind: k.isin([p for p, x in kinds.items() if x == kind])
        number = F.coalesce(v.try_cast("double").cast("string"), v)
        boolean = F.when(F.lower(v).isin("true", "1", "yes"), "true").when(F.lower(v).isin("false", "0", "no"), "false").otherwise(v)
        array = F.when(v.startswith("["), v).otherwise(F.to_json(F.array(v)))
        return F.when(of("number"), number).when(of("boolean"), boolean).when(of("array"), array).otherwise(v)

    return F.transform_values(keyed, one)


def fallbacks(rows: DataFrame, columns: dict[str, list[str]], defaults: dict[str, str] | None = None) -> DataFrame:
    """(id, columns): each from the first property that is there, else its default."""
    pick = lambda c, alts: F.coalesce(*[F.try_element_at("props", F.lit(a)) for a in alts], F.lit((defaults or {}).get(c)))
    return rows.select("id", *[pick(c, alts).alias(c) for c, alts in columns.items()])


def missing_fields(rows: DataFrame, schema: dict[str, str]) -> Column:
    """What a result lacks of an expected schema {column: type}: the column, or a value of that type."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    checks = [F.lit(f"{c}: missing") if c not in kinds else F.when(F.col(c).isNull(), F.lit(f"{c}: null")) if kinds[c] == t else F.lit(f"{c}: {kinds[c]}, not {t}") for c, t in schema.items()]
    return F.filter(F.array(*checks), lambda x: x.isNotNull())


def dual(rows: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """Nodes in both layouts, as a store in migration writes them: typed, and generic with the type as a property."""
    typed = rows.where(F.col("type") == kind)
    return typed, typed.select("id", F.lit("Node").alias("type"), "name", F.map_concat(F.create_map(F.lit("_type"), F.col("type")), "props").alias("props"))


def said(quoted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Quotes (episode_id, text, speaker) as nodes of an extraction, their value cut at 100 characters, and SAID edges from who speaks; a quote of no one has no edge."""
    made = quotes(quoted)[0].withColumn("props", F.map_concat("props", F.create_map(F.lit("value"), F.col("name"))))
    who = edges(quoted.where(F.col("speaker").isNotNull()).dropDuplicates(["episode_id", "text"]), F.col("speaker"), F.concat_ws("_quote_", F.col("episode_id").cast("string"), F.substring(F.sha2("text", 256), 1, 16)), "SAID")
    return made, who


def mapping_text(names: dict[str, str], defaults: dict[str, str]) -> str:
    """The property mappings of a store as a Markdown table."""
    rows = [f"| {old} | {new} | {defaults.get(new, '')} |" for old, new in sorted(names.items())]
    return "\n".join(["| property | stored as | default |", "|---|---|---|", *rows])
