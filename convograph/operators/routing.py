"""Routing of pattern queries between the typed and the generic layout of a store, and what migrations and checkpoints say about themselves."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convograph.operators.store import Graph
from convograph.plans import patterns

#: Labels of the typed layout.
LABELS = ("Podcast", "Episode", "Segment", "Entity", "Insight", "Quote")


def is_fixed(query: Column, labels: tuple[str, ...] = LABELS) -> Column:
    """Whether a query speaks of labels of the typed layout."""
    return F.coalesce(query.rlike(rf":({'|'.join(labels)})\b"), F.lit(False))


def special(query: Column) -> Column:
    """Counts of distinct nodes by their id, and label tests as tests of the type."""
    q = F.regexp_replace(query, r"COUNT\(DISTINCT\s+(\w+)\)", r"COUNT(DISTINCT $1.id)")
    return F.regexp_replace(q, r"WHERE\s+(\w+):(\w+)", r'WHERE $1._type = "$2"')


def variations(name: str, names: dict[str, str]) -> list[str]:
    """Names under which a property may be stored: itself, mapped either way, with or without _id, in the other case style."""
    out = {name, *[new for old, new in names.items() if old == name], *[old for old, new in names.items() if new == name]}
    out.add(name[:-3] if name.endswith("_id") else f"{name}_id")
    if "_" in name:
        head, *rest = name.split("_")
        out.add(head + "".join(x.capitalize() for x in rest))
    else:
        out.add(re.sub(r"(?<!^)(?=[A-Z])", "_", name).lower())
    return sorted(out)


#: Canned questions over a graph: functions of the graph and parameters.
QUESTIONS = {
    "entities_by_type": lambda g, type, limit=10: g.nodes.where(F.col("type") == type).orderBy("id").limit(limit),
    "count_by_type": lambda g: g.nodes.groupBy("type").agg(F.count("*").alias("n")),
    "neighbours": lambda g, id, limit=10: g.neighbours().where(F.col("id") == id).orderBy(F.desc("weight"), "neighbour").limit(limit),
    "text_search": lambda g, text: g.find({"text_contains": text}),
    "by_property": lambda g, key, value: g.find({"properties": {key: value}}),
    "edges_above": lambda g, type, least: g.edges.where((F.col("type") == type) & (F.col("weight") > least)),
    "members_of": lambda g, id, type: g.edges.where((F.col("src") == id) & (F.col("type") == type)).select(F.col("dst").alias("id")),
}


def ask(graph: Graph, name: str, **parameters) -> DataFrame:
    """A canned question by name; parameters are values, never text of a query."""
    if name not in QUESTIONS:
        raise ValueError(f"no such question: {name}; there are {', '.join(sorted(QUESTIONS))}")
    return QUESTIONS[name](graph, **parameters)


def run(typed: Graph, generic: Graph, query: str, parameters: dict | None = None, names: dict[str, str] | None = None, mode: str = "generic") -> DataFrame:
    """A query where its layout is: on the typed graph if it speaks of its labels and the mode is ``fixed``, else translated and run on the generic one, whose
    rows come back under the labels they stand for."""
    fixed = any(f":{x}" in query for x in LABELS)
    if mode == "fixed" and fixed:
        return patterns.match(typed, query, parameters)
    nodes = generic.nodes.withColumn("type", F.coalesce(F.try_element_at("props", F.lit("_type")), F.col("type")))
    for old, new in (names or {}).items():
        query = re.sub(rf"\b{old}(\s*:)", rf"{new}\1", query)
    return patterns.match(Graph(nodes, generic.edges), query, parameters)


def needs_standardizing(rows: DataFrame) -> bool:
    """Whether results are of the generic layout."""
    return "_type" in rows.columns


def checkpoint_version(data: Column) -> Column:
    """Version of a checkpoint (JSON text) by the fields it has."""
    has = lambda k: F.coalesce(F.array_contains(F.json_object_keys(data), k), F.lit(False))
    return F.when(has("version"), F.get_json_object(data, "$.version")).when(has("schema_evolution") | has("extraction_mode"), "2").otherwise("1")


def latest_version(versions: DataFrame, target: str) -> DataFrame:
    """Whether the schema version applied last is the target."""
    return versions.agg(F.max_by("version", "applied_at").alias("version")).withColumn("complete", F.coalesce(F.col("version") == target, F.lit(False)))


def readiness(constraints: DataFrame, least: int = 7) -> DataFrame:
    """Whether enough of the constraints (constraint, n groups that break it) hold for a migration to start."""
    return constraints.agg(F.count_if(F.col("n") == 0).alias("held"), F.count("*").alias("constraints")).withColumn("ready", F.col("held") >= least)


def migration_plan(sources: dict[str, tuple[DataFrame, list[str]]], done: DataFrame | None = None) -> list[tuple[str, DataFrame]]:
    """The steps of a migration in order of what they depend on, each with the rows it has yet to do.

    sources: {step: (rows, steps before it)}; done: (step, id).  Steps that depend on each other in a circle are an error."""
    order: list[str] = []
    left = dict(sources)
    while left:
        free = sorted(k for k, (_, before) in left.items() if all(b in order for b in before))
        if not free:
            raise ValueError(f"steps in a circle: {', '.join(sorted(left))}")
        order += free
        left = {k: v for k, v in left.items() if k not in free}
    rest = lambda k: sources[k][0] if done is None else sources[k][0].join(done.where(F.col("step") == k).select("id"), "id", "left_anti")
    return [(k, rest(k)) for k in order]


def marker_metrics(before: Column, after: Column) -> dict[str, Column]:
    """How a text grew by its markers: lengths, growth, number of markers and their kinds."""
    found = F.regexp_extract_all(after, F.lit(r"\[([A-Z]+): "), F.lit(1))
    return {"before": F.length(before), "after": F.length(after), "growth": F.length(after) - F.length(before), "markers": F.size(found), "kinds": F.array_sort(F.array_distinct(found))}


#: Where a word of ASCII letters begins and ends: unlike those of ``\\b``, these edges do not depend on the regex engine's idea of letters.
WORD = ("(?<![A-Za-z0-9_])", "(?![A-Za-z0-9_])")


def quote_preview(text: Column) -> dict[str, Column]:
    """What a search for quotes would find: quoted passages, reported speech and statements in the first person."""
    count = lambda p: F.regexp_count(text, F.lit(p))
    return {"quoted": count(r'"[^"]{10,}"'), "reported": count(rf"(?i){WORD[0]}(said|says|told|asked){WORD[1]}"), "personal": count(rf"(?i){WORD[0]}I (think|believe|feel){WORD[1]}")}


def found(text: Column, pattern: str) -> Column:
    """All matches of a pattern."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


