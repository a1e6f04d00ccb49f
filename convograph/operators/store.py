"""A property graph as two tables, its checks, its query patterns and its schema migrations.

nodes: (id, type, name, props MAP<STRING, STRING>); edges: (src, dst, type, weight)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convograph.functions import text as T

ESSENTIAL = ["id", "name", "segment_id", "episode_id", "podcast_id"]


class Graph:
    """Nodes and edges; every change returns a new graph."""

    def __init__(self, nodes: DataFrame, edges: DataFrame):
        self.nodes, self.edges = nodes, edges

    def add_nodes(self, nodes: DataFrame) -> Graph:
        return Graph(self.nodes.unionByName(nodes), self.edges)

    def add_edges(self, edges: DataFrame) -> Graph:
        """Adds the edges both ends of which exist."""
        ids = self.nodes.select("id")
        known = edges.join(ids.withColumnRenamed("id", "src"), "src", "left_semi").join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi")
        return Graph(self.nodes, self.edges.unionByName(known.select(self.edges.columns)))

    def update(self, changes: DataFrame) -> Graph:
        """Overwrites properties by (id, props); unknown ids are left out, the id itself stays."""
        c = changes.select("id", F.col("props").alias("_new"))
        merged = F.map_concat(F.map_filter("props", lambda k, v: ~F.coalesce(F.map_contains_key("_new", k), F.lit(False))), F.coalesce("_new", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))))
        return Graph(self.nodes.join(c, "id", "left").withColumn("props", merged).drop("_new"), self.edges)

    def delete(self, ids: DataFrame) -> Graph:
        """Removes nodes and the edges that touch them."""
        i = ids.select("id").distinct()
        e = self.edges.join(i.withColumnRenamed("id", "src"), "src", "left_anti").join(i.withColumnRenamed("id", "dst"), "dst", "left_anti")
        return Graph(self.nodes.join(i, "id", "left_anti"), e)

    def counts(self) -> DataFrame:
        n = self.nodes.groupBy("type").agg(F.count("*").alias("n")).select(F.lit("node").alias("kind"), "type", "n")
        return n.unionByName(self.edges.groupBy("type").agg(F.count("*").alias("n")).select(F.lit("edge").alias("kind"), "type", "n"))

    def neighbours(self, node_type: str | None = None) -> DataFrame:
        """(id, neighbour, type, weight) over edges of either direction."""
        e = self.edges.select(F.col("src").alias("id"), F.col("dst").alias("neighbour"), "type", "weight").unionByName(self.edges.select(F.col("dst").alias("id"), F.col("src").alias("neighbour"), "type", "weight"))
        return e.join(self.nodes.where(F.col("type") == node_type).select("id"), "id", "left_semi") if node_type else e

    def orphans(self, node_type: str, edge_type: str) -> DataFrame:
        """Nodes of a type without an outgoing edge of a type."""
        return self.nodes.where(F.col("type") == node_type).join(self.edges.where(F.col("type") == edge_type).select(F.col("src").alias("id")), "id", "left_anti")

    def dangling(self) -> DataFrame:
        """Edges with an end that does not exist."""
        ids = self.nodes.select("id")
        a = self.edges.join(ids.withColumnRenamed("id", "src"), "src", "left_anti").withColumn("end", F.lit("src"))
        return a.unionByName(self.edges.join(ids.withColumnRenamed("id", "dst"), "dst", "left_anti").withColumn("end", F.lit("dst")).select(a.columns))

    def duplicates(self) -> DataFrame:
        return self.nodes.groupBy("type", "id").agg(F.count("*").alias("n")).where("n > 1")

    def find(self, intent: dict) -> DataFrame:
        """Compiles an intent {action: find|count|exists, type, properties, text_contains} to filters."""
        d = self.nodes
        if intent.get("type"):
            d = d.where(F.col("type") == intent["type"])
        for k, v in (intent.get("properties") or {}).items():
            d = d.where(F.element_at("props", F.lit(k)) == str(v))
        if intent.get("text_contains"):
            d = d.where(F.contains(F.lower("name"), F.lit(intent["text_contains"].lower())))
        action = intent.get("action", "find")
        if action == "find":
            return d
        if action == "count":
            return d.agg(F.count("*").alias("n"))
        if action == "exists":
            return d.limit(1).agg((F.count("*") > 0).alias("exists"))
        raise ValueError(f"unknown action {action}")


def limited_properties(props: Column, most: int = 50) -> Column:
    """At most ``most`` properties: the essential ones, then the first by name."""
    keys = F.array_sort(F.map_keys(props))
    first = F.filter(keys, lambda k: k.isin(ESSENTIAL))
    kept = F.slice(F.concat(first, F.array_except(keys, first)), 1, most)
    return F.map_filter(props, lambda k, v: F.array_contains(kept, k))


def schemaless(nodes: DataFrame, label: str) -> DataFrame:
    """Rows of a typed table as generic nodes: (id, _type, props variant)."""
    return nodes.select(F.col("id").cast("string").alias("id"), F.lit(label).alias("_type"), F.to_variant_object(F.struct(*[c for c in nodes.columns if c != "id"])).alias("props"))


def standardized(nodes: DataFrame, names: dict[str, list[str]], defaults: dict[str, str]) -> DataFrame:
    """Typed columns from variant properties: the first name that is present, else the default."""
    pick = lambda c, alts: F.coalesce(*[F.try_variant_get("props", f"$.{a}", "string") for a in alts], F.lit(defaults.get(c)))
    return nodes.select("id", "_type", *[pick(c, alts).alias(c) for c, alts in names.items()])


#: Schema versions in order, with the step up from the one before and down to it.
Step = Callable[[DataFrame], DataFrame]
VERSIONS: list[tuple[str, Step, Step]] = [
    ("1.0.0", lambda d: d.withColumn("schema_version", F.lit("1.0.0")), lambda d: d.drop("schema_version")),
    ("1.1.0", lambda d: d.withColumns({"schema_version": F.lit("1.1.0"), "migrated": F.lit(True)}), lambda d: d.drop("migrated").withColumn("schema_version", F.lit("1.0.0"))),
]


def migrate(d: DataFrame, start: str, end: str) -> DataFrame:
    """Applies the steps between two versions, up or down."""
    order = ["0.0.0", *[v for v, _, _ in VERSIONS]]
    a, b = order.index(start), order.index(end)
    for i in range(a, b):
        d = VERSIONS[i][1](d)
    for i in range(a, b, -1):
        d = VERSIONS[i - 1][2](d)
    return d


def violations(d: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(columns, violation) for each rule that a row breaks, from one scan."""
    each = F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(k)) for k, c in rules.items()]), lambda x: x.isNotNull())
    return d.withColumn("violation", F.explode(each))


def relationship(a: Column, b: Column, pairs: dict[tuple[str, str], str], default: str = "RELATED_TO") -> Column:
    """Relation of two entity types, whatever their order."""
    out = F.lit(default)
    for (x, y), name in pairs.items():
        out = F.when(((a == x) & (b == y)) | ((a == y) & (b == x)), F.lit(name)).otherwise(out)
    return out


def enriched(text: Column, segment: Column, title: Column, start: Column, end: Column, speaker: Column) -> Column:
    """A segment's text with its context as markers."""
    head = F.concat(F.lit("[SEGMENT: "), segment, F.lit("] [EPISODE: "), title, F.lit("] [TIME: "), F.format_string("%.1f", start), F.lit("-"), F.format_string("%.1f", end), F.lit("s] [SPEAKER: "), speaker, F.lit("] "))
    return T.flat(F.concat(head, text))


def markers(enriched_text: Column) -> dict[str, Column]:
    """The context back from the markers, and the text without them."""
    get = lambda p: F.nullif(F.regexp_extract(enriched_text, p, 1), F.lit(""))
    return {"segment": get(r"\[SEGMENT: ([^\]]+)\]"), "episode": get(r"\[EPISODE: ([^\]]+)\]"), "time": get(r"\[TIME: ([^\]]+)\]"), "speaker": get(r"\[SPEAKER: ([^\]]+)\]"), "clean": F.trim(F.regexp_replace(enriched_text, r"\[[A-Z]+: [^\]]*\]\s*", ""))}
