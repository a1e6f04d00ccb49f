"""A small pattern language over the graph store, and its translation to generic nodes.

``(v:Label {key: $value})`` finds nodes and ``(a:Label)-[r:TYPE]->(b:Label)`` finds edges; nothing else is parsed."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convograph.operators.store import Graph

NODE = re.compile(r"^\s*MATCH\s*\((\w+)(?::(\w+))?\s*(?:\{(\w+)\s*:\s*\$(\w+)\})?\)\s*RETURN\s+\w+\s*$", re.I)
EDGE = re.compile(r"^\s*MATCH\s*\((\w+)(?::(\w+))?\)\s*-\[\w*:(\w+)\]->\s*\((\w+)(?::(\w+))?\)\s*RETURN\s+.+$", re.I)


def match(graph: Graph, query: str, parameters: dict | None = None) -> DataFrame:
    """Nodes, or (src, dst, type, weight) of edges between nodes of the named types."""
    if m := NODE.match(query):
        _, label, key, parameter = m.groups()
        d = graph.nodes.where(F.col("type") == label) if label else graph.nodes
        if key:
            value = str((parameters or {})[parameter])
            d = d.where(F.col(key) == value) if key in ("id", "name") else d.where(F.element_at("props", F.lit(key)) == value)
        return d
    if m := EDGE.match(query):
        _, left, kind, _, right = m.groups()
        e = graph.edges.where(F.col("type") == kind)
        for end, label in (("src", left), ("dst", right)):
            if label:
                e = e.join(graph.nodes.where(F.col("type") == label).select(F.col("id").alias(end)), end, "left_semi")
        return e.select("src", "dst", "type", "weight")
    raise ValueError(f"no such pattern: {query}")


def generic(query: str, labels: tuple[str, ...], renamed: dict[str, str]) -> str:
    """The query over ``Node`` with a ``_type``: labels become types, properties take their new names, edges become ``RELATIONSHIP``."""

    def node(m: re.Match) -> str:
        var, label, props = m.groups()
        inner = (props or "").strip("{} ")
        return f"({var}:Node {{_type: '{label}'{', ' + inner if inner else ''}}})"

    out = re.sub(rf"\((\w*):({'|'.join(labels)})\s*(\{{[^}}]*\}})?\)", node, query)
    for old, new in renamed.items():
        out = re.sub(rf"\.{old}\b", f".{new}", out)
        out = re.sub(rf"\b{old}(\s*:)", rf"{new}\1", out)
    return re.sub(r"-\[:(\w+)\]-", r"-[:RELATIONSHIP {_type: '\1'}]-", out)


def compiled(action: str, node_type: str, properties: dict | None = None, text: str | None = None) -> dict:
    """An intent for :meth:`Graph.find`."""
    return {"action": action, "type": node_type, "properties": properties or {}, "text_contains": text}
