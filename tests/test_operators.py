"""Micro-fixtures with values worked out by hand, and brute force where there is no SQL twin."""

import itertools
import random

from pyspark.sql import functions as F

from convograph.functions import text as T
from convograph.operators import components
from convograph.operators import entities as E
from convograph.operators import graph as G
from convograph.operators import mentions as M
from convograph.operators import networks as N
from convograph.operators.components import connected_components


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first()["x"]


def test_text_fixtures(spark):
    lit = F.lit
    s = one(spark, T.sentiment(lit("great great bad day")))
    assert (s.positive_count, s.negative_count, round(s.score, 3), s.polarity) == (2, 1, 0.333, "positive")
    assert one(spark, T.is_advertisement(lit("This is Sponsored By Acme")))
    assert [one(spark, T.syllables(lit(w))) for w in ("machine", "the", "rhythm")] == [2, 1, 1]
    assert [one(spark, T.normalize_name(lit(w))) for w in ("Acme, Inc.", "Dr. Smith & Co")] == ["acme", "doctor smith"]
    assert [one(spark, T.duration_seconds(lit(w))) for w in ("01:23:45", "23:45", "90", "x")] == [5025, 1425, 90, None]
    assert [one(spark, T.relation_type(lit(w))) for w in ("works at", "related-to", "Foo bar!")] == ["WORKS_AT", "RELATED_TO", "FOO_BAR"]
    assert one(spark, T.windowed_diversity(F.transform(F.sequence(lit(1), lit(60)), lambda i: i.cast("string")))) == 1.0
    assert round(one(spark, G.cosine(F.array(lit(1.0), lit(2.0)), F.array(lit(3.0), lit(4.0)))), 6) == 0.98387
    assert one(spark, T.clock(lit(3725))) == "01:02:05"
    assert not one(spark, E.is_acronym(lit("NASA"), lit("National Aeronautics and Space Administration")))
    assert one(spark, E.match(lit("AI"), lit("artificial intelligence"))).kind == "alias"
    assert round(one(spark, T.quote_importance(lit("insight " * 20), lit(0.9))), 2) == 0.72
    assert one(spark, E.frequency_factor(lit(4), lit(60))) == 1.0


def test_mentions_and_gaps(spark):
    seg = spark.createDataFrame([(1, 0, "The party started"), (1, 1, "art and music"), (1, 2, None)], "episode_id int, segment_index int, text string")
    ent = spark.createDataFrame([("e1", "Art"), ("e2", "music")], "entity_id string, name string")
    m = M.mentions(seg, ent)
    assert sorted((r.segment_index, r.entity_id) for r in m.collect()) == [(0, "e1"), (1, "e1"), (1, "e2")]
    assert [tuple(r) for r in M.co_occurrences(m).collect()] == [("e1", "e2", 1)]
    edges = spark.createDataFrame([("e1", "e2", 1), ("e3", "e4", 1), ("e1", "e3", 1)], "src string, dst string, weight int")
    c = spark.createDataFrame([("e1", 0), ("e2", 0), ("e3", 1), ("e4", 1)], "node string, community int")
    g = G.gaps(edges, c).first()
    assert (g.community_a, g.community_b, g.connections, round(g.gap_score, 6)) == (0, 1, 1, 0.666667)
    two = spark.createDataFrame([("a", "b", 1), ("c", "d", 1)], "src string, dst string, weight int")
    cc = spark.createDataFrame([("a", 0), ("b", 0), ("c", 1), ("d", 1)], "node string, community int")
    assert G.modularity(two, cc).first()[0] == 0.5


def test_components(spark):
    random.seed(1)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1120)]
    up = {}

    def top(x):
        while up.get(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        if a != b:
            up[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame([*edges, (5, None)], "src long, dst long")).collect()}
    assert got == {x: top(x) for a, b in edges if a != b for x in (a, b)}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_component_rounds_take_tasks_by_edges_not_by_shuffle_partitions(spark, monkeypatch):
    settings = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    was = {k: spark.conf.get(k) for k in settings}
    edges = spark.range(1, 400).selectExpr("id AS src", "id - id % 7 AS dst")
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        for rows, most in ((components.ROWS, 2 * components.LEAST), (20, 60)):
            monkeypatch.setattr(components, "ROWS", rows)
            found = connected_components(edges)
            assert found.rdd.getNumPartitions() <= most
            assert {r.node: r.component for r in found.collect()} == {i: i - i % 7 for i in range(399)}
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def test_networks_against_brute_force():
    random.seed(2)
    for _ in range(10):
        n = random.randint(3, 9)
        edges = [(a, b) for a, b in itertools.combinations(range(n), 2) if random.random() < 0.5]
        if not edges:
            continue
        adj = adjacent([(a, b, 1.0) for a, b in edges])
        nodes = sorted(adj)

        def paths(s, t):
            best, out = None, []
            todo = [[s]]
            while todo:
                p = todo.pop(0)
                if best and len(p) > best:
                    break
                if p[-1] == t:
                    best = len(p)
                    out.append(p)
                    continue
                todo += [[*p, u] for u in adj[p[-1]] if u not in p]
            return out

        want = dict.fromkeys(nodes, 0.0)
        for s, t in itertools.combinations(nodes, 2):
            ps = paths(s, t)
            for v in nodes:
                if v not in (s, t) and ps:
                    want[v] += sum(v in p for p in ps) / len(ps)
        k = len(nodes)
        scale = 2 / ((k - 1) * (k - 2)) if k > 2 else 0
        got, weighted = N.betweenness_of(adj), N.betweenness_of(adj, True)
        assert all(abs(got[v] - want[v] * scale) < 1e-9 and abs(weighted[v] - got[v]) < 1e-9 for v in nodes)
        parts = N.louvain_of(adj)
        assert set(parts) == set(nodes)
        assert all(parts[c] == c for c in parts.values())


def adjacent(edges):
    out = {}
    for a, b, w in edges:
        out.setdefault(a, {})[b] = out.setdefault(b, {})[a] = w
    return out


def test_two_cliques_are_two_communities():
    e = [*itertools.combinations(range(5), 2), *itertools.combinations(range(10, 15), 2), (0, 10)]
    assert set(N.louvain_of(adjacent([(a, b, 1.0) for a, b in e])).values()) == {0, 10}


def test_most_similar_takes_query_sets_in_blocks(spark):
    vectors = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(3)], "id long, v array<double>")
    queries = spark.range(12_001).select((F.col("id") % 4_001).alias("k"), F.col("id").alias("query")).select("query", F.array(F.lit(1.0), (F.col("k") % 3).cast("double")).alias("q"))
    got = G.most_similar(queries, vectors, top=1)
    want = queries.select("query", F.when(F.col("query") < 3, F.lit(None)).otherwise(F.element_at("q", 2)).cast("long").alias("id")).where("id is not null")
    assert got.count() == got.select("query").distinct().count() == 12_001
    assert got.where("query >= 3").select("query", "id").exceptAll(want).isEmpty()
