"""Operators for what no single task holds, against plain forms that hold it in one."""

import random
from collections import Counter
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from convograph.operators import centrality, choice, communities, gaps, graph, mentions, names, service, tiles
from convograph.operators import networks as N


def graphs(seed):
    """Groups of random graphs: parts that do not hang together, equal and unequal weights."""
    random.seed(seed)
    out = {}
    for g in range(3):
        nodes = [f"n{i}" for i in range(14)]
        pairs = {tuple(sorted(random.sample(nodes, 2))) for _ in range((12, 22, 30)[g])}
        out[g] = [(a, b, float(random.choice((1, 1, 2, 3)))) for a, b in sorted(pairs)]
    return out


def adjacent(edges):
    out = {}
    for a, b, w in edges:
        out.setdefault(a, {})[b] = out.setdefault(b, {})[a] = w
    return out


def modularity(edges, part):
    m, ends, inside = sum(w for *_, w in edges), Counter(), Counter()
    for a, b, w in edges:
        ends[part[a]] += w
        ends[part[b]] += w
        inside[part[a]] += w * (part[a] == part[b])
    return sum(inside[c] / m - (ends[c] / (2 * m)) ** 2 for c in ends)


def frame(spark, all_graphs):
    return spark.createDataFrame([(g, *e) for g, es in all_graphs.items() for e in es] + [(0, "n1", "n1", 5.0)], "g long, src string, dst string, weight double")


def test_centralities_of_graphs_that_no_task_holds(spark):
    some = {g: es for g, es in graphs(4).items() if g < 2}
    # by all tasks, and in one task each
    for work in (0, centrality.WORK):
        own = some if work else {1: some[1]}
        got = {(r.g, r.node): r for r in centrality.centralities(frame(spark, own), "g", work=work).collect()}
        assert len(got) == sum(len(adjacent(es)) for es in own.values())
        for g, es in own.items():
            adj = adjacent(es)
            b, wb, e = N.betweenness_of(adj), N.betweenness_of(adj, True), N.eigenvector_of(adj)
            for v in adj:
                r = got[g, v]
                assert abs(r.betweenness - b[v]) < 1e-9 and abs(r.weighted_betweenness - wb[v]) < 1e-9 and abs(r.eigenvector - e[v]) < 1e-6
                assert abs(r.degree - len(adj[v]) / (len(adj) - 1)) < 1e-12
    links = centrality._links(frame(spark, some), "g")
    got = centrality.betweenness(links, block=200).collect()
    assert all(abs(r.betweenness - N.betweenness_of(adjacent(some[r._g._group]), True)[r.v]) < 1e-9 for r in got)


def test_communities_of_graphs_that_no_task_holds(spark):
    some = graphs(5)
    # cliques that hang together by single edges
    some[7] = [(f"k{10 * c + i}", f"k{10 * c + j}", 1.0) for c in range(6) for i in range(6) for j in range(i)] + [(f"k{10 * c}", f"k{10 * (c + 1)}", 1.0) for c in range(5)]
    for limit in (10, communities.LIMIT):
        rows = communities.louvain(frame(spark, some), "g", limit=limit).collect()
        for g, es in some.items():
            part = {r.node: r.community for r in rows if r.g == g}
            assert part.keys() == adjacent(es).keys() and all(part[c] == c == min(v for v in part if part[v] == c) for c in part.values())
            alone = modularity(es, N.louvain_of(adjacent(es)))
            assert modularity(es, part) >= (alone * 0.99 if g == 7 or limit > 10 else alone - 0.06)
        assert len({r.community for r in rows if r.g == 7}) == 6
    assert communities.louvain(frame(spark, {}).where("src != dst")).isEmpty()


def test_mentions_of_two_hundred_thousand_names(spark, monkeypatch):
    random.seed(6)
    letters = "abcdeéIş ."
    texts = ["".join(random.choice(letters) for _ in range(random.choice((0, 3, 40, 90)))) for _ in range(120)] + [None, "", "AB", "x" * 400]
    names = {t[i : i + n].lower() for t in texts if t for i in range(len(t)) for n in (1, 2, 4, 5, 6, 11, 30)}
    while len(names) < 200_000:
        names.add("".join(random.choice(letters.lower()) for _ in range(random.randint(6, 9))))
    names = sorted(names - {""})
    monkeypatch.setattr(mentions, "BROADCAST_ROWS", 120_000)  # two slices
    s = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    e = spark.createDataFrame([(k, n.upper() if k % 3 == 0 and n.upper().lower() == n else n) for k, n in enumerate(names)] + [(-1, ""), (-2, None)], "k int, name string").coalesce(8)
    got = mentions.mentions(s, e)
    assert "NestedLoop" not in got._jdf.queryExecution().toString()
    got = got.select("i", "k").collect()
    want = {(i, k) for i, t in enumerate(texts) if t for k, n in enumerate(names) if n in t.lower()}
    assert len(got) == len(want) and {(r.i, r.k) for r in got} == want


def test_choices_in_rounds(spark):
    random.seed(7)
    rivals = {tuple(sorted(random.sample(range(60), 2), reverse=True)) for _ in range(90)} | {(100 + i + 1, 100 + i) for i in range(7)}
    kept = {}
    for v in sorted({x for r in rivals for x in r}):
        kept[v] = not any(kept[b] for a, b in rivals if a == v)
    got = choice.kept_first(spark.createDataFrame(sorted(rivals) * 2, "later long, earlier long")).collect()
    assert len(got) == len(kept) and {r.node: r.kept for r in got} == kept
    assert choice.kept_first(spark.createDataFrame([], "later long, earlier long")).count() == 0


def test_no_similar_pair_of_names_is_missed(spark):
    random.seed(8)
    words = ["a", "b", "ab", "abc", "abcd", "banana", "bananas", "mississippi", "misisipi", "aaaaaaaa", "aaaaaaa", "new york city", "new yrok city", "x" * 230, "x" * 229 + "y"]
    rows = [(g, i, x) for g in ("p", None) for i, x in enumerate(["", " ", None, *words, *("".join(random.choice("abc ") for _ in range(random.randint(1, 9))) for _ in range(50))])]
    d = spark.createDataFrame(rows, "g string, pos long, name string")
    for least in (0.81, 0.85):
        want = {}
        for g, j, y in rows:
            for h, i, x in rows:
                if g == h == "p" and i < j and x is not None and y is not None:
                    ratio = SequenceMatcher(None, y.lower().strip(), x.lower().strip()).ratio()
                    if ratio >= least:
                        want[i, j] = round(ratio, 9)
        assert {(r.a, r.b): round(r.similarity, 9) for r in names.similar(d, "g", least).where("g = 'p'").collect()} == want and want


def test_products_of_tiles(spark):
    random.seed(9)
    rows = [(i % 2, i, [random.choice([0.0, 1.0, -1.0, 2.0]) for _ in range(3)]) for i in range(70)] + [(0, 900, [0.0, 0.0, 0.0]), (0, 901, None)]
    d = spark.createDataFrame(rows, "g int, id long, v array<double>").repartition(3)

    def cos(a, b):
        m = (sum(x * x for x in a) * sum(x * x for x in b)) ** 0.5
        return round(sum(x * y for x, y in zip(a, b, strict=True)) / m, 12) if m else 0.0

    some = [r for r in rows if r[2]]
    got = tiles.alike(d, "g", 0.9, tile=8).collect()
    want = {(g, i, j) for g, i, a in some for h, j, b in some if g == h and i < j and cos(a, b) >= 0.9}
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    queries = d.where("id % 5 = 0").select(F.col("id").alias("query"), F.col("v").alias("q"))
    for tile in (8, 512):
        got = {(r.query, r["rank"]): r.id for r in tiles.nearest(queries, d.select("id", "v"), 3, 0.1, tile).collect()}
        want = {}
        for _, q, a in some:
            if q % 5 == 0:
                best = sorted((-cos(a, b), i) for _, i, b in some if i != q and cos(a, b) >= 0.1)[:3]
                want |= {(q, k): i for k, (_, i) in enumerate(best, 1)}
        assert got == want
    pairs = spark.createDataFrame([(0, 7), (3, 900), (5, 901)], "a long, b long")
    got = {(r.a, r.b, r["rank"]): r.via for r in gaps.paths(pairs, d.select("id", "v"), 0.2).collect()}
    v = {i: x for _, i, x in some}
    best = sorted((-(cos(v[0], x) + cos(v[7], x)), i) for i, x in v.items() if i not in (0, 7) and cos(v[0], x) > 0.2 and cos(v[7], x) > 0.2)[:3]
    assert got == {(0, 7, k): i for k, (_, i) in enumerate(best, 1)}
    assert tiles.nearest(queries.limit(0), d.select("id", "v"), 3).count() == 0


def test_percentiles_by_selection(spark):
    random.seed(10)
    rows = [(g, None if i % 40 == 0 else float(random.choice([random.randrange(9), random.random(), 10.0 ** random.randrange(9)]))) for g in ("a", "b", None) for i in range(400)] + [("one", 3.0), ("none", None)]
    d = spark.createDataFrame(rows, "g string, x double")
    for ranges in (4, 4096):
        got = {r.g: (r.p0, r.p50, r.p99, r.p100) for r in service.percentiles(d, ["g"], "x", [0, 50, 99, 100], ranges).collect()}
        want = {}
        for g in ("a", "b", None, "one"):
            x = sorted(v for h, v in rows if h == g and v is not None)
            want[g] = tuple(x[min(int(len(x) * p / 100), len(x) - 1)] for p in (0, 50, 99, 100))
        assert got == want


def test_gaps_of_many_communities(spark):
    """Pairs without a link, though the first communities are linked with almost all."""
    n = 40
    nodes = spark.createDataFrame([(i, i) for i in range(n)], "node long, community long")
    linked = [(i, j, 1.0) for i in range(25) for j in range(i + 1, n) if (i, j) not in {(3, 30), (11, 12)}] + [(5, 6, 1.0)] * 4
    edges = spark.createDataFrame(linked, "src long, dst long, weight double")
    counts = Counter((min(a, b), max(a, b)) for a, b, _ in linked)
    for few, top in ((3, 4), (3, 200), (1, 1), (9, 10**4)):
        want = sorted((counts[i, j], i, j) for i in range(n) for j in range(i + 1, n) if counts[i, j] < few)[:top]
        got = [(r.connections, r.community_a, r.community_b) for r in graph.gaps(edges, nodes, few, top).collect()]
        assert got == want


def test_limits_and_streaks_of_hot_keys(spark):
    random.seed(11)
    rows = [(i, random.choice(("hot", "hot", "hot", "a", None)), random.randrange(3000) if i % 50 else None, random.random() < 0.8) for i in range(1500)]
    d = spark.createDataFrame(rows, "i long, k string, s long, good boolean").withColumn("t", F.timestamp_seconds("s")).repartition(3)
    want = {}
    for i, k, s, _ in rows:
        same = [x for _, h, x, _ in rows if h == k and (x is None) == (s is None)]
        want[i] = tuple(len(same) if s is None else sum(s - n < x <= s for x in same) for n in (60, 700))
    got = {r.i: (r.in_60s, r.in_700s, r.limited) for r in service.over_limit(d, "k", "t", {60: 20, 700: 150}, stretch=100).collect()}
    assert got == {i: (a, b, a > 20 or b > 150) for i, (a, b) in want.items()}
    rows = [(i, random.choice(("hot", "hot", "hot", "a", None)), i < 200 or 400 < i < 900 or random.random() < 0.7) for i in range(1500)]
    want, now = {}, {}
    for i, k, good in rows:
        now[k] = (good, now[k][1] + 1) if k in now and now[k][0] == good else (good, 1)
        want[i] = now[k][1]
    got = service.streaks(spark.createDataFrame(rows, "i long, k string, good boolean").repartition(5), "k", ["i"], F.col("good"))
    assert {r.i: r.streak for r in got.collect()} == want and got.count() == len(rows)
