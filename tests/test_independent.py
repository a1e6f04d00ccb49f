"""Operators without a SQL twin against plain re-statements of what they compute, and the general sides of those whose queries show one case."""

import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from convograph.operators import merging as R
from convograph.operators import routing as Q
from convograph.operators import sets as S
from convograph.operators import storing
from convograph.operators import summaries as U
from convograph.operators import themes as H
from convograph.operators.names import greedy_resolve
from convograph.operators.store import Graph
from convograph.plans import catalog

SF = "/root/testdata/sf0.001"


def names(seed, n=60):
    random.seed(seed)
    base = ["".join(random.choice("abcdeorst") for _ in range(random.randint(3, 14))) for _ in range(n // 4)]
    out = []
    for _ in range(n):
        s = list(random.choice(base))
        if random.random() < 0.6:
            s[random.randrange(len(s))] = random.choice("abxyz")
        out.append("".join(s).title() if random.random() < 0.3 else "".join(s))
    return out


def test_name_similarity(spark):
    got = {r.p_partkey: r.similarity for r in catalog.queries()["name_similarity"](spark, SF).collect()}
    parts = spark.read.parquet(f"{SF}/part.parquet").collect()
    assert got == {p.p_partkey: round(SequenceMatcher(None, p.p_name.lower(), p.p_type.lower()).ratio(), 6) for p in parts}


def test_candidates_miss_no_similar_name(spark):
    both = names(1, 120)
    a, b = both[:60], both[60:]
    new = spark.createDataFrame([(i, x, "t" if i % 3 else "u") for i, x in enumerate(a)] + [(900, None, "t"), (901, "", "t")], "new_id int, name string, type string")
    known = spark.createDataFrame([(i, x, "t", [a[i % len(a)]] if i % 5 == 0 else None) for i, x in enumerate(b)], "id int, name string, type string, aliases array<string>")
    got = {(r.new_id, r.id): (round(r.similarity, 6), r.match_type) for r in R.candidates(new, known).collect()}
    want = {}
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            if i % 3 == 0:
                continue
            ratio = SequenceMatcher(None, x.lower(), y.lower()).ratio()
            if x.lower() == y.lower():
                want[i, j] = (1.0, "exact_normalized")
            elif j % 5 == 0 and a[j % len(a)].lower() == x.lower():
                want[i, j] = (0.95, "alias_match")
            elif ratio >= 0.85:
                want[i, j] = (round(ratio, 6), "fuzzy_match")
    assert got == want and any(k == "fuzzy_match" for _, k in got.values())


def test_greedy_resolution(spark):
    rows = [(g, i, x) for g in ("p", "q") for i, x in enumerate(names(3 + ord(g)))]
    got = {(r.g, r.pos): r.merged_into for r in greedy_resolve(spark.createDataFrame(rows, "g string, pos long, name string"), "g").collect()}
    want, kept = {}, {}
    for g, i, x in rows:
        best = [(-SequenceMatcher(None, x.lower(), y).ratio(), j) for j, y in kept.get(g, [])]
        best = min((b for b in best if -b[0] >= 0.85), default=None)
        want[g, i] = best[1] if best else i
        if not best:
            kept.setdefault(g, []).append((i, x.lower()))
    assert got == want


def test_clusters_are_kept_greedily(spark):
    random.seed(5)
    rows = [(g, k, [f"m{random.randrange(9)}" for _ in range(random.randint(1, 6))], random.randrange(5) / 5) for g in (1, 2) for k in range(20)]
    d = spark.createDataFrame(rows, "g int, key int, members array<string>, coherence double")
    want = set()
    for g in (1, 2):
        kept = []
        for _, k, m, _ in sorted((r for r in rows if r[0] == g), key=lambda r: (-r[3], r[1])):
            if all(len(set(m) & x) <= 0.8 * len(set(m)) for x in kept):
                kept.append(set(m))
                want.add((g, k))
    assert {(r.g, r.key) for r in S.distinct_clusters(d, "g").collect()} == want


def test_leaders(spark):
    random.seed(6)
    rows = [(g, i, [random.choice([0.0, 1.0, 2.0]) + random.random() / 5 for _ in range(3)]) for g in (1, 2) for i in range(25)]
    got = {(r.g, r.id): r.cluster for r in S.leader_clusters(spark.createDataFrame(rows, "g int, id int, v array<double>"), "g", least=0.95).collect()}
    cos = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True)) / (sum(x * x for x in a) * sum(x * x for x in b)) ** 0.5
    want = {}
    for g in (1, 2):
        leaders = {}
        for _, i, v in (r for r in rows if r[0] == g):
            near = next((j for j in leaders if cos(v, leaders[j][0]) >= 0.95), None)
            if near is None:
                leaders[i] = (v, [i])
            else:
                leaders[near][1].append(i)
        want |= {(g, i): j for j, (_, m) in leaders.items() if len(m) >= 2 for i in m}
    assert got == want


def test_merged_entities_by_hand(spark):
    rows = [(1, 0, "Acme", "Maker of things", ["ACME Inc"], 0.5, {"a": "1"}), (1, 1, "Acme Corp", "Maker", ["Acme Group"], 0.9, {"a": "2", "b": "3"}), (1, 2, "acme group", None, None, 0.1, None), (2, 0, "Solo", None, None, 0.4, None)]
    d = spark.createDataFrame(rows, "cluster int, pos int, name string, description string, aliases array<string>, confidence double, metadata map<string,string>")
    got = {r.cluster: r for r in R.merged(d).collect()}
    assert (got[1].name, got[1].confidence, got[1].description) == ("Acme Corp", 0.9, "Maker. Maker of things")
    assert got[1].aliases == ["Acme Group"] and got[1].metadata == {"a": "2", "b": "3"}
    assert (got[2].name, got[2].description, got[2].aliases) == ("Solo", "", [])
    assert R.merged(d.limit(0)).count() == 0 and R.reduction(d.limit(0), "cluster").first()[:4] == (0, 0, 0, 0.0)


def test_routing(spark):
    assert Q.variations("start_time", {"start_time": "begin", "t": "start_time"}) == ["begin", "startTime", "start_time", "start_time_id", "t"]
    assert Q.variations("episodeId", {}) == ["episodeId", "episodeId_id", "episode_id"]
    g = Graph(spark.createDataFrame([("1", "A", "x", {"k": "v"})], "id string, type string, name string, props map<string,string>"), spark.createDataFrame([("1", "2", "T", 0.9), ("1", "3", "T", 0.2)], "src string, dst string, type string, weight double"))
    assert [r.dst for r in Q.ask(g, "edges_above", type="T", least=0.5).collect()] == ["2"] and Q.ask(g, "by_property", key="k", value="v").count() == 1
    assert [r.neighbour for r in Q.ask(g, "neighbours", id="1", limit=1).collect()] == ["2"]
    with pytest.raises(ValueError, match="no such question"):
        Q.ask(g, "drop_everything")
    with pytest.raises(ValueError, match="circle"):
        Q.migration_plan({"a": (g.nodes, ["b"]), "b": (g.nodes, ["a"])})
    assert Q.needs_standardizing(g.nodes.withColumn("_type", F.lit("x"))) and not Q.needs_standardizing(g.nodes)


def test_summaries_of_nothing(spark):
    e = lambda ddl: spark.createDataFrame([], ddl)
    assert U.run_summary(e("source string, entities long, relationships long, types array<string>, failed boolean")).first()[:5] == (0, 0, 0, 0, 0)
    one = spark.createDataFrame([(1, 0.4)], "episode_id int, smoothness double")
    none = e("episode_id int, resolution_type string"), e("episode_id int, closure boolean")
    assert U.coherence(one, *none).collect() == [(1, 0.4)]
    t = e("episode_id int, theme int, field string, concepts array<string>, segments int, pattern_type string, named boolean, metaphor string, evolution string, validation double, confidence double")
    assert H.detect(t, []).count() == 0 and H.narrative(H.detect(t, [])).count() == 0
    assert storing.quotes(spark.createDataFrame([(1, "a", "x"), (1, "a", "y")], "episode_id int, text string, speaker string"))[0].count() == 1
