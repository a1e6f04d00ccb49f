"""References, cross-cluster patterns and placed matches against plain loops."""

import math
import random
import re

from convograph.functions import lexicons as L
from convograph.operators import references as R
from convograph.operators import storing

ENTITY = "episode_id string, entity_id string, name string, aliases array<string>, description string, mention_count long"
INSIGHT = "episode_id string, insight_id long, title string, description string, supporting array<string>, confidence double"
NAMES = ["Solar Cell", "cell", "grid", "Ohm", "volt", "Wind Farm"]


def made(seed):
    random.seed(seed)
    text = lambda: random.choice([None, "", " ".join(random.choices([*NAMES, "the", "causes", "needs", "vs", "forms", "CELLS"], k=6))])
    entities = [(e, f"{e}{i}", name, random.choice([None, [], ["OHM"], ["wind", None, ""]]), text(), random.choice([None, 0, 4, 25])) for e in "ab" for i, name in enumerate([*NAMES, None])]
    insights = [(e, i, text(), text(), random.choice([None, [], random.choices([x[1] for x in entities if x[0] == e] + ["gone", None], k=4)]), i / 10) for e in "ab" for i in range(8)]
    return entities, insights


def test_cross_references(spark):
    for seed in range(2):
        entities, insights = made(seed)
        want = {}
        for ep, id_, name, aliases, _, _ in entities:
            own = {x.lower() for x in [name, *(aliases or [])] if x}
            n, w = 0, 0.0
            for ep2, other, _, _, text, count in entities:
                if ep2 == ep and other != id_ and text and any(x in text.lower() for x in own):
                    n, w = n + 1, w + min(1.0, (count or 0) / 10)
            for ep2, _, title, text, support, _ in insights:
                if ep2 == ep:
                    hit = any(x in " ".join(t for t in (title, text) if t is not None).lower() for x in own)
                    there = id_ in (support or [])
                    n, w = n + hit + there, w + 1.5 * hit + 2.0 * there
            want[ep, id_] = (n, round(w, 6), round(min(1.0, math.log(1 + w) / math.log(11)), 6))
        got = R.cross_references(spark.createDataFrame(entities, ENTITY), spark.createDataFrame(insights, INSIGHT)).collect()
        assert {(r.episode_id, r.entity_id): (r.n_references, round(r.weight, 6), round(r.score, 6)) for r in got} == want and len(got) == len(want)
    empty = R.cross_references(spark.createDataFrame([], ENTITY), spark.createDataFrame([], INSIGHT))
    assert empty.count() == 0
    alone = R.cross_references(spark.createDataFrame(entities, ENTITY), spark.createDataFrame([], INSIGHT))
    assert alone.count() == len(entities)


def test_cross_cluster_patterns(spark):
    _, insights = made(5)
    insights += [("a", 90, None, "Heat CAUSES stress and needs care", ["a0", "a1"], 0.9), ("a", 91, None, "one leads to two", ["a0"], 0.5), ("b", 90, None, "new vs old", None, None)]
    clusters = [("a", 1, ["a0", "a2", None]), ("a", 2, ["a1", "a2"]), ("b", 1, ["b0", "b1", "b2"]), ("b", 3, ["b3"]), ("b", 4, None)]
    of = {}
    for ep, c, members in clusters:
        for m in members or []:
            of[ep, m] = max(c, of.get((ep, m), c))
    want = set()
    for ep, id_, _, text, support, confidence in insights:
        spans = sorted({of[ep, s] for s in support or [] if s is not None and (ep, s) in of})
        for kind, words in L.PATTERN_KEYWORDS.items():
            if any(w in (text or "").lower() for w in words):
                if kind not in R.SPANNING:
                    want.add((ep, id_, kind, (), text, confidence))
                elif len(spans) > 1:
                    want.add((ep, id_, kind, tuple(spans), text, confidence))
    got = R.cross_cluster_patterns(spark.createDataFrame(clusters, "episode_id string, cluster_id long, members array<string>"), spark.createDataFrame(insights, INSIGHT)).collect()
    assert {(r.episode_id, r.insight_id, r.pattern, tuple(r.clusters), r.evidence, r.strength) for r in got} == want and len(got) == len(want)
    assert {r.pattern for r in got} == set(L.PATTERN_KEYWORDS)


def test_pattern_matches(spark):
    texts = [("x", "Mail ann.lee@site.org or call 555-123-4567 on 2024-01-02 at 9:30 PM for $5 million 😀 #Tag @Bob"), ("y", None), ("z", ""), (None, "É Ann Lee met Bob Ray"), ("z", "12/31/99 " * 30_000)]
    docs = spark.createDataFrame(texts, "k string, text string")
    want = sorted(((k or "", p, n, m.group(), m.start(), m.end(), m.groups()) for k, t in texts for p, x in L.ENTITY_PATTERNS.items() for n, m in enumerate(re.finditer(x, t or "", re.IGNORECASE))), key=str)
    got = sorted(((r.k or "", r.pattern, r.nth, r.match, r.start, r.end, tuple(r.groups)) for r in R.pattern_matches(docs, "k").collect()), key=str)
    assert got == want and len(got) > 30_000
    own = R.pattern_matches(docs, "k", patterns={"pair": r"(\w+)@(\w+)?|(met)"}).collect()  # a caller's own patterns
    assert {(r.match, tuple(r.groups)) for r in own} == {("lee@site", ("lee", "site", None)), ("met", (None, None, "met"))}


def test_mapping_text():
    assert storing.mapping_text({"b": "title", "a": "name"}, {"name": "x"}).splitlines() == ["| property | stored as | default |", "|---|---|---|", "| a | name | x |", "| b | title |  |"]
    assert len(storing.mapping_text({}, {}).splitlines()) == 2
