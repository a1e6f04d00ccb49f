"""Spelling variants, conversation repair, the Jaccard join, and repeated strings and secrets at size, against brute force and their SQL."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest

from convograph.llm import conversations, exchange, jaccard, repeats, secretscan, variants
from convograph.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
BLANK = " \t\n\x0b\x0c\r"


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def by_repr(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("name", ["op11_spelling_variants", "op12_conversation_repair", "op13_jaccard_join"])
def test_same_as_sql(spark, name):
    d = QUERIES[name](spark, SF)
    with duckdb.connect() as db:
        for f in os.listdir(SF):
            db.execute(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
        r = db.execute(SQL[name])
        names = [x[0] for x in r.description]
        assert sorted(names) == sorted(d.columns)
        assert by_repr(tuple(x) for x in d.select(names).collect()) == by_repr(r.fetchall())


# ---- spelling variants


def variants_by_hand(rows, damage, often=5):
    n = Counter()
    for d, t in rows:
        for w in map(lower, re.findall("[A-Za-zÀ-ÿ]+", t or "")):
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if damage and h % damage == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            n[w] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= often}
    cut = defaultdict(set)
    for w in n:
        for v in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            cut[v].add(w)
    near = defaultdict(set)
    for ws in cut.values():
        for a in ws:
            near[a] |= {b for b in ws if a != b and (len(a) != len(b) or sum(x != y for x, y in zip(a, b, strict=True)) == 1)}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return by_repr((w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n)


def test_variants(spark, monkeypatch):
    random.seed(11)
    stems = ["abcdefgh", "abcdxfgh", "bbcdefgh", "prefixaa", "éàüöïñç", "Qwertyuiop", "q" * 300]
    rows = []
    for i in range(400):
        words = []
        for _ in range(30):
            w = list(random.choices(stems, (30, 6, 1, 9, 9, 9, 1))[0])
            for _ in range(random.choice((0, 0, 0, 1, 2))):
                k = random.randrange(len(w))
                w[k : k + 1] = random.choice(([], ["z"], [w[k], "y"]))
            words.append("".join(w))
        rows.append((random.choice((i, None, 3)), random.choice((" ", "-", "1")).join(words)))
    rows += [(900, None), (901, ""), (902, "1 2 ."), (903, "prefix" + "ab" * 9), *[(904, "prefix" + a + b + c) for a in "abcdefgh" for b in "abcd" for c in "abc" for _ in range(5)]]
    docs = spark.createDataFrame([(d, t, "w", 1) for d, t in rows], "doc_id long, text string, word string, n int")
    for damage in (0, 7):
        want = variants_by_hand(rows, damage)
        for size in (variants.BLOCK, 2):
            monkeypatch.setattr(variants.blocks, "__defaults__", (size,))
            assert by_repr(tuple(r) for r in variants.digests(variants.group(docs, damage=damage)).collect()) == want
    assert any(x[1] != x[2] and x[1] for x in want) and len(want) > 150
    assert variants.group(docs.limit(0)).count() == 0


def test_one_edit():
    assert variants.one_edit("abc", "abd") and variants.one_edit("abc", "ab") and variants.one_edit("ab", "xab") and variants.one_edit("a", "")
    assert not variants.one_edit("abc", "abc") and not variants.one_edit("ab", "ba") and not variants.one_edit("abcd", "ab")


# ---- conversations


def repaired_by_hand(rows):
    """All repairs, row by row, with inserts anywhere."""
    shown = lambda x: " " if x is None else str(x)
    told = defaultdict(list)
    for c, t, r, x in rows:
        k, r, x = zlib.crc32(f"{shown(c)}:{shown(t)}".encode()) % 20, shown(r), shown(x)
        x = "" if k == 1 else re.sub("[.!?]", "", x) if k == 2 else x
        told[c] += [(t, "user" if k == 4 else r, x)] * (0 if k == 0 else 2 if k == 3 else 1)
    goes = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    name = {"u": "user", "a": "assistant"}

    def put(at, state, way):
        if state not in at or way[:2] < at[state][:2]:
            at[state] = way

    def insert(at):
        for _ in range(3):
            for state, (cost, audit, out) in list(at.items()):
                for q in "ua":
                    if (state, q) in goes:
                        put(at, q, (cost + 2, audit + "I", (*out, name[q] + ":")))
        return at

    found = []
    for c, turns in told.items():
        turns.sort(key=lambda z: (z[0] is not None, z[0] or 0, z[1].encode(), z[2].encode()))
        at, faults, seen = {"": (0, "", ())}, Counter(), set()
        for _, r, x in turns:
            kept = x.strip(BLANK)
            fault = "blank" if not kept else "duplicate" if (r, x) in seen else "truncated" if kept[-1] not in ".!?" else ""
            seen.add((r, x))
            faults[fault] += 1
            new = {}
            for state, (cost, audit, out) in insert(at).items():
                put(new, state, (cost + 3, audit + "D", out))
                if fault not in ("blank", "duplicate"):
                    more = cost + (fault == "truncated")
                    if (state, r[:1]) in goes:
                        put(new, goes[state, r[:1]], (more, audit + "K", (*out, f"{r}:{x}")))
                    for q in "ua":
                        if (state, q) in goes:
                            put(new, q, (more + 2, audit + "R", (*out, f"{name[q]}:{x}")))
            at = new
        cost, audit, out = min(way for state, way in insert(at).items() if state in ("", "a"))
        some = [t for t, *_ in turns if t is not None]
        pairs = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
        found.append((c, max(some) - min(some) + 1 - len(set(some)) if some else 0, faults["blank"], faults["duplicate"], faults["truncated"], pairs, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()))
    return by_repr(found)


def talk(seed):
    random.seed(seed)
    texts = ["a.", "b?", "b", "c  ", "", " \n", "d! ", "héé", None, "e.", "f.", "g.\n", "h.x", "i.", " ", "two\nlines."]
    rows = [(c, random.choice([None, *range(12)]), random.choice(["user", "assistant", "system", "user", "assistant", "tool", None, "", "umpire"]), random.choice(texts)) for c in [None, *range(60)] for _ in range(random.choice([0, 1, 2, 3, 5, 13, 30]))]
    rows += [(777, t // 3, random.choice(["user", "assistant"]), random.choice(["a.", "b?", f"x{t}.", f"x{t // 50}"])) for t in range(900)]
    return [*rows, *[(778, 5, "user", "the same.")] * 300]


@pytest.mark.parametrize("stretch", [16, 4096])
def test_conversations(spark, monkeypatch, stretch):
    monkeypatch.setattr(conversations, "STRETCH", stretch)
    monkeypatch.setattr(conversations, "BITS", stretch.bit_length() - 1)
    rows = talk(12)
    turns = spark.createDataFrame([(*r, "p", 1, 2) for r in rows], "conv_id long, turn long, role string, text string, _part string, _pos int, edit int").repartition(5)
    hurt = conversations.damage(turns)
    log, found = conversations.repair(hurt)
    got = conversations.digests(turns, log, found)
    assert by_repr(tuple(r) for r in got.collect()) == repaired_by_hand(rows)
    edits = Counter(r.edit for r in log.select("edit").collect())
    assert edits["K"] + edits["R"] + edits["D"] == hurt.count() and edits["I"]
    none = turns.limit(0)
    assert conversations.digests(none, *conversations.repair(none)).count() == 0


# ---- Jaccard join


def joined_by_hand(rows, size=3, share=90):
    sets = []
    for _, t in rows:
        w = re.findall("[^\\x20\\x09-\\x0D]+", lower(t))
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    held = defaultdict(list)
    for i, s in enumerate(sets):
        for j in {j for k in s for j in held[k]}:
            both = len(s & sets[j])
            if 100 * both >= share * (len(s) + len(sets[j]) - both):
                up[max(top(i), top(j))] = min(top(i), top(j))
        for k in s:
            held[k].append(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[top(i)] = min(least.get(top(i), 1 << 62), 1 << 62 if d is None else d)
    return by_repr((d, len(sets[i]), None if least[top(i)] == 1 << 62 else least[top(i)]) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize("share", [90, 70])
def test_jaccard(spark, monkeypatch, share):
    monkeypatch.setattr(exchange, "SMALL_BYTES", 20_000)
    random.seed(13)
    rows = [(None, "a b"), (None, "a B"), (7, "a b"), (8, None), (9, " \n"), (10, "x"), (11, "X"), (12, "x x"), (13, "x x x x"), (14, "É x y"), (15, "é x y")]
    words = [f"w{i}" for i in range(40)]
    base = [[random.choice(words) for _ in range(n)] for n in (12, 20, 40, 40, 80, 150, 300)]
    for i in range(500):
        w = list(random.choice(base)) + (random.choice(base) if random.random() < 0.3 else [])
        for _ in range(random.choice((0, 0, 1, 1, 2, 3, 6))):
            k = random.randrange(len(w))
            w[k : k + 1] = random.choice(([], [f"n{random.randrange(500)}"], [random.choice(words)], [w[k], "q"]))
        rows.append((random.choice((i + 20, i + 20, i + 20, 30, None)), " ".join(w)))
    # a chain without a middle: each is like the next only
    line = [f"c{i}" for i in range(400)]
    rows += [(2000 + k, " ".join(line[9 * k : 9 * k + 200])) for k in range(20)]
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, n int, node string")
    assert by_repr(tuple(r) for r in jaccard.classes(docs, share=share).collect()) == joined_by_hand(rows, share=share)
    assert jaccard.classes(docs.limit(0)).count() == 0


# ---- repeated strings


def test_repeats_tell_many_contexts_of_one_string_apart(spark):
    """200,000 documents that share 25 bytes, but no string of 50: nothing goes."""
    rng = np.random.default_rng(4)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", np.uint8)
    some = letters[rng.integers(0, 26, (400, 25))]
    middle = min((bytes(x) for x in some), key=lambda x: repeats.buckets(np.frombuffer(x, np.uint8))[0])  # an anchor of almost every document
    around = letters[rng.integers(0, 26, (200_000, 50))]
    texts = [(bytes(x[:25]) + middle + bytes(x[25:])).decode() for x in around]
    docs = spark.createDataFrame(pd.DataFrame({"doc_id": np.arange(len(texts)), "text": texts})).repartition(8)
    assert repeats.deduplicate(docs).where("size(spans) > 0").count() == 0


# ---- secrets


def test_a_text_of_very_many_secrets(spark):
    """Offsets in one text of 60,000 matches, and runs beside them that overlap some."""
    text = " é ".join((f"token = abcdef{i}", f"AKIA{i:016d}", f"x {i:024x}", f"{i}kq83JSKDJ2883jdksjQWPEO", f"api_key:{i:024x}", "pwd secret=a")[i % 6] for i in range(80_000))
    base = [(m.start(), 0, m.end()) for m in re.finditer(secretscan.ASSIGN, text) if len(m[2]) >= 6]
    base += [(m.start(), k, m.end()) for k, p in ((1, secretscan.ACCESS), (2, secretscan.HEX)) for m in re.finditer(p, text)]
    ratios = np.ones(secretscan.SIZE * secretscan.SIZE)
    docs = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in secretscan.scan(docs, secretscan.Model(ratios, 0.0, 1.0, 1.0)).collect()}
    assert [tuple(x) for x in got[1].base] == sorted(base) and not got[2].base
    edges, reach = sorted(base), 0
    stops = []
    for at, _, stop in edges:
        reach = max(reach, stop)
        stops.append((at, reach))
    import bisect

    starts = [a for a, _ in stops]
    runs = [(m.start(), m.end()) for m in re.finditer(secretscan.RUN, text)]
    free = [(a, 3, b) for a, b in runs if (k := bisect.bisect_left(starts, b)) == 0 or stops[k - 1][1] <= a]
    assert [tuple(x) for x in got[1].spans if x.kind == 3] == free and len(free) > 10_000
