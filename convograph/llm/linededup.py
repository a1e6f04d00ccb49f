"""Line deduplication by a deletion-neighbourhood join.

Two lines are the same if at most one character is inserted, deleted or replaced between them;
of such lines the earliest, by document id and line number, stays.  Short lines are the same only if they
are equal, as one edit turns unrelated ones into each other.  A line and all its variants with one
character deleted are hashed; lines that share a variant are joined, their edit distance is verified on the
texts, and the later one goes.

Variants of every line would be hundreds of rows a line, so three cheaper joins come first, each
through the block exchange: equal lines are reduced to their earliest; a line whose first half and second half are both unlike those of
any other line of about its length cannot have a neighbour and emits nothing; and only lines that share a
variant ask for each other's text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from convograph.llm.common import id_text, packed
from convograph.llm.exchange import LAST, Blocks, Keys, each, groups, ids, join, mix, pack, split, unpack

BASE = np.uint64(0x9E3779B97F4A7C55)
BACK = np.uint64(pow(int(BASE), -1, 1 << 64))


def _hash(s: str) -> int:
    return xxhash.xxh3_64_intdigest(s.encode("utf-8", "replace"))


class Lines:
    """The lines of a block that are long enough to be compared, with their places."""

    def __init__(self, rows: pa.Table, least: int = 1):
        self.doc_ids = ids(rows.column("_id"))
        self.whole = [(t or "").split("\n") for t in rows.column("_text").to_pylist()]
        self.text: list[str] = []
        row, line = [], []
        for r, lines in enumerate(self.whole):
            for k, s in enumerate(lines):
                if len(s) >= least:
                    self.text.append(s)
                    row.append(r)
                    line.append(k)
        self.row, self.line = np.array(row, np.int64), np.array(line, np.int64)
        self.doc = self.doc_ids[self.row] if len(row) else self.row
        self.key = np.fromiter(map(_hash, self.text), np.uint64, len(self.text))

    def firsts(self) -> np.ndarray:
        """The earliest of equal lines in this block, by key."""
        order, at = groups(self.key, self.doc, self.line)
        k = self.key[order[at]]
        new = np.ones(len(at), bool)
        new[1:] = k[1:] != k[:-1]
        return order[at][new]

    def owned(self, got: dict[int, list[bytes]]) -> np.ndarray:
        """Lines of this block that are the earliest of their equals anywhere."""
        mine = _keys(got.get(1, []))
        first = self.firsts()
        return first[np.isin(self.key[first], mine, assume_unique=True)]


def _keys(payloads: list[bytes]) -> np.ndarray:
    return np.concatenate([unpack(p) for p in payloads] or [np.zeros(0, np.uint64)])


def halves(s: str) -> list[int]:
    """Keys of which any two lines within one edit share one: the ends of the shorter length's half."""
    out = []
    for g in (len(s), len(s) + 1):
        c = (g - 1) // 2
        out += [_hash(f"{g}<{s[:c]}"), _hash(f"{g}>{s[len(s) - c :]}")]
    return out


_powers = np.ones(1, np.uint64)


def variants(s: str) -> np.ndarray:
    """Hashes of a line (first) and of its variants with each character deleted, in linear time."""
    global _powers
    x = mix(np.frombuffer(s.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64) + np.uint64(1))
    n = len(x)
    if len(_powers) < n:
        _powers = np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(2 * n, BASE, np.uint64))))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(x * _powers[:n], dtype=np.uint64)))
    return mix(np.concatenate((sums[n:], sums[:-1] + (sums[n] - sums[1:]) * BACK)))


def within_one(a: str, b: str) -> bool:
    """Whether the edit distance is at most one."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    low, high = 0, len(a)
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid - 1)
    return a[low + (len(a) == len(b)) :] == b[low + 1 :]


def _equal(keys: Keys):
    def emit(rows, _):
        x = Lines(rows)
        i = x.firsts()
        for b, f, t in keys.cut(x.key[i]):
            yield b, join(pack(x.key[i[f:t]]), x.doc[i[f:t]], x.line[i[f:t]])

    return emit


def _earliest(payloads: list[bytes]) -> list[bytes | None]:
    """Of each message the keys of which no other has an earlier line."""
    fields = [split(p) for p in payloads]
    keys = [unpack(f[0]) for f in fields]
    key = np.concatenate(keys)
    doc, line = (np.concatenate([np.frombuffer(f[k], np.int64) for f in fields]) for k in (1, 2))
    order = np.lexsort((line, doc, key))
    at = np.flatnonzero(np.concatenate(([True], key[order][1:] != key[order][:-1])))
    first = np.repeat(order[at], np.diff(at, append=len(order)))
    win = np.zeros(len(key), bool)
    win[order] = (doc[order] == doc[first]) & (line[order] == line[first])  # rows of one id may be in several blocks
    out, i = [], 0
    for k in keys:
        w = win[i : i + len(k)]
        out.append(pack(k[w]) if w.any() else None)
        i += len(k)
    return out


def _halves(keys: Keys, least: int):
    def emit(rows, got):
        x = Lines(rows)
        h = np.array([k for i in x.owned(got) if len(x.text[i]) >= least for k in set(halves(x.text[i]))], np.uint64)
        key, n = np.unique(h, return_counts=True)
        for b, f, t in keys.cut(key):
            yield b, join(pack(key[f:t]), np.packbits(n[f:t] > 1))

    return emit


def _shared(payloads: list[bytes]) -> list[bytes | None]:
    fields = [split(p) for p in payloads]
    keys = [unpack(f[0]) for f in fields]
    weight = 1 + np.concatenate([np.unpackbits(np.frombuffer(f[1], np.uint8), count=len(k)) for f, k in zip(fields, keys, strict=True)]).astype(np.int64)
    order, at = groups(np.concatenate(keys))
    many = np.zeros(len(order), bool)
    many[order] = np.repeat(np.add.reduceat(weight[order], at) > 1, np.diff(at, append=len(order)))
    out, i = [], 0
    for k in keys:
        m = many[i : i + len(k)]
        out.append(pack(k[m]) if m.any() else None)
        i += len(k)
    return out


def _variants(keys: Keys, least: int):
    def emit(rows, got):
        x, shared = Lines(rows), set(_keys(got.get(2, [])).tolist())
        chosen = [i for i in x.owned(got) if len(x.text[i]) >= least and not shared.isdisjoint(halves(x.text[i]))] if shared else []
        if not chosen:
            return
        v = [variants(x.text[i]) for i in chosen]
        n = np.array([len(h) for h in v])
        key = np.concatenate(v)
        place = np.concatenate([np.arange(-1, k - 1, dtype=np.int32) for k in n])
        owner = np.repeat(np.array(chosen), n)
        order = np.argsort(key, kind="stable")
        key, place, owner = key[order], place[order], owner[order]
        for b, f, t in keys.cut(key):
            o, where = np.unique(owner[f:t], return_inverse=True)
            yield b, join(pack(key[f:t]), place[f:t], where.astype(np.int32), x.doc[o], x.line[o])

    return emit


def _pairs(_: int, blocks: list[int], payloads: list[bytes]):
    """Requests to the block of the earlier line of each pair that shares a variant, by that block."""
    fields = [split(p) for p in payloads]
    key = np.concatenate([unpack(f[0]) for f in fields])
    place = np.concatenate([np.frombuffer(f[1], np.int32) for f in fields])
    own = [np.frombuffer(f[2], np.int32) for f in fields]
    block = np.repeat(np.array(blocks), [len(o) for o in own])
    doc, line = (np.concatenate([np.frombuffer(f[k], np.int64)[o] for f, o in zip(fields, own, strict=True)]) for k in (3, 4))
    # one variant, earliest line first; a whole line (place -1) is within one edit of all that lead to it,
    # two shortened lines are within one edit of each other if the same place is deleted
    order = np.lexsort((line, doc, key))
    key, place, doc, line, block = (a[order] for a in (key, place, doc, line, block))
    at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    size = np.diff(at, append=len(key))
    found = set()
    for i, n in zip(at[size > 1].tolist(), size[size > 1].tolist(), strict=True):
        seen: dict[int, int] = {}
        for j in range(i, i + n):
            p = int(place[j])
            early = {seen.get(p), seen.get(-1), i if p == -1 and j > i else None} - {None}
            for e in early:
                if (doc[e], line[e]) != (doc[j], line[j]):
                    found.add((int(block[e]), int(doc[e]), int(line[e]), int(block[j]), int(doc[j]), int(line[j])))
            seen.setdefault(p, j)
    by: dict[int, list] = {}
    for f in sorted(found):
        by.setdefault(f[0], []).append(f[1:])
    return ((b, 3, np.array(f, np.int64).tobytes()) for b, f in by.items())


def _answer(least: int):
    def emit(rows, got):
        asked = {tuple(r) for p in got.get(3, []) for r in np.frombuffer(p, np.int64).reshape(-1, 5).tolist()}
        if not asked:
            return
        x = Lines(rows, least)
        text: dict[tuple[int, int], set[bytes]] = {}  # rows of one id may differ
        for d, k, s in zip(x.doc.tolist(), x.line.tolist(), x.text, strict=True):
            text.setdefault((d, k), set()).add(s.encode("utf-8", "replace"))
        by: dict[int, list] = {}
        for doc, line, block, doc2, line2 in sorted(asked):
            by.setdefault(block, []).extend((doc2, line2, s) for s in sorted(text[doc, line]))
        for block, found in by.items():
            yield block, join(np.array([f[:2] for f in found], np.int64), *[f[2] for f in found])

    return emit


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 20, keep: list[str] | None = None) -> DataFrame:
    """(id, text, n_lines, removed, and the columns of ``keep``) of each row: its text without the removed lines, and their numbers from 0.

    Lines end at newlines.  A line goes if a line within its edit bound has a smaller (id, line number) anywhere in
    the input, whether or not that one stays itself.  The bound is one edit between lines of ``least`` characters or more and none
    between shorter ones, as one edit turns unrelated short lines into each other; empty lines always stay.  Null texts count as empty, empty texts have one empty line; a null id is larger
    than all others; in rows of one id lines with one number leave each other alone; an empty table gives no rows."""
    base = id_text(docs, id_col, text_col)
    if keep:
        base = docs.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"), packed(docs, keep).alias("_row"))
    blocks = Blocks(base)
    first = blocks.answer(blocks.send(_equal(blocks.keys)), each(1, _earliest))
    second = blocks.answer(blocks.send(_halves(blocks.keys, least), first), each(2, _shared))
    asked = blocks.answer(blocks.send(_variants(blocks.keys, least), first.unionByName(second)), _pairs)
    texts = blocks.send(_answer(least), asked, level=4)
    names = ["_id", "_kept", "n_lines", "removed", *(["_row"] if keep else [])]

    def build(rows: pa.Table, got) -> pa.Table:
        x = Lines(rows)
        gone: list[set[int]] = [set() for _ in x.whole]
        mine = set(x.owned(got).tolist())
        first = {x.key[i]: (x.doc[i], x.line[i]) for i in mine}
        for i, key in enumerate(x.key):
            if i not in mine and first.get(key) != (x.doc[i], x.line[i]):
                gone[x.row[i]].add(int(x.line[i]))
        later: dict[tuple[int, int], list[str]] = {}
        for p in got.get(4, []):
            place, *earlier = split(p)
            for (doc, line), s in zip(np.frombuffer(place, np.int64).reshape(-1, 2).tolist(), earlier, strict=True):
                later.setdefault((doc, line), []).append(bytes(s).decode())
        if later:
            for i, (doc, line) in enumerate(zip(x.doc.tolist(), x.line.tolist(), strict=True)):
                if any(within_one(x.text[i], s) for s in later.get((doc, line), ())):
                    gone[x.row[i]].add(line)
        kept = ["\n".join(s for k, s in enumerate(lines) if k not in g) if g else "\n".join(lines) for lines, g in zip(x.whole, gone, strict=True)]
        out = [rows.column("_id"), pa.array(kept, pa.string()), pa.array(map(len, x.whole), pa.int64()), pa.array([sorted(g) for g in gone], pa.list_(pa.int64()))]
        return pa.table([*out, *([rows.column("_row")] if keep else [])], names=names)

    kind = StructType.fromDDL("_id long, _kept string, n_lines long, removed array<long>")
    if keep:
        kind = kind.add("_row", base.schema["_row"].dataType)
    out = blocks.finish(build, first.unionByName(texts), kind)
    more = [F.col(f"_row.`{c}`").alias(c) for c in keep or []]
    return out.select(F.col("_id").alias(id_col), F.col("_kept").alias(text_col), "n_lines", "removed", *more)


def digests(found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return found.select(id_col, "n_lines", F.size("removed").cast("long").alias("n_removed"), F.array_join("removed", ",").alias("removed"), F.sha2(F.col(text_col), 256).alias("kept_sha256"))
