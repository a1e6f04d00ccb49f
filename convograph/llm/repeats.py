"""Exact removal of repeated byte strings by bucket-pointer refinement.

Strings of ``2q`` bytes (q = 25) are grouped as a bucket-pointer suffix sort does it: suffixes
start in buckets of their first q-gram, and a bucket is refined by the bucket identifiers of
later offsets, which earlier passes have already computed, until groups agree on 2q bytes.
A bucket identifier is a hash of the q-gram, so that buckets need no global numbering.

Sorting every suffix is not needed.  Of the q-grams in a string of 2q bytes the one with the least
identifier is its anchor; equal strings have equal anchors at equal offsets.  Only anchors, about
2 in 27 suffixes, enter the first pass:

1. anchors in buckets of one document are finished (as single-suffix buckets are);
2. the others are refined by the identifiers at offsets -q and +q.  A document whose refined bucket
   also has a smaller document loses the whole context of the anchor; a bucket that is not split by the
   refinement is finished;
3. where a bucket splits, a string around the anchor can still be common to its parts; such a string takes in the
   H = 13 bytes before the anchor or those after it.  If two parts agree on that side too, the strings that reach so
   far are refined singly, each by the identifiers of its two halves, once for each part (its smallest document).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convograph.llm.common import id_text
from convograph.llm.exchange import LAST, Blocks, Keys, each, groups, ids, join, mix, pack, pack_ids, pieces, split, texts, unpack, unpack_ids

Q = 25
H = 13
BASE = np.uint64(0x9E3779B97F4A7C55)
LETTER = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(BASE), n, 1 << 64))


def buckets(data: np.ndarray) -> np.ndarray:
    """Identifier of the q-gram at each position (the last q - 1 have none), by doubling."""
    h1 = LETTER[data]
    h, n = h1, 1
    for _ in range(3):  # 2, 4, 8
        h = h[:-n] * _power(n) + h[n:]
        n *= 2
    h8 = h
    h16 = h8[:-8] * _power(8) + h8[8:]
    h24 = h16[:-8] * _power(8) + h8[16:]
    h25 = h24[:-1] * BASE + h1[24 : 24 + len(h24) - 1]
    return mix(h25)


def slide(x: np.ndarray, n: int, best) -> np.ndarray:
    """Best of each ``n`` in a row."""
    w = 1
    while 2 * w <= n:
        x = best(x[:-w], x[w:])
        w *= 2
    return best(x[: len(x) - (n - w)], x[n - w :]) if n > w else x


class Part:
    """Anchors of a run of documents: position, document and bucket identifier."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.start, self.stop = offsets[:-1], offsets[1:]
        lengths = np.diff(offsets)
        self.h = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        if len(data) >= 2 * Q:
            self.h = h = buckets(data)
            fits = np.zeros(len(data) + 1, np.int32)
            long = lengths >= 2 * Q
            fits[self.start[long]] += 1
            fits[self.stop[long] - 2 * Q + 1] -= 1
            fits = np.cumsum(fits)[: len(data) - 2 * Q + 1] > 0
            least = slide(h, Q + 1, np.minimum)
            least = np.where(fits, least, np.uint64(0))
            pad = np.zeros(Q, np.uint64)
            most = slide(np.concatenate((pad, least, pad)), Q + 1, np.maximum)
            self.at = np.flatnonzero((most == h[: len(most)]) & (most > 0))
        self.doc = np.searchsorted(self.stop, self.at, side="right")
        self.key = self.h[self.at]

    def context(self, chosen: np.ndarray) -> np.ndarray:
        """Refinement of the chosen anchors by the identifiers of earlier and later offsets, in 64 bits: all contexts of one anchor are told apart by these."""
        at, doc = self.at[chosen], self.doc[chosen]
        left = np.minimum(Q, at - self.start[doc])
        right = np.minimum(Q, self.stop[doc] - Q - at)
        return mix(self.h[at - left] + mix(self.h[at + right] + (left * 64 + right).astype(np.uint64)))

    def sides(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """16 bits about the H bytes on each side; equal sides give equal bits."""
        at, doc = self.at[chosen], self.doc[chosen]
        left = np.minimum(H, at - self.start[doc])
        right = np.minimum(H, self.stop[doc] - Q - at)
        short = [mix(self.h[p] + n.astype(np.uint64)) >> np.uint64(48) for p, n in ((at - left, left), (at + right, right))]
        return short[0].astype(np.uint16), short[1].astype(np.uint16)

    def strings(self, before: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (position, document) of the strings that reach H bytes before, or after, the chosen anchors."""
        at = np.concatenate((self.at[before], self.at[after]))
        doc = np.concatenate((self.doc[before], self.doc[after]))
        low = np.maximum(self.start[doc], at - np.repeat((Q, H - 1), (len(before), len(after))))
        high = np.minimum(at - np.repeat((H, 0), (len(before), len(after))), self.stop[doc] - 2 * Q)
        n = np.maximum(high - low + 1, 0)
        first = np.cumsum(n) - n
        p = np.repeat(low - first, n) + np.arange(n.sum())
        p, index = np.unique(p, return_index=True)
        return p, np.repeat(doc, n)[index]


def parts(rows: pa.Table) -> Iterator[tuple[Part, np.ndarray, np.ndarray, int]]:
    data, offsets = texts(rows.column("_text"))
    doc_ids = ids(rows.column("_id"))
    for i, j in pieces(offsets):
        o = offsets[i : j + 1]
        yield Part(data[o[0] : o[-1]], o - o[0]), doc_ids[i:j], data[o[0] : o[-1]], i


def _least(key: np.ndarray, doc: np.ndarray, *more: np.ndarray):
    """Distinct keys with their least and greatest document."""
    order, at = groups(key, *more)
    return tuple(k[order[at]] for k in (key, *more)) + ((np.minimum.reduceat(doc[order], at), np.maximum.reduceat(doc[order], at)) if len(at) else (doc[:0], doc[:0]))


def _find(table: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether, where) each key is in a sorted table."""
    if not len(table):
        return np.zeros(len(key), bool), np.zeros(len(key), np.int64)
    at = np.minimum(np.searchsorted(table, key), len(table) - 1)
    return table[at] == key, at


def _first(keys: Keys):
    def emit(rows, _):
        got = [(p.key, d[p.doc]) for p, d, _, _ in parts(rows)]
        key, low, high = _least(np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got]))
        for b, i, j in keys.cut(key):
            yield b, join(pack(key[i:j]), np.packbits(low[i:j] != high[i:j]))

    return emit


def _shared(payloads: list[bytes]) -> list[bytes | None]:
    """The keys of each message that two documents have."""
    fields = [split(p) for p in payloads]
    keys = [unpack(f[0]) for f in fields]
    twice = [np.unpackbits(np.frombuffer(f[1], np.uint8), count=len(k)) for f, k in zip(fields, keys, strict=True)]
    order, at = groups(np.concatenate(keys))
    weight = 1 + np.concatenate(twice).astype(np.int64)
    many = np.zeros(len(order), bool)
    many[order] = np.repeat(np.add.reduceat(weight[order], at) > 1, np.diff(at, append=len(order)))
    out, i = [], 0
    for k in keys:
        out.append(pack(k[many[i : i + len(k)]]) if many[i : i + len(k)].any() else None)
        i += len(k)
    return out


def _contexts(keys: Keys):
    def emit(rows, got):
        shared = np.sort(np.concatenate([unpack(p) for p in got.get(1, [])] or [np.zeros(0, np.uint64)]))
        found = []
        for p, d, _, _ in parts(rows):
            chosen = np.flatnonzero(_find(shared, p.key)[0])
            found.append((p.key[chosen], p.context(chosen), *p.sides(chosen), d[p.doc[chosen]]))
        key, context, before, after, doc = (np.concatenate(x) for x in zip(*found, strict=True))
        key, context, before, after, low, high = _least(key, doc, context, before, after)
        for b, i, j in keys.cut(key):
            yield b, join(pack(key[i:j]), context[i:j], pack_ids(low[i:j]), np.packbits(low[i:j] != high[i:j]), before[i:j], after[i:j])

    return emit


def _bits(fields: list[list[bytes]], k: int, lengths: list[int]) -> np.ndarray:
    return np.concatenate([np.unpackbits(np.frombuffer(f[k], np.uint8), count=n) for f, n in zip(fields, lengths, strict=True)] or [np.zeros(0, np.uint8)]).astype(bool)


def _column(fields: list[list[bytes]], k: int, kind) -> np.ndarray:
    return np.concatenate([np.frombuffer(f[k], kind) for f in fields] or [np.zeros(0, kind)])


def _refined(payloads: list[bytes]) -> list[bytes | None]:
    """For each (key, context): its smallest document, and whether another part of a split bucket agrees on either side."""
    fields = [split(p) for p in payloads]
    keys = [unpack(f[0]) for f in fields]
    key, context, low = np.concatenate(keys), _column(fields, 1, np.uint64), np.concatenate([unpack_ids(f[2]) for f in fields])
    twice = _bits(fields, 3, [len(k) for k in keys])
    order, at = groups(key, context)
    size = np.diff(at, append=len(order))
    least = np.empty_like(low)
    least[order] = np.repeat(np.minimum.reduceat(low[order], at), size)
    agree = []
    for k in (4, 5):
        side = mix(key[order[at]] + _column(fields, k, np.uint16)[order[at]].astype(np.uint64))
        by, start = groups(side)
        many = np.empty(len(at), bool)
        n = np.diff(start, append=len(by))
        many[by] = np.repeat(n > 1, n)
        one = np.empty(len(key), bool)
        one[order] = np.repeat(many, size)
        agree.append(one & (least == low))
    use = agree[0] | agree[1] | twice | (least < low)
    out, i = [], 0
    for k in keys:
        s = slice(i, i + len(k))
        u = use[s]
        out.append(join(pack(k[u]), context[s][u], pack_ids(least[s][u]), np.packbits(agree[0][s][u]), np.packbits(agree[1][s][u])) if u.any() else None)
        i += len(k)
    return out


def _code(key: np.ndarray, more: np.ndarray) -> np.ndarray:
    return mix(key + mix(more.astype(np.uint64)))


def _table(payloads: list[bytes]):
    """Lookup by (key, context) of the replies of the second pass."""
    fields = [split(p) for p in payloads]
    keys = [unpack(f[0]) for f in fields]
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, bool)
    lengths = [len(k) for k in keys]
    code = _code(np.concatenate(keys), _column(fields, 1, np.uint64))
    order = np.argsort(code, kind="stable")
    return code[order], np.concatenate([unpack_ids(f[2]) for f in fields])[order], _bits(fields, 3, lengths)[order], _bits(fields, 4, lengths)[order]


def _judge(p: Part, d: np.ndarray, table):
    """(anchors whose context a smaller document has, anchors whose strings are refined singly before and after)."""
    code, least, before, after = table
    known, where = _find(code, _code(p.key, p.context(slice(None))))
    known = np.flatnonzero(known)
    where = where[known]
    doc = d[p.doc[known]]
    first = least[where] == doc
    return known[least[where] < doc], known[first & before[where]], known[first & after[where]]


class Strings:
    """The singly refined strings of a block: distinct (key, second) in order, the smallest document of each, and each part's share."""

    def __init__(self, rows: pa.Table, got: dict[int, list[bytes]]):
        table, found, self.parts = _table(got.get(2, [])), [], []
        for p, d, data, _ in parts(rows):
            whole, before, after = _judge(p, d, table)
            at, doc = p.strings(before, after)
            key, second = mix(p.h[at] + mix(p.h[at + Q])), (p.h[at] >> np.uint64(32)).astype(np.uint32)
            self.parts.append((p.start, p.stop, d, data, p.at[whole], p.doc[whole], at, doc, len(key)))
            found.append((key, second, d[doc]))
        key, second, doc = (np.concatenate(x) for x in zip(*found, strict=True))
        order, at = groups(key, second)
        self.key, self.second = key[order[at]], second[order[at]]
        self.low = np.minimum.reduceat(doc[order], at) if len(at) else doc[:0]
        self.which = np.empty(len(key), np.int64)
        self.which[order] = np.repeat(np.arange(len(at)), np.diff(at, append=len(order)))


def _singles(keys: Keys):
    def emit(rows, got):
        x = Strings(rows, got)
        for b, i, j in keys.cut(x.key):
            yield b, join(np.array([b], np.int64), pack(x.key[i:j]), x.second[i:j], pack_ids(x.low[i:j]))

    return emit


def _earliest(payloads: list[bytes]) -> list[bytes | None]:
    """For each string of each message whether another block has it in a smaller document."""
    fields = [split(p) for p in payloads]
    keys = [unpack(f[1]) for f in fields]
    key, second, low = np.concatenate(keys), _column(fields, 2, np.uint32), np.concatenate([unpack_ids(f[3]) for f in fields])
    order, at = groups(key, second)
    least = np.empty_like(low)
    least[order] = np.repeat(np.minimum.reduceat(low[order], at), np.diff(at, append=len(order)))
    out, i = [], 0
    for f, k in zip(fields, keys, strict=True):
        out.append(join(f[0], np.array([len(k)], np.int64), np.packbits(least[i : i + len(k)] < low[i : i + len(k)])))
        i += len(k)
    return out


RESULT = "_id long, n_bytes long, kept binary, spans array<array<long>>"


def _remove(rows: pa.Table, got: dict[int, list[bytes]]) -> pa.Table:
    x = Strings(rows, got)
    bits = sorted((int(np.frombuffer(f[0], np.int64)[0]), np.unpackbits(np.frombuffer(f[2], np.uint8), count=int(np.frombuffer(f[1], np.int64)[0]))) for f in map(split, got.get(3, [])))
    elsewhere = np.concatenate([b for _, b in bits] or [np.zeros(0, np.uint8)]).astype(bool)
    out: dict[str, list] = {"_id": [], "n_bytes": [], "kept": [], "spans": []}
    used = 0
    for start, stop, d, data, anchor, of, at, doc, n in x.parts:
        change = np.zeros(len(data) + 1, np.int32)
        np.add.at(change, np.maximum(start[of], anchor - Q), 1)
        np.add.at(change, np.minimum(stop[of], anchor + 2 * Q), -1)
        which = x.which[used : used + n]
        used += n
        at = at[elsewhere[which] | (x.low[which] < d[doc])]
        np.add.at(change, at, 1)
        np.add.at(change, at + 2 * Q, -1)
        gone = np.cumsum(change[:-1]) > 0
        for k in range(len(d)):
            a, b = int(start[k]), int(stop[k])
            g = gone[a:b]
            out["_id"].append(None if d[k] == LAST else int(d[k]))
            out["n_bytes"].append(b - a)
            if g.any():
                edge = np.flatnonzero(np.diff(g, prepend=False, append=False)).reshape(-1, 2)
                out["spans"].append(edge.tolist())
                out["kept"].append(data[a:b][~g].tobytes())
            else:
                out["spans"].append([])
                out["kept"].append(data[a:b].tobytes())
    return pa.table({"_id": pa.array(out["_id"], pa.int64()), "n_bytes": pa.array(out["n_bytes"], pa.int64()), "kept": pa.array(out["kept"], pa.binary()), "spans": pa.array(out["spans"], pa.list_(pa.list_(pa.int64())))})


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, kept, spans): each whole text as UTF-8 without the bytes that some string of 50
    bytes covers which also starts in a document of a smaller id; ``spans`` are the removed runs.

    Strings are judged on the input and may overlap.  Null texts are empty; a null id is larger
    than all others; rows of one id are one document to each other, so they remove nothing from each other; texts
    under 50 bytes stay whole.  Other columns are not read.  Equality is that of 64 bits of
    identifier for the contexts of one anchor (128 for others), and of 96 bits for strings refined singly: contexts of an anchor that n documents
    have are mistaken in about n * n / 2 ** 65 cases."""
    blocks = Blocks(id_text(docs, id_col, text_col))
    first = blocks.answer(blocks.send(_first(blocks.keys)), each(1, _shared))
    second = blocks.answer(blocks.send(_contexts(blocks.keys), first), each(2, _refined))
    third = blocks.answer(blocks.send(_singles(blocks.keys), second), each(3, _earliest))
    return blocks.finish(_remove, second.unionByName(third), RESULT).withColumnRenamed("_id", id_col)


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    kept = F.octet_length("kept").cast("long")
    return found.select(id_col, "n_bytes", (F.col("n_bytes") - kept).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
