"""Jaccard join of word n-gram sets by grouped prefixes.

Shingles are ordered by how many documents have them (rarest first).  Of two sets whose Jaccard similarity reaches a threshold the
first ``n - ceil(t n) + 1`` shingles, the prefix, have one in common; where their first common shingle stands bounds how many
they can share.  Sets with equal prefixes and equal sizes form one group: groups are joined through an index of their prefixes, pairs of groups
are filtered by size, position and bitmaps of their shingles, and what is left is expanded to members and verified.

Document frequencies come from the block exchange, so no shingle is a row of its own, and a set in which rare shingles fill the whole prefix has no
partner and goes no further.  Equal sets are one from there on.  As linked sets are to be connected, not listed, a posting list of the index is first joined with one
of its groups only, the one it stands earliest in, for which a member of every list has one row; what is connected then meets no more,
and only groups of different components are paired.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convograph.llm.common import id_text, shared_folder
from convograph.llm.exchange import LAST, Blocks, Keys, each, groups, ids, join, mix, pack, pieces, split, texts, unpack
from convograph.llm.katz import tokens
from convograph.operators.components import connected_components

ONE, TWO = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)
#: Share that two sets have to have in common, in hundredths of their union.
SHARE = 90
#: Words of 64 bits of a set's bitmap: a power of two.
WIDE = 8


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """(document, 64-bit key) of the distinct shingles of each document, by document and key.

    Words are runs of other than blank and control-space characters, A-Z in lower case; fewer words than ``size`` are one shingle, none have none."""
    word, first = tokens(data, offsets)
    n = np.diff(first, append=len(word)) - 1  # each document ends with a mark
    word, doc = np.delete(word, first + n), np.repeat(np.arange(len(n)), n)
    place, many = np.arange(len(word)) - (np.cumsum(n) - n)[doc], n[doc]
    at = np.flatnonzero((place == 0) | (place + size <= many))
    key, doc = mix(word[at] ^ ONE), doc[at]
    for k in range(1, size):
        more = np.flatnonzero(many[at] > k)
        key[more] = mix(mix(key[more] + TWO) + word[at[more] + k])
    order, new = groups(doc, key)
    return doc[order[new]], key[order[new]]


class Sets:
    """The shingle sets of a block: distinct keys in order, in how many of its documents each is, and which of them each document has."""

    def __init__(self, rows: pa.Table, size: int):
        data, offsets = texts(rows.column("_text"))
        self.ids, doc, key = ids(rows.column("_id")), [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for i, j in pieces(offsets):
            o = offsets[i : j + 1]
            d, k = shingles(data[o[0] : o[-1]], o - o[0], size)
            doc.append(d + i)
            key.append(k)
        self.doc, key = np.concatenate(doc), np.concatenate(key)
        order, at = groups(key)
        self.count = np.diff(at, append=len(order))
        self.key = key[order[at]]
        self.which = np.empty(len(key), np.int64)
        self.which[order] = np.repeat(np.arange(len(at)), self.count)
        self.n = np.bincount(self.doc, minlength=len(self.ids))


def _frequencies(keys: Keys, size: int):
    def emit(rows, _):
        s = Sets(rows, size)
        for b, i, j in keys.cut(s.key):
            yield b, join(np.array([b], np.int64), pack(s.key[i:j]), s.count[i:j].astype(np.uint32))

    return emit


def _classes(payloads: list[bytes]) -> list[bytes]:
    """For each key of each message the logarithm of the number of documents that have it, 0 if it is one."""
    fields = [split(p) for p in payloads]
    keys = [unpack(f[1]) for f in fields]
    n = np.concatenate([np.frombuffer(f[2], np.uint32) for f in fields]).astype(np.int64)
    order, at = groups(np.concatenate(keys))
    total = np.empty(len(order), np.int64)
    total[order] = np.repeat(np.add.reduceat(n[order], at), np.diff(at, append=len(order)))
    rank = np.ceil(4 * np.log2(total)).astype(np.uint8)
    out, i = [], 0
    for f, k in zip(fields, keys, strict=True):
        out.append(join(f[0], rank[i : i + len(k)]))
        i += len(k)
    return out


FOUND = "_id long, n long, _unique int, _same long, _same2 long, _group long, _shared array<long>"


def _prefixes(size: int, share: int):
    def build(rows: pa.Table, got: dict[int, list[bytes]]) -> pa.Table:
        s = Sets(rows, size)
        parts = sorted((int(np.frombuffer(f[0], np.int64)[0]), np.frombuffer(f[1], np.uint8)) for f in map(split, got.get(1, [])))
        rank = np.concatenate([p[1] for p in parts] or [np.zeros(0, np.uint8)])[s.which]
        key = s.key[s.which]
        order = np.lexsort((key, rank, s.doc))
        key, rank = key[order], rank[order]
        stop = np.cumsum(s.n)
        unique = np.bincount(s.doc[order][rank == 0], minlength=len(s.n))
        prefix = s.n - (share * s.n + 99) // 100 + 1
        out: dict[str, list] = {n: [] for n in ("_unique", "_same", "_same2", "_group", "_shared")}
        for d, (n, u, p, b) in enumerate(zip(s.n.tolist(), unique.tolist(), prefix.tolist(), stop.tolist(), strict=True)):
            if n == 0 or u >= p:
                for c in out:
                    out[c].append(None)
                continue
            k = key[b - n : b]
            out["_unique"].append(u)
            out["_same"].append(_long(np.add.reduce(mix(k ^ ONE))))
            out["_same2"].append(_long(np.bitwise_xor.reduce(mix(k + TWO))))
            out["_group"].append(_long(mix(np.add.reduce(mix(k[:p] + TWO) * np.arange(1, 2 * p, 2, np.uint64), keepdims=True) + np.uint64(n))[0]))
            out["_shared"].append(k[u:].view(np.int64))
        kinds = {"_unique": pa.int32(), "_shared": pa.list_(pa.int64())}
        id_ = pa.array(s.ids, pa.int64(), mask=s.ids == LAST)
        return pa.table({"_id": id_, "n": pa.array(s.n, pa.int64()), **{c: pa.array(v, kinds.get(c, pa.int64())) for c, v in out.items()}})

    return build


def _long(x: np.uint64) -> int:
    return int(np.uint64(x).view(np.int64))


def _bits() -> Column:
    """A bitmap of a set's shingles that others have too."""
    word = "aggregate(filter(_shared, t -> (shiftrightunsigned(t, 6) & {m}) = {w}), 0L, (a, t) -> a | shiftleft(1L, cast(t & 63 AS int)))"
    return F.array(*[F.expr(word.format(m=WIDE - 1, w=w)) for w in range(WIDE)])


def _possible(share: int) -> Column:
    """Whether groups x and y that have their first common shingle where they meet can reach the share."""
    common = F.expr(f"({share} * (x.n + y.n) + {99 + share}) div {100 + share}")
    fits = (100 * F.least("x.n", "y.n") >= share * F.greatest("x.n", "y.n")) & (F.col("x.n") - F.col("x.pos") >= common) & (F.col("y.n") - F.col("y.pos") >= common)
    # A bit that one has and the other has not is a shingle at least that they do not share.
    for one, other in (("x", "y"), ("y", "x")):
        apart = sum(F.bit_count(F.col(f"{one}.bits")[w].bitwiseAND(F.bitwise_not(F.col(f"{other}.bits")[w]))) for w in range(WIDE))
        fits = fits & F.coalesce(F.col(f"{one}.held") - apart >= common, F.lit(True))
    return fits


def _verified(pairs: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """(src, dst): the pairs of sets that reach the share; rare shingles that one document has are not in ``_shared`` and cannot be common."""
    for side in ("src", "dst"):
        pairs = pairs.join(sets.select(F.col("node").alias(side), F.col("n").alias(f"{side}_n"), F.col("_shared").alias(f"{side}_set")), side)
    common = F.size(F.array_intersect("src_set", "dst_set"))
    return pairs.where((100 + share) * common >= share * (F.col("src_n") + F.col("dst_n"))).select("src", "dst")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, share: int = SHARE) -> DataFrame:
    """(id, n_shingles, component) of every row: the size of its set of distinct shingles of ``size`` words, and the smallest id that links
    of ``100 * common >= share * union`` reach, its own included.

    Null texts and texts without words have empty sets, which link with nothing.  A null id is larger than all others, and a component of null ids only is null;
    repeated rows are documents of their own with one id.  Ids must be whole numbers; other columns are not read.  Shingles are 64-bit keys: two different ones are
    taken for one only if their keys collide within one pair of documents (about 10^-11 for texts of 10,000 words)."""
    blocks = Blocks(id_text(docs, id_col, text_col))
    spark = docs.sparkSession
    ranks = blocks.answer(blocks.send(_frequencies(blocks.keys, size)), each(1, _classes))
    at = shared_folder(spark, "jaccard")
    blocks.finish(_prefixes(size, share), ranks, FOUND).write.parquet(at)
    found = spark.read.parquet(at)
    known = F.coalesce("_id", F.lit(LAST))

    # Equal sets are one: its smallest id, with its key, names it.
    same = ["n", "_same", "_same2"]
    sets = found.where("_shared IS NOT NULL").groupBy(*same).agg(F.min(known).alias("_least"), F.first("_group").alias("_group"), F.first("_unique").alias("_unique"))
    sets = sets.withColumn("node", F.struct(F.col("_least").alias("id"), F.col("_same").alias("key"))).checkpoint()
    members = sets.select("node", "n", "_group", "_unique")
    held = found.where("_shared IS NOT NULL").select(F.struct(known.alias("id"), F.col("_same").alias("key")).alias("node"), "n", "_shared")

    # One member stands for its group in the index: all have its size and prefix.
    leads = members.groupBy("_group").agg(F.min("node").alias("node"), (F.count("*") == 1).alias("_alone"))
    prefix = F.expr(f"int(n - ({share} * n + 99) div 100 + 1 - _unique)")
    index = held.join(leads.join(members.drop("_group"), "node").drop("n"), "node").withColumn("bits", F.when(F.col("_alone"), _bits())).select("_group", "node", "n", "_unique", "bits", F.size("_shared").alias("held"), F.posexplode(F.slice("_shared", F.lit(1), prefix)).alias("k", "token"))
    index = index.select("token", "_group", "node", "n", "bits", "held", (F.col("_unique") + F.col("k")).alias("pos")).dropDuplicates(["token", "_group"]).checkpoint()

    inside = members.join(leads.select("_group", F.col("node").alias("src")), "_group").where("node != src").select("src", F.col("node").alias("dst"))
    links = _verified(inside.unionByName(_stars(index, share)).distinct(), held, share).checkpoint()
    parts = connected_components(links)
    links = links.unionByName(_verified(_rest(index, members, parts, share), held, share)).checkpoint()
    parts = connected_components(links)

    whole = sets.join(parts, "node", "left").select(*same, F.coalesce("component.id", "_least").alias("_part"))
    out = found.drop("_shared", "_group", "_unique").join(whole, same, "left").withColumn("_part", F.coalesce("_part", known))
    return out.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("_part") != LAST, F.col("_part")).alias("component"))


def _stars(index: DataFrame, share: int) -> DataFrame:
    """(src, dst): each group of a posting list with the one that has the shingle earliest."""
    first = index.groupBy("token").agg(F.count("*").alias("_many"), F.min(F.struct("pos", "n", "_group", "node", "bits", "held")).alias("_x")).where("_many > 1").select("token", "_x.*")
    pairs = first.alias("x").join(index.alias("y"), F.col("x.token") == F.col("y.token")).where((F.col("x._group") != F.col("y._group")) & _possible(share))
    return pairs.select(F.col("x.node").alias("src"), F.col("y.node").alias("dst")).distinct()


def _rest(index: DataFrame, members: DataFrame, parts: DataFrame, share: int) -> DataFrame:
    """(src, dst): pairs of sets of different components whose groups meet in the index and can reach the share."""
    part = F.coalesce("component", "node").alias("part")
    of = members.join(parts, "node", "left").select("_group", "node", part).checkpoint()
    index = index.drop("node").join(of.select("_group", "part").distinct(), "_group")
    live = index.groupBy("token").agg(F.min("part").alias("_low"), F.max("part").alias("_high")).where("_low != _high").select("token")
    index = index.join(live, "token").checkpoint()
    # Of two groups the smaller has its first common shingle among those that leave it enough for a partner no smaller.
    small = index.where(F.expr(f"n - pos >= ({2 * share} * n + {99 + share}) div {100 + share}"))
    order = F.struct("x.n", "x._group", "x.part") > F.struct("y.n", "y._group", "y.part")
    pairs = index.alias("x").join(small.alias("y"), (F.col("x.token") == F.col("y.token")) & (F.col("x.part") != F.col("y.part")) & order & _possible(share))
    pairs = pairs.select(F.col("x._group").alias("_gx"), F.col("x.part").alias("_px"), F.col("y._group").alias("_gy"), F.col("y.part").alias("_py")).distinct()
    for side, g, p in (("src", "_gx", "_px"), ("dst", "_gy", "_py")):
        pairs = pairs.join(of.select(F.col("_group").alias(g), F.col("part").alias(p), F.col("node").alias(side)), [g, p])
    return pairs.select("src", "dst")


def digests(found: DataFrame) -> DataFrame:
    return found.withColumnRenamed("component", "component_id")
