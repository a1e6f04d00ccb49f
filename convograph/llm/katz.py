"""Katz back-off language model over words, learned and evaluated through the block exchange.

Counts of words and of word pairs live in tables partitioned by ranges of their key.  Every
block of documents asks for the counts of its own words and pairs and scores its documents from
the answers, so no table is broadcast or gathered and frequent words are one entry a block.

The model is bigram over unigram over unknown.  Counts up to K are discounted by Good-Turing;
what a context saves goes to the words not seen after it, in proportion to their unigram
probabilities and exactly normalised: ``alpha(u) = (1 - sum P(v|u)) / (1 - sum P(v))`` over the v seen after u.
What the unigrams save goes to one unknown type.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convograph.llm.common import id_text
from convograph.llm.exchange import ALL, Blocks, Keys, groups, ids, join, mix, pack, pieces, split, texts, unpack

K = 5
BASE = np.uint64(0x9E3779B97F4A7C55)
BACK = np.uint64(pow(int(BASE), -1, 1 << 64))
LETTER = mix(np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(1))
BLANK = np.isin(np.arange(256), (9, 10, 11, 12, 13, 32))
END, BEGIN = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        for name, base in (("up", BASE), ("down", BACK)):
            _powers[name] = np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(n, base, np.uint64))))
    return _powers["up"][:n], _powers["down"][:n]


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(token keys of all documents, where each document's tokens start); every document ends with END."""
    n = len(offsets) - 1
    word = ~BLANK[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(word & (edge[:-1] | np.concatenate(([True], ~word[:-1])))[: len(data)]) if len(data) else np.zeros(0, np.int64)
    up, down = _power(len(data))
    keys = mix(np.add.reduceat(np.where(word, LETTER[data] * up, np.uint64(0)), start) * down[start]) if len(start) else np.zeros(0, np.uint64)
    doc = np.searchsorted(offsets[1:], start, side="right")
    first = np.searchsorted(doc, np.arange(n)) + np.arange(n)
    out = np.full(len(start) + n, END)
    out[np.arange(len(start)) + doc] = keys
    return out, first


class Text:
    """Tokens of a block: words, contexts, and whether they are of training documents."""

    def __init__(self, rows: pa.Table, of: int):
        data, offsets = texts(rows.column("_text"))
        self.ids = rows.column("_id").to_pylist()
        self.held = np.array([zlib.crc32(b"" if i is None else str(i).encode()) % of == 0 for i in self.ids], bool)
        word, start, at = [], [], 0
        for i, j in pieces(offsets):
            o = offsets[i : j + 1]
            w, s = tokens(data[o[0] : o[-1]], o - o[0])
            word.append(w)
            start.append(s + at)
            at += len(w)
        self.word, self.start = np.concatenate(word), np.concatenate(start)
        self.before = np.concatenate(([BEGIN], self.word[:-1]))
        self.before[self.start] = BEGIN
        self.n = np.diff(self.start, append=len(self.word))
        self.train = np.repeat(~self.held, self.n)
        self.pair = mix(mix(self.before.copy()) + self.word)


def _counted(key: np.ndarray, train: np.ndarray):
    """(distinct keys, how often each occurs in training, one row of each, which distinct key each row has)."""
    order, at = groups(key)
    n = np.add.reduceat(train[order].astype(np.int64), at) if len(at) else np.zeros(0, np.int64)
    which = np.empty(len(key), np.int64)
    which[order] = np.repeat(np.arange(len(at)), np.diff(at, append=len(order)))
    return key[order[at]], n, order[at], which


def _planes(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T.tobytes() if len(x) else b""


def _unplanes(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel() if data else np.zeros(0, kind)


def _send(keys: Keys, k: np.ndarray, n: np.ndarray, aside: list[int] | None = None):
    """To the buckets their keys and training counts; any one of them also gets the counts of counts of keys not sent."""
    none = np.zeros(0, np.int64)
    for b, f, t in keys.cut(k):
        yield b, join(pack(k[f:t]), _planes(n[f:t].astype(np.uint32)), none)
    if aside:
        yield sum(aside) % keys.n, join(b"", b"", np.array(aside, np.int64))


def _words(keys: Keys, of: int):
    def emit(rows, _):
        x = Text(rows, of)
        k, n, _, _ = _counted(x.word, x.train)
        yield from _send(keys, k, n)

    return emit


def _pairs(keys: Keys, of: int):
    """Pairs of words that other blocks have too; the counts of the other pairs are known here."""

    def emit(rows, got):
        x = Text(rows, of)
        a = Answers(x, got)
        k, n, _, _ = a.pairs
        yield from _send(keys, k[~a.here], n[~a.here], _of_counts(n[a.here]))

    return emit


def _of_counts(n: np.ndarray) -> list[int]:
    """Total, distinct, and the counts of counts 1 to K + 1."""
    return [int(n.sum()), int((n > 0).sum()), *np.bincount(n[n <= K + 1], minlength=K + 2)[1 : K + 2].tolist()]


#: Level of the counts of counts of a level's keys.
STATS = 8


def _tally(level: int):
    """Answers to each block: its keys' counts over all blocks and whether it alone has a word or is the one
    block that answers for a pair; and to all blocks the bucket's counts of counts."""

    def tally(bucket: int, blocks: list[int], payloads: list[bytes]):
        fields = [split(p) for p in payloads]
        aside = [np.frombuffer(f[2], np.int64) for f in fields if f[2]]
        blocks, fields = zip(*[(b, f) for b, f in zip(blocks, fields, strict=True) if f[0]], strict=True) if any(f[0] for f in fields) else ((), ())
        keys = [unpack(f[0]) for f in fields]
        n = np.concatenate([_unplanes(f[1], np.uint32) for f in fields] or [np.zeros(0, np.uint32)]).astype(np.int64)
        by, at = groups(np.concatenate(keys or [np.zeros(0, np.uint64)]))
        size = np.diff(at, append=len(by))
        total = np.add.reduceat(n[by], at) if len(at) else np.zeros(0, np.int64)
        every = np.empty(len(by), np.int64)
        every[by] = np.repeat(total, size)
        mark = np.zeros(len(by), bool)
        if level == 1:
            mark[by] = np.repeat(size == 1, size)
        elif len(at):  # the first block that has training counts of the pair
            first = np.minimum.reduceat(np.where(n[by] > 0, np.arange(len(by)), len(by)), at)
            mark[by[first[first < len(by)]]] = True
        yield ALL, level + STATS, sum(aside, np.array(_of_counts(total), np.int64)).tobytes()
        i = 0
        for block, k in zip(blocks, keys, strict=True):
            s = slice(i, i + len(k))
            yield block, level, join(np.array([bucket], np.int64), _planes(every[s].astype(np.uint64)), np.packbits(mark[s]))
            i += len(k)

    return tally


def discounts(n: list[int] | np.ndarray) -> np.ndarray:
    """Share of a count r that stays, for r = 0 to K; n: how many keys occur 1 to K + 1 times.

    Where Good-Turing gives none between 0 and 1 (few or no keys of a count), half a count is taken off."""
    d = np.ones(K + 1)
    tail = (K + 1) * n[K] / n[0] if n[0] else 0.0
    for r in range(1, K + 1):
        star = (r + 1) * n[r] / n[r - 1] if n[r - 1] else 0.0
        x = (star / r - tail) / (1 - tail) if tail < 1 else 0.0
        d[r] = x if 0 < x < 1 else (r - 0.5) / r
    return d


def _kept(n: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Discounted counts."""
    return n * d[np.where(n <= K, n, 0)]


class Answers:
    """What a block knows from the answers so far: counts of its words and unigram probabilities, then counts of its pairs.

    ``here`` are the pairs with a word that no other block has; they are counted in this block only."""

    def __init__(self, x: Text, got: dict[int, list[bytes]]):
        self.words = _counted(x.word, x.train)
        self.pairs = _counted(x.pair, x.train)
        self.n, self.only = self._read(got.get(1, []))
        s1 = sum(np.frombuffer(p, np.int64) for p in got[1 + STATS])
        words, row = self.words[0], self.pairs[2]
        i = np.minimum(np.searchsorted(words, x.before[row]), len(words) - 1)
        self.here = ((words[i] == x.before[row]) & self.only[i]) | self.only[self.words[3][row]]
        if 2 + STATS in got:
            n, own = self._read(got.get(2, []))
            s2 = sum(np.frombuffer(p, np.int64) for p in got[2 + STATS])
            self.n2, self.own = self.pairs[1].copy(), np.ones(len(self.here), bool)
            self.n2[~self.here], self.own[~self.here] = n, own
            self.d2 = discounts(s2[2:])
        self.total, self.distinct = int(s1[0]), int(s1[1])
        d1 = discounts(s1[2:])
        # sum of discounted counts over all training words, from the counts of counts
        saved = sum(r * c * (1 - d1[r]) for r, c in zip(range(1, K + 1), s1[2 : K + 2].tolist(), strict=True))
        if self.total:
            # with no rare word to discount, the unknown type gets half a count
            scale = 1.0 if saved > 0 else self.total / (self.total + 0.5)
            unknown = saved / self.total if saved > 0 else 0.5 / (self.total + 0.5)
            p = np.where(self.n > 0, _kept(self.n, d1) / self.total * scale, unknown)
        else:
            p = np.ones(len(self.n))
        self.p = p

    @staticmethod
    def _read(payloads: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        rows = sorted((int(np.frombuffer(f[0], np.int64)[0]), f) for f in map(split, payloads))
        n = [_unplanes(f[1], np.uint64) for _, f in rows]
        mark = [np.unpackbits(np.frombuffer(f[2], np.uint8), count=len(k)) for (_, f), k in zip(rows, n, strict=True)]
        return np.concatenate(n or [np.zeros(0)]).astype(np.int64), np.concatenate(mark or [np.zeros(0)]).astype(bool)


def _contexts(x: Text, a: Answers):
    """(contexts, how often each begins a pair in training anywhere, sums over its pairs here, contexts that no other block has, context of each token).

    Every training occurrence of a word but END begins one pair, and BEGIN begins as many as there are ENDs."""
    k, _, _, which = _counted(x.before, x.train)
    pair_row = a.pairs[2]
    n = np.where(a.own, a.n2, 0)
    at = which[pair_row]
    word = a.words[3][pair_row]
    sums = [np.bincount(at, _kept(n, a.d2), len(k)), np.bincount(at, np.where(n > 0, a.p[word], 0.0), len(k))]
    words = a.words[0]
    i = np.minimum(np.searchsorted(words, np.where(k == BEGIN, END, k)), max(len(words) - 1, 0))
    return k, a.n[i], sums, (k != BEGIN) & a.only[i], which


def _sums(keys: Keys, of: int):
    """To the buckets, for contexts that other blocks have too, the discounted count of the pairs that this block answers for and the unigram probability of their second words."""

    def emit(rows, got):
        x = Text(rows, of)
        k, _, sums, alone, _ = _contexts(x, Answers(x, got))
        send = ~alone
        k, sums = k[send], [s[send] for s in sums]
        for b, f, t in keys.cut(k):
            yield b, join(pack(k[f:t]), *[_planes(s[f:t]) for s in sums])

    return emit


def weights(count: np.ndarray, kept: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log10 of a context's denominator, log10 of its back-off weight) from the count of its pairs,
    their discounted count and the unigram probability of the words seen.

    A context that saves nothing gets one more count; one without pairs backs off by weight one."""
    save = count - kept
    denominator = np.where(save > 1e-9 * np.maximum(count, 1), count, count + 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        alpha = np.where(count > 0, (denominator - kept) / denominator / np.maximum(1 - seen, 1e-300), 1.0)
        return np.log10(np.maximum(denominator, 1)), np.log10(alpha)


def _add(bucket: int, blocks: list[int], payloads: list[bytes]):
    """The sums over all blocks."""
    fields = [split(p) for p in payloads]
    keys = [unpack(f[0]) for f in fields]
    by, at = groups(np.concatenate(keys))
    n = np.diff(at, append=len(by))
    both = []
    for k in (1, 2):
        every = np.empty(len(by))
        every[by] = np.repeat(np.add.reduceat(np.concatenate([_unplanes(f[k], np.float64) for f in fields])[by], at), n)
        both.append(every)
    i = 0
    for block, k in zip(blocks, keys, strict=True):
        s = slice(i, i + len(k))
        yield block, 3, join(np.array([bucket], np.int64), _planes(both[0][s]), _planes(both[1][s]))
        i += len(k)


NAMES = ("_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
RESULT = "_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", of: int = 10) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of each whole text.

    The model learns from documents whose crc32 of the id as text is not divisible by ``of``.  Tokens are runs of
    non-blanks with A-Z in lower case and one end.  ``score`` is the model's log10 probability of the tokens,
    ``base_score`` that of additively smoothed word counts.  A null text is its end only; a null id counts as the empty text, which is held out;
    repeated rows are documents of their own.  Without training documents every token has probability one."""
    blocks = Blocks(id_text(docs, id_col, text_col))
    tally = blocks.answer(blocks.send(_words(blocks.keys, of)), _tally(1))
    tally = tally.unionByName(blocks.answer(blocks.send(_pairs(blocks.keys, of), tally), _tally(2)))
    none = pa.table([pa.array([], t) for t in (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())], names=NAMES)
    added = blocks.answer(blocks.send(_sums(blocks.keys, of), tally), _add)

    def build(rows: pa.Table, got) -> pa.Table:
        if not rows.num_rows:  # counts of counts reach blocks without documents, too
            return none
        x = Text(rows, of)
        a = Answers(x, got)
        _, count, sums, alone, context = _contexts(x, a)
        answers = sorted((int(np.frombuffer(f[0], np.int64)[0]), f) for f in map(split, got.get(3, [])))
        if answers:
            for i, s in enumerate(sums):
                s[~alone] = np.concatenate([_unplanes(f[i + 1], np.float64) for _, f in answers])
        denominator, alpha = weights(count, *sums)
        n, n2 = a.n[a.words[3]], a.n2[a.pairs[3]]
        with np.errstate(divide="ignore"):
            found = np.where(n2 > 0, np.log10(_kept(n2, a.d2)) - denominator[context], alpha[context] + np.log10(a.p)[a.words[3]])
        base = np.log10((n + 0.1) / (a.total + 0.1 * (a.distinct + 1)))
        add = lambda v: np.add.reduceat(v, x.start)
        train = np.full(len(x.n), a.total, np.int64)
        return pa.table([pa.array(x.ids, pa.int64()), *map(pa.array, (x.held, x.n, add((n > 0).astype(np.int64)), train, add(base), add(found)))], names=NAMES)

    return blocks.finish(build, tally.unionByName(added), RESULT).withColumnRenamed("_id", id_col)


def checked(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return found.select(id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", (F.col("score") > F.col("base_score")).alias("better"))


__all__ = ["checked", "discounts", "ids", "score", "tokens", "weights"]
