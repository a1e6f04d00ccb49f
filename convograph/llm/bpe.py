"""Byte-pair encoding as a bounded-lookahead streaming transducer, and its inverse.

A merge list has a finite lookahead: a token that starts at byte ``s`` cannot change once the
``lookahead`` bytes from ``s`` on have been seen.  The bound comes from the merge list alone (see
:meth:`Merges.lookahead`).  The transducer therefore holds one window of bytes, merges it, emits
the tokens that can no longer change and goes on from there, so its memory does not grow with
the text.  Decoding feeds token bytes to an incremental UTF-8 state machine.
"""

from __future__ import annotations

import codecs
import json
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from convograph.llm.common import lean, ready, schema

#: The pattern of byte-level BPE that splits text before merging.
PIECES = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
#: A blank between two non-blanks always starts a piece, so a text may be cut before it.
CUT = regex.compile(r"(?<=\S) (?=\S)")
CHUNK = 1 << 16
CACHE = 300_000
#: A larger cache goes at a task's end: most of it are pieces of that task's texts, and an idle worker would hold them.
KEPT = CACHE // 6
NONE = 1 << 60


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Merges:
    """A merge list with its vocabulary, read from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        vocab = spec["model"]["vocab"]
        size = 1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])])
        self.token: list[bytes] = [b""] * size
        for word, i in vocab.items():
            self.token[i] = bytes(letters[c] for c in word)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for word, i in self.special.items():
            self.token[i] = word.encode()
        self.byte = [vocab[next(c for c, b in letters.items() if b == x)] for x in range(256)]
        self.rank: dict[int, int] = {}
        self.new: list[int] = []
        for r, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank[vocab[a] << 20 | vocab[b]] = r
            self.new.append(vocab[a + b])
        self.longest = max(map(len, self.token))
        self.lookahead = self._lookahead()
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def _lookahead(self) -> int:
        """How many bytes from a token's start can decide about it.

        Walking the merges by rank, ``reach[t]`` is how far from the start of an occurrence of
        ``t`` lower-ranked merges can look.  A merge (u, v) depends on what v's own formation and
        its consumption by earlier merges depend on; u depends on that merge from then on."""
        reach = [len(t) for t in self.token]
        for key, r in self.rank.items():
            new = self.new[r]
            u, v = key >> 20, key & 0xFFFFF
            span = len(self.token[u]) + reach[v]
            reach[new] = max(reach[new], reach[u], span)
            reach[u] = max(reach[u], span)
        return max(reach)

    def merge(self, piece: bytes) -> list[int]:
        """Tokens of one window: lowest rank first, the leftmost of equals first."""
        ids, rank, new = [self.byte[b] for b in piece], self.rank, self.new
        ranks = [rank.get(a << 20 | b, NONE) for a, b in zip(ids, ids[1:], strict=False)]
        while ranks:
            best = min(ranks)
            if best == NONE:
                break
            i = ranks.index(best)
            ids[i : i + 2] = [new[best]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank.get(ids[i - 1] << 20 | ids[i], NONE)
            if i < len(ranks):
                ranks[i] = rank.get(ids[i] << 20 | ids[i + 1], NONE)
        return ids


class Encoder:
    """The transducer.  ``cache`` is bounded and only saves work on frequent pieces."""

    def __init__(self, merges: Merges):
        self.m = merges
        self.window = 2 * merges.lookahead + merges.longest

        class Cache(dict):
            def __missing__(cache, piece: str) -> tuple[int, ...]:
                ids = tuple(self.piece(piece.encode()))
                if len(piece) <= 64:
                    if len(cache) >= CACHE:
                        cache.clear()
                    cache[piece] = ids
                return ids

        self.cache = Cache()

    def piece(self, data: bytes) -> Iterator[int]:
        """Tokens of a piece of any length, in memory bounded by the window."""
        at, m = 0, self.m
        while True:
            window = data[at : at + self.window]
            ids = m.merge(window)
            if at + len(window) == len(data):
                yield from ids
                return
            start = 0
            for i in ids:
                if start + m.lookahead > len(window):
                    break
                yield i
                start += len(m.token[i])
            at += start

    def chunks(self, text: str) -> Iterator[list[int]]:
        """Token ids of a text, a bounded chunk at a time."""
        parts = self.m.split_special.split(text) if self.m.split_special else [text]
        for part in parts:
            if part in self.m.special:
                yield [self.m.special[part]]
                continue
            at = 0
            while at < len(part):
                cut = CUT.search(part, at + CHUNK) if len(part) - at > CHUNK else None
                end = cut.start() if cut else len(part)
                yield list(chain.from_iterable(map(self.cache.__getitem__, PIECES.findall(part, at, end) if end == len(part) else PIECES.findall(part[at:end]))))
                at = end


class Decoder:
    """Bytes to text, whatever the split: a UTF-8 machine that carries unfinished characters over."""

    def __init__(self, merges: Merges):
        self.token = merges.token
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int], last: bool = False) -> str:
        return self.machine.decode(b"".join(map(self.token.__getitem__, ids)), last)


_loaded: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker and file."""
    if path not in _loaded:
        _loaded[path] = Encoder(Merges(path))
    return _loaded[path]


def encode_text(text: str, path: str) -> list[int]:
    return list(chain.from_iterable(encoder(path).chunks(text)))


def _shrink() -> None:
    """Drops large caches of this worker."""
    for e in _loaded.values():
        if len(e.cache) > KEPT:
            e.cache.clear()


def _tidy(run):
    """A function of batches that leaves neither a large cache nor free memory behind."""

    def whole(batches):
        yield from run(batches)
        _shrink()

    return lean(whole)


def decode_ids(ids: list[int], path: str, step: int = 4096) -> str:
    d = Decoder(encoder(path).m)
    return "".join([*(d.feed(ids[i : i + step]) for i in range(0, len(ids), step)), d.feed([], True)])


def _rows(docs: DataFrame, column: str, kind: str, function, step: int = 256) -> DataFrame:
    whole = StructType([*docs.schema.fields]).add(column, kind)
    arrow = {"array<int>": pa.list_(pa.int32()), "string": pa.string()}[kind]

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(function(part), type=arrow)], names=[*part.schema.names, column])

    return docs.mapInArrow(_tidy(run), whole)


def encode(docs: DataFrame, path: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """Adds the token ids of each whole text (null: none) as ``out``.

    Special tokens' strings in a text become those tokens.  Rows pass through one by one, so
    repeated rows stay, an empty table stays empty and other columns are left alone; ``out``
    must not be one of them."""
    ready(docs.sparkSession)
    if out in docs.columns:
        raise ValueError(f"a column {out} exists")
    return _rows(docs, out, "array<int>", lambda b: [encode_text(t or "", path) for t in b.column(text_col).to_pylist()])


def decode(docs: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """Adds the text of each row's ids (null: empty) as ``out``; bytes that are no UTF-8 become U+FFFD."""
    ready(docs.sparkSession)
    if out in docs.columns:
        raise ValueError(f"a column {out} exists")
    return _rows(docs, out, "string", lambda b: [decode_ids(x or [], path) for x in b.column(ids_col).to_pylist()])


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, decoded) of each row's whole text, null as the empty one.

    Each row, repeated or not, gets a row; an empty table gives none; other columns are not read.  The lookahead bounds what the transducers hold; the
    ids and the decoded text of a row are results and whole."""
    ready(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [encode_text(t or "", path) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, type=pa.list_(pa.int32())), pa.array([decode_ids(x, path) for x in ids], type=pa.string())], names=[id_col, "ids", "decoded"])

    two = docs.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").alias("_text"))
    return two.mapInArrow(_tidy(run), schema(id_col, two.schema[0].dataType, "ids array<int>, decoded string"))


def digests(trips: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return trips.select(
        id_col,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
