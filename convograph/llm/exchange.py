"""Block exchange: set operations over very many hashed keys without a row for each key.

Documents are dealt into blocks by the hash of their id.  A block sends, for each bucket of the
key space, one packed row of its distinct keys; a bucket merges the rows of all blocks and
answers each block with one packed row.  A key that a third of all documents hold is one entry
for each block, never one for each document, so no bucket is hot; and the documents themselves
are exchanged once, as every step reads the same exchange.

The number of blocks follows from the bytes of text, so a block fits a worker at any size.  Messages between n blocks
and n buckets would be n * n; beyond ``DIRECT`` blocks they take two hops, through relays that each serve about
sqrt(n) blocks and sqrt(n) buckets and regroup what they pass on, so that their number grows as n to the power 3/2.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from convograph.llm.common import lean, ready, released

LAST = np.iinfo(np.int64).max
#: Mean bytes of text in a block, which is one task's work: the most, and those that do while messages need one hop only.
BLOCK_BYTES, SMALL_BYTES = 64 << 20, 8 << 20
#: Number of blocks beyond which messages take two hops.
DIRECT = 1024
#: Address of all blocks.
ALL = -1
MESSAGE = "to int, via int, payload binary"


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit keys (one to one)."""
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def pack(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys as byte planes of their differences, of which the high ones are mostly zero."""
    if not len(keys):
        return b""
    gaps = np.diff(keys, prepend=np.uint64(0))
    return gaps.view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack(data: bytes) -> np.ndarray:
    n = len(data) // 8
    gaps = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, n).T).view(np.uint64).ravel()
    return np.cumsum(gaps, dtype=np.uint64)


def join(*parts: bytes | np.ndarray) -> bytes:
    """Several arrays in one payload, entropy-coded if it is not tiny."""
    raw = [p if isinstance(p, bytes) else p.tobytes() for p in parts]
    data = np.array([len(raw), *map(len, raw)], np.int64).tobytes() + b"".join(raw)
    if len(data) < 512:
        return data
    return np.int64(-len(data)).tobytes() + pa.compress(data, codec="zstd", asbytes=True)


def split(data: bytes) -> list[bytes]:
    n = int(np.frombuffer(data, np.int64, 1)[0])
    if n < 0:
        data = pa.decompress(data[8:], -n, codec="zstd", asbytes=True)
        n = int(np.frombuffer(data, np.int64, 1)[0])
    sizes, at, out = np.frombuffer(data, np.int64, n, 8), 8 + 8 * n, []
    for s in sizes.tolist():
        out.append(data[at : at + s])
        at += s
    return out


def groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, starts): an order that sorts rows by the keys, first key first, and where each group starts in it."""
    if not len(keys[0]):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[0] = True
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    return order, np.flatnonzero(new)


def texts(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column."""
    if column.nbytes >= 1 << 31:  # beyond 32-bit offsets
        column = column.cast(pa.large_string())
    array = column.combine_chunks()
    if isinstance(array, pa.ChunkedArray):
        array = array.chunk(0) if array.num_chunks else pa.array([], pa.string())
    n = len(array)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    width = np.int64 if pa.types.is_large_string(array.type) else np.int32
    offsets = np.frombuffer(array.buffers()[1], width)[array.offset : array.offset + n + 1].astype(np.int64)
    data = np.frombuffer(array.buffers()[2], np.uint8) if array.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def ids(column: pa.ChunkedArray) -> np.ndarray:
    return np.array([LAST if x is None else x for x in column.to_pylist()], np.int64) if column.null_count else column.to_numpy().astype(np.int64)


def pieces(offsets: np.ndarray, size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Runs of documents of about ``size`` bytes, so that work arrays stay small."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def pack_ids(x: np.ndarray) -> bytes:
    """Document ids as places in a table of the distinct ones."""
    table, place = np.unique(x, return_inverse=True)
    return join(table, place.astype(np.uint16 if len(table) <= 1 << 16 else np.uint32))


def unpack_ids(data: bytes) -> np.ndarray:
    table, place = split(data)
    table = np.frombuffer(table, np.int64)
    return table[np.frombuffer(place, np.uint16 if len(table) <= 1 << 16 else np.uint32)]


class Keys:
    """Deals keys into ``n`` buckets by range."""

    def __init__(self, n: int):
        self.n = n

    def bucket(self, keys: np.ndarray) -> np.ndarray:
        return (((keys >> np.uint64(32)) * np.uint64(self.n)) >> np.uint64(32)).astype(np.int64)

    def cut(self, keys: np.ndarray) -> list[tuple[int, int, int]]:
        """(bucket, from, to) of sorted keys."""
        if not len(keys):
            return []
        b = self.bucket(keys)
        at = np.flatnonzero(np.diff(b, prepend=-1))
        return [(int(b[i]), int(i), int(j)) for i, j in zip(at, [*at[1:], len(b)], strict=True)]


def bundle(tags: list[int], payloads: list[bytes]) -> bytes:
    """Payloads with a number each, in one."""
    return np.array([len(tags), *tags, *map(len, payloads)], np.int64).tobytes() + b"".join(payloads)


def unbundle(data: bytes) -> Iterator[tuple[int, memoryview]]:
    """The numbers and payloads of a bundle, which are not copied."""
    view = memoryview(data)
    n = int(np.frombuffer(data, np.int64, 1)[0])
    head = np.frombuffer(data, np.int64, 2 * n, 8).tolist()
    at = 8 + 16 * n
    for tag, size in zip(head[:n], head[n:], strict=True):
        yield tag, view[at : at + size]
        at += size


def _rows(found: dict[tuple[int, int], list[tuple[int, bytes]]]) -> pa.Table:
    """A message for each (to, via) with its tagged payloads."""
    return pa.table({"to": pa.array([k[0] for k in found], pa.int32()), "via": pa.array([k[1] for k in found], pa.int32()), "payload": pa.array([bundle(*zip(*sorted(f, key=lambda x: x[0]), strict=True)) for f in found.values()], pa.binary())})


class Blocks:
    """Rows of (_id, _text, ...) dealt into blocks by the hash of both.

    What crosses the exchange is one compressed Arrow batch for each block and batch of rows.
    The bytes of text are counted first, in a scan of that column alone, and they alone give the number of blocks, as messages grow with it
    whatever the partitions.

    Work passes between blocks and buckets of keys in turns: ``send`` lets every block write to buckets, ``answer``
    lets every bucket write to blocks, ``finish`` turns blocks and what they got into rows of results."""

    def __init__(self, docs: DataFrame):
        ready(docs.sparkSession)
        size = docs.agg(F.sum(F.octet_length("_text").cast("long"))).first()[0] or 0
        self.n = max(-(-size // BLOCK_BYTES), min(DIRECT, -(-size // SMALL_BYTES)), min(16, size >> 20), 1)
        self.width = 0 if self.n <= DIRECT else math.isqrt(self.n - 1) + 1
        self.keys = Keys(self.n)
        blocked = docs.withColumn("_block", F.pmod(F.xxhash64("_id", "_text"), F.lit(self.n)).cast("int"))
        self.docs = blocked.mapInArrow(lean(_deal), "_block int, _rows binary")

    def send(self, emit: Callable, replies: DataFrame | None = None, level: int | None = None) -> DataFrame:
        """Messages of all blocks to buckets.  ``emit(rows, replies)`` yields (bucket, payload); replies: payloads by level.

        With a ``level`` they are messages of blocks to blocks, as replies of that level."""
        width = self.width

        def messages(block: int, found) -> pa.Table:
            out: dict[tuple[int, int], list] = {}
            tag = block if level is None else level
            for bucket, payload in found:
                if width:
                    out.setdefault((bucket // width, block // width), []).append((bucket << 32 | tag, payload))
                else:
                    out.setdefault((bucket, 0), []).append((tag, payload))
            return _rows(out)

        if replies is None:
            sent = self.docs.groupBy("_block").applyInArrow(lambda key, rows: released(messages(key[0].as_py(), emit(_gather(rows), {}))), MESSAGE)
        else:
            sent = self._with(replies).applyInArrow(lambda key, rows, got: released(messages(key[0].as_py(), emit(_gather(rows), by_level(got)) if rows.num_rows else ())), MESSAGE)
        if not width:
            return sent

        def relay(key, rows):
            out: dict[tuple[int, int], list] = {}
            for data in rows.column("payload").to_pylist():
                for tag, payload in unbundle(data):
                    out.setdefault((tag >> 32, key[1].as_py()), []).append((tag & 0xFFFFFFFF, payload))
            return _rows(out)

        return sent.groupBy("to", "via").applyInArrow(lambda key, rows: released(relay(key, rows)), MESSAGE)

    def answer(self, messages: DataFrame, reply: Callable) -> DataFrame:
        """Messages of all buckets to blocks.  ``reply(bucket, blocks, payloads)`` yields (block, level, payload); what is for
        ``ALL`` blocks is an array of 64-bit integers, which may be added up on the way."""
        width, n = self.width, self.n

        def run(key, rows):
            bucket = key[0].as_py()
            got = sorted((x for data in rows.column("payload").to_pylist() for x in unbundle(data)), key=lambda x: x[0])
            out: dict[tuple[int, int], list] = {}
            for block, level, payload in reply(bucket, [g[0] for g in got], [g[1] for g in got]):
                if width:
                    for to in range(-(-n // width)) if block == ALL else (block // width,):
                        out.setdefault((to, bucket // width), []).append((level << 32 | block & 0xFFFFFFFF, payload))
                else:
                    for to in range(n) if block == ALL else (block,):
                        out.setdefault((to, 0), []).append((level, payload))
            return _rows(out)

        sent = messages.groupBy("to").applyInArrow(lambda key, rows: released(run(key, rows)), MESSAGE)
        if not width:
            return sent

        def relay(key, rows):
            group, out, total = key[0].as_py(), {}, {}
            for data in rows.column("payload").to_pylist():
                for tag, payload in unbundle(data):
                    level, block = tag >> 32, tag & 0xFFFFFFFF
                    if block == ALL & 0xFFFFFFFF:
                        total[level] = total.get(level, 0) + np.frombuffer(payload, np.int64)
                    else:
                        out.setdefault((block, 0), []).append((level, payload))
            for level, sums in total.items():
                for block in range(group * width, min(n, (group + 1) * width)):
                    out.setdefault((block, 0), []).append((level, sums.tobytes()))
            return _rows(out)

        return sent.groupBy("to", "via").applyInArrow(lambda key, rows: released(relay(key, rows)), MESSAGE)

    def _with(self, replies: DataFrame):
        return self.docs.groupBy("_block").cogroup(replies.groupBy("to"))

    def finish(self, build: Callable, replies: DataFrame, schema: StructType | str) -> DataFrame:
        """``build(rows, replies)`` returns the table of results of a block."""
        return self._with(replies).applyInArrow(lambda key, rows, got: released(build(_gather(rows), by_level(got))), schema)


def _deal(batches):
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6))
    for batch in batches:
        block = batch.column("_block").to_numpy()
        order, at = groups(block)
        rest = batch.select([n for n in batch.schema.names if n != "_block"])
        out = []
        for i, j in zip(at, [*at[1:], len(order)], strict=True):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rest.schema, options=options) as w:
                w.write_batch(rest.take(pa.array(order[i:j])))
            out.append(sink.getvalue().to_pybytes())
        yield pa.RecordBatch.from_arrays([pa.array(block[order[at]], pa.int32()), pa.array(out, pa.binary())], names=["_block", "_rows"])


def _gather(rows: pa.Table) -> pa.Table:
    """The rows of a block, in no order that a pass could rely on."""
    if not rows.num_rows:
        return pa.table({"_id": pa.array([], pa.int64()), "_text": pa.array([], pa.string())})
    return pa.concat_tables([pa.ipc.open_stream(x.as_buffer()).read_all() for x in rows.column("_rows").combine_chunks()])


def by_level(got: pa.Table) -> dict[int, list[bytes]]:
    out: dict[int, list[bytes]] = {}
    for data in got.column("payload").to_pylist():
        for level, payload in unbundle(data):
            out.setdefault(level, []).append(payload)
    return out


def each(level: int, answer: Callable) -> Callable:
    """A ``reply`` of one level.  ``answer(payloads)`` returns one payload, or None, for each message."""
    return lambda bucket, blocks, payloads: ((b, level, a) for b, a in zip(blocks, answer(payloads), strict=True) if a is not None)
