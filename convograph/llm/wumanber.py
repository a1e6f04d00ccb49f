"""Benchmark decontamination by Wu-Manber multi-pattern search.

Every window of benchmark words is one pattern.  Patterns of similar length share an automaton:
a table of shifts by text block lets the scan jump over positions where no pattern can end, the
hash of a block that may end a pattern's head selects the patterns to test, and a direct
comparison confirms each occurrence.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convograph.llm.common import lean, packed, ready, schema, shared_folder

#: ASCII letters in lower case and digits stay, other ASCII becomes a blank, the rest is part of words.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
#: Lengths at which a new automaton begins, so that one short pattern does not shorten all shifts.
CLASSES = (0, 6, 12, 24, 48)
#: Bytes of benchmark text that are searched for in one pass; a larger benchmark takes several.
PART_BYTES = 8 << 20
#: The part that this worker holds, by its name: tasks of one pass share it.
_held: dict[str, Benchmark] = {}


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(FOLD).split()


class WuManber:
    """Finds all occurrences of byte patterns."""

    def __init__(self, patterns: list[bytes], block: int = 8):
        self.m = min(map(len, patterns))
        self.b = min(block, self.m)
        self.default = self.m - self.b + 1
        self.shift: dict[bytes, int] = {}
        self.bucket: dict[bytes, list[tuple[bytes, int]]] = defaultdict(list)
        for k, p in enumerate(patterns):
            for end in range(self.b, self.m + 1):
                piece = p[end - self.b : end]
                self.shift[piece] = min(self.shift.get(piece, self.default), self.m - end)
            self.bucket[p[self.m - self.b : self.m]].append((p, k))

    def find(self, text: bytes) -> Iterator[tuple[int, int]]:
        """(start, pattern) of each occurrence, by start."""
        b, m, n, shift, default, bucket = self.b, self.m, len(text), self.shift.get, self.default, self.bucket
        end = m
        while end <= n:
            step = shift(text[end - b : end], default)
            if step:
                end += step
                continue
            for p, k in bucket[text[end - b : end]]:
                if text.startswith(p, end - m):
                    yield end - m, k
            end += 1


class Benchmark:
    """The windows of some items as patterns with blanks around their words."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        owners: dict[bytes, set[str]] = defaultdict(set)
        length: dict[bytes, int] = {}
        for item, text in items:
            w = words(text)
            for i in range(max(1, len(w) - window + 1) if w else 0):
                part = w[i : i + window]
                key = b" " + b" ".join(part) + b" "
                owners[key].add(item)
                length[key] = len(part)
        self.automata = []
        for low, high in zip(CLASSES, [*CLASSES[1:], 1 << 60], strict=True):
            if chosen := [p for p in owners if low <= len(p) < high]:
                self.automata.append((WuManber(chosen), [length[p] for p in chosen], [owners[p] for p in chosen]))

    def scan(self, text: bytes, hit: bytearray, found: set[str]) -> None:
        """Marks the hit words of a text of single-spaced words and adds the items that occur."""
        for automaton, length, owners in self.automata:
            at = word = 0
            for start, k in automaton.find(text):
                word += text.count(b" ", at, start)
                at = start
                hit[word : word + length[k]] = b"\1" * length[k]
                found |= owners[k]


def _part(name: str, items: list[tuple[str, str | None]], window: int) -> Benchmark:
    if name not in _held:
        _held.clear()
        _held[name] = Benchmark(items, window)
    return _held[name]


def _in_parts(rows: DataFrame, size: int) -> Iterator[tuple[list[tuple[str, str | None]], bool]]:
    """Parts of (item, text) rows of about ``size`` bytes, and whether each is the last; the driver holds two at most."""
    now: list[tuple[str, str | None]] = []
    held, total = None, 0
    for item, text in rows.toLocalIterator():
        now.append((item, text))
        total += len((text or "").encode())
        if total >= size:
            if held is not None:
                yield held, False
            held, now, total = now, [], 0
    if held is not None and now:
        yield held, False
    yield now or held or [], True


def _spans(hit: bytearray) -> list[list[int]]:
    out, at = [], hit.find(1)
    while at >= 0:
        end = hit.find(0, at)
        end = len(hit) if end < 0 else end
        out.append([at, end])
        at = hit.find(1, end)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", window: int = 13, share: int = 20, part_bytes: int = PART_BYTES) -> DataFrame:
    """(id, n_words, n_hit, items, spans, contaminated) of each document.

    A word is hit if it lies in an occurrence of a window, ``window`` consecutive words of an item
    or all of a shorter one; ``spans`` are the maximal runs of hit words (start, end).  A document
    is contaminated if it has hits and ``share * n_hit >= n_words``.  Null or empty texts have no
    words and are never contaminated; items without words have no windows; a null item id is
    the empty string; items of one id count once; repeated documents each get a row; texts are searched whole, however long;
    without documents there are no rows, without items no hits; other columns are not read.

    The benchmark is the set of queries that meets all documents, in parts of ``part_bytes`` of text.  A part is
    broadcast, its automata are built once in each worker, and it is released before the next one; what has been hit so far
    goes on to the next pass through the shared folder.  A benchmark of one part, the usual case, takes one pass and writes nothing."""
    spark = ready(docs.sparkSession)
    rows = benchmark.select(F.coalesce(F.col(f"`{item_col}`").cast("string"), F.lit("")), F.col(f"`{item_text}`"))
    state = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"), F.array().cast("array<string>").alias("_items"), F.array().cast("array<array<long>>").alias("_spans"))
    kind = state.schema["_id"].dataType
    going = schema("_id", kind, "_text string, _items array<string>, _spans array<array<long>>")
    done = schema(id_col, kind, "n_words long, n_hit long, items array<string>, spans array<array<long>>, contaminated boolean")

    def scan(shared, last: bool):
        def run(batches):
            part = _part(*shared.value)
            for batch in batches:
                found = []
                for text, items, spans in zip(*[batch.column(k).to_pylist() for k in (1, 2, 3)], strict=True):
                    w, items = words(text), set(items)
                    hit = bytearray(len(w))
                    for a, b in spans:
                        hit[a:b] = b"\1" * (b - a)
                    part.scan(b" " + b" ".join(w) + b" ", hit, items)
                    n_hit = hit.count(1)
                    found.append((len(w), n_hit, sorted(items), _spans(hit), n_hit > 0 and share * n_hit >= len(w)))
                n, h, items, spans, bad = zip(*found, strict=True) if found else ((),) * 5
                items, spans = pa.array(items, pa.list_(pa.string())), pa.array(spans, pa.list_(pa.list_(pa.int64())))
                if last:
                    yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(h, pa.int64()), items, spans, pa.array(bad, pa.bool_())], names=[id_col, "n_words", "n_hit", "items", "spans", "contaminated"])
                else:
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), items, spans], names=["_id", "_text", "_items", "_spans"])

        return run

    for items, last in _in_parts(rows, part_bytes):
        shared = spark.sparkContext.broadcast((uuid.uuid4().hex, items, window))
        if last:
            return state.mapInArrow(lean(scan(shared, True)), done)
        at = shared_folder(spark, "benchmark-pass")
        state.mapInArrow(lean(scan(shared, False)), going).write.parquet(at)
        shared.destroy()
        state = spark.read.schema(going).parquet(at)


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns, in one pass for each part of the benchmark."""
    cols = docs.columns
    whole = docs.select(packed(docs, cols).alias("_row"), F.col(f"`{options.pop('text_col', 'text')}`").alias("_t"))
    return decontaminate(whole, benchmark, id_col="_row", text_col="_t", **options).where(~F.col("contaminated")).select("_row.*")


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return found.select(id_col, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")
