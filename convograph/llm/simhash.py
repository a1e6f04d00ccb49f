"""SimHash near-duplicates found through a table of distances to reference fingerprints.

The distances of a fingerprint to fixed reference fingerprints (pivots) are its coordinates; by
the triangle inequality two fingerprints that differ in at most ``k`` bits differ by at most ``k`` in
every coordinate.  Fingerprints are laid out by their first coordinate, and each meets only those within ``k`` of
it there; pairs with a larger difference in any other coordinate are discarded, and the rest
are verified bit by bit.

One coordinate alone would leave windows that grow with the corpus.  So fingerprints are dealt into cells first:
of ``k + 2`` blocks of bits two at least are equal in any pair within ``k`` bits, and a cell holds the
fingerprints that agree in two given blocks.  A cell with too many of them is split the same way on
its other bits, until it has CELL at most or its fingerprints are few enough to be bounded by the bits that are left.
"""

from __future__ import annotations

from functools import reduce
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convograph.llm.common import id_text, lean, packed, ready
from convograph.llm.exchange import LAST
from convograph.operators.components import connected_components

BITS = ((np.arange(256)[:, None] >> np.arange(7, -1, -1)) & 1).astype(np.int64)
PIVOTS = np.array([xxhash.xxh64_intdigest(f"pivot {i}", 42) for i in range(16)], np.uint64)
#: Fingerprints of a cell that are compared with each other at once.
CELL = 256
FIRST = int(PIVOTS[0].view(np.int64))


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64 bits, each set if it is set in over half of the XXH64 hashes of the word shingles."""
    w = (text or "").encode("utf-8", "replace").lower().split()
    if not w:
        return 0
    rows = [b" ".join(w)] if len(w) <= shingle else map(b" ".join, zip(*[w[i:] for i in range(shingle)], strict=False))
    digest = xxhash.xxh64_digest
    h = np.frombuffer(b"".join([digest(s, 42) for s in rows]), np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(h[:, i], minlength=256) @ BITS for i in range(8)])
    return int(np.packbits(2 * ones > len(h)).view(">u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(_id, _fp) of rows of (_id, _text)."""
    ready(docs.sparkSession)

    def run(batches):
        for batch in batches:
            fp = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], names=["_id", "_fp"])

    return docs.select("_id", "_text").mapInArrow(lean(run), "_id long, _fp long")


def _split(cells: DataFrame, width: int, blocks: int) -> DataFrame:
    """Each row once for each two of the ``blocks`` blocks of ``width`` bits in ``rest``: the two join the cell's key, the others stay."""
    def block(i: int):
        return F.shiftrightunsigned("rest", i * width).bitwiseAND((1 << width) - 1)

    made = []
    for n, two in enumerate(combinations(range(blocks), 2)):
        others = [F.shiftleft(block(k), at * width) for at, k in enumerate(k for k in range(blocks) if k not in two)]
        made.append(F.struct(F.xxhash64("cell", F.lit(n), *map(block, two)).alias("cell"), reduce(lambda x, y: x.bitwiseOR(y), others).alias("rest")))
    return cells.select("fp", F.explode(F.array(*made)).alias("_x")).select("fp", "_x.cell", "_x.rest")


def _cells(points: DataFrame, bits: int) -> DataFrame:
    """Cells that hold every pair within ``bits`` bits, of at most CELL fingerprints each."""
    todo, done, left, blocks = points.select("fp", F.col("fp").alias("rest"), F.lit(0).cast("long").alias("cell")), [], 64, bits + 2
    while True:
        width = -(-left // blocks)
        left = (blocks - 2) * width
        parts = _split(todo, width, blocks)
        live = parts.join(parts.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1"), "cell")
        if 1 << left <= CELL or width == 1:
            done.append(live)
            break
        live = live.checkpoint()
        done.append(live.where(F.col("n") <= CELL))
        todo = live.where(F.col("n") > CELL).select("fp", "rest", "cell")
        if todo.isEmpty():
            break
    return reduce(DataFrame.unionByName, [d.select("cell", "fp") for d in done])


def _roots(pairs: list[tuple[np.ndarray, np.ndarray]]) -> dict[int, int]:
    """Least member of each group of linked fingerprints."""
    up: dict[int, int] = {}

    def top(x: int) -> int:
        while up.get(x, x) != x:
            up[x] = up.get(up[x], up[x])
            x = up[x]
        return x

    for left, right in pairs:
        for a, b in zip(left.tolist(), right.tolist(), strict=True):
            a, b = top(a), top(b)
            if a != b:
                up[max(a, b)] = min(a, b)
    return {x: top(x) for x in up}


def links(points: DataFrame, bits: int = 2) -> DataFrame:
    """(src, dst) that connect all distinct fingerprints ``fp`` that are linked, as stars of each task's groups.

    ``bits`` is at most 8: cells grow with it, as they agree in two of ``bits + 2`` blocks."""
    ready(points.sparkSession)
    if not 0 <= bits <= 8:
        raise ValueError("bits")

    def compare(cell: np.ndarray, fp: np.ndarray, first: np.ndarray):
        """Pairs of a run of cells, each in order of the first coordinate."""
        far = np.stack([np.bitwise_count(fp ^ p) for p in PIVOTS[1:]]).astype(np.int8)
        here, step = np.arange(len(fp)), 1
        while True:
            here = here[here + step < len(fp)]
            here = here[(cell[here] == cell[here + step]) & (first[here + step] - first[here] <= bits)]
            if not len(here):
                return
            near = here[np.abs(far[:, here] - far[:, here + step]).max(axis=0) <= bits]
            near = near[np.bitwise_count(fp[near] ^ fp[near + step]) <= bits]
            yield fp[near].view(np.int64), fp[near + step].view(np.int64)
            step += 1

    def run(batches):
        held, pairs = None, []
        for batch in chain(batches, [None]):
            if batch is not None:
                new = [batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64), batch.column(2).to_numpy()]
                held = new if held is None else [np.concatenate(x) for x in zip(held, new, strict=True)]
            if held is None or not len(held[0]):
                continue
            last = held[0] == held[0][-1]
            end = len(last) if batch is None else int(np.flatnonzero(last)[0])
            pairs.extend(compare(*[x[:end] for x in held]))
            held = [x[end:] for x in held]
        star = [(x, r) for x, r in _roots(pairs).items() if x != r]
        yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in star], pa.int64()), pa.array([r for _, r in star], pa.int64())], names=["src", "dst"])

    first = F.bit_count(F.col("fp").bitwiseXOR(F.lit(FIRST))).alias("first")
    dealt = _cells(points, bits).select("cell", "fp", first).repartition("cell").sortWithinPartitions("cell", "first")
    return dealt.mapInArrow(lean(run), "src long, dst long")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, bits: int = 2) -> DataFrame:
    """(id, fp, component): the SimHash of each whole text and the least id that links of at most ``bits`` bits reach.

    Words are runs of non-blanks with A-Z in lower case.  A text of fewer words than a shingle is one
    shingle; a text without words, null included, has fingerprint zero and is linked like any other.  Equal
    fingerprints are one point, so copies cost nothing; rows of one id each get a row; a null
    id counts as the greatest and a component of null ids only is null.  Other columns are not read; an empty table gives no rows."""
    prints = fingerprints(id_text(docs, id_col, text_col), shingle).checkpoint()
    key = F.coalesce("_id", F.lit(LAST))
    points = prints.groupBy(F.col("_fp").alias("fp")).agg(F.min(key).alias("least")).checkpoint()
    groups = connected_components(links(points, bits))
    rooted = points.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("root"))
    tops = rooted.groupBy("root").agg(F.min("least").alias("component"))
    known = rooted.join(tops, "root").select(F.col("fp").alias("_fp"), F.when(F.col("component") != LAST, F.col("component")).alias("component"))
    return prints.join(known, "_fp").select(F.col("_id").alias(id_col), F.col("_fp").alias("fp"), "component")


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", also: DataFrame | None = None, **options) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are the smallest id of their class; of repeated rows of that id all stay.

    ``also`` has further classes (id, component) of the rows: what either links is one class then, and rows of one id are one.  Null and empty
    texts are one class; a null id stays only in a class of null ids; an empty table stays empty."""
    found = classes(docs, id_col, text_col, **options)
    whole = docs.select(packed(docs, docs.columns).alias("_row"), F.col(f"`{id_col}`").cast("long").alias("_id"))
    if also is not None:
        links = [d.select(*[F.coalesce(c, F.lit(LAST)).alias(to) for c, to in ((id_col, "src"), ("component", "dst"))]) for d in (found, also)]
        parts = connected_components(links[0].unionByName(links[1]))
        return whole.join(parts.where("node != component").select("node"), F.coalesce("_id", F.lit(LAST)) == F.col("node"), "left_anti").select("_row.*")
    stay = found.where(F.col(id_col).eqNullSafe(F.col("component"))).select(F.col(id_col).alias("_stay")).distinct()
    return whole.join(stay, F.col("_id").eqNullSafe(F.col("_stay")), "left_semi").select("_row.*")


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    return found.select(id_col, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))
