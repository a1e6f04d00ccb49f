"""Spelling variants: words one edit apart, found in forward and reversed sorted dictionaries.

One edit leaves a half of a word intact: of two words one edit apart, the shorter of ``m`` code points, either the first
``m // 2`` or the last ``m // 2`` code points are equal.  So the words of lengths ``m`` and ``m + 1`` are dealt into blocks of one shared
prefix (a range of the forward dictionary) and of one shared suffix (a range of the reversed one).  A block of over ``BLOCK`` words
is subdivided by the same rule: of the part between what its words share, again a half is intact, so that each word goes on to a
block of a longer prefix and to one of a longer suffix.  This ends where under two code points are left between them, so a block is bounded by the
alphabet, however frequent a prefix is.  Sorted ranges of blocks are scanned and pairs verified code point by code point.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convograph.llm.common import ascii_lower, ready

#: Maximal runs of letters.
RUN = "[A-Za-zÀ-ÿ]"
#: Words of a block that are compared with each other; larger ones are subdivided.
BLOCK = 64


def counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 6, often: int = 5, damage: int = 0) -> DataFrame:
    """(word, n): the words of ``least`` code points or more that occur ``often`` times or more in whole texts, A-Z in lower case.

    With ``damage``, a run whose crc32 of ``<id>:<run>`` it divides first loses the code point at that number modulo its length, so that a share
    of all words is misspelt in a known way.  Null texts have no words; a null id reads as an empty string there.  Counts are
    pre-aggregated before the shuffle, so a frequent word is one row of each task.  Rows of one id count like others."""
    runs = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("_id"), F.explode(F.regexp_extract_all(F.col(f"`{text_col}`"), F.lit(f"{RUN}{{{least},}}"), F.lit(0))).alias("_run"))
    runs = runs.select("_id", ascii_lower(F.col("_run")).alias("_run"))
    word = F.col("_run")
    if damage:
        runs = runs.withColumn("_h", F.crc32(F.concat_ws(":", "_id", "_run")))
        at = F.pmod(F.col("_h"), F.char_length("_run")).cast("int")
        cut = F.concat(F.substring("_run", F.lit(1), at), F.substring("_run", at + 2, F.char_length("_run")))
        word = F.when(F.col("_h") % damage != 0, word).when(F.char_length("_run") > least, cut)
    return runs.select(word.alias("word")).where("word IS NOT NULL").groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= often)


def _halves(rows: DataFrame) -> DataFrame:
    """Each row once with a longer prefix and once with a longer suffix, by half of what lies between them in the shorter word."""
    head, tail, size = F.char_length("_head"), F.char_length("_tail"), F.char_length("word")
    half = F.floor((F.col("_m") - head - tail) / 2).cast("int")
    front = F.struct(F.substring("word", F.lit(1), head + half).alias("_head"), F.col("_tail"))
    back = F.struct(F.col("_head"), F.substring("word", (size - tail - half + 1).cast("int"), tail + half).alias("_tail"))
    return rows.withColumn("_half", F.explode(F.array(front, back))).select("word", "n", "_m", "_half._head", "_half._tail")


def blocks(words: DataFrame, size: int = BLOCK) -> DataFrame:
    """(word, n, _m, _head, _tail): blocks of words of ``_m`` and ``_m + 1`` code points that share a prefix and a suffix.

    Any two words one edit apart meet in one of them; none has over ``size`` words unless under two code points
    of the shorter words are left to differ in.  Only block sizes reach the driver as one count a level; levels are log2 of the longest word."""
    ready(words.sparkSession)
    key = ["_m", "_head", "_tail"]
    length = F.char_length("word")
    rows = words.withColumn("_m", F.explode(F.array(length, length - 1))).where("_m > 0").withColumns({"_head": F.lit(""), "_tail": F.lit("")})
    done = []
    while True:
        rows = _halves(rows).checkpoint()
        # A block needs a word of _m code points: those of _m + 1 among themselves meet elsewhere.
        sizes = rows.groupBy(key).agg(F.count("*").alias("_size"), F.sum((F.char_length("word") == F.col("_m")).cast("int")).alias("_short")).where("_size > 1 AND _short > 0")
        large = (F.col("_size") > size) & (F.col("_m") - F.char_length("_head") - F.char_length("_tail") > 1)
        rows = rows.join(sizes.select(*key, large.alias("_large")), key)
        done.append(rows.where("NOT _large").drop("_large"))
        rows = rows.where("_large").drop("_large")
        if rows.isEmpty():
            return reduce(DataFrame.unionByName, done).select("word", "n", *key)


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced code point makes ``a`` into ``b``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


PAIR = "word string, n long, near string, near_n long"


def _pairs(m: int, block: list[tuple[str, int]]) -> Iterator[tuple[str, int, str, int]]:
    short = [x for x in block if len(x[0]) == m]
    longer = [x for x in block if len(x[0]) > m]
    for i, (a, n) in enumerate(short):
        for b, k in [*short[i + 1 :], *longer]:
            if one_edit(a, b):
                yield a, n, b, k
                yield b, k, a, n


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walks through sorted ranges: a block is a run of rows of one key, and may go on in the next batch."""
    names = [f.partition(" ")[0] for f in PAIR.split(", ")]
    now, block, found = None, [], []

    def batch(rows):
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True)], names=names)

    for rows in batches:
        for m, head, tail, word, n in zip(*(rows.column(c).to_pylist() for c in ("_m", "_head", "_tail", "word", "n")), strict=True):
            if (m, head, tail) != now:
                found.extend(_pairs(now[0], block) if now else ())
                now, block = (m, head, tail), []
                if len(found) >= 4096:
                    yield batch(found)
                    found = []
            block.append((word, n))
    found.extend(_pairs(now[0], block) if now else ())
    if found:
        yield batch(found)


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): all ordered pairs of different words one edit apart, once each.  ``words`` has (word, n), each word once."""
    sorted_ranges = blocks(words).repartitionByRange("_m", "_head", "_tail").sortWithinPartitions("_m", "_head", "_tail", "word")
    return sorted_ranges.mapInArrow(_scan, PAIR).groupBy("word", "near").agg(F.first("n").alias("n"), F.first("near_n").alias("near_n"))


def forms(words: DataFrame, times: int = 5) -> DataFrame:
    """(word, n, form, form_n, n_near, root) of every word.

    ``form`` is the near word of largest count (ties: the smallest in code-point order) if that count is ``times`` the word's or
    more.  ``root`` follows forms to the last; as counts rise by a factor at each step chains are short and have no cycle, and they
    are halved in each round (pointer jumping), whose links are checkpointed."""
    words = words.checkpoint()
    pairs = near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("_n"), F.col("near"))).alias("_best"))
    found = words.join(pairs, "word", "left")
    good = -F.col("_best._n") >= times * F.col("n")
    found = found.select("word", "n", F.when(good, F.col("_best.near")).alias("form"), F.when(good, -F.col("_best._n")).alias("form_n"), F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near")).checkpoint()
    links = found.where("form IS NOT NULL").select("word", F.col("form").alias("root")).checkpoint()
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        joined = links.join(further, "root", "left").checkpoint()
        if joined.where("_next IS NOT NULL").isEmpty():
            break
        links = joined.select("word", F.coalesce("_next", "root").alias("root"))
    return found.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))


def group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", damage: int = 0) -> DataFrame:
    """``forms`` of the ``counts`` of whole texts; an empty table gives no words.  Columns but the two named are not read."""
    return forms(counts(docs, id_col, text_col, damage=damage))


def digests(found: DataFrame) -> DataFrame:
    return found.select("word", "form", "root", "n", "n_near", "form_n")
