"""Conversation structure repair by a dynamic programme over the subsequence of turns that stay.

A repair keeps turns, gives them another role, deletes them or inserts empty ones, so that role initials read ``(s?(ua)+)?``.
What it costs follows from the turns it retains and their roles: turns between two retained ones are deleted, at a
difference of prefix sums, and the pair of roles says what must be inserted between them.  So the cheapest rest after a turn is a
running minimum for each last retained role, over the next retained turn, of prefix sum plus inserts plus the rest after that
turn; it is replaced only by something strictly cheaper, as passes run backwards: of equal costs the one with the later turn, thus
more deletions first, has the ASCII-least audit (D < I < K < R), and for one turn the options are tried in that order.

Nothing needs a conversation in one task.  Turns are range-sorted and cut into stretches of ``STRETCH`` at most; a stretch is a
matrix of least costs from each last role before it to each after it, and such matrices multiply: one scan backwards over
stretches gives the price of what follows each, each is then walked from every possible role before it, and one scan forwards tells which role that is.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convograph.llm.common import shared_folder

#: Turns of a stretch at most: a power of two.
STRETCH = 4096
BITS = STRETCH.bit_length() - 1
BLANK = " \t\n\x0b\x0c\r"
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
#: Last retained roles: none yet, system, user, assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Inserts between the last retained role and the next, and before the end.
BETWEEN = {(START, USER): 0, (START, ASSISTANT): 1, (SYSTEM, USER): 0, (SYSTEM, ASSISTANT): 1, (USER, USER): 1, (USER, ASSISTANT): 0, (ASSISTANT, USER): 0, (ASSISTANT, ASSISTANT): 1, (START, SYSTEM): 0}
AT_END = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
#: Initials as they are coded in a turn, faults as two bits above them.
INITIALS = {"u": USER, "a": ASSISTANT, "s": SYSTEM}
OTHER = 0
FAULTS = ("blank", "duplicate", "truncated")
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
#: Stands for "cannot be" in columns of whole numbers.
NEVER = 1 << 60


def options(code: int, last: int) -> list[tuple[str, int, int]]:
    """(edits, role, cost) of retaining a turn after the last retained role, by edits in ASCII order."""
    initial, fault = code & 3, code >> 2
    if fault in (1, 2):
        return []
    found = []
    for role in (SYSTEM, USER, ASSISTANT):
        same = initial == role
        if (last, role) in BETWEEN and (same or role != SYSTEM):
            n = BETWEEN[last, role]
            found.append(("I" * n + ("K" if same else "R"), role, INSERT * n + REROLE * (not same) + TRUNCATED * (fault == 3)))
    return sorted(found)


OPTIONS = [[options(code, last) for last in range(4)] for code in range(16)]


@lru_cache(1 << 14)
def _step(code: int, rest: tuple) -> tuple[tuple, tuple]:
    """Running minima before a turn from those after it, both less the prefix sum there, and what each chose (None: delete)."""
    less, chosen = [], []
    for last in range(4):
        best, choice = DELETE + rest[last], None
        for edits, role, cost in OPTIONS[code][last]:
            if cost + rest[role] < best:
                best, choice = cost + rest[role], (edits, role)
        less.append(best)
        chosen.append(choice)
    return tuple(less), tuple(chosen)


def backwards(codes: list[int], ends: list[float], trace: list | None = None) -> list[float]:
    """Least cost of a stretch and what follows it, by last role before it; ``ends``: the same of what follows.  Choices go to ``trace``, last turn first."""
    base, rest = 0, tuple(ends)
    for code in reversed(codes):
        low = min(rest)
        if low and low < math.inf:  # few distinct differences are met, whatever the sums
            base, rest = base + low, tuple(x - low for x in rest)
        rest, chosen = _step(code, rest)
        if trace is not None:
            trace.append(chosen)
    return [base + x for x in rest]


def forwards(trace: list, last: int) -> tuple[list[str], int]:
    """Edits of each turn after a last role, and the last role then."""
    edits = []
    for chosen in reversed(trace):
        if chosen[last] is None:
            edits.append("D")
        else:
            word, last = chosen[last]
            edits.append(word)
    return edits, last


def _rows(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(b.column(n).to_pylist() for n in names), strict=True)


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 1000) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    for r in rows:
        out.append(r)
        if len(out) == size:
            yield pa.RecordBatch.from_pydict(dict(zip(schema.names, zip(*out, strict=True), strict=True)), schema)
            out = []
    if out:
        yield pa.RecordBatch.from_pydict(dict(zip(schema.names, zip(*out, strict=True), strict=True)), schema)


def _summaries(batches):
    """For each stretch its matrix (role before, role after), and what concerns its turns and the edges to its neighbours."""
    schema = pa.schema([("_id", pa.int64()), ("_matrix", pa.list_(pa.int64())), ("_first", pa.int64()), ("_last", pa.int64()), ("_from", pa.int64()), ("_to", pa.int64()), ("_turns", pa.int64()), ("_illegal", pa.int64())])

    def run():
        for at, codes, turns in _rows(batches, "_id", "_codes", "_numbers"):
            columns = [backwards(codes, [0 if p == q else math.inf for p in range(4)]) for q in range(4)]
            roles = [c & 3 for c in codes]
            some = [t for t in turns if t is not None]
            steps = sum(a != b for a, b in zip(some, some[1:], strict=False))
            bad = sum(x not in LEGAL for x in zip(roles, roles[1:], strict=False))
            yield at, [NEVER if columns[q][p] == math.inf else int(columns[q][p]) for p in range(4) for q in range(4)], roles[0], roles[-1], some[0] if some else None, some[-1] if some else None, steps + bool(some), bad

    return _batches(run(), schema)


def _prices(key: str):
    """A scan over stretches, last one first: the price of what follows each, and what each has in common with the stretch after it."""
    schema = pa.schema([("_id", pa.int64()), ("_ends", pa.list_(pa.int64())), ("_cost", pa.int64()), ("_edge", pa.int64()), ("_again", pa.int64())])

    def scan(batches):
        now, ends, first, number = None, [], None, None
        for part, at, matrix, head, tail, low, high in _rows(batches, key, "_id", "_matrix", "_first", "_last", "_from", "_to"):
            if now is None or part != now[0]:
                now, ends, first, number = (part,), [INSERT * AT_END[p] for p in range(4)], None, None
            before = [min(min(matrix[4 * p + q] + ends[q] for q in range(4)), NEVER) for p in range(4)]
            yield at, list(ends), before[START], int(first is not None and (tail, first) not in LEGAL), int(number is not None and number == high)
            ends, first, number = before, head, low if low is not None else number

    return lambda batches: _batches(scan(batches), schema)


def _walks(batches):
    """For each stretch and each last role before it, its edits and the last role after it."""
    schema = pa.schema([("_id", pa.int64()), ("_edits", pa.list_(pa.list_(pa.string()))), ("_exits", pa.list_(pa.int32()))])

    def run():
        for at, codes, ends in _rows(batches, "_id", "_codes", "_ends"):
            trace: list = []
            backwards(codes, [math.inf if x >= NEVER else x for x in ends], trace)
            walks = [forwards(trace, last) for last in range(4)]
            yield at, [w[0] for w in walks], [w[1] for w in walks]

    return _batches(run(), schema)


def _entries(key: str):
    """A scan over stretches in order: the last role before each, and the inserts after the last one of a conversation."""
    schema = pa.schema([("_id", pa.int64()), ("_entry", pa.int32()), ("_tail", pa.int32())])

    def scan(batches):
        held = None
        for part, at, exits in _rows(batches, key, "_id", "_exits"):
            if held and held[0] != part:
                yield held[1], held[2], AT_END[held[3]]
                held = None
            elif held:
                yield held[1], held[2], 0
            entry = held[3] if held else START
            held = (part, at, entry, exits[entry])
        if held:
            yield held[1], held[2], AT_END[held[3]]

    return lambda batches: _batches(scan(batches), schema)


def _edited(kind: pa.DataType, key: str):
    """Merges edits with the turns that follow them: a row for each edit."""

    def scan(batches):
        edits: Iterator[str] = iter(())
        tail, left, last, where = 0, 0, START, (None, 0)
        for part, pos, role, text, words, entry, inserts in _rows(batches, key, "_pos", "_role", "_text", "_edits", "_entry", "_tail"):
            if words is not None:
                edits, left, tail, last = iter(words), len(words), inserts, entry
                continue
            word = next(edits)
            left -= 1
            for k, e in enumerate(word):
                if e == "D":
                    yield part, pos, k, e, role, text
                    continue
                if e == "I":
                    last = ASSISTANT if last == USER else USER
                    yield part, pos, k, e, NAMES[last], ""
                elif e == "K":
                    last = INITIALS[role[0]]
                    yield part, pos, k, e, role, text
                else:
                    last = ASSISTANT if last == USER else USER
                    yield part, pos, k, e, NAMES[last], text
            if not left:
                for k in range(tail):
                    last = ASSISTANT if last == USER else USER
                    yield part, pos, len(word) + k, "I", NAMES[last], ""

    schema = pa.schema([(key, kind), ("_pos", pa.int64()), ("_k", pa.int32()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
    return lambda batches: _batches(scan(batches), schema, 200)


def damage(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text) of turns with faults put in, by the crc32 of ``<conv_id>:<turn>`` modulo 20: 0 drops a turn, 1 empties
    its text, 2 takes out its ``[.!?]``, 3 repeats it, 4 makes it the user's.  Nulls read as one space, but stay null as conversation and turn."""
    some = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    rows = turns.select(F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"), some(role_col).alias("role"), some(text_col).alias("text"), (F.crc32(F.concat_ws(":", some(conv_col), some(turn_col))) % 20).alias("_kind"))
    kind = F.col("_kind")
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.where(kind != 0).select("conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(copies).alias("_copy")).drop("_copy")


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(log, found).  ``log`` has a row for each edit of the cheapest repair (conv, _pos and _k, which give their order, edit, role, text): kept, reroled and
    inserted turns as they are afterwards, deleted ones as they were.  ``found`` has for each conversation with turns its gaps, faults, illegal neighbours and cost.

    Turns are taken by number (nulls first), those of one number by role and text; a turn's first fault counts (blank, duplicate of an
    earlier role and text, truncated).  Null roles and texts are one space; null conversations are one conversation; roles of other initials than s, u and a,
    and empty roles, cannot be kept.  Other columns are not read.  A conversation may have any number of turns, and repeated ones: ranges are split by them too."""
    spark = turns.sparkSession
    at = shared_folder(spark, "conversations")
    some = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    rows = turns.select(F.col(f"`{conv_col}`").alias(conv_col), F.col(f"`{turn_col}`").cast("long").alias("_turn"), some(role_col).alias("_role"), some(text_col).alias("_text"))
    by = [F.col(f"`{conv_col}`"), "_turn", "_role", "_text", "_row"]
    rows = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by).drop("_row")
    rows.withColumn("_pos", F.monotonically_increasing_id()).write.parquet(at)
    conv = F.col(f"`{conv_col}`")
    rows = spark.read.parquet(at).withColumn("_part", F.shiftright("_pos", BITS))

    trimmed = F.rtrim("_text", F.lit(BLANK))
    initial = F.coalesce(*[F.when(F.substring("_role", 1, 1) == x, code) for x, code in INITIALS.items()], F.lit(OTHER))
    ended = F.right(trimmed, F.lit(1)).isin(".", "!", "?")
    traits = rows.select(conv, "_part", "_pos", "_turn", initial.alias("_initial"), (trimmed == "").alias("_blank"), ended.alias("_ended"), F.sha2(F.concat_ws(":", F.length("_role"), "_role", "_text"), 256).alias("_same"))
    # Each role and text is first met at one position; positions are unique, so no text is hot in the join.
    firsts = traits.where("NOT _blank").groupBy(conv, "_same").agg(F.min("_pos").alias("_pos")).select("_pos", F.lit(True).alias("_new"))
    traits = traits.drop("_same").join(firsts, "_pos", "left")
    fault = F.when(F.col("_blank"), 1).when(F.col("_new").isNull(), 2).when(~F.col("_ended"), 3).otherwise(0)
    traits = traits.select(conv, "_part", "_pos", "_turn", (F.col("_initial") + 4 * fault).alias("_code"))
    stretches = traits.groupBy(conv, "_part").agg(F.array_sort(F.collect_list(F.struct("_pos", "_code", "_turn"))).alias("_x"))
    stretches = stretches.select(conv, F.col("_x")[0]["_pos"].alias("_id"), F.col("_x._code").alias("_codes"), F.col("_x._turn").alias("_numbers")).checkpoint()

    summary = "_id long, _matrix array<long>, _first long, _last long, _from long, _to long, _turns long, _illegal long"
    summaries = stretches.mapInArrow(_summaries, summary).join(stretches.select(conv, "_id"), "_id").checkpoint()
    prices = summaries.repartition(conv).sortWithinPartitions(conv, F.desc("_id")).mapInArrow(_prices(conv_col), "_id long, _ends array<long>, _cost long, _edge long, _again long").checkpoint()
    walks = stretches.join(prices.select("_id", "_ends"), "_id").mapInArrow(_walks, "_id long, _edits array<array<string>>, _exits array<int>").checkpoint()
    exits = walks.select("_id", "_exits").join(stretches.select(conv, "_id"), "_id")
    entries = exits.repartition(conv).sortWithinPartitions(conv, "_id").mapInArrow(_entries(conv_col), "_id long, _entry int, _tail int")
    edits = walks.join(entries, "_id").join(stretches.select(conv, "_id"), "_id")

    # Edits go before the first turn of their stretch, in one sorted stream with the turns.
    none = {"_edits": "array<string>", "_entry": "int", "_tail": "int"}
    stream = rows.select(conv, "_part", "_pos", F.lit(1).alias("_kind"), "_role", "_text", *[F.lit(None).cast(t).alias(c) for c, t in none.items()])
    heads = edits.select(conv, F.shiftright("_id", BITS).alias("_part"), F.col("_id").alias("_pos"), F.lit(0).alias("_kind"), F.lit("").alias("_role"), F.lit("").alias("_text"), F.col("_edits")[F.col("_entry")].alias("_edits"), "_entry", "_tail")
    stream = stream.unionByName(heads).repartition(conv, "_part").sortWithinPartitions(conv, "_pos", "_kind")
    kind = turns.select(conv).schema
    log = stream.mapInArrow(_edited(_arrow(kind[0].dataType), conv_col), f"`{conv_col}` {kind[0].dataType.simpleString()}, _pos long, _k int, edit string, role string, text string")

    faults = [F.sum(_how_many(k)).cast("long").alias(f) for k, f in enumerate(FAULTS, 1)]
    seen = F.sum("_turns") - F.sum("_again")
    whole = stretches.select(conv, "_id", "_codes").join(summaries.drop(conv_col), "_id").join(prices.drop("_ends"), "_id").groupBy(conv)
    gaps = F.when(F.max("_to").isNull(), 0).otherwise(F.max("_to") - F.min("_from") + 1 - seen)
    return log, whole.agg(gaps.alias("gaps"), *faults, (F.sum("_illegal") + F.sum("_edge")).alias("illegal"), F.min_by("_cost", "_id").alias("cost"))


def _how_many(fault: int):
    return F.size(F.filter("_codes", lambda c: F.shiftright(c, 2) == fault))


def _arrow(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def _digest(kind: pa.DataType, key: str):
    """Audits and digests of sorted logs, in one pass with the state of one digest."""

    def scan(batches):
        now, audit, digest, none = None, [], hashlib.sha256(), True
        for part, edit, role, text in _rows(batches, key, "edit", "role", "text"):
            if now is None or now[0] != part:
                if now is not None:
                    yield now[0], "".join(audit), digest.hexdigest()
                now, audit, digest, none = (part,), [], hashlib.sha256(), True
            audit.append(edit)
            if edit != "D":
                digest.update(f"{'' if none else chr(10)}{role}:{text}".encode())
                none = False
        if now is not None:
            yield now[0], "".join(audit), digest.hexdigest()

    return lambda batches: _batches(scan(batches), pa.schema([(key, kind), ("audit", pa.string()), ("repaired_sha256", pa.string())]))


def digests(turns: DataFrame, log: DataFrame, found: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Every conversation of ``turns`` with what was found in it, the edits' initials and the SHA-256 of its repaired turns.

    A digest takes in its conversation from first to last, so its rows pass through one task, which holds the state of the digest alone."""
    conv, kind = F.col(f"`{conv_col}`"), turns.select(F.col(f"`{conv_col}`")).schema[0].dataType
    marks = log.repartition(conv).sortWithinPartitions(conv, "_pos", "_k").mapInArrow(_digest(_arrow(kind), conv_col), f"`{conv_col}` {kind.simpleString()}, audit string, repaired_sha256 string")
    whole = turns.select(conv.alias("_conv")).distinct()
    for part in (found, marks):
        part = part.withColumnRenamed(conv_col, "_c")
        whole = whole.join(part, whole["_conv"].eqNullSafe(part["_c"]), "left").drop("_c")
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", *FAULTS, "illegal", "cost")]
    return whole.select(F.col("_conv").alias(conv_col), *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
