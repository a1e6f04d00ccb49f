"""Linking tool calls with their results, in DataFrame functions only.

Calls and results are joined by identifier in shuffled hash joins, calls are ordered topologically by what they come
after, arguments are validated against schemas, and each pair is serialised as canonical JSON
(object keys in order, no blanks).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from convograph.llm.common import ready

#: Types of a schema by the names Spark gives variants.
TYPES = {"integer": "BIGINT", "string": "STRING", "boolean": "BOOLEAN", "number": "BIGINT|DOUBLE|FLOAT|DECIMAL.*", "array": "ARRAY.*", "object": "OBJECT.*"}
#: Turns of a conversation that are numbered by one task.
STRETCH = 1024


def quoted(text: Column) -> Column:
    """A string as JSON; null stays null in JSON."""
    array = F.to_json(F.array(text))
    return F.when(text.isNull(), F.lit("null")).otherwise(F.substring(array, F.lit(2), F.length(array) - 2))


def canonical(json: Column) -> Column:
    """JSON text with sorted keys and without blanks; null if it is not JSON."""
    return F.to_json(F.try_parse_json(json))


def errors(name: Column, arguments: Column, schemas: dict[str, dict[str, dict]]) -> Column:
    """What is wrong with arguments (JSON text) under the schema of their tool, in order of the field names.

    A schema maps a field to {type, required, min, max, enum}.  An unknown tool, text that is not a JSON object and
    fields that the schema does not name are errors."""
    value = F.try_parse_json(arguments)

    def field(tool: str, key: str, rule: dict) -> list[Column]:
        v = F.try_variant_get(value, f"$.{key}", "variant")
        kind = F.schema_of_variant(v)
        missing = v.isNull() | (kind == "VOID")
        out = []
        if rule.get("required"):
            out.append(F.when(missing, F.lit(f"{key}: missing")))
        out.append(F.when(~missing & ~kind.rlike(f"^({TYPES[rule['type']]})$"), F.lit(f"{key}: not {rule['type']}")))
        number = F.try_variant_get(value, f"$.{key}", "double")
        if "min" in rule:
            out.append(F.when(number < rule["min"], F.lit(f"{key}: below {rule['min']}")))
        if "max" in rule:
            out.append(F.when(number > rule["max"], F.lit(f"{key}: above {rule['max']}")))
        if "enum" in rule:
            out.append(F.when(~missing & ~F.coalesce(F.try_variant_get(value, f"$.{key}", "string").isin(rule["enum"]), F.lit(False)), F.lit(f"{key}: not one of {'|'.join(map(str, rule['enum']))}")))
        return [F.when(name == tool, c) for c in out]

    keys = F.json_object_keys(arguments)
    found = [c for tool, rules in sorted(schemas.items()) for key, rule in sorted(rules.items()) for c in field(tool, key, rule)]
    known = F.when(name == F.lit(None), F.array().cast("array<string>"))
    for tool, rules in sorted(schemas.items()):
        known = known.when(name == tool, F.array(*[F.lit(k) for k in sorted(rules)]))
    extra = F.coalesce(F.transform(F.array_sort(F.array_except(keys, known)), lambda k: F.concat(k, F.lit(": unknown"))), F.array().cast("array<string>"))
    listed = F.concat(F.filter(F.array(*found), lambda c: c.isNotNull()), extra) if found else extra
    return F.when(~F.coalesce(name.isin(sorted(schemas)), F.lit(False)), F.array(F.lit("tool: unknown"))).when(keys.isNull(), F.array(F.lit("arguments: no object"))).otherwise(listed)


def hashed(d: DataFrame) -> DataFrame:
    """As the side of a join that its tasks hash; its rows are one for each key."""
    return d.hint("shuffle_hash")


def anchors(single: DataFrame) -> DataFrame:
    """(id, anchor, steps, open): for ids that come after one call each, the first call on the way up that does not, by pointer doubling.

    Every round doubles the steps, so a chain of n calls takes about log2(n) rounds.  Ways that lead round a cycle stay open."""
    now = single.select("id", F.col("before").alias("anchor"), F.lit(1).cast("long").alias("steps")).checkpoint()
    n, reach = now.count(), 1
    while True:
        up = now.select(F.col("id").alias("anchor"), F.col("anchor").alias("_next"), F.col("steps").alias("_more"))
        far = now.join(hashed(up), "anchor", "left")
        now = far.select("id", F.coalesce("_next", "anchor").alias("anchor"), (F.col("steps") + F.coalesce("_more", F.lit(0))).alias("steps"), F.col("_next").isNotNull().alias("open")).checkpoint()
        reach *= 2
        if reach > n or not now.where("open").head(1):
            # the last round may have gone on from a way that is done: what is open now still stands before such a call
            still = now.join(hashed(single.select(F.col("id").alias("anchor"))), "anchor", "left_semi").select("id", F.lit(True).alias("_cyclic"))
            return now.join(hashed(still), "id", "left").select("id", "anchor", "steps", F.coalesce("_cyclic", F.lit(False)).alias("open"))


def levels(after: DataFrame) -> DataFrame:
    """(id, level, cyclic) of the ids in edges (id, before): the longest way from a call that comes after none.

    Calls after one other are contracted to the end of their way by pointer doubling.  Calls after several are then
    settled in rounds, one for each level among calls of that kind alone.  Calls on or behind a cycle have no level."""
    edges = after.where("id is not null and before is not null").distinct().checkpoint()
    count = edges.groupBy("id").agg(F.count("*").alias("n"))
    single = edges.join(hashed(count.where("n = 1").select("id")), "id", "left_semi")
    ways = anchors(single)
    many = edges.join(hashed(count.where("n > 1").select("id")), "id", "left_semi")
    # what a call after several waits for: the end of the way of each call before it
    end = ways.select(F.col("id").alias("before"), "anchor", "steps", "open")
    waits = many.join(hashed(end), "before", "left").select("id", F.coalesce("anchor", "before").alias("anchor"), (F.coalesce("steps", F.lit(0)) + 1).alias("steps"), F.coalesce("open", F.lit(False)).alias("open")).checkpoint()
    known = settled = None
    left = waits.select("id").distinct().count()
    while left:
        # settled: all anchors are roots or have a level
        level = waits.join(hashed(waits.select(F.col("id").alias("anchor")).distinct().withColumn("_waits", F.lit(True))), "anchor", "left")
        level = level.join(hashed(known.withColumnRenamed("id", "anchor").withColumnRenamed("level", "_level")), "anchor", "left") if known is not None else level.withColumn("_level", F.lit(None).cast("long"))
        stuck = F.col("open") | (F.col("_waits").isNotNull() & F.col("_level").isNull())
        settled = level.groupBy("id").agg(F.max(F.col("steps") + F.coalesce("_level", F.lit(0))).alias("level"), F.max(F.coalesce(stuck, F.lit(False))).alias("stuck")).where("not stuck").select("id", "level").checkpoint()
        n = settled.count()
        if known is not None and n == known_n:
            break
        known, known_n = settled, n
        if n == left:
            break
    several = waits.select("id").distinct()
    several = several.join(hashed(known), "id", "left") if known is not None else several.withColumn("level", F.lit(None).cast("long"))
    top = several.select(F.col("id").alias("anchor"), F.lit(True).alias("_several"), F.col("level").alias("_level"))
    one = ways.join(hashed(top), "anchor", "left").select("id", F.when(~F.col("open") & (F.col("_several").isNull() | F.col("_level").isNotNull()), F.col("steps") + F.coalesce("_level", F.lit(0))).alias("level"))
    return one.unionByName(several.select("id", "level")).withColumn("cyclic", F.col("level").isNull())


def numbered(rows: DataFrame, calls: DataFrame) -> DataFrame:
    """Adds ``position``, from 0, by (turn, canonical) among the calls of a conversation that have one level.

    ``calls`` are the same rows without their texts.  Turns are numbered in stretches, and only the sizes of stretches are summed
    over a whole level, so that the calls of a conversation are never in one task, however many."""
    key = ["_conv", "_level", "_stretch"]

    def keyed(d: DataFrame) -> DataFrame:
        low = F.lit(-(1 << 62))
        return d.withColumns({"_conv": F.coalesce("conv_id", low), "_level": F.coalesce("level", low), "_stretch": F.floor(F.coalesce("turn", low) / STRETCH)})

    size = keyed(calls).groupBy(*key).agg(F.count("*").alias("_n"))
    before = size.select(*key, F.coalesce(F.sum("_n").over(W.partitionBy("_conv", "_level").orderBy("_stretch").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before")).where("_before > 0")
    inner = keyed(rows).withColumn("_rn", F.row_number().over(W.partitionBy(*key).orderBy("turn", "canonical")))
    return inner.join(hashed(before), key, "left").withColumn("position", (F.coalesce("_before", F.lit(0)) + F.col("_rn") - 1).cast("long")).drop("_rn", "_before", *key)


def link(calls: DataFrame, results: DataFrame, after: DataFrame, schemas: dict[str, dict[str, dict]]) -> DataFrame:
    """One row for each call and for each result identifier without a call.

    calls: (conv_id, turn, call_id, name, arguments); results: (conv_id, turn, call_id, content); after: (id, before); other columns are not read.
    Columns: conv_id, turn, call_id, name, level, position, status (linked, unanswered, cyclic, orphan), n_results, valid,
    errors, canonical.  A conversation's calls run in order of (level, position): a level comes after the ones below, and positions are by (turn, canonical)
    within it.  Of several results of an identifier the one of the least (turn, content) is serialised and
    all are counted, before the join; calls of one identifier, repeated rows included, each keep their row and result.  Calls without an
    identifier link to nothing and calls after unknown ones do not wait; a null conversation is one of its own.  Cyclic calls have no level.  Orphans have no name, level, position or errors.
    Texts of any length are taken whole; empty tables give no rows."""
    ready(calls.sparkSession)
    calls = calls.select("conv_id", "turn", "call_id", "name", "arguments")
    one = results.where("call_id is not null").groupBy("call_id").agg(F.count("*").alias("n_results"), F.min(F.struct("turn", "content", "conv_id")).alias("_r"))
    known = after.join(hashed(calls.select(F.col("call_id").alias("before")).where("before is not null").distinct()), "before", "left_semi")
    level = levels(known.select("id", "before")).withColumnRenamed("id", "call_id").checkpoint()

    def joined(d: DataFrame, *sides: DataFrame) -> DataFrame:
        # calls without an identifier match nothing and are dealt by their place
        d = d.withColumn("_deal", F.when(F.col("call_id").isNull(), F.xxhash64("conv_id", "turn")).otherwise(F.lit(0)))
        for side in sides:
            d = d.join(hashed(side.withColumn("_deal", F.lit(0).cast("long"))), ["call_id", "_deal"], "left")
        return d.drop("_deal")

    found = joined(calls, one, level)
    wrong = errors(F.col("name"), F.col("arguments"), schemas)
    content = F.col("_r.content")
    args = F.coalesce(canonical(F.col("arguments")), quoted(F.col("arguments")))
    text = F.concat(F.lit('{"arguments":'), args, F.lit(',"id":'), quoted(F.col("call_id")), F.lit(',"name":'), quoted(F.col("name")), F.lit(',"result":'), quoted(content), F.lit("}"))
    known_level = F.when(~F.coalesce("cyclic", F.lit(False)), F.coalesce("level", F.lit(0))).cast("long").alias("level")
    rows = found.select(
        "conv_id", "turn", "call_id", "name", known_level,
        F.when(F.coalesce("cyclic", F.lit(False)), "cyclic").when(F.col("n_results") > 0, "linked").otherwise("unanswered").alias("status"),
        F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"), wrong.alias("_errors"), text.alias("canonical"),
    )
    places = joined(calls.select("conv_id", "turn", "call_id"), level).select("conv_id", "turn", known_level)
    rows = numbered(rows, places).select("conv_id", "turn", "call_id", "name", "level", "position", "status", "n_results", (F.size("_errors") == 0).alias("valid"), F.array_join("_errors", "; ").alias("errors"), "canonical")
    alone = one.join(hashed(calls.select("call_id").where("call_id is not null").distinct()), "call_id", "left_anti")
    lost = alone.select(
        F.col("_r.conv_id").alias("conv_id"), F.col("_r.turn").alias("turn"), "call_id", F.lit(None).cast("string").alias("name"), F.lit(None).cast("long").alias("level"), F.lit(None).cast("long").alias("position"),
        F.lit("orphan").alias("status"), F.col("n_results").cast("long").alias("n_results"), F.lit(False).alias("valid"), F.lit("").alias("errors"),
        F.concat(F.lit('{"arguments":null,"id":'), quoted(F.col("call_id")), F.lit(',"name":null,"result":'), quoted(content), F.lit("}")).alias("canonical"),
    )
    return rows.unionByName(lost)


#: The tools as which the turns of a plain conversation are read.
SCHEMAS = {
    "answer": {"chars": {"type": "integer", "required": True, "min": 1, "max": 800}, "text": {"type": "string", "required": True}, "words": {"type": "integer", "required": True, "min": 3}},
    "configure": {"chars": {"type": "integer", "required": True, "max": 300}, "text": {"type": "string", "required": True}, "words": {"type": "integer", "required": True, "min": 1, "max": 40}},
}


def from_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(calls, results, after) of plain turns (conv_id, turn, role, text).

    A user turn calls ``answer`` and a system turn ``configure``; an assistant turn is the result of the turn before
    it; a call comes after the call one turn before it or, where there is none, two turns before it, so the calls of a conversation
    are a chain that a longer break ends.  Other roles, null included, are no calls."""
    t = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text"))
    ident = lambda turn: F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))
    words = F.size(F.filter(F.split("text", r"[\x20\x09-\x0D]+", -1), lambda w: w != "")).cast("long")
    args = F.to_json(F.struct(F.col("text").alias("text"), words.alias("words"), F.length("text").cast("long").alias("chars")))
    call = t.where("role in ('user', 'system')")
    calls = call.select("conv_id", "turn", ident(F.col("turn")).alias("call_id"), F.when(F.col("role") == "user", "answer").otherwise("configure").alias("name"), args.alias("arguments"))
    results = t.where("role = 'assistant' and conv_id is not null and turn is not null").select("conv_id", "turn", ident(F.col("turn") - 1).alias("call_id"), F.col("text").alias("content"))
    places = call.where("conv_id is not null and turn is not null").select("conv_id", "turn").distinct()
    # each call offers itself to the two turns after it; a turn takes the nearest offer
    offers = places.select("conv_id", F.explode(F.array(F.col("turn") + 1, F.col("turn") + 2)).alias("turn"), F.col("turn").alias("_from")).groupBy("conv_id", "turn").agg(F.max("_from").alias("_from"))
    after = places.join(hashed(offers), ["conv_id", "turn"]).select(ident(F.col("turn")).alias("id"), ident(F.col("_from")).alias("before"))
    return calls, results, after
