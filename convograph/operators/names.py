"""Pairs of similar names by a prefix-filtered join on their pairs of letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convograph.operators.choice import kept_first
from convograph.operators.entities import similarity
from convograph.workers import written


def _grams(low: Column) -> Column:
    """Pairs of letters with their number among equal ones, so that they are a set; a name of one letter is one itself."""
    pairs = F.when(F.char_length(low) > 1, F.transform(F.sequence(F.lit(1), F.greatest(F.char_length(low) - 1, F.lit(1))), lambda i: F.substring(low, i, F.lit(2)))).otherwise(F.array(low))
    return F.transform(pairs, lambda x, i: F.concat(x, F.lit(":"), F.size(F.filter(F.slice(pairs, F.lit(1), i + 1), lambda y: y == x)).cast("string")))


def common_pairs(total: Column, least: float) -> Column:
    """Pairs of letters that names of this total length have in common at least if their ratio 2M/T reaches ``least``.

    The M letters that match are in T - 2M + 1 blocks at most, each of which loses one pair."""
    matched = F.ceil(F.round(least * total / 2, 9))
    return F.greatest(3 * matched - total - 1, F.lit(1))


def _fewest(total: Column, least: float) -> Column:
    """The same for this length and all above it."""
    return F.greatest(F.ceil(F.round(total * (1.5 * least - 1) - 1, 9)), F.lit(1))


def similar(names: DataFrame, group: str, least: float = 0.85, both: bool = False) -> DataFrame:
    """(group, a, b, similarity): pairs of rows (group, pos, name) of one group whose names, in small letters and trimmed, have a ratio of ``least`` or more; a < b.

    Pairs of letters are ordered by how many names of the group have them.  Names that are alike enough share one among the rarest of each that
    are left when as many as they must have in common are taken off the end, so only those are joined, under a filter by length and place;
    what is found is counted before the letters are compared.  Null names are left out; empty ones are like each other.  At 0.8 or less names
    that share no pair of letters can be alike (ab and acb), so ``least`` has to be more.  The ratio may depend on which name comes first: with ``both``, pairs that are alike either way
    are found, and ``back`` is the ratio with a as the later one."""
    if least <= 0.8:
        raise ValueError("least must be more than 0.8")
    low = F.lower(F.trim("name"))
    rows = names.where(F.col("name").isNotNull()).select(group, "pos", low.alias("low"), F.char_length(low).alias("size"), _grams(low).alias("grams"))
    each = rows.select(group, "pos", F.explode("grams").alias("gram"))
    rarity = each.groupBy(group, "gram").agg(F.count("*").alias("many"))
    ordered = each.join(rarity, [group, "gram"]).groupBy(group, "pos").agg(F.transform(F.array_sort(F.collect_list(F.struct("many", "gram"))), lambda x: x["gram"]).alias("grams"))
    rows = rows.drop("grams").join(ordered, [group, "pos"]).checkpoint()
    shortest = F.ceil(F.round(F.col("size") * least / (2 - least), 9))
    prefix = F.greatest(F.size("grams") - _fewest(F.col("size") + shortest, least) + 1, F.lit(1)).cast("int")
    index = rows.select(group, "pos", "size", F.size("grams").alias("many"), F.posexplode(F.slice("grams", F.lit(1), prefix)).alias("at", "gram"))
    x, y = index.alias("x"), index.alias("y")
    total = F.col("x.size") + F.col("y.size")
    fits = (2 * F.least("x.size", "y.size") >= least * total - 1e-9) & (F.col("x.pos") < F.col("y.pos"))
    left = F.least(F.col("x.many") - F.col("x.at"), F.col("y.many") - F.col("y.at"))
    met = x.join(y, (F.col(f"x.{group}") == F.col(f"y.{group}")) & (F.col("x.gram") == F.col("y.gram"))).where(fits & (left >= common_pairs(total, least)))
    met = met.select(F.col(f"x.{group}").alias(group), F.col("x.pos").alias("a"), F.col("y.pos").alias("b")).distinct()
    for side in ("a", "b"):
        met = met.join(rows.select(group, F.col("pos").alias(side), F.col("low").alias(f"low_{side}"), F.col("grams").alias(f"grams_{side}")), [group, side])
    enough = F.size(F.array_intersect("grams_a", "grams_b")) >= common_pairs(F.char_length("low_a") + F.char_length("low_b"), least)
    # the earlier name is the second sequence, as in a loop that compares each name with those before it
    back = [similarity(F.col("low_a"), F.col("low_b")).alias("back")] if both else []
    found = met.where(enough | (F.col("low_a") == F.col("low_b"))).select(group, "a", "b", similarity(F.col("low_b"), F.col("low_a")).alias("similarity"), *back)
    return found.where((F.greatest("similarity", "back") if both else F.col("similarity")) >= least)


def greedy_resolve(entities: DataFrame, group: str, least: float = 0.85) -> DataFrame:
    """(group, pos, merged_into): within a group (an episode and type) each entity in order joins the most similar one kept before it that is alike enough, else it is kept.

    ``pos`` is unique in a group; of equally similar ones the earlier is joined.  No group is gathered: similar pairs of different names are found by a join and decided in rounds.  Whether a name is
    kept is decided at its first place; later ones of a name that is kept join that, others the most similar name kept before them."""
    low = F.lower(F.trim("name"))
    # equal names of 200 letters may have a ratio below one, so they stand for themselves
    name = F.concat(low, F.when(F.char_length(low) >= 200, F.concat(F.lit("\0"), F.col("pos").cast("string"))).otherwise(""))
    named = entities.where(F.col("name").isNotNull() & F.col(group).isNotNull()).select(group, F.col("pos").cast("long").alias("pos"), name.alias("_name"), low.alias("name"))
    firsts = written(named.groupBy(group, "_name").agg(F.min("pos").alias("first"), F.first("name").alias("name")))
    pairs = written(similar(firsts.select(group, F.col("first").alias("pos"), "name"), group, least, both=True))
    node = lambda c: F.struct(F.col(group).alias("g"), F.col(c).alias("pos"))
    alike = F.col("similarity") >= least
    gone = kept_first(pairs.where(alike).select(node("b").alias("later"), node("a").alias("earlier"))).where("NOT kept").select(F.col("node.g").alias(group), F.col("node.pos").alias("first"))
    gone = written(gone)
    near = pairs.select(group, F.col("b").alias("first"), F.col("a").alias("other"), "similarity").where(alike).unionByName(pairs.select(group, F.col("a").alias("first"), F.col("b").alias("other"), F.col("back").alias("similarity")).where(alike))
    near = near.join(gone, [group, "first"], "left_semi").join(gone.withColumnRenamed("first", "other"), [group, "other"], "left_anti")
    into = near.groupBy(group, "first").agg(F.collect_list(F.struct("similarity", (-F.col("other")).alias("a"))).alias("_into"))
    placed = named.join(firsts.drop("name"), [group, "_name"]).join(into, [group, "first"], "left")
    before = F.array_max(F.filter("_into", lambda x: -x["a"] < F.col("pos")))["a"]
    placed = placed.select(group, "pos", F.when(F.col("_into").isNull(), F.col("first")).otherwise(F.coalesce(-before, F.col("pos"))).alias("merged_into"))
    rest = entities.where(F.col("name").isNull() | F.col(group).isNull()).select(group, F.col("pos").cast("long").alias("pos"), F.col("pos").cast("long").alias("merged_into"))
    return placed.unionByName(rest)
