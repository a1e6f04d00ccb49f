"""Metric samples, service levels and stateful limits over event tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from convograph.workers import written

#: Upper bounds of histogram buckets where none are given.
BUCKETS = [0.1, 0.5, 1.0, 5.0, 10.0, 30.0, 60.0, 120.0, 300.0]


#: Ranges into which values are dealt to find a rank.
RANGES = 4096


def percentiles(samples: DataFrame, group: list[str], value: str, ps: list[float], ranges: int = RANGES) -> DataFrame:
    """Index percentiles of each group: the sorted value at index min(int(n p / 100), n - 1), not interpolated; null values do not count.

    A rank is found by selection: values are dealt into ``ranges`` equal ranges between the least and greatest of their group and counted there; the counts say in which range
    each rank lies, and only the values of those ranges are counted one by one, ranges again between their least and greatest while one holds more than ``ranges`` distinct
    values.  So no group is sorted, and a task holds no more than the counts of ``ranges`` ranges."""
    # Groups are structs, which are equal where nulls are.
    rows = samples.where(F.col(value).isNotNull()).groupBy(F.struct(*group).alias("_k"), value).agg(F.count("*").alias("_c"))
    v = F.col(value).cast("double")
    total = rows.groupBy("_k").agg(F.sum("_c").alias("_all"), F.count("*").alias("_many"), F.min(v).alias("_low"), F.max(v).alias("_high"))
    index = [F.struct(F.lit(f"p{p:g}").alias("name"), F.least(F.floor(F.col("_all") * p / 100), F.col("_all") - 1).alias("left")) for p in ps]
    wanted = total.select("_k", "_many", "_low", "_high", F.inline(F.array(*index)))
    found = None
    while True:
        few = wanted.where(F.col("_many") <= ranges)
        place = W.partitionBy("_k", "name").orderBy(value).rowsBetween(W.unboundedPreceding, 0)
        near = rows.join(few, "_k").where((v >= F.col("_low")) & (v <= F.col("_high"))).withColumn("_upto", F.sum("_c").over(place))
        part = near.where((F.col("_upto") > F.col("left")) & (F.col("_upto") - F.col("_c") <= F.col("left"))).select("_k", "name", value)
        found = part if found is None else found.unionByName(part)
        wanted = written(wanted.where(F.col("_many") > ranges))
        if wanted.isEmpty():
            break
        # The range of a value, and by the counts of ranges the one that the rank lies in.
        at = F.least(F.floor((v - F.col("_low")) / (F.col("_high") - F.col("_low")) * ranges), F.lit(ranges - 1))
        dealt = rows.join(wanted, "_k").where((v >= F.col("_low")) & (v <= F.col("_high"))).groupBy("_k", "name", "left", at.alias("_at")).agg(F.sum("_c").alias("_c"), F.count("*").alias("_n"), F.min(v).alias("_l"), F.max(v).alias("_h"))
        upto = dealt.withColumn("_upto", F.sum("_c").over(W.partitionBy("_k", "name").orderBy("_at").rowsBetween(W.unboundedPreceding, 0)))
        inside = upto.where((F.col("_upto") > F.col("left")) & (F.col("_upto") - F.col("_c") <= F.col("left")))
        wanted = written(inside.select("_k", F.col("_n").alias("_many"), F.col("_l").alias("_low"), F.col("_h").alias("_high"), "name", (F.col("left") - F.col("_upto") + F.col("_c")).alias("left")))
    return found.groupBy("_k").pivot("name", [f"p{p:g}" for p in ps]).agg(F.first(value)).select("_k.*", *[f"`p{p:g}`" for p in ps])


def histogram(samples: DataFrame, group: list[str], value: str, bounds: list[float] | None = None) -> DataFrame:
    """Cumulative counts of values up to each bound."""
    bounds = bounds or BUCKETS
    g = samples.groupBy(*group).agg(*[F.count_if(F.col(value) <= b).alias(f"b{i}") for i, b in enumerate(bounds)])
    return g.select(*group, F.explode(F.array(*[F.struct(F.lit(float(b)).alias("le"), F.col(f"b{i}").alias("count")) for i, b in enumerate(bounds)])).alias("x")).select(*group, "x.le", "x.count")


def error_budget(events: DataFrame, group: list[str], good: Column, target: float, period_minutes: float) -> DataFrame:
    """Consumption of an error budget: share of the bad events that the target allows."""
    g = events.groupBy(*group).agg(F.count("*").alias("total"), F.count_if(good).alias("good"))
    bad, allowed = F.col("total") - F.col("good"), F.col("total") * (1 - target / 100)
    consumed = F.when(allowed > 0, bad / allowed * 100).otherwise(F.lit(0.0))
    budget = period_minutes * (1 - target / 100)
    left = F.greatest(F.lit(0.0), 100 - consumed)
    out = g.withColumns({"bad": bad, "consumed_percent": consumed, "consumed_minutes": F.lit(budget) * consumed / 100, "remaining_minutes": F.greatest(F.lit(0.0), F.lit(budget) - F.lit(budget) * consumed / 100), "remaining_percent": left})
    return out.withColumn("status", F.when(left < 10, "critical").when(left < 20, "warning").otherwise("healthy"))


def windowed_rates(events: DataFrame, ts: str, bad: Column, lengths: dict[str, str]) -> DataFrame:
    """Share of bad events in tumbling windows of several lengths, in one pass over windows of each length."""
    out = None
    for name, length in lengths.items():
        g = events.groupBy(F.window(ts, length).alias("w")).agg(F.count("*").alias("total"), F.count_if(bad).alias("bad")).select(F.lit(name).alias("length"), F.col("w.start").alias("start"), "total", "bad", (F.col("bad") / F.col("total")).alias("burn_rate"))
        out = g if out is None else out.unionByName(g)
    return out


#: Seconds of a key that one window sees at once.
STRETCH = 4096


def over_limit(events: DataFrame, key: str, ts: str, limits: dict[int, int], stretch: int = STRETCH) -> DataFrame:
    """Events with how many of their key's events fall into the trailing windows (seconds), and whether a limit is passed.

    Windows are of whole seconds, so they are counted over one row for each second of a key.  These are cut into stretches of time that overlap by
    the longest window: a frame sees at most ``stretch`` rows and that overlap, however many events a key has."""
    sec, reach = F.col(ts).cast("timestamp").cast("long"), max(limits)
    size = max(stretch, reach)
    each = events.groupBy(F.struct(F.col(key).alias("k"), sec.alias("s")).alias("_at")).agg(F.count("*").alias("_c"))
    own = F.floor(F.col("_at.s") / size)
    late = F.col("_at.s") > (own + 1) * size - reach  # what windows of the next stretch reach back to
    each = each.withColumn("_part", F.explode(F.when(late, F.array(own, own + 1)).otherwise(F.array(own))))
    w = lambda s: W.partitionBy("_at.k", "_part").orderBy("_at.s").rangeBetween(-s + 1, 0)
    seen = each.withColumns({f"in_{s}s": F.sum("_c").over(w(s)) for s in limits}).where(F.col("_part").eqNullSafe(own)).drop("_c", "_part")
    out = events.withColumn("_at", F.struct(F.col(key).alias("k"), sec.alias("s"))).join(seen, "_at").drop("_at")
    hit = F.lit(False)
    for s, most in limits.items():
        hit = hit | (F.col(f"in_{s}s") > most)
    return out.withColumn("limited", hit)


def streaks(events: DataFrame, key: str, order: list[str], ok: Column) -> DataFrame:
    """Length of the run of equal outcomes that ends at each event.

    Events are range-sorted by key and order, so a key of very many events lies in many partitions.  Runs are counted within each; of a partition only its
    first outcome, whether it is one run, and the run at its end go on, and what the partitions before end with is added to its first run.
    Events of one key and order may be split in any way."""
    rows = events.withColumn("ok", ok)
    by = [F.col(c) for c in (key, *order)]
    rows = written(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_pos", F.monotonically_increasing_id())).withColumn("_part", F.shiftright("_pos", 33))
    inside = W.partitionBy(key, "_part").orderBy("_pos")
    rows = rows.withColumn("_run", F.sum(F.when(F.col("ok").eqNullSafe(F.lag("ok").over(inside)) & (F.row_number().over(inside) > 1), 0).otherwise(1)).over(inside.rowsBetween(W.unboundedPreceding, 0)))
    rows = rows.withColumn("streak", F.row_number().over(W.partitionBy(key, "_part", "_run").orderBy("_pos")))
    ends = rows.groupBy(F.struct(key).alias("_k"), "_part").agg(F.min_by(F.struct("ok"), "_pos").alias("_first"), F.max_by(F.struct("ok"), "_pos").alias("_last"), F.max_by("streak", "_pos").alias("_tail"), F.max("_run").alias("_runs"))
    parts = W.partitionBy("_k").orderBy("_part")
    goes_on = F.coalesce(F.col("_first") == F.lag("_last").over(parts), F.lit(False))
    ends = ends.withColumn("_on", goes_on).withColumn("_chain", F.sum(F.when(F.col("_on") & (F.col("_runs") == 1), 0).otherwise(1)).over(parts.rowsBetween(W.unboundedPreceding, 0)))
    ends = ends.withColumn("_whole", F.sum("_tail").over(W.partitionBy("_k", "_chain").orderBy("_part").rowsBetween(W.unboundedPreceding, 0)))
    before = ends.withColumn("_before", F.when(F.col("_on"), F.lag("_whole").over(parts)).otherwise(0)).where("_before > 0").select("_k", "_part", "_before")
    out = rows.withColumn("_k", F.struct(key)).join(F.broadcast(before), ["_k", "_part"], "left") if before.count() <= 10_000 else rows.withColumn("_k", F.struct(key)).join(before, ["_k", "_part"], "left")
    return out.withColumn("streak", F.col("streak") + F.when(F.col("_run") == 1, F.coalesce("_before", F.lit(0))).otherwise(0)).select(*rows.drop("_pos", "_part", "_run").columns)


def circuit(events: DataFrame, key: str, order: list[str], ok: Column, failures: int = 5) -> DataFrame:
    """Events with the state a breaker has after them, from the current run of failures: open from ``failures`` on."""
    s = streaks(events, key, order, ok)
    return s.withColumn("state", F.when(~F.col("ok") & (F.col("streak") >= failures), "open").otherwise("closed"))


def compare(now: DataFrame, base: DataFrame, metric: str, value: str, margin: float = 10.0) -> DataFrame:
    """Change of each metric against a baseline in percent."""
    j = now.select(metric, F.col(value).alias("now")).join(base.select(metric, F.col(value).alias("base")), metric, "full_outer")
    change = F.when(F.col("base") != 0, (F.col("now") - F.col("base")) / F.col("base") * 100)
    return j.withColumns({"change": change, "verdict": F.when(F.col("base").isNull(), "new").when(F.col("now").isNull(), "missing").when(change > margin, "regressed").when(change < -margin, "improved").otherwise("unchanged")})
