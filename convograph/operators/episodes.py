"""Analyses of whole episodes that join or fold what the mention operators give."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from convograph.functions import text as T
from convograph.operators.blocks import against
from convograph.operators.mentions import occurrences


def align(segments: DataFrame, turns: DataFrame, reach: float = 1.0) -> DataFrame:
    """Speaker of each segment (episode_id, segment_index, start_time, end_time) from turns (episode_id, speaker, start, stop).

    Up to ten points of a segment, one each half second, vote for the speaker of the nearest turn within ``reach`` seconds; of equal
    votes the earliest point's wins.  A segment without votes has none.  Turns meet points in buckets of time, so the join is an equi-join."""
    n = F.least(F.lit(10), F.greatest(F.lit(1), F.floor((F.col("end_time") - F.col("start_time")) / 0.5).cast("int")))
    step = (F.col("end_time") - F.col("start_time")) / n
    p = segments.select("episode_id", "segment_index", F.posexplode(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.col("start_time") + step * (i + 0.5))).alias("i", "t")).withColumn("_b", F.floor(F.col("t") / 10))
    t = turns.withColumn("_b", F.explode(F.sequence(F.floor((F.col("start") - reach) / 10), F.floor((F.col("stop") + reach) / 10))))
    gap = F.greatest(F.lit(0.0), F.col("start") - F.col("t"), F.col("t") - F.col("stop"))
    near = p.join(t, ["episode_id", "_b"]).withColumn("gap", gap).where(F.col("gap") < reach)
    vote = near.groupBy("episode_id", "segment_index", "i").agg(F.min(F.struct("gap", "start", "speaker"))["speaker"].alias("speaker"))
    votes = vote.groupBy("episode_id", "segment_index", "speaker").agg(F.count("*").alias("n"), F.min("i").alias("i"))
    return votes.groupBy("episode_id", "segment_index").agg(F.max_by("speaker", F.struct("n", -F.col("i"))).alias("aligned_speaker"))


def interactions(timeline: DataFrame) -> DataFrame:
    """Pairs of concepts in one segment, by how they meet."""
    t = timeline.select("episode_id", "segment_index", "entity_id", F.col("nth"), F.lower("text").alias("low"))
    a, b = t.alias("a"), t.alias("b")
    both = a.join(b, F.expr("a.episode_id = b.episode_id and a.segment_index = b.segment_index and a.entity_id < b.entity_id"))
    kind = F.when((F.col("a.nth") == 1) & (F.col("b.nth") == 1), "co_introduction").when((F.col("b.nth") == 1) & (F.col("a.nth") > 1), "causal_link").otherwise("contrast")
    return both.select("a.episode_id", "a.segment_index", F.col("a.entity_id").alias("src"), F.col("b.entity_id").alias("dst"), kind.alias("interaction"))


def _sentences(text: Column, name: Column) -> Column:
    """Numbers of the sentences, from 0, that have a name."""
    return F.filter(F.transform(F.split(F.lower(text), r"\.", -1), lambda s, i: F.when(F.contains(s, F.lower(name)), i)), lambda i: i.isNotNull())


#: What the confidence in a relationship needs of each name: its place, the text's length, and its sentences.
RELATION = {"at": lambda text, name: F.instr(F.lower(text), F.lower(name)), "size": lambda text, name: F.length(text), "sentences": _sentences}


def relationship_confidence(a: Column, b: Column) -> Column:
    """One less the distance of two names in a text, a fifth more if they share a sentence; a and b have the features ``RELATION``."""
    base = 1 - F.abs(a["at"] - b["at"]) / a["size"]
    return F.when(F.arrays_overlap(a["sentences"], b["sentences"]), F.least(F.lit(1.0), base + 0.2)).otherwise(base)


def bridge_insights(found: DataFrame, communities: DataFrame, top: int = 20) -> DataFrame:
    """Texts that mention entities of two communities or more; score = communities over entities."""
    g = found.join(communities, "entity_id").groupBy("episode_id", "segment_index").agg(F.countDistinct("community").alias("communities"), F.count("*").alias("mentioned")).where("communities > 1")
    return g.withColumn("score", F.col("communities") / F.col("mentioned")).orderBy(F.desc("score"), F.desc("mentioned"), "episode_id", "segment_index").limit(top)


def entropy(values: DataFrame, group: str, weight: str) -> DataFrame:
    """Shannon entropy (natural) of the shares of a weight within each group."""
    w = values.withColumn("_p", F.col(weight) / F.sum(weight).over(W.partitionBy(group))).where("_p > 0")
    return w.groupBy(group).agg((-F.sum(F.col("_p") * F.log("_p"))).alias("entropy"))


def speakers(segments: DataFrame) -> DataFrame:
    """Per speaker of an episode: segments, questions, statements, turns begun, words and role."""
    order = W.partitionBy("episode_id").orderBy("segment_index")
    text = F.col("text")
    q = F.length(text) - F.length(F.replace(text, F.lit("?")))
    s = segments.withColumns({"q": q, "s": F.greatest(F.size(F.filter(F.split(text, "[.!?]+", -1), lambda x: F.trim(x) != "")) - q, F.lit(0)), "begun": (~F.col("speaker").eqNullSafe(F.lag("speaker").over(order))).cast("int")})
    g = s.groupBy("episode_id", "speaker").agg(F.count("*").alias("segments"), F.sum("q").alias("questions"), F.sum("s").alias("statements"), F.sum("begun").alias("turns"), F.sum("word_count").alias("words"))
    ratio = F.col("questions") / F.greatest(F.col("questions") + F.col("statements"), F.lit(1))
    return g.withColumns({"question_ratio": ratio, "role": F.when(ratio > 0.5, "interviewer").when(F.col("turns") > 5, "moderator").otherwise("participant")})


def theme_strength(segments: DataFrame, themes: DataFrame) -> DataFrame:
    """Strength of each theme (theme, concepts) in each segment; themes are broadcast in blocks of known size."""
    low = F.lower("text")
    j = against(segments, themes)
    hits = F.size(F.filter("concepts", lambda c: F.contains(low, F.lower(c))))
    return j.select("episode_id", "segment_index", "theme", F.least(F.lit(1.0), hits / (F.size("concepts") * F.greatest(F.col("word_count") / 100, F.lit(1.0)))).alias("strength"), hits.alias("hits"))


def theme_evolution(strength: DataFrame) -> DataFrame:
    """Per theme of an episode: where it first comes up and how its strength moves."""
    w = W.partitionBy("episode_id", "theme")
    s = strength.withColumns({"n": F.count("*").over(w), "i": F.row_number().over(w.orderBy("segment_index")) - 1})
    third = F.floor(F.col("n") / 3)
    late = F.col("n") - F.ceil(F.col("n") / 3)
    g = s.groupBy("episode_id", "theme").agg(
        F.min(F.when(F.col("hits") > 0, F.col("segment_index"))).alias("first"), F.max("n").alias("n"), F.avg(F.when(F.col("i") < third, F.col("strength"))).alias("early"), F.avg(F.when(F.col("i") >= late, F.col("strength"))).alias("late"),
        (F.max_by("i", F.struct("strength", -F.col("i"))) / F.max("n")).alias("peak"),
    )
    pattern = F.when(F.col("n") < 3, "brief").when(F.col("late") > F.col("early") * 1.5, "crescendo").when(F.col("early") > F.col("late") * 1.5, "diminuendo").when(F.col("peak") < 0.3, "front-loaded").when(F.col("peak") > 0.7, "climactic").otherwise("steady")
    return g.select("episode_id", "theme", "first", "early", "late", pattern.alias("pattern"))


def score_changes(scores: DataFrame, group: str, order: str, score: str) -> DataFrame:
    """Change of a score against the row before, its size and direction; a missing score counts as 50."""
    w = W.partitionBy(group).orderBy(order)
    s = F.coalesce(F.col(score), F.lit(50.0))
    d = scores.withColumn("change", s - F.lag(s).over(w)).where("change is not null")
    a = F.abs("change")
    return d.withColumns({"kind": F.when(a < 10, "smooth").when(a < 20, "moderate").otherwise("abrupt"), "direction": F.when(F.col("change") > 0, "increasing").when(F.col("change") < 0, "decreasing").otherwise("stable")})


def rolled_up(scores: DataFrame, group: str, order: str) -> DataFrame:
    """Mean, sample variance and dominant level (the first seen of equals) of the scores of each group."""
    g = scores.groupBy(group, "level").agg(F.count("*").alias("n"), F.sum("score").alias("s"), F.sum(F.col("score") * F.col("score")).alias("ss"), F.min(order).alias("first"))
    n = F.sum("n")
    return g.groupBy(group).agg((F.sum("s") / n).alias("mean"), F.when(n > 1, (F.sum("ss") - F.sum("s") * F.sum("s") / n) / (n - 1)).otherwise(F.lit(0.0)).alias("variance"), F.max_by("level", F.struct("n", -F.col("first"))).alias("dominant"))


def transcript(segments: DataFrame, longest: int = 2000) -> DataFrame:
    """Each episode as ``[SPEAKER MM:SS] text`` paragraphs, cut at ``longest`` characters."""
    line = F.concat(F.lit("["), F.upper("speaker"), F.lit(" "), T.clock(F.col("start_time")), F.lit("] "), F.col("text"))
    lines = F.transform(F.array_sort(F.collect_list(F.struct("segment_index", line.alias("line")))), lambda x: x["line"])
    return segments.groupBy("episode_id").agg(F.substring(F.array_join(lines, "\n\n"), 1, longest).alias("transcript"))


def feed_items(xml: DataFrame, most: int = 0) -> DataFrame:
    """Episodes of feeds (feed, xml): title, audio address (enclosure first, else a link to an audio file), identifier and duration; items without audio go.

    ``most`` keeps so many of each feed, in its order, of those with audio; 0 keeps all."""
    i = xml.select("feed", F.posexplode(F.regexp_extract_all("xml", F.lit(r"(?s)(<item>.*?</item>)"), F.lit(1))).alias("pos", "item"))
    get = lambda path: F.xpath_string("item", F.lit(path))
    audio = F.coalesce(F.nullif(get("item/enclosure[starts-with(@type,'audio')]/@url"), F.lit("")), F.when(get("item/link").rlike(r"(?i)\.(mp3|m4a|wav|ogg|aac|opus)$"), get("item/link")))
    d = i.select("feed", "pos", get("item/title").alias("title"), audio.alias("audio"), F.substring(F.sha2(F.coalesce(F.nullif(get("item/guid"), F.lit("")), F.concat_ws("_", get("item/title"), get("item/link"))), 256), 1, 32).alias("episode_id"), T.duration_seconds(get("item/duration")).alias("seconds"))
    d = d.where("audio is not null")
    if most:
        d = d.withColumn("_rn", F.row_number().over(W.partitionBy("feed").orderBy("pos"))).where(F.col("_rn") <= most).drop("_rn")
    return d.drop("pos")


def feed_record(feeds: DataFrame) -> DataFrame:
    """(feed, title, description, language) of feeds (feed, name, xml); a feed without a title takes the name it is configured under."""
    get = lambda path: F.nullif(F.trim(F.xpath_string("xml", F.lit(path))), F.lit(""))
    return feeds.select("feed", F.coalesce(get("//channel/title"), "name").alias("title"), F.coalesce(get("//channel/description"), F.lit("")).alias("description"), get("//channel/language").alias("language"))


__all__ = ["align", "occurrences"]
