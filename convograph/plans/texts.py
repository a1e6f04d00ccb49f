"""Queries over single texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from convograph.functions import lexicons as L
from convograph.functions import text as T
from convograph.plans.base import Book, listed, n, quote, r6, sql_any, sql_how_many, sql_matches, sql_plain, sql_total, sql_words, table
from convograph.sources.adapters import spread

book = Book()
W = sql_words()
SENT = r"list_filter(list_transform(regexp_split_to_array(text, '[.!?]+'), lambda s: regexp_replace(s, '^\s+|\s+$', '', 'g')), lambda s: s <> '')"
TOK = rf"regexp_extract_all({sql_plain('lower(text)')}, '\b[a-z]+\b')"
SYL = "greatest(1, len(regexp_extract_all(w, '[aeiouy]+')) - CASE WHEN ends_with(w, 'e') AND len(regexp_extract_all(w, '[aeiouy]+')) > 1 THEN 1 ELSE 0 END)"


def docs(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "documents").select("doc_id", "text"))


@book.add(rf"""
WITH d AS (SELECT doc_id, text, {W} AS w, list_filter({SENT}, lambda s: length(s) > 10) AS s FROM documents)
SELECT doc_id, CAST(length(text) AS BIGINT) AS character_count, CAST(len(w) AS BIGINT) AS word_count, CAST(len(s) AS BIGINT) AS sentence_count,
  CASE WHEN len(w) > 0 THEN round(list_sum(list_transform(w, lambda x: length(x))) / len(w), 6) ELSE 0 END AS average_word_length,
  CASE WHEN len(s) > 0 THEN round(list_sum(list_transform(s, lambda x: len({sql_words('x')}))) / len(s), 6) ELSE 0 END AS average_sentence_length,
  CAST(len(list_distinct(list_transform(w, lambda x: lower(x)))) AS BIGINT) AS unique_word_count,
  CASE WHEN len(w) > 0 THEN round(len(list_distinct(list_transform(w, lambda x: lower(x)))) / len(w), 6) ELSE 0 END AS lexical_diversity
FROM d""")
def text_statistics(spark, sf):
    w, s = F.col("w"), F.col("s")
    unique = F.size(F.array_distinct(F.transform(w, F.lower)))
    d = docs(spark, sf).select("doc_id", "text", T.words(F.col("text")).alias("w"), T.sentences(F.col("text"), 11).alias("s"))
    return d.select(
        "doc_id", n(F.length("text")).alias("character_count"), n(F.size(w)).alias("word_count"), n(F.size(s)).alias("sentence_count"),
        r6(F.coalesce(F.when(F.size(w) > 0, T.mean_length(w)), F.lit(0.0))).alias("average_word_length"),
        r6(F.coalesce(F.when(F.size(s) > 0, T.summed(s, lambda x: F.size(T.words(x))) / F.size(s)), F.lit(0.0))).alias("average_sentence_length"),
        n(unique).alias("unique_word_count"), r6(T.ratio(unique.cast("double"), F.size(w))).alias("lexical_diversity"),
    )


@book.add(rf"""
WITH d AS (SELECT doc_id, text, trim(regexp_replace(text, '\s+', ' ', 'g')) AS f FROM documents),
e AS (SELECT doc_id, text, f, CASE WHEN f LIKE '"%' OR f LIKE '''%' THEN f ELSE '"' || f || '"' END AS q FROM d)
SELECT doc_id, sha256(trim(replace(replace(replace(replace(replace(regexp_replace(f, '[\x00-\x1f\x7f]|[\x{{80}}-\x{{9f}}]', '', 'g'), ' um ', ' '), ' uh ', ' '), ' uhm ', ' '), ' umm ', ' '), '  ', ' '))) AS cleaned,
  sha256(CASE WHEN text = '' THEN '' WHEN (length(q) - length(replace(q, '"', ''))) % 2 <> 0 THEN replace(q, '"', '') || '"' ELSE q END) AS quoted,
  sha256(trim(regexp_replace(regexp_replace(text, '[^a-zA-Z0-9\s.,!?;:\-''"()]', '', 'g'), '\s+', ' ', 'g'))) AS punctuated,
  sha256(trim(regexp_replace(regexp_replace(text, '[^a-zA-Z0-9\s]', '', 'g'), '\s+', ' ', 'g'))) AS bare,
  CASE WHEN length(text) <= 80 THEN text WHEN contains(text[:77], ' ') THEN text[: 77 - instr(reverse(text[:77]), ' ')] || '...' ELSE text[:77] || '...' END AS truncated, sha256(f) AS flat
FROM e""")
def cleaned_texts(spark, sf):
    return docs(spark, sf).select(
        "doc_id", F.sha2(T.clean_segment(F.col("text")), 256).alias("cleaned"), F.sha2(T.clean_quote(F.col("text")), 256).alias("quoted"), F.sha2(T.keep_characters(F.col("text")), 256).alias("punctuated"),
        F.sha2(T.keep_characters(F.col("text"), False), 256).alias("bare"), T.truncate(F.col("text"), 80).alias("truncated"), F.sha2(T.flat(F.col("text")), 256).alias("flat"),
    )


@book.add(rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+') AS w FROM documents),
c AS (SELECT doc_id, len(list_filter(w, lambda x: list_contains({listed(L.POSITIVE)}, x))) AS p, len(list_filter(w, lambda x: list_contains({listed(L.NEGATIVE)}, x))) AS g FROM d),
s AS (SELECT doc_id, p, g, CASE WHEN p + g > 0 THEN (p - g) / (p + g) ELSE 0.0 END AS score FROM c)
SELECT doc_id, CAST(p AS BIGINT) AS positive_count, CAST(g AS BIGINT) AS negative_count, round(score, 6) AS score, CASE WHEN score > 0.1 THEN 'positive' WHEN score < -0.1 THEN 'negative' ELSE 'neutral' END AS polarity FROM s""")
def sentiment_lexicon(spark, sf):
    s = F.col("s")
    return docs(spark, sf).select("doc_id", T.sentiment(F.col("text")).alias("s")).select("doc_id", n(s["positive_count"]).alias("positive_count"), n(s["negative_count"]).alias("negative_count"), r6(s["score"]).alias("score"), s["polarity"].alias("polarity"))


@book.add(rf"""SELECT doc_id, {sql_any('lower(text)', L.AD_MARKERS)} AS reference_ad, {sql_any('lower(text)', ['th the', 'en der', 'de la'])} AS test_ad FROM documents""")
def advertisement_flags(spark, sf):
    return docs(spark, sf).select("doc_id", T.is_advertisement(F.col("text")).alias("reference_ad"), T.is_advertisement(F.col("text"), ["th the", "en der", "de la"]).alias("test_ad"))


TECH = sorted({t for v in L.TECHNICAL_TERMS.values() for t in v})
TEST_TERMS = ["inthe", "thand", "edion", "tion", "that", "with", "from"]
VOCABULARY = rf"""d AS (SELECT doc_id, text, {TOK} AS w FROM documents),
v AS (SELECT doc_id, text, w, len(w) AS total, len(list_distinct(w)) AS uniq, len(list_filter(w, lambda x: list_contains({listed(TECH + TEST_TERMS)}, x))) AS tech,
  coalesce(list_sum(list_transform(w, lambda w: length(w))), 0) AS chars, coalesce(list_sum(list_transform(w, lambda w: {SYL})), 0) AS syl,
  CASE WHEN len(w) > 50 THEN list_avg(list_transform(range(1, len(w) - 48, 10), lambda i: len(list_distinct(w[i : i + 49])) / 50.0)) WHEN len(w) > 0 THEN len(list_distinct(w)) / len(w) ELSE 0.0 END AS mattr FROM d)"""


def vocabulary(d: DataFrame) -> DataFrame:
    """Adds tokens and the vocabulary metrics of a text."""
    d = d.withColumn("w", T.alpha_tokens(F.col("text")))
    w = F.col("w")
    return d.withColumns({
        "total": F.size(w), "uniq": F.size(F.array_distinct(w)), "tech": F.size(F.filter(w, lambda x: x.isin(TECH + TEST_TERMS))),
        "chars": T.summed(w, F.length), "syl": T.summed(w, T.syllables), "mattr": T.windowed_diversity(w),
    })


@book.add(f"""WITH {VOCABULARY}
SELECT doc_id, CAST(uniq AS BIGINT) AS unique_words, CAST(total AS BIGINT) AS total_words, CASE WHEN total > 0 THEN round(uniq / total, 6) ELSE 0 END AS richness, CASE WHEN total > 0 THEN round(chars / total, 6) ELSE 0 END AS avg_word_length,
 CAST(tech AS BIGINT) AS technical_terms, CASE WHEN total > 0 THEN round(tech / total, 6) ELSE 0 END AS technical_density, CASE WHEN total > 0 THEN round(least(1.0, syl / total / 3.0), 6) ELSE 0 END AS syllable_complexity, round(mattr, 6) AS lexical_diversity FROM v""")
def vocabulary_complexity(spark, sf):
    t = F.col("total")
    d = lambda c: T.ratio(F.col(c).cast("double"), t)
    return vocabulary(docs(spark, sf)).select(
        "doc_id", n(F.col("uniq")).alias("unique_words"), n(t).alias("total_words"), r6(d("uniq")).alias("richness"), r6(d("chars")).alias("avg_word_length"), n(F.col("tech")).alias("technical_terms"),
        r6(d("tech")).alias("technical_density"), r6(F.least(F.lit(1.0), d("syl") / 3)).alias("syllable_complexity"), r6(F.col("mattr")).alias("lexical_diversity"),
    )


#: Names that stand for technical entities where no entities are given.
TECHNICAL_NAMES = ["tion", "ment", "lich", "eaux", "ción"]
COMPLEXITY = rf"""{VOCABULARY},
s AS (SELECT *, len({SENT}) AS ns, coalesce(list_avg(list_filter(list_transform({SENT}, lambda s: len(regexp_extract_all(s, '[\p{{L}}\p{{N}}_]+'))), lambda x: x > 0)), 0) AS asl FROM v),
r AS (SELECT *, CASE WHEN ns > 0 AND total > 0 THEN greatest(0, least(100, 206.835 - 1.015 * (total / ns) - 84.6 * (least(1.0, syl / total / 3.0) * 3))) ELSE 50 END AS readability FROM s),
c AS (SELECT *, least(100, greatest(0, CASE WHEN total > 0 THEN tech / total ELSE 0 END * 100 * 0.25 + least(asl / 30 * 100, 100) * 0.20 + mattr * 100 * 0.15 + (100 - readability) * 0.20 + CASE WHEN total > 0 THEN least(1.0, syl / total / 3.0) ELSE 0 END * 100 * 0.10 + least({sql_how_many('lower(text)', TECHNICAL_NAMES)} * 10, 100) * 0.10)) AS score FROM r)"""


def complexity(d: DataFrame, technical_entities: Column | None = None) -> DataFrame:
    """Adds sentence measures, readability (Flesch) and the complexity score of a text; ``technical_entities`` is how many it mentions."""
    technical = T.how_many(F.lower("text"), TECHNICAL_NAMES) if technical_entities is None else technical_entities
    v = vocabulary(d)
    t = F.col("total")
    d_ = lambda c: T.ratio(F.col(c).cast("double"), t)
    per = F.filter(F.transform(T.sentences(F.col("text")), lambda s: F.regexp_count(s, F.lit(r"(?U)\b\w+\b"))), lambda x: x > 0)
    s = v.withColumns({"ns": F.size(T.sentences(F.col("text"))), "per": per})
    s = s.withColumn("asl", F.when(F.size("per") > 0, F.aggregate("per", F.lit(0), lambda a, x: a + x) / F.size("per")).otherwise(F.lit(0.0)))
    syl = F.least(F.lit(1.0), d_("syl") / 3)
    s = s.withColumn("readability", F.when((F.col("ns") > 0) & (t > 0), T.flesch(t / F.col("ns"), syl * 3)).otherwise(F.lit(50.0)))
    score = d_("tech") * 25 + F.least(F.col("asl") / 30 * 100, F.lit(100.0)) * 0.2 + F.col("mattr") * 15 + (100 - F.col("readability")) * 0.2 + syl * 10 + F.least(technical * 10, F.lit(100)) * 0.1
    s = s.withColumn("score", F.least(F.lit(100.0), F.greatest(F.lit(0.0), score)))
    return s.withColumn("level", F.when(F.col("score") < 30, "simple").when(F.col("score") < 50, "moderate").when(F.col("score") < 70, "complex").otherwise("very_complex"))


LEVEL = "CASE WHEN score < 30 THEN 'simple' WHEN score < 50 THEN 'moderate' WHEN score < 70 THEN 'complex' ELSE 'very_complex' END"


@book.add(f"""WITH {COMPLEXITY} SELECT doc_id, CAST(ns AS BIGINT) AS sentences, round(asl, 6) AS avg_sentence_length, round(readability, 6) AS readability, round(score, 6) AS score, {LEVEL} AS level FROM c""")
def segment_complexity(spark, sf):
    return complexity(docs(spark, sf)).select("doc_id", n(F.col("ns")).alias("sentences"), r6(F.col("asl")).alias("avg_sentence_length"), r6(F.col("readability")).alias("readability"), r6(F.col("score")).alias("score"), "level")


#: Words by which sentences of a text count as insights, explanations, quotes and quotes in context, where none are given.
INSIGHT_MARKS, EXPLANATION_MARKS, QUOTE_MARKS, CONTEXT_MARKS = [" the", " de", " und"], ["tion", "ung", "ment"], [" and ", " que ", " et "], ["er ", "es "]


@book.add(f"""WITH {COMPLEXITY}, p AS (SELECT *, CASE WHEN asl > 20 THEN greatest(0.3, 1 - (asl - 20) / 30) ELSE 1.0 END AS pen, {sql_how_many('lower(text)', INSIGHT_MARKS)} AS ni, {sql_how_many('lower(text)', EXPLANATION_MARKS)} AS ne, {sql_how_many('lower(text)', QUOTE_MARKS)} AS nq, {sql_how_many('lower(text)', CONTEXT_MARKS)} AS nc FROM c),
q AS (SELECT *, CASE WHEN ni > 0 THEN least(1.0, 0.5 + least(ne, ni) / ni * 0.5) ELSE 0.5 END AS explained, CASE WHEN nq > 0 THEN least(1.0, 0.5 + least(nc, nq) / nq * 0.5) ELSE 0.5 END AS context FROM p)
SELECT doc_id, round(least(1.0, greatest(0.0, readability / 100 * 0.3 + explained * 0.25 + context * 0.15 + (1 - CASE WHEN total > 0 THEN tech / total ELSE 0 END) * 0.2 + pen * 0.1)), 6) AS accessibility, round(explained, 6)::DOUBLE AS explanation_quality, round(context, 6)::DOUBLE AS context_availability, round(1 - pen, 6) AS sentence_complexity FROM q""")
def accessibility_score(spark, sf):
    """Insights and quotes are counted by words that the texts have, as these tables hold none."""
    low = F.lower("text")
    ni, nq = T.how_many(low, INSIGHT_MARKS), T.how_many(low, QUOTE_MARKS)
    explained, context = T.backed(F.least(T.how_many(low, EXPLANATION_MARKS), ni), ni), T.backed(F.least(T.how_many(low, CONTEXT_MARKS), nq), nq)
    pen = F.when(F.col("asl") > 20, F.greatest(F.lit(0.3), 1 - (F.col("asl") - 20) / 30)).otherwise(F.lit(1.0))
    c = complexity(docs(spark, sf)).withColumns({"explained": explained, "context": context})
    score = F.col("readability") / 100 * 0.3 + F.col("explained") * 0.25 + F.col("context") * 0.15 + (1 - T.ratio(F.col("tech").cast("double"), F.col("total"))) * 0.2 + pen * 0.1
    return c.select("doc_id", r6(F.least(F.lit(1.0), F.greatest(F.lit(0.0), score))).alias("accessibility"), r6(F.col("explained")).alias("explanation_quality"), r6(F.col("context")).alias("context_availability"), r6(1 - pen).alias("sentence_complexity"))


SPOKEN = r"""CASE WHEN length(regexp_replace(x, '^[.,!?;:"]+|[.,!?;:"]+$', '', 'g')) <= 3 THEN 1 ELSE greatest(1, len(regexp_extract_all(x, '[aeiouAEIOU]+')) - CASE WHEN ends_with(regexp_replace(x, '[.,!?;:"]+$', ''), 'e') AND len(regexp_extract_all(x, '[aeiouAEIOU]+')) > 1 THEN 1 ELSE 0 END) END"""
MEASURES = rf"""d AS (SELECT doc_id, text, {sql_plain()} AS p, {W} AS w, len({SENT}) AS ns FROM documents),
m AS (SELECT doc_id, p, w, len(w) AS nw, ns, {sql_total('p', L.JARGON_PATTERNS)} AS jargon, {sql_total('p', L.EXPLANATION_PATTERNS)} AS explained, coalesce(list_sum(list_transform(w, lambda x: {SPOKEN})), 0) AS syl,
  coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS chars, len(list_distinct(list_transform(w, lambda x: lower(x)))) AS uniq FROM d WHERE len(w) > 0),
k AS (SELECT *, chars / nw * 0.2 + (1 - uniq / nw) * 0.2 + syl / nw * 0.3 + jargon / nw * 100 * 0.3 AS cx FROM m)"""


def measures(d: DataFrame) -> DataFrame:
    """Adds the whole-word measures (texts without words go)."""
    p, w = F.col("p"), F.col("w")
    m = d.withColumns({"p": T.plain(F.col("text")), "w": T.words(F.col("text")), "ns": F.size(T.sentences(F.col("text")))}).where(F.size("w") > 0)
    m = m.withColumns({"nw": F.size(w), "jargon": T.total(p, L.JARGON_PATTERNS), "explained": T.total(p, L.EXPLANATION_PATTERNS), "syl": T.summed(w, T.syllables_spoken), "chars": T.summed(w, F.length), "uniq": F.size(F.array_distinct(F.transform(w, F.lower)))})
    x = lambda c: F.col(c) / F.col("nw")
    return m.withColumn("cx", x("chars") * 0.2 + (1 - x("uniq")) * 0.2 + x("syl") * 0.3 + x("jargon") * 100 * 0.3)


@book.add(f"""WITH {MEASURES} SELECT doc_id, round(cx, 6) AS complexity_score, round(jargon / nw, 6) AS technical_density, round(uniq / nw, 6) AS unique_ratio, round(syl / nw, 6) AS syllable_complexity,
CASE WHEN jargon / nw > 0.1 THEN 'expert' WHEN cx < 3 AND jargon / nw > 0.05 THEN 'intermediate' WHEN cx < 3 THEN 'layperson' WHEN cx < 5 THEN 'intermediate' ELSE 'expert' END AS classification FROM k""")
def metrics_complexity(spark, sf):
    d = F.col("jargon") / F.col("nw")
    kind = F.when(d > 0.1, "expert").when((F.col("cx") < 3) & (d > 0.05), "intermediate").when(F.col("cx") < 3, "layperson").when(F.col("cx") < 5, "intermediate").otherwise("expert")
    return measures(docs(spark, sf)).select("doc_id", r6(F.col("cx")).alias("complexity_score"), r6(d).alias("technical_density"), r6(F.col("uniq") / F.col("nw")).alias("unique_ratio"), r6(F.col("syl") / F.col("nw")).alias("syllable_complexity"), kind.alias("classification"))


@book.add(f"""WITH {MEASURES}, a AS (SELECT *, CASE WHEN jargon > 0 THEN explained / jargon * 100 ELSE 100.0 END AS eq, CASE WHEN ns > 0 THEN greatest(0, least(100, 206.835 - 1.015 * (nw / ns) - 84.6 * (syl / nw))) ELSE 0 END AS rd FROM k)
SELECT doc_id, CASE WHEN ns > 0 THEN round(((100 - cx * 10) * 0.3 + rd * 0.3 + least(100, eq) * 0.2 + (100 - least(100, jargon / nw * 100 * 10)) * 0.2) / 100, 6) ELSE 0 END AS accessibility, round(jargon / nw * 100, 6) AS jargon_percentage,
round(eq / 100, 6) AS explanation_quality, round(rd / 100, 6) AS readability FROM a""")
def metrics_accessibility(spark, sf):
    m = measures(docs(spark, sf)).withColumns({
        "eq": F.when(F.col("jargon") > 0, F.col("explained") / F.col("jargon") * 100).otherwise(F.lit(100.0)),
        "rd": F.when(F.col("ns") > 0, T.flesch(F.col("nw") / F.col("ns"), F.col("syl") / F.col("nw"))).otherwise(F.lit(0.0)),
    })
    share = F.col("jargon") / F.col("nw") * 100
    a = ((100 - F.col("cx") * 10) * 0.3 + F.col("rd") * 0.3 + F.least(F.lit(100.0), F.col("eq")) * 0.2 + (100 - F.least(F.lit(100.0), share * 10)) * 0.2) / 100
    return m.select("doc_id", r6(F.when(F.col("ns") > 0, a).otherwise(0.0)).alias("accessibility"), r6(share).alias("jargon_percentage"), r6(F.col("eq") / 100).alias("explanation_quality"), r6(F.col("rd") / 100).alias("readability"))


@book.add(rf"""WITH {MEASURES}, f AS (SELECT *, CAST(floor({sql_total('p', L.FACT_COUNT_PATTERNS)} + 0.5 * len(list_filter(regexp_split_to_array(p, '[.!?]+'), lambda s: regexp_matches(s, '\d')))) AS BIGINT) AS facts FROM k)
SELECT doc_id, CAST(nw AS BIGINT) AS word_count, facts AS fact_count, round(facts / nw * 100, 6) AS fact_density, round(explained / nw * 100, 6) AS insight_density, round(explained / nw * 100 * 0.4 + jargon / nw * 100 * 0.3 + facts / nw * 100 * 0.3, 6) AS information_score,
 round(nw / 150.0, 6) AS duration_minutes, round(explained / (nw / 150.0), 6) AS insights_per_minute FROM f""")
def information_density(spark, sf):
    """Explanations stand for insights and jargon for entities, as the table has neither."""
    m = measures(docs(spark, sf)).withColumn("facts", F.floor(T.total(F.col("p"), L.FACT_COUNT_PATTERNS) + 0.5 * F.size(F.filter(F.split("p", "[.!?]+", -1), lambda s: s.rlike(r"\d")))))
    per = lambda c: F.col(c) / F.col("nw") * 100
    return m.select("doc_id", n(F.col("nw")).alias("word_count"), n(F.col("facts")).alias("fact_count"), r6(per("facts")).alias("fact_density"), r6(per("explained")).alias("insight_density"), r6(per("explained") * 0.4 + per("jargon") * 0.3 + per("facts") * 0.3).alias("information_score"), r6(F.col("nw") / 150).alias("duration_minutes"), r6(F.col("explained") / (F.col("nw") / 150)).alias("insights_per_minute"))


FAMILIES = {"technical": L.TECHNICAL_PATTERNS, "fact": L.FACT_PATTERNS, "quote": L.QUOTE_PATTERNS, "entity": {k: v for k, v in L.ENTITY_PATTERNS.items() if k not in ("url", "person_name")}, **{f"domain_{d}": p for d, p in L.DOMAIN_PATTERNS.items()}}


@book.add("WITH d AS (SELECT " + sql_plain() + " AS p FROM documents) " + " UNION ALL ".join(f"SELECT {quote(f)} AS family, {quote(k)} AS pattern, CAST(sum({sql_matches('p', x)}) AS BIGINT) AS hits, CAST(count(*) FILTER (WHERE {sql_matches('p', x)} > 0) AS BIGINT) AS texts FROM d" for f, ps in FAMILIES.items() for k, x in ps.items()))
def pattern_counts(spark, sf):
    """The patterns of the library over the corpus, in one pass; in any case a name is any run of words, so names have a query of their own."""
    d = docs(spark, sf).select(T.plain(F.col("text")).alias("p"))
    each = [F.struct(F.lit(f).alias("family"), F.lit(k).alias("pattern"), T.matches(F.col("p"), x).alias("m")) for f, ps in FAMILIES.items() for k, x in ps.items()]
    return d.select(F.explode(F.array(*each)).alias("x")).groupBy("x.family", "x.pattern").agg(n(F.sum("x.m")).alias("hits"), n(F.count_if(F.col("x.m") > 0)).alias("texts"))


@book.add(f"WITH d AS (SELECT doc_id, {sql_plain()} AS p FROM documents) SELECT doc_id, CAST({sql_total('p', L.TECHNICAL_PATTERNS)} AS BIGINT) AS technical_terms, CAST({sql_total('p', L.FACT_PATTERNS)} AS BIGINT) AS facts, round(least(1.0, (" + " + ".join(f"CAST({sql_matches('p', x)} > 0 AS INT)" for x in L.QUOTE_PATTERNS.values()) + ") / (0.3 * 9)), 6) AS quotability FROM d")
def quotability(spark, sf):
    p = F.col("p")
    present = sum(((T.matches(p, x) > 0).cast("int") for x in L.QUOTE_PATTERNS.values()), F.lit(0))
    return docs(spark, sf).select("doc_id", T.plain(F.col("text")).alias("p")).select("doc_id", n(T.total(p, L.TECHNICAL_PATTERNS)).alias("technical_terms"), n(T.total(p, L.FACT_PATTERNS)).alias("facts"), r6(F.least(F.lit(1.0), present / (0.3 * 9))).alias("quotability"))


@book.add(f"SELECT doc_id, unnest(regexp_extract_all({sql_plain()}, {quote(L.ENTITY_PATTERNS['email'])})) AS email FROM documents")
def email_addresses(spark, sf):
    return docs(spark, sf).select("doc_id", F.explode(T.emails(T.plain(F.col("text")))).alias("email"))


@book.add(rf"""WITH g AS (SELECT doc_id, {sql_plain()} AS p FROM documents)
SELECT doc_id, CAST(i AS BIGINT) AS nth, m AS match FROM (SELECT doc_id, unnest(regexp_extract_all(p, '\b[A-Z][a-z]+(?:\s+[A-Z][a-z]+)+\b')) AS m, unnest(range(len(regexp_extract_all(p, '\b[A-Z][a-z]+(?:\s+[A-Z][a-z]+)+\b')))) AS i FROM g)""")
def person_names(spark, sf):
    found = F.regexp_extract_all(T.plain(F.col("text")), F.lit(L.ENTITY_PATTERNS["person_name"]), F.lit(0))
    return docs(spark, sf).select("doc_id", F.posexplode(found).alias("nth", "match")).select("doc_id", n(F.col("nth")).alias("nth"), "match")


@book.add(rf"SELECT doc_id, CAST(i AS BIGINT) AS nth, s AS sentence FROM (SELECT doc_id, unnest(list_filter({SENT}, lambda s: length(s) > 10)) AS s, unnest(range(len(list_filter({SENT}, lambda s: length(s) > 10)))) AS i FROM documents)")
def split_sentences(spark, sf):
    return docs(spark, sf).select("doc_id", F.posexplode(T.sentences(F.col("text"), 11)).alias("nth", "sentence")).select("doc_id", n(F.col("nth")).alias("nth"), "sentence")


STOP = listed(L.STOP_WORDS)


@book.add(rf"""
WITH s AS (SELECT doc_id, unnest(range(len(string_split(text, '.')))) AS sn, unnest(string_split(text, '.')) AS s FROM documents),
w AS (SELECT doc_id, sn, list_filter(regexp_split_to_array(regexp_replace(lower(s), '[^\p{{L}}\p{{N}}_\s-]', ' ', 'g'), '\s+'), lambda w: w <> '') AS w FROM s),
p AS (SELECT doc_id, sn, w, unnest(range(1, len(w))) AS i FROM w),
g AS (SELECT doc_id, sn, i, 2 AS k, w[i] || ' ' || w[i + 1] AS phrase FROM p WHERE NOT list_contains({STOP}, w[i]) AND NOT list_contains({STOP}, w[i + 1])
 UNION ALL SELECT doc_id, sn, i, 3, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FROM p WHERE i + 2 <= len(w) AND NOT list_contains({STOP}, w[i]) AND NOT list_contains({STOP}, w[i + 2])),
c AS (SELECT doc_id, phrase, count(*) AS n, min(sn * 10000000 + i * 10 + k) AS first FROM g GROUP BY doc_id, phrase)
SELECT doc_id, phrase, CAST(n AS BIGINT) AS uses, CAST(rank AS BIGINT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, first) AS rank FROM c) WHERE rank <= 10""")
def key_phrases(spark, sf):
    """The ten most frequent phrases of two and three words of each text, the earlier of equals first.

    Texts are dealt by their id before they fall into phrases, many times their size, so counts and ranks need no other shuffle."""
    from pyspark.sql import Window

    w, stop = F.col("w"), F.array(*[F.lit(x) for x in L.STOP_WORDS])
    s = table(spark, sf, "documents").select("doc_id", "text").repartition("doc_id").select("doc_id", F.posexplode(F.split("text", r"\.", -1)).alias("sn", "s"))
    s = s.select("doc_id", "sn", T.words(F.regexp_replace(F.lower("s"), r"[^\p{L}\p{N}_\s-]", " ")).alias("w")).where("size(w) > 1").withColumn("stop", F.transform("w", lambda x: F.array_contains(stop, x)))

    def phrase(i, size: int):
        ends = ~F.get("stop", i - 1) & ~F.get("stop", i + size - 2)
        said = F.concat_ws(" ", *[F.get(w, i - 1 + k) for k in range(size)])
        return F.when((i + size - 1 <= F.size(w)) & ends, F.struct(said.alias("phrase"), (F.col("sn").cast("long") * 10000000 + i * 10 + size).alias("at")))

    each = F.flatten(F.transform(F.sequence(F.lit(1), F.size(w) - 1), lambda i: F.array(phrase(i, 2), phrase(i, 3))))
    g = s.select("doc_id", F.explode(F.filter(each, lambda x: x.isNotNull())).alias("x"))
    c = g.groupBy("doc_id", "x.phrase").agg(F.count("*").alias("uses"), F.min("x.at").alias("first"))
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.desc("uses"), "first"))
    return c.withColumn("rank", rank).where("rank <= 10").select("doc_id", "phrase", "uses", n(F.col("rank")).alias("rank"))


def _names(spark, sf):
    parts = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.concat("c_name", F.when(F.col("c_custkey") % 5 == 0, ", Inc.").when(F.col("c_custkey") % 5 == 1, " & Co").when(F.col("c_custkey") % 5 == 2, " Corporation").when(F.col("c_custkey") % 5 == 3, " LLC").otherwise(" of the U.S.")).alias("name"))
    return parts


def _normal(x: str, suffixes) -> str:
    for s in suffixes:
        x = f"(SELECT CASE WHEN ends_with(y, {quote(s)}) THEN trim(y[: length(y) - {len(s)}]) ELSE y END FROM (SELECT {x} AS y))"
    for a, b in L.NAME_ABBREVIATIONS:
        x = f"replace({x}, {quote(a)}, {quote(b)})"
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


NAMES_SQL = "n AS (SELECT c_custkey AS k, c_name || CASE c_custkey % 5 WHEN 0 THEN ', Inc.' WHEN 1 THEN ' & Co' WHEN 2 THEN ' Corporation' WHEN 3 THEN ' LLC' ELSE ' of the U.S.' END AS name FROM customer)"


def _stepwise(suffixes: list[str]) -> str:
    steps, last = [NAMES_SQL, "s0 AS (SELECT k, lower(trim(name)) AS y FROM n)"], "s0"
    for i, s in enumerate(suffixes, 1):
        steps.append(f"s{i} AS (SELECT k, CASE WHEN ends_with(y, {quote(s)}) THEN trim(y[: length(y) - {len(s)}]) ELSE y END AS y FROM {last})")
        last = f"s{i}"
    x = "y"
    for a, b in L.NAME_ABBREVIATIONS:
        x = f"replace({x}, {quote(a)}, {quote(b)})"
    return "WITH " + ", ".join(steps) + rf" SELECT k AS c_custkey, trim(regexp_replace({x}, '\s+', ' ', 'g')) AS normalized FROM {last}"


@book.add(_stepwise(L.NAME_SUFFIXES))
def normalized_names(spark, sf):
    return _names(spark, sf).select(F.col("k").alias("c_custkey"), T.normalize_name(F.col("name")).alias("normalized"))


@book.add(_stepwise(L.NAME_SUFFIXES_SHORT))
def normalized_entity_names(spark, sf):
    return _names(spark, sf).select(F.col("k").alias("c_custkey"), T.normalize_name(F.col("name"), L.NAME_SUFFIXES_SHORT).alias("normalized"))


DESCRIBED = "p_name || ', also known as ' || p_brand || '. Formerly ' || p_type || ' (aka ' || upper(p_name) || ')'"


@book.add(rf"""WITH d AS (SELECT p_partkey, p_name, {DESCRIBED} AS t FROM part), a AS (SELECT p_partkey, p_name, unnest(list_concat(regexp_extract_all(t, '(?i)also known as ([^,\.]+)', 1), regexp_extract_all(t, '(?i)formerly ([^,\.]+)', 1), regexp_extract_all(t, '(?i)aka ([^,\.]+)', 1), regexp_extract_all(t, '\(([^)]+)\)', 1))) AS alias FROM d)
SELECT p_partkey, trim(alias) AS alias FROM a WHERE trim(alias) <> '' AND lower(trim(alias)) <> lower(p_name)""")
def described_aliases(spark, sf):
    d = F.concat(F.col("p_name"), F.lit(", also known as "), F.col("p_brand"), F.lit(". Formerly "), F.col("p_type"), F.lit(" (aka "), F.upper("p_name"), F.lit(")"))
    return table(spark, sf, "part").select("p_partkey", F.explode(T.aliases(F.col("p_name"), d)).alias("alias"))


TYPE = "CASE " + " ".join(f"WHEN {sql_any('t', ws)} THEN {quote(k)}" for k, ws in L.QUOTE_TYPES) + " ELSE 'general' END"


@book.add(rf"""WITH b AS (SELECT item_id, text, lower(text) AS t, len({W}) AS nw FROM benchmark), q AS (SELECT item_id, nw, {TYPE} AS kind FROM b)
SELECT item_id, kind AS quote_type, CAST(round(least(1.0, greatest(0.0, (0.5 + CASE kind WHEN 'insightful' THEN 0.2 WHEN 'controversial' THEN 0.15 WHEN 'factual' THEN 0.1 WHEN 'opinion' THEN 0.05 WHEN 'humorous' THEN 0.1 ELSE 0 END + CASE WHEN nw BETWEEN 15 AND 30 THEN 0.1 ELSE 0 END) * 0.9)), 6) AS DOUBLE) AS importance, round(nw / 150.0 * 60, 6) AS seconds FROM q""")
def quote_scores(spark, sf):
    return table(spark, sf, "benchmark").select("item_id", T.quote_type(F.col("text")).alias("quote_type"), r6(T.quote_importance(F.col("text"), F.lit(0.9))).alias("importance"), r6(F.size(T.words(F.col("text"))) / 150 * 60).alias("seconds"))


@book.add(r"""WITH e AS (SELECT event_id, CAST(floor(value) AS BIGINT) AS v FROM events), t AS (SELECT event_id, v, CASE event_id % 4 WHEN 0 THEN '01:' || lpad(CAST(v % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(event_id % 60 AS VARCHAR), 2, '0') WHEN 1 THEN CAST(v AS VARCHAR) || ':' || lpad(CAST(event_id % 60 AS VARCHAR), 2, '0') WHEN 2 THEN CAST(v AS VARCHAR) ELSE 'x' END AS s FROM e)
SELECT event_id, CAST(CASE event_id % 4 WHEN 0 THEN 3600 + (v % 60) * 60 + event_id % 60 WHEN 1 THEN v * 60 + event_id % 60 WHEN 2 THEN v END AS BIGINT) AS seconds, lpad(CAST(v * 37 % 7200 // 60 % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(v * 37 % 7200 % 60 AS VARCHAR), 2, '0') AS mmss, v * 37 % 7200 >= 3600 AS has_hours FROM t""")
def durations(spark, sf):
    v = F.col("value").cast("long")
    i = F.col("event_id")
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    s = F.when(i % 4 == 0, F.concat(F.lit("01:"), two(v % 60), F.lit(":"), two(i % 60))).when(i % 4 == 1, F.concat(v.cast("string"), F.lit(":"), two(i % 60))).when(i % 4 == 2, v.cast("string")).otherwise("x")
    clock = T.clock(v * 37 % 7200)
    return table(spark, sf, "events").select("event_id", n(T.duration_seconds(s)).alias("seconds"), F.right(clock, F.lit(5)).alias("mmss"), (F.length(clock) > 5).alias("has_hours"))


@book.add(r"""SELECT p_partkey, regexp_replace(regexp_replace(upper(p_type), '[ \-]', '_', 'g'), '[^A-Z0-9_]', '', 'g') AS relation, regexp_replace(replace(regexp_replace('/../' || p_name || ':' || p_brand || '?', '[<>:"|?*]', '', 'g'), '..', ''), '^/+', '') AS path,
CASE p_partkey % 4 WHEN 0 THEN 'md5' WHEN 1 THEN 'sha256' WHEN 2 THEN 'numeric' ELSE 'other' END AS id_format, lower(substr(sha256(p_name), 1, 32)) AS episode_id FROM part""")
def identifiers(spark, sf):
    k = F.col("p_partkey")
    ident = F.when(k % 4 == 0, F.md5("p_name")).when(k % 4 == 1, F.sha2("p_name", 256)).when(k % 4 == 2, k.cast("string")).otherwise(F.col("p_name"))
    path = F.concat(F.lit("/../"), F.col("p_name"), F.lit(":"), F.col("p_brand"), F.lit("?"))
    return table(spark, sf, "part").select("p_partkey", T.relation_type(F.col("p_type")).alias("relation"), T.safe_path(path).alias("path"), T.id_format(ident).alias("id_format"), F.substring(F.sha2("p_name", 256), 1, 32).alias("episode_id"))


@book.add(r"""SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, '{"k": null, "ok": true}' AS mended FROM events""")
def json_answers(spark, sf):
    wrapped = F.concat(F.lit("Here it is: ```json\n"), F.col("props"), F.lit("\n``` done"))
    broken = F.lit("{'k': None, ok: True,}")
    return table(spark, sf, "events").select("event_id", F.get_json_object(T.first_json(wrapped), "$.k").cast("long").alias("k"), T.mended_json(broken).alias("mended"))


@book.add("SELECT a AS attempt, CAST(least(pow(2.0, a - 1), 30) AS DOUBLE) AS exponential, CAST(least(a * 2.0, 30) AS DOUBLE) AS linear, 2.0::DOUBLE AS constant, CAST(least([1, 1, 2, 3, 5, 8, 13, 21][a] * 2, 30) AS DOUBLE) AS fibonacci FROM (SELECT unnest(range(1, 9)) AS a)")
def retry_delays(spark, sf):
    a = F.col("attempt").cast("int")
    return spark.range(1, 9).withColumnRenamed("id", "attempt").select("attempt", *[T.delay(a, 2.0, s, 30.0).alias(s) for s in ("exponential", "linear", "constant", "fibonacci")])


@book.add(r"""SELECT page_id, regexp_matches(url, '^https?://[^\s/]+\.[A-Za-z]{2,6}(/\S*)?$') AS valid_url, false AS valid_email, lower(regexp_extract(url, '^https?://([^/]+)', 1)) AS host FROM pages""")
def page_urls(spark, sf):
    return table(spark, sf, "pages").select("page_id", T.is_url(F.col("url")).alias("valid_url"), T.is_email(F.col("url")).alias("valid_email"), F.lower(F.regexp_extract("url", "^https?://([^/]+)", 1)).alias("host"))


QUERIES, SQL = book.queries, book.sql
__all__ = ["QUERIES", "SQL", "complexity", "sql_how_many"]
