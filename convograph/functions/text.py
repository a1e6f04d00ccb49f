"""Text functions as Column expressions; all run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from convograph.functions import lexicons as L


def words(text: Column) -> Column:
    """Runs of non-blanks."""
    return F.filter(F.split(text, r"\s+", -1), lambda w: w != "")


def flat(text: Column) -> Column:
    """One blank between words, none at the ends."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def plain(text: Column) -> Column:
    """Characters beyond ASCII as ``_``, so that word boundaries of ASCII patterns fall where Unicode ones do."""
    return F.regexp_replace(text, r"[^\x00-\x7F]", "_")


def alpha_tokens(text: Column) -> Column:
    """Whole lower-case words of a to z."""
    return F.regexp_extract_all(plain(F.lower(text)), F.lit(r"\b[a-z]+\b"), F.lit(0))


def has_any(text: Column, phrases: list[str]) -> Column:
    out = F.lit(False)
    for p in phrases:
        out = out | F.contains(text, F.lit(p))
    return out


def how_many(text: Column, phrases: list[str]) -> Column:
    """How many of the phrases occur at all."""
    return sum((F.contains(text, F.lit(p)).cast("int") for p in phrases), F.lit(0))


def first_of(text: Column, phrases: list[str]) -> Column:
    """The first phrase of the list that occurs, or null."""
    return F.coalesce(*[F.when(F.contains(text, F.lit(p)), F.lit(p)) for p in phrases])


def matches(text: Column, pattern: str) -> Column:
    """How often a pattern occurs, in any case."""
    return F.regexp_count(text, F.lit(f"(?i){pattern}"))


def total(text: Column, patterns) -> Column:
    return sum((matches(text, p) for p in (patterns.values() if isinstance(patterns, dict) else patterns)), F.lit(0))


def sentences(text: Column, least: int = 1) -> Column:
    return F.filter(F.transform(F.split(text, r"[.!?]+", -1), lambda s: F.trim(F.regexp_replace(s, r"^\s+|\s+$", ""))), lambda s: F.length(s) >= least)


def mean_length(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(0), lambda a, w: a + F.length(w)) / F.size(parts)


def ratio(a: Column, b: Column, default: float = 0.0) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(default))


def syllables(word: Column) -> Column:
    """Groups of vowels, less a silent e, one at least."""
    n = F.regexp_count(word, F.lit("[aeiouy]+"))
    return F.greatest(F.lit(1), n - (F.endswith(word, F.lit("e")) & (n > 1)).cast("int"))


def syllables_spoken(word: Column) -> Column:
    """Syllables of a word as it stands in text: one if it is short; y is no vowel."""
    w = F.regexp_replace(word, r'^[.,!?;:"]+|[.,!?;:"]+$', "")
    n = F.regexp_count(w, F.lit("[aeiouAEIOU]+"))
    return F.when(F.length(w) <= 3, 1).otherwise(F.greatest(F.lit(1), n - (F.endswith(w, F.lit("e")) & (n > 1)).cast("int")))


def summed(parts: Column, f) -> Column:
    return F.aggregate(parts, F.lit(0), lambda a, w: a + f(w))


def windowed_diversity(tokens: Column, window: int = 50, stride: int = 10) -> Column:
    """Mean share of distinct tokens in windows, or of all tokens if they fit one."""
    n = F.size(tokens)
    starts = F.sequence(F.lit(1), n - window + 1, F.lit(stride))
    shares = F.transform(starts, lambda i: F.size(F.array_distinct(F.slice(tokens, i, window))) / F.lit(float(window)))
    return F.when(n > window, F.aggregate(shares, F.lit(0.0), lambda a, x: a + x) / F.size(shares)).when(n > 0, F.size(F.array_distinct(tokens)) / n).otherwise(F.lit(0.0))


def flesch(words_per_sentence: Column, syllables_per_word: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), 206.835 - 1.015 * words_per_sentence - 84.6 * syllables_per_word))


def sentiment(text: Column, positive: list[str] = L.POSITIVE, negative: list[str] = L.NEGATIVE) -> Column:
    """struct(positive_count, negative_count, score, polarity); the polarity is by the unrounded score."""
    tokens = F.regexp_extract_all(F.lower(text), F.lit(r"(?U)\b\w+\b"), F.lit(0))
    p = F.size(F.filter(tokens, lambda w: w.isin(positive)))
    n = F.size(F.filter(tokens, lambda w: w.isin(negative)))
    score = ratio((p - n).cast("double"), p + n)
    return F.struct(p.alias("positive_count"), n.alias("negative_count"), score.alias("score"), F.when(score > 0.1, "positive").when(score < -0.1, "negative").otherwise("neutral").alias("polarity"))


def is_advertisement(text: Column, markers: list[str] = L.AD_MARKERS) -> Column:
    return has_any(F.lower(text), markers)


def clean_segment(text: Column) -> Column:
    """One blank between words, no control characters, and without hesitations (each once, as they do not overlap)."""
    t = F.regexp_replace(flat(text), r"[\x00-\x1f\x7f-\x9f]", "")
    for um in (" um ", " uh ", " uhm ", " umm ", "  "):
        t = F.replace(t, F.lit(um), F.lit(" "))
    return F.trim(t)


def clean_quote(text: Column) -> Column:
    q = flat(text)
    q = F.when(F.startswith(q, F.lit('"')) | F.startswith(q, F.lit("'")), q).otherwise(F.concat(F.lit('"'), q, F.lit('"')))
    odd = (F.length(q) - F.length(F.replace(q, F.lit('"')))) % 2 != 0
    return F.when(F.coalesce(text, F.lit("")) == "", "").otherwise(F.when(odd, F.concat(F.replace(q, F.lit('"')), F.lit('"'))).otherwise(q))


def truncate(text: Column, most: int, suffix: str = "...") -> Column:
    """At most ``most`` characters, cut at the last blank that leaves room for the suffix."""
    head = F.substring(text, 1, most - len(suffix))
    at = F.length(head) - F.locate(" ", F.reverse(head))
    cut = F.when(F.contains(head, F.lit(" ")), F.substring(head, F.lit(1), at)).otherwise(head)
    return F.when(F.length(text) <= most, text).otherwise(F.concat(cut, F.lit(suffix)))


def keep_characters(text: Column, punctuation: bool = True) -> Column:
    return flat(F.regexp_replace(text, r"[^a-zA-Z0-9\s.,!?;:\-'\"()]" if punctuation else r"[^a-zA-Z0-9\s]", ""))


def urls(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"https?://(?:www\.)?[-a-zA-Z0-9@:%._\+~#=]{1,256}\.[a-zA-Z0-9()]{1,6}\b(?:[-a-zA-Z0-9()@:%_\+.~#?&/=]*)"), F.lit(0))


def emails(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(L.ENTITY_PATTERNS["email"]), F.lit(0))


def normalize_name(name: Column, suffixes: list[str] = L.NAME_SUFFIXES) -> Column:
    """Lower case, without company suffixes in order, with abbreviations written out."""
    def cut(name: Column, suffix: Column) -> Column:
        return F.when(F.endswith(name, suffix), F.trim(F.substring(name, F.lit(1), F.length(name) - F.length(suffix)))).otherwise(name)

    n = F.aggregate(F.array(*[F.lit(s) for s in suffixes]), F.lower(F.trim(name)), cut)
    for short, full in L.NAME_ABBREVIATIONS:
        n = F.replace(n, F.lit(short), F.lit(full))
    return flat(n)


def aliases(name: Column, description: Column) -> Column:
    """Other names in a description, by the alias patterns in order."""
    found = F.concat(*[F.regexp_extract_all(description, F.lit(f"(?i){p}"), F.lit(1)) for p in L.ALIAS_PATTERNS])
    return F.filter(F.transform(found, lambda a: F.trim(a)), lambda a: (a != "") & (F.lower(a) != F.lower(name)))


def quote_type(text: Column) -> Column:
    t, out = F.lower(text), F.lit("general")
    for kind, phrases in reversed(L.QUOTE_TYPES):
        out = F.when(has_any(t, phrases), F.lit(kind)).otherwise(out)
    return out


def looked_up(key: Column, values: dict, default) -> Column:
    out = F.lit(default)
    for k, v in values.items():
        out = F.when(key == k, F.lit(v)).otherwise(out)
    return out


def quote_importance(text: Column, confidence: Column, bonus: Column | None = None) -> Column:
    n = F.size(words(text))
    score = (F.lit(0.5) + looked_up(quote_type(text), L.QUOTE_SCORES, 0.0) + F.when(n.between(15, 30), 0.1).otherwise(0.0)) * confidence
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), score + (bonus if bonus is not None else F.lit(0.0))))


def duration_seconds(text: Column) -> Column:
    """H:M:S, M:S or S as seconds; null if it is neither."""
    p = F.transform(F.split(text, ":", -1), lambda x: F.try_to_number(F.trim(x), F.lit("999999")).cast("int"))
    n = F.size(p)
    return F.when(n == 3, F.get(p, F.lit(0)) * 3600 + F.get(p, F.lit(1)) * 60 + F.get(p, F.lit(2))).when(n == 2, F.get(p, F.lit(0)) * 60 + F.get(p, F.lit(1))).when(n == 1, F.get(p, F.lit(0)))


def clock(seconds: Column) -> Column:
    """MM:SS, with hours from one hour on."""
    s = F.floor(seconds).cast("long")
    h, m, r = F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    return F.when(h > 0, F.concat_ws(":", two(h), two(m), two(r))).otherwise(F.concat_ws(":", two(m), two(r)))


def relation_type(name: Column) -> Column:
    """Upper case with underscores, letters and digits only."""
    return F.regexp_replace(F.regexp_replace(F.upper(name), r"[ \-]", "_"), r"[^A-Z0-9_]", "")


def safe_path(path: Column) -> Column:
    p = F.regexp_replace(path, r'[<>:"|?*\x00-\x1f]', "")
    return F.regexp_replace(F.replace(p, F.lit("..")), r"^/+", "")


def id_format(i: Column) -> Column:
    return F.when(i.rlike("^[0-9a-f]{32}$"), "md5").when(i.rlike("^[0-9a-f]{64}$"), "sha256").when(i.rlike("^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"), "uuid").when(i.rlike("^[0-9]+$"), "numeric").otherwise("other")


def is_url(url: Column) -> Column:
    return F.coalesce(url.rlike(r"(?i)^https?://(?:(?:[A-Z0-9](?:[A-Z0-9-]{0,61}[A-Z0-9])?\.)+[A-Z]{2,6}\.?|localhost|\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})(?::\d+)?(?:/?|[/?]\S+)$"), F.lit(False))


def is_email(email: Column) -> Column:
    return F.coalesce(email.rlike(r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"), F.lit(False))


def first_json(response: Column) -> Column:
    """The JSON of a model's answer: fences off, the widest object first, else the widest array."""
    t = F.trim(F.regexp_replace(response, r"```(?:json)?", ""))
    obj = F.regexp_extract(t, r"(?s)(\{.*\})", 1)
    return F.when(obj != "", obj).otherwise(F.regexp_extract(t, r"(?s)(\[.*\])", 1))


def mended_json(json: Column) -> Column:
    """Common errors put right: trailing commas, single quotes, bare keys, Python constants."""
    j = F.regexp_replace(json, r",\s*([}\]])", "$1")
    j = F.replace(j, F.lit("'"), F.lit('"'))
    j = F.regexp_replace(j, r"([{,]\s*)([A-Za-z_]\w*)\s*:", '$1"$2":')
    for a, b in (("None", "null"), ("True", "true"), ("False", "false")):
        j = F.regexp_replace(j, rf"\b{a}\b", b)
    return j


def delay(attempt: Column, factor: float, strategy: str, most: float) -> Column:
    """Seconds to wait before an attempt (from 1): exponential, linear, constant or fibonacci."""
    if strategy == "exponential":
        d = F.pow(F.lit(float(factor)), attempt.cast("double") - 1)
    elif strategy == "linear":
        d = attempt * factor
    elif strategy == "constant":
        d = F.lit(float(factor))
    else:
        fib = F.aggregate(F.sequence(F.lit(1), attempt), F.struct(F.lit(0.0).alias("a"), F.lit(1.0).alias("b")), lambda s, _: F.struct(s["b"].alias("a"), (s["a"] + s["b"]).alias("b")))
        d = fib["a"] * factor
    return F.least(d.cast("double"), F.lit(float(most)))


def validated(text: Column) -> Column:
    """Text without blanks around it; null becomes empty, other types become text."""
    return F.coalesce(F.trim(text.cast("string")), F.lit(""))


def backed(some: Column, of: Column) -> Column:
    """0.5 and half the share of those that back something up; 0.5 where there are none."""
    return F.when(of > 0, F.least(F.lit(1.0), 0.5 + some / of * 0.5)).otherwise(F.lit(0.5))
