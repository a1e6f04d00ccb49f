"""Secret scanning with DataFrame functions only.

Three fixed patterns find assignments, access keys and long hexadecimal runs.  Beside them two
character Markov models, of random strings and of ordinary identifiers, are learned from
labelled samples; a run of key characters is reported when the log-likelihood ratio of the two
models, divided by the number of transitions, exceeds a threshold that is set on labelled samples held out of the models.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from convograph.llm.common import ready

# The patterns of the scan.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_HEAD = r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "markov")

RUN = r"[A-Za-z0-9+/_=-]{16,}"
FIRST, SIZE = 43, 80  # codes of '+' to 'z'
SPAN = "struct<at:int,kind:int,stop:int>"


def let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once, however often it is used there."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def running(values: Column, combine, none: Column) -> Column:
    """Sums (or maxima) of the values of an array up to each, by doubling: every pass combines each with the one 1, 2, 4, ... places before it.

    An array of n values takes n log2(n) steps; appending to a result would copy it for every value."""

    def double(x: Column, j: Column) -> Column:
        step = F.pow(F.lit(2), j).cast("int")
        return F.when(step < F.size(x), F.zip_with(x, F.concat(F.array_repeat(none, step), F.slice(x, 1, F.size(x) - step)), combine)).otherwise(x)

    return let(values, lambda v: F.aggregate(F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(v), F.lit(1)))).cast("int")), v, double))


def spans(text: Column, pattern: str, kind: int, guard: str | None = None, keep=None) -> Column:
    """Spans of all matches, code points with exclusive ends, from the lengths of matches and of what lies between them."""

    def measured(whole: Column) -> Column:
        return F.zip_with(F.slice(F.split(text, pattern, -1), 1, F.size(whole)), whole, lambda gap, hit: F.struct(F.length(gap) + F.length(hit), F.length(hit)))

    def placed(sizes: Column) -> Column:
        stops = running(F.transform(sizes, lambda x: x["col1"]), lambda a, b: a + b, F.lit(0))
        found = F.zip_with(stops, sizes, lambda stop, x: F.struct((stop - x["col2"]).alias("at"), F.lit(kind).alias("kind"), stop.alias("stop")).cast(SPAN))
        if keep is None:
            return found
        return F.transform(F.filter(F.zip_with(found, F.regexp_extract_all(text, F.lit(pattern), F.lit(2)), lambda s, v: F.struct(s.alias("s"), v.alias("v"))), lambda x: keep(x["v"])), lambda x: x["s"])

    scanned = let(let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), measured), placed)
    return F.when(text.rlike(guard or pattern), scanned).otherwise(F.array().cast(f"array<{SPAN}>"))


def apart(more: Column, base: Column) -> Column:
    """The spans of ``more``, with their values, that overlap none of ``base``: of those that start before a span stops, the farthest stop is not past its start."""
    marks = F.concat(F.transform(base, lambda b: F.struct(b["at"].alias("place"), F.lit(1).alias("own"), b["stop"].alias("reach"), b["at"].alias("at"), F.lit("").alias("value"))),
                     F.transform(more, lambda s: F.struct(s["stop"].alias("place"), F.lit(0).alias("own"), F.lit(0).alias("reach"), s["at"].alias("at"), s["value"].alias("value"))))

    def free(order: Column) -> Column:
        reach = running(F.transform(order, lambda x: x["reach"]), lambda a, b: F.greatest(a, b), F.lit(0))
        alone = F.filter(F.zip_with(order, reach, lambda x, r: F.struct(x.alias("x"), r.alias("r"))), lambda y: (y["x"]["own"] == 0) & (y["r"] <= y["x"]["at"]))
        return F.transform(alone, lambda y: F.struct(y["x"]["at"].alias("at"), y["x"]["place"].alias("stop"), y["x"]["value"].alias("value")))

    return let(F.sort_array(marks), free)


def base_spans(text: Column) -> Column:
    return F.concat(
        spans(text, ASSIGN, 0, ASSIGN_HEAD, lambda v: F.length(v) >= 6),
        spans(text, ACCESS, 1),
        spans(text, HEX, 2),
    )


def codes(token: Column) -> Column:
    return F.transform(F.split(token, "", -1), lambda c: F.ascii(c) - FIRST)


def samples(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", documents: int = 500, strings: int = 2000) -> DataFrame:
    """Labelled samples (token, random) of at most 200 characters, as one long run would outweigh all others.

    Ordinary ones come from the words of at most ``documents`` documents (those of the least id hashes), alone and joined as identifiers
    and paths are: with capitals, underscores, hyphens, slashes, acronyms and numbers; and from runs of each single character.
    Random ones are the secrets' values in those documents and ``strings`` generated strings of each of four alphabets.
    Without documents only generated samples are left; words are taken as often as they occur."""
    spark = ready(docs.sparkSession)
    two = docs.select(F.col(f"`{id_col}`").alias("_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))
    chosen = two.select("_id").orderBy(F.xxhash64("_id", F.lit("markov")), "_id").limit(documents).distinct()
    some = two.join(F.broadcast(chosen), "_id", "left_semi").checkpoint()  # few whole texts, which training and scoring read again
    words = F.filter(F.split("_text", r"[^A-Za-z]+", -1), lambda w: F.length(w) >= 3)
    after = lambda n: F.slice(words, n + 1, 1 << 30)

    def joined(x: Column) -> Column:
        a, b, c, d = (x[k] for k in "abcd")
        number = (F.crc32(a.cast("binary")) % 10000).cast("string")
        made = [
            F.concat_ws("_", a, b), F.concat_ws("_", F.lower(a), F.lower(b), F.lower(c)), F.upper(F.concat_ws("_", a, b, c)), F.upper(F.concat_ws("_", b, c, d, a)),
            F.concat(F.lower(a), F.initcap(b), F.initcap(c)), F.concat(*map(F.initcap, (a, b, c, d))), F.concat(F.upper(F.left(a, F.lit(3))), *map(F.initcap, (b, c, d))), F.concat(F.initcap(a), F.initcap(b), number),
            F.concat_ws("_", a, b, number), F.concat_ws("-", F.lower(a), F.lower(b), number), F.concat(F.lit("/"), F.lower(F.concat_ws("/", a, b, c))), F.concat_ws("/", F.lower(a), F.concat_ws("_", b, c)), F.concat_ws("+", a, b, c), F.concat(F.lower(a), F.lit("="), F.lower(b), number),
        ]
        return F.get(F.array(*made), (F.crc32(F.concat(b, a).cast("binary")) % len(made)).cast("int"))

    fours = F.arrays_zip(words.alias("a"), after(1).alias("b"), after(2).alias("c"), after(3).alias("d"))
    ordinary = some.select(F.explode(F.concat(words, F.transform(F.filter(fours, lambda x: x["d"].isNotNull()), joined))).alias("token"), F.lit(0).alias("random")).where("token is not null")
    found = some.select(F.explode(F.concat(F.regexp_extract_all("_text", F.lit(ASSIGN), F.lit(2)), F.regexp_extract_all("_text", F.lit(HEX), F.lit(0)))).alias("token"), F.lit(1).alias("random")).where("length(token) >= 6").select(F.translate("token", ".", "").alias("token"), "random")
    seed = F.sha2(F.col("id").cast("string"), 256)
    size = (F.col("id") % 25 + 16).cast("int")
    coded = F.base64(F.unhex(seed))
    made = spark.range(strings).select(F.explode(F.array(F.substring(seed, F.lit(1), size + 8), F.substring(coded, F.lit(1), size), F.concat(F.lit("AKIA"), F.upper(F.translate(F.left(coded, F.lit(24)), "+/=", "XYZ"))), F.lower(F.translate(F.substring(coded, F.lit(1), size), "+/=", "xyz")))).alias("token"), F.lit(1).alias("random"))
    runs = spark.range(64 * max(1, strings // 20)).select(F.expr("repeat(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-', cast(id % 67 as int) + 1, 1), cast(16 + id % 41 as int))").alias("token"), F.lit(0).alias("random"))
    return ordinary.unionByName(found).unionByName(made).unionByName(runs).where("length(token) <= 200")


class Model(NamedTuple):
    """ratios: log-likelihood ratios of character pairs, random over ordinary, SIZE x SIZE in one row; threshold: of the mean over a token's pairs;
    precision and recall at it on held-out samples, both labels weighted alike."""

    ratios: np.ndarray
    threshold: float
    precision: float
    recall: float


#: Class of each character: lower case, capitals, digits, others.
CLASS = np.array([0 if chr(c).islower() else 1 if chr(c).isupper() else 2 if chr(c).isdigit() else 3 for c in range(FIRST, FIRST + SIZE)])


def train(labelled: DataFrame, smoothing: float = 0.5, weight: float = 10.0) -> np.ndarray:
    """Log-likelihood ratios of character pairs.

    A model's transitions are interpolated with those of the characters' classes, which count ``weight`` times.
    Characters outside the alphabet count as its first one.  The counts that come to the driver are at most two for each pair.
    Without samples of a label that model is uniform."""
    c = F.transform(codes(F.col("token")), lambda x: F.when(x.between(0, SIZE - 1), x).otherwise(0))
    pair = F.zip_with(F.slice(c, 1, F.size(c) - 1), F.slice(c, 2, F.size(c) - 1), lambda a, b: a * SIZE + b)
    rows = labelled.where("length(token) > 1").select("random", F.explode(pair).alias("pair")).groupBy("random", "pair").count().collect()
    n = np.zeros((2, SIZE, SIZE))
    for r in rows:
        n[r[0], r[1] // SIZE, r[1] % SIZE] += r[2]
    one = np.eye(4)[CLASS]
    between = one.T @ (n + smoothing / SIZE) @ one
    single = n.sum(axis=1) + smoothing
    within = single / (single @ one)[:, CLASS]
    backed = (between / between.sum(axis=2, keepdims=True))[:, CLASS][:, :, CLASS] * within[:, None, :]
    n += weight * backed
    logs = np.log(n / n.sum(axis=2, keepdims=True))
    return (logs[1] - logs[0]).ravel()


def ratio(token: Column, ratios: np.ndarray) -> Column:
    """Mean log-likelihood ratio of the transitions of a token of key characters."""
    table, c = F.lit(ratios), codes(token)
    pairs = F.zip_with(F.slice(c, 1, F.size(c) - 1), F.slice(c, 2, F.size(c) - 1), lambda a, b: F.get(table, a * SIZE + b))
    return F.aggregate(pairs, F.lit(0.0), lambda acc, x: acc + x) / F.greatest(F.size(c) - 1, F.lit(1))


def fit(labelled: DataFrame, cost: float = 10.0, slack: float = 0.005) -> Model:
    """Trains on three quarters of the samples, by their checksum, and sets the threshold on the rest: of tokens as long as those that are scanned,
    the middle of the ratios at which the share of random ones found less ``cost`` times that of ordinary ones reported is within ``slack`` of its
    greatest, so that the margins on both sides are alike and no single sample decides.

    The scores come to the driver as counts by hundredths, not as samples.  Without held-out samples of both labels the threshold is 1."""
    held = F.crc32(F.col("token").cast("binary")) % 4 == 0
    ratios = train(labelled.where(~held))
    long = labelled.where(held & F.col("token").rlike(f"^{RUN}$"))
    rows = long.groupBy("random", F.round(ratio(F.col("token"), ratios), 2).alias("score")).count().collect()
    total = {k: sum(r[2] for r in rows if r[0] == k) for k in (0, 1)}
    if not total[0] or not total[1]:
        return Model(ratios, 1.0, 0.0, 0.0)
    tried, scores = [], sorted({r[1] for r in rows})
    for t, above in zip(scores, [*scores[1:], scores[-1]], strict=True):
        found, wrong = (sum(r[2] for r in rows if r[0] == k and r[1] > t) / total[k] for k in (1, 0))
        tried.append((found - cost * wrong, t, above, found, wrong))
    good = [x for x in tried if x[0] >= max(tried)[0] - slack]
    threshold = (good[0][1] + good[-1][2]) / 2
    found, wrong = (sum(r[2] for r in rows if r[0] == k and r[1] > threshold) / total[k] for k in (1, 0))
    return Model(ratios, threshold, found / max(found + wrong, 1e-12), found)


def scan(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans): arrays of (at, kind, stop) by start, then kind, as in ``KINDS``.

    ``base`` has the matches of the three patterns, leftmost and non-overlapping for each kind;
    ``spans`` adds the runs of 16 key characters or more that the models take for random and
    that overlap no base span.  Null and empty texts have no spans; each row is scanned by itself and whole, however long, so
    repeated rows, rows of one id and other columns do not matter and an empty table gives no rows."""
    ready(docs.sparkSession)
    two = docs.select(F.col(f"`{id_col}`").alias(id_col), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("_text"))
    first = two.select(id_col, "_text", base_spans(F.col("_text")).alias("_base"))
    # Runs bring their values along: to cut one out of a long text would walk through all that stands before it.
    runs = F.zip_with(spans(F.col("_text"), RUN, 3), F.regexp_extract_all("_text", F.lit(RUN), F.lit(0)), lambda s, v: F.struct(s["at"].alias("at"), s["stop"].alias("stop"), v.alias("value")))
    more = F.filter(apart(runs, F.col("_base")), lambda s: ratio(s["value"], model.ratios) > model.threshold)
    more = F.transform(more, lambda s: F.struct(s["at"].alias("at"), F.lit(3).alias("kind"), s["stop"].alias("stop")).cast(SPAN))
    return first.select(id_col, F.sort_array("_base").alias("base"), F.sort_array(F.concat("_base", more)).alias("spans"))


def listed(column: str) -> Column:
    """kind:start:end, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(column, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["at"].cast("string"), s["stop"].cast("string"))), ",")


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    def n(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(id_col, n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"), F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"), n(3).alias("n_markov"))


def scan_whole(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return scan(docs, fit(samples(docs)))
