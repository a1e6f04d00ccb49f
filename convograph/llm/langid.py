"""Language identification by mixture inference.

Each language has a smoothed distribution of hashed byte n-grams, learned from labelled texts.
Expectation-maximisation estimates a document's proportions of the languages, and the set of
languages is chosen by penalised likelihood: starting from the best single language, one more is
taken while the likelihood gains more than the penalty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convograph.llm.common import lean, ready, schema

BITS = 14
FOLD = np.array([32 if (b < 65 or 90 < b < 97 or 122 < b < 128) else b + 32 if b <= 90 else b for b in range(256)], dtype=np.uint32)


def grams(text: str, n: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of the folded bytes of a text, and how often each occurs."""
    x = FOLD[np.frombuffer(f" {text} ".encode("utf-8", "replace"), dtype=np.uint8)]
    x = x[np.concatenate(([True], (x[1:] != 32) | (x[:-1] != 32)))]
    if len(x) < n:
        return np.zeros(0, np.int64), np.zeros(0)
    h = np.zeros(len(x) - n + 1, dtype=np.uint32)
    for i in range(n):
        h = h * np.uint32(0x01000193) + x[i : len(x) - n + 1 + i]
    h *= np.uint32(0x9E3779B1)
    counts = np.bincount(h >> np.uint32(32 - BITS), minlength=1 << BITS)
    ids = np.flatnonzero(counts)
    return ids, counts[ids].astype(float)


def mixture(p: np.ndarray, c: np.ndarray, rounds: int = 12) -> tuple[np.ndarray, float]:
    """Proportions of the columns of ``p`` and the log-likelihood of counts ``c`` under them."""
    k = p.shape[1]
    w = np.full(k, 1.0 / k)
    total = c.sum()
    for _ in range(rounds if k > 1 else 0):
        new = w * (p.T @ (c / (p @ w))) / total
        done = np.abs(new - w).max() < 1e-4
        w = new
        if done:
            break
    return w, float(c @ np.log(p @ w))


class Model:
    """langs: names in order; logs: one row of log-probabilities for each."""

    def __init__(self, langs: list[str], logs: np.ndarray, penalty: float):
        self.langs, self.logs, self.penalty = langs, logs, penalty
        self.probs = np.ascontiguousarray(np.exp(logs).T)

    def infer(self, text: str | None) -> tuple[str, float, dict[str, float]]:
        """(language, its proportion, proportions of the chosen set)."""
        if not text or not self.langs or not any(map(str.isalpha, text)):
            return "und", 0.0, {}
        ids, c = grams(text)
        p = self.probs[ids]
        w, _ = mixture(p, c)
        order = sorted(range(len(self.langs)), key=lambda k: (-w[k], k))
        chosen, best, share = [order[0]], mixture(p[:, order[:1]], c)[1], np.ones(1)
        cost = self.penalty * np.log(c.sum() + 1)
        for k in order[1:]:
            if w[k] < 0.01:
                break
            v, fit = mixture(p[:, [*chosen, k]], c)
            if fit - best <= cost:
                break
            chosen, best, share = [*chosen, k], fit, v
        top = int(np.argmax(share))
        return self.langs[chosen[top]], float(min(1.0, share[top])), {self.langs[k]: float(s) for k, s in zip(chosen, share, strict=True)}


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = 1000, penalty: float = 2.0, smoothing: float = 0.5) -> Model:
    """Learns from rows with a label and a text that has a letter.

    ``per_language`` bounds the sample: a language with more rows gives a share of them, by the
    hash of the id, so that about so many whole texts are read of each.  What reaches the driver is one
    table of counts for each language."""
    ready(docs.sparkSession)
    labelled = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"), F.col(f"`{lang_col}`").cast("string").alias("_lang")).where("_lang is not null and _text is not null")
    share = {r[0]: min(1.0, per_language / r[1]) for r in labelled.groupBy("_lang").count().collect()}
    if not share:
        return Model([], np.zeros((0, 1 << BITS)), penalty)
    at_most = F.element_at(F.create_map(*[F.lit(x) for kv in share.items() for x in kv]), F.col("_lang"))
    sample = labelled.where(F.pmod(F.xxhash64("_id", F.lit("langid")), F.lit(1 << 30)) < at_most * (1 << 30)).select("_lang", "_text")

    def count(batches):
        tables: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids, c = grams(text)
                t = tables.setdefault(lang, np.zeros(1 << BITS))
                t[ids] += c
        for lang, t in tables.items():
            ids = np.flatnonzero(t)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(ids), pa.string()), pa.array(ids, pa.int32()), pa.array(t[ids], pa.float64())], names=["_lang", "_gram", "_n"])

    counts = sample.mapInArrow(lean(count), "_lang string, _gram int, _n double").groupBy("_lang", "_gram").agg(F.sum("_n")).toPandas()
    langs = sorted(share)
    n = np.zeros((len(langs), 1 << BITS))
    n[counts["_lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(dtype=int), counts["_gram"].to_numpy()] = counts.iloc[:, 2].to_numpy()
    n += smoothing
    return Model(langs, np.log(n / n.sum(axis=1, keepdims=True)), penalty)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, mixture) of each whole text.

    ``score`` is the proportion of the predicted language.  A null text, a text without a letter
    and any text under an empty model get ``und``, 0 and an empty mixture.  Rows are independent, so
    repeated rows and other columns do not matter.  The model is one table for each language."""
    spark = ready(docs.sparkSession)
    shared = spark.sparkContext.broadcast((model.langs, model.logs, model.penalty))

    def run(batches):
        m = Model(*shared.value)
        for batch in batches:
            found = [m.infer(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), pa.array([list(f[2].items()) for f in found], pa.map_(pa.string(), pa.float64()))], names=[id_col, "lang_pred", "score", "mixture"])

    two = docs.select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text_col}`").alias("_text"))
    return two.mapInArrow(lean(run), schema(id_col, two.schema[0].dataType, "lang_pred string, score double, mixture map<string,double>"))


def held_out(id_col: str = "doc_id", of: int = 5) -> Column:
    """True for documents whose crc32 of the id as text is divisible by ``of``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")) % of == 0
