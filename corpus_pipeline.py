"""Corpus preparation: language ID, line dedup, SimHash near-dedup, decontamination, BPE.

Each stage takes the rows that the one before it kept.  All but the last return the columns of
``documents``, and columns beyond those pass through under whatever name.  An empty table stays empty in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from convograph.llm import bpe, jaccard, langid, linededup, simhash, wumanber
from convograph.llm.common import packed, ready, shared_folder, table
from convograph.llm.queries import tokenizer

#: A text of which no language has this share is rejected.
LEAST_SHARE = 0.3
#: Bits that fingerprints of near copies may differ in.
BITS = 4
#: Words of a shingle, and hundredths of their shingles that near copies have in common: fingerprints alone miss many such pairs.
WORDS, SHARE = 5, 80


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps rows whose text is in a learned language; texts that are null or have no letter go, as do those without a main language.

    Rows are judged one by one, so ties and repeated rows do not matter; texts are read whole."""
    ready(spark)
    model = langid.train(docs.where(~langid.held_out()))
    whole = docs.select(packed(docs, docs.columns).alias("_row"), F.col("text").alias("_t"))
    found = langid.identify(whole, model, id_col="_row", text_col="_t")
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SHARE)).select("_row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated lines out of the texts; no row goes.

    Of equal lines, and of lines of 20 characters or more within one edit, the earliest by id and line number stays; in rows of one id lines with
    one number leave each other alone.  A null text comes out empty."""
    ready(spark)
    kept = linededup.deduplicate(docs, keep=[c for c in docs.columns if c not in ("doc_id", "text")])
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each group that links connect: fingerprints that differ in at most ``BITS`` bits, and sets of
    ``WORDS``-word shingles of which ``SHARE`` hundredths of the union are common.

    Null and empty texts are one group; repeated rows of the smallest id all stay; a null id stays only in a group of null ids."""
    ready(spark)
    return simhash.first_of_each(docs, bits=BITS, also=jaccard.classes(docs, size=WORDS, share=SHARE))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops contaminated documents: those of which a twentieth of the words or more lie in windows of benchmark items.

    Rows are judged one by one, so repeated rows share their fate; null and empty texts are clean."""
    ready(spark)
    return wumanber.clean(docs, table(spark, sf_dir, "benchmark"))


def tokenization(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the text they decode to, one row for each row; a null text is empty."""
    ready(spark)
    return bpe.digests(bpe.round_trip(docs, tokenizer()))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("decontamination", decontamination),
    ("tokenization", tokenization),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            at = shared_folder(spark, f"pipeline-{name}")
            docs.write.parquet(at)
            docs = spark.read.parquet(at)
    return docs


#: Mixture inference and the transducer have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None
