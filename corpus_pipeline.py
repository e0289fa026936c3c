"""A corpus pipeline of five operators; each stage works on what the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wikicells.llm import bpe, minhash, mixture, secrets, toxicity
from wikicells.llm.scratch import release, settle

#: The columns of `documents`, which every stage but the last returns.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.7 stay. The scorer learns from those of `labels` that are not held out."""
    release(spark)
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.without_toxic(docs.select(*COLUMNS), model, threshold=0.7)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: five words, a similarity of 0.8."""
    release(spark)
    return minhash.one_of_each(docs.select(*COLUMNS), words=5, percent=80)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in their texts are replaced by a mark."""
    release(spark)
    hidden = secrets.redact(docs.select(*COLUMNS), threshold=0.5)
    return hidden.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents are taken until each source meets its target; one that is taken twice is there twice. Rows come in training order."""
    release(spark)
    return mixture.repeat_rows(docs.select(*COLUMNS), mixture.mix(docs, cut=False)).select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the token ids of every document, and of what they decode to."""
    release(spark)
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    digests = bpe.round_trip(docs, path, public_tokenizers.PATTERN)
    release(spark)  # the dictionary is made by now, the texts are encoded as the result is read
    return digests


STAGES = [
    ("toxicity", reject_toxic),
    ("minhash", drop_near_duplicates),
    ("secrets", hide_secrets),
    ("mixing", mix_sources),
    ("byte_bpe", tokenize),
]

#: Trained scores, lexed assignments and merges of bytes are not expressible in SQL; the tests compare
#: the stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each result settled as a table for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = settle(docs)
    return docs
