"""A training corpus from ``documents``: five stages, each one of the operators of ``innkeeper.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that ``run`` writes as Parquet in
the shared checkpoint folder and reads back as the next stage's ``docs``.  All but the last return the columns
of ``documents``.  A stage works on all rows of its own input, also for the statistics it learns.

Defined results, for every stage: NULL and empty texts aren't toxic, hold no passage and no benchmark words, and encode to no
tokens; texts without any word have one fingerprint, so one of them stays; repeated rows are near duplicates of each other, and one stays; rows
with a NULL id are documents like others; ties of a group go to the smallest id; empty tables give an empty table of the stage's columns;
columns of ``documents`` beyond the five known ones are left out, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innkeeper.llm import bpe, decontaminate, simhash, substring_dedup, toxicity
from innkeeper.llm.common import crc_fold, materialise, read_table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator doesn't reject, learned from the labelled rows outside the
    held-out fifth."""
    labels = read_table(spark, sf_dir, "labels").where(crc_fold("doc_id", 5) != 0)
    model = toxicity.train(docs, labels, "doc_id", "text", "toxic")
    return toxicity.score(docs.select(*COLUMNS), model).where("predicted = 0").select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicate fingerprints: the one of the smallest id."""
    return simhash.drop_near_duplicates(docs.select(*COLUMNS), shingle=3, distance=2)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 50 words or more that an earlier document (or place) has; ``n_chars`` follows the text."""
    cut = substring_dedup.cut_repeats(docs.select(*COLUMNS), min_words=50, similarity=0.8)
    return cut.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window of 10 words."""
    return decontaminate.drop_contaminated(docs.select(*COLUMNS), read_table(spark, sf_dir, "benchmark"), width=10)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The corpus as token ids."""
    encoded = bpe.encode_documents(docs.select(*COLUMNS), public_tokenizers.path("word_bpe_49k.json"))
    return encoded.select("doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("benchmark_decontamination", drop_contaminated),
    ("bpe_encoding", encode),
]

#: SQL can't express the learned classifier, the fingerprints or the encoder: tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
