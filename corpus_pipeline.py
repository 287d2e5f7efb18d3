"""The corpus pipeline: five stages over documents, each one operator of estatespark.llm.

Every stage reads what its predecessor kept as a written table. All but the last return the
columns of documents; the last returns a row for each stored document (doc_id, start,
n_tokens, ids_crc32).
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estatespark.llm import decontam, mixing, neardup, tokenstore, toxicity
from estatespark.llm.common import cut, ship, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def clean_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the toxicity classifier rejects. It learns from the labels of
    all rows of ``labels`` whose documents came in."""
    ship(spark)
    model = toxicity.fit_frame(docs, table(spark, sf_dir, "labels"), F.lit(True))
    return toxicity.keep_clean(docs, model)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates (five-word shingles, 0.8)."""
    ship(spark)
    return neardup.keep_one(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item."""
    ship(spark)
    return decontam.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def weighted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixes the sources to their targets; a document taken twice comes as two rows."""
    return mixing.mixed_rows(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes the token ids of the mix and reads the files back."""
    ship(spark)
    return tokenstore.stored(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", clean_language),
    ("near_duplicates", one_of_each),
    ("decontamination", no_benchmark),
    ("mixing", weighted),
    ("token_files", token_files),
]

# A trained model, signatures and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = cut(docs, name)
    return docs
