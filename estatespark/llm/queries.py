"""The registered queries of the corpus operators: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (clusters, decontam, fingerprints, langid, licenses, mixing, neardup, quotes, suffixes,
               tokenstore, toxicity, trie, warc)
from .common import ship, table

QueryFn = Callable[[SparkSession, str], DataFrame]


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bottom-k sketches of every document and of its edited text."""
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known licences that documents are, and those that their lines announce."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share 80 % of their two-word shingles."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), neardup.Params(shingle=2))


def op4_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written to range-coded files and read back."""
    return tokenstore.stored(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that occur in documents, up to the error budget."""
    return decontam.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_quotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message without its quotes, linked to what it answers, in reply order."""
    return quotes.in_reply_order(quotes.linked(table(spark, sf_dir, "conversations"), partial=True))


def op7_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three of four folds."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(_fold(4) == 2, F.lit(False))
    found = langid.predict(docs, langid.learn(docs, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written to WARC archives and read back."""
    return warc.archived(table(spark, sf_dir, "pages"))


def _fold(parts: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from four of five folds of the labels."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_frame(docs, table(spark, sf_dir, "labels"), F.coalesce(_fold(5) != 0, F.lit(False)))
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(_fold(5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, which open as the first of their group does."""
    return trie.shared_openings(table(spark, sf_dir, "conversations"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of all vectors around 40 centroids."""
    return clusters.with_inertia(*clusters.clustered(table(spark, sf_dir, "embeddings")))


def op13_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document by its repeats."""
    return suffixes.judged(suffixes.measured(table(spark, sf_dir, "documents"))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_QUERIES: tuple[QueryFn, ...] = (
    op1_fingerprints, op2_licenses, op3_near_duplicates, op4_token_store, op5_decontamination, op6_quotations,
    op7_languages, op8_warc, op9_toxicity, op10_mix, op11_prefix_trie, op12_centroids, op13_repetition)


def _shipped(query: QueryFn) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)
    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


def queries() -> dict[str, QueryFn]:
    return {q.__name__: _shipped(q) for q in _QUERIES}


def oracle_sql() -> dict[str, str]:
    """DuckDB's SQL for those that it can express; the others are held against brute force."""
    return {"op2_licenses": licenses.oracle_sql(), "op6_quotations": quotes.oracle_sql(),
            "op10_mix": mixing.oracle_sql(), "op11_prefix_trie": trie.oracle_sql(), "op12_centroids": clusters.oracle_sql(),
            "op13_repetition": suffixes.oracle_sql()}
