"""Queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from pitlake.llm.common import shared_dir, table, written
from pitlake.llm.fingerprints import fingerprint_documents
from pitlake.llm.licenses import scan_licenses
from pitlake.llm.mixing import select_mixture
from pitlake.llm.near_texts import near_texts
from pitlake.llm.pieces import encode_documents
from pitlake.llm.pii import scan_documents
from pitlake.llm.sharding import shard_documents
from pitlake.llm.sql import ORACLES
from pitlake.llm.token_rollup import Ledger, changes, count_documents, later_copies, revisions
from pitlake.llm.toxicity import score_documents, train
from pitlake.llm.vectors import near_vectors


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much of every document goes into a mixture of four fifths of all tokens."""
    return select_mixture(table(spark, sf_dir, "documents"))


def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in every document."""
    return scan_licenses(table(spark, sf_dir, "documents"))


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return fingerprint_documents(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after three batches: all documents in, counts revised, later copies of equal texts out.

    The first batch is committed twice, which must not count it twice.
    """
    counted = written(count_documents(table(spark, sf_dir, "documents")), "counted")
    ledger = Ledger(spark, f"{shared_dir(spark)}/pitlake/ledger-{uuid.uuid4().hex}")
    for batch_id in ("1-load", "1-load"):
        ledger.commit(batch_id, changes(counted, 1))
    ledger.commit("2-revise", revisions(counted))
    ledger.commit("3-copies", changes(later_copies(counted), -1, "revised_words", "revised_tokens"))
    return ledger.totals()


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether they decode to its text."""
    return encode_documents(table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 15, counts at most one apart."""
    return shard_documents(table(spark, sf_dir, "documents"), n_shards=16, vnodes=64)


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links at cosine 0.93 among all embeddings of equal label."""
    return near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents at a shingle similarity of 0.85."""
    return near_texts(table(spark, sf_dir, "documents"), percent=85)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return scan_documents(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score for every document, learnt from the labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, train(docs, table(spark, sf_dir, "labels")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One query per operator, over its whole table."""
    return {
        "op1_mixing": op1_mixing,
        "op2_license_scans": op2_license_scans,
        "op3_document_fingerprints": op3_document_fingerprints,
        "op4_token_counts": op4_token_counts,
        "op5_sentencepiece": op5_sentencepiece,
        "op6_sharding": op6_sharding,
        "op7_embedding_near_dedup": op7_embedding_near_dedup,
        "op8_minhash_near_dedup": op8_minhash_near_dedup,
        "op9_pii": op9_pii,
        "op10_toxicity": op10_toxicity,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express."""
    return dict(ORACLES)
