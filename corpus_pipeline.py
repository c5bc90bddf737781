"""The corpus pipeline: five stages, each written as Parquet and read again as the next one's documents."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlake.llm.common import shared_dir, small_batches, table, written
from pitlake.llm.mixing import mixed_documents
from pitlake.llm.near_texts import near_texts
from pitlake.llm.pieces import encode_documents
from pitlake.llm.pii import redact_documents
from pitlake.llm.toxicity import drop_toxic, train


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic by a model learnt from the labelled rows that are not held out.

    Null and empty texts stay; rows that repeat are judged alike, by their text alone; an
    empty table gives an empty result. All columns stay as they are, whatever their names.
    """
    small_batches(spark)
    return drop_toxic(docs, train(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group at a shingle similarity of 0.8.

    A pair at 0.8 is missed with a probability of 5e-6 at most. Null, empty and blank texts
    have no near copies and all stay. Where doc_ids repeat or are null, rows and not doc_ids
    are compared: of a group the row with the smallest doc_id stays, one without a doc_id
    only where none has one; of rows that are alike any. All columns stay as they are.
    """
    small_batches(spark)
    unclear = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL")
    if unclear.limit(1).count():
        return _near_dedup_rows(docs)
    found = near_texts(docs, percent=80)
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias("gone")).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone["gone"], "left_anti").select(*[docs[f"`{c}`"] for c in docs.columns])


def _near_dedup_rows(docs: DataFrame) -> DataFrame:
    """The same with a number per row, which is written with the rows so that it stays theirs."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.monotonically_increasing_id().alias("number"))
    rows = written(rows, "numbered")
    found = near_texts(rows.select(F.col("number").alias("doc_id"), "row.text"), percent=80)
    found = found.select(F.col("doc_id").alias("number"), F.col("component_id").alias("group"))
    nodes = rows.select("number", F.col("row.doc_id").alias("doc_id")).join(found, "number")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "number"))
    chosen = nodes.groupBy("group").agg(first.alias("x")).select("x.number")
    return rows.join(chosen, "number", "left_semi").select("row.*")


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in them replaced by its kind.

    Null texts stay null, empty ones empty; every row stays, repeated or not, with all its
    columns; only ``text`` and ``n_chars`` change.
    """
    return redact_documents(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A mixture of four fifths of all tokens to target weights; a row per use of a document.

    Documents without tokens (null, empty or blank) are in no mixture. A null lang or source
    is a node of its own. Rows that repeat are used alike. An empty table gives an empty one.
    """
    return mixed_documents(docs, budget_share=0.8, epochs=4)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, round_trip of every row; null and empty texts have no ids, other columns are left out."""
    small_batches(spark)
    return encode_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("pii", pii),
    ("mixing", mixing),
    ("sentencepiece", sentencepiece),
]


def run(spark: SparkSession, sf_dir: str, root: str | None = None) -> DataFrame:
    """All stages over ``documents``.

    Each stage's result is a table under ``root``, a folder in the shared one by default. A
    run that failed goes on where it stopped if it is given the same ``root`` again: stages
    that finished (their folder holds a success marker) are read, not computed.
    """
    docs = table(spark, sf_dir, "documents")
    root = root or f"{shared_dir(spark)}/pitlake/pipeline-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for name, stage in STAGES:
        if not files.exists(path(f"{root}/{name}/_SUCCESS")):
            stage(spark, docs, sf_dir).write.mode("overwrite").parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return docs


#: Learnt weights, MinHash and piece ids are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None
