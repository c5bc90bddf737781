"""Ordered deduplication, compaction, promotion and upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in an explicit order; null keys are rows of their own key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth")


def earliest(df: DataFrame, key: str, time: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Compaction's rule: the row that arrived first stays; rows without a key all stay."""
    kept = keep_one(df.where(F.col(key).isNotNull()), [key], [F.col(time).asc_nulls_last(), *[F.col(c).asc() for c in tiebreak]])
    return kept.unionByName(df.where(F.col(key).isNull()))


def latest(df: DataFrame, key: str, time: str, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Promotion's rule: the row that arrived last stays."""
    return keep_one(df, [key], [F.col(time).desc_nulls_last(), *[F.col(c).desc() for c in tiebreak]])


def upsert(base: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``changes`` replace those of ``base`` with the same keys; columns missing on a side are null."""
    rest = base.join(changes.select(*keys).distinct(), list(keys), "left_anti")
    return rest.unionByName(changes, allowMissingColumns=True)


def unseen(rows: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not present yet."""
    return rows.join(present.select(key).distinct(), key, "left_anti")
