"""Train and test splits that do not leak."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pitlake.functions.scalars import parse_duration

Fold = tuple[int, date, date, date, date]


def _days(text: str) -> timedelta:
    return timedelta(seconds=parse_duration(text))


def walk_forward(start: str, end: str, train: str, test: str, step: str, embargo: str = "0d", purge: str = "0d") -> list[Fold]:
    """Folds (number, train start, train end, test start, test end), ends exclusive, that fit before ``end``.

    ``purge`` ends training that much earlier, so that no label's window reaches the test.
    """
    folds, at, last = [], date.fromisoformat(start), date.fromisoformat(end)
    while at + _days(train) + _days(embargo) + _days(test) <= last:
        cut = at + _days(train)
        folds.append((len(folds), at, cut - _days(purge), cut + _days(embargo), cut + _days(embargo) + _days(test)))
        at += _days(step)
    return folds


def expanding(start: str, end: str, least: str, test: str, embargo: str = "0d") -> list[Fold]:
    """Folds whose training part always begins at ``start`` and grows by one test part each time."""
    folds, first, last = [], date.fromisoformat(start), date.fromisoformat(end)
    cut = first + _days(least)
    while cut + _days(embargo) + _days(test) <= last:
        folds.append((len(folds), first, cut, cut + _days(embargo), cut + _days(embargo) + _days(test)))
        cut += _days(test)
    return folds


def assign_folds(rows: DataFrame, day: str, folds: list[Fold]) -> DataFrame:
    """A row per fold that uses it, with ``fold`` and ``part``; folds are few, so the range join is broadcast."""
    table = rows.sparkSession.createDataFrame(folds, "fold bigint, _a date, _b date, _c date, _d date")
    at = F.col(day)
    train, test = (at >= F.col("_a")) & (at < F.col("_b")), (at >= F.col("_c")) & (at < F.col("_d"))
    return rows.join(F.broadcast(table), train | test).withColumn("part", F.when(train, "train").otherwise("test")).drop("_a", "_b", "_c", "_d")


def temporal_split(rows: DataFrame, day: str, split: str, purge_days: int = 0, embargo_days: int = 0) -> DataFrame:
    """``part``: train ends ``purge_days`` before the split, test begins ``embargo_days`` after it, between is purged."""
    at, cut = F.col(day), F.lit(split).cast("date")
    part = F.when(at < F.date_sub(cut, purge_days), "train").when(at >= F.date_add(cut, embargo_days), "test").otherwise("purged")
    return rows.withColumn("part", part)


def overlaps_holdout(fold: Fold, first: str, end: str) -> bool:
    """Whether a fold's training or test part reaches into ``[first, end)``."""
    a, b = date.fromisoformat(first), date.fromisoformat(end)
    return any(start < b and stop > a for start, stop in (fold[1:3], fold[3:5]))


def share_split(rows: DataFrame, order: Sequence[str], share: float = 0.8) -> DataFrame:
    """``part``: the first ``share`` of all rows in order is train, the others test.

    Rows are counted per value of the first column; only rows of the one value in which the
    cut lies are ranked, all others are decided by comparison.
    """
    first = order[0]
    counts = rows.groupBy(first).agg(F.count("*").alias("n"))
    running = Window.partitionBy(F.lit(0)).orderBy(F.col(first).asc_nulls_first())  # a row per distinct value
    counts = counts.select(first, "n", F.sum("n").over(running).alias("upto"), F.sum("n").over(Window.partitionBy(F.lit(0))).alias("total"))
    wanted = F.floor(F.col("total") * F.lit(float(share)))
    at = counts.where((F.col("upto") >= wanted) & (F.col("upto") - F.col("n") < wanted)).select(F.col(first).alias("at"), (wanted - F.col("upto") + F.col("n")).alias("rest")).first()
    if at is None:
        return rows.withColumn("part", F.lit("test"))
    cut = F.lit(at["at"]).cast(rows.schema[first].dataType)
    nth = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*order))
    edge = rows.where(F.col(first).eqNullSafe(cut)).withColumn("part", F.when(nth <= at["rest"], "train").otherwise("test"))
    before = F.col(first).isNull() | (F.col(first) < cut)
    rest = rows.where(~F.col(first).eqNullSafe(cut)).withColumn("part", F.when(before, "train").otherwise("test"))
    return edge.unionByName(rest)
