"""Listing intervals of instruments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def active_on(lifecycle: DataFrame, day: str) -> DataFrame:
    """Instruments with ``list_date <= day < delist_date``; an open end lasts."""
    at = F.lit(day).cast("date")
    return lifecycle.where((F.col("list_date") <= at) & (F.col("delist_date").isNull() | (at < F.col("delist_date"))))


def will_delist_within(day: str, days: int) -> Column:
    """Whether the delisting lies 1 to ``days`` days ahead."""
    return F.coalesce(F.datediff("delist_date", F.lit(day).cast("date")).between(1, days), F.lit(False))


def survivors(rows: DataFrame, lifecycle: DataFrame, key: str, time: str) -> DataFrame:
    """Rows whose instrument is listed at their own time: an equi-join on the key, then the interval."""
    side = lifecycle.select(F.col(key).alias("_key"), "list_date", "delist_date")
    day = F.col(time).cast("date")
    hit = (F.col(key) == F.col("_key")) & (F.col("list_date") <= day) & (F.col("delist_date").isNull() | (day < F.col("delist_date")))
    return rows.join(side, hit, "left_semi")
