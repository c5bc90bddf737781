"""Daily rows out of intraday ones."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlake.operators.asof import micros


def arrival(time: str, sequence: str) -> Column:
    """One number that orders rows by time, then by a whole number: fixed-width, so a hash aggregate updates it in place."""
    return micros(time).cast("decimal(38,0)") * F.lit(Decimal(10**19)) + F.col(sequence).cast("decimal(19,0)")


def daily_bars(bars: DataFrame, key: str = "instrument_key", time: str = "ts_event", sequence: str = "seq", available: str | None = "ts_available") -> DataFrame:
    """First open, extremes, last close and vwap, sums per key and day; of equal times the sequence decides.

    ``available`` is the latest of the day's rows, where there is such a column. Rows
    without a key or a time are left out.
    """
    rows = bars.where(F.col(key).isNotNull() & F.col(time).isNotNull()).withColumn("_at", arrival(time, sequence).cast("decimal(38,0)"))
    more = [F.max(available).alias(available)] if available else []
    return rows.groupBy(key, F.col(time).cast("date").alias("day")).agg(
        F.min_by("open", "_at").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "_at").alias("close"),
        F.sum("volume").alias("volume"),
        F.max_by("vwap", "_at").alias("vwap"),
        F.count("*").alias("n_bars"),
        *more,
    )


def last_of_day(rows: DataFrame, columns: Sequence[str], key: str = "instrument_key", time: str = "ts_event", sequence: str = "seq") -> DataFrame:
    """The last value of each column per key and day, nulls skipped column by column."""
    rows = rows.where(F.col(key).isNotNull() & F.col(time).isNotNull()).withColumn("_at", arrival(time, sequence).cast("decimal(38,0)"))
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_at"))).alias(c) for c in columns]
    return rows.groupBy(key, F.col(time).cast("date").alias("day")).agg(*last)


def fill_days_native_first(bars: DataFrame, native: Column, key: str = "instrument_key", time: str = "ts_event", sequence: str = "seq") -> DataFrame:
    """key, day, close, origin: the native daily bar's close where a day has one, else the last intraday close."""
    rows = bars.withColumn("_at", arrival(time, sequence).cast("decimal(38,0)")).withColumn("_native", native)
    days = rows.groupBy(key, F.col(time).cast("date").alias("day")).agg(
        F.max_by("close", F.when(F.col("_native"), F.col("_at"))).alias("own"),
        F.max_by("close", F.when(~F.col("_native"), F.col("_at"))).alias("made"),
        F.count_if("_native").alias("n"),
    )
    some = F.col("n") > 0
    return days.select(key, "day", F.when(some, F.col("own")).otherwise(F.col("made")).alias("close"), F.when(some, "native").otherwise("resampled").alias("origin"))
