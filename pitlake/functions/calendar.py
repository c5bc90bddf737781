"""The exchange's sessions, by rule, and times measured in them."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: The exchange's zone and hours.
ZONE, OPEN, CLOSE, EARLY = ZoneInfo("America/New_York"), time(9, 30), time(16, 0), time(13, 0)


def _nth(year: int, month: int, weekday: int, n: int) -> date:
    first = date(year, month, 1)
    return first + timedelta((weekday - first.weekday()) % 7 + 7 * (n - 1))


def _easter(year: int) -> date:
    a, b, c = year % 19, year // 100, year % 100
    h = (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30
    k = (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7
    m = (a + 11 * h + 22 * k) // 451
    return date(year, (h + k - 7 * m + 114) // 31, (h + k - 7 * m + 114) % 31 + 1)


def holidays(year: int) -> set[date]:
    """Days without a session besides weekends."""

    def observed(day: date) -> date:
        return day + timedelta({5: -1, 6: 1}.get(day.weekday(), 0))

    last_monday = date(year, 5, 31) - timedelta(date(year, 5, 31).weekday())
    out = {_nth(year, 1, 0, 3), _nth(year, 2, 0, 3), _easter(year) - timedelta(2), last_monday, _nth(year, 9, 0, 1), _nth(year, 11, 3, 4)}
    out |= {observed(date(year, 7, 4)), observed(date(year, 12, 25))}
    if year >= 2022:
        out.add(observed(date(year, 6, 19)))
    new_year = date(year, 1, 1)
    if new_year.weekday() != 5:  # a Saturday's New Year is not made up for
        out.add(observed(new_year))
    return out


def early_closes(year: int) -> set[date]:
    """Sessions that end at 13:00."""
    days = {_nth(year, 11, 3, 4) + timedelta(1), date(year, 12, 24), date(year, 7, 3)}
    return {d for d in days if d.weekday() < 5 and d not in holidays(year)}


def session_rows(first: date, last: date) -> list[tuple[date, datetime, datetime, int, int]]:
    """(session, open, close, minutes before it, minutes up to its end), times zone-less in UTC."""
    out, day, before = [], first, 0
    while day <= last:
        if day.weekday() < 5 and day not in holidays(day.year):
            ends = EARLY if day in early_closes(day.year) else CLOSE
            opens, closes = (datetime.combine(day, t, ZONE).astimezone(ZoneInfo("UTC")).replace(tzinfo=None) for t in (OPEN, ends))
            minutes = int((closes - opens).total_seconds() // 60)
            out.append((day, opens, closes, before, before + minutes))
            before += minutes
        day += timedelta(1)
    return out


def sessions(spark: SparkSession, first: str, last: str) -> DataFrame:
    """The sessions of a span of days: some 250 rows a year."""
    rows = session_rows(date.fromisoformat(first), date.fromisoformat(last))
    return spark.createDataFrame(rows, "session date, open_utc timestamp_ntz, close_utc timestamp_ntz, minutes_before long, minutes_upto long")


def _minutes(a: Column, b: Column) -> Column:
    return F.timestamp_diff("MINUTE", a, b)


def with_market_clock(df: DataFrame, ts: str, calendar: DataFrame) -> DataFrame:
    """``df`` with is_open, market_minutes (since the calendar's start) and next_open for a zone-less UTC time.

    The calendar is small by construction, so the range join is broadcast. Times outside it
    get nulls.
    """
    following = calendar.select(F.col("open_utc").alias("_o"), F.col("close_utc").alias("_c"), F.col("minutes_before").alias("_m"))
    following = following.withColumn("_n", F.lead("_o").over(Window.partitionBy(F.lit(0)).orderBy("_o")))
    hit = (F.col(ts) >= F.col("_o")) & (F.col("_n").isNull() | (F.col(ts) < F.col("_n")))
    out = df.join(F.broadcast(following), hit, "left")
    is_open = F.col(ts) < F.col("_c")
    since = F.col("_m") + F.least(_minutes(F.col("_o"), F.col(ts)), _minutes(F.col("_o"), F.col("_c")))
    return out.withColumn("is_open", is_open).withColumn("market_minutes", since).withColumn("next_open", F.col("_n")).drop("_o", "_c", "_m", "_n")


def after_market_minutes(df: DataFrame, target: str, calendar: DataFrame, name: str = "due") -> DataFrame:
    """``df`` with the time at which the market clock reads ``target`` minutes; a full session means the next open."""
    side = calendar.select(F.col("open_utc").alias("_o"), F.col("minutes_before").alias("_a"), F.col("minutes_upto").alias("_b"))
    hit = (F.col(target) >= F.col("_a")) & (F.col(target) < F.col("_b"))
    out = df.join(F.broadcast(side), hit, "left")
    return out.withColumn(name, F.timestamp_add("MINUTE", F.col(target) - F.col("_a"), F.col("_o"))).drop("_o", "_a", "_b")


def publish_time(df: DataFrame, day: str, calendar: DataFrame, name: str = "ts_available", hour: int = 16) -> DataFrame:
    """``df`` with the time at which a vendor's file of a day is out: 16:00 UTC of the next session."""
    order = Window.partitionBy(F.lit(0)).orderBy("session")
    side = calendar.select(F.col("session").alias("_next"), F.coalesce(F.lag("session").over(order), F.lit("0001-01-01").cast("date")).alias("_from"))
    hit = (F.col(day) >= F.col("_from")) & (F.col(day) < F.col("_next"))
    out = df.join(F.broadcast(side), hit, "left")
    return out.withColumn(name, F.timestamp_add("HOUR", F.lit(hour), F.col("_next").cast("timestamp_ntz"))).drop("_next", "_from")


def label_availability(df: DataFrame, day: str, calendar: DataFrame, window: int, lag_seconds: int = 0, name: str = "ts_available") -> DataFrame:
    """``df`` with the close of the ``window``-th session from the label's day, plus a lag; null beyond the calendar."""
    nth = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("session"))
    numbered = calendar.select(F.col("session").alias("_s"), F.col("close_utc").alias("_c"), nth.alias("_n"))
    before = numbered.select(F.col("_s").alias("_a"), F.lead("_s").over(Window.partitionBy(F.lit(0)).orderBy("_s")).alias("_b"), F.col("_n").alias("_k"))
    inside = (F.col(day) >= F.col("_a")) & (F.col("_b").isNull() | (F.col(day) < F.col("_b")))
    out = df.join(F.broadcast(before), inside, "left").withColumn("_n", F.col("_k") + window)
    out = out.join(F.broadcast(numbered.select("_n", "_c")), "_n", "left")
    return out.withColumn(name, F.timestamp_add("SECOND", F.lit(lag_seconds), F.col("_c"))).drop("_a", "_b", "_k", "_n", "_c")
