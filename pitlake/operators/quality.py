"""Quality checks as single aggregations."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, nulls, extremes, mean and deviation per column: one pass, then a row per column."""
    structs = [
        F.struct(
            F.lit(c).alias("column_name"), F.count(c).alias("n"), F.count_if(F.col(c).isNull()).alias("nulls"), F.min(c).cast("double").alias("low"),
            F.max(c).cast("double").alias("high"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("deviation"),
        )
        for c in columns
    ]
    return df.agg(F.array(*structs).alias("found")).select(F.inline("found"))


def invariants(df: DataFrame, rules: dict[str, tuple[Sequence[str], Column, float]]) -> DataFrame:
    """(invariant, status, rows, violations) of named rules; a rule lacking a column is ``not_run``.

    A rule is (columns, predicate that holds on good rows, tolerated share of violations).
    Nulls satisfy a predicate.
    """
    run = {n: r for n, r in rules.items() if all(c in df.columns for c in r[0])}
    parts = [
        F.struct(F.lit(n).alias("invariant"), F.count("*").alias("n_rows"), F.count_if(~F.coalesce(p, F.lit(True))).alias("violations"), F.lit(t).alias("tolerated"))
        for n, (_, p, t) in run.items()
    ]
    out = df.agg(F.array(*parts).alias("found")).select(F.inline("found"))
    status = F.when(F.col("violations") > F.col("tolerated") * F.col("n_rows"), "fail").otherwise("pass")
    out = out.select("invariant", status.alias("status"), "n_rows", "violations")
    absent = [n for n in rules if n not in run]
    if absent:
        missing = df.sparkSession.createDataFrame([(n, "not_run", None, None) for n in absent], "invariant string, status string, n_rows long, violations long")
        out = out.unionByName(missing)
    return out


#: Kinds of instruments, and per feed the columns that may not be negative, pairs of which the first may
#: not be below the second, shares of violations that are tolerated, and shares of nulls that are not complete any more.
KINDS = ("equity", "option", "crypto", "forex", "macro")
FEEDS = {
    "bars": {"positive": ("open", "high", "low", "close", "volume"), "ordered": {"high_ge_low": ("high", "low")}, "tolerated": {}, "complete": {"open": 0.01, "high": 0.01, "low": 0.01, "close": 0.01, "volume": 0.05}},
    "quotes": {"positive": ("bid_px", "ask_px", "bid_sz", "ask_sz"), "ordered": {"ask_ge_bid": ("ask_px", "bid_px")}, "tolerated": {"ask_ge_bid": 0.01}, "complete": {"bid_px": 0.0, "ask_px": 0.0, "bid_sz": 0.05, "ask_sz": 0.05}},
    "trades": {"positive": ("price", "size"), "ordered": {}, "tolerated": {}, "complete": {"price": 0.01, "size": 0.05}},
    "flow_alerts": {"positive": ("premium", "volume"), "ordered": {}, "tolerated": {}, "complete": {"premium": 0.05, "volume": 0.05}},
}


def feed_rules(df: DataFrame, feed: str, now: str) -> dict[str, tuple[Sequence[str], Column, float]]:
    """The eight rules that all feeds share, and the feed's own; ``now`` is when rows may be available at the latest."""
    kinds = {f.name: f.dataType.typeName() for f in df.schema}
    c, spec = F.col, FEEDS[feed]
    text = lambda n: kinds.get(n) == "string"
    present = lambda n: c(n).isNotNull() & (F.trim(c(n)) != "" if text(n) else F.lit(True))
    time = lambda n: c(n).try_cast("timestamp_ntz") if text(n) else c(n)
    number = lambda n: c(n).try_cast("double") if text(n) else c(n)
    rules: dict[str, tuple[Sequence[str], Column, float]] = {}
    for n in ("ts_event", "ts_available"):
        rules[f"{n}_parseable"] = ([n], time(n).isNotNull() | c(n).isNull(), 0.0)
    for n in ("event_id", "instrument_key", "ts_event", "ts_available"):
        rules[f"{n}_required"] = ([n], present(n), 0.0)
    rules["ts_available_ge_ts_event"] = (["ts_event", "ts_available"], time("ts_available") >= time("ts_event"), 0.0)
    rules["ts_available_not_future"] = (["ts_available"], time("ts_available") <= F.lit(now).cast(kinds.get("ts_available") if kinds.get("ts_available") in ("timestamp", "timestamp_ntz") else "timestamp_ntz"), 0.0)
    for n in spec["positive"]:
        good = number(n) >= 0
        rules[f"{n}_non_negative"] = ([n], F.coalesce(good, c(n).isNull()) if text(n) else good, 0.0)
    for name, (a, b) in spec["ordered"].items():
        rules[name] = ([a, b], number(a) >= number(b), spec["tolerated"].get(name, 0.0))
    if feed == "bars":
        rules["high_is_highest"] = (["high", "open", "close"], number("high") >= F.greatest(number("open"), number("close")), 0.0)
        rules["low_is_lowest"] = (["low", "open", "close"], number("low") <= F.least(number("open"), number("close")), 0.0)
        rules["instrument_type_allowed"] = (["instrument_type"], c("instrument_type").isin(*KINDS), 0.0)
    return rules


def feed_invariants(df: DataFrame, feed: str, now: str) -> DataFrame:
    """(invariant, status, n_rows, violations) of all rules of a feed and of the completeness of its columns, in one pass.

    A column is complete while its share of nulls is below its threshold (a threshold of 0 allows none).
    """
    rules = feed_rules(df, feed, now)
    complete = FEEDS[feed]["complete"]
    for n in complete:
        rules[f"{n}_complete"] = ([n], F.col(n).isNotNull(), 0.0)
    out = invariants(df, rules)
    least = F.lit(0.0)
    for n, share in complete.items():
        least = F.when(F.col("invariant") == f"{n}_complete", share).otherwise(least)
    thin = F.col("invariant").endswith("_complete") & (F.col("violations") < least * F.col("n_rows"))
    return out.withColumn("status", F.when(thin, "pass").otherwise(F.col("status")))


def null_rates(df: DataFrame, group: str, payload: Sequence[str], enrichment: Sequence[str], most_payload: float = 0.05, most_enrichment: float = 0.95) -> DataFrame:
    """(group, column_name, null_rate, failed): payload columns fail above one share of nulls, enrichment columns above another."""
    parts = [
        F.struct(F.lit(c).alias("column_name"), F.avg(F.col(c).isNull().cast("double")).alias("null_rate"), F.lit(most).alias("most"))
        for names, most in ((payload, most_payload), (enrichment, most_enrichment))
        for c in names
    ]
    out = df.groupBy(group).agg(F.array(*parts).alias("found")).select(group, F.inline("found"))
    return out.select(group, "column_name", "null_rate", (F.col("null_rate") > F.col("most")).alias("failed"))


def null_audit(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, nulls, percent) of the columns that hold nulls; expected columns that are missing are all null."""
    wanted = list(columns or df.columns)
    count = lambda c: F.count_if(F.col(c).isNull()) if c in df.columns else F.count("*")
    parts = [F.struct(F.lit(c).alias("column_name"), count(c).alias("nulls"), (count(c) * 100.0 / F.count("*")).alias("percent")) for c in wanted]
    return df.agg(F.array(*parts).alias("found")).select(F.inline("found")).where("nulls > 0")


def liveness(rows: DataFrame, feed: str, time: str, now: str, seconds: int, floor: int, session: tuple[int, int]) -> DataFrame:
    """(feed, at, n, status): rows of the last ``seconds`` against a floor; outside a weekday's session hours (UTC) a feed may be silent."""
    at = datetime.fromisoformat(now)
    kind = rows.schema[time].dataType.typeName()
    last, first = F.lit(now).cast(kind), F.lit(str(at - timedelta(seconds=seconds))).cast(kind)
    closed = at.weekday() > 4 or not session[0] <= at.hour < session[1]
    n = F.count_if((F.col(time) > first) & (F.col(time) <= last))
    out = rows.groupBy(feed).agg(n.alias("n"))
    status = F.lit("closed") if closed else F.when(F.col("n") >= floor, "alive").otherwise("silent")
    return out.select(feed, F.lit(now).alias("at"), "n", status.alias("status"))


def floors(rows: DataFrame, feed: str, time: str, ratio: float = 0.3) -> DataFrame:
    """(feed, day, floor): a share of the median hourly count of every day that the table spans, 1 at least; empty hours count as 0."""
    counts = rows.groupBy(feed, F.col(time).cast("date").alias("day"), F.hour(time).alias("hour")).agg(F.count("*").alias("n"))
    # A day's counts are 24 at most, so its median is taken from them and as many zeros as are missing.
    days = counts.groupBy(feed, "day").agg(F.sort_array(F.collect_list("n")).alias("found"))
    full = F.concat(F.array_repeat(F.lit(0).cast("long"), 24 - F.size("found")), F.col("found"))
    middle = days.withColumn("all", full).select(feed, "day", ((F.get("all", F.lit(11)) + F.get("all", F.lit(12))) / 2).alias("m"))
    span = counts.agg(F.min("day").alias("a"), F.max("day").alias("b"))
    wanted = counts.select(feed).distinct().join(F.broadcast(span)).select(feed, F.explode(F.sequence("a", "b")).alias("day"))  # one row
    out = wanted.join(middle, [feed, "day"], "left")
    return out.select(feed, F.col("day").cast("string").alias("day"), F.greatest(F.lit(1), F.floor(F.coalesce("m", F.lit(0.0)) * ratio)).cast("long").alias("floor"))


def missing_hours(days: DataFrame, rows: DataFrame, feed: str, time: str, first: int, last: int) -> DataFrame:
    """(feed, day, hour) of a session's hours in which a feed has no rows, on the given (feed, day)s."""
    wanted = days.select(feed, "day", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("hour"))
    have = rows.select(feed, F.col(time).cast("date").alias("day"), F.hour(time).alias("hour")).distinct()
    return wanted.join(have, [feed, "day", "hour"], "left_anti")


def error_summary(errors: DataFrame, identity: str, feed: str, message: str, time: str, top: int = 5, samples: int = 2) -> DataFrame:
    """Failed rows by feed and kind (a message up to its first colon) with times and samples, and the commonest messages.

    (part, feed, error, n, first_at, last_at, samples): part ``error`` has a row per feed
    and kind, part ``message`` one for each of the ``top`` messages. One pre-aggregation by
    message serves both; a message keeps its ``samples`` smallest identities on the way.
    """
    w = Window.partitionBy(feed, message).orderBy(identity)
    few = errors.withColumn("_nth", F.row_number().over(w)).groupBy(feed, message).agg(
        F.count("*").alias("n"), F.min(time).alias("a"), F.max(time).alias("b"),
        F.collect_list(F.when(F.col("_nth") <= samples, F.col(identity))).alias("few"),
    )
    kinds = few.groupBy(feed, F.substring_index(message, ":", 1).alias("error")).agg(
        F.sum("n").alias("n"), F.min("a").alias("a"), F.max("b").alias("b"), F.slice(F.sort_array(F.flatten(F.collect_list("few"))), 1, samples).alias("few")
    )
    clock = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    one = kinds.select(F.lit("error").alias("part"), feed, "error", "n", clock("a").alias("first_at"), clock("b").alias("last_at"), F.array_join(F.transform("few", lambda x: x.cast("string")), ",").alias("samples"))
    most = few.groupBy(message).agg(F.sum("n").alias("n")).orderBy(F.desc("n"), message).limit(top)
    none = F.lit(None).cast("string")
    two = most.select(F.lit("message").alias("part"), none.alias(feed), F.col(message).alias("error"), "n", none.alias("first_at"), none.alias("last_at"), none.alias("samples"))
    return one.unionByName(two)


def duplicate_surplus(key: str) -> Column:
    """Rows beyond the first of each non-null key."""
    return F.count(key) - F.count_distinct(key)


def stability_index(expected: DataFrame, actual: DataFrame, bucket: str, floor: float = 1e-6) -> DataFrame:
    """Population stability index of two (bucket, n) tables: shares clipped at ``floor``, renormalised, compared."""
    both = expected.select(bucket, F.col("n").alias("e")).join(actual.select(bucket, F.col("n").alias("a")), bucket, "full")
    everything = Window.partitionBy(F.lit(0))  # one row per bucket
    for c in ("e", "a"):
        both = both.withColumn(c, F.greatest(F.coalesce(F.col(c), F.lit(0)) / F.sum(c).over(everything), F.lit(floor)))
    for c in ("e", "a"):
        both = both.withColumn(c, F.col(c) / F.sum(c).over(everything))
    return both.agg(F.sum((F.col("a") - F.col("e")) * F.ln(F.col("a") / F.col("e"))).alias("psi"))


def missing_ranges(days: DataFrame, key: str, day: str, start: str, end: str) -> DataFrame:
    """Contiguous ranges of days without rows between two dates, per key (gaps and islands)."""
    keys = days.select(key).distinct()
    wanted = keys.select(key, F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias(day))
    gone = wanted.join(days.select(key, day).distinct(), [key, day], "left_anti")
    nth = F.row_number().over(Window.partitionBy(key).orderBy(day))
    return (
        gone.withColumn("_island", F.date_sub(day, nth))
        .groupBy(key, "_island")
        .agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count("*").alias("n_days"))
        .drop("_island")
    )


def expired_partitions(inventory: DataFrame, today: str, days: int) -> DataFrame:
    """Partitions (with a ``dt``) older than ``days`` before ``today``."""
    return inventory.where(F.col("dt") < F.date_sub(F.lit(today).cast("date"), days))


def expired_versions(inventory: DataFrame, keep: int, pins: DataFrame | None = None) -> DataFrame:
    """Versions (dataset, version, number) beyond the newest ``keep``, pinned ones aside."""
    rank = F.dense_rank().over(Window.partitionBy("dataset").orderBy(F.col("number").desc()))
    old = inventory.withColumn("_rank", rank).where(F.col("_rank") > keep).drop("_rank")
    return old if pins is None else old.join(pins.select("dataset", "version"), ["dataset", "version"], "left_anti")


def safe_to_delete(expired: DataFrame, lineage: DataFrame) -> DataFrame:
    """Expired partitions (dataset, dt) that nothing kept was made of; ``lineage`` has (source, dt) of what is kept."""
    used = lineage.select(F.col("source").alias("dataset"), "dt").distinct()
    return expired.join(used, ["dataset", "dt"], "left_anti")
