"""Queries of scans and predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlake.operators.windows import change, series
from pitlake.plans import bindings as b
from pitlake.plans.catalog import register

ASOF = "1999-06-30 00:00:00"


def _asof() -> Column:
    return F.lit(ASOF).cast("timestamp_ntz")


@register(
    "pit_daily_momentum",
    b.with_(b.BARS, f"seen AS (SELECT * FROM bars WHERE ts_available <= TIMESTAMP '{ASOF}')", b.DAILY.replace("FROM bars", "FROM seen"))
    + """SELECT instrument_key, CAST(day AS VARCHAR) AS day, round(close, 4) AS close,
  round(close / lag(close, 1) OVER w - 1, 6) AS momentum_1d, round(close / lag(close, 5) OVER w - 1, 6) AS momentum_5d,
  round(close / lag(close, 20) OVER w - 1, 6) AS momentum_20d, round((close / lag(close, 5) OVER w - 1) * 100, 6) AS roc_5d
  FROM daily WINDOW w AS (PARTITION BY instrument_key ORDER BY day)""",
)
def pit_daily_momentum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As-of read, daily bars, momentum: the flagship."""
    seen = b.bars(spark, sf_dir).where(F.col("ts_available") <= _asof())
    w = series("instrument_key", ["day"])
    out = b.daily(seen)
    return out.select(
        "instrument_key",
        F.col("day").cast("string").alias("day"),
        F.round("close", 4).alias("close"),
        *[F.round(change(w, "close", n), 6).alias(f"momentum_{n}d") for n in (1, 5, 20)],
        F.round(change(w, "close", 5) * 100, 6).alias("roc_5d"),
    )


@register(
    "scan_silver",
    b.with_(b.BARS)
    + """SELECT instrument_key, CAST(ts_event AS VARCHAR) AS ts_event, seq, round(close, 4) AS close FROM bars
  WHERE ts_event BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-12-31 00:00:00' AND timeframe = '1Day'
  AND instrument_key IN ('equity:S1', 'equity:S2', 'equity:S3')""",
)
def scan_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Range (both ends), keys, timeframe and projection; key and time are computed here, so nothing is pruned (``lake_silver_scan`` is)."""
    return (
        b.bars(spark, sf_dir)
        .where("ts_event BETWEEN timestamp_ntz'1997-01-01 00:00:00' AND timestamp_ntz'1997-12-31 00:00:00' AND timeframe = '1Day'")
        .where(F.col("instrument_key").isin("equity:S1", "equity:S2", "equity:S3"))
        .select("instrument_key", F.date_format("ts_event", "yyyy-MM-dd HH:mm:ss").alias("ts_event"), "seq", F.round("close", 4).alias("close"))
    )


@register(
    "scan_asof",
    b.with_(b.SNAPS)
    + f"""SELECT instrument_key, count(*) AS n, max(seq) AS newest, CAST(max(CAST(ts_available AS DATE)) AS VARCHAR) AS seen
  FROM snaps WHERE ts_available <= TIMESTAMP '{ASOF}' GROUP BY 1""",
)
def scan_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nothing that was not available yet."""
    seen = b.snaps(spark, sf_dir).where(F.col("ts_available") <= _asof()).groupBy("instrument_key")
    return seen.agg(F.count("*").alias("n"), F.max("seq").alias("newest"), F.max(F.col("ts_available").cast("date")).cast("string").alias("seen"))


@register(
    "scan_filters",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity >= 49 AND l_returnflag <> 'N' AND l_linestatus IN ('O', 'F') AND l_discount < 0.05",
)
def scan_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tuple predicates; an unknown column is skipped."""
    from pitlake.sources.reader import apply_filters

    rows = b.read(spark, sf_dir, "lineitem")
    wanted = [("l_quantity", ">=", 49), ("l_returnflag", "!=", "N"), ("l_linestatus", "in", ["O", "F"]), ("l_discount", "<", 0.05), ("no_such", "=", 1)]
    return apply_filters(rows, wanted).select("l_orderkey", "l_linenumber", "l_quantity")


@register("scan_partition_counts", "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS dt, count(*) AS n_rows FROM events GROUP BY 1")
def scan_partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per partition."""
    return b.read(spark, sf_dir, "events").groupBy(F.col("ts").cast("date").cast("string").alias("dt")).agg(F.count("*").alias("n_rows"))


@register(
    "filter_required_fields",
    "SELECT event_id FROM events WHERE value IS NOT NULL AND trim(event_type) <> '' AND event_type IS NOT NULL AND trim(props) <> ''",
)
def filter_required_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Required columns present; blank strings count as absent."""
    from pitlake.functions.scalars import present

    rows = b.read(spark, sf_dir, "events")
    return rows.where(present(F.col("value")) & present(F.col("event_type"), True) & present(F.col("props"), True)).select("event_id")


@register(
    "gate_future_events",
    "SELECT event_id, CASE WHEN ts > TIMESTAMP '2024-01-20 01:00:00' THEN 'future' WHEN ts < TIMESTAMP '2024-01-05' THEN 'late' ELSE 'ok' END AS gate FROM events",
)
def gate_future_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Future events go to the error table, late ones are only marked. Now is a parameter: 2024-01-20."""
    return b.read(spark, sf_dir, "events").selectExpr(
        "event_id",
        "CASE WHEN ts > timestamp_ntz'2024-01-20 01:00:00' THEN 'future' WHEN ts < timestamp_ntz'2024-01-05 00:00:00' THEN 'late' ELSE 'ok' END AS gate",
    )


@register("filter_flags", b.with_(b.ALERTS) + "SELECT event_id FROM alerts WHERE is_sweep AND k % 3 = 0")
def filter_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Membership in a list of quality flags."""
    flags = F.array_compact(F.array(F.when(F.col("is_sweep"), "sweep"), F.when(F.col("k") % 3 == 0, "third")))
    rows = b.alerts(spark, sf_dir).withColumn("quality_flags", flags)
    return rows.where(F.array_contains("quality_flags", "sweep") & F.array_contains("quality_flags", "third")).select("event_id")


@register(
    "filter_min_samples",
    "SELECT o_custkey, o_orderkey FROM (SELECT *, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders) WHERE n >= 12",
)
def filter_min_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys with enough rows, by a pre-aggregated count rather than a window over whole rows."""
    orders = b.read(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    enough = orders.groupBy("o_custkey").agg(F.count("*").alias("n")).where("n >= 12").select("o_custkey")
    return orders.join(enough, "o_custkey", "left_semi")


@register(
    "filter_truncated_windows",
    b.with_(b.ALERTS)
    + """SELECT event_id, NOT coalesce(premium >= CASE event_type WHEN 'view' THEN 50 WHEN 'click' THEN 80 END, false) AS truncated FROM alerts""",
)
def filter_truncated_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label window is truncated unless it lasts as long as its horizon; unknown horizons are."""
    nominal = F.create_map(F.lit("view"), F.lit(50), F.lit("click"), F.lit(80))
    return b.alerts(spark, sf_dir).select("event_id", (~F.coalesce(F.col("premium") >= F.try_element_at(nominal, F.col("event_type")), F.lit(False))).alias("truncated"))


@register(
    "flag_late_enrichment",
    b.with_(b.ALERTS)
    + """SELECT event_id, concat_ws(',', CASE WHEN is_sweep THEN 'sweep' END, CASE WHEN epoch_us(ts_available) - epoch_us(ts_event) > 300000000 THEN 'late_enriched' END) AS flags FROM alerts""",
)
def flag_late_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provenance flags, added once."""
    from pitlake.functions.scalars import add_flag
    from pitlake.operators.asof import micros

    flags = F.array_compact(F.array(F.when(F.col("is_sweep"), "sweep")))
    late = micros("ts_available") - micros("ts_event") > 300_000_000
    rows = b.alerts(spark, sf_dir).withColumn("flags", flags).withColumn("flags", add_flag(F.col("flags"), "late_enriched", late))
    rows = rows.withColumn("flags", add_flag(F.col("flags"), "late_enriched", late))
    return rows.select("event_id", F.array_join("flags", ",").alias("flags"))


@register(
    "select_incomplete_rows",
    b.with_(b.ALERTS)
    + "SELECT event_id FROM alerts WHERE (k % 7 = 0 OR premium < 5) AND ts_event >= TIMESTAMP '2024-01-10'",
)
def select_incomplete_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that lack an enrichment and are young enough; without an age they are not chosen."""
    rows = b.alerts(spark, sf_dir).selectExpr("event_id", "ts_event", "nullif(k % 7, 0) AS gex", "CASE WHEN premium >= 5 THEN premium END AS vex")
    young = F.coalesce(F.col("ts_event") >= F.lit("2024-01-10 00:00:00").cast("timestamp_ntz"), F.lit(False))
    return rows.where((F.col("gex").isNull() | F.col("vex").isNull()) & young).select("event_id")


@register(
    "leakage_report",
    b.with_(b.SNAPS)
    + f"""SELECT 'future_rows' AS check_name, count(*) FILTER (WHERE ts_available > TIMESTAMP '{ASOF}') AS violations FROM snaps
  UNION ALL SELECT 'available_before_event', count(*) FILTER (WHERE ts_available < ts_event) FROM snaps
  UNION ALL SELECT 'commit_skew', count(*) FILTER (WHERE abs(epoch_us(ts_available) - epoch_us(ts_event)) > 5000000) FROM snaps""",
)
def leakage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leakage checks in one pass."""
    from pitlake.operators.asof import micros

    checks = {
        "future_rows": F.col("ts_available") > _asof(),
        "available_before_event": F.col("ts_available") < F.col("ts_event"),
        "commit_skew": F.abs(micros("ts_available") - micros("ts_event")) > 5_000_000,
    }
    found = F.array(*[F.struct(F.lit(n).alias("check_name"), F.count_if(c).alias("violations")) for n, c in checks.items()])
    return b.snaps(spark, sf_dir).agg(found.alias("found")).select(F.inline("found"))


@register(
    "universe_filter",
    b.with_(b.LIFECYCLE)
    + """SELECT instrument_key, delist_date IS NOT NULL AND date_diff('day', DATE '1998-01-01', delist_date) BETWEEN 1 AND 365 AS will_delist
  FROM lifecycle WHERE list_date <= DATE '1998-01-01' AND (delist_date IS NULL OR DATE '1998-01-01' < delist_date)""",
)
def universe_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instruments active on a day, those that delist within a year marked."""
    from pitlake.operators.universe import active_on, will_delist_within

    return active_on(b.lifecycle(spark, sf_dir), "1998-01-01").select("instrument_key", will_delist_within("1998-01-01", 365).alias("will_delist"))


@register(
    "universe_changes",
    b.with_(b.LIFECYCLE)
    + """SELECT 'delisted' AS change, instrument_key, CAST(delist_date AS VARCHAR) AS day FROM lifecycle WHERE delist_date BETWEEN DATE '2000-01-01' AND DATE '2000-12-31'
  UNION ALL SELECT 'listed', instrument_key, CAST(list_date AS VARCHAR) FROM lifecycle WHERE list_date BETWEEN DATE '1995-01-01' AND DATE '1995-03-31'""",
)
def universe_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delistings and listings in a span of days."""
    life = b.lifecycle(spark, sf_dir)
    gone = life.where("delist_date BETWEEN date'2000-01-01' AND date'2000-12-31'").selectExpr("'delisted' AS change", "instrument_key", "cast(delist_date AS string) AS day")
    new = life.where("list_date BETWEEN date'1995-01-01' AND date'1995-03-31'").selectExpr("'listed' AS change", "instrument_key", "cast(list_date AS string) AS day")
    return gone.unionByName(new)
