"""How the operators' roles are bound to the driver's tables, in Spark and, as CTEs, in SQL.

alerts    events: key = user, premium = value, call when purchase or click, sweep when signup;
          available up to ten minutes later, so arrival is out of order
bars      lineitem per supplier, 1Min bars of a shipping day, unique in (key, ts_event, seq)
quotes    lineitem: bid and ask around the price, sizes from the quantity
snaps     orders as slow-moving snapshots of a customer
lifecycle customers with orders: listed on the first order's day, delisted on the last one's
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlake.operators.daily import daily_bars


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One input table."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flow alerts."""
    return read(spark, sf_dir, "events").selectExpr(
        "event_id",
        "concat('equity:U', user_id) AS instrument_key",
        "ts AS ts_event",
        "ts + make_dt_interval(0, 0, 0, event_id % 600) AS ts_available",
        "value AS premium",
        "CASE WHEN event_type IN ('purchase', 'click') THEN 'C' ELSE 'P' END AS put_call",
        "event_type = 'signup' AS is_sweep",
        "event_type",
        "cast(get_json_object(props, '$.k') AS int) AS k",
    )


ALERTS = """alerts AS (SELECT event_id, 'equity:U' || user_id AS instrument_key, ts AS ts_event,
  ts + to_seconds(event_id % 600) AS ts_available, value AS premium,
  CASE WHEN event_type IN ('purchase', 'click') THEN 'C' ELSE 'P' END AS put_call,
  event_type = 'signup' AS is_sweep, event_type, CAST(props->>'$.k' AS INTEGER) AS k FROM events)"""


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intraday bars."""
    return read(spark, sf_dir, "lineitem").selectExpr(
        "concat('equity:S', l_suppkey) AS instrument_key",
        "l_shipdate + make_dt_interval(0, 0, cast(l_orderkey % 390 AS int)) AS ts_event",
        "l_shipdate + make_dt_interval(0, 1, cast(l_orderkey % 390 AS int)) AS ts_available",
        "l_orderkey * 10 + l_linenumber AS seq",
        "CASE WHEN l_linenumber = 1 THEN '1Day' ELSE '1Min' END AS timeframe",
        "l_extendedprice AS open",
        "l_extendedprice * (1 + l_tax) AS high",
        "l_extendedprice * (1 - l_discount) AS low",
        "l_extendedprice * (1 + l_tax - l_discount) AS close",
        "l_quantity AS volume",
        "l_extendedprice * (1 + l_tax / 2) AS vwap",
    )


BARS = """bars AS (SELECT 'equity:S' || l_suppkey AS instrument_key,
  l_shipdate + to_minutes(CAST(l_orderkey % 390 AS INTEGER)) AS ts_event,
  l_shipdate + to_minutes(CAST(l_orderkey % 390 + 60 AS INTEGER)) AS ts_available,
  l_orderkey * 10 + l_linenumber AS seq,
  CASE WHEN l_linenumber = 1 THEN '1Day' ELSE '1Min' END AS timeframe,
  l_extendedprice AS open, l_extendedprice * (1 + l_tax) AS high, l_extendedprice * (1 - l_discount) AS low,
  l_extendedprice * (1 + l_tax - l_discount) AS close, l_quantity AS volume,
  l_extendedprice * (1 + l_tax / 2) AS vwap FROM lineitem)"""


def daily(bars_df: DataFrame) -> DataFrame:
    """Daily bars."""
    return daily_bars(bars_df)


DAILY = """daily AS (SELECT instrument_key, CAST(ts_event AS DATE) AS day, first(open ORDER BY ts_event, seq) AS open,
  max(high) AS high, min(low) AS low, last(close ORDER BY ts_event, seq) AS close, sum(volume) AS volume,
  last(vwap ORDER BY ts_event, seq) AS vwap, count(*) AS n_bars, max(ts_available) AS ts_available
  FROM bars GROUP BY ALL)"""


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes."""
    return read(spark, sf_dir, "lineitem").selectExpr(
        "concat('equity:S', l_suppkey) AS instrument_key",
        "l_shipdate AS ts_event",
        "l_orderkey * 10 + l_linenumber AS seq",
        "l_extendedprice AS price",
        "l_extendedprice * (1 - l_discount) AS bid_px",
        "l_extendedprice * (1 + l_tax) AS ask_px",
        "l_quantity AS bid_sz",
        "l_quantity + l_linenumber AS ask_sz",
        "l_returnflag",
        "l_linestatus",
    )


QUOTES = """quotes AS (SELECT 'equity:S' || l_suppkey AS instrument_key, l_shipdate AS ts_event,
  l_orderkey * 10 + l_linenumber AS seq, l_extendedprice AS price, l_extendedprice * (1 - l_discount) AS bid_px,
  l_extendedprice * (1 + l_tax) AS ask_px, l_quantity AS bid_sz, l_quantity + l_linenumber AS ask_sz,
  l_returnflag, l_linestatus FROM lineitem)"""


def snaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots."""
    return read(spark, sf_dir, "orders").selectExpr(
        "concat('equity:U', o_custkey) AS instrument_key",
        "o_orderdate AS ts_event",
        "o_orderdate + make_dt_interval(0, cast(o_orderkey % 48 AS int)) AS ts_available",
        "o_orderkey AS seq",
        "o_totalprice AS level",
        "o_orderpriority AS sector",
        "o_orderstatus AS status",
    )


SNAPS = """snaps AS (SELECT 'equity:U' || o_custkey AS instrument_key, o_orderdate AS ts_event,
  o_orderdate + to_hours(CAST(o_orderkey % 48 AS INTEGER)) AS ts_available, o_orderkey AS seq, o_totalprice AS level,
  o_orderpriority AS sector, o_orderstatus AS status FROM orders)"""


def lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing intervals; customers of segment BUILDING are still listed."""
    orders = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    customers = read(spark, sf_dir, "customer")
    return orders.join(customers, orders["o_custkey"] == customers["c_custkey"]).selectExpr(
        "concat('equity:U', o_custkey) AS instrument_key",
        "cast(a AS date) AS list_date",
        "CASE WHEN c_mktsegment <> 'BUILDING' THEN cast(b AS date) END AS delist_date",
    )


LIFECYCLE = """lifecycle AS (SELECT 'equity:U' || o_custkey AS instrument_key, CAST(min(o_orderdate) AS DATE) AS list_date,
  CASE WHEN min(c_mktsegment) <> 'BUILDING' THEN CAST(max(o_orderdate) AS DATE) END AS delist_date
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY o_custkey)"""


def duplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of which every tenth arrived again, an hour later and with another value."""
    first = read(spark, sf_dir, "events").selectExpr("event_id", "ts AS ts_event", "ts AS ts_ingest", "user_id", "value")
    again = first.where("event_id % 10 = 0").selectExpr(
        "event_id", "ts_event", "ts_ingest + make_dt_interval(0, 1) AS ts_ingest", "user_id", "value + 1 AS value"
    )
    return first.unionByName(again)


DUPLICATED = """duplicated AS (SELECT event_id, ts AS ts_event, ts AS ts_ingest, user_id, value FROM events UNION ALL
  SELECT event_id, ts, ts + to_hours(1), user_id, value + 1 FROM events WHERE event_id % 10 = 0)"""


def with_(*ctes: str) -> str:
    """A WITH clause of the CTEs."""
    return "WITH " + ",\n".join(ctes) + "\n"
