"""Queries of sorting, set operations, deduplication, scalars and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pitlake.functions import scalars as s
from pitlake.operators import dedupe, quality
from pitlake.plans import bindings as b
from pitlake.plans.catalog import register


@register("top_scores", "SELECT event_id, round(value, 4) AS score FROM events WHERE value >= 40 ORDER BY value DESC, event_id LIMIT 25")
def top_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score filter, best first; the limit is the feature."""
    return b.read(spark, sf_dir, "events").where("value >= 40").orderBy(F.desc("value"), "event_id").limit(25).select("event_id", F.round("value", 4).alias("score"))


@register("first_per_key", "SELECT o_custkey, o_orderkey, CAST(nth AS INTEGER) AS nth FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS nth FROM orders) WHERE nth <= 3")
def first_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three rows of each key."""
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return b.read(spark, sf_dir, "orders").withColumn("nth", F.row_number().over(w)).where("nth <= 3").select("o_custkey", "o_orderkey", "nth")


@register("union_by_name", "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL::BIGINT AS n FROM customer UNION ALL SELECT s_suppkey, s_name, NULL, 1 FROM supplier")
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of both, columns by name, missing ones null."""
    left = b.read(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_mktsegment AS segment")
    right = b.read(spark, sf_dir, "supplier").selectExpr("s_suppkey AS id", "s_name AS name", "cast(1 AS bigint) AS n")
    return left.unionByName(right, allowMissingColumns=True)


@register("set_operations", "SELECT 'both' AS kind, count(*) AS n FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') UNION ALL SELECT 'either', count(*) FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O' UNION SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') UNION ALL SELECT 'only', count(*) FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def set_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intersection, union and difference."""
    orders = b.read(spark, sf_dir, "orders")
    a, c = (orders.where(F.col("o_orderstatus") == x).select("o_custkey") for x in ("O", "P"))
    size = lambda df, kind: df.agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "n")
    return size(a.intersect(c), "both").unionByName(size(a.union(c).distinct(), "either")).unionByName(size(a.subtract(c), "only"))


@register("dedupe_earliest", b.with_(b.DUPLICATED) + "SELECT event_id, round(value, 4) AS value FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts_ingest) AS nth FROM duplicated) WHERE nth = 1")
def dedupe_earliest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compaction keeps what arrived first."""
    return dedupe.earliest(b.duplicated(spark, sf_dir), "event_id", "ts_ingest").select("event_id", F.round("value", 4).alias("value"))


@register("dedupe_latest", b.with_(b.DUPLICATED) + "SELECT event_id, round(value, 4) AS value FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts_ingest DESC) AS nth FROM duplicated) WHERE nth = 1")
def dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Promotion keeps what arrived last."""
    return dedupe.latest(b.duplicated(spark, sf_dir), "event_id", "ts_ingest").select("event_id", F.round("value", 4).alias("value"))


@register("upsert_partition", "SELECT o_orderkey, o_orderstatus, round(o_totalprice, 2) AS price FROM orders WHERE o_orderkey % 5 <> 0 UNION ALL SELECT o_orderkey, 'X', round(o_totalprice * 2, 2) FROM orders WHERE o_orderkey % 5 = 0")
def upsert_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes replace rows with the same key."""
    base = b.read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.round("o_totalprice", 2).alias("price"))
    new = b.read(spark, sf_dir, "orders").where("o_orderkey % 5 = 0").select("o_orderkey", F.lit("X").alias("o_orderstatus"), F.round(F.col("o_totalprice") * 2, 2).alias("price"))
    return dedupe.upsert(base, new, ["o_orderkey"])


@register("quarantine_split", "SELECT 'quarantined' AS side, count(*) FILTER (WHERE o_orderkey % 11 = 0 AND o_orderstatus <> 'P') AS n FROM orders UNION ALL SELECT 'kept', count(*) FILTER (WHERE NOT (o_orderkey % 11 = 0 AND o_orderstatus <> 'P')) FROM orders")
def quarantine_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose measures are all null and that carry no flag are set aside."""
    rows = b.read(spark, sf_dir, "orders").selectExpr("CASE WHEN o_orderkey % 11 <> 0 THEN o_totalprice END AS delta", "CASE WHEN o_orderkey % 11 <> 0 THEN 1.0D END AS gamma", "CASE WHEN o_orderstatus = 'P' THEN array('no_greeks') END AS quality_flags")
    bad = F.coalesce("delta", "gamma").isNull() & ~F.coalesce(F.array_contains("quality_flags", "no_greeks"), F.lit(False))
    found = F.array(*[F.struct(F.lit(n).alias("side"), F.count_if(c).alias("n")) for n, c in (("quarantined", bad), ("kept", ~bad))])
    return rows.agg(found.alias("x")).select(F.inline("x"))


@register("retention_partitions", "SELECT CAST(dt AS VARCHAR) AS dt, n FROM (SELECT CAST(ts AS DATE) AS dt, count(*) AS n FROM events GROUP BY 1) WHERE dt < DATE '2024-01-30' - 14")
def retention_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions older than the retention."""
    parts = b.read(spark, sf_dir, "events").groupBy(F.col("ts").cast("date").alias("dt")).agg(F.count("*").alias("n"))
    return quality.expired_partitions(parts, "2024-01-30", 14).select(F.col("dt").cast("string").alias("dt"), "n")


@register("retention_versions", "WITH v AS (SELECT DISTINCT o_custkey % 7 AS dataset, o_orderkey % 9 AS number FROM orders), r AS (SELECT *, dense_rank() OVER (PARTITION BY dataset ORDER BY number DESC) AS k FROM v) SELECT dataset, number FROM r WHERE k > 3 AND NOT (dataset = 2 AND number = 1)")
def retention_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions beyond the newest three, unless pinned."""
    rows = b.read(spark, sf_dir, "orders").selectExpr("o_custkey % 7 AS dataset", "o_orderkey % 9 AS number").distinct().withColumn("version", F.col("number"))
    pins = spark.createDataFrame([(2, 1)], "dataset bigint, version bigint")
    return quality.expired_versions(rows, 3, pins).select("dataset", "number")


@register("retention_lineage", """WITH p AS (SELECT event_type AS dataset, CAST(ts AS DATE) AS dt, count(*) AS n FROM events GROUP BY 1, 2), used AS (SELECT DISTINCT event_type AS dataset, CAST(ts AS DATE) AS dt FROM events WHERE user_id % 10 = 0)
  SELECT dataset, CAST(dt AS VARCHAR) AS dt, n FROM p ANTI JOIN used USING (dataset, dt) WHERE dt < DATE '2024-01-30' - 7""")
def retention_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old partitions that no kept feature was made of."""
    events = b.read(spark, sf_dir, "events").select(F.col("event_type").alias("dataset"), F.col("ts").cast("date").alias("dt"), "user_id")
    parts = events.groupBy("dataset", "dt").agg(F.count("*").alias("n"))
    lineage = events.where("user_id % 10 = 0").select(F.col("dataset").alias("source"), "dt")
    return quality.safe_to_delete(quality.expired_partitions(parts, "2024-01-30", 7), lineage).select("dataset", F.col("dt").cast("string").alias("dt"), "n")


@register("rewrite_labels", """SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'quarantined' ELSE 'kept' END AS side, CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 5 = 0 THEN 'label_window_truncated' ELSE '' END AS flags, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS expiry FROM orders""")
def rewrite_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored labels rewritten: windows that end before they begin set aside, short ones flagged, expiries made dates."""
    from pitlake.operators.labels import rewritten

    day = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "yyyyMMdd")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    hours = F.when(F.col("o_orderkey") % 7 == 0, -1).when(F.col("o_orderkey") % 5 == 0, 3).otherwise(5)
    rows = b.read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").alias("window_start"), (F.col("o_orderdate") + F.make_dt_interval(hours=hours)).alias("window_end"), day.alias("expiry"), F.lit("swing").alias("horizon"), F.array().cast("array<string>").alias("quality_flags"))
    kept, aside = rewritten(rows, {"swing": 4 * 3600})
    both = kept.withColumn("side", F.lit("kept")).unionByName(aside.withColumn("side", F.lit("quarantined")))
    return both.select("o_orderkey", "side", F.array_join("quality_flags", ",").alias("flags"), F.col("expiry").cast("string").alias("expiry"))


@register("latest_per_entity", b.with_(b.ALERTS) + "SELECT instrument_key, event_id, round(premium, 4) AS premium FROM (SELECT *, row_number() OVER (PARTITION BY instrument_key ORDER BY ts_event DESC) AS nth FROM alerts) WHERE nth = 1")
def latest_per_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot for an online store."""
    rows = b.alerts(spark, sf_dir).groupBy("instrument_key").agg(F.max_by(F.struct("event_id", "premium"), "ts_event").alias("x"))
    return rows.select("instrument_key", "x.event_id", F.round("x.premium", 4).alias("premium"))


@register("scalar_coercions", "SELECT event_id, TRY_CAST(CASE WHEN event_id % 4 = 0 THEN 'n/a' WHEN event_id % 4 = 1 THEN '' ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS as_double, CASE event_id % 4 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true END AS as_bool, CAST(TRY_CAST(CASE WHEN event_id % 2 = 0 THEN CAST(event_id AS VARCHAR) || '.75' ELSE 'x' END AS DOUBLE) - CASE WHEN event_id % 2 = 0 THEN 0.75 ELSE 0 END AS BIGINT) AS as_long FROM events")
def scalar_coercions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts to numbers and booleans, null on failure."""
    rows = b.read(spark, sf_dir, "events").selectExpr(
        "event_id", "CASE WHEN event_id % 4 = 0 THEN 'n/a' WHEN event_id % 4 = 1 THEN '' ELSE cast(value AS string) END AS d",
        "CASE event_id % 4 WHEN 0 THEN ' Yes' WHEN 1 THEN 'F' WHEN 2 THEN '1' ELSE 'maybe' END AS f", "CASE WHEN event_id % 2 = 0 THEN concat(event_id, '.75') ELSE 'x' END AS l",
    )
    return rows.select("event_id", s.to_double(F.col("d")).alias("as_double"), s.to_boolean(F.col("f")).alias("as_bool"), s.to_long(F.col("l")).alias("as_long"))


@register("scalar_timestamps", "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN epoch_us(ts) // 1000000 * 1000000 WHEN event_id % 3 = 1 THEN epoch_us(ts) // 1000 * 1000 END AS us FROM events")
def scalar_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epoch seconds, epoch milliseconds, and text that is no time, as microseconds."""
    from pitlake.operators.asof import micros

    us = micros("ts")
    text = F.when(F.col("event_id") % 3 == 0, F.floor(us / 1_000_000).cast("string")).when(F.col("event_id") % 3 == 1, F.floor(us / 1000).cast("string")).otherwise("soon")
    return b.read(spark, sf_dir, "events").select("event_id", micros(s.to_timestamp(text)).alias("us"))


@register("scalar_keys", "SELECT c_custkey, regexp_matches('equity:' || upper(substr(c_mktsegment, 1, 4)), '^equity:[A-Z0-9]+(?:[.-][A-Z0-9]+)*$') AS valid, 'equity:' || c_mktsegment AS prefixed, c_mktsegment AS plain FROM customer")
def scalar_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key grammar and prefixes."""
    rows = b.read(spark, sf_dir, "customer")
    key = F.concat(F.lit("equity:"), F.upper(F.substring("c_mktsegment", 1, 4)))
    twice = s.with_prefix(s.with_prefix(F.col("c_mktsegment")))
    return rows.select("c_custkey", s.valid_key(key, F.lit("equity")).alias("valid"), twice.alias("prefixed"), s.without_prefix(twice).alias("plain"))


@register("scalar_option_symbols", "SELECT o_orderkey, 'U' || chr(CAST(65 + o_custkey % 26 AS INTEGER)) || strftime(o_orderdate, '%y%m%d') || CASE WHEN o_orderstatus = 'O' THEN 'C' ELSE 'P' END || lpad(CAST(CAST(o_custkey * 2500 AS BIGINT) AS VARCHAR), 8, '0') AS symbol, CASE WHEN o_orderstatus = 'O' THEN 'C' ELSE 'P' END AS side FROM orders")
def scalar_option_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Option symbols built and their side read back."""
    rows = b.read(spark, sf_dir, "orders").selectExpr("o_orderkey", "concat('u', lower(chr(65 + o_custkey % 26))) AS u", "cast(o_orderdate AS date) AS e", "CASE WHEN o_orderstatus = 'O' THEN 'call' ELSE 'put' END AS pc", "o_custkey * 2.5 AS strike")
    symbol = s.option_symbol(F.col("u"), F.col("e"), F.col("pc"), F.col("strike"))
    return rows.select("o_orderkey", symbol.alias("symbol"), s.option_side(symbol).alias("side"))


@register("scalar_symbols", "SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'BTC-USD' WHEN 1 THEN 'ETH-USD' WHEN 2 THEN 'ETH-USDT' WHEN 3 THEN 'SOL-EUR' END AS crypto, 'BRK.B' AS equity, CASE event_id % 2 WHEN 0 THEN 'XLK' ELSE 'SPY' END AS fund FROM events")
def scalar_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crypto, equity and sector names made canonical."""
    rows = b.read(spark, sf_dir, "events").selectExpr("event_id", "CASE event_id % 5 WHEN 0 THEN ' btc/usd' WHEN 1 THEN 'ETH_USD' WHEN 2 THEN 'ethusdt' WHEN 3 THEN 'SOL-EUR' ELSE '12' END AS c", "'brk.b==' AS e", "CASE event_id % 2 WHEN 0 THEN ' technology ' ELSE 'unknown' END AS f")
    return rows.select("event_id", s.crypto_symbol(F.col("c")).alias("crypto"), s.equity_symbol(F.col("e")).alias("equity"), s.sector_fund(F.col("f")).alias("fund"))


@register("scalar_suspect_flags", b.with_(b.BARS, b.QUOTES) + """SELECT 'quotes' AS feed, seq, concat_ws(',', CASE WHEN bid_px - 1000 > ask_px - 2000 THEN 'inverted_spread' END, CASE WHEN bid_px - 1000 < 0 OR ask_px - 2000 < 0 THEN 'negative_price' END) AS flags FROM quotes
  UNION ALL SELECT 'bars', seq, concat_ws(',', CASE WHEN close - 2000 < 0 OR high - 3000 < 0 THEN 'negative_price' END, CASE WHEN volume - 2 < 0 THEN 'negative_volume' END, CASE WHEN high - 3000 < low THEN 'high_below_low' END) FROM bars
  UNION ALL SELECT 'trades', seq, concat_ws(',', CASE WHEN close - 2000 <= 0 THEN 'non_positive_price' END, CASE WHEN volume - 2 < 0 THEN 'negative_size' END) FROM bars""")
def scalar_suspect_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is odd about quotes, bars and trades."""
    c = F.col
    odd = lambda df, feed, **columns: df.select(F.lit(feed).alias("feed"), "seq", F.array_join(s.suspect_flags(feed, **columns), ",").alias("flags"))
    bars = b.bars(spark, sf_dir)
    quotes = odd(b.quotes(spark, sf_dir), "quotes", bid=c("bid_px") - 1000, ask=c("ask_px") - 2000)
    wide = odd(bars, "bars", open=c("open"), high=c("high") - 3000, low=c("low"), close=c("close") - 2000, volume=c("volume") - 2)
    return quotes.unionByName(wide).unionByName(odd(bars, "trades", price=c("close") - 2000, size=c("volume") - 2))


@register("scalar_explode_payload", "SELECT o_custkey || ':' || (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) AS event_id, round(o_totalprice, 2) AS price FROM orders")
def scalar_explode_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aggregate payloads (JSON arrays) exploded into rows that inherit the key."""
    orders = b.read(spark, sf_dir, "orders")
    items = F.sort_array(F.collect_list(F.struct("o_orderkey", F.round("o_totalprice", 2).alias("price"))))  # one customer's orders
    payload = orders.groupBy("o_custkey").agg(F.to_json(items).alias("payload"))
    rows = payload.select("o_custkey", F.posexplode(F.from_json("payload", "array<struct<o_orderkey:bigint,price:double>>")).alias("i", "x"))
    return rows.select(F.concat_ws(":", F.col("o_custkey").cast("string"), F.col("i").cast("string")).alias("event_id"), "x.price")


@register("scalar_alignment", b.with_(b.ALERTS) + "SELECT event_id, CASE event_type WHEN 'view' THEN 1 WHEN 'error' THEN -1 ELSE 0 END AS sentiment, CASE WHEN event_type NOT IN ('view', 'error') THEN 0 WHEN (put_call = 'C') = (event_type = 'view') THEN 1 ELSE -1 END AS alignment FROM alerts")
def scalar_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentiment words and their agreement with a direction."""
    word = F.when(F.col("event_type") == "view", " Bullish").when(F.col("event_type") == "error", "bearish ").otherwise("n/a")
    rows = b.alerts(spark, sf_dir).withColumn("sentiment", s.sentiment_sign(word))
    return rows.select("event_id", "sentiment", s.alignment(F.col("put_call") == "C", F.col("sentiment")).alias("alignment"))


@register("scalar_dates", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS expiry, CASE WHEN o_orderkey % 3 < 2 THEN date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) END AS dte FROM orders")
def scalar_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expiries as ISO text, as digits, as neither."""
    text = F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "yyyyMMdd")).when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("never")
    rows = b.read(spark, sf_dir, "orders").select("o_orderkey", s.to_date(text).alias("e"))
    return rows.select("o_orderkey", F.col("e").cast("string").alias("expiry"), F.datediff("e", F.lit("1995-01-01").cast("date")).cast("long").alias("dte"))


_ZONED = "SELECT event_id, ts, value, timezone('America/New_York', timezone('UTC', ts)) AS local FROM events"


@register("scalar_clock", f"SELECT event_id, CAST(hour(local) AS INTEGER) AS hour, CAST(minute(local) AS INTEGER) AS minute, CAST((dayofweek(local) + 6) % 7 AS INTEGER) AS weekday, CAST(hour(local) * 60 + minute(local) - 570 AS INTEGER) AS since_open, CAST(960 - hour(local) * 60 - minute(local) AS INTEGER) AS to_close, round((value + 1) / 100, 6) AS moneyness, round(ln((value + 1) / 100), 6) AS log_moneyness FROM ({_ZONED})")
def scalar_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exchange clock of a UTC time (Monday is 0), and moneyness."""
    rows = b.read(spark, sf_dir, "events")
    clock = s.exchange_clock(F.col("ts"))
    money = s.moneyness(F.col("value") + 1, F.lit(100.0))
    return rows.select("event_id", *[c.alias(n) for n, c in clock.items()], *[F.round(c, 6).alias(n) for n, c in money.items()])


@register("scalar_tags", b.with_(b.ALERTS) + "SELECT event_id, CAST(event_type = 'view' AS INTEGER) AS tag_view, CAST(is_sweep AS INTEGER) AS tag_sweep, CAST(k % 2 = 0 AS INTEGER) AS tag_even, 0 AS tag_none FROM alerts")
def scalar_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One column of 0 and 1 per tag, whatever its case; no list has no tags."""
    tags = F.when(F.col("k") >= 0, F.array_compact(F.array(F.initcap("event_type"), F.when(F.col("is_sweep"), F.lit("SWEEP")), F.when(F.col("k") % 2 == 0, F.lit("Even")))))
    rows = b.alerts(spark, sf_dir).withColumn("tags", tags)
    return rows.select("event_id", *[c.alias(n) for n, c in s.tag_columns(F.col("tags"), ["view", "sweep", "even", "none"]).items()])


@register("scalar_first_present", b.with_(b.ALERTS) + "SELECT event_id, CASE WHEN k % 3 = 0 THEN 'a' || k WHEN k % 3 = 1 THEN 'b' || k ELSE event_type END AS found FROM alerts")
def scalar_first_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first of several names of a payload that holds something; blank text holds nothing."""
    from pitlake.functions.payloads import first_present

    k = F.col("k").cast("string")
    payload = F.to_json(F.struct(
        F.when(F.col("k") % 3 == 0, F.concat(F.lit("a"), k)).alias("ticker"), F.when(F.col("k") % 3 == 1, F.concat(F.lit("b"), k)).otherwise(F.lit("  ")).alias("symbol"), F.col("event_type").alias("underlying"),
    ))
    return b.alerts(spark, sf_dir).select("event_id", first_present(payload, ["ticker", "symbol", "underlying"]).alias("found"))


@register("scalar_feed_keys", b.with_(b.ALERTS) + """SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'equity:U' || (k % 9) WHEN 1 THEN 'crypto:BTC-USD' WHEN 2 THEN 'option:OCC:AB240119C' || lpad(CAST((k + 1) * 1000 AS VARCHAR), 8, '0') WHEN 3 THEN 'equity:XLK' ELSE 'equity:SPY' END AS key FROM alerts""")
def scalar_feed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instrument keys made per feed out of symbols and payloads."""
    from pitlake.functions.keys import feed_key

    n = F.col("event_id") % 5
    feed = F.element_at(F.array(*[F.lit(x) for x in ("bars", "trades", "flow_alerts", "sector_tide", "market_tide")]), (n + 1).cast("int"))
    kind = F.when(n == 1, "crypto").otherwise("equity")
    symbol = F.when(n == 0, F.concat(F.lit(" u"), F.col("k") % 9, F.lit("="))).when(n == 1, F.lit("btcusd"))
    payload = F.when(n == 2, F.to_json(F.struct(F.lit("ab").alias("ticker"), F.lit("2024-01-19").alias("expiry"), F.lit("call").alias("put_call"), (F.col("k") + 1).alias("strike")))).when(n == 3, F.lit('{"sector": "Technology"}'))
    return b.alerts(spark, sf_dir).select("event_id", feed_key(feed, kind, symbol, payload).alias("key"))


_FOLDS = """counted AS (SELECT fold, count(*) FILTER (WHERE d >= a AND d < b) AS n_train, count(*) FILTER (WHERE d >= c AND d < e) AS n_test
  FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders) JOIN f ON (d >= a AND d < b) OR (d >= c AND d < e) GROUP BY 1)"""


def _fold_counts(spark: SparkSession, sf_dir: str, folds: list) -> DataFrame:
    from pitlake.operators.splits import assign_folds

    rows = assign_folds(b.read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d")), "d", folds)
    return rows.groupBy("fold").agg(F.count_if(F.col("part") == "train").alias("n_train"), F.count_if(F.col("part") == "test").alias("n_test"))


@register("scalar_payload_columns", b.with_(b.ALERTS) + """SELECT event_id, 'n' || k AS politician_name, CASE WHEN k % 2 = 0 THEN '2024-01-02' ELSE '2024-01-03' END AS trade_date, (k + 1) * 1000.0::DOUBLE AS amount_min, CASE WHEN k % 3 = 0 THEN (k + 1) * 1000.0::DOUBLE ELSE (k + 2) * 1000.5::DOUBLE END AS amount_max,
  nullif(concat_ws('|', CASE WHEN k % 2 = 0 THEN 'director' END, CASE WHEN k % 3 = 0 THEN '10b5-1' END), '') AS insider_relationship, round((k + 1) / nullif(k % 4, 0), 6) AS call_put_ratio,
  CASE WHEN k % 2 = 0 THEN '2023-12-31' ELSE strftime(ts_event, '%Y-%m-%d') END AS short_date FROM alerts""")
def scalar_payload_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provider payloads of four feeds read into their columns."""
    from pitlake.functions.contracts import normalised

    k = F.col("k")
    money = lambda n: F.concat(F.lit("$"), F.format_number(n, 2))
    amounts = F.when(k % 3 == 0, money((k + 1) * 1000)).otherwise(F.concat(money((k + 1) * 1000), F.lit(" - "), money((k + 2) * 1000.5)))
    congress = F.to_json(F.struct(F.lit("").alias("name"), F.concat(F.lit("n"), k).alias("reporter"), F.when(k % 2 == 0, "2024-01-02").alias("transaction_date"), F.lit("2024-01-03").alias("date"), amounts.alias("amounts")))
    insider = F.to_json(F.struct((k % 2 == 0).alias("is_director"), (k % 3 == 0).alias("is_10b5_1")))
    tide = F.to_json(F.struct((k + 1).cast("string").alias("net_call_premium"), (k % 4).cast("string").alias("net_put_premium")))
    short = F.to_json(F.struct(F.when(k % 2 == 0, "2023-12-31").otherwise(" ").alias("date")))
    event = F.col("ts_event")
    one, two, three, four = (normalised(f, p, event) for f, p in (("congress_trades", congress), ("insider_trades", insider), ("sector_tide", tide), ("short_data", short)))
    return b.alerts(spark, sf_dir).select(
        "event_id", *[one[c].alias(c) for c in ("politician_name", "trade_date", "amount_min", "amount_max")],
        two["insider_relationship"].alias("insider_relationship"), F.round(three["call_put_ratio"], 6).alias("call_put_ratio"), four["date"].alias("short_date"),
    )


@register("scalar_event_ids", "SELECT count(DISTINCT event_id) AS n_ids, count(DISTINCT event_id) AS n_rows, 32 AS width FROM events")
def scalar_event_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bar identities: as many as there are rows, 32 signs wide, the same when they are made again."""
    from pitlake.functions.payloads import bar_event_id

    rows = b.read(spark, sf_dir, "events").select(F.lit("p").alias("provider"), F.col("event_type").alias("feed"), F.concat(F.lit("equity:U"), "user_id").alias("key"), "ts", F.col("event_id").cast("string").alias("frame"))
    made = lambda: bar_event_id(F.col("provider"), F.col("feed"), F.col("key"), F.col("ts"), F.col("frame"))
    ids = rows.select(made().alias("a"), made().alias("c")).where("a = c")
    return ids.agg(F.count_distinct("a").alias("n_ids"), F.count("*").alias("n_rows"), F.max(F.length("a")).alias("width"))


@register("split_walk_forward", "WITH s AS (SELECT g AS fold, CAST(DATE '1995-01-01' + CAST(g * 180 AS INTEGER) AS DATE) AS a FROM generate_series(0, 30) t(g)), f AS (SELECT fold, a, a + 350 AS b, a + 365 AS c, a + 545 AS e FROM s WHERE a + 545 <= DATE '2002-01-01'), " + _FOLDS + " SELECT * FROM counted")
def split_walk_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All walk-forward folds that fit, with an embargo and a purge; the folds are a short literal table."""
    from pitlake.operators.splits import walk_forward

    return _fold_counts(spark, sf_dir, walk_forward("1995-01-01", "2002-01-01", "360d", "180d", "180d", "5d", purge="10d"))


@register("split_expanding", "WITH s AS (SELECT g AS fold, DATE '1995-01-01' AS a, CAST(DATE '1995-01-01' + CAST(720 + g * 180 AS INTEGER) AS DATE) AS b FROM generate_series(0, 30) t(g)), f AS (SELECT fold, a, b, b + 5 AS c, b + 185 AS e FROM s WHERE b + 185 <= DATE '2002-01-01'), " + _FOLDS + " SELECT * FROM counted")
def split_expanding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folds whose training part grows."""
    from pitlake.operators.splits import expanding

    return _fold_counts(spark, sf_dir, expanding("1995-01-01", "2002-01-01", "720d", "180d", "5d"))


@register("split_holdout_overlap", "WITH s AS (SELECT g AS fold, CAST(DATE '1995-01-01' + CAST(g * 180 AS INTEGER) AS DATE) AS a FROM generate_series(0, 30) t(g)), f AS (SELECT fold, a, a + 360 AS b, a + 365 AS c, a + 545 AS e FROM s WHERE a + 545 <= DATE '2002-01-01') SELECT fold, (a < DATE '2001-01-01' AND b > DATE '2000-06-01') OR (c < DATE '2001-01-01' AND e > DATE '2000-06-01') AS overlaps FROM f")
def split_holdout_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folds that reach into a holdout."""
    from pitlake.operators.splits import overlaps_holdout, walk_forward

    folds = walk_forward("1995-01-01", "2002-01-01", "360d", "180d", "180d", "5d")
    return spark.createDataFrame([(f[0], overlaps_holdout(f, "2000-06-01", "2001-01-01")) for f in folds], "fold bigint, overlaps boolean")


@register("split_temporal_default", "WITH n AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS i, count(*) OVER () AS n FROM orders) SELECT o_orderkey, CASE WHEN i <= floor(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS part FROM n")
def split_temporal_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a split date the first four fifths of the rows in time are for training."""
    from pitlake.operators.splits import share_split

    rows = share_split(b.read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"], 0.8)
    return rows.select("o_orderkey", "part")


@register("split_temporal", "SELECT CASE WHEN CAST(o_orderdate AS DATE) < DATE '1999-12-27' THEN 'train' WHEN CAST(o_orderdate AS DATE) >= DATE '2000-01-04' THEN 'test' ELSE 'purged' END AS part, count(*) AS n FROM orders GROUP BY 1")
def split_temporal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train before the split less a purge, test after it plus an embargo."""
    from pitlake.operators.splits import temporal_split

    rows = temporal_split(b.read(spark, sf_dir, "orders").withColumn("d", F.col("o_orderdate").cast("date")), "d", "2000-01-01", purge_days=5, embargo_days=3)
    return rows.groupBy("part").agg(F.count("*").alias("n"))


@register("split_meta_label", "SELECT event_id, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS meta_label FROM events")
def split_meta_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1 where the outcome is a hit."""
    outcome = F.when(F.col("event_type") == "purchase", "HIT_TP").otherwise("hit_sl")
    return b.read(spark, sf_dir, "events").select("event_id", (F.lower(outcome) == "hit_tp").cast("int").alias("meta_label"))


@register("stream_window_counts", "SELECT CAST(date_trunc('hour', ts) AS VARCHAR) AS hour, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tumbling windows; the streaming form is tested against this one."""
    rows = b.read(spark, sf_dir, "events").groupBy(F.date_trunc("hour", "ts").alias("hour"), "event_type").agg(F.count("*").alias("n"))
    return rows.select(F.date_format("hour", "yyyy-MM-dd HH:mm:ss").alias("hour"), "event_type", "n")
