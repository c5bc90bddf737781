"""Queries of scoring, of the catalog, of the exchange's calendar and of streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlake.functions.calendar import after_market_minutes, label_availability, publish_time, sessions, with_market_clock
from pitlake.functions.payloads import explode_chain
from pitlake.operators import scoring
from pitlake.operators.windows import change, series, trimmed
from pitlake.plans import bindings as b
from pitlake.plans.catalog import register
from pitlake.session import shared_folder
from pitlake.sources import catalog, writer
from pitlake.streaming import ingest, watch

_SCORED = "scored AS (SELECT event_id, round(premium / 100, 2) AS s, CAST(premium + k > 60 AS INTEGER) AS y FROM alerts)"


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.alerts(spark, sf_dir).select("event_id", F.round(F.col("premium") / 100, 2).alias("s"), (F.col("premium") + F.col("k") > 60).cast("int").alias("y"))


def _precision(t: float) -> str:
    return f"coalesce(sum(y) FILTER (WHERE s >= {t}::DOUBLE) / nullif(count(*) FILTER (WHERE s >= {t}::DOUBLE), 0), 0.0)"


@register("ml_metrics", b.with_(b.ALERTS, _SCORED, "pairs AS (SELECT s, sum(y) AS p, count(*) - sum(y) AS n FROM scored GROUP BY 1)", "won AS (SELECT p * (coalesce(sum(n) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + n / 2) AS w FROM pairs)")
  + f"""SELECT 'accuracy' AS metric, round(avg(CASE WHEN (s >= 0.5::DOUBLE) = (y = 1) THEN 1.0 ELSE 0.0 END), 8) AS value FROM scored UNION ALL SELECT 'precision', round({_precision(0.5)}, 8) FROM scored
  UNION ALL SELECT 'recall', round(sum(y) FILTER (WHERE s >= 0.5::DOUBLE) / sum(y), 8) FROM scored UNION ALL SELECT 'auc', round((SELECT sum(w) FROM won) / (sum(y) * (count(*) - sum(y))), 8) FROM scored"""
  + "".join(f" UNION ALL SELECT 'precision_at_{round(t * 100)}', round({_precision(t)}, 8) FROM scored" for t in (0.5, 0.6, 0.7)))
def ml_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy, precision, recall, area under the curve, precision at thresholds."""
    return scoring.metrics(_scored(spark, sf_dir), "s", "y").select("metric", F.round("value", 8).alias("value"))


@register("ml_confidence", b.with_(b.ALERTS, _SCORED) + "SELECT event_id, CASE WHEN s >= 0.7::DOUBLE THEN 'high' WHEN s >= 0.3::DOUBLE THEN 'medium' ELSE 'low' END AS confidence FROM scored")
def ml_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores in three buckets."""
    return _scored(spark, sf_dir).select("event_id", scoring.confidence(F.col("s")).alias("confidence"))


@register("ml_feature_columns", "SELECT * FROM (VALUES (0, 'event_id'), (1, 'premium'), (2, 'is_sweep'), (3, 'event_type'), (4, 'k')) v(place, name)")
def ml_feature_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that a model may learn from."""
    return spark.createDataFrame(list(enumerate(scoring.feature_columns(b.alerts(spark, sf_dir)))), "place int, name string")


@register("ml_boosted_trees")
def ml_boosted_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trees learnt from the first half of the month, their metrics on the second; no SQL, tested by its area under the curve."""
    rows = b.alerts(spark, sf_dir).withColumn("meta_label", (F.col("premium") + F.col("k") > 60).cast("int")).select("event_id", "ts_event", "premium", "k", "meta_label")
    split = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    model = scoring.train(rows.where(F.col("ts_event") < split).drop("event_id"), "meta_label", ["premium", "k"], trees=5, depth=3)
    return scoring.metrics(scoring.scored(model, rows.where(F.col("ts_event") >= split), ["premium", "k"]), "score", "meta_label")


def _instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.read(spark, sf_dir, "customer").selectExpr("c_name AS canonical_symbol", "CASE WHEN c_mktsegment = 'BUILDING' THEN 'option' ELSE 'equity' END AS instrument_type", "c_custkey AS id")


_INSTRUMENTS = "instruments AS (SELECT c_name AS canonical_symbol, CASE WHEN c_mktsegment = 'BUILDING' THEN 'option' ELSE 'equity' END AS instrument_type, c_custkey AS id FROM customer)"


@register("catalog_search", b.with_(_INSTRUMENTS) + "SELECT id, canonical_symbol FROM instruments WHERE instrument_type = 'equity' AND canonical_symbol ILIKE 'CUSTOMER%' ORDER BY canonical_symbol LIMIT 20")
def catalog_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instruments of a kind by the beginning of their symbol; the limit is the feature."""
    return catalog.search_instruments(_instruments(spark, sf_dir), "equity", "CUSTOMER", 20).select("id", "canonical_symbol")


@register("catalog_lookup", b.with_(_INSTRUMENTS) + "SELECT id, canonical_symbol, instrument_type FROM instruments WHERE canonical_symbol IN (SELECT c_name FROM customer WHERE c_custkey IN (1, 7, 42))")
def catalog_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instruments of given symbols."""
    wanted = [r["c_name"] for r in b.read(spark, sf_dir, "customer").where("c_custkey IN (1, 7, 42)").select("c_name").collect()]
    return catalog.lookup_instruments(_instruments(spark, sf_dir), wanted).select("id", "canonical_symbol", "instrument_type")


@register("catalog_datasets", "SELECT * FROM (VALUES ('silver', 'snaps', NULL, NULL, true), ('gold', 'levels', 'p', 'v10', false), ('gold', 'levels', 'p', 'v9', true), ('label', 'levels', NULL, '1.0.0', true)) v(layer, dataset, project, version, newest)")
def catalog_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feeds, features and labels of a lake with their versions."""
    root = shared_folder(spark, "lake")
    snaps = b.snaps(spark, sf_dir).where("seq < 100").select("instrument_key", F.lit("equity").alias("instrument_type"), F.date_trunc("year", "ts_event").alias("ts_event"), F.col("ts_event").alias("ts_ingest"), "ts_available", "level")
    writer.write_silver(snaps, root, "snaps")
    for version in ("v9", "v10"):
        writer.write_gold(snaps, root, "levels", "p", version)
    writer.write_label(snaps, root, "levels", "1.0.0")
    return catalog.datasets(spark, root)


@register("catalog_coverage", "SELECT 'snaps' AS dataset, CAST(CAST(min(date_trunc('year', o_orderdate)) AS DATE) AS VARCHAR) AS first_dt, CAST(CAST(max(date_trunc('year', o_orderdate)) AS DATE) AS VARCHAR) AS last_dt, CAST(count(DISTINCT date_trunc('year', o_orderdate)) AS INTEGER) AS n_dt FROM orders")
def catalog_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last day of a stored feed, from listings alone."""
    root = shared_folder(spark, "lake")
    snaps = b.snaps(spark, sf_dir).select("instrument_key", F.lit("equity").alias("instrument_type"), F.date_trunc("year", "ts_event").alias("ts_event"), F.col("ts_event").alias("ts_ingest"), "ts_available")
    writer.write_silver(snaps, root, "snaps")
    return catalog.coverage(spark, root).select("dataset", "first_dt", "last_dt", "n_dt")


@register("filter_after_computing", b.with_(b.BARS, b.DAILY, "m AS (SELECT instrument_key, day, close / lag(close, 20) OVER (PARTITION BY instrument_key ORDER BY day) - 1 AS r FROM daily WHERE day >= DATE '1996-06-01')")
  + "SELECT instrument_key, CAST(day AS VARCHAR) AS day, round(r, 6) AS r FROM m WHERE day BETWEEN DATE '1997-01-01' AND DATE '1997-03-31'")
def filter_after_computing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features computed over a longer span, trimmed to the days that were asked for; an end at midnight takes its whole day."""
    days = b.daily(b.bars(spark, sf_dir)).where("day >= date'1996-06-01'")
    rows = days.select("instrument_key", F.col("day").cast("timestamp_ntz").alias("at"), change(series("instrument_key", ["day"]), "close", 20).alias("r"))
    out = trimmed(rows, "at", "1997-01-01 00:00:00", "1997-03-31 00:00:00")
    return out.select("instrument_key", F.col("at").cast("date").cast("string").alias("day"), F.round("r", 6).alias("r"))


#: The exchange's sessions from the end of 2023 to March 2024, all of them from 14:30 to 21:00 UTC.
_SESSIONS = """cal AS (SELECT CAST(g AS DATE) AS s, row_number() OVER (ORDER BY g) - 1 AS i, lead(CAST(g AS DATE)) OVER (ORDER BY g) AS n FROM generate_series(TIMESTAMP '2023-12-26', TIMESTAMP '2024-03-01', INTERVAL 1 DAY) t(g)
  WHERE dayofweek(g) NOT IN (0, 6) AND CAST(g AS DATE) NOT IN (DATE '2024-01-01', DATE '2024-01-15', DATE '2024-02-19'))"""
_CLOCK = "'%Y-%m-%d %H:%M:%S'"


def _sessions(spark: SparkSession) -> DataFrame:
    return sessions(spark, "2023-12-26", "2024-03-01")


@register("calendar_clock", b.with_(_SESSIONS) + f"""SELECT event_id, ts < s + INTERVAL 21 HOUR AS is_open, CAST(i * 390 + least(datesub('minute', s + INTERVAL 870 MINUTE, ts), 390) AS BIGINT) AS market_minutes, strftime(n + INTERVAL 870 MINUTE, {_CLOCK}) AS next_open
  FROM events ASOF JOIN cal ON ts >= s + INTERVAL 870 MINUTE""")
def calendar_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the exchange is open, minutes of trading so far, and when it opens next."""
    rows = with_market_clock(b.read(spark, sf_dir, "events").select("event_id", "ts"), "ts", _sessions(spark))
    return rows.select("event_id", "is_open", "market_minutes", F.date_format("next_open", "yyyy-MM-dd HH:mm:ss").alias("next_open"))


@register("calendar_due", b.with_(_SESSIONS) + f"SELECT event_id, strftime(s + INTERVAL 870 MINUTE + to_minutes(CAST(event_id % 9000 % 390 AS INTEGER)), {_CLOCK}) AS due FROM events JOIN cal ON i = event_id % 9000 // 390")
def calendar_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When a number of trading minutes is over."""
    rows = b.read(spark, sf_dir, "events").select("event_id", (F.col("event_id") % 9000).alias("m"))
    return after_market_minutes(rows, "m", _sessions(spark)).select("event_id", F.date_format("due", "yyyy-MM-dd HH:mm:ss").alias("due"))


@register("calendar_publish", b.with_(_SESSIONS) + f"SELECT event_id, strftime(s + INTERVAL 16 HOUR, {_CLOCK}) AS published FROM events ASOF JOIN cal ON CAST(ts AS DATE) < s")
def calendar_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When a vendor's file of a day is out."""
    rows = b.read(spark, sf_dir, "events").select("event_id", F.col("ts").cast("date").alias("day"))
    return publish_time(rows, "day", _sessions(spark), "at").select("event_id", F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("published"))


@register("calendar_label_availability", b.with_(_SESSIONS, "k AS (SELECT event_id, i + 5 AS i FROM events ASOF JOIN cal ON CAST(ts AS DATE) >= s)") + f"SELECT event_id, strftime(s + INTERVAL 21 HOUR + INTERVAL 1 MINUTE, {_CLOCK}) AS available FROM k JOIN cal USING (i)")
def calendar_label_availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When a label of five sessions may first be seen."""
    rows = b.read(spark, sf_dir, "events").select("event_id", F.col("ts").cast("date").alias("day"))
    return label_availability(rows, "day", _sessions(spark), 5, 60, "at").select("event_id", F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("available"))


@register("scalar_json_chain", "SELECT o_orderkey AS id, CAST(i AS INTEGER) AS nth, round(o_totalprice + i, 2) AS strike FROM orders, (VALUES (1), (2), (3)) v(i) WHERE o_orderkey % 4 <> 3")
def scalar_json_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contracts of JSON chains, bare and nested; bad JSON gives none."""
    one = lambda i: F.struct(F.lit(f"X{i}").alias("occ_symbol"), F.round(F.col("o_totalprice") + i, 2).alias("strike"))
    bare = F.to_json(F.array(one(1), one(2), one(3)))
    chain = F.when(F.col("o_orderkey") % 4 == 3, F.lit("{broken")).when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit('{"data":{"contracts":'), bare, F.lit("}}"))).otherwise(bare)
    rows = explode_chain(b.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), chain.alias("chain_json")))
    return rows.select("id", F.substring("occ_symbol", 2, 1).cast("int").alias("nth"), "strike")


@register("stream_ingested", "SELECT 'silver' AS layer, CAST(event_id AS VARCHAR) AS id FROM events WHERE event_id % 20 <> 7 UNION ALL SELECT 'errors', 'missing_feed' FROM events WHERE event_id % 40 = 7 UNION ALL SELECT 'errors', 'bad_json' FROM events WHERE event_id % 40 = 27 UNION ALL SELECT 'bronze', CAST(count(*) + count(*) FILTER (WHERE event_id % 20 = 0) AS VARCHAR) FROM events")
def stream_ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events streamed as JSON lines in two files, every twentieth twice: what reached Silver, the errors, and Bronze's number of lines."""
    root = shared_folder(spark, "stream")
    time = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    fields = F.struct(F.col("event_id").cast("string").alias("event_id"), F.lit("p").alias("provider"), F.when(F.col("event_id") % 40 != 7, F.col("event_type")).alias("feed"), F.concat(F.lit("equity:U"), "user_id").alias("instrument_key"), time.alias("ts_event"), time.alias("ts_ingest"))
    line = F.when(F.col("event_id") % 40 == 27, F.lit("nonsense")).otherwise(F.to_json(fields)).alias("value")
    lines = b.read(spark, sf_dir, "events").select("event_id", line)
    lines.select("value").coalesce(1).write.text(f"{root}/in/1")
    lines.where("event_id % 20 = 0").select("value").coalesce(1).write.text(f"{root}/in/2")
    stream = spark.readStream.option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).text(f"{root}/in")
    ingest.run(stream, f"{root}/out", now="2030-01-01 00:00:00").awaitTermination()
    silver = spark.read.parquet(f"{root}/out/silver").select(F.lit("silver").alias("layer"), F.col("event_id").alias("id"))
    errors = spark.read.parquet(f"{root}/out/errors").select(F.lit("errors").alias("layer"), F.col("error").alias("id"))
    bronze = spark.read.text(f"{root}/out/bronze").agg(F.lit("bronze").alias("layer"), F.count("*").cast("string").alias("id"))
    return silver.unionByName(errors).unionByName(bronze)


@register("stream_watched", "WITH p AS (SELECT user_id AS alert_id, ts, event_id, value + 1 AS price, row_number() OVER w AS n, first_value(value + 1) OVER w AS entry FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), m AS (SELECT *, (price - entry) / entry AS move FROM p WHERE n > 1), h AS (SELECT *, row_number() OVER (PARTITION BY alert_id ORDER BY ts, event_id) AS k FROM m WHERE move >= 0.5 OR move <= -0.5) SELECT alert_id, CASE WHEN move >= 0.5 THEN 'hit_tp' ELSE 'hit_sl' END AS outcome, n - 1 AS n_prices FROM h WHERE k = 1")
def stream_watched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Barrier outcomes of a watch per user over a stream of prices; those that touch nothing within the stream are still open."""
    root = shared_folder(spark, "stream")
    rows = b.read(spark, sf_dir, "events").select(F.col("user_id").alias("alert_id"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").cast("int").alias("seq"), (F.col("value") + 1).alias("price"), F.lit(True).alias("is_call"), F.lit("2025-01-01 00:00:00").cast("timestamp").alias("window_end"))
    rows.write.parquet(f"{root}/in")
    out = watch.watch(spark.readStream.schema(rows.schema).parquet(f"{root}/in"), 0.5, 0.5)
    query = out.writeStream.option("checkpointLocation", f"{root}/c").foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{root}/out/batch={n}"))
    query.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/out").select("alert_id", "outcome", "n_prices")
