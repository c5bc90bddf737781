"""Queries that write a lake out of the driver's tables and read it through the library."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlake.plans import bindings as b
from pitlake.plans.catalog import register
from pitlake.session import shared_folder
from pitlake.sources import reader, writer
from pitlake.sources.layout import data_files, prune
from pitlake.sources.reader import Lake

YEAR = ("1997-01-01 00:00:00", "1997-12-31 00:00:00")
ASOF = "1999-06-30 00:00:00"


def _text(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


def _monthly(bars: DataFrame) -> DataFrame:
    """Bars moved to the first day of their month, so that a lake of small tables has some dozens of partitions."""
    first = F.date_trunc("month", "ts_event")
    clock = F.col("ts_event") - F.date_trunc("day", "ts_event")
    return bars.withColumns({"ts_event": first + clock, "ts_available": first + clock + F.make_dt_interval(hours=F.lit(30 * 24))})


_MONTHLY = """monthly AS (SELECT * REPLACE (date_trunc('month', ts_event) + (ts_event - date_trunc('day', ts_event)) AS ts_event,
  date_trunc('month', ts_event) + (ts_event - date_trunc('day', ts_event)) + to_days(30) AS ts_available) FROM bars)"""


def _silver(spark: SparkSession, sf_dir: str) -> tuple[Lake, str]:
    """A lake with the feed ``bars``."""
    root = shared_folder(spark, "lake")
    rows = _monthly(b.bars(spark, sf_dir)).select(
        F.col("seq").cast("string").alias("event_id"), "instrument_key", F.lit("equity").alias("instrument_type"), "ts_event", F.col("ts_event").alias("ts_ingest"),
        "ts_available", "timeframe", "close", "volume",
    )
    writer.write_silver(rows, root, "bars")
    return Lake(spark, root), root


@register("lake_silver_scan", b.with_(b.BARS, _MONTHLY) + f"""SELECT instrument_key, strftime(ts_event, '%Y-%m-%d %H:%M:%S') AS ts_event, round(close, 4) AS close FROM monthly
  WHERE ts_event BETWEEN TIMESTAMP '{YEAR[0]}' AND TIMESTAMP '{YEAR[1]}' AND timeframe = '1Day' AND instrument_key IN ('equity:S1', 'equity:S2', 'equity:S3')""")
def lake_silver_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Range, keys, timeframe and projection of a stored feed; a feed that is not there adds nothing."""
    lake, _ = _silver(spark, sf_dir)
    found = lake.silver("bars", YEAR, ["equity:S1", "equity:S2", "equity:S3"], "equity", timeframe="1Day", columns=["close"])
    assert lake.silver("quotes").isEmpty()
    return found.select("instrument_key", _text("ts_event"), F.round("close", 4).alias("close"))


@register("lake_asof_scan", b.with_(b.BARS, _MONTHLY) + f"SELECT instrument_key, count(*) AS n, strftime(max(ts_available), '%Y-%m-%d %H:%M:%S') AS seen FROM monthly WHERE ts_available <= TIMESTAMP '{ASOF}' GROUP BY 1")
def lake_asof_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored rows that were available at a time."""
    lake, _ = _silver(spark, sf_dir)
    seen = lake.asof("bars", ASOF).groupBy("instrument_key").agg(F.count("*").alias("n"), F.max("ts_available").alias("seen"))
    return seen.select("instrument_key", "n", _text("seen"))


@register("lake_partition_counts", b.with_(b.BARS, _MONTHLY) + "SELECT CAST(CAST(ts_event AS DATE) AS VARCHAR) AS dt, count(*) AS n_rows FROM monthly GROUP BY 1")
def lake_partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per stored partition; no data column is read."""
    _, root = _silver(spark, sf_dir)
    return reader.partition_counts(spark, f"{root}/silver/feed=bars")


@register("lake_batched_scan", b.with_(b.BARS, _MONTHLY) + "SELECT CAST(CAST(ts_event AS DATE) AS VARCHAR) AS dt, round(sum(close), 2) AS total FROM monthly WHERE ts_event >= TIMESTAMP '1997-01-01' AND ts_event < TIMESTAMP '1997-07-01' GROUP BY 1")
def lake_batched_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scan of half a year taken partition by partition."""
    lake, _ = _silver(spark, sf_dir)
    scan = lake.silver("bars", ("1997-01-01 00:00:00", "1997-06-30 23:59:59"))
    out = None
    for dt, part in reader.batches(scan):
        one = part.agg(F.lit(dt).alias("dt"), F.round(F.sum("close"), 2).alias("total"))
        out = one if out is None else out.unionByName(one)
    return out


def _gold(spark: SparkSession, sf_dir: str) -> tuple[Lake, str]:
    """A lake with two versions of a feature of snapshots, the older one doubled."""
    root = shared_folder(spark, "lake")
    snaps = b.snaps(spark, sf_dir).select("instrument_key", F.date_trunc("year", "ts_event").alias("ts_event"), "ts_available", "level", "seq")
    writer.write_gold(snaps.withColumn("level", F.col("level") * 2), root, "levels", "p", "1.2.0")
    writer.write_gold(snaps, root, "levels", "p", "1.10.0", {"of": "snapshots"})
    return Lake(spark, root), root


_YEARLY = "yearly AS (SELECT * REPLACE (date_trunc('year', ts_event) AS ts_event) FROM snaps)"


@register("lake_gold_scan", b.with_(b.SNAPS, _YEARLY) + f"SELECT seq, round(level, 2) AS level FROM yearly WHERE ts_event BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1999-12-31' AND ts_available <= TIMESTAMP '{ASOF}'")
def lake_gold_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest version of a feature, pruned by day, as of a time."""
    lake, _ = _gold(spark, sf_dir)
    found = lake.gold("levels", "p", time_range=("1997-01-01 00:00:00", "1999-12-31 00:00:00"), asof=ASOF, prune_by_dt=True)
    return found.select("seq", F.round("level", 2).alias("level"))


@register("lake_gold_versions", "SELECT * FROM (VALUES (0, '1.10.0'), (1, '1.2.0')) v(place, version)")
def lake_gold_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of a dataset, the newest first."""
    _, root = _gold(spark, sf_dir)
    return spark.createDataFrame(list(enumerate(reader.versions(spark, f"{root}/gold/dataset=levels/project=p"))), "place int, version string")


@register("lake_unified_scan", """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_custkey AS DOUBLE) ELSE round(o_totalprice, 2) END AS measure, CASE WHEN o_orderkey % 3 = 2 THEN o_orderstatus END AS status FROM orders""")
def lake_unified_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose measure is whole or not, and of which some have one column more, as one table."""
    root = shared_folder(spark, "lake") + "/t"
    orders = b.read(spark, sf_dir, "orders")
    parts = (
        orders.where("o_orderkey % 3 = 0").selectExpr("o_orderkey AS id", "cast(o_custkey AS bigint) AS measure"),
        orders.where("o_orderkey % 3 = 1").selectExpr("o_orderkey AS id", "round(o_totalprice, 2) AS measure"),
        orders.where("o_orderkey % 3 = 2").selectExpr("o_orderkey AS id", "round(o_totalprice, 2) AS measure", "o_orderstatus AS status"),
    )
    for i, part in enumerate(parts):
        part.coalesce(1).write.parquet(f"{root}/dt=2024-01-0{i + 1}")
    return reader.read_unified(spark, root).select("id", "measure", "status")


@register("lake_label_scan", b.with_(b.SNAPS) + f"SELECT seq, round(level, 2) AS level FROM snaps WHERE ts_available <= TIMESTAMP '{ASOF}'")
def lake_label_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored labels as of a time."""
    root = shared_folder(spark, "lake")
    writer.write_label(b.snaps(spark, sf_dir).select("instrument_key", "ts_event", "ts_available", "level", "seq"), root, "levels", "1.0.0", {"horizon": "5d"})
    return Lake(spark, root).label("levels", ASOF).select("seq", F.round("level", 2).alias("level"))


@register("lake_bronze_scan", "SELECT event_id, round(value, 4) AS value FROM events WHERE event_id % 50 <> 0 UNION ALL SELECT -1, count(*) FROM events WHERE event_id % 50 = 0")
def lake_bronze_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gzipped JSON lines written and read again; lines that are no JSON are counted under -1."""
    path = shared_folder(spark, "bronze")
    events = b.read(spark, sf_dir, "events").select("event_id", F.round("value", 4).alias("value"))
    line = F.when(F.col("event_id") % 50 == 0, F.lit("{broken")).otherwise(F.to_json(F.struct("event_id", "value")))
    events.select(line.alias("value")).write.option("compression", "gzip").text(path)
    good, bad = reader.bronze(spark, path, "event_id long, value double", salvage=True)
    return good.unionByName(bad.agg(F.lit(-1).cast("long").alias("event_id"), F.count("*").cast("double").alias("value")))


@register("lake_bronze_layers", "SELECT event_type AS feed, CAST(CAST(ts AS DATE) AS VARCHAR) AS dt, count(*) AS n FROM events GROUP BY 1, 2")
def lake_bronze_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze by provider, feed and day."""
    path = shared_folder(spark, "bronze")
    rows = b.read(spark, sf_dir, "events").selectExpr("event_id", "ts AS ts_event", "event_type AS feed", "'p' AS provider", "value")
    writer.write_bronze(rows, path)
    return spark.read.schema("event_id long, provider string, feed string, dt string").json(path).groupBy("feed", "dt").agg(F.count("*").alias("n"))


@register("lake_vendor_bars", "SELECT 'S' || l_suppkey AS ticker, l_orderkey * 10 + l_linenumber AS transactions, round(l_extendedprice, 2) AS close, epoch_us(l_shipdate) AS us FROM lineitem")
def lake_vendor_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendor bars in gzipped CSV with nanosecond times."""
    from pitlake.operators.asof import micros

    path = shared_folder(spark, "vendor")
    price = "round(l_extendedprice, 2)"
    rows = b.read(spark, sf_dir, "lineitem").selectExpr("concat('S', l_suppkey) AS ticker", "l_quantity AS volume", f"{price} AS open", f"{price} AS close", f"{price} AS high", f"{price} AS low", "l_shipdate", "l_orderkey * 10 + l_linenumber AS transactions")
    rows = rows.withColumn("window_start", micros("l_shipdate") * 1000).select(*reader.VENDOR)
    rows.write.option("compression", "gzip").option("header", "true").csv(path)
    return reader.vendor_csv(spark, path).select("ticker", "transactions", "close", micros("ts_event").alias("us"))


@register("lake_compacted", b.with_(b.DUPLICATED) + "SELECT event_id, round(value, 4) AS value FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts_ingest) AS nth FROM duplicated) WHERE nth = 1")
def lake_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A partition of several appended files, compacted, appended to again, compacted and pruned."""
    path = shared_folder(spark, "lake") + "/dt=2024-01-01"
    rows = b.duplicated(spark, sf_dir)
    rows.where("event_id % 10 <> 0").write.parquet(path)
    rows.where("event_id % 20 = 0").write.mode("append").parquet(path)
    writer.compact(spark, path)
    rows.where("event_id % 20 = 10").write.mode("append").parquet(path)
    writer.compact(spark, path)
    prune(spark, path)
    return reader.read_unified(spark, path).select("event_id", F.round("value", 4).alias("value"))


@register("lake_promoted", b.with_(b.DUPLICATED) + "SELECT event_id, round(value, 4) AS value FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts_ingest DESC) AS nth FROM duplicated) WHERE nth = 1")
def lake_promoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A back-fill promoted into a partition: what arrived last stays."""
    root = shared_folder(spark, "lake")
    rows = b.duplicated(spark, sf_dir)
    rows.where("hour(ts_ingest) % 2 = 0").write.parquet(f"{root}/dt=2024-01-01")
    rows.where("hour(ts_ingest) % 2 = 1").write.parquet(f"{root}/backfill")
    writer.promote(spark, f"{root}/dt=2024-01-01", f"{root}/backfill")
    return reader.read_unified(spark, f"{root}/dt=2024-01-01").select("event_id", F.round("value", 4).alias("value"))


@register("lake_upserted", "SELECT o_orderkey, o_orderstatus, round(o_totalprice, 2) AS price FROM orders WHERE o_orderkey % 5 <> 0 UNION ALL SELECT o_orderkey, 'X', round(o_totalprice * 2, 2) FROM orders WHERE o_orderkey % 5 = 0")
def lake_upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes put into a stored partition."""
    path = shared_folder(spark, "lake") + "/dt=2024-01-01"
    orders = b.read(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.round("o_totalprice", 2).alias("price"))
    orders.write.parquet(path)
    new = b.read(spark, sf_dir, "orders").where("o_orderkey % 5 = 0").select("o_orderkey", F.lit("X").alias("o_orderstatus"), F.round(F.col("o_totalprice") * 2, 2).alias("price"))
    writer.upsert_partition(spark, path, new, ["o_orderkey"])
    return reader.read_unified(spark, path)


@register("lake_quarantined", "SELECT CASE WHEN o_orderkey % 11 = 0 AND o_orderstatus <> 'P' THEN 'quarantined' ELSE 'kept' END AS side, o_orderkey FROM orders")
def lake_quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad rows written aside, where no scan sees them, and the rest."""
    root = shared_folder(spark, "lake")
    rows = b.read(spark, sf_dir, "orders").selectExpr("o_orderkey", "CASE WHEN o_orderkey % 11 <> 0 THEN 1.0D END AS delta", "CASE WHEN o_orderstatus = 'P' THEN array('no_greeks') END AS quality_flags")
    bad = F.col("delta").isNull() & ~F.coalesce(F.array_contains("quality_flags", "no_greeks"), F.lit(False))
    writer.write_quarantine(rows, bad, root, "greeks").write.parquet(f"{root}/data")
    assert all("_quarantine" not in f.path for f in data_files(spark, root))
    kept = reader.read_unified(spark, root).select(F.lit("kept").alias("side"), "o_orderkey")
    return kept.unionByName(spark.read.parquet(f"{root}/_quarantine/greeks").select(F.lit("quarantined").alias("side"), "o_orderkey"))


@register("lake_materialised", b.with_(b.ALERTS) + "SELECT instrument_key, event_id, round(premium, 4) AS premium FROM alerts QUALIFY row_number() OVER (PARTITION BY instrument_key ORDER BY ts_event DESC, event_id DESC) = 1")
def lake_materialised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An online store filled with what there was on the 15th, then brought up to date."""
    path = shared_folder(spark, "lake") + "/store"
    rows = b.alerts(spark, sf_dir).select("instrument_key", "event_id", "premium", "ts_event")
    writer.materialise(rows.where("ts_event <= timestamp_ntz'2024-01-15 00:00:00'"), path, "instrument_key", "ts_event", tiebreak=["event_id"])
    found = writer.materialise(rows, path, "instrument_key", "ts_event", since="2024-01-15 00:00:00", tiebreak=["event_id"])
    return found.select("instrument_key", "event_id", F.round("premium", 4).alias("premium"))


@register("lake_salvaged_rows", "SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'type_error: price' WHEN event_id % 4 = 1 THEN 'type_error: price,day' ELSE '' END AS error FROM events")
def lake_salvaged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of texts that convert to a schema, and those that do not, with why."""
    rows = b.read(spark, sf_dir, "events").selectExpr("event_id", "CASE WHEN event_id % 4 < 2 THEN 'n/a' ELSE cast(value AS string) END AS price", "CASE WHEN event_id % 4 = 1 THEN 'never' ELSE '2024-01-02' END AS day", "'x' AS more")
    good, bad = writer.convertible(rows, "event_id long, price double, day date, absent string")
    return good.select("event_id", F.lit("").alias("error")).unionByName(bad.select("event_id", "error"))


@register("lake_ledgers", """SELECT 'one' AS ledger, CAST(o_orderkey AS VARCHAR) AS watch_id, o_orderstatus AS status, NULL::DOUBLE AS mfe FROM orders WHERE o_orderkey % 2 = 0 AND o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'
  UNION ALL SELECT 'two', CAST(o_orderkey AS VARCHAR), NULL, round(o_totalprice, 2) FROM orders WHERE o_orderkey % 2 = 1 AND o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'""")
def lake_ledgers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledgers of unlike columns as one table, within dates."""
    orders = b.read(spark, sf_dir, "orders")
    one = orders.where("o_orderkey % 2 = 0").selectExpr("o_orderkey AS watch_id", "o_orderstatus AS status", "o_orderdate AS closed_at")
    two = orders.where("o_orderkey % 2 = 1").selectExpr("o_orderkey AS watch_id", "round(o_totalprice, 2) AS mfe", "o_orderdate AS closed_at", "1 AS more")
    return reader.ledgers(spark, {"one": one, "two": two}, "1997-01-01 00:00:00", "1999-01-01 00:00:00").select("ledger", "watch_id", "status", "mfe")


@register("lake_schema_changes", "SELECT * FROM (VALUES ('added', 'status', NULL, 'string'), ('changed', 'measure', 'bigint', 'double'), ('removed', 'day', 'timestamp_ntz', NULL)) v(kind, name, before, after)")
def lake_schema_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the schema of a partition differs from the one before; equal schemas have equal fingerprints."""
    root = shared_folder(spark, "lake")
    orders = b.read(spark, sf_dir, "orders")
    orders.selectExpr("o_orderkey AS id", "cast(o_custkey AS bigint) AS measure", "o_orderdate AS day").write.parquet(f"{root}/dt=2024-01-01")
    orders.selectExpr("o_orderkey AS id", "o_totalprice AS measure", "o_orderstatus AS status").write.parquet(f"{root}/dt=2024-01-02")
    orders.selectExpr("o_orderstatus AS status", "o_totalprice AS measure", "o_orderkey AS id").write.parquet(f"{root}/dt=2024-01-03")
    prints = [reader.partition_fingerprint(spark, f"{root}/dt=2024-01-0{i}") for i in (1, 2, 3)]
    assert prints[0] != prints[1] == prints[2]
    types = lambda i: {f.name: f.dataType.simpleString() for f in spark.read.parquet(f"{root}/dt=2024-01-0{i}").schema}
    return spark.createDataFrame(reader.schema_changes(types(1), types(2)), "kind string, name string, before string, after string")
