"""Streaming ingestion: parse, gate, deduplicate, and write Bronze, Silver and errors from one batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from pitlake.sources.layout import Store

ENVELOPE = (
    "event_id string, provider string, feed string, source string, instrument_type string, instrument_key string, "
    "symbol string, ts_event timestamp, ts_ingest timestamp, ts_available timestamp, payload string"
)
REQUIRED = ("event_id", "provider", "feed", "instrument_key", "ts_event", "ts_ingest")


def parse(lines: DataFrame, now: str | None = None, ahead_seconds: int = 3600) -> DataFrame:
    """JSON lines (``value``) to envelopes with an ``error``: bad_json, missing_<field>, future_event or null."""
    rows = lines.select(F.from_json("value", ENVELOPE).alias("e"), "value").select("e.*", "value")
    error = F.when(F.coalesce(*[F.col(c).cast("string") for c in REQUIRED]).isNull(), "bad_json")
    for name in REQUIRED:
        error = error.when(F.col(name).isNull(), f"missing_{name}")
    clock = F.lit(now).cast("timestamp") if now else F.current_timestamp()
    error = error.when(F.col("ts_event") > clock + F.make_dt_interval(secs=F.lit(ahead_seconds)), "future_event")
    return rows.withColumn("error", error)


def available(envelopes: DataFrame) -> DataFrame:
    """Availability filled in and never before the event."""
    return envelopes.withColumn("ts_available", F.greatest(F.coalesce("ts_available", "ts_ingest"), "ts_event"))


def _day(time: str) -> Column:
    return F.date_format(time, "yyyy-MM-dd")


def unseen_events(batch: DataFrame, silver: str, number: int) -> DataFrame:
    """The first of each event id of a batch that no earlier batch brought, however late it comes.

    An id stands for one event, and so for one day: ids are compared within the days that
    the batch has rows of, and only these partitions of Silver are read, no column but the id.
    """
    spark = batch.sparkSession
    first = F.row_number().over(Window.partitionBy("event_id").orderBy("ts_ingest", "value"))
    rows = batch.withColumn("dt", _day("ts_event")).withColumn("_nth", first).where("_nth = 1").drop("_nth")
    store = Store(spark, silver)
    if not store.exists(silver) or not any(folder for _, folder, _ in store.children(silver)):
        return rows
    days = [r["dt"] for r in rows.select("dt").distinct().collect()]  # days of the calendar
    kept = [p for p, folder, _ in store.children(silver) if folder and "/batch=" in p and not p.endswith(f"/batch={number}")]
    folders = [f"{p}/dt={d}" for p in kept for d in days if store.exists(f"{p}/dt={d}")]
    if not folders:
        return rows
    return rows.join(spark.read.schema("event_id string").parquet(*folders), "event_id", "left_anti")


def write_layers(root: str) -> Callable[[DataFrame, int], None]:
    """A batch writer: every line to Bronze, good ones that are new to Silver, others to errors.

    Bronze is written before anything is sorted out, so it holds every line, repeated ones
    too. Each batch has its own folder in each layer and overwrites it, so a batch that is
    run again changes nothing.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        batch.select("value").write.mode("overwrite").option("compression", "gzip").text(f"{root}/bronze/batch={number}")
        good = available(unseen_events(batch.where("error IS NULL"), f"{root}/silver", number)).drop("error", "value")
        good.write.mode("overwrite").partitionBy("dt").parquet(f"{root}/silver/batch={number}")
        batch.where("error IS NOT NULL").select("error", "feed", "value").write.mode("overwrite").parquet(f"{root}/errors/batch={number}")
        batch.unpersist()

    return write


def run(lines: DataFrame, root: str, now: str | None = None) -> StreamingQuery:
    """Ingest all that is available, then stop; the checkpoint is the acknowledgement.

    There is no watermark: late rows are accepted like others and stored under the day of
    their event. How much a batch takes is set on the source (``maxFilesPerTrigger``).
    """
    query = parse(lines, now).writeStream.foreachBatch(write_layers(root)).option("checkpointLocation", f"{root}/_checkpoint")
    return query.trigger(availableNow=True).start()


def reprocess(spark: SparkSession, root: str, name: str, now: str | None = None, feeds: list[str] | None = None, repair: Callable[[DataFrame], DataFrame] | None = None) -> dict[str, int]:
    """Run failed lines again, as a batch of their own; how many were ``read``, ``recovered`` and ``failed`` again.

    ``repair`` may change ``value`` before. Lines that pass go to Silver as ``batch=<name>``, those that
    fail again to a folder of that name under ``retried``; errors themselves stay until they are purged.
    """
    errors = spark.read.parquet(f"{root}/errors")
    errors = errors if feeds is None else errors.where(F.col("feed").isin(feeds))
    lines = errors.select("value")
    rows = parse(repair(lines) if repair else lines, now).persist()
    good = available(unseen_events(rows.where("error IS NULL"), f"{root}/silver", name)).drop("error", "value")
    good.write.mode("overwrite").partitionBy("dt").parquet(f"{root}/silver/batch={name}")
    rows.where("error IS NOT NULL").select("error", "feed", "value").write.mode("overwrite").parquet(f"{root}/retried/batch={name}")
    tally = rows.agg(F.count("*").alias("n"), F.count_if(F.col("error").isNull()).alias("good")).first()
    rows.unpersist()
    return {"read": tally["n"], "recovered": tally["good"], "failed": tally["n"] - tally["good"]}


def purge(spark: SparkSession, root: str, before: int) -> int:
    """Remove the errors of batches before a number; how many batches there were."""
    store = Store(spark, f"{root}/errors")
    old = [p for p, folder, _ in store.children(f"{root}/errors") if folder and p.rsplit("=", 1)[-1].isdigit() and int(p.rsplit("=", 1)[-1]) < before]
    for p in old:
        store.delete(p)
    return len(old)
