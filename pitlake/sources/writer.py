"""Sinks and maintenance of Silver and Gold data."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitlake.operators.dedupe import earliest, latest, upsert
from pitlake.sources.layout import Store, data_files, data_folder, folder_files, publish
from pitlake.sources.reader import read_unified

REQUIRED = ("instrument_key", "ts_event", "ts_available")


class LeakageError(ValueError):
    """Rows that would have been available before they happened."""


def write_gold(df: DataFrame, root: str, dataset: str, project: str, version: str, metadata: dict | None = None) -> int:
    """Append features, partitioned by the day of their event; returns the number of rows.

    Rows need the three columns of :data:`REQUIRED`, none of them null; a look-ahead row fails the whole
    write. Rows are checked while they are written, into a folder of this write alone, so
    what was checked is what is published, and a failed write leaves nothing behind. An
    empty table writes nothing. Metadata goes into a file beside the data.
    """
    missing = [c for c in REQUIRED if c not in df.columns]
    if missing:
        raise ValueError(f"{dataset} lacks {missing}")
    spark = df.sparkSession
    path = f"{root}/gold/dataset={dataset}/project={project}/version={version}"
    store, write = Store(spark, path), uuid.uuid4().hex
    known = reduce(and_, [F.col(c).isNotNull() for c in REQUIRED])
    good = known & (F.col("ts_available") >= F.col("ts_event"))
    rows = df.withColumn("dt", F.coalesce(F.col("ts_event").cast("date").cast("string"), F.lit("none")))
    staged = f"{path}/_staged-{write}"
    seen = Observation()
    checked = rows.repartition("dt").observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(~F.coalesce(good, F.lit(False))).alias("bad"))
    checked.write.partitionBy("dt").parquet(staged)
    tally = seen.get
    if tally["bad"]:
        store.delete(staged)
        raise LeakageError(f"{dataset}: {tally['bad']} rows lack a key or time, or were available before their event")
    if tally["n"]:
        for folder, is_folder, _ in store.children(staged):
            if is_folder:
                day = folder.rsplit("/", 1)[-1]
                store.make(f"{path}/{day}")
                for file, inner, _ in store.children(folder):
                    if not inner and file.endswith(".parquet"):
                        store.rename(file, f"{path}/{day}/{write}-{file.rsplit('/', 1)[-1]}")
        if metadata is not None:
            store.create(f"{path}/_metadata.json", json.dumps(metadata, sort_keys=True), overwrite=True)
    store.delete(staged)
    return tally["n"]


def write_label(df: DataFrame, root: str, dataset: str, version: str, metadata: dict | None = None) -> None:
    """Replace a label dataset; labels carry their own availability."""
    if "ts_available" not in df.columns:
        raise ValueError(f"{dataset} lacks ts_available")
    path = f"{root}/gold/dataset={dataset}/type=label/version={version}"
    df.write.mode("overwrite").parquet(path)
    Store(df.sparkSession, path).create(f"{path}/_metadata.json", json.dumps(metadata or {}, sort_keys=True), overwrite=True)


def write_silver(df: DataFrame, root: str, feed: str, rows_per_file: int = 1_000_000) -> None:
    """Append normalised rows by instrument type and day; availability is filled and never before the event.

    A partition's rows go to files of ``rows_per_file`` at most; a day with very many rows is
    spread over tasks by its event ids rather than written by one.
    """
    seen = F.greatest(F.coalesce("ts_available", "ts_ingest"), "ts_event")
    rows = df.withColumn("ts_available", seen).withColumn("dt", F.col("ts_event").cast("date").cast("string"))
    rows = rows.hint("rebalance", "instrument_type", "dt")
    out = rows.write.mode("append").option("maxRecordsPerFile", rows_per_file).partitionBy("instrument_type", "dt")
    out.parquet(f"{root}/silver/feed={feed}")


def convertible(rows: DataFrame, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows of the schema, rows that do not convert, with ``error``): a value of the wrong type costs its row, not the batch.

    Columns that are missing are null; those that the schema does not know are dropped.
    """
    kinds = T._parse_datatype_string(schema)
    have = [f for f in kinds if f.name in rows.columns]
    wrong = {f.name: F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull() for f in have}
    bad = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in wrong.items()]))
    marked = rows.withColumn("_wrong", bad)
    typed = [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in kinds]
    good = marked.where(F.size("_wrong") == 0).select(*typed)
    return good, marked.where(F.size("_wrong") > 0).withColumn("error", F.concat(F.lit("type_error: "), F.array_join("_wrong", ","))).drop("_wrong")


def write_bronze(df: DataFrame, path: str) -> None:
    """Append rows as gzipped JSON lines by provider, feed and day."""
    rows = df.withColumn("dt", F.col("ts_event").cast("date").cast("string"))
    rows.write.mode("append").option("compression", "gzip").partitionBy("provider", "feed", "dt").json(path)


def compact(spark: SparkSession, path: str, target_bytes: int = 256 << 20, most_files: int = 1000, most_bytes: int = 50 << 20) -> int:
    """Merge a partition's small files: one row per event id, the one that arrived first; returns the rows of the partition.

    Files of ``most_bytes`` or more stay as they are unless ids must be compared, that is
    where there is an ``event_id``; of very many files the smallest ``most_files`` are merged, the next
    call takes the others. Rows are dealt to files of ``target_bytes`` by their event id, which
    the deduplication uses as it is: one shuffle, and no task holds more than a file.
    """
    files = data_files(spark, path)
    df = read_unified(spark, path)
    if df is None:
        return 0
    identified = "event_id" in df.columns
    chosen = files if identified else sorted((f for f in files if f.size < most_bytes), key=lambda f: f.size)[:most_files]
    parts = max(1, -(-sum(f.size for f in chosen) // target_bytes))
    if identified:
        kept = earliest(df.repartition(parts, "event_id"), "event_id", "ts_ingest")
    elif len(chosen) < 2:
        return df.count()
    else:
        old = data_folder(path, files)
        chosen = sorted({*chosen, *old}, key=lambda f: f.path)  # a manifest names one data folder, so its files go along
        kept = spark.read.option("basePath", path).option("mergeSchema", "true").parquet(*[f.path for f in chosen]).repartition(parts)
    publish(kept, path, chosen)
    return read_unified(spark, path).count()  # from the footers


def promote(spark: SparkSession, canonical: str, backfill: str) -> int:
    """Merge a back-fill into a partition: of an event id the row that arrived last stays."""
    files = data_files(spark, canonical)
    parts = [df for df in (read_unified(spark, canonical), read_unified(spark, backfill)) if df is not None]
    if not parts:
        return 0
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    return spark.read.parquet(*[f.path for f in folder_files(spark, publish(latest(rows, "event_id", "ts_ingest"), canonical, files))]).count()


def upsert_partition(spark: SparkSession, path: str, changes: DataFrame, keys: Sequence[str]) -> None:
    """Replace the rows of a partition that have the changes' keys; a writer that was overtaken fails and can be run again."""
    files = data_files(spark, path)
    base = read_unified(spark, path)
    publish(changes if base is None else upsert(base, changes, keys), path, files)


def write_quarantine(df: DataFrame, bad: Column, root: str, name: str) -> DataFrame:
    """Rows that are bad go to a hidden folder beside the data, which no scan sees; returns the others."""
    hit = F.coalesce(bad, F.lit(False))
    df.where(hit).write.mode("append").parquet(f"{root}/_quarantine/{name}")
    return df.where(~hit)


def materialise(df: DataFrame, path: str, entity: str, time: str, since: str | None = None, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Write the latest row of each entity; with ``since`` only entities with newer rows are replaced. Returns the store's rows.

    The store is a partition like others: it is replaced as a whole, by a manifest.
    """
    spark = df.sparkSession
    fresh = df if since is None else df.where(F.col(time) > F.lit(since).cast(df.schema[time].dataType))
    newest = latest(fresh, entity, time, tiebreak)
    files = data_files(spark, path)
    base = read_unified(spark, path) if since is not None else None
    publish(newest if base is None else upsert(base, newest, [entity]), path, files)
    return read_unified(spark, path)
