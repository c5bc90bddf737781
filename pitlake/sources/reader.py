"""Scans: path scoping, schema unification, versions and point-in-time filters."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException as SparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitlake.functions.scalars import version_order
from pitlake.sources.layout import data_files

ALWAYS = ("ts_event", "ts_available", "instrument_key")


class ReadError(RuntimeError):
    """Data that should be there can't be read; never the same as no data."""


def predicate(name: str, op: str, value) -> Column | None:
    """One comparison; None for an unknown operator."""
    c = F.col(name)
    return {
        "=": lambda: c == value, "==": lambda: c == value, "!=": lambda: c != value, "<": lambda: c < value, "<=": lambda: c <= value,
        ">": lambda: c > value, ">=": lambda: c >= value, "in": lambda: c.isin(list(value)),
    }.get(op, lambda: None)()


def apply_filters(df: DataFrame, filters: Sequence[tuple]) -> DataFrame:
    """All comparisons, joined by AND; unknown columns and operators are skipped."""
    found = [p for n, o, v in filters if n in df.columns and (p := predicate(n, o, v)) is not None]
    return df.where(reduce(lambda a, b: a & b, found)) if found else df


def merged_type(a: T.DataType, b: T.DataType, name: str) -> T.DataType:
    """The type that a column of two files is read as, or an error."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    kinds = (T.TimestampType, T.TimestampNTZType)
    if isinstance(a, kinds) and isinstance(b, kinds):
        if name in ("ts_event", "ts_label", "ts_available", "instrument_key"):
            raise ReadError(f"{name}: times with and without zone")
        return T.TimestampType()
    if any(isinstance(x, T.DecimalType) for x in (a, b)) or any(isinstance(x, T.StringType) for x in (a, b)):
        raise ReadError(f"{name}: {a.simpleString()} and {b.simpleString()} can't be unified")
    if any(isinstance(x, T.FractionalType) for x in (a, b)):
        return T.DoubleType()
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(merged_type(a.elementType, b.elementType, name))
    raise ReadError(f"{name}: {a.simpleString()} and {b.simpleString()} can't be unified")


def _compatible(spark: SparkSession, root: str, files: list[str]) -> list[DataFrame]:
    """One scan per run of files whose schemas Spark merges by itself.

    Spark merges footers in a job of its own. Files that conflict are halved: schemas change
    over time, so a change costs a logarithmic number of attempts.
    """
    try:
        return [spark.read.option("basePath", root).option("mergeSchema", "true").parquet(*files)]
    except (AnalysisException, SparkException, Py4JJavaError) as error:
        if "CANNOT_MERGE" not in str(error) or len(files) == 1:
            raise ReadError(f"{root}: {error}") from error
    half = len(files) // 2
    return _compatible(spark, root, files[:half]) + _compatible(spark, root, files[half:])


def read_unified(spark: SparkSession, root: str, first: str | None = None, last: str | None = None) -> DataFrame | None:
    """All files under a folder as one table; None if there are none.

    Only ``dt=`` folders of the range are listed. Files whose schemas can't be merged are
    scanned apart and cast to the merged types; columns that a scan lacks are null. Empty
    files alone mean a failed write and are an error.
    """
    every = data_files(spark, root, first, last)
    files = [f.path for f in every if f.size]
    if not files:
        if every:
            raise ReadError(f"{root}: only empty files")
        return None
    scans = _compatible(spark, root, files)
    merged: dict[str, T.DataType] = {}
    for df in scans:
        for field in df.schema:
            merged[field.name] = merged_type(merged[field.name], field.dataType, field.name) if field.name in merged else field.dataType
    typed = [df.select(*[F.col(f"`{f.name}`") if f.dataType == merged[f.name] else F.col(f"`{f.name}`").cast(merged[f.name]).alias(f.name) for f in df.schema]) for df in scans]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), typed)


def batches(df: DataFrame, by: str = "dt") -> Iterator[tuple[str, DataFrame]]:
    """The rows of a scan partition by partition, in order, so that a caller holds one at a time.

    Each is a filter on the partition column: Spark reads that partition's files only.
    """
    for row in df.select(by).distinct().orderBy(by).toLocalIterator():
        yield row[by], df.where(F.col(by).eqNullSafe(row[by]))


def partition_counts(spark: SparkSession, root: str, by: str = "dt") -> DataFrame:
    """Rows per partition, from the footers: no column but the partition's is read."""
    df = read_unified(spark, root)
    if df is None:
        return spark.createDataFrame([], f"{by} string, n_rows long")
    return df.groupBy(by).agg(F.count("*").alias("n_rows"))


def versions(spark: SparkSession, root: str) -> list[str]:
    """Version folders under a dataset, the newest first."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(conf)
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
    return sorted((n.split("=", 1)[1] for n in names if n.startswith("version=")), key=version_order, reverse=True)


class Lake:
    """Reads of Silver, Gold and label data under a root folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _empty(self) -> DataFrame:
        return self.spark.createDataFrame([], "ts_event timestamp_ntz, ts_available timestamp_ntz, instrument_key string")

    def _pruned(self, df: DataFrame, time: str, time_range, keys, asof) -> DataFrame:
        if time_range:
            first, last = (F.lit(t).cast(df.schema[time].dataType) for t in time_range)
            df = df.where(F.col(time).between(first, last))
            if "dt" in df.columns and time == "ts_event":  # sound: dt is the date of ts_event
                df = df.where(F.col("dt").cast("string").between(str(time_range[0])[:10], str(time_range[1])[:10]))
        if keys is not None:
            df = df.where(F.col("instrument_key").isin(list(keys)))
        if asof is not None:
            df = df.where(F.col("ts_available") <= F.lit(asof).cast(df.schema["ts_available"].dataType))
        return df

    def silver(self, feed: str, time_range=None, keys=None, instrument_type: str | None = None, asof=None, columns=None, timeframe: str | None = None) -> DataFrame:
        """Silver scan; a feed that is not there is empty, one that can't be read is an error."""
        path = f"{self.root}/silver/feed={feed}" + (f"/instrument_type={instrument_type}" if instrument_type else "")
        span = (str(time_range[0])[:10], str(time_range[1])[:10]) if time_range else (None, None)
        df = read_unified(self.spark, path, *span)
        if df is None:
            return self._empty()
        df = self._pruned(df, "ts_event", time_range, keys, asof)
        if timeframe is not None:
            df = df.where(F.col("timeframe") == timeframe)
        if columns is not None:
            wanted = sorted({*ALWAYS, *columns} & set(df.columns))
            df = df.select(*wanted)
        return df

    def asof(self, feed: str, asof, **options) -> DataFrame:
        """Silver rows that were available at a time."""
        return self.silver(feed, asof=asof, **options)

    def gold(self, dataset: str, project: str, version: str | None = None, time_range=None, keys=None, asof=None, prune_by_dt: bool = False) -> DataFrame:
        """Gold scan of a version (the newest by default); with ``asof`` the data must carry availability.

        ``prune_by_dt`` lists only the range's ``dt=`` folders; that is sound for data timed by
        ``ts_event``, an error for others.
        """
        base = f"{self.root}/gold/dataset={dataset}/project={project}"
        found = versions(self.spark, base)
        if version is None and not found:
            return self._empty()
        span = (str(time_range[0])[:10], str(time_range[1])[:10]) if prune_by_dt and time_range else (None, None)
        df = read_unified(self.spark, f"{base}/version={version or found[0]}", *span)
        if df is None:
            return self._empty()
        if prune_by_dt and "ts_event" not in df.columns:
            raise ReadError(f"{dataset}: only data timed by ts_event can be pruned by dt")
        if asof is not None and "ts_available" not in df.columns:
            raise ReadError(f"{dataset}: no ts_available, so nothing can be read as of a time")
        time = "ts_event" if "ts_event" in df.columns else "ts_label"
        return self._pruned(df, time, time_range, keys, asof)

    def label(self, dataset: str, asof, version: str | None = None) -> DataFrame:
        """Label scan as of a time."""
        base = f"{self.root}/gold/dataset={dataset}/type=label"
        df = read_unified(self.spark, f"{base}/version={version or versions(self.spark, base)[0]}")
        if df is None or "ts_available" not in df.columns:
            raise ReadError(f"{dataset}: labels without ts_available")
        return df.where(F.col("ts_available") <= F.lit(asof).cast(df.schema["ts_available"].dataType))


def require_columns(df: DataFrame, required: Sequence[str], dataset: str) -> DataFrame:
    """``df``, or an error that names what it lacks."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ReadError(f"{dataset} lacks {missing}")
    return df


def fingerprint(df: DataFrame) -> str:
    """Hash of the sorted (name, type) pairs."""
    return hashlib.sha256(repr(sorted((f.name, f.dataType.simpleString()) for f in df.schema)).encode()).hexdigest()


def partition_fingerprint(spark: SparkSession, path: str) -> str | None:
    """The fingerprint of a partition, of its first data file; None without one."""
    files = [f.path for f in data_files(spark, path) if f.size]
    return fingerprint(spark.read.parquet(files[0])) if files else None


def schema_changes(before: dict[str, str], after: dict[str, str]) -> list[tuple[str, str, str | None, str | None]]:
    """(kind, column, old type, new type) of what was added, removed or changed."""
    out = [("removed", c, t, None) for c, t in before.items() if c not in after] + [("added", c, None, t) for c, t in after.items() if c not in before]
    return sorted(out + [("changed", c, t, after[c]) for c, t in before.items() if c in after and after[c] != t])


def _unpacked(data: bytes) -> tuple[list[str], str]:
    """Whole lines of a gzipped file and its state: good, cut (its end is missing) or bad (its contents are wrong)."""
    reader, out, state = zlib.decompressobj(31), b"", "good"
    if not data.startswith(b"\x1f\x8b"):
        return [], "bad"
    try:
        while data:
            out += reader.decompress(data)
            if not reader.eof:
                state = "cut"
                break
            data = reader.unused_data  # files that were appended to hold several members
            reader = zlib.decompressobj(31)
            if data and not data.startswith(b"\x1f\x8b"):
                return [], "bad"
    except zlib.error:
        return [], "bad"  # a wrong checksum vouches for none of the lines
    text = out.decode("utf-8", "replace")
    lines = text.split("\n")
    return [x for x in (lines if state == "good" else lines[:-1]) if x.strip()], state


def salvaged_lines(spark: SparkSession, path: str, most_bad: float = 0.5) -> DataFrame:
    """(file, value) of gzipped files of lines, damaged ones included.

    Of a file that was cut off all whole lines are kept, of one whose checksum is wrong none. If
    more than ``most_bad`` of the files are damaged the read fails. A file is one row of the
    scan and is unpacked by one task.
    """

    def run(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                lines, state = _unpacked(data)
                yield pa.RecordBatch.from_arrays([pa.array([name] * (len(lines) + 1)), pa.array([state, *lines]), pa.array([True] + [False] * len(lines))], ["file", "value", "about"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").option("recursiveFileLookup", "true").load(path).select("path", "content")
    rows = files.mapInArrow(run, "file string, value string, about boolean")
    tally = rows.where("about").agg(F.count("*").alias("n"), F.count_if(F.col("value") != "good").alias("bad")).first()
    if tally["n"] and tally["bad"] / tally["n"] > most_bad:
        raise ReadError(f"{path}: {tally['bad']} of {tally['n']} files are damaged")
    return rows.where("NOT about").select("file", "value")


def parsed_lines(lines: DataFrame, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of JSON lines in a column ``value``."""
    struct = T._parse_datatype_string(schema).add("_corrupt_record", "string")
    rows = lines.select(F.from_json("value", struct, {"columnNameOfCorruptRecord": "_corrupt_record"}).alias("x"), "value")
    bad = F.col("x").isNull() | F.col("x._corrupt_record").isNotNull()
    return rows.where(~bad).select("x.*").drop("_corrupt_record"), rows.where(bad).select("value")


def bronze(spark: SparkSession, path: str, schema: str, salvage: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of JSON lines, gzipped or not; with ``salvage`` damaged gzip files give what can be trusted of them."""
    lines = salvaged_lines(spark, path) if salvage else spark.read.option("recursiveFileLookup", "true").text(path)
    return parsed_lines(lines.select("value"), schema)


#: The columns of vendor bars, in their order.
VENDOR = {"ticker": "string", "volume": "double", "open": "double", "close": "double", "high": "double", "low": "double", "window_start": "long", "transactions": "long"}


def vendor_csv(spark: SparkSession, path: str, most_rejects: float = 0.005) -> DataFrame:
    """Vendor bars with a fixed header; too many rejected rows fail the query.

    The share of rejects is checked where the rows are used, by a window-free aggregate that
    joins back as one row, so that planning reads nothing but headers.
    """
    raw = spark.read.schema(", ".join(f"{c} string" for c in VENDOR)).csv(path, header=True, enforceSchema=False)
    rows = raw.select(*[F.col(c).try_cast(kind).alias(c) for c, kind in VENDOR.items()])
    bad = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in VENDOR])
    share = rows.agg(F.count("*").alias("_n"), F.count_if(bad).alias("_bad"))
    gate = F.assert_true(F.col("_bad") <= F.col("_n") * most_rejects, F.concat(F.lit(f"{path}: "), F.col("_bad").cast("string"), F.lit(" rows rejected of "), F.col("_n").cast("string")))
    at = F.timestamp_add("MICROSECOND", (F.col("window_start") / 1000).cast("long"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    gated = rows.join(F.broadcast(share), F.coalesce(gate, F.lit(True)))  # one row
    return gated.where(~bad).withColumn("ts_event", at).drop("_n", "_bad")


#: What every ledger gives.
LEDGER = "watch_id string, alert_id string, symbol string, status string, entry_price double, exit_price double, mfe double, mae double, closed_at timestamp_ntz"


def ledgers(spark: SparkSession, tables: dict[str, DataFrame], first: str | None = None, last: str | None = None) -> DataFrame:
    """Rows of several ledgers as one table with their ``ledger``: a fixed projection, missing columns null, closed within the dates.

    A ledger in a database is a ``spark.read.jdbc`` table here, so the projection and the
    dates reach the database.
    """
    kinds = T._parse_datatype_string(LEDGER)
    parts = []
    for name, df in tables.items():
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in kinds]
        part = df.select(F.lit(name).alias("ledger"), *columns)
        if first:
            part = part.where(F.col("closed_at") >= F.lit(first).cast("timestamp_ntz"))
        if last:
            part = part.where(F.col("closed_at") < F.lit(last).cast("timestamp_ntz"))
        parts.append(part)
    return reduce(DataFrame.unionByName, parts)
