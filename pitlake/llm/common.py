"""What the training-data operators share: the shared folder, written tables, and the memory of Python workers."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of rows that reach Python at once, and the setting that bounds them; a longer row comes alone.
BATCH_BYTES, BATCH_SETTING = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only where that is unset in local mode, as in tests, a temporary folder is used instead.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = f"file://{tempfile.mkdtemp(prefix='pitlake-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back: its lineage ends there.

    The files outlive a lost executor, and their size is known to the planner.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/pitlake/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bound what reaches Python at once by bytes, unless the session does so.

    Spark bounds rows only. An executor holds such a batch several times, outside its heap and
    in each Python worker. The setting must stand while a plan runs, so it is left in place.
    """
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def give_back() -> None:
    """Return to the system what this process has freed."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def sparing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` over batches, after which memory is given back: Spark keeps workers for later stages."""

    def ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return ended


def discard(df: DataFrame) -> None:
    """Remove the files of a table made by :func:`written`."""
    spark = df.sparkSession
    root = f"{shared_dir(spark)}/pitlake/"
    plain = root.removeprefix("file:").lstrip("/")
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if plain in folder:
            jvm = spark.sparkContext._jvm
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
