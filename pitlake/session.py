"""The session settings that every plan of this library relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Settings that change results or plans; sizes and masters are left to the caller.
PINNED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def pin(spark: SparkSession) -> SparkSession:
    """Set the pinned settings on an existing session."""
    for key, value in PINNED.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int = 8, shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("pitlake")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in PINNED.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, tag: str) -> str:
    """A new folder's name in the folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only where that is unset in local mode, as in tests, a temporary folder is used.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = f"file://{tempfile.mkdtemp(prefix='pitlake-')}"
    return f"{root.rstrip('/')}/pitlake/{tag}-{uuid.uuid4().hex}"
