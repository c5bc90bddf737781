"""What a lake holds, and which instruments there are, as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlake.functions.scalars import version_order
from pitlake.sources.layout import Store, data_files


def _keyed(store: Store, path: str, key: str) -> list[tuple[str, str]]:
    """(value, path) of the folders ``key=value`` of a folder."""
    if not store.exists(path):
        return []
    named = [(p.rstrip("/").rsplit("/", 1)[-1], p) for p, folder, _ in store.children(path) if folder]
    return [(n.split("=", 1)[1], p) for n, p in named if n.startswith(key + "=")]


def datasets(spark: SparkSession, root: str) -> DataFrame:
    """(layer, dataset, project, version, newest) of the Silver feeds, features and labels under a root."""
    store = Store(spark, root)
    rows: list[tuple[str, str, str | None, str | None, bool]] = [("silver", feed, None, None, True) for feed, _ in _keyed(store, f"{root}/silver", "feed")]
    for name, path in _keyed(store, f"{root}/gold", "dataset"):
        for key, layer in (("project", "gold"), ("type", "label")):
            for project, inner in _keyed(store, path, key):
                versions = sorted((v for v, _ in _keyed(store, inner, "version")), key=version_order, reverse=True)
                rows += [(layer, name, project if layer == "gold" else None, v, i == 0) for i, v in enumerate(versions)]
    return spark.createDataFrame(rows, "layer string, dataset string, project string, version string, newest boolean")


def coverage(spark: SparkSession, root: str, layer: str = "silver", key: str = "feed") -> DataFrame:
    """(dataset, first_dt, last_dt, n_dt, n_files, bytes) per dataset of a layer, from listings alone."""
    store = Store(spark, root)
    rows = []
    for name, path in _keyed(store, f"{root}/{layer}", key):
        files = data_files(spark, path)
        days = sorted({p[3:] for f in files for p in f.path.split("/") if p.startswith("dt=")})
        rows.append((name, days[0] if days else None, days[-1] if days else None, len(days), len(files), sum(f.size for f in files)))
    return spark.createDataFrame(rows, "dataset string, first_dt string, last_dt string, n_dt int, n_files int, bytes long")


def search_instruments(instruments: DataFrame, kind: str | None = None, prefix: str | None = None, limit: int = 100) -> DataFrame:
    """Instruments of a kind whose symbol begins with a prefix, whatever its case, in the order of their symbols; the limit is the feature."""
    rows = instruments if kind is None else instruments.where(F.col("instrument_type") == kind)
    if prefix:
        rows = rows.where(F.lower("canonical_symbol").startswith(prefix.lower()))
    return rows.orderBy("canonical_symbol").limit(limit)


def lookup_instruments(instruments: DataFrame, symbols: Sequence[str]) -> DataFrame:
    """Instruments of the given symbols."""
    return instruments.where(F.col("canonical_symbol").isin(list(symbols)))
