"""Scores of a model: training, metrics, buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Columns that are no inputs of a model: identifiers, times, outcomes, texts and provenance.
NOT_FEATURES = (
    "alert_id", "watch_id", "symbol", "underlying", "occ_symbol", "instrument_key",
    "alert_time", "outcome_time", "expiry", "ts_event", "ts_available",
    "outcome", "outcome_return", "meta_label", "hit_tp_first", "mfe", "mae", "bars_to_hit", "trading_minutes_to_hit",
    "alert_type", "side", "aggressor", "put_call", "quality_flags", "label_window_truncated",
)
HIGH, LOW = 0.7, 0.3  # fixed values: where confidence is high, and where it is low


def feature_columns(df: DataFrame) -> list[str]:
    """Columns that a model may learn from, in the table's order."""
    return [c for c in df.columns if c not in NOT_FEATURES]


def confidence(score: Column) -> Column:
    """high, medium or low; null without a score."""
    return F.when(score >= HIGH, "high").when(score >= LOW, "medium").when(score.isNotNull(), "low")


def metrics(df: DataFrame, score: str, label: str, thresholds: Sequence[float] = (0.5, 0.6, 0.7)) -> DataFrame:
    """(metric, value): accuracy, precision and recall at a half, area under the curve, precision at thresholds.

    Rows without a score or label do not count. A precision of nothing is 0; the area is a
    half where one class is missing. The area is the share of pairs that are in order, by
    counts per distinct score: what reaches the unpartitioned window is a row per score.
    """
    rows = df.where(F.col(score).isNotNull() & F.col(label).isNotNull()).select(F.col(score).cast("double").alias("s"), (F.col(label) == 1).cast("long").alias("y"))
    per = rows.groupBy("s").agg(F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
    below = F.coalesce(F.sum("neg").over(Window.partitionBy(F.lit(0)).orderBy("s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    per = per.withColumn("won", F.col("pos").cast("double") * (below + F.col("neg") / 2))
    hit = lambda t, c: F.sum(F.when(F.col("s") >= t, F.col(c)).otherwise(0))
    precision = lambda t: F.coalesce(F.try_divide(hit(t, "pos"), hit(t, "pos") + hit(t, "neg")), F.lit(0.0))
    right = hit(0.5, "pos") + F.sum("neg") - hit(0.5, "neg")
    found = {
        "accuracy": F.try_divide(right, F.sum("pos") + F.sum("neg")),
        "precision": precision(0.5),
        "recall": F.coalesce(F.try_divide(hit(0.5, "pos"), F.sum("pos")), F.lit(0.0)),
        "auc": F.coalesce(F.try_divide(F.sum("won"), F.sum("pos").cast("double") * F.sum("neg")), F.lit(0.5)),
        **{f"precision_at_{round(t * 100)}": precision(t) for t in thresholds},
    }
    parts = F.array(*[F.struct(F.lit(n).alias("metric"), c.alias("value")) for n, c in found.items()])
    return per.agg(parts.alias("found")).select(F.inline("found"))


def scored_and_filtered(df: DataFrame, score: str, least: float = 0.5) -> DataFrame:
    """Rows with a score of at least ``least``, the best first."""
    return df.where(F.col(score) >= least).orderBy(F.col(score).desc())


def train(df: DataFrame, label: str, features: Sequence[str] | None = None, trees: int = 20, depth: int = 4, seed: int = 7):
    """A boosted-trees pipeline fitted to the rows with a label; missing inputs are given a value of their own."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    names = list(features or feature_columns(df.drop(label)))
    rows = df.where(F.col(label).isNotNull()).select(F.col(label).cast("double").alias(label), *[F.coalesce(F.col(c).cast("double"), F.lit(-999.0)).alias(c) for c in names])
    stages = [VectorAssembler(inputCols=names, outputCol="features"), GBTClassifier(labelCol=label, maxIter=trees, maxDepth=depth, seed=seed)]
    return Pipeline(stages=stages).fit(rows)


def scored(model, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``df`` with ``score``, the model's probability of label 1."""
    from pyspark.ml.functions import vector_to_array

    filled = df.withColumns({f"_in_{c}": F.col(c) for c in features}).withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(-999.0)) for c in features})
    out = model.transform(filled).withColumn("score", vector_to_array("probability")[1])
    return out.select(*[F.col(f"_in_{c}").alias(c) if c in features else F.col(c) for c in df.columns], "score")
