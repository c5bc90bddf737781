"""Maintenance of stored labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlake.functions.scalars import add_flag, to_date

TRUNCATED = "label_window_truncated"


def rewritten(labels: DataFrame, nominal_seconds: dict[str, int]) -> tuple[DataFrame, DataFrame]:
    """(labels, labels set aside): windows that end before they begin are set aside.

    A window that is shorter than its horizon's nominal length, or whose horizon is unknown,
    is flagged once; expiries given as text or digits become dates. ``labels`` has window_start,
    window_end, horizon, quality_flags and expiry.
    """
    from pitlake.operators.asof import micros

    known = F.create_map(*[F.lit(x) for pair in nominal_seconds.items() for x in pair])
    lasts = (micros("window_end") - micros("window_start")) / 1_000_000
    short = ~F.coalesce(lasts >= F.try_element_at(known, F.col("horizon")), F.lit(False))
    flags = add_flag(F.coalesce("quality_flags", F.array().cast("array<string>")), TRUNCATED, short)
    rows = labels.withColumn("quality_flags", flags).withColumn("expiry", to_date(F.col("expiry").cast("string")))
    inverted = F.coalesce(F.col("window_end") < F.col("window_start"), F.lit(False))
    return rows.where(~inverted), rows.where(inverted)
