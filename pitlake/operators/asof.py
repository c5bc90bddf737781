"""Point-in-time joins: no row is matched before it became available."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def micros(column: str | Column) -> Column:
    """Microseconds since the epoch of a zone-less timestamp, whatever the session's zone."""
    column = F.col(column) if isinstance(column, str) else column
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), column.cast("timestamp_ntz"))


def safe_time(event: str, available: str | None) -> Column:
    """When a row may first be seen: the later of event and availability, nulls skipped."""
    return F.greatest(event, available) if available else F.col(event)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    available: str | None = None,
    tolerance_seconds: int | None = None,
    tiebreak: Sequence[str] = (),
    suffix: str = "_right",
    bucket_seconds: int | None = None,
) -> DataFrame:
    """Each left row with the right row of its key whose safe time is the latest not after ``left_time``.

    Both sides are sorted together once per key, so the cost is one shuffle and O(n log n);
    of right rows with equal safe time the last by (right_time, tiebreak) wins. With
    ``bucket_seconds`` a hot key is cut into time buckets that are sorted apart: the last
    right row of each bucket is carried into the following ones. Rows with a null key or
    time match nothing; left rows are all kept.
    """
    missing = [c for c in [*on, left_time] if c not in left.columns] + [c for c in [*on, right_time] if c not in right.columns]
    if missing:
        raise ValueError(f"as-of join lacks columns {missing}")
    payload = [c for c in right.columns if c not in on]
    fields = [c + suffix if c in left.columns else c for c in payload]
    keys = [F.col(c).alias(f"_k{i}") for i, c in enumerate(on)] or [F.lit(0).alias("_k0")]
    names = [f"_k{i}" for i in range(len(keys))]
    ties = [f"_b{i}" for i in range(len(tiebreak))]
    order = ["_t", "_side", "_event", *ties]
    known = lambda time: reduce(and_, [F.col(c).isNotNull() for c in on], time.isNotNull())
    safe = safe_time(right_time, available)
    right_rows = right.where(known(safe)).select(
        *keys, micros(safe).alias("_t"), F.lit(0).alias("_side"), micros(right_time).alias("_event"), *[F.col(c).alias(t) for c, t in zip(tiebreak, ties, strict=True)],
        F.struct(micros(safe).alias("_safe"), *[F.col(c).alias(f) for c, f in zip(payload, fields, strict=True)]).alias("_match"),
    )
    kind = right_rows.schema["_match"].dataType
    left_rows = left.where(known(F.col(left_time))).select(
        *keys, micros(left_time).alias("_t"), F.lit(1).alias("_side"), F.lit(None).cast("long").alias("_event"), *[F.lit(None).cast(right_rows.schema[t].dataType).alias(t) for t in ties],
        F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("_left"), F.lit(None).cast(kind).alias("_match"),
    )
    parts = list(names)
    if bucket_seconds:
        bucket = F.floor(F.col("_t") / (bucket_seconds * 1_000_000))
        left_rows, right_rows = left_rows.withColumn("_bucket", bucket), right_rows.withColumn("_bucket", bucket)
        # The last right row of each bucket opens the following ones: a row per bucket, found from the right side alone.
        ends = right_rows.groupBy(*names, "_bucket").agg(F.max_by(F.struct(*order, "_match"), F.struct(*order)).alias("_end"))
        wanted = left_rows.groupBy(*names, "_bucket").agg(F.lit(None).cast(ends.schema["_end"].dataType).alias("_end"))
        both = wanted.unionByName(ends).groupBy(*names, "_bucket").agg(F.first("_end", ignorenulls=True).alias("_end"))
        before = Window.partitionBy(*names).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
        carried = both.select(*names, "_bucket", F.last("_end", ignorenulls=True).over(before).alias("_end")).where("_end IS NOT NULL")
        right_rows = right_rows.unionByName(carried.select(*names, "_bucket", *[F.col(f"_end.{c}").alias(c) for c in (*order, "_match")]))
        parts.append("_bucket")
    rows = right_rows.unionByName(left_rows, allowMissingColumns=True)
    window = Window.partitionBy(*parts).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_found", F.last("_match", ignorenulls=True).over(window)).where("_side = 1")
    near = F.lit(True) if tolerance_seconds is None else F.col("_t") - F.col("_found._safe") <= tolerance_seconds * 1_000_000
    matched = rows.select(*[F.col(f"_left.`{c}`").alias(c) for c in left.columns], *[F.when(near, F.col(f"_found.`{f}`")).alias(f) for f in fields])
    # Rows with a null key or time match nothing and take no part in the sort.
    lone = left.where(~known(F.col(left_time))).select("*", *[F.lit(None).cast(kind[f].dataType).alias(f) for f in fields])
    return matched.unionByName(lone)


def validity_join(
    left: DataFrame, dimension: DataFrame, on: str, time: str, start: str = "valid_from", end: str = "valid_to",
    tiebreak: Sequence[str] = (), bucket_seconds: int | None = None,
) -> DataFrame:
    """Slowly changing dimension: the row with ``start <= time < end``, an open end lasting for ever.

    A key's intervals must not overlap (of those that start together the last by
    ``tiebreak`` counts), so the latest to have started is the only one that can hold: an
    as-of join, then one comparison. All left rows are kept.
    """
    side = dimension.withColumnRenamed(end, "_end")
    out = asof_join(left, side, [on], time, start, tiebreak=tiebreak, bucket_seconds=bucket_seconds)
    holds = F.col(start).isNotNull() & (F.col("_end").isNull() | (F.col("_end") > F.col(time)))
    added = [c for c in out.columns if c not in left.columns and c != "_end"]
    return out.select(*left.columns, *[F.when(holds, F.col(c)).alias(c) for c in added], F.when(holds, F.col("_end")).alias(end))


def forward_rows(left: DataFrame, right: DataFrame, on: str, left_time: str, right_time: str, n: int, tiebreak: Sequence[str] = ()) -> DataFrame:
    """For each left row the first ``n`` right rows of its key strictly after its time, with their position.

    Right rows are numbered per key; a left row's position is the number of right rows not
    after it, taken from one sort of both sides; what remains is an equi-join on key and
    number, so no range is compared.
    """
    numbered = right.withColumn("_n", F.row_number().over(Window.partitionBy(on).orderBy(right_time, *tiebreak)))
    sides = numbered.select(F.col(on).alias("_on"), micros(right_time).alias("_t"), F.lit(0).alias("_side"), F.lit(None).cast(left.select(F.struct(*left.columns).alias("x")).schema["x"].dataType).alias("_left"))
    lefts = left.select(F.col(on).alias("_on"), micros(left_time).alias("_t"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_left"))
    upto = Window.partitionBy("_on").orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = sides.unionByName(lefts).withColumn("_seen", F.sum(1 - F.col("_side")).over(upto)).where("_side = 1")
    wanted = placed.withColumn("position", F.explode(F.sequence(F.lit(1), F.lit(n)))).withColumn("_n", (F.col("_seen") + F.col("position")).cast("int"))
    columns = [c for c in right.columns if c != on]
    bars = numbered.select(F.col(on).alias("_r"), F.col("_n").alias("_m"), *[F.col(c).alias(c if c not in left.columns else c + "_right") for c in columns])
    return wanted.join(bars, (F.col("_on") == F.col("_r")) & (F.col("_n") == F.col("_m"))).select(
        "_left.*", "position", *[c if c not in left.columns else c + "_right" for c in columns]
    )
