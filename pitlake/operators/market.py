"""Daily market aggregates over tables with the usual columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pitlake.operators.daily import arrival
from pitlake.operators.windows import gated, series

NEW_POSITION = 1.5  # fixed value: volume over previous open interest that makes a build-up a new position


def microstructure(quotes: DataFrame, key: str = "instrument_key", time: str = "ts_event", sequence: str = "seq") -> DataFrame:
    """Spread, spread in basis points, imbalance, depth, last middle price and counts per key and day.

    Quotes (bid_px, ask_px, bid_sz, ask_sz) without sizes count for the prices only;
    ``n_sized`` tells how many had them.
    """
    wide, size = F.col("ask_px") - F.col("bid_px"), F.col("bid_sz") + F.col("ask_sz")
    rows = quotes.withColumn("_mid", (F.col("ask_px") + F.col("bid_px")) / 2).withColumn("_at", arrival(time, sequence).cast("decimal(38,0)"))
    return rows.groupBy(key, F.col(time).cast("date").alias("day")).agg(
        F.avg(wide).alias("spread"),
        F.avg(F.try_divide(wide, F.col("_mid")) * 10000).alias("spread_bps"),
        F.avg(F.try_divide(F.col("bid_sz") - F.col("ask_sz"), size)).alias("imbalance"),
        F.avg(size).alias("depth"),
        F.max_by("_mid", F.when(F.col("_mid").isNotNull(), F.col("_at"))).alias("last_mid"),
        F.count("*").alias("n_quotes"),
        F.count(size).alias("n_sized"),
    )


def oi_momentum(changes: DataFrame, key: str = "instrument_key", time: str = "ts_event", days: int = 5) -> DataFrame:
    """Build-up of open interest per key and day over all strikes, the new-position signal, and a rolling sum.

    Nulls count as 0, a ratio to nothing is 0; days without a full rolling sum are dropped.
    """
    zero = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    rows = changes.groupBy(key, F.col(time).cast("date").alias("day")).agg(
        (F.sum(zero("call_oi_change")) + F.sum(zero("put_oi_change"))).alias("_change"),
        (F.avg(zero("call_oi")) + F.avg(zero("put_oi"))).alias("_held"),
        F.sum(zero("volume")).alias("_volume"),
        F.sum(zero("prev_oi")).alias("_prev"),
    )
    ratio = F.coalesce(F.try_divide("_change", "_held"), F.lit(0.0))
    turnover = F.coalesce(F.try_divide("_volume", "_prev"), F.lit(0.0))
    rows = rows.select(key, "day", ratio.alias("oi_buildup_ratio"), ((ratio > 0) & (turnover > NEW_POSITION)).cast("double").alias("new_position_signal"))
    total = gated(series(key, ["day"]), "oi_buildup_ratio", days, F.sum)
    return rows.withColumn(f"oi_change_momentum_{days}d", total).where(F.col(f"oi_change_momentum_{days}d").isNotNull())


def atm_straddle(chain: DataFrame, key: str = "underlying", day: str = "day") -> DataFrame:
    """key, day, straddle: the middle prices of the call and the put that are nearest to the money, together.

    ``chain`` has is_call, delta, strike, mid and seq, which breaks ties. Contracts with a
    delta are taken by its distance from a half. Where a key has none on a day, the common strike of calls
    and puts that is nearest to the median strike is taken. Without both sides there is no row.
    """
    known = chain.where("delta IS NOT NULL")
    side = lambda is_call: F.col("is_call") if is_call else ~F.col("is_call")
    far = F.abs(F.abs(F.col("delta").cast("double")) - 0.5)
    pick = lambda is_call, order: F.min_by("mid", F.when(side(is_call), order))
    order = F.struct(far, "seq")
    by_delta = known.groupBy(key, day).agg(pick(True, order).alias("_c"), pick(False, order).alias("_p"))
    rest = chain.where("delta IS NULL").join(known.select(key, day).distinct(), [key, day], "left_anti")
    per_strike = rest.groupBy(key, day, "strike").agg(pick(True, F.col("seq")).alias("_c"), pick(False, F.col("seq")).alias("_p"), F.count("*").alias("_n"))
    middle = rest.groupBy(key, day).agg(F.percentile("strike", F.lit(0.5)).alias("_m"))
    common = per_strike.where("_c IS NOT NULL AND _p IS NOT NULL").join(middle, [key, day])
    nearest = F.row_number().over(Window.partitionBy(key, day).orderBy(F.abs(F.col("strike") - F.col("_m")), "strike"))
    by_strike = common.withColumn("_nth", nearest).where("_nth = 1").select(key, day, "_c", "_p")
    both = by_delta.where("_c IS NOT NULL AND _p IS NOT NULL").unionByName(by_strike)
    return both.select(key, day, (F.col("_c") + F.col("_p")).alias("straddle"))
