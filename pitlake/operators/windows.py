"""Rolling, lagged and forward-looking columns over one ordered series per key."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec


def series(key: str | Sequence[str], order: Sequence[str]) -> WindowSpec:
    """The series of a key in its order."""
    return Window.partitionBy(*([key] if isinstance(key, str) else key)).orderBy(*order)


def trailing(w: WindowSpec, n: int) -> WindowSpec:
    """The last ``n`` rows, the current one included."""
    return w.rowsBetween(-(n - 1), Window.currentRow)


def gated(w: WindowSpec, column: str | Column, n: int, aggregate: Callable[[Column], Column], least: int | None = None) -> Column:
    """An aggregate over the last ``n`` rows, null below ``least`` (``n``) observations."""
    column = F.col(column) if isinstance(column, str) else column
    frame = trailing(w, n)
    return F.when(F.count(column).over(frame) >= (n if least is None else least), aggregate(column).over(frame))


def change(w: WindowSpec, column: str | Column, n: int) -> Column:
    """Relative change against ``n`` rows before; null where there is none or it is zero."""
    column = F.col(column) if isinstance(column, str) else column
    before = F.lag(column, n).over(w)
    return F.try_divide(column, before) - 1


def zscore(w: WindowSpec, column: str | Column, n: int) -> Column:
    """Deviation from the rolling mean in rolling deviations; zero where that is zero."""
    column = F.col(column) if isinstance(column, str) else column
    spread = gated(w, column, n, F.stddev_samp)
    return F.when(spread == 0, 0.0).otherwise((column - gated(w, column, n, F.avg)) / spread)


def true_range(w: WindowSpec) -> Column:
    """Largest of the bar's range and its distances from the close before."""
    before = F.lag("close", 1).over(w)
    return F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - before), F.abs(F.col("low") - before))


def exponential(df: DataFrame, key: str | Sequence[str], order: Sequence[str], column: str, alpha: float, name: str, adjust: bool = False, least: int = 1) -> DataFrame:
    """``df`` with the exponential mean of a column over each series, null below ``least`` observations.

    Recursive (``y = (1 - alpha) * y + alpha * x``, the first value as it is), or with
    ``adjust`` the weighted mean of all values so far. Nulls count as no observation; the
    mean before them is carried on.

    Series are cut into blocks in which the weights span a factor of e**50. Within a block
    the mean is a running sum; from the block before only its last value is needed, as what
    lies further back weighs e**-50 at most, beyond double precision. So the cost is linear
    in a series' length, and the sums of one long series are spread over tasks by block.
    """
    keys, keep = [key] if isinstance(key, str) else list(key), 1.0 - alpha
    block = max(1, math.ceil(50 / -math.log(keep))) if keep > 0 else 1
    w = series(keys, order)
    x = F.col(column).cast("double")
    rows = df.withColumn("_n", F.count(x).over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1)
    rows = rows.withColumn("_block", F.floor(F.col("_n") / block)).withColumn("_m", F.pmod("_n", F.lit(block)))
    weight = F.lit(1.0) if adjust else F.when(F.col("_n") == 0, 1.0).otherwise(alpha)
    inside = Window.partitionBy(*keys, "_block").orderBy("_m", *order).rowsBetween(Window.unboundedPreceding, 0)
    lift = lambda n: F.exp(n * (math.log(keep) if keep > 0 else 0.0))
    rows = rows.withColumn("_sum", F.sum(x * weight * lift(-F.col("_m"))).over(inside) * lift(F.col("_m")))
    ended = F.when((F.col("_m") == block - 1) & x.isNotNull(), F.col("_sum"))
    before = F.last(ended, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    value = F.col("_sum") + F.coalesce(before, F.lit(0.0)) * (lift(F.col("_m") + 1) if keep > 0 else 0.0)
    if adjust:
        value = value * alpha / (1 - lift(F.col("_n") + 1)) if keep > 0 else value
    rows = rows.withColumn("_value", F.when(x.isNotNull(), value))
    carried = F.last("_value", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn(name, F.when(F.col("_n") >= least - 1, carried)).drop("_n", "_block", "_m", "_sum", "_value")


def _span(n: int) -> float:
    return 2.0 / (n + 1)


def macd(df: DataFrame, key: str, order: Sequence[str], column: str, fast: int = 12, slow: int = 26, signal: int = 9, adjust: bool = False) -> DataFrame:
    """``df`` with ``macd``, the fast less the slow exponential mean, and ``macd_signal``, that of macd itself."""
    rows = exponential(df, key, order, column, _span(fast), "_fast", adjust)
    rows = exponential(rows, key, order, column, _span(slow), "_slow", adjust)
    rows = rows.withColumn("macd", F.col("_fast") - F.col("_slow")).drop("_fast", "_slow")
    return exponential(rows, key, order, "macd", _span(signal), "macd_signal", adjust)


def _strength(gain: Column, loss: Column) -> Column:
    """100 at no gain is 0; null where nothing was lost."""
    return 100 - 100 / (1 + gain / F.nullif(loss, F.lit(0.0)))


def rsi(df: DataFrame, key: str, order: Sequence[str], column: str, period: int, name: str) -> DataFrame:
    """``df`` with the relative strength index by Wilder's recursive means; null below ``period`` changes, and without a loss."""
    step = F.col(column) - F.lag(column).over(series(key, order))
    rows = df.withColumn("_gain", F.greatest(step, F.lit(0.0))).withColumn("_loss", F.greatest(-step, F.lit(0.0)))
    rows = rows.withColumn("_gain", F.when(step.isNotNull(), F.col("_gain"))).withColumn("_loss", F.when(step.isNotNull(), F.col("_loss")))
    for c in ("_gain", "_loss"):
        rows = exponential(rows, key, order, c, 1.0 / period, c + "_mean", least=period)
    return rows.withColumn(name, _strength(F.col("_gain_mean"), F.col("_loss_mean"))).drop("_gain", "_loss", "_gain_mean", "_loss_mean")


def rsi_simple(df: DataFrame, key: str, order: Sequence[str], column: str, period: int, name: str) -> DataFrame:
    """The same by plain rolling means; the first row's missing change counts as none."""
    w = series(key, order)
    step = F.coalesce(F.col(column) - F.lag(column).over(w), F.lit(0.0))
    rows = df.withColumn("_up", F.greatest(step, F.lit(0.0))).withColumn("_down", F.greatest(-step, F.lit(0.0)))
    return rows.withColumn(name, _strength(gated(w, "_up", period, F.avg), gated(w, "_down", period, F.avg))).drop("_up", "_down")


def volatility(df: DataFrame, key: str, order: Sequence[str], year: float = 252.0) -> DataFrame:
    """``df`` (high, low, close) with annualised volatilities, their ratios, true ranges, band width and z-scores."""
    w = series(key, order)
    rows = df.withColumn("_lr", F.ln(F.try_divide(F.col("close"), F.lag("close").over(w)))).withColumn("_tr", true_range(w))
    rows = rows.withColumn("_sr", change(w, "close", 1)).withColumn("_hl", F.pow(F.ln(F.try_divide("high", "low")), 2))
    over = lambda c, n, f: gated(w, c, n, f)
    scale = math.sqrt(year)
    out = {f"vol_{n}d": over("_lr", n, F.stddev_samp) * scale for n in (5, 20, 60)}
    out |= {"parkinson_20d": F.sqrt(over("_hl", 20, F.avg) / (4 * math.log(2))) * scale}
    out |= {f"atr_{n}": over("_tr", n, F.avg) for n in (14, 20)}
    out |= {f"_mean{n}": over("close", n, F.avg) for n in (20, 60)} | {f"_sd{n}": over("close", n, F.stddev_samp) for n in (20, 60)}
    out |= {"simple_vol_20d": over("_sr", 20, F.stddev_samp) * scale}
    rows = rows.select("*", *[v.alias(k) for k, v in out.items()])  # one sort serves all frames
    ratio = lambda a, b: F.col(a) / F.nullif(F.col(b), F.lit(0.0))
    rows = rows.withColumns(
        {
            "vol_ratio_5_20": ratio("vol_5d", "vol_20d"),
            "vol_ratio_20_60": ratio("vol_20d", "vol_60d"),
            "band_width_20": 2 * ratio("_sd20", "_mean20"),
            "band_width_template": 4 * ratio("_sd20", "_mean20"),
            **{f"zscore_{n}d": (F.col("close") - F.col(f"_mean{n}")) / F.nullif(F.col(f"_sd{n}"), F.lit(0.0)) for n in (20, 60)},
        }
    )
    return rows.drop("_lr", "_tr", "_sr", "_hl", "_mean20", "_mean60", "_sd20", "_sd60")


def relative(df: DataFrame, key: str, order: Sequence[str], own: str, benchmark: str, year: float = 252.0) -> DataFrame:
    """``df`` with beta, alpha, correlations, idiosyncratic volatility and relative strength against a benchmark's price.

    ``own`` and ``benchmark`` are prices on the same row. Frames need all their returns:
    60 for beta and the long correlation, 20 for the others.
    """
    w = series(key, order)
    rows = df.withColumn("_x", change(w, own, 1)).withColumn("_y", change(w, benchmark, 1))
    both = F.col("_x").isNotNull() & F.col("_y").isNotNull()
    rows = rows.withColumn("_bx", F.when(both, F.col("_x"))).withColumn("_by", F.when(both, F.col("_y"))).withColumn("_diff", F.col("_x") - F.col("_y"))

    def joint(n: int, value: Callable[[WindowSpec], Column]) -> Column:
        return F.when(F.count("_bx").over(trailing(w, n)) >= n, value(trailing(w, n)))

    spread = gated(w, "_y", 60, F.var_samp)
    corr = lambda f: F.covar_samp("_bx", "_by").over(f) / F.nullif(F.stddev_samp("_bx").over(f) * F.stddev_samp("_by").over(f), F.lit(0.0))
    out = {
        "rel_strength_20d": (F.col(own) / F.lag(own, 20).over(w)) / (F.col(benchmark) / F.lag(benchmark, 20).over(w)),
        "beta_60d": joint(60, lambda f: F.covar_samp("_bx", "_by").over(f)) / F.nullif(spread, F.lit(0.0)),
        "alpha_20d": gated(w, "_x", 20, F.avg) - gated(w, "_y", 20, F.avg),
        "corr_20d": joint(20, corr),
        "corr_60d": joint(60, corr),
        "idio_vol_20d": gated(w, "_diff", 20, F.stddev_samp) * math.sqrt(year),
    }
    return rows.select("*", *[v.alias(k) for k, v in out.items()]).drop("_x", "_y", "_bx", "_by", "_diff")


def trimmed(df: DataFrame, time: str, start: str, end: str) -> DataFrame:
    """Rows within ``[start, end]`` after what needed rows before them is computed; an end at midnight takes its whole day."""
    kind = df.schema[time].dataType.typeName()
    last = datetime.fromisoformat(end)
    if last == last.replace(hour=0, minute=0, second=0, microsecond=0):
        last += timedelta(days=1, microseconds=-1)
    return df.where(F.col(time).between(F.lit(start).cast(kind), F.lit(str(last)).cast(kind)))


def time_before(key: str, micros: str, seconds: int, closed: bool = False) -> WindowSpec:
    """Rows of the key in ``(t - seconds, t)``, or ``[t - seconds, t)`` if closed; equal times are left out."""
    return Window.partitionBy(key).orderBy(micros).rangeBetween(-seconds * 1_000_000 + (0 if closed else 1), -1)


def time_upto(key: str, micros: str, seconds: int) -> WindowSpec:
    """Rows of the key in ``(t - seconds, t]``; rows at the same time see each other."""
    return Window.partitionBy(key).orderBy(micros).rangeBetween(-seconds * 1_000_000 + 1, 0)


def trend_scan(df: DataFrame, key: str | Sequence[str], order: Sequence[str], column: str, horizons: Sequence[int] = (1, 2, 3, 5, 10, 15, 20)) -> DataFrame:
    """``df`` with ``t`` and ``horizon``: the slope statistic of the values from a row to a horizon ahead that is strongest.

    Of equal ones the shorter horizon counts. A horizon without enough rows ahead, one of a
    single step and a perfect line have no statistic; rows without any are dropped. The
    values ahead are columns, so all sums are generated code. Residuals are summed as they
    are: a difference of sums of squares would lose a nearly perfect line's to rounding.
    """
    known = sorted(h for h in horizons if h > 1)
    longest, keep = max(known), [f"`{c}`" for c in df.columns]
    keys = ", ".join(f"`{c}`" for c in ([key] if isinstance(key, str) else key))
    own = f"cast(`{column}` AS double)"
    # Expressions are text: as many columns as these take long to build one by one.
    w = f"OVER (PARTITION BY {keys} ORDER BY {', '.join(f'`{c}`' for c in order)})"
    rows = df.selectExpr("*", *[f"lead({own}, {k}) {w} AS _a{k}" for k in range(1, longest + 1)])
    rows = rows.selectExpr(*keep, *[f"_a{h} IS NOT NULL AND {own} IS NOT NULL AS _has{h}" for h in known], *[f"coalesce(_a{k} - {own}, 0D) AS _y{k}" for k in range(1, longest + 1)])
    spread = {h: h * (h + 1) * (h + 2) / 12.0 for h in known}
    y = lambda k: f"_y{k}" if k else "0D"
    mean = [f"({' + '.join(y(k) for k in range(1, h + 1))}) * {1.0 / (h + 1)!r}D AS _m{h}" for h in known]
    slope = [f"({' + '.join(f'{y(k)} * {k - h / 2.0!r}D' for k in range(1, h + 1))}) * {1.0 / spread[h]!r}D AS _b{h}" for h in known]
    rows = rows.selectExpr("*", *mean, *slope)
    square = lambda x: f"({x}) * ({x})"
    rest = [" + ".join(square(f"{y(k)} - _m{h} - _b{h} * {k - h / 2.0!r}D") for k in range(h + 1)) + f" AS _r{h}" for h in known]
    whole = [" + ".join(square(f"{y(k)} - _m{h}") for k in range(h + 1)) + f" AS _s{h}" for h in known]
    rows = rows.selectExpr(*keep, *[f"_has{h}" for h in known], *[f"_b{h}" for h in known], *rest, *whole)
    rows = rows.selectExpr(*keep, *[f"CASE WHEN _has{h} AND _r{h} > _s{h} * 1e-12D THEN _b{h} / sqrt(_r{h} * {1.0 / (h - 1) / spread[h]!r}D) END AS _t{h}" for h in known])
    size = lambda h: f"round(abs(_t{h}), 6)"
    best = f"greatest({', '.join(size(h) for h in known)}, NULL)"
    pick = f"coalesce({', '.join(f'CASE WHEN {size(h)} = {best} THEN struct(_t{h} AS t, {h} AS h) END' for h in known)}, NULL)"
    # Exploding none or one drops the rows without any; a filter would be pushed down and compute everything again.
    found = rows.selectExpr(*keep, f"explode(array_compact(array({pick}))) AS _best")
    return found.selectExpr(*keep, "_best.t AS t", "_best.h AS horizon")
