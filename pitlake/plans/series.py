"""Queries of window functions over ordered series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from pitlake.operators import windows as w_
from pitlake.operators.asof import micros
from pitlake.operators.dedupe import keep_one
from pitlake.plans import bindings as b
from pitlake.plans.catalog import register

_W = "WINDOW w AS (PARTITION BY instrument_key ORDER BY day)"
_HEAD = "SELECT instrument_key, CAST(day AS VARCHAR) AS day, "


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = b.daily(b.bars(spark, sf_dir))
    return days.withColumn("day", F.col("day").cast("string"))


def _r(column: Column, name: str, digits: int = 6) -> Column:
    return F.round(column, digits).alias(name)




def _by_day() -> WindowSpec:
    return w_.series("instrument_key", ["day"])


@register("win_momentum", b.with_(b.BARS, b.DAILY) + _HEAD + ", ".join(f"round(close / lag(close, {n}) OVER w - 1, 6) AS m{n}" for n in (1, 5, 10, 20, 60)) + f", round((close / lag(close, 20) OVER w - 1) * 100, 6) AS roc20 FROM daily {_W}")
def win_momentum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Momentum over five horizons."""
    return _daily(spark, sf_dir).select("instrument_key", "day", *[_r(w_.change(_by_day(), "close", n), f"m{n}") for n in (1, 5, 10, 20, 60)], _r(w_.change(_by_day(), "close", 20) * 100, "roc20"))


def _gate(expression: str, n: int, column: str) -> str:
    frame = f"(PARTITION BY instrument_key ORDER BY day ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({column}) OVER {frame} >= {n} THEN {expression} OVER {frame} END"


@register("win_adv", b.with_(b.BARS, b.DAILY, f"a AS (SELECT instrument_key, day, {_gate('avg(volume)', 20, 'volume')} AS v, {_gate('avg(close)', 20, 'close')} AS c FROM daily)") + "SELECT instrument_key, CAST(day AS VARCHAR) AS day, round(v, 6) AS adv, round(c, 6) AS avg_close FROM a WHERE v IS NOT NULL AND c IS NOT NULL")
def win_adv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gated rolling means; rows without one are dropped."""
    rows = _daily(spark, sf_dir)
    rows = rows.select("instrument_key", "day", *[_r(w_.gated(_by_day(), c, 20, F.avg), n) for c, n in (("volume", "adv"), ("close", "avg_close"))])
    return rows.where("adv IS NOT NULL AND avg_close IS NOT NULL")


@register("win_zscore", b.with_(b.BARS, b.DAILY, f"z AS (SELECT instrument_key, day, volume, {_gate('avg(volume)', 20, 'volume')} AS m, {_gate('stddev_samp(volume)', 20, 'volume')} AS s FROM daily)") + _HEAD + "round(CASE WHEN s = 0 THEN 0.0 ELSE (volume - m) / s END, 6) AS z FROM z")
def win_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rolling z-score."""
    return _daily(spark, sf_dir).select("instrument_key", "day", _r(w_.zscore(_by_day(), "volume", 20), "z"))


@register("win_acceleration", b.with_(b.BARS, b.DAILY) + _HEAD + f"round(close - {_gate('avg(close)', 5, 'close')}, 6) AS acceleration, {_gate('sum(volume)', 5, 'volume')} AS volume_5d FROM daily")
def win_acceleration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value less its rolling mean, and a rolling sum."""
    return _daily(spark, sf_dir).select("instrument_key", "day", _r(F.col("close") - w_.gated(_by_day(), "close", 5, F.avg), "acceleration"), w_.gated(_by_day(), "volume", 5, F.sum).alias("volume_5d"))


_GEX = """g AS (SELECT CAST(l_shipdate AS DATE) AS day, 'm' AS instrument_key, avg(l_extendedprice * (l_tax - l_discount)) AS net FROM lineitem GROUP BY 1),
s AS (SELECT day, net, stddev_samp(net) OVER (PARTITION BY instrument_key ORDER BY day ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS sd FROM g)"""


@register("win_regime", b.with_(_GEX) + "SELECT CAST(day AS VARCHAR) AS day, CASE WHEN coalesce(abs(net) < 0.1 * sd, false) THEN 0.0::DOUBLE WHEN net > 0 THEN 1.0::DOUBLE ELSE (-1.0)::DOUBLE END AS regime, round(CASE WHEN sd > 0 THEN net / sd END, 6) AS flip_distance FROM s")
def win_regime(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regime and distance from its flip; one row per day reaches the unpartitioned window."""
    net = F.avg(F.col("l_extendedprice") * (F.col("l_tax") - F.col("l_discount")))
    days = b.read(spark, sf_dir, "lineitem").groupBy(F.col("l_shipdate").cast("date").cast("string").alias("day")).agg(net.alias("net"))
    sd = F.stddev_samp("net").over(Window.partitionBy(F.lit("m")).orderBy("day").rowsBetween(-19, 0))
    days = days.withColumn("sd", sd)
    regime = F.when(F.coalesce(F.abs("net") < 0.1 * F.col("sd"), F.lit(False)), 0.0).when(F.col("net") > 0, 1.0).otherwise(-1.0)
    return days.select("day", regime.alias("regime"), _r(F.when(F.col("sd") > 0, F.col("net") / F.col("sd")), "flip_distance"))


@register("win_rolling_median", b.with_(b.BARS, b.DAILY) + _HEAD + "round(median(close) OVER (PARTITION BY instrument_key ORDER BY day ROWS BETWEEN 89 PRECEDING AND CURRENT ROW), 6) AS med FROM daily")
def win_rolling_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rolling median from the first row on."""
    return _daily(spark, sf_dir).select("instrument_key", "day", _r(F.percentile("close", F.lit(0.5)).over(w_.trailing(_by_day(), 90)), "med"))


_VOL = """r AS (SELECT *, ln(close / lag(close) OVER w) AS lr, close / lag(close) OVER w - 1 AS sr, lag(close) OVER w AS pc FROM daily WINDOW w AS (PARTITION BY instrument_key ORDER BY day)),
t AS (SELECT *, greatest(high - low, abs(high - pc), abs(low - pc)) AS tr, ln(high / low) ** 2 AS hl FROM r)"""
_YEAR = "sqrt(252)"
_FAMILY = (
    "v AS (SELECT instrument_key, day, close, "
    + ", ".join(f"{_gate('stddev_samp(lr)', n, 'lr')} * {_YEAR} AS vol_{n}d" for n in (5, 20, 60))
    + f", sqrt({_gate('avg(hl)', 20, 'hl')} / (4 * ln(2))) * {_YEAR} AS parkinson_20d, "
    + ", ".join(f"{_gate('avg(tr)', n, 'tr')} AS atr_{n}" for n in (14, 20))
    + f", {_gate('stddev_samp(sr)', 20, 'sr')} * {_YEAR} AS simple_vol_20d, "
    + ", ".join(f"{_gate('avg(close)', n, 'close')} AS m{n}, {_gate('stddev_samp(close)', n, 'close')} AS s{n}" for n in (20, 60))
    + " FROM t)"
)
_VOLATILITIES = ("vol_5d", "vol_20d", "vol_60d", "parkinson_20d", "atr_14", "atr_20", "simple_vol_20d", "vol_ratio_5_20", "vol_ratio_20_60", "band_width_20", "band_width_template", "zscore_20d", "zscore_60d")


@register("win_volatility", b.with_(b.BARS, b.DAILY, _VOL, _FAMILY) + _HEAD + ", ".join(f"round({c}, 6) AS {c}" for c in _VOLATILITIES[:7])
  + """, round(vol_5d / nullif(vol_20d, 0), 6) AS vol_ratio_5_20, round(vol_20d / nullif(vol_60d, 0), 6) AS vol_ratio_20_60, round(2 * s20 / nullif(m20, 0), 6) AS band_width_20,
  round(4 * s20 / nullif(m20, 0), 6) AS band_width_template, round((close - m20) / nullif(s20, 0), 6) AS zscore_20d, round((close - m60) / nullif(s60, 0), 6) AS zscore_60d FROM v""")
def win_volatility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The volatility family of daily bars."""
    rows = w_.volatility(_daily(spark, sf_dir), "instrument_key", ["day"])
    return rows.select("instrument_key", "day", *[_r(F.col(c), c) for c in _VOLATILITIES])


def _ema_sql(column: str, keep: float, window: str) -> str:
    """A fold over the values so far; the SQL needs no better order than that."""
    return f"list_reduce(list({column}) FILTER (WHERE {column} IS NOT NULL) OVER {window}, lambda a, x: a * {keep!r}::DOUBLE + x * (1 - {keep!r}::DOUBLE))"


_EVW = "(PARTITION BY user_id ORDER BY ts, event_id)"
_LONG = "(PARTITION BY event_type ORDER BY ts, event_id)"


@register("win_ewma", f"SELECT event_id, round({_ema_sql('value', 1 - 2 / 13, _EVW)}, 4) AS ema FROM events")
def win_ewma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recursive exponential mean of every user's events."""
    rows = b.read(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    return w_.exponential(rows, "user_id", ["ts", "event_id"], "value", 2 / 13, "ema").select("event_id", _r(F.col("ema"), "ema", 4))


@register("win_ewma_long", f"SELECT event_id, round({_ema_sql('value', 1 - 2 / 41, _LONG)}, 4) AS ema FROM events")
def win_ewma_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over a handful of long series."""
    rows = b.read(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value")
    return w_.exponential(rows, "event_type", ["ts", "event_id"], "value", 2 / 41, "ema").select("event_id", _r(F.col("ema"), "ema", 4))


@register("win_ewma_adjusted", "WITH e AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events) "
  "SELECT a.event_id, round(sum(x.value * pow(0.7, a.n - x.n)) / sum(pow(0.7, a.n - x.n)), 4) AS ema FROM e a JOIN e x ON a.user_id = x.user_id AND x.n <= a.n GROUP BY 1")
def win_ewma_adjusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted mean of all values so far, weights falling by the row."""
    rows = b.read(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    return w_.exponential(rows, "user_id", ["ts", "event_id"], "value", 0.3, "ema", adjust=True).select("event_id", _r(F.col("ema"), "ema", 4))


_BYDAY = "(PARTITION BY instrument_key ORDER BY day)"


@register("win_macd", b.with_(b.BARS, b.DAILY, f"m AS (SELECT instrument_key, day, {_ema_sql('close', 1 - 2 / 13, _BYDAY)} - {_ema_sql('close', 1 - 2 / 27, _BYDAY)} AS macd FROM daily)")
  + _HEAD + f"round(macd, 4) AS macd, round({_ema_sql('macd', 1 - 2 / 10, _BYDAY)}, 4) AS macd_signal FROM m")
def win_macd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Convergence of two exponential means, and its signal line."""
    rows = w_.macd(_daily(spark, sf_dir).select("instrument_key", "day", "close"), "instrument_key", ["day"], "close")
    return rows.select("instrument_key", "day", _r(F.col("macd"), "macd", 4), _r(F.col("macd_signal"), "macd_signal", 4))


def _rsi_sql(n: int) -> str:
    up, down = (_ema_sql(c, 1 - 1 / n, _BYDAY) for c in ("up", "down"))
    return f"round(CASE WHEN count(up) OVER {_BYDAY} >= {n} THEN 100 - 100 / (1 + {up} / nullif({down}, 0)) END, 4) AS rsi_{n}"


@register("win_rsi", b.with_(b.BARS, b.DAILY, f"s AS (SELECT instrument_key, day, close - lag(close) OVER {_BYDAY} AS c FROM daily)", "g AS (SELECT instrument_key, day, CASE WHEN c IS NOT NULL THEN greatest(c, 0.0) END AS up, CASE WHEN c IS NOT NULL THEN greatest(-c, 0.0) END AS down, coalesce(greatest(c, 0.0), 0.0) AS up0, coalesce(greatest(-c, 0.0), 0.0) AS down0 FROM s)")
  + _HEAD + f"{_rsi_sql(14)}, {_rsi_sql(28)}, round(100 - 100 / (1 + {_gate('avg(up0)', 14, 'up0')} / nullif({_gate('avg(down0)', 14, 'down0')}, 0)), 4) AS rsi_simple_14 FROM g")
def win_rsi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relative strength by recursive means over 14 and 28 days, and by plain ones over 14."""
    rows = _daily(spark, sf_dir).select("instrument_key", "day", "close")
    for n in (14, 28):
        rows = w_.rsi(rows, "instrument_key", ["day"], "close", n, f"rsi_{n}")
    rows = w_.rsi_simple(rows, "instrument_key", ["day"], "close", 14, "rsi_simple_14")
    return rows.select("instrument_key", "day", *[_r(F.col(c), c, 4) for c in ("rsi_14", "rsi_28", "rsi_simple_14")])


_PAIR = """pair AS (SELECT a.instrument_key, a.day, a.close AS own, s.close AS bench FROM daily a LEFT JOIN daily s ON a.day = s.day AND s.instrument_key = 'equity:S1' WHERE a.instrument_key <> 'equity:S1'),
rets AS (SELECT *, own / lag(own) OVER w - 1 AS x, bench / lag(bench) OVER w - 1 AS y, (own / lag(own, 20) OVER w) / (bench / lag(bench, 20) OVER w) AS strength FROM pair WINDOW w AS (PARTITION BY instrument_key ORDER BY day)),
two AS (SELECT *, CASE WHEN y IS NOT NULL THEN x END AS bx, CASE WHEN x IS NOT NULL THEN y END AS by_, x - y AS d FROM rets)"""


def _joint(n: int, expression: str) -> str:
    frame = f"(PARTITION BY instrument_key ORDER BY day ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count(bx) OVER {frame} >= {n} THEN {expression.replace('@', 'OVER ' + frame)} END"


_CORR = "covar_samp(bx, by_) @ / nullif(stddev_samp(bx) @ * stddev_samp(by_) @, 0)"
_RELATIVES = ("rel_strength_20d", "beta_60d", "alpha_20d", "corr_20d", "corr_60d", "idio_vol_20d")


@register("win_relative", b.with_(b.BARS, b.DAILY, _PAIR) + _HEAD + f"""round(strength, 4) AS rel_strength_20d, round({_joint(60, 'covar_samp(bx, by_) @')} / nullif({_gate('var_samp(y)', 60, 'y')}, 0), 4) AS beta_60d,
  round({_gate('avg(x)', 20, 'x')} - {_gate('avg(y)', 20, 'y')}, 4) AS alpha_20d, round({_joint(20, _CORR)}, 4) AS corr_20d, round({_joint(60, _CORR)}, 4) AS corr_60d, round({_gate('stddev_samp(d)', 20, 'd')} * sqrt(252), 4) AS idio_vol_20d FROM two""")
def win_relative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The relative family against a benchmark, which is left out itself."""
    rows = _daily(spark, sf_dir).select("instrument_key", "day", F.col("close").alias("own"))
    bench = rows.where("instrument_key = 'equity:S1'").select("day", F.col("own").alias("bench"))
    rows = rows.where("instrument_key <> 'equity:S1'").join(bench, "day", "left")
    rows = w_.relative(rows, "instrument_key", ["day"], "own", "bench")
    return rows.select("instrument_key", "day", *[_r(F.col(c), c, 4) for c in _RELATIVES])


@register("win_max_availability", b.with_(b.BARS, b.DAILY) + _HEAD + "CAST(CAST(max(ts_available) OVER (PARTITION BY instrument_key ORDER BY day ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS DATE) AS VARCHAR) AS seen FROM daily")
def win_max_availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Availability of a rolling feature: the latest of its sources."""
    return _daily(spark, sf_dir).select("instrument_key", "day", F.max("ts_available").over(w_.trailing(_by_day(), 5)).cast("date").cast("string").alias("seen"))


@register("win_last_24h", b.with_(b.ALERTS) + """SELECT event_id, round(sum(premium) OVER w, 4) AS premium_24h, count(CASE WHEN is_sweep THEN 1 END) OVER w AS sweeps_24h FROM alerts
  WINDOW w AS (PARTITION BY instrument_key ORDER BY epoch_us(ts_event) RANGE BETWEEN 86399999999 PRECEDING AND CURRENT ROW)""")
def win_last_24h(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums over (t - 24h, t]."""
    rows = b.alerts(spark, sf_dir).withColumn("t", micros("ts_event"))
    w = w_.time_upto("instrument_key", "t", 86400)
    return rows.select("event_id", _r(F.sum("premium").over(w), "premium_24h", 4), F.count(F.when(F.col("is_sweep"), 1)).over(w).alias("sweeps_24h"))


@register("win_flow_context", b.with_(b.ALERTS, "x AS (SELECT *, epoch_us(ts_event) AS t FROM alerts)") + """SELECT event_id, count(*) OVER h AS n_1h,
  round(CASE WHEN count(*) OVER q > 0 THEN CASE WHEN put_call = 'C' THEN count(CASE WHEN put_call = 'C' THEN 1 END) OVER q ELSE count(CASE WHEN put_call = 'P' THEN 1 END) OVER q END / count(*) OVER q ELSE 0.5 END, 6) AS agreement_4h,
  coalesce(len(list_distinct(list(CAST(ts_event AS DATE)) OVER d)), 0) AS days_5d FROM x
  WINDOW h AS (PARTITION BY instrument_key ORDER BY t RANGE BETWEEN 3599999999 PRECEDING AND 1 PRECEDING), q AS (PARTITION BY instrument_key ORDER BY t RANGE BETWEEN 14399999999 PRECEDING AND 1 PRECEDING),
  d AS (PARTITION BY instrument_key ORDER BY t RANGE BETWEEN 431999999999 PRECEDING AND 1 PRECEDING)""")
def win_flow_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History strictly before a row: count, agreement of direction, distinct days."""
    rows = b.alerts(spark, sf_dir).withColumn("t", micros("ts_event"))
    h, q, d = (w_.time_before("instrument_key", "t", s) for s in (3600, 14400, 432000))
    side = lambda s: F.count(F.when(F.col("put_call") == s, 1)).over(q)
    return rows.select(
        "event_id", F.count("*").over(h).alias("n_1h"), _r(F.when(F.count("*").over(q) > 0, F.try_divide(F.when(F.col("put_call") == "C", side("C")).otherwise(side("P")), F.count("*").over(q))).otherwise(0.5), "agreement_4h"),
        F.size(F.collect_set(F.col("ts_event").cast("date")).over(d)).cast("long").alias("days_5d"),
    )


_BASE = """x AS (SELECT *, epoch_us(ts_event) AS t, CASE WHEN premium > 50 THEN 1.0 ELSE 0.0 END AS won FROM alerts WHERE k % 4 <> 0),
u AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY instrument_key, t ORDER BY event_id DESC) = 1)"""


@register("win_base_rate", b.with_(b.ALERTS, _BASE) + """SELECT event_id, count(*) OVER w AS n, round(avg(won) OVER w, 6) AS win_rate, round(abs(avg(won) OVER w - 0.5) * 2, 6) AS conviction FROM u
  WINDOW w AS (PARTITION BY instrument_key ORDER BY t RANGE BETWEEN 7776000000000 PRECEDING AND 1 PRECEDING)""")
def win_base_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trailing base rate over [t - 90d, t), truncated labels left out; of rows with equal key and time the last counts."""
    rows = b.alerts(spark, sf_dir).where("k % 4 <> 0").withColumn("t", micros("ts_event")).withColumn("won", (F.col("premium") > 50).cast("double"))
    rows = keep_one(rows, ["instrument_key", "t"], [F.desc("event_id")])
    w = w_.time_before("instrument_key", "t", 90 * 86400, closed=True)
    return rows.select("event_id", F.count("*").over(w).alias("n"), _r(F.avg("won").over(w), "win_rate"), _r(F.abs(F.avg("won").over(w) - 0.5) * 2, "conviction"))


@register("label_returns", b.with_(b.BARS, b.DAILY, "f AS (SELECT *, lead(close, 5) OVER w / close - 1 AS fr, lead(day, 5) OVER w AS hit_day FROM daily WINDOW w AS (PARTITION BY instrument_key ORDER BY day))") + "SELECT instrument_key, CAST(day AS VARCHAR) AS day, round(fr, 6) AS forward_return, CAST(sign(fr) AS INTEGER) AS direction, CAST(hit_day + 1 AS VARCHAR) AS available FROM f WHERE fr IS NOT NULL")
def label_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forward return, its sign, available a day after the resolving bar; the tail is dropped."""
    days = b.daily(b.bars(spark, sf_dir))
    rows = days.select("instrument_key", "day", (F.lead("close", 5).over(_by_day()) / F.col("close") - 1).alias("fr"), F.lead("day", 5).over(_by_day()).alias("at"))
    return rows.where("fr IS NOT NULL").select("instrument_key", F.col("day").cast("string").alias("day"), _r(F.col("fr"), "forward_return"), F.signum("fr").cast("int").alias("direction"), F.date_add("at", 1).cast("string").alias("available"))


@register("label_classes", b.with_(b.BARS, b.DAILY) + _HEAD + ", ".join(f"round(lead(close, {h}) OVER w / close - 1, 6) AS r{h}" for h in (1, 5, 10, 20)) + f", CASE WHEN coalesce(lead(close, 1) OVER w / close - 1, 0) > 0.01 THEN 1 WHEN coalesce(lead(close, 1) OVER w / close - 1, 0) < -0.01 THEN -1 ELSE 0 END AS label FROM daily {_W}")
def label_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several horizons, the tail kept; no return classifies as 0."""
    ahead = lambda h: F.lead("close", h).over(_by_day()) / F.col("close") - 1
    one = F.coalesce(ahead(1), F.lit(0.0))
    return _daily(spark, sf_dir).select("instrument_key", "day", *[_r(ahead(h), f"r{h}") for h in (1, 5, 10, 20)], F.when(one > 0.01, 1).when(one < -0.01, -1).otherwise(0).alias("label"))


_HORIZONS = (1, 2, 3, 5, 10, 15, 20)
#: Residuals are summed as they are: a difference of sums of squares would lose a nearly perfect line's to rounding.
_TREND = f"""ahead AS (SELECT instrument_key, day, list(close) OVER (PARTITION BY instrument_key ORDER BY day ROWS BETWEEN CURRENT ROW AND 20 FOLLOWING) AS ys FROM daily),
cut AS (SELECT instrument_key, day, h, list_transform(ys[1:h + 1], lambda y: y - ys[1]) AS y FROM ahead, (VALUES {", ".join(f"({h})" for h in _HORIZONS if h > 1)}) v(h) WHERE len(ys) > h),
fit AS (SELECT *, list_sum(y) / (h + 1) AS m, list_sum(list_transform(range(0, h + 1), lambda k: (k - h / 2.0::DOUBLE) * y[k + 1])) / (h * (h + 1) * (h + 2) / 12.0::DOUBLE) AS b FROM cut),
res AS (SELECT *, list_sum(list_transform(range(0, h + 1), lambda k: (y[k + 1] - m - b * (k - h / 2.0::DOUBLE)) ** 2)) AS rest, list_sum(list_transform(y, lambda v: (v - m) ** 2)) AS syy FROM fit),
t AS (SELECT *, b / sqrt(rest / (h - 1) / (h * (h + 1) * (h + 2) / 12.0::DOUBLE)) AS t FROM res WHERE rest > syy * 1e-12),
best AS (SELECT *, row_number() OVER (PARTITION BY instrument_key, day ORDER BY round(abs(t), 6) DESC, h) AS nth FROM t)"""


@register("label_trend_scan", b.with_(b.BARS, b.DAILY, _TREND) + "SELECT instrument_key, CAST(day AS VARCHAR) AS day, round(t, 3) AS t, CAST(h AS INTEGER) AS horizon FROM best WHERE nth = 1")
def label_trend_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Horizon with the strongest slope statistic, the shorter of equal ones; one frame serves all horizons."""
    rows = w_.trend_scan(_daily(spark, sf_dir).select("instrument_key", "day", "close"), "instrument_key", ["day"], "close", _HORIZONS)
    return rows.select("instrument_key", "day", _r(F.col("t"), "t", 3), "horizon")


@register("win_straddle_returns", b.with_(b.BARS, b.DAILY, "s AS (SELECT instrument_key, day, close / lag(close, 20) OVER w - 1 AS a, close / lag(close, 60) OVER w - 1 AS b FROM daily WINDOW w AS (PARTITION BY instrument_key ORDER BY day))") + "SELECT instrument_key, CAST(day AS VARCHAR) AS day, round(a, 6) AS r20, round(b, 6) AS r60 FROM s WHERE a IS NOT NULL OR b IS NOT NULL")
def win_straddle_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trailing returns; a row without either is dropped."""
    rows = _daily(spark, sf_dir).select("instrument_key", "day", _r(w_.change(_by_day(), "close", 20), "r20"), _r(w_.change(_by_day(), "close", 60), "r60"))
    return rows.where("r20 IS NOT NULL OR r60 IS NOT NULL")


@register("win_difference", b.with_(b.BARS, b.DAILY) + _HEAD + f"round(vwap - lag(vwap) OVER w, 6) AS change_1d FROM daily {_W}")
def win_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day-over-day difference."""
    return _daily(spark, sf_dir).select("instrument_key", "day", _r(F.col("vwap") - F.lag("vwap").over(_by_day()), "change_1d"))


@register("win_vol_of_vol", "WITH d AS (SELECT user_id AS instrument_key, CAST(ts AS DATE) AS day, last(value ORDER BY ts) AS c FROM events WHERE value > 0 GROUP BY 1, 2), l AS (SELECT *, ln(c / lag(c) OVER (PARTITION BY instrument_key ORDER BY day)) AS lr FROM d) SELECT instrument_key, CAST(day AS VARCHAR) AS day, round(" + _gate("stddev_samp(lr)", 20, "lr") + ", 6) AS vol FROM l")
def win_vol_of_vol(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deviation of log returns of the last value per day, gated."""
    days = b.read(spark, sf_dir, "events").where("value > 0").groupBy(F.col("user_id").alias("instrument_key"), F.col("ts").cast("date").cast("string").alias("day")).agg(F.max_by("value", "ts").alias("c"))
    days = days.withColumn("lr", F.ln(F.col("c") / F.lag("c").over(_by_day())))
    return days.select("instrument_key", "day", _r(w_.gated(_by_day(), "lr", 20, F.stddev_samp), "vol"))


@register("win_atr_backfilled", b.with_(b.BARS, b.DAILY, _VOL, f"a AS (SELECT instrument_key, day, {_gate('avg(tr)', 14, 'tr')} AS atr FROM t)") + _HEAD + "round(coalesce(atr, first_value(atr IGNORE NULLS) OVER (PARTITION BY instrument_key ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 6) AS atr FROM a")
def win_atr_backfilled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """True range mean, its warm-up filled from the first value: a look-ahead kept on purpose."""
    rows = _daily(spark, sf_dir).withColumn("tr", w_.true_range(_by_day())).withColumn("atr", w_.gated(_by_day(), "tr", 14, F.avg))
    ahead = F.first("atr", ignorenulls=True).over(_by_day().rowsBetween(0, Window.unboundedFollowing))
    return rows.select("instrument_key", "day", _r(F.coalesce("atr", ahead), "atr"))


@register("win_realised_vol", b.with_(b.BARS, b.DAILY, _VOL) + _HEAD + f"round({_gate('stddev_pop(lr)', 20, 'lr')}, 6) AS realised, " + ", ".join(f"round(close / lag(close, {n}) OVER {_BYDAY} - 1, 6) AS r{n}" for n in (1, 5, 30)) + " FROM t")
def win_realised_vol(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Population deviation of twenty log returns, and the returns over 1, 5 and 30 days."""
    rows = _daily(spark, sf_dir).withColumn("lr", F.ln(F.col("close") / F.lag("close").over(_by_day())))
    return rows.select("instrument_key", "day", _r(w_.gated(_by_day(), "lr", 20, F.stddev_pop), "realised"), *[_r(w_.change(_by_day(), "close", n), f"r{n}") for n in (1, 5, 30)])


@register("label_horizon_routing", "SELECT o_orderkey, CASE WHEN o_orderkey % 40 <= 2 THEN 'intraday' WHEN o_orderkey % 40 <= 21 THEN 'swing' ELSE 'leap' END AS horizon, CASE WHEN o_totalprice / 10000 < 15 THEN 'low' WHEN o_totalprice / 10000 > 25 THEN 'high' ELSE 'normal' END AS regime FROM orders")
def label_horizon_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Horizon by days to expiry, regime by level."""
    from pitlake.functions.scalars import horizon, volatility_regime

    return b.read(spark, sf_dir, "orders").select("o_orderkey", horizon(F.col("o_orderkey") % 40).alias("horizon"), volatility_regime(F.col("o_totalprice") / 10000).alias("regime"))
