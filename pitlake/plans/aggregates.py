"""Queries of group aggregations and quality checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pitlake.operators import quality
from pitlake.operators.daily import fill_days_native_first
from pitlake.operators.market import atm_straddle, microstructure, oi_momentum
from pitlake.plans import bindings as b
from pitlake.plans.catalog import register



def _day() -> Column:
    return F.col("ts_event").cast("date").cast("string").alias("day")


def _r(column: Column | str, name: str, digits: int = 6) -> Column:
    return F.round(column, digits).alias(name)


@register("agg_daily_ohlcv", b.with_(b.BARS, b.DAILY) + """SELECT instrument_key, CAST(day AS VARCHAR) AS day, round(open, 6) AS open, round(high, 6) AS high,
  round(low, 6) AS low, round(close, 6) AS close, volume, round(vwap, 6) AS vwap, n_bars FROM daily""")
def agg_daily_ohlcv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intraday bars to daily bars."""
    days = b.daily(b.bars(spark, sf_dir))
    return days.select("instrument_key", F.col("day").cast("string").alias("day"), *[_r(c, c, 6) for c in ("open", "high", "low", "close")], "volume", _r("vwap", "vwap", 6), "n_bars")


@register("agg_daily_prefer_native", b.with_(b.BARS, "native AS (SELECT instrument_key, CAST(ts_event AS DATE) AS day, last(close ORDER BY ts_event, seq) AS close FROM bars WHERE timeframe = '1Day' GROUP BY ALL)",
  "made AS (SELECT instrument_key, CAST(ts_event AS DATE) AS day, last(close ORDER BY ts_event, seq) AS close FROM bars WHERE timeframe <> '1Day' GROUP BY ALL)")
  + """SELECT instrument_key, CAST(day AS VARCHAR) AS day, round(close, 4) AS close, 'native' AS origin FROM native UNION ALL
  SELECT instrument_key, CAST(day AS VARCHAR), round(close, 4), 'resampled' FROM made m WHERE NOT EXISTS (SELECT 1 FROM native n WHERE n.instrument_key = m.instrument_key AND n.day = m.day)""")
def agg_daily_prefer_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars where there are any, resampled ones elsewhere; one aggregation decides both."""
    days = fill_days_native_first(b.bars(spark, sf_dir), F.col("timeframe") == "1Day")
    return days.select("instrument_key", F.col("day").cast("string").alias("day"), F.round("close", 4).alias("close"), "origin")


@register("agg_flow_daily", b.with_(b.ALERTS) + """SELECT instrument_key, CAST(CAST(ts_event AS DATE) AS VARCHAR) AS day, round(sum(premium), 4) AS total,
  round(coalesce(sum(premium) FILTER (WHERE put_call = 'C'), 0), 4) AS calls, round(coalesce(sum(premium) FILTER (WHERE put_call = 'P'), 0), 4) AS puts,
  count(*) FILTER (WHERE is_sweep) AS sweeps,
  CASE WHEN coalesce(sum(premium) FILTER (WHERE put_call = 'P'), 0) > 0 THEN round(coalesce(sum(premium) FILTER (WHERE put_call = 'C'), 0) / sum(premium) FILTER (WHERE put_call = 'P'), 6) END AS call_put_ratio
  FROM alerts GROUP BY 1, 2""")
def agg_flow_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Premiums by side, sweeps and the call-put ratio."""
    side = lambda s: F.coalesce(F.sum(F.when(F.col("put_call") == s, F.col("premium"))), F.lit(0.0))
    days = b.alerts(spark, sf_dir).groupBy("instrument_key", _day())
    return days.agg(
        _r(F.sum("premium"), "total", 4), _r(side("C"), "calls", 4), _r(side("P"), "puts", 4), F.count_if("is_sweep").alias("sweeps"),
        F.when(side("P") > 0, F.round(F.try_divide(side("C"), side("P")), 6)).alias("call_put_ratio"),
    )


_NET = """net AS (SELECT instrument_key, CAST(ts_event AS DATE) AS d, sum(CASE WHEN put_call = 'C' THEN premium ELSE -premium END) AS net,
  coalesce(sum(k) FILTER (WHERE is_sweep), 0) AS sw, sum(k) AS al FROM alerts GROUP BY 1, 2)"""


@register("agg_cross_section_zscore", b.with_(b.ALERTS, _NET, "logs AS (SELECT *, sign(net) * ln(1 + abs(net)) AS x FROM net)")
  + """SELECT instrument_key, CAST(d AS VARCHAR) AS day, round(CASE WHEN stddev_samp(x) OVER w > 0 THEN (x - avg(x) OVER w) / stddev_samp(x) OVER w ELSE 0.0 END, 6) AS z
  FROM logs WINDOW w AS (PARTITION BY d)""")
def agg_cross_section_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signed-log z-score across keys per day."""
    net = F.sum(F.when(F.col("put_call") == "C", F.col("premium")).otherwise(-F.col("premium")))
    rows = b.alerts(spark, sf_dir).groupBy("instrument_key", _day()).agg(net.alias("net"))
    rows = rows.withColumn("x", F.signum("net") * F.log1p(F.abs("net")))
    w = Window.partitionBy("day")
    spread = F.stddev_samp("x").over(w)
    return rows.select("instrument_key", "day", F.round(F.when(spread > 0, (F.col("x") - F.avg("x").over(w)) / spread).otherwise(0.0), 6).alias("z"))


@register("agg_winsorised_share", b.with_(b.ALERTS, _NET, "shares AS (SELECT instrument_key, d, CASE WHEN al > 0 THEN sw / al END AS share FROM net)", "cuts AS (SELECT d, quantile_cont(share, 0.01) AS lo, quantile_cont(share, 0.99) AS hi FROM shares GROUP BY 1)")
  + "SELECT instrument_key, CAST(d AS VARCHAR) AS day, round(least(greatest(share, lo), hi), 6) AS share FROM shares JOIN cuts USING (d) WHERE share IS NOT NULL")
def agg_winsorised_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sweep share cut at the day's first and last percentile."""
    rows = b.alerts(spark, sf_dir).groupBy("instrument_key", _day()).agg(F.coalesce(F.sum(F.when(F.col("is_sweep"), F.col("k"))), F.lit(0)).alias("sw"), F.sum("k").alias("al"))
    rows = rows.withColumn("share", F.when(F.col("al") > 0, F.try_divide("sw", "al"))).where("share IS NOT NULL")
    # A day's bounds are one aggregate; joining them back keeps its rows out of any one task's memory.
    cuts = rows.groupBy("day").agg(F.percentile("share", F.array(F.lit(0.01), F.lit(0.99))).alias("cut"))
    low, high = F.col("cut")[0], F.col("cut")[1]
    return rows.join(cuts, "day").select("instrument_key", "day", F.round(F.least(F.greatest("share", low), high), 6).alias("share"))


_SIZED = "sized AS (SELECT *, CASE WHEN seq % 3 <> 0 THEN bid_sz END AS b, CASE WHEN seq % 3 <> 0 THEN ask_sz END AS a FROM quotes)"


@register("agg_microstructure", b.with_(b.QUOTES, _SIZED) + """SELECT instrument_key, CAST(CAST(ts_event AS DATE) AS VARCHAR) AS day, round(avg(ask_px - bid_px), 6) AS spread,
  round(avg((ask_px - bid_px) / ((ask_px + bid_px) / 2) * 10000), 4) AS spread_bps, round(avg((b - a) / (b + a)), 6) AS imbalance,
  round(avg(b + a), 4) AS depth, round(last((ask_px + bid_px) / 2 ORDER BY ts_event, seq), 6) AS last_mid, count(*) AS n_quotes, count(b) AS n_sized FROM sized GROUP BY 1, 2""")
def agg_microstructure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spread, imbalance, depth, the last middle price, and how many quotes there were, with sizes and without."""
    some = F.col("seq") % 3 != 0
    q = b.quotes(spark, sf_dir).withColumns({"bid_sz": F.when(some, F.col("bid_sz")), "ask_sz": F.when(some, F.col("ask_sz"))})
    days = microstructure(q)
    return days.select("instrument_key", F.col("day").cast("string").alias("day"), _r("spread", "spread", 6), _r("spread_bps", "spread_bps", 4), _r("imbalance", "imbalance"), _r("depth", "depth", 4), _r("last_mid", "last_mid", 6), "n_quotes", "n_sized")


@register("agg_darkpool", b.with_(b.QUOTES) + """SELECT instrument_key, CAST(CAST(ts_event AS DATE) AS VARCHAR) AS day, round(sum(price * bid_sz), 2) AS notional, round(avg(bid_sz), 6) AS avg_size,
  count(*) AS n, round(avg(CASE WHEN price > ask_px * 0.99 THEN 1.0 ELSE 0.0 END), 6) AS above, round(avg(CASE WHEN price < bid_px * 1.01 THEN 1.0 ELSE 0.0 END), 6) AS below FROM quotes GROUP BY 1, 2""")
def agg_darkpool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prints: sums, counts and shares beyond the quote; the denominator is all rows."""
    q = b.quotes(spark, sf_dir)
    share = lambda c: F.avg(F.coalesce(c.cast("double"), F.lit(0.0)))
    return q.groupBy("instrument_key", _day()).agg(
        _r(F.sum(F.col("price") * F.col("bid_sz")), "notional", 2), _r(F.avg("bid_sz"), "avg_size", 6), F.count("*").alias("n"),
        _r(share(F.col("price") > F.col("ask_px") * 0.99), "above"), _r(share(F.col("price") < F.col("bid_px") * 1.01), "below"),
    )


_GREEKS = """greeks AS (SELECT 'equity:S' || l_suppkey AS instrument_key, CAST(l_shipdate AS DATE) AS d, l_extendedprice / 1000 AS call_gamma, -l_extendedprice * l_tax / 100 AS put_gamma,
  l_quantity AS strike, l_linenumber AS dte, l_orderkey * 10 + l_linenumber AS seq FROM lineitem)"""


def _greeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.read(spark, sf_dir, "lineitem").selectExpr(
        "concat('equity:S', l_suppkey) AS instrument_key", "l_shipdate AS ts_event", "l_extendedprice / 1000 AS call_gamma", "-l_extendedprice * l_tax / 100 AS put_gamma",
        "l_quantity AS strike", "l_linenumber AS dte", "l_orderkey * 10 + l_linenumber AS seq",
    )


@register("agg_greek_exposure", b.with_(_GREEKS) + """SELECT instrument_key, CAST(d AS VARCHAR) AS day, round(sum(call_gamma + put_gamma), 8) AS net_gamma,
  round(abs(sum(put_gamma)) / nullif(abs(sum(call_gamma)), 0), 6) AS put_call_ratio, first(strike ORDER BY call_gamma + put_gamma DESC, seq) AS max_gamma_strike,
  round(sum(dte * abs(call_gamma + put_gamma)) / nullif(sum(abs(call_gamma + put_gamma)), 0), 6) AS weighted_dte FROM greeks GROUP BY 1, 2""")
def agg_greek_exposure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Net exposure (call plus put), ratio, the strike with most gamma, gamma-weighted days."""
    gamma = F.col("call_gamma") + F.col("put_gamma")
    return _greeks(spark, sf_dir).groupBy("instrument_key", _day()).agg(
        _r(F.sum(gamma), "net_gamma", 8), _r(F.try_divide(F.abs(F.sum("put_gamma")), F.abs(F.sum("call_gamma"))), "put_call_ratio"), F.max_by("strike", F.struct(gamma.alias("g"), (-F.col("seq")).alias("s"))).alias("max_gamma_strike"),
        _r(F.try_divide(F.sum(F.col("dte") * F.abs(gamma)), F.sum(F.abs(gamma))), "weighted_dte"),
    )


_SIDES = "g AS (SELECT d, CASE WHEN year(d) % 2 = 0 THEN call_gamma END AS c, put_gamma AS p, strike AS whole FROM greeks)"


@register("agg_net_gex", b.with_(_GREEKS, _SIDES) + "SELECT CAST(d AS VARCHAR) AS day, round(coalesce(avg(c - p), avg(whole)), 9) AS net_gex FROM g GROUP BY d")
def agg_net_gex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily mean of call minus put gamma; the provider's own total on days that lack the sides."""
    rows = _greeks(spark, sf_dir).withColumn("call_gamma", F.when(F.year("ts_event") % 2 == 0, F.col("call_gamma")))
    return rows.groupBy(_day()).agg(_r(F.coalesce(F.avg(F.col("call_gamma") - F.col("put_gamma")), F.avg("strike")), "net_gex", 9))


@register("agg_options_sentiment", b.with_(b.SNAPS) + """SELECT 'sector:' || sector AS instrument_key, CAST(CAST(ts_event AS DATE) AS VARCHAR) AS day, last(level ORDER BY ts_event, seq) AS level, NULL::BIGINT AS n FROM snaps GROUP BY 1, 2
  UNION ALL SELECT instrument_key, CAST(CAST(ts_event AS DATE) AS VARCHAR), last(level ORDER BY ts_event, seq), count(*) FROM snaps GROUP BY 1, 2""")
def agg_options_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last level per key and day, sector rows appended under their own key, missing columns null."""
    snaps, last = b.snaps(spark, sf_dir), F.max_by("level", F.struct("ts_event", "seq")).alias("level")
    keys = snaps.groupBy("instrument_key", _day()).agg(last, F.count("*").alias("n"))
    sectors = snaps.groupBy(F.concat(F.lit("sector:"), "sector").alias("instrument_key"), _day()).agg(last)
    return keys.unionByName(sectors, allowMissingColumns=True)


@register("agg_fails_daily", b.with_(b.QUOTES) + "SELECT instrument_key, CAST(CAST(ts_event AS DATE) AS VARCHAR) AS day, sum(bid_sz) AS quantity, round(sum(bid_sz * price), 2) AS value, count(*) AS n, round(avg(price), 6) AS avg_price FROM quotes GROUP BY 1, 2")
def agg_fails_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fails to deliver per day."""
    return b.quotes(spark, sf_dir).groupBy("instrument_key", _day()).agg(F.sum("bid_sz").alias("quantity"), _r(F.sum(F.col("bid_sz") * F.col("price")), "value", 2), F.count("*").alias("n"), _r(F.avg("price"), "avg_price", 6))


@register("agg_market_sentiment", b.with_(b.ALERTS, "t AS (SELECT CAST(ts_event AS DATE) AS d, sum(premium) FILTER (WHERE put_call = 'C') AS c, sum(premium) FILTER (WHERE put_call = 'P') AS p FROM alerts GROUP BY 1)")
  + "SELECT CAST(d AS VARCHAR) AS day, round(coalesce((c - p) / nullif(c + p, 0), 0.0), 6) AS score FROM t")
def agg_market_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(calls - puts) / (calls + puts), 0 where there is nothing."""
    side = lambda s: F.sum(F.when(F.col("put_call") == s, F.col("premium")))
    days = b.alerts(spark, sf_dir).groupBy(_day()).agg(side("C").alias("c"), side("P").alias("p"))
    return days.select("day", _r(F.coalesce(F.try_divide(F.col("c") - F.col("p"), F.col("c") + F.col("p")), F.lit(0.0)), "score"))


_RETURNS = "rets AS (SELECT instrument_key, day, close / lag(close) OVER (PARTITION BY instrument_key ORDER BY day) - 1 AS r FROM daily)"


def _returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pitlake.operators.windows import change, series

    days = b.daily(b.bars(spark, sf_dir))
    return days.select("instrument_key", F.col("day").cast("string").alias("day"), change(series("instrument_key", ["day"]), "close", 1).alias("r"))


@register("agg_dispersion", b.with_(b.BARS, b.DAILY, _RETURNS) + "SELECT CAST(day AS VARCHAR) AS day, round(stddev_samp(r), 6) AS dispersion FROM rets WHERE r IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def agg_dispersion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deviation of the day's returns across keys."""
    return _returns(spark, sf_dir).where("r IS NOT NULL").groupBy("day").agg(_r(F.stddev_samp("r"), "dispersion"), F.count("*").alias("n")).where("n > 1").drop("n")


@register("agg_breadth", b.with_(b.BARS, b.DAILY, _RETURNS) + "SELECT CAST(day AS VARCHAR) AS day, round(avg(CASE WHEN r > 0 THEN 1.0 ELSE 0.0 END), 6) AS breadth FROM rets WHERE r IS NOT NULL GROUP BY 1")
def agg_breadth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of keys that rose."""
    return _returns(spark, sf_dir).where("r IS NOT NULL").groupBy("day").agg(_r(F.avg((F.col("r") > 0).cast("double")), "breadth"))


@register("agg_yield_slope", b.with_(b.SNAPS, "c AS (SELECT CAST(ts_event AS DATE) AS d, sector, last(level ORDER BY seq) AS y FROM snaps GROUP BY 1, 2)")
  + "SELECT CAST(d AS VARCHAR) AS day, round(max(y) FILTER (WHERE sector = '1-URGENT') - max(y) FILTER (WHERE sector = '5-LOW'), 4) AS slope FROM c GROUP BY d")
def agg_yield_slope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pivot of maturities, long minus short."""
    rows = b.snaps(spark, sf_dir).groupBy(_day()).pivot("sector", ["1-URGENT", "5-LOW"]).agg(F.max_by("level", "seq"))
    return rows.select("day", _r(F.col("`1-URGENT`") - F.col("`5-LOW`"), "slope", 4))


@register("agg_toxicity_daily", b.with_(b.ALERTS, "t AS (SELECT instrument_key, CAST(ts_event AS DATE) AS d, sum(premium) FILTER (WHERE put_call = 'C') AS a, sum(premium) FILTER (WHERE put_call = 'P') AS b FROM alerts GROUP BY 1, 2)")
  + "SELECT instrument_key, CAST(d AS VARCHAR) AS day, round(abs(coalesce(a, 0) - coalesce(b, 0)) / nullif(coalesce(a, 0) + coalesce(b, 0), 0), 6) AS vpin FROM t")
def agg_toxicity_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-flow imbalance; null where nothing was traded."""
    side = lambda s: F.coalesce(F.sum(F.when(F.col("put_call") == s, F.col("premium"))), F.lit(0.0))
    days = b.alerts(spark, sf_dir).groupBy("instrument_key", _day()).agg(side("C").alias("a"), side("P").alias("b"))
    return days.select("instrument_key", "day", _r(F.try_divide(F.abs(F.col("a") - F.col("b")), F.col("a") + F.col("b")), "vpin"))


@register("agg_iv_surface", b.with_("iv AS (SELECT 'equity:U' || o_custkey AS instrument_key, CAST(date_trunc('month', o_orderdate) AS DATE) AS d, o_orderkey % 60 AS dte, o_totalprice AS iv, o_totalprice * 0.9 + o_orderkey % 7 AS call_iv, o_totalprice AS put_iv, o_orderkey AS seq FROM orders)",
  "n AS (SELECT *, row_number() OVER (PARTITION BY instrument_key, d ORDER BY dte, seq) AS nth FROM iv WHERE dte > 0)")
  + """SELECT instrument_key, CAST(d AS VARCHAR) AS day, round(max((put_iv - call_iv) / nullif(call_iv, 0)) FILTER (WHERE nth = 1), 6) AS skew,
  round((max(iv) FILTER (WHERE nth = 2) - max(iv) FILTER (WHERE nth = 1)) / nullif(max(iv) FILTER (WHERE nth = 1), 0), 6) AS slope FROM n WHERE nth <= 2 GROUP BY 1, 2""")
def agg_iv_surface(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest and next expiry: skew and slope."""
    iv = b.read(spark, sf_dir, "orders").selectExpr("concat('equity:U', o_custkey) AS instrument_key", "cast(cast(date_trunc('month', o_orderdate) AS date) AS string) AS day", "o_orderkey % 60 AS dte", "o_totalprice AS iv", "o_totalprice * 0.9 + o_orderkey % 7 AS call_iv", "o_totalprice AS put_iv", "o_orderkey AS seq")
    nth = F.row_number().over(Window.partitionBy("instrument_key", "day").orderBy("dte", "seq"))
    rows = iv.where("dte > 0").withColumn("nth", nth).where("nth <= 2").groupBy("instrument_key", "day")
    at = lambda c, n: F.max(F.when(F.col("nth") == n, F.col(c)))
    return rows.agg(_r(F.try_divide(at("put_iv", 1) - at("call_iv", 1), at("call_iv", 1)), "skew"), _r(F.try_divide(at("iv", 2) - at("iv", 1), at("iv", 1)), "slope"))


_CHAIN = """chain AS (SELECT 'U' || l_suppkey AS underlying, CAST(date_trunc('month', l_shipdate) AS DATE) AS d, CASE WHEN l_linestatus = 'O' THEN 'C' ELSE 'P' END AS side, CASE WHEN l_suppkey % 2 = 0 THEN l_quantity / 50.0 END AS delta,
  l_quantity AS strike, l_extendedprice AS mid, l_orderkey * 10 + l_linenumber AS seq FROM lineitem),
near AS (SELECT *, row_number() OVER (PARTITION BY underlying, d, side ORDER BY abs(abs(delta) - 0.5), seq) AS nth FROM chain WHERE delta IS NOT NULL),
bydelta AS (SELECT underlying, d, sum(mid) AS straddle FROM near WHERE nth = 1 GROUP BY 1, 2 HAVING count(*) = 2),
common AS (SELECT underlying, d, strike FROM chain WHERE delta IS NULL GROUP BY 1, 2, 3 HAVING count(DISTINCT side) = 2),
middle AS (SELECT underlying, d, median(strike) AS m FROM chain WHERE delta IS NULL GROUP BY 1, 2),
chosen AS (SELECT c.underlying, c.d, first(strike ORDER BY abs(strike - m), strike) AS strike FROM common c JOIN middle USING (underlying, d) GROUP BY 1, 2),
bystrike AS (SELECT underlying, d, first(mid ORDER BY seq) FILTER (WHERE side = 'C') + first(mid ORDER BY seq) FILTER (WHERE side = 'P') AS straddle FROM chain JOIN chosen USING (underlying, d, strike) WHERE delta IS NULL GROUP BY 1, 2)"""


@register("agg_atm_straddle", b.with_(_CHAIN) + "SELECT underlying, CAST(d AS VARCHAR) AS day, round(straddle, 4) AS straddle FROM (SELECT * FROM bydelta UNION ALL SELECT * FROM bystrike)")
def agg_atm_straddle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The call and the put nearest to half a delta, together; without deltas those at the common strike nearest to the median."""
    chain = b.read(spark, sf_dir, "lineitem").selectExpr(
        "concat('U', l_suppkey) AS underlying", "cast(cast(date_trunc('month', l_shipdate) AS date) AS string) AS day", "l_linestatus = 'O' AS is_call", "CASE WHEN l_suppkey % 2 = 0 THEN l_quantity / 50.0D END AS delta",
        "l_quantity AS strike", "l_extendedprice AS mid", "l_orderkey * 10 + l_linenumber AS seq",
    )
    return atm_straddle(chain).select("underlying", "day", _r("straddle", "straddle", 4))


@register("agg_latest_snapshot", b.with_(b.SNAPS) + "SELECT instrument_key, seq, status FROM (SELECT *, row_number() OVER (PARTITION BY instrument_key ORDER BY ts_event DESC, seq DESC) AS nth FROM snaps) WHERE nth = 1")
def agg_latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest snapshot per key, as a partial aggregate instead of a sort."""
    newest = F.max_by(F.struct("seq", "status"), F.struct("ts_event", "seq")).alias("x")
    return b.snaps(spark, sf_dir).groupBy("instrument_key").agg(newest).select("instrument_key", "x.*")


@register("agg_label_stats", b.with_(b.ALERTS) + "SELECT coalesce(event_type, 'all') AS horizon, count(*) AS n, round(avg(CASE WHEN premium > 50 THEN 1.0 ELSE 0.0 END), 6) AS win_rate, round(avg(premium), 6) AS mean_mfe FROM alerts GROUP BY GROUPING SETS ((), (event_type))")
def agg_label_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Win rate and mean by horizon and overall, in one grouping-sets pass."""
    rows = b.alerts(spark, sf_dir).rollup("event_type").agg(F.count("*").alias("n"), _r(F.avg((F.col("premium") > 50).cast("double")), "win_rate"), _r(F.avg("premium"), "mean_mfe"))
    return rows.select(F.coalesce("event_type", F.lit("all")).alias("horizon"), "n", "win_rate", "mean_mfe")


_OI = """oi AS (SELECT 'equity:S' || l_suppkey AS instrument_key, CAST(l_shipdate AS DATE) AS d, sum(l_linenumber - 3) + sum(l_quantity - 25) AS change, avg(l_quantity) + avg(l_linenumber * 10) AS held, sum(l_quantity) AS volume, sum(l_extendedprice / 1000) AS prev FROM lineitem GROUP BY 1, 2),
m AS (SELECT instrument_key, d AS day, coalesce(change / nullif(held, 0), 0.0) AS ratio, coalesce(volume / nullif(prev, 0), 0.0) AS turnover FROM oi)"""


@register("agg_oi_momentum", b.with_(_OI) + """SELECT instrument_key, CAST(day AS VARCHAR) AS day, round(ratio, 6) AS oi_buildup_ratio, CASE WHEN ratio > 0 AND turnover > 1.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS new_position_signal,
  round(CASE WHEN count(ratio) OVER w >= 5 THEN sum(ratio) OVER w END, 6) AS oi_change_momentum_5d FROM m WINDOW w AS (PARTITION BY instrument_key ORDER BY day ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) QUALIFY count(ratio) OVER w >= 5""")
def agg_oi_momentum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open-interest build-up over strikes, the new-position signal, and five days of it; days without five are dropped."""
    rows = b.read(spark, sf_dir, "lineitem").selectExpr(
        "concat('equity:S', l_suppkey) AS instrument_key", "l_shipdate AS ts_event", "l_linenumber - 3 AS call_oi_change", "l_quantity - 25 AS put_oi_change",
        "l_quantity AS call_oi", "l_linenumber * 10 AS put_oi", "l_quantity AS volume", "l_extendedprice / 1000 AS prev_oi",
    )
    out = oi_momentum(rows)
    return out.select("instrument_key", F.col("day").cast("string").alias("day"), _r("oi_buildup_ratio", "oi_buildup_ratio"), "new_position_signal", _r("oi_change_momentum_5d", "oi_change_momentum_5d"))


@register("quality_profile", """SELECT 'l_quantity' AS column_name, count(l_quantity) AS n, count(*) - count(l_quantity) AS nulls, round(min(l_quantity), 4) AS low, round(max(l_quantity), 4) AS high, round(avg(l_quantity), 6) AS mean, round(stddev_samp(l_quantity), 6) AS deviation FROM lineitem
  UNION ALL SELECT 'l_discount', count(l_discount), count(*) - count(l_discount), round(min(l_discount), 4), round(max(l_discount), 4), round(avg(l_discount), 6), round(stddev_samp(l_discount), 6) FROM lineitem""")
def quality_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column profile in one pass."""
    out = quality.profile(b.read(spark, sf_dir, "lineitem"), ["l_quantity", "l_discount"])
    return out.select("column_name", "n", "nulls", _r("low", "low", 4), _r("high", "high", 4), _r("mean", "mean"), _r("deviation", "deviation"))


@register("quality_mean_shift", """WITH d AS (SELECT CAST(ts AS DATE) AS d, avg(value) AS m FROM events GROUP BY 1), w AS (SELECT d, m, avg(m) OVER x AS base, stddev_samp(m) OVER x AS sd, count(*) OVER x AS n FROM d WINDOW x AS (ORDER BY d ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
  SELECT CAST(d AS VARCHAR) AS day, round((m - base) / sd, 6) AS z, abs((m - base) / sd) > 2 AS shifted FROM w WHERE n = 7 AND sd > 0""")
def quality_mean_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean of a day against the seven before it; one row per day reaches the unpartitioned window."""
    days = b.read(spark, sf_dir, "events").groupBy(F.col("ts").cast("date").cast("string").alias("day")).agg(F.avg("value").alias("m"))
    w = Window.partitionBy(F.lit(0)).orderBy("day").rowsBetween(-7, -1)
    days = days.select("day", "m", F.avg("m").over(w).alias("base"), F.stddev_samp("m").over(w).alias("sd"), F.count("*").over(w).alias("n"))
    z = (F.col("m") - F.col("base")) / F.col("sd")
    return days.where("n = 7 AND sd > 0").select("day", _r(z, "z"), (F.abs(z) > 2).alias("shifted"))


@register("quality_volume_ratio", """WITH d AS (SELECT event_type, CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY 1, 2), w AS (SELECT *, median(n) OVER (PARTITION BY event_type ORDER BY d ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS base FROM d)
  SELECT event_type, CAST(d AS VARCHAR) AS day, n, CASE WHEN n / base < 0.2 THEN 'FAIL' WHEN n / base < 0.5 THEN 'WARN' ELSE 'OK' END AS status FROM w WHERE base IS NOT NULL""")
def quality_volume_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a day against the median of the five before it."""
    days = b.read(spark, sf_dir, "events").groupBy("event_type", F.col("ts").cast("date").cast("string").alias("day")).agg(F.count("*").alias("n"))
    base = F.percentile("n", F.lit(0.5)).over(Window.partitionBy("event_type").orderBy("day").rowsBetween(-5, -1))
    ratio = F.col("n") / F.col("base")
    status = F.when(ratio < 0.2, "FAIL").when(ratio < 0.5, "WARN").otherwise("OK")
    return days.withColumn("base", base).where("base IS NOT NULL").select("event_type", "day", "n", status.alias("status"))


@register("quality_psi", """WITH e AS (SELECT event_type AS k, count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-15' GROUP BY 1), a AS (SELECT event_type AS k, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-15' GROUP BY 1),
  c AS (SELECT greatest(coalesce(e.n, 0) / sum(e.n) OVER (), 1e-6) AS e, greatest(coalesce(a.n, 0) / sum(a.n) OVER (), 1e-6) AS a FROM e FULL JOIN a USING (k)), r AS (SELECT e / sum(e) OVER () AS e, a / sum(a) OVER () AS a FROM c)
  SELECT round(sum((a - e) * ln(a / e)), 8) AS psi FROM r""")
def quality_psi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stability index between two halves of a month."""
    events = b.read(spark, sf_dir, "events")
    halves = [events.where(c).groupBy(F.col("event_type").alias("k")).agg(F.count("*").alias("n")) for c in ("ts < timestamp_ntz'2024-01-15 00:00:00'", "ts >= timestamp_ntz'2024-01-15 00:00:00'")]
    return quality.stability_index(*halves, "k").select(_r("psi", "psi", 8))


@register("quality_completeness", "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(DISTINCT user_id) AS n, count(DISTINCT user_id) >= 0.8 * (SELECT count(DISTINCT user_id) FROM events) AS complete FROM events GROUP BY 1")
def quality_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct keys of a day against all keys."""
    events = b.read(spark, sf_dir, "events")
    whole = events.agg(F.count_distinct("user_id").alias("whole"))
    days = events.groupBy(F.col("ts").cast("date").cast("string").alias("day")).agg(F.count_distinct("user_id").alias("n"))
    return days.join(F.broadcast(whole)).select("day", "n", (F.col("n") >= 0.8 * F.col("whole")).alias("complete"))  # one row


_HOLES = "h AS (SELECT event_type AS dataset, nullif(k % 5, 0) AS gamma, nullif(k % 50, 0) AS price, CASE WHEN event_type = 'error' THEN NULL ELSE premium END AS premium FROM alerts)"


@register("quality_null_rates", b.with_(b.ALERTS, _HOLES) + " UNION ALL ".join(f"SELECT dataset, '{c}' AS column_name, round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS null_rate, avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) > {t} AS failed FROM h GROUP BY 1" for c, t in (("gamma", 0.95), ("price", 0.05), ("premium", 0.05))))
def quality_null_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null rates per dataset and column: payload columns fail above 5 %, enrichment columns above 95 %."""
    rows = b.alerts(spark, sf_dir).select(
        F.col("event_type").alias("dataset"), F.nullif(F.col("k") % 5, F.lit(0)).alias("gamma"), F.nullif(F.col("k") % 50, F.lit(0)).alias("price"),
        F.when(F.col("event_type") != "error", F.col("premium")).alias("premium"),
    )
    return quality.null_rates(rows, "dataset", payload=["price", "premium"], enrichment=["gamma"]).select("dataset", "column_name", _r("null_rate", "null_rate"), "failed")


@register("quality_write_audit", b.with_(b.ALERTS, _HOLES) + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls, round((count(*) - count({c})) * 100.0 / count(*), 1) AS percent FROM h HAVING count(*) > count({c})" for c in ("dataset", "gamma", "price", "premium")))
def quality_write_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that held nulls when a table was written, out of one pass."""
    rows = b.alerts(spark, sf_dir).select(
        F.col("event_type").alias("dataset"), F.nullif(F.col("k") % 5, F.lit(0)).alias("gamma"), F.nullif(F.col("k") % 50, F.lit(0)).alias("price"),
        F.when(F.col("event_type") != "error", F.col("premium")).alias("premium"),
    )
    return quality.null_audit(rows).select("column_name", "nulls", F.round("percent", 1).alias("percent"))


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars with the columns of Silver, some of them wrong."""
    return b.bars(spark, sf_dir).selectExpr(
        "CASE WHEN seq % 97 = 0 THEN ' ' ELSE cast(seq AS string) END AS event_id", "instrument_key", "ts_event", "CASE WHEN seq % 89 = 0 THEN ts_event - make_dt_interval(0, 1) ELSE ts_available END AS ts_available",
        "open", "CASE WHEN seq % 83 = 0 THEN low - 1 ELSE high END AS high", "low", "close", "CASE WHEN seq % 79 = 0 THEN NULL ELSE volume - 1 END AS volume", "CASE WHEN seq % 73 = 0 THEN 'bond' ELSE 'equity' END AS instrument_type",
    )


_SILVER = """silver AS (SELECT CASE WHEN seq % 97 = 0 THEN ' ' ELSE CAST(seq AS VARCHAR) END AS event_id, instrument_key, ts_event, CASE WHEN seq % 89 = 0 THEN ts_event - INTERVAL 1 HOUR ELSE ts_available END AS ts_available,
  open, CASE WHEN seq % 83 = 0 THEN low - 1 ELSE high END AS high, low, close, CASE WHEN seq % 79 = 0 THEN NULL ELSE volume - 1 END AS volume, CASE WHEN seq % 73 = 0 THEN 'bond' ELSE 'equity' END AS instrument_type FROM bars)"""
_RULES = {
    "ts_event_parseable": "false", "ts_available_parseable": "false", "event_id_required": "event_id IS NULL OR trim(event_id) = ''", "instrument_key_required": "instrument_key IS NULL OR trim(instrument_key) = ''",
    "ts_event_required": "ts_event IS NULL", "ts_available_required": "ts_available IS NULL", "ts_available_ge_ts_event": "ts_available < ts_event", "ts_available_not_future": "ts_available > TIMESTAMP '2001-06-30 00:00:00'",
    **{f"{c}_non_negative": f"{c} < 0" for c in ("open", "high", "low", "close", "volume")},
    "high_ge_low": "high < low", "high_is_highest": "high < open OR high < close", "low_is_lowest": "low > open OR low > close", "instrument_type_allowed": "instrument_type NOT IN ('equity', 'option', 'crypto', 'forex', 'macro')",
}
_COMPLETE = {"open": 0.01, "high": 0.01, "low": 0.01, "close": 0.01, "volume": 0.05}


@register("quality_invariants", b.with_(b.BARS, _SILVER)
  + " UNION ALL ".join(f"SELECT '{n}' AS invariant, CASE WHEN count(*) FILTER (WHERE {c}) > 0 THEN 'fail' ELSE 'pass' END AS status, count(*) AS n_rows, count(*) FILTER (WHERE {c}) AS violations FROM silver" for n, c in _RULES.items())
  + "".join(f" UNION ALL SELECT '{n}_complete', CASE WHEN (count(*) - count({n})) / count(*) >= {t} AND count(*) > count({n}) THEN 'fail' ELSE 'pass' END, count(*), count(*) - count({n}) FROM silver" for n, t in _COMPLETE.items()))
def quality_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All shared and feed invariants of bars, and completeness, in one aggregation."""
    return quality.feed_invariants(_silver(spark, sf_dir), "bars", now="2001-06-30 00:00:00")


@register("quality_invariants_quotes", b.with_(b.QUOTES) + """SELECT 'ask_ge_bid' AS invariant, CASE WHEN count(*) FILTER (WHERE ask_px - 2000 < bid_px) > 0.01 * count(*) THEN 'fail' ELSE 'pass' END AS status, count(*) AS n_rows, count(*) FILTER (WHERE ask_px - 2000 < bid_px) AS violations FROM quotes
  UNION ALL SELECT 'bid_px_non_negative', CASE WHEN count(*) FILTER (WHERE bid_px < 0) > 0 THEN 'fail' ELSE 'pass' END, count(*), count(*) FILTER (WHERE bid_px < 0) FROM quotes
  UNION ALL SELECT 'event_id_required', 'not_run', NULL, NULL""")
def quality_invariants_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tolerated rule, one that tolerates nothing, and one whose column is missing."""
    out = quality.feed_invariants(b.quotes(spark, sf_dir).withColumn("ask_px", F.col("ask_px") - 2000), "quotes", now="2030-01-01 00:00:00")
    return out.where(F.col("invariant").isin("ask_ge_bid", "bid_px_non_negative", "event_id_required"))


@register("quality_duplicates", b.with_(b.DUPLICATED) + "SELECT count(event_id) - count(DISTINCT event_id) AS surplus FROM duplicated")
def quality_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surplus rows of an id."""
    return b.duplicated(spark, sf_dir).agg(quality.duplicate_surplus("event_id").alias("surplus"))


@register("quality_gaps", """WITH days AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events), want AS (SELECT user_id, CAST(g AS DATE) AS d FROM (SELECT DISTINCT user_id FROM events), generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30', INTERVAL 1 DAY) t(g)),
  gone AS (SELECT * FROM want EXCEPT SELECT * FROM days), isl AS (SELECT user_id, d, date_diff('day', DATE '2024-01-01', d) - row_number() OVER (PARTITION BY user_id ORDER BY d) AS i FROM gone)
  SELECT user_id, CAST(min(d) AS VARCHAR) AS first_day, CAST(max(d) AS VARCHAR) AS last_day, count(*) AS n_days FROM isl GROUP BY user_id, i""")
def quality_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contiguous ranges of missing days."""
    days = b.read(spark, sf_dir, "events").select("user_id", F.col("ts").cast("date").alias("d"))
    out = quality.missing_ranges(days, "user_id", "d", "2024-01-01", "2024-01-30")
    return out.select("user_id", F.col("first_day").cast("string").alias("first_day"), F.col("last_day").cast("string").alias("last_day"), "n_days")


@register("quality_coverage", "SELECT event_type AS feed, CAST(min(CAST(ts AS DATE)) AS VARCHAR) AS first_dt, CAST(max(CAST(ts AS DATE)) AS VARCHAR) AS last_dt, count(DISTINCT CAST(ts AS DATE)) AS n_dt, count(*) AS n_rows FROM events GROUP BY 1")
def quality_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last partition and rows per feed: per partition first, then rolled up."""
    parts = b.read(spark, sf_dir, "events").groupBy(F.col("event_type").alias("feed"), F.col("ts").cast("date").cast("string").alias("dt")).agg(F.count("*").alias("n"))
    return parts.groupBy("feed").agg(F.min("dt").alias("first_dt"), F.max("dt").alias("last_dt"), F.count("*").alias("n_dt"), F.sum("n").alias("n_rows"))


_CLOCKS = ("2024-01-19 15:00:00", "2024-01-20 12:00:00", "2024-01-19 23:00:00")


@register("quality_liveness", " UNION ALL ".join(f"""SELECT event_type AS feed, '{at}' AS at, count(*) FILTER (WHERE ts > TIMESTAMP '{at}' - INTERVAL 1 HOUR AND ts <= TIMESTAMP '{at}') AS n,
  CASE WHEN dayofweek(TIMESTAMP '{at}') IN (0, 6) OR hour(TIMESTAMP '{at}') < 14 OR hour(TIMESTAMP '{at}') >= 21 THEN 'closed' WHEN count(*) FILTER (WHERE ts > TIMESTAMP '{at}' - INTERVAL 1 HOUR AND ts <= TIMESTAMP '{at}') >= 1 THEN 'alive' ELSE 'silent' END AS status FROM events GROUP BY 1""" for at in _CLOCKS))
def quality_liveness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last hour against a floor, judged in trading hours only; now is a parameter."""
    events = b.read(spark, sf_dir, "events").select(F.col("event_type").alias("feed"), "ts")
    found = [quality.liveness(events, "feed", "ts", now, 3600, 1, (14, 21)) for now in _CLOCKS]
    return found[0].unionByName(found[1]).unionByName(found[2])


@register("quality_floors", """WITH g AS (SELECT event_type, t FROM (SELECT DISTINCT event_type FROM events), generate_series((SELECT date_trunc('day', min(ts)) FROM events), (SELECT date_trunc('day', max(ts)) + INTERVAL 23 HOUR FROM events), INTERVAL 1 HOUR) g(t)),
  c AS (SELECT event_type, date_trunc('hour', ts) AS t, count(*) AS n FROM events GROUP BY 1, 2)
  SELECT g.event_type, CAST(g.t AS DATE)::VARCHAR AS day, CAST(greatest(1, floor(0.3 * median(coalesce(n, 0)))) AS BIGINT) AS floor FROM g LEFT JOIN c ON g.event_type = c.event_type AND g.t = c.t GROUP BY ALL""")
def quality_floors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Floor of every day from the median of its hourly counts; empty hours count as 0."""
    return quality.floors(b.read(spark, sf_dir, "events").select("event_type", "ts"), "event_type", "ts", 0.3)


@register("quality_missing_hours", "WITH k AS (SELECT DISTINCT user_id % 7 AS feed, CAST(ts AS DATE) AS d FROM events), want AS (SELECT feed, d, h FROM k, generate_series(9, 15) g(h)), have AS (SELECT DISTINCT user_id % 7 AS feed, CAST(ts AS DATE) AS d, hour(ts) AS h FROM events WHERE user_id % 3 = 0) SELECT feed, CAST(d AS VARCHAR) AS day, CAST(h AS INTEGER) AS hour FROM want ANTI JOIN have USING (feed, d, h)")
def quality_missing_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours of a day's session that have no partition."""
    events = b.read(spark, sf_dir, "events").select((F.col("user_id") % 7).alias("feed"), "user_id", "ts")
    days = events.select("feed", F.col("ts").cast("date").alias("day")).distinct()
    return quality.missing_hours(days, events.where("user_id % 3 = 0"), "feed", "ts", 9, 15).select("feed", F.col("day").cast("string").alias("day"), "hour")


@register("quality_error_summary", """WITH e AS (SELECT event_id, event_type AS feed, 'kind_' || (k % 4) AS error, 'kind_' || (k % 4) || ': row ' || (k % 9) AS message, ts_event FROM alerts),
  n AS (SELECT *, row_number() OVER (PARTITION BY feed, error ORDER BY event_id) AS nth FROM e),
  m AS (SELECT message, count(*) AS n FROM e GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5)
  SELECT 'error' AS part, feed, error, count(*) AS n, strftime(min(ts_event), '%Y-%m-%d %H:%M:%S') AS first_at, strftime(max(ts_event), '%Y-%m-%d %H:%M:%S') AS last_at, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) FILTER (WHERE nth <= 2) AS samples FROM n GROUP BY 2, 3
  UNION ALL SELECT 'message', NULL, message, n, NULL, NULL, NULL FROM m""".replace("WITH e AS", "WITH " + b.ALERTS + ", e AS", 1))
def quality_error_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors by feed and kind with times and two samples each, and the five commonest messages."""
    kind = F.concat(F.lit("kind_"), F.col("k") % 4)
    errors = b.alerts(spark, sf_dir).select("event_id", F.col("event_type").alias("feed"), F.concat(kind, F.lit(": row "), F.col("k") % 9).alias("message"), "ts_event")
    return quality.error_summary(errors, "event_id", "feed", "message", "ts_event")


@register("quality_fresh_partitions", "SELECT t AS event_type FROM (VALUES ('view'), ('click'), ('signup'), ('refund')) v(t) WHERE t NOT IN (SELECT DISTINCT event_type FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-10')")
def quality_fresh_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected datasets without a partition of the day."""
    expected = spark.createDataFrame([("view",), ("click",), ("signup",), ("refund",)], "event_type string")
    return expected.join(b.read(spark, sf_dir, "events").where("cast(ts AS date) = date'2024-01-10'"), "event_type", "left_anti")
