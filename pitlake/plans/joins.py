"""Queries of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlake.functions.scalars import add_flag
from pitlake.operators.asof import asof_join, forward_rows, validity_join
from pitlake.operators.barrier import Costs, barrier_outcome, contract_outcome
from pitlake.operators.universe import survivors
from pitlake.plans import bindings as b
from pitlake.plans.catalog import register

_SAFE = """safe AS (SELECT *, greatest(ts_event, ts_available) AS safe_time,
  row_number() OVER (PARTITION BY {key} greatest(ts_event, ts_available) ORDER BY ts_event DESC, event_id DESC) AS nth FROM {source})"""
_LEFT = "buys AS (SELECT * FROM alerts WHERE event_type = 'purchase'), views AS (SELECT * FROM alerts WHERE event_type <> 'purchase')"


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    alerts = b.alerts(spark, sf_dir)
    return alerts.where("event_type = 'purchase'"), alerts.where("event_type <> 'purchase'")


_ASOF_SQL = (
    b.with_(b.ALERTS, _LEFT, _SAFE.format(key="instrument_key,", source="views"), "one AS (SELECT * FROM safe WHERE nth = 1)")
    + """SELECT l.event_id, r.event_id AS right_id, round(r.premium, 4) AS right_premium
  FROM buys l ASOF LEFT JOIN one r ON l.instrument_key = r.instrument_key AND l.ts_event >= r.safe_time"""
)


@register("join_asof", _ASOF_SQL)
def join_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest safe row of the key."""
    left, right = _sides(spark, sf_dir)
    out = asof_join(left, right, ["instrument_key"], "ts_event", "ts_event", "ts_available", tiebreak=["event_id"])
    return out.select("event_id", F.col("event_id_right").alias("right_id"), F.round("premium_right", 4).alias("right_premium"))


@register("join_asof_bucketed", _ASOF_SQL)
def join_asof_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with hot keys cut into buckets of a day."""
    left, right = _sides(spark, sf_dir)
    out = asof_join(left, right, ["instrument_key"], "ts_event", "ts_event", "ts_available", tiebreak=["event_id"], bucket_seconds=86400)
    return out.select("event_id", F.col("event_id_right").alias("right_id"), F.round("premium_right", 4).alias("right_premium"))


@register(
    "join_asof_fill",
    b.with_(b.ALERTS, _LEFT, _SAFE.format(key="instrument_key,", source="views"),
            "one AS (SELECT *, CASE WHEN k % 3 <> 0 OR k % 5 <> 0 THEN coalesce(CASE WHEN k % 3 <> 0 THEN premium END, 0) + coalesce(CASE WHEN k % 5 <> 0 THEN k END, 0) END AS both_sides FROM safe WHERE nth = 1)")
    + """SELECT l.event_id, round(coalesce(CASE WHEN l.k % 2 = 0 THEN l.premium END, CASE WHEN near THEN r_gex END), 4) AS gex, round(coalesce(CASE WHEN l.k % 7 = 0 THEN l.premium END, CASE WHEN near THEN r_vex END), 4) AS vex,
  concat_ws(',', CASE WHEN l.k % 2 <> 0 AND near AND r_gex IS NOT NULL THEN 'gex_backfilled' END, CASE WHEN l.k % 7 <> 0 AND near AND r_vex IS NOT NULL THEN 'vex_backfilled' END) AS flags FROM
  (SELECT l.*, r.premium AS r_gex, r.both_sides AS r_vex, epoch_us(l.ts_event) - epoch_us(r.safe_time) <= 3600000000 AS near FROM buys l
   ASOF LEFT JOIN one r ON l.instrument_key = r.instrument_key AND l.ts_event >= r.safe_time) l""",
)
def join_asof_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null measures filled from the latest row at most an hour old, and flagged; a sum of sides needs one of them."""
    left, right = _sides(spark, sf_dir)
    left = left.withColumn("gex", F.when(F.col("k") % 2 == 0, F.col("premium"))).withColumn("vex", F.when(F.col("k") % 7 == 0, F.col("premium")))
    call, put = F.when(F.col("k") % 3 != 0, F.col("premium")), F.when(F.col("k") % 5 != 0, F.col("k").cast("double"))
    sides = F.when(call.isNotNull() | put.isNotNull(), F.coalesce(call, F.lit(0.0)) + F.coalesce(put, F.lit(0.0)))
    right = right.select("instrument_key", "ts_event", "ts_available", "event_id", F.col("premium").alias("found_gex"), sides.alias("found_vex"))
    out = asof_join(left, right, ["instrument_key"], "ts_event", "ts_event", "ts_available", 3600, ["event_id"])
    out = out.withColumn("flags", F.array().cast("array<string>"))
    for c in ("gex", "vex"):
        filled = F.col(c).isNull() & F.col(f"found_{c}").isNotNull()
        out = out.withColumn("flags", add_flag(F.col("flags"), f"{c}_backfilled", filled)).withColumn(c, F.coalesce(c, f"found_{c}"))
    return out.select("event_id", F.round("gex", 4).alias("gex"), F.round("vex", 4).alias("vex"), F.array_join("flags", ",").alias("flags"))


@register(
    "join_asof_market",
    b.with_(b.ALERTS, _LEFT, _SAFE.format(key="", source="views"), "one AS (SELECT * FROM safe WHERE nth = 1)")
    + """SELECT l.event_id, round((r.premium - 40) + (20 - r.k), 4) AS net, CASE WHEN (r.premium - 40) + (20 - r.k) > 0 THEN 'bullish' WHEN (r.premium - 40) + (20 - r.k) < 0 THEN 'bearish' WHEN r.event_id IS NOT NULL THEN 'neutral' END AS direction
  FROM buys l ASOF LEFT JOIN one r ON l.ts_event >= r.safe_time""",
)
def join_asof_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market-wide as-of join: no key, so time buckets keep it distributed; the direction is the net's sign."""
    left, right = _sides(spark, sf_dir)
    out = asof_join(left, right, [], "ts_event", "ts_event", "ts_available", tiebreak=["event_id"], bucket_seconds=21600)
    net = (F.col("premium_right") - 40) + (20 - F.col("k_right"))  # the legs are signed already
    return out.select("event_id", F.round(net, 4).alias("net"), F.when(net > 0, "bullish").when(net < 0, "bearish").when(net == 0, "neutral").alias("direction"))


@register(
    "join_asof_sector",
    b.with_(b.SNAPS, "lefts AS (SELECT seq, sector, ts_event FROM snaps WHERE status = 'F')", "tide AS (SELECT sector, ts_event, seq, level, row_number() OVER (PARTITION BY sector, ts_event ORDER BY seq DESC) AS nth FROM snaps WHERE status <> 'F')")
    + """SELECT l.seq, CAST(coalesce(sign(r.level - 100000), 0) AS DOUBLE) AS sentiment, round(r.level, 4) AS net_premium
  FROM lefts l ASOF LEFT JOIN (SELECT * FROM tide WHERE nth = 1) r ON l.sector = r.sector AND l.ts_event >= r.ts_event""",
)
def join_asof_sector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest snapshot of the sector; without one, sentiment 0 and no level."""
    snaps = b.snaps(spark, sf_dir)
    left = snaps.where("status = 'F'").select("seq", "sector", "ts_event")
    right = snaps.where("status <> 'F'").select("sector", "ts_event", F.col("seq").alias("nth"), "level")
    out = asof_join(left, right, ["sector"], "ts_event", "ts_event", tiebreak=["nth"], bucket_seconds=30 * 86400)  # few sectors, many rows
    return out.select("seq", F.coalesce(F.signum(F.col("level") - 100000), F.lit(0.0)).alias("sentiment"), F.round("level", 4).alias("net_premium"))


@register(
    "join_validity",
    b.with_(b.SNAPS, "dim AS (SELECT instrument_key, seq AS revision, ts_event AS valid_from, lead(ts_event) OVER (PARTITION BY instrument_key ORDER BY ts_event, seq) AS valid_to FROM snaps)", "asked AS (SELECT instrument_key, seq, ts_event + to_days(20) AS t FROM snaps WHERE status = 'O')")
    + """SELECT asked.seq, dim.revision FROM asked LEFT JOIN dim ON asked.instrument_key = dim.instrument_key AND valid_from <= t AND (valid_to IS NULL OR valid_to > t)""",
)
def join_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slowly changing dimension at a time."""
    from pitlake.operators.windows import series

    snaps = b.snaps(spark, sf_dir)
    w = series("instrument_key", ["ts_event", "seq"])
    dim = snaps.select("instrument_key", F.col("seq").alias("revision"), F.col("ts_event").alias("valid_from"), F.lead("ts_event").over(w).alias("valid_to"))
    at = snaps.where("status = 'O'").selectExpr("instrument_key", "seq", "ts_event + make_dt_interval(20) AS t")
    return validity_join(at, dim, "instrument_key", "t", tiebreak=["revision"]).select("seq", "revision")


@register(
    "join_feature_retrieval",
    b.with_(b.ALERTS, _LEFT, "clicks AS (SELECT instrument_key, ts_event, premium FROM views WHERE event_type = 'click' QUALIFY row_number() OVER (PARTITION BY instrument_key, ts_event ORDER BY ts_available DESC, event_id DESC) = 1)",
            "errors AS (SELECT instrument_key, ts_event, k FROM views WHERE event_type = 'error' QUALIFY row_number() OVER (PARTITION BY instrument_key, ts_event ORDER BY ts_available DESC, event_id DESC) = 1)")
    + """SELECT l.event_id, CASE WHEN epoch_us(l.ts_event) - epoch_us(c.ts_event) <= 86400000000 THEN round(c.premium, 4) END AS clicks_premium,
  CASE WHEN epoch_us(l.ts_event) - epoch_us(e.ts_event) <= 172800000000 THEN e.k END AS errors_k
  FROM buys l ASOF LEFT JOIN clicks c ON l.instrument_key = c.instrument_key AND l.ts_event >= c.ts_event
  ASOF LEFT JOIN errors e ON l.instrument_key = e.instrument_key AND l.ts_event >= e.ts_event""",
)
def join_feature_retrieval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity rows joined to several feature views, each with its time to live; of equal times the latest available row counts."""
    left, right = _sides(spark, sf_dir)
    out = left.select("event_id", "instrument_key", "ts_event")
    for kind, column, ttl in (("click", "premium", 86400), ("error", "k", 172800)):
        view = right.where(F.col("event_type") == kind).select("instrument_key", F.col("ts_event").alias("seen"), F.col("ts_available").alias(f"{kind}_at"), F.col("event_id").alias(f"{kind}_id"), F.col(column).alias(f"{kind}s_{column}"))
        out = asof_join(out, view, ["instrument_key"], "ts_event", "seen", tolerance_seconds=ttl, tiebreak=[f"{kind}_at", f"{kind}_id"]).drop("seen")
    return out.select("event_id", F.round("clicks_premium", 4).alias("clicks_premium"), "errors_k")


@register(
    "join_last_bar",
    b.with_(b.BARS, "ranked AS (SELECT *, row_number() OVER (PARTITION BY instrument_key, ts_event ORDER BY seq DESC) AS nth FROM bars)", "asked AS (SELECT 'equity:S' || (o_custkey % 10) AS instrument_key, o_orderkey, o_orderdate AS t FROM orders)")
    + """SELECT o_orderkey, round(close, 4) AS spot FROM asked a ASOF LEFT JOIN (SELECT * FROM ranked WHERE nth = 1) r
  ON a.instrument_key = r.instrument_key AND a.t >= r.ts_event""",
)
def join_last_bar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price at a time: the last bar not after it."""
    asked = b.read(spark, sf_dir, "orders").selectExpr("concat('equity:S', o_custkey % 10) AS instrument_key", "o_orderkey", "o_orderdate AS t")
    bars = b.bars(spark, sf_dir).select("instrument_key", "ts_event", "seq", "close")
    out = asof_join(asked, bars, ["instrument_key"], "t", "ts_event", tiebreak=["seq"])
    return out.select("o_orderkey", F.round("close", 4).alias("spot"))


_FORWARD = """asked AS (SELECT 'equity:S' || (o_custkey % 10) AS instrument_key, o_orderkey, o_orderdate AS t, o_orderstatus = 'O' AS is_call FROM orders),
numbered AS (SELECT *, row_number() OVER (PARTITION BY instrument_key ORDER BY ts_event, seq) AS n FROM bars),
upto AS (SELECT instrument_key, ts_event, max(n) AS seen FROM numbered GROUP BY 1, 2),
placed AS (SELECT a.*, coalesce(u.seen, 0) AS seen FROM asked a ASOF LEFT JOIN upto u ON a.instrument_key = u.instrument_key AND a.t >= u.ts_event),
path AS (SELECT p.o_orderkey, p.is_call, n.n - p.seen AS position, n.close FROM (SELECT *, unnest(range(seen + 1, seen + 9)) AS at FROM placed) p
  JOIN numbered n ON n.instrument_key = p.instrument_key AND n.n = p.at)"""


def _forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = b.read(spark, sf_dir, "orders").selectExpr("concat('equity:S', o_custkey % 10) AS instrument_key", "o_orderkey", "o_orderdate AS t", "o_orderstatus = 'O' AS is_call")
    bars = b.bars(spark, sf_dir).select("instrument_key", "ts_event", "seq", "close")
    return forward_rows(asked, bars, "instrument_key", "t", "ts_event", 8, ["seq"])


@register("join_forward_window", b.with_(b.BARS, _FORWARD) + "SELECT o_orderkey, CAST(position AS INTEGER) AS position, round(close, 4) AS close FROM path")
def join_forward_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first eight bars after the time of every order."""
    return _forward(spark, sf_dir).select("o_orderkey", "position", F.round("close", 4).alias("close"))


def _outcomes(paths: DataFrame) -> DataFrame:
    rows = paths.groupBy("o_orderkey", "is_call").agg(F.sort_array(F.collect_list(F.struct("position", "close"))).alias("path"))
    path = F.transform(F.slice("path", 2, 8), lambda p: p["close"])
    found = barrier_outcome(path, F.element_at("path", 1)["close"], F.col("is_call"), 0.3, 0.2, Costs(), 7)
    whole = ("hit_tp_first", "bars_to_hit")
    return rows.where(F.size("path") > 1).select("o_orderkey", *[c.cast("int" if n == "hit_tp_first" else "long").alias(n) if n in whole else F.round(c, 6).alias(n) for n, c in found.items()])


@register(
    "label_barrier",
    b.with_(b.BARS, _FORWARD, "entry AS (SELECT o_orderkey, max(close) FILTER (WHERE position = 1) AS entry FROM path GROUP BY 1)",
            "moves AS (SELECT p.o_orderkey, position - 1 AS step, CASE WHEN is_call THEN 1.0 ELSE -1.0 END * (close - entry) / entry AS m FROM path p JOIN entry USING (o_orderkey) WHERE position > 1)",
            "hits AS (SELECT o_orderkey, max(m) AS mfe, min(m) AS mae, min(step) FILTER (WHERE m >= 0.302) AS up, min(step) FILTER (WHERE m <= -0.2) AS down FROM moves GROUP BY 1)")
    + """SELECT o_orderkey, CAST(coalesce(up, 99) < coalesce(down, 99) AS INTEGER) AS hit_tp_first, round(mfe, 6) AS mfe, round(mae, 6) AS mae,
  round(mfe - 0.002, 6) AS mfe_adj, round(mae - 0.001, 6) AS mae_adj,
  CAST(CASE WHEN coalesce(up, 99) < coalesce(down, 99) THEN up WHEN coalesce(down, 99) < coalesce(up, 99) THEN down END AS BIGINT) AS bars_to_hit,
  round(CASE WHEN mfe = 0 AND mae = 0 THEN 1.0 WHEN abs(mae) < 1e-10 THEN CASE WHEN mfe > 0 THEN 10.0 ELSE 1.0 END ELSE least(10.0, mfe / abs(mae)) END, 6) AS edge_ratio,
  round(CASE WHEN coalesce(up, 99) < coalesce(down, 99) THEN 1.0 - up / 7.0 END, 6) AS time_efficiency FROM hits""",
)
def label_barrier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Barrier outcomes of every order over the seven bars after its entry bar, with costs."""
    return _outcomes(_forward(spark, sf_dir))


_CONTRACT = """moves AS (SELECT p.o_orderkey, position - 1 AS step, (close - entry) / entry AS m FROM path p JOIN (SELECT o_orderkey, max(close) FILTER (WHERE position = 1) AS entry FROM path GROUP BY 1) USING (o_orderkey) WHERE position > 1),
hits AS (SELECT o_orderkey, max(m) AS mfe, min(m) AS mae, min(step) FILTER (WHERE m >= 0.25 + 0.04) AS up, min(step) FILTER (WHERE m <= -0.15) AS down FROM moves GROUP BY 1)"""


@register("label_contract_barrier", b.with_(b.BARS, _FORWARD, _CONTRACT) + """SELECT o_orderkey, CAST(coalesce(up, 99) < coalesce(down, 99) AS INTEGER) AS contract_hit_tp_first, round(mfe, 6) AS contract_mfe, round(mae, 6) AS contract_mae,
  round(mfe - 0.04, 6) AS contract_mfe_adj, round(mae - 0.02, 6) AS contract_mae_adj,
  CAST(CASE WHEN coalesce(up, 99) < coalesce(down, 99) THEN up WHEN coalesce(down, 99) < coalesce(up, 99) THEN down END AS BIGINT) AS contract_bars_to_hit FROM hits""")
def label_contract_barrier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of the contract itself: held long, fixed shares, option costs."""
    rows = _forward(spark, sf_dir).groupBy("o_orderkey").agg(F.sort_array(F.collect_list(F.struct("position", "close"))).alias("path"))  # eight at most
    path = F.transform(F.slice("path", 2, 8), lambda p: p["close"])
    found = contract_outcome(path, F.element_at("path", 1)["close"], 0.25, 0.15, Costs())
    kinds = {"contract_hit_tp_first": "int", "contract_bars_to_hit": "long"}
    return rows.where(F.size("path") > 1).select("o_orderkey", *[c.cast(kinds[n]).alias(n) if n in kinds else F.round(c, 6).alias(n) for n, c in found.items()])


@register("join_inner", "SELECT o_orderkey, l_linenumber, round(o_totalprice + l_extendedprice, 4) AS total FROM orders JOIN lineitem ON o_orderkey = l_orderkey")
def join_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features with outcomes."""
    orders = b.read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    lines = b.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"]).select("o_orderkey", "l_linenumber", F.round(F.col("o_totalprice") + F.col("l_extendedprice"), 4).alias("total"))


@register(
    "join_left_aggregates",
    b.with_(b.ALERTS)
    + """SELECT instrument_key, CAST(CAST(ts_event AS DATE) AS VARCHAR) AS day, round(sum(premium), 4) AS total,
  round(coalesce(sum(premium) FILTER (WHERE put_call = 'C'), 0), 4) AS calls, count(*) FILTER (WHERE is_sweep) AS sweeps FROM alerts GROUP BY 1, 2""",
)
def join_left_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the reference joins from several aggregates is one conditional aggregation."""
    rows = b.alerts(spark, sf_dir).groupBy("instrument_key", F.col("ts_event").cast("date").cast("string").alias("day"))
    calls = F.sum(F.when(F.col("put_call") == "C", F.col("premium")))
    return rows.agg(F.round(F.sum("premium"), 4).alias("total"), F.round(F.coalesce(calls, F.lit(0.0)), 4).alias("calls"), F.count_if("is_sweep").alias("sweeps"))


@register(
    "join_market_wide",
    b.with_(b.ALERTS, "tide AS (SELECT CAST(ts_event AS DATE) AS d, sum(premium) AS market FROM alerts GROUP BY 1)")
    + "SELECT event_id, round(premium / market, 8) AS share FROM alerts JOIN tide ON CAST(ts_event AS DATE) = d",
)
def join_market_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A market-wide row per day joined on the day alone; the planner broadcasts it by its size."""
    alerts = b.alerts(spark, sf_dir).withColumn("d", F.col("ts_event").cast("date"))
    tide = alerts.groupBy("d").agg(F.sum("premium").alias("market"))
    return alerts.join(tide, "d", "left").select("event_id", F.round(F.col("premium") / F.col("market"), 8).alias("share"))


@register(
    "join_benchmark",
    b.with_(b.BARS, b.DAILY)
    + """SELECT a.instrument_key, CAST(a.day AS VARCHAR) AS day, round(a.close / s.close, 6) AS relative FROM daily a LEFT JOIN daily s
  ON a.day = s.day AND s.instrument_key = 'equity:S1'""",
)
def join_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each bar beside the benchmark's bar of the day."""
    days = b.daily(b.bars(spark, sf_dir))
    bench = days.where("instrument_key = 'equity:S1'").select("day", F.col("close").alias("bench"))
    return days.join(bench, "day", "left").select("instrument_key", F.col("day").cast("string").alias("day"), F.round(F.col("close") / F.col("bench"), 6).alias("relative"))


@register(
    "join_full_outer",
    """SELECT CAST(d AS VARCHAR) AS day, a, b FROM (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS a FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)
  FULL JOIN (SELECT CAST(l_shipdate AS DATE) AS d, count(*) AS b FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) USING (d)""",
)
def join_full_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature frames merged on their time."""
    left = b.read(spark, sf_dir, "orders").where("o_orderstatus = 'O'").groupBy(F.col("o_orderdate").cast("date").alias("d")).agg(F.count("*").alias("a"))
    right = b.read(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").groupBy(F.col("l_shipdate").cast("date").alias("d")).agg(F.count("*").alias("b"))
    return left.join(right, "d", "full").select(F.col("d").cast("string").alias("day"), "a", "b")


@register("join_semi", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def join_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a universe."""
    wanted = b.read(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return b.read(spark, sf_dir, "customer").join(wanted, "c_custkey", "left_semi").select("c_custkey", "c_name")


@register("join_anti", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def join_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows not present yet."""
    from pitlake.operators.dedupe import unseen

    present = b.read(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return unseen(b.read(spark, sf_dir, "customer").select("c_custkey"), present, "c_custkey")


@register("join_dimension_map", "SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def join_dimension_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sector map through two small dimensions."""
    nation, region = b.read(spark, sf_dir, "nation"), b.read(spark, sf_dir, "region")
    sector = nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select("n_nationkey", "n_name", "r_name")
    customer = b.read(spark, sf_dir, "customer")
    return customer.join(sector, customer["c_nationkey"] == sector["n_nationkey"]).select("c_custkey", "n_name", "r_name")


@register(
    "join_lifecycle",
    b.with_(b.SNAPS, b.LIFECYCLE)
    + """SELECT seq FROM snaps s JOIN lifecycle l ON s.instrument_key = l.instrument_key WHERE list_date <= CAST(s.ts_event AS DATE)
  AND (delist_date IS NULL OR CAST(s.ts_event AS DATE) < delist_date)""",
)
def join_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose instrument was listed at their time."""
    return survivors(b.snaps(spark, sf_dir), b.lifecycle(spark, sf_dir), "instrument_key", "ts_event").select("seq")


@register(
    "join_feed_overlap",
    "SELECT event_type AS feed, round(count(DISTINCT user_id) / (SELECT count(DISTINCT user_id) FROM events), 6) AS overlap, count(DISTINCT user_id) / (SELECT count(DISTINCT user_id) FROM events) >= 0.5 AS enough FROM events GROUP BY 1",
)
def join_feed_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of all keys that each feed covers, and whether that is half of them: distinct keys first, then counts."""
    pairs = b.read(spark, sf_dir, "events").select(F.col("event_type").alias("feed"), "user_id").distinct()
    whole = pairs.agg(F.count_distinct("user_id").alias("whole"))
    share = F.col("own") / F.col("whole")
    feeds = pairs.groupBy("feed").agg(F.count("user_id").alias("own"))
    return feeds.join(F.broadcast(whole)).select("feed", F.round(share, 6).alias("overlap"), (share >= 0.5).alias("enough"))  # one row


@register(
    "trade_windows_session",
    """SELECT user_id, CAST(count(*) AS BIGINT) AS n_sessions FROM (SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM events)
  WHERE before IS NULL OR epoch_us(ts) - epoch_us(before) >= 3600000000 GROUP BY 1""",
)
def trade_windows_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions with gaps of an hour, by the built-in session window."""
    events = b.read(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    return events.groupBy("user_id", F.session_window("ts", "1 hour")).agg(F.count("*").alias("n")).groupBy("user_id").agg(F.count("*").alias("n_sessions"))
