"""Edge cases of joins, windows, deduplication and quality, on rows made here."""

from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pitlake.operators import barrier, dedupe, quality, splits, windows
from pitlake.operators.asof import asof_join, forward_rows, validity_join


def t(minute):
    return datetime(2024, 1, 1, minute // 60, minute % 60)


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_late_old_row_beats_newer_event_that_arrived_earlier(spark):
    left = frame(spark, [("a", t(30))], "k string, at timestamp_ntz")
    right = frame(spark, [("a", t(10), t(12), 1), ("a", t(5), t(20), 2), ("a", t(40), t(41), 3)], "k string, ev timestamp_ntz, av timestamp_ntz, v int")
    assert asof_join(left, right, ["k"], "at", "ev", "av").first()["v"] == 2


def test_tolerance_is_inclusive_and_keys_do_not_mix(spark):
    left = frame(spark, [("a", t(30)), ("b", t(30)), (None, t(30))], "k string, at timestamp_ntz")
    right = frame(spark, [("a", t(20), 1), ("c", t(30), 2), (None, t(30), 3)], "k string, ev timestamp_ntz, v int")
    near = {r["k"]: r["v"] for r in asof_join(left, right, ["k"], "at", "ev", tolerance_seconds=600).collect()}
    assert near == {"a": 1, "b": None, None: None}
    far = {r["k"]: r["v"] for r in asof_join(left, right, ["k"], "at", "ev", tolerance_seconds=599).collect()}
    assert far["a"] is None


def test_missing_column_is_an_error(spark):
    with pytest.raises(ValueError):
        asof_join(frame(spark, [(1,)], "k int"), frame(spark, [(1,)], "k int"), ["k"], "at", "ev")


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 300)), min_size=1, max_size=15),
    st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 300), st.integers(0, 60)), min_size=1, max_size=15),
)
def test_asof_join_agrees_with_search(spark, lefts, rights):
    left = frame(spark, [(i, k, t(m)) for i, (k, m) in enumerate(lefts)], "i int, k string, at timestamp_ntz")
    right = frame(spark, [(j, k, t(m), t(m + d)) for j, (k, m, d) in enumerate(rights)], "j int, k string, ev timestamp_ntz, av timestamp_ntz")
    want = {}
    for i, (k, m) in enumerate(lefts):
        seen = [(rm + d, rm, j) for j, (rk, rm, d) in enumerate(rights) if rk == k and rm + d <= m]
        want[i] = max(seen)[2] if seen else None
    for bucket in (None, 3600):
        found = asof_join(left, right, ["k"], "at", "ev", "av", tiebreak=["j"], bucket_seconds=bucket)
        assert {r["i"]: r["j"] for r in found.collect()} == want


def test_validity_join_has_open_end(spark):
    left = frame(spark, [("a", t(5)), ("a", t(10)), ("b", t(1))], "k string, at timestamp_ntz")
    dim = frame(spark, [("a", 1, t(0), t(10)), ("a", 2, t(10), None)], "k string, v int, valid_from timestamp_ntz, valid_to timestamp_ntz")
    assert sorted((r["k"], r["v"]) for r in validity_join(left, dim, "k", "at").collect() if r["v"]) == [("a", 1), ("a", 2)]


def test_forward_rows_begin_strictly_after(spark):
    left = frame(spark, [("a", t(10))], "k string, at timestamp_ntz")
    right = frame(spark, [("a", t(m), m) for m in (9, 10, 11, 12, 13)], "k string, ts timestamp_ntz, v int")
    assert [r["v"] for r in forward_rows(left, right, "k", "at", "ts", 2).orderBy("position").collect()] == [11, 12]


def test_gated_mean_needs_observations(spark):
    df = frame(spark, [("a", i, v) for i, v in enumerate([1.0, None, 3.0, 5.0])], "k string, i int, v double")
    w = windows.series("k", ["i"])
    got = [r["m"] for r in df.select("i", windows.gated(w, "v", 2, F.avg).alias("m")).orderBy("i").collect()]
    assert got == [None, None, None, 4.0]


def test_zero_spread_scores_zero(spark):
    df = frame(spark, [("a", i, 2.0) for i in range(3)], "k string, i int, v double")
    got = [r["z"] for r in df.select("i", windows.zscore(windows.series("k", ["i"]), "v", 3).alias("z")).orderBy("i").collect()]
    assert got == [None, None, 0.0]


@pytest.mark.parametrize(("alpha", "adjust"), [(0.3, True), (0.3, False), (0.9, False), (0.9, True), (0.01, False), (0.01, True), (1.0, False)])
def test_exponential_means_agree_with_pandas_over_many_blocks(spark, alpha, adjust):
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(1)
    values = {"a": rng.normal(100, 30, 700), "b": rng.normal(-5, 1000, 3), "c": np.array([7.0])}
    rows = [(k, i, float(v)) for k, vs in values.items() for i, v in enumerate(vs)]
    df = frame(spark, rows, "k string, i int, v double")
    got = {(r["k"], r["i"]): r["e"] for r in windows.exponential(df, "k", ["i"], "v", alpha, "e", adjust).collect()}
    for k, vs in values.items():
        want = pd.Series(vs).ewm(alpha=alpha, adjust=adjust).mean().tolist()
        assert [got[k, i] for i in range(len(vs))] == pytest.approx(want, rel=1e-11, abs=1e-9)


def test_exponential_means_carry_over_nulls_and_wait_for_enough(spark):
    df = frame(spark, [("a", 0, None), ("a", 1, 2.0), ("a", 2, None), ("a", 3, 4.0), (None, 0, 1.0)], "k string, i int, v double")
    got = {(r["k"], r["i"]): r["e"] for r in windows.exponential(df, "k", ["i"], "v", 0.5, "e").collect()}
    assert got == {("a", 0): None, ("a", 1): 2.0, ("a", 2): 2.0, ("a", 3): 3.0, (None, 0): 1.0}
    late = {(r["k"], r["i"]): r["e"] for r in windows.exponential(df, "k", ["i"], "v", 0.5, "e", least=2).collect()}
    assert late[("a", 1)] is None and late[("a", 3)] == 3.0
    assert windows.exponential(df.limit(0), "k", ["i"], "v", 0.5, "e").count() == 0


def test_strength_and_convergence_agree_with_pandas(spark):
    import numpy as np
    import pandas as pd

    prices = pd.Series(100 + np.random.default_rng(3).normal(0, 1, 120).cumsum())
    df = frame(spark, [("a", i, float(v)) for i, v in enumerate(prices)], "k string, i int, v double")
    rows = windows.rsi(windows.rsi_simple(windows.macd(df, "k", ["i"], "v"), "k", ["i"], "v", 14, "simple"), "k", ["i"], "v", 14, "rsi").orderBy("i").collect()
    line = prices.ewm(span=12, adjust=False).mean() - prices.ewm(span=26, adjust=False).mean()
    assert [r["macd"] for r in rows] == pytest.approx(line.tolist(), abs=1e-9)
    assert [r["macd_signal"] for r in rows] == pytest.approx(line.ewm(span=9, adjust=False).mean().tolist(), abs=1e-9)
    step = prices.diff()
    mean = lambda x: x.ewm(alpha=1 / 14, min_periods=14, adjust=False).mean()
    want = 100 - 100 / (1 + mean(step.clip(lower=0)) / mean(-step.clip(upper=0)))
    assert [r["rsi"] for r in rows[:14]] == [None] * 14 and [r["rsi"] for r in rows[14:]] == pytest.approx(want.tolist()[14:])


def test_perfect_line_has_no_trend_statistic(spark):
    df = frame(spark, [("a", i, float(i)) for i in range(6)], "k string, p int, v double")
    assert windows.trend_scan(df, "k", ["p"], "v").count() == 0


def test_barriers(spark):
    rows = [(1, [101.0, 111.0, 80.0], True), (2, [99.0, 80.0, 120.0], True), (3, [80.0], False), (4, [100.5], True), (5, [], True)]
    df = frame(spark, rows, "i int, path array<double>, call boolean")
    found = barrier.barrier_outcome(F.col("path"), F.lit(100.0), F.col("call"), 0.1, 0.1, window=3)
    got = {r["i"]: r for r in df.select("i", *[c.alias(n) for n, c in found.items()]).collect()}
    assert [got[i]["hit_tp_first"] for i in range(1, 6)] == [1, 0, 1, 0, None]
    assert [got[i]["bars_to_hit"] for i in range(1, 6)] == [2, 2, 1, None, None]
    assert got[1]["time_efficiency"] == pytest.approx(1 / 3) and got[4]["time_efficiency"] is None


def test_dedupe_directions_and_null_keys(spark):
    df = frame(spark, [(1, 5, "a"), (1, 3, "b"), (None, 1, "c"), (None, 2, "d")], "event_id int, at int, v string")
    assert sorted(r["v"] for r in dedupe.earliest(df, "event_id", "at").collect()) == ["b", "c", "d"]
    assert "a" in {r["v"] for r in dedupe.latest(df, "event_id", "at").collect()}


def test_compaction_twice_is_once(spark):
    df = frame(spark, [(i % 3, i, str(i)) for i in range(9)], "event_id int, at int, v string")
    once = dedupe.earliest(df, "event_id", "at")
    assert sorted(once.collect()) == sorted(dedupe.earliest(once, "event_id", "at").collect())


def test_gaps_and_islands(spark):
    days = frame(spark, [("a", date(2024, 1, 2)), ("a", date(2024, 1, 5))], "k string, d date")
    got = sorted((str(r["first_day"]), r["n_days"]) for r in quality.missing_ranges(days, "k", "d", "2024-01-01", "2024-01-06").collect())
    assert got == [("2024-01-01", 1), ("2024-01-03", 2), ("2024-01-06", 1)]


def test_stability_of_equal_distributions_is_zero(spark):
    a = frame(spark, [("x", 3), ("y", 5)], "b string, n long")
    assert quality.stability_index(a, a, "b").first()["psi"] == pytest.approx(0)


def test_folds_keep_their_embargo():
    folds = splits.walk_forward("2024-01-01", "2024-12-31", "90d", "30d", "30d", "5d")
    assert folds and all((c - b).days == 5 and (d - c).days == 30 for _, _, b, c, d in folds)
    grown = splits.expanding("2024-01-01", "2024-12-31", "90d", "30d")
    assert all(f[1] == date(2024, 1, 1) for f in grown) and grown[1][2] > grown[0][2]


def test_boosted_trees_tell_held_out_rows_apart(spark, sf):
    import __spark_entry__ as entry

    got = {r["metric"]: r["value"] for r in entry.queries()["ml_boosted_trees"](spark, sf).collect()}
    assert got["auc"] > 0.95 and got["accuracy"] > 0.85


def test_metrics_of_nothing_and_of_one_class(spark):
    from pitlake.operators import scoring

    df = frame(spark, [(0.9, 1), (0.2, 1), (None, 1), (0.5, None)], "s double, y int")
    got = {r["metric"]: r["value"] for r in scoring.metrics(df, "s", "y").collect()}
    assert got["auc"] == 0.5 and got["accuracy"] == 0.5 and got["precision"] == 1.0 and got["recall"] == 0.5
    assert {r["metric"]: r["value"] for r in scoring.metrics(df.limit(0), "s", "y").collect()}["auc"] == 0.5


def test_a_bucketed_join_carries_rows_over_buckets_and_keeps_null_keys(spark):
    from datetime import datetime, timedelta

    from pitlake.operators.asof import asof_join, validity_join

    at = lambda h: datetime(2024, 1, 1) + timedelta(hours=h)
    left = frame(spark, [(1, "a", at(100)), (2, "a", at(0)), (3, None, at(5)), (4, "a", None), (5, "b", at(3))], "i int, k string, t timestamp_ntz")
    right = frame(spark, [("a", at(1), "x"), ("a", at(2), "y"), ("b", at(3), "z"), (None, at(0), "n")], "k string, t timestamp_ntz, v string")
    for bucket in (None, 3600):
        got = {r["i"]: r["v"] for r in asof_join(left, right, ["k"], "t", "t", bucket_seconds=bucket).collect()}
        assert got == {1: "y", 2: None, 3: None, 4: None, 5: "z"}
    dim = right.select("k", F.col("t").alias("valid_from"), (F.col("t") + F.make_dt_interval(hours=F.lit(50))).alias("valid_to"), "v")
    got = {r["i"]: r["v"] for r in validity_join(left, dim, "k", "t").collect()}
    assert got == {1: None, 2: None, 3: None, 4: None, 5: "z"}


def test_a_share_of_rows_is_split_at_ties(spark):
    df = frame(spark, [(i // 4, i) for i in range(10)] + [(None, 99)], "d int, i int")
    got = {r["i"]: r["part"] for r in splits.share_split(df, ["d", "i"], 0.5).collect()}
    assert sorted(i for i, p in got.items() if p == "train") == [0, 1, 2, 3, 99] and len(got) == 11
    assert splits.share_split(df.limit(0), ["d"], 0.5).count() == 0
