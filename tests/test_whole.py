"""Queries against plain Python, beside their SQL."""

from collections import defaultdict
from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from pitlake.plans import bindings as b


def rows_of(spark, sf, name):
    return entry.queries()[name](spark, sf).collect()


def test_forward_bars_and_barriers_of_every_order(spark, sf):
    bars = defaultdict(list)
    for r in b.bars(spark, sf).select("instrument_key", "ts_event", "seq", "close").collect():
        bars[r[0]].append((r[1], r[2], r[3]))
    want, hits = {}, {}
    for r in b.read(spark, sf, "orders").collect():
        later = sorted(x for x in bars[f"equity:S{r['o_custkey'] % 10}"] if x[0] > r["o_orderdate"])[:8]
        want |= {(r["o_orderkey"], i): pytest.approx(x[2], abs=1e-4) for i, x in enumerate(later, 1)}
        if len(later) > 1:
            moves = [(1 if r["o_orderstatus"] == "O" else -1) * (x[2] - later[0][2]) / later[0][2] for x in later[1:]]
            up = next((i for i, m in enumerate(moves, 1) if m >= 0.302), 99)
            down = next((i for i, m in enumerate(moves, 1) if m <= -0.2), 99)
            hits[r["o_orderkey"]] = (int(up < down), min(up, down) if up != down else None, pytest.approx(max(moves), abs=1e-6))
    got = rows_of(spark, sf, "join_forward_window")
    assert len(got) == len(want) and {(r["o_orderkey"], r["position"]): r["close"] for r in got} == want
    got = rows_of(spark, sf, "label_barrier")
    assert len(got) == len(hits) and {r["o_orderkey"]: (r["hit_tp_first"], r["bars_to_hit"], r["mfe"]) for r in got} == hits


def test_exponential_means_of_all_events(spark, sf):
    want, last = {}, {}
    for r in sorted(b.read(spark, sf, "events").collect(), key=lambda r: (r["ts"], r["event_id"])):
        u = r["user_id"]
        last[u] = last[u] * 11 / 13 + r["value"] * 2 / 13 if u in last else r["value"]
        want[r["event_id"]] = pytest.approx(last[u], abs=1e-4)
    assert {r["event_id"]: r["ema"] for r in rows_of(spark, sf, "win_ewma")} == want


def closes(spark, sf):
    days = defaultdict(list)
    for r in b.daily(b.bars(spark, sf)).select("instrument_key", F.col("day").cast("string").alias("day"), "close").orderBy("instrument_key", "day").collect():
        days[r[0]].append((r[1], r[2]))
    return days


def test_trend_scan_over_the_horizons_of_the_reference(spark, sf):
    want = {}
    for key, days in closes(spark, sf).items():
        y = np.array([c for _, c in days])
        for i in range(len(y)):
            seen = {}
            for h in (2, 3, 5, 10, 15, 20):
                if i + h < len(y):
                    part, x = y[i : i + h + 1], np.arange(h + 1.0)
                    slope, at = np.polyfit(x, part, 1)
                    rest = ((part - at - slope * x) ** 2).sum()
                    seen[h] = slope / np.sqrt(rest / (h - 1) / ((x - x.mean()) ** 2).sum())
            if seen:
                best = max(seen, key=lambda h: (round(abs(seen[h]), 6), -h))
                want[key, days[i][0]] = (best, pytest.approx(seen[best], rel=1e-4, abs=2e-3))
    got = {(r["instrument_key"], r["day"]): (r["horizon"], r["t"]) for r in rows_of(spark, sf, "label_trend_scan")}
    assert got == want and {h for h, _ in got.values()} == {2, 3, 5, 10, 15, 20}


def test_classes_over_the_horizons_of_the_reference(spark, sf):
    days = closes(spark, sf)
    got = {(r["instrument_key"], r["day"]): r for r in rows_of(spark, sf, "label_classes")}
    assert len(got) == sum(map(len, days.values()))
    for key, series in days.items():
        for i, (day, c) in enumerate(series):
            for h in (1, 5, 10, 20):
                want = pytest.approx(series[i + h][1] / c - 1, abs=1e-6) if i + h < len(series) else None
                assert got[key, day][f"r{h}"] == want


def test_base_rate_looks_back_ninety_days_once_per_time(spark, sf):
    rows = [(r["instrument_key"], r["ts_event"], r["event_id"], r["premium"] > 50) for r in b.alerts(spark, sf).where("k % 4 <> 0").collect()]
    want = {}
    for key, t, i in {(key, t): (key, t, i) for key, t, i, _ in sorted(rows)}.values():
        seen = [won for k, u, _, won in rows if k == key and t - timedelta(days=90) <= u < t]
        want[i] = (len(seen), pytest.approx(sum(seen) / len(seen), abs=1e-6) if seen else None)
    assert {r["event_id"]: (r["n"], r["win_rate"]) for r in rows_of(spark, sf, "win_base_rate")} == want


def test_feeds_cover_the_keys_of_all_their_rows(spark, sf):
    feeds = defaultdict(set)
    for r in b.read(spark, sf, "events").collect():
        feeds[r["event_type"]].add(r["user_id"])
    every = len(set().union(*feeds.values()))
    assert {r["feed"]: r["overlap"] for r in rows_of(spark, sf, "join_feed_overlap")} == {f: round(len(u) / every, 6) for f, u in feeds.items()}


def test_times_of_every_row_to_the_microsecond(spark, sf):
    from pitlake.operators.asof import micros

    want = {i: (us // 1_000_000 * 1_000_000, us // 1000 * 1000, None)[i % 3] for i, us in b.read(spark, sf, "events").select("event_id", micros("ts")).collect()}
    assert any(i % 3 == 1 and us % 1_000_000 < 100_000 for i, us in want.items() if us is not None)
    assert {r["event_id"]: r["us"] for r in rows_of(spark, sf, "scalar_timestamps")} == want
