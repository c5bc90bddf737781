"""A stateful barrier watch per alert: prices fold extremes until a barrier or the window's end."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUTCOME = "alert_id long, outcome string, mfe double, mae double, n_prices long"
_STATE = "entry double, mfe double, mae double, n long, done boolean"


def _outcome(key: tuple, kind: str, mfe: float, mae: float, n: int) -> pd.DataFrame:
    return pd.DataFrame([(key[0], kind, mfe, mae, n)], columns=["alert_id", "outcome", "mfe", "mae", "n_prices"])


def _follow(take: float, stop: float):
    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            _, mfe, mae, n, done = state.get
            state.remove()
            if not done:
                yield _outcome(key, "expired", mfe, mae, n)
            return
        entry, mfe, mae, n, done = state.get if state.exists else (None, 0.0, 0.0, 0, False)
        rows = pd.concat(list(frames)).sort_values(["ts", "seq"], kind="stable")
        end = rows["window_end"].iloc[-1]
        inside = rows[(rows["ts"] <= rows["window_end"]) & rows["price"].notna()]
        if not state.exists and inside.empty:
            return  # prices after the window of an alert that is over, or was never seen
        if not done and len(inside):
            prices, sign = inside["price"].to_numpy(float), np.where(inside["is_call"], 1.0, -1.0)
            if entry is None:
                entry, prices, sign = float(prices[0]), prices[1:], sign[1:]
            moves = sign * (prices - entry) / entry
            touched = np.flatnonzero((moves >= take) | (moves <= -stop))
            upto = moves[: touched[0] + 1] if len(touched) else moves
            n, mfe, mae = n + len(upto), float(np.max(upto, initial=mfe)), float(np.min(upto, initial=mae))
            if len(touched):
                done = True
                yield _outcome(key, "hit_tp" if moves[touched[0]] >= take else "hit_sl", mfe, mae, n)
        last = int(end.timestamp() * 1000)
        if state.getCurrentWatermarkMs() < last:
            state.update((entry, mfe, mae, n, done))
            state.setTimeoutTimestamp(last)  # at the window's end the alert expires, or its outcome is forgotten
        else:  # the window is over already: no timeout would fire any more
            if not done:
                yield _outcome(key, "expired", mfe, mae, n)
            if state.exists:
                state.remove()

    return step


def watch(prices: DataFrame, take: float, stop: float, delay: str = "2 hours") -> DataFrame:
    """One outcome per alert from a stream of (alert_id, ts, seq, price, is_call, window_end).

    The first price is the entry. Late prices within the delay are folded in as they come;
    an alert that touches nothing expires when the watermark passes its window's end.
    """
    return (
        prices.withWatermark("ts", delay)
        .groupBy("alert_id")
        .applyInPandasWithState(_follow(take, stop), OUTCOME, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
    )
