"""When to try again, when to slow down, how often to look."""

from __future__ import annotations

import random
import time
from collections.abc import Callable
from dataclasses import dataclass
from typing import TypeVar

T = TypeVar("T")

#: What an error's text says about trying again.
RETRYABLE = ("timeout", "timed out", "connection", "temporarily", "unavailable", "throttl", "too many requests", "429", "503", "504")
PERMANENT = ("bad_json", "missing_", "future_event", "type_error", "schema", "permission", "not found")


def retryable(error: BaseException | str) -> bool:
    """Whether an error may go away by itself; one that nothing is known of is tried again."""
    text = f"{type(error).__name__}: {error}".lower() if isinstance(error, BaseException) else error.lower()
    if any(x in text for x in PERMANENT):
        return False
    return any(x in text for x in RETRYABLE) or isinstance(error, (OSError, TimeoutError)) or not isinstance(error, (ValueError, TypeError, KeyError))


def delay(attempt: int, first: float = 0.1, most: float = 30.0, jitter: float = 0.1, draw: Callable[[], float] = random.random) -> float:
    """Seconds before an attempt (from 0): doubled each time, up to a limit, a tenth more or less."""
    return min(most, first * 2**attempt) * (1 + jitter * (2 * draw() - 1))


def tried(work: Callable[[], T], attempts: int = 5, sleep: Callable[[float], None] = time.sleep) -> T:
    """The result of work, tried again after errors that may go away."""
    for attempt in range(attempts):
        try:
            return work()
        except Exception as error:
            if attempt + 1 == attempts or not retryable(error):
                raise
            sleep(delay(attempt))
    raise ValueError("no attempts")


@dataclass(frozen=True)
class Pressure:
    """How far a stream is behind: rows that wait over rows per second."""

    waiting: int
    per_second: float = 1000.0
    most_seconds: float = 60.0

    @property
    def seconds(self) -> float:
        return self.waiting / self.per_second if self.per_second > 0 else float("inf")

    @property
    def slow_down(self) -> bool:
        return self.seconds > self.most_seconds


def pressure(progress: dict, most_seconds: float = 60.0) -> Pressure:
    """The pressure that a streaming query's progress report shows: offsets behind the latest, at the rate of the last batch."""
    waiting = sum(int(float((s.get("metrics") or {}).get("numFilesOutstanding") or (s.get("metrics") or {}).get("avgOffsetsBehindLatest") or 0)) for s in progress.get("sources", []))
    return Pressure(waiting, float(progress.get("processedRowsPerSecond") or 0) or 1000.0, most_seconds)


#: Seconds between looks at a watch, by horizon.
CADENCE = {"intraday": 300, "swing": 900, "leap": 3600}


def cadence(horizon: str | None) -> int:
    """Seconds between two looks; the longest for an unknown horizon."""
    return CADENCE.get(horizon or "", max(CADENCE.values()))
