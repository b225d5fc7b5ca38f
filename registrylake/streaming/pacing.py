"""Per-host pacing over a stream of outcomes: gap, next time and expiry in typed state with timers (survey ids X1, X3, X4; extension).

The state of a host is a few numbers however many requests it answers. Outcomes of a host must reach the stream in order of their micro-batches;
within one they are put in order of time. A timer drops a host from which nothing came for ``idle_ms``; it begins anew when it comes back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StatefulProcessor

from registrylake.operators.pacing import BASE_GAP, MAX_RETRY_AFTER, decayed, raised

OUT = "host string, gap_ms long, next_ms long, n_429 long, n_requests long, expired boolean"
STATE = "gap long, next_ms long, n_429 long, n_requests long, last_ms long"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stepped(gap: int, next_ms: int | None, at_ms: int, outcome: str, retry_ms: int | None, base: int) -> tuple[int, int]:
    """Gap and next time after one outcome."""
    later = max(at_ms + gap, at_ms + gap if next_ms is None else next_ms)
    if outcome == "429":
        gap = raised(gap, base)
        later = max(later, at_ms + (gap if retry_ms is None else min(retry_ms, MAX_RETRY_AFTER)))
    elif outcome == "ok":
        gap = decayed(gap, base)
    return gap, later


class HostPacing(StatefulProcessor):
    def __init__(self, base: int, idle_ms: int):
        self.base, self.idle_ms = base, idle_ms

    def init(self, handle) -> None:
        self.handle, self.state = handle, handle.getValueState("host", STATE)

    def handleInputRows(self, key, rows, timerValues):
        gap, later, limited, n, last = self.state.get() if self.state.exists() else (self.base, None, 0, 0, 0)
        for r in sorted(rows, key=lambda r: (r.at_ms, r.ordinal)):
            gap, later = stepped(gap, later, r.at_ms, r.outcome, r.retry_ms, self.base)
            limited, n, last = limited + (r.outcome == "429"), n + 1, max(last, r.at_ms)
        self.state.update((gap, later, limited, n, last))
        for old in self.handle.listTimers():
            self.handle.deleteTimer(old)
        self.handle.registerTimer(last + self.idle_ms)
        yield Row(host=key[0], gap_ms=gap, next_ms=later, n_429=limited, n_requests=n, expired=False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.state.exists():
            gap, later, limited, n, _ = self.state.get()
            self.state.clear()
            yield Row(host=key[0], gap_ms=gap, next_ms=later, n_429=limited, n_requests=n, expired=True)

    def close(self) -> None:
        pass


def paced(rows: DataFrame, base: int = BASE_GAP, idle_ms: int = 86_400_000, late: str = "1 minute") -> DataFrame:
    """``rows``: host, at, ordinal, outcome (``429``, ``ok``, others), and retry_ms where a 429 named a time. Each host's state after every batch that touched it, and at its expiry.

    Rows that are more than ``late`` behind the newest one may be dropped.
    """
    from pyspark.sql import functions as F

    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    retry = F.col("retry_ms").cast("long") if "retry_ms" in rows.columns else F.lit(None).cast("long")
    plain = rows.select("host", "at", F.unix_millis("at").alias("at_ms"), F.col("ordinal").cast("long").alias("ordinal"), "outcome", retry.alias("retry_ms"))
    return plain.withWatermark("at", late).groupBy("host").transformWithState(HostPacing(base, idle_ms), OUT, "Update", "EventTime")
