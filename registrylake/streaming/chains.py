"""Cursor chains whose pages arrive over time (survey ids X9, X15; extension).

A chain's pages wait in keyed list state. Once the pages from the first one on have no gap and one of them ends the chain, its row is given and later
pages of it change nothing; a chain to which nothing came for ``idle_ms`` is closed by a timer with what it has. State holds at most a page
more than the cap for each chain, and none after the timer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from registrylake.operators.chains import MAX_PAGES
from registrylake.streaming.pacing import ROCKS

PAGE = "page_no long, status string, next_cursor string, n_items long, exception string"
OUT = "chain string, status string, reason string, page_count int, item_count long, truncated boolean, items_lost long"


def ended(pages: list, max_pages: int) -> tuple:
    """What ``operators.chains.chain_end`` says of pages in order: status, reason, page_count, item_count, truncated, items_lost."""
    first, reason, at, cursor = pages[:max_pages], None, None, None
    for at, p in enumerate(first):
        if p[4] is not None:
            reason = "exception"
        elif p[1] is not None and p[1] != "ok":
            reason = "failed"
        elif not p[2]:
            reason = "complete"
        elif at and p[2] == cursor:
            reason = "repeated_cursor"
        if reason:
            break
        cursor = p[2]
    if reason is None:
        reason = "page_cap" if len(first) == max_pages else "unfinished"
    items = sum(p[3] for p in first[: at + 1] if p[4] is None and p[1] == "ok")
    partial = reason == "exception" and at > 0
    status = "ok" if partial else "error" if reason == "exception" else first[at][1] if reason == "failed" else "ok"
    return status, reason, at if reason == "exception" else at + 1, items if status == "ok" else None, partial or reason in ("repeated_cursor", "page_cap"), items if partial else 0


class ChainPages(StatefulProcessor):
    def __init__(self, max_pages: int, idle_ms: int, first: int):
        self.max_pages, self.idle_ms, self.first = max_pages, idle_ms, first

    def init(self, handle) -> None:
        self.handle = handle
        self.pages = handle.getListState("pages", PAGE)
        self.closed = handle.getValueState("closed", "done boolean")

    def handleInputRows(self, key, rows, timerValues):
        held = {p[0]: tuple(p) for p in (self.pages.get() if self.pages.exists() else ())}
        last = 0
        for r in rows:
            last = max(last, r.at_ms)
            if r.page_no <= self.max_pages:
                held.setdefault(r.page_no, (r.page_no, r.status, r.next_cursor, r.n_items, r.exception))
        for old in self.handle.listTimers():
            last = max(last, old - self.idle_ms)
            self.handle.deleteTimer(old)
        self.handle.registerTimer(last + self.idle_ms)
        if self.closed.exists():
            return
        run, n = [], self.first
        while n in held:
            run.append(held[n])
            n += 1
        # Nothing that comes later changes the end of a run without gaps that has one.
        if run and ended(run, self.max_pages)[1] != "unfinished":
            self.pages.clear()
            self.closed.update((True,))
            yield self._row(key, run)
        elif held:
            self.pages.put([held[n] for n in sorted(held)])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        pages = sorted((tuple(p) for p in self.pages.get()), key=lambda p: p[0]) if self.pages.exists() else []
        done = self.closed.exists()
        self.pages.clear()
        self.closed.clear()
        if pages and not done:
            yield self._row(key, pages)

    def _row(self, key, pages):
        status, reason, count, items, truncated, lost = ended(pages, self.max_pages)
        return Row(chain=key[0], status=status, reason=reason, page_count=count, item_count=items, truncated=truncated, items_lost=lost)

    def close(self) -> None:
        pass


def chains_of(pages: DataFrame, max_pages: int = MAX_PAGES, idle_ms: int = 3_600_000, late: str = "1 minute", first: int = 1) -> DataFrame:
    """``pages``: chain, at, page_no (from ``first``), status, next_cursor, n_items, exception. One row for each chain, as ``fold_chains`` gives it; of a page that comes twice the first one counts."""
    pages.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    plain = pages.select("chain", "at", F.unix_millis("at").alias("at_ms"), F.col("page_no").cast("long").alias("page_no"), "status", "next_cursor", F.col("n_items").cast("long").alias("n_items"), "exception")
    return plain.withWatermark("at", late).groupBy("chain").transformWithState(ChainPages(max_pages, idle_ms, first), OUT, "Append", "EventTime")
