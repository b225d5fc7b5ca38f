"""Per-host pacing (survey ids X1-X8, A16): the gap's fold as an expression, the sweep as a simulator with a virtual clock."""

from __future__ import annotations

import heapq
from collections import deque
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from registrylake.operators import ordered

BASE_GAP, MAX_GAP, MAX_RETRY_AFTER, RAISE, DECAY = 150, 60_000, 300_000, 4, 0.8


def raised(gap: float, base: int = BASE_GAP) -> int:
    return int(min(MAX_GAP, max(base, gap) * RAISE))


def decayed(gap: float, base: int = BASE_GAP) -> int:
    return int(max(base, (gap * DECAY + 0.5) // 1))


def gap_after(outcomes: Column, base: int = BASE_GAP, start: Column | None = None) -> Column:
    """The gap after an array of outcomes (``429``, ``ok``, others), folded in order from ``start`` (the base gap)."""
    up = lambda g: F.least(F.lit(MAX_GAP).cast("long"), F.greatest(F.lit(base).cast("long"), g) * RAISE)
    down = lambda g: F.greatest(F.lit(base).cast("long"), F.floor(g * DECAY + 0.5))
    first = F.lit(base).cast("long") if start is None else start
    return F.aggregate(outcomes, first, lambda g, o: F.when(o == "429", up(g)).when(o == "ok", down(g)).otherwise(g))


def gap_fold(rows: DataFrame, host: str, order: list[str], outcome: str, base: int = BASE_GAP, parts: int | None = None) -> DataFrame:
    """A16's inputs: last gap, 429s and requests of each host.

    A host's history is cut into ranges, so that none is a single array. The fold of a range rises with the gap that it
    starts from; where the least and the largest start give one result, every start does, and the range is that number. The
    few others (short ones, mostly) keep the outcomes that move the gap. The ranges of a host are folded in order.
    """
    cut = ordered.ranged(rows.select(host, *order, F.col(outcome).alias("__rl_o")), [host, *order], parts)
    moves = F.when(F.col("__rl_o").isin("429", "ok"), F.struct(*order, "__rl_o"))
    listed = F.transform(F.array_sort(F.collect_list(moves)), lambda x: x["__rl_o"])
    each = cut.groupBy(host, ordered.RANGE).agg(listed.alias("__rl_o"), F.count_if(F.col("__rl_o") == "429").alias("n_429"), F.count(F.lit(1)).alias("n_requests"))
    low, high = gap_after(F.col("__rl_o"), base), gap_after(F.col("__rl_o"), base, F.lit(MAX_GAP).cast("long"))
    told = each.withColumns({"low": low, "high": high})
    step = F.struct(ordered.RANGE, F.when(F.col("low") == F.col("high"), F.col("low")).alias("gap"), F.when(F.col("low") != F.col("high"), F.col("__rl_o")).alias("o"))
    whole = told.groupBy(host).agg(F.array_sort(F.collect_list(step)).alias("__rl_steps"), F.sum("n_429").alias("n_429"), F.sum("n_requests").alias("n_requests"))
    gap = F.aggregate("__rl_steps", F.lit(base).cast("long"), lambda g, x: F.coalesce(x["gap"], gap_after(x["o"], base, g)))
    return whole.select(host, gap.alias("gap_ms"), "n_429", "n_requests")


def next_times(rows: DataFrame, host: str, order: list[str], outcome: str, retry_ms: str | None = None, base: int = BASE_GAP, parts: int | None = None) -> DataFrame:
    """Last gap, next time (ms), 429s and requests of each host; ``order`` is the time and a tiebreak.

    A request keeps the host's gap free after it; a 429 raises the gap and defers the host by its retry time (``retry_ms``, capped), or
    by the raised gap where it names none. A host's history is cut into ranges as in ``gap_fold``; a range that knows the gap it starts from
    is folded by itself, and the host's next time is the latest of its ranges'.
    """
    wait = F.col(retry_ms).cast("long") if retry_ms else F.lit(None).cast("long")
    cut = ordered.ranged(rows.select(host, *order, F.col(outcome).alias("__rl_o"), wait.alias("__rl_w")), [host, *order], parts)
    item = F.struct(*order, F.unix_millis(order[0]).alias("__rl_at"), "__rl_o", "__rl_w")
    each = cut.groupBy(host, ordered.RANGE).agg(F.array_sort(F.collect_list(item)).alias("__rl_x"), F.count_if(F.col("__rl_o") == "429").alias("n_429"), F.count(F.lit(1)).alias("n_requests"))
    moves = F.transform("__rl_x", lambda x: x["__rl_o"])
    told = each.withColumns({"low": gap_after(moves, base), "high": gap_after(moves, base, F.lit(MAX_GAP).cast("long"))})
    same = F.col("low") == F.col("high")
    step = F.struct(ordered.RANGE, F.when(same, F.col("low")).alias("gap"), F.when(~same, F.filter(moves, lambda o: o.isin("429", "ok"))).alias("o"))
    steps = told.groupBy(host).agg(F.array_sort(F.collect_list(step)).alias("__rl_steps"))
    none = F.array().cast(f"array<struct<{ordered.RANGE}: int, gap: bigint>>")

    def along(acc, x):
        here = F.struct(x[ordered.RANGE].alias(ordered.RANGE), acc["gap"].alias("gap"))
        return F.struct(F.coalesce(x["gap"], gap_after(x["o"], base, acc["gap"])).alias("gap"), F.concat(acc["starts"], F.array(here)).alias("starts"))

    starts = F.aggregate("__rl_steps", F.struct(F.lit(base).cast("long").alias("gap"), none.alias("starts")), along)["starts"]
    begun = steps.select(F.col(host).alias("__rl_host"), F.explode(starts).alias("s")).select("__rl_host", F.col(f"s.{ordered.RANGE}").alias("__rl_r"), F.col("s.gap").alias("__rl_gap"))
    both = each.join(begun, F.col(host).eqNullSafe(F.col("__rl_host")) & (F.col(ordered.RANGE) == F.col("__rl_r")))

    def fold(acc, x):
        gap = gap_after(F.array(x["__rl_o"]), base, acc["gap"])
        wait = F.when(x["__rl_w"].isNull(), gap).otherwise(F.least(x["__rl_w"], F.lit(MAX_RETRY_AFTER).cast("long")))
        return F.struct(gap.alias("gap"), F.greatest(acc["next"], x["__rl_at"] + acc["gap"], F.when(x["__rl_o"] == "429", x["__rl_at"] + wait)).alias("next"))

    end = F.aggregate("__rl_x", F.struct(F.col("__rl_gap").alias("gap"), F.lit(None).cast("long").alias("next")), fold)
    done = both.withColumn("__rl_end", end)
    return done.groupBy(host).agg(F.max_by("__rl_end.gap", ordered.RANGE).alias("gap_ms"), F.max("__rl_end.next").alias("next_ms"), F.sum("n_429").alias("n_429"), F.sum("n_requests").alias("n_requests"))


def sweep_statistics(hosts: DataFrame, host: str, base: int = BASE_GAP) -> tuple[DataFrame, DataFrame]:
    """Totals over hosts, and the three busiest."""
    total = hosts.agg(F.count(F.lit(1)).alias("hosts"), F.count_if(F.col("gap_ms") > base).alias("backed_off"), F.sum("n_429").alias("n_429"), F.max("gap_ms").alias("max_gap_ms"))
    return total, hosts.orderBy(F.desc("n_requests"), host).limit(3)


@dataclass
class HostState:
    host: str
    queue: deque = field(default_factory=deque)
    gap: float = BASE_GAP
    next_at: float = 0.0
    busy: bool = False
    n_429: int = 0


def simulate(endpoints: list, perform, workers: int = 8, deadline: float = float("inf"), base: int = BASE_GAP, only_ok_decays: bool = False) -> dict:
    """A sweep over (host, endpoint) with ``perform(host, endpoint, attempt) -> (outcome, ms, retry_after_ms)``.

    One request a host at a time, hosts in turn; a first 429 raises the host's gap, honours its retry time and puts the
    endpoint at the front of its queue; a second one is final and raises again without the retry time (R7). Other rows
    decay the gap, or only ``ok`` ones (R8). Nothing is dispatched after the deadline; what is left is counted.
    """
    hosts: dict[str, HostState] = {}
    for host, endpoint in endpoints:
        hosts.setdefault(host, HostState(host, gap=base)).queue.append((endpoint, 1))
    ring, cursor, now, rows = list(hosts.values()), 0, 0.0, []
    running: list = []
    while True:
        while len(running) < workers and now < deadline:
            ready = next((i for i in range(len(ring)) if (s := ring[(cursor + i) % len(ring)]).queue and not s.busy and s.next_at <= now), None)
            if ready is None:
                break
            s = ring[(cursor + ready) % len(ring)]
            cursor = (cursor + ready + 1) % len(ring)
            endpoint, attempt = s.queue.popleft()
            s.busy, s.next_at = True, now + s.gap
            outcome, ms, retry = perform(s.host, endpoint, attempt)
            heapq.heappush(running, (now + ms, len(rows) + len(running), s.host, endpoint, attempt, outcome, retry))
        if not running:
            waiting = [s.next_at for s in ring if s.queue]
            if not waiting or min(waiting) >= deadline or now >= deadline:
                break
            now = max(now, min(waiting))
            continue
        now, _, host, endpoint, attempt, outcome, retry = heapq.heappop(running)
        s = hosts[host]
        s.busy = False
        if outcome == "429":
            s.n_429 += 1
            s.gap = raised(s.gap, base)
            wait = min(retry, MAX_RETRY_AFTER) if retry and attempt == 1 else s.gap
            s.next_at = max(s.next_at, now + wait)
            if attempt == 1:
                s.queue.appendleft((endpoint, 2))
                continue
        elif outcome == "ok" or not only_ok_decays:
            s.gap = decayed(s.gap, base)
        rows.append((host, endpoint, attempt, outcome, now))
    return {"rows": rows, "undispatched": sum(len(s.queue) for s in ring), "gaps": {h: s.gap for h, s in hosts.items()}, "n_429": sum(s.n_429 for s in ring)}


def slots(rows: DataFrame, host: str, at: str, gap_ms: int = 100, tiebreak: str | None = None, parts: int | None = None) -> DataFrame:
    """Start times of a host's requests, at least ``gap_ms`` apart: the latest of (arrival_i + (k - i) * gap) over i up to k.

    The maximum runs within a range of the host's requests and goes on from the ranges before. Requests of one time go by ``tiebreak``.
    """
    order = [at, tiebreak] if tiebreak else [at]
    cut = ordered.ranged(rows, [host, *order], parts)
    w = ordered.within([host], order)
    ranked = cut.withColumn("__rl_k", F.row_number().over(w)).withColumn("__rl_t", F.unix_millis(at) - F.col("__rl_k") * gap_ms)
    tops = ranked.groupBy(host, ordered.RANGE).agg(F.count(F.lit(1)).alias("__rl_n"), F.max("__rl_t").alias("__rl_top"))
    # The place of a range's first request among the host's, and the top of the ranges before it on the same scale.
    earlier = ordered.before([host])
    tops = tops.withColumn("__rl_base", F.coalesce(F.sum("__rl_n").over(earlier), F.lit(0)))
    tops = tops.withColumn("__rl_head", F.max(F.col("__rl_top") - F.col("__rl_base") * gap_ms).over(earlier))
    tops = tops.select(F.col(host).alias("__rl_host"), F.col(ordered.RANGE).alias("__rl_r"), "__rl_base", "__rl_head")
    both = ranked.join(tops, F.col(host).eqNullSafe(F.col("__rl_host")) & (F.col(ordered.RANGE) == F.col("__rl_r")))
    own = F.max("__rl_t").over(w.rowsBetween(W.unboundedPreceding, 0)) - F.col("__rl_base") * gap_ms
    start = F.greatest(own, F.col("__rl_head")) + (F.col("__rl_base") + F.col("__rl_k")) * gap_ms
    return both.withColumn("start_ms", start).select(*rows.columns, "start_ms")
