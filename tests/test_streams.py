import os
import random
from datetime import datetime, timedelta

import pytest

from registrylake.operators import pacing
from registrylake.operators.chains import fold_chains
from registrylake.streaming import chains as sc
from registrylake.streaming import pacing as sp

T0 = datetime(2024, 1, 1)


def at(ms):
    return T0 + timedelta(milliseconds=ms)


@pytest.fixture
def streamed(spark, tmp_path):
    """The rows that a stream gives for batches of rows, each batch a file and a micro-batch of its own."""

    def run(batches, kind, make, name="s"):
        source, out = str(tmp_path / name / "in"), {}
        os.makedirs(source)
        for i, rows in enumerate(batches):
            spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(source)
            for f in os.listdir(source):
                if f.endswith(".parquet") and not f.startswith("b"):
                    os.rename(f"{source}/{f}", f"{source}/b{i:03d}.parquet")
                    os.utime(f"{source}/b{i:03d}.parquet", (1_700_000_000 + i, 1_700_000_000 + i))
        rows = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(f"{source}/b*.parquet")
        stream = make(rows).writeStream.foreachBatch(lambda b, e: out.setdefault(e, b.collect())).outputMode("update").option("checkpointLocation", str(tmp_path / name / "cp"))
        stream.trigger(availableNow=True).start().awaitTermination()
        return [r for e in sorted(out) for r in out[e]]

    return run


OUTCOMES = "host string, at timestamp, ordinal long, outcome string, retry_ms long"


def outcomes(seed, n=120, hosts="abc"):
    rng, rows, now = random.Random(seed), [], 0
    for i in range(n):
        now += rng.choice([0, 1, 200, 5000])
        outcome = rng.choice(["429", "ok", "ok", "other"])
        rows.append((rng.choice(hosts), at(now), i, outcome, rng.choice([None, 0, 700, 10**9]) if outcome == "429" else None))
    return rows


def brute_pacing(rows, base=150):
    out = {}
    for host in {r[0] for r in rows}:
        gap, nxt, limited, n = base, None, 0, 0
        for _, when, _, outcome, retry in sorted((r for r in rows if r[0] == host), key=lambda r: (r[1], r[2])):
            ms, n = int((when - datetime(1970, 1, 1)).total_seconds() * 1000 + 0.5), n + 1
            nxt = max(nxt or 0, ms + gap)
            if outcome == "429":
                gap, limited = min(60_000, max(base, gap) * 4), limited + 1
                nxt = max(nxt, ms + (gap if retry is None else min(retry, 300_000)))
            elif outcome == "ok":
                gap = max(base, int(gap * 0.8 + 0.5))
        out[host] = (gap, nxt, limited, n)
    return out


@pytest.mark.parametrize("parts", [None, 1, 7])
def test_next_times_over_ranges(spark, parts):
    rows = outcomes(1)
    got = pacing.next_times(spark.createDataFrame(rows, OUTCOMES), "host", ["at", "ordinal"], "outcome", "retry_ms", parts=parts)
    assert {r.host: (r.gap_ms, r.next_ms, r.n_429, r.n_requests) for r in got.collect()} == brute_pacing(rows)


def test_next_times_of_nothing_and_of_null_hosts(spark):
    empty = spark.createDataFrame([], OUTCOMES)
    assert pacing.next_times(empty, "host", ["at", "ordinal"], "outcome", "retry_ms").count() == 0
    rows = [(None, at(5), 1, "429", None), (None, at(6), 2, None, None)]
    got = pacing.next_times(spark.createDataFrame(rows, OUTCOMES), "host", ["at", "ordinal"], "outcome").first()
    assert (got.host, got.gap_ms, got.n_429, got.n_requests) == (None, 600, 1, 2)


def test_streamed_pacing_equals_both_folds(spark, streamed):
    rng, rows = random.Random(3), outcomes(3)
    batches, left = [], list(rows)
    while left:
        n = rng.randrange(1, 50)
        batch, left = left[:n], left[n:]
        batches.append(rng.sample(batch, len(batch)))  # no order within a micro-batch
    got = {r.host: (r.gap_ms, r.next_ms, r.n_429, r.n_requests) for r in streamed(batches, OUTCOMES, lambda d: sp.paced(d, late="1 day")) if not r.expired}
    assert got == brute_pacing(rows)
    gaps = {r.host: (r.gap_ms, r.n_429, r.n_requests) for r in pacing.gap_fold(spark.createDataFrame(rows, OUTCOMES), "host", ["at", "ordinal"], "outcome").collect()}
    assert {h: (g, l, n) for h, (g, _, l, n) in got.items()} == gaps


def test_idle_hosts_expire_and_begin_anew(streamed):
    batches = [[("a", at(0), 1, "429", None), ("b", at(0), 2, "429", None)], [("b", at(90_000), 3, "ok", None)], [("c", at(200_000), 4, "ok", None)], [("c", at(200_100), 5, "other", None)], [("a", at(200_500), 5, "ok", None), ("b", at(200_500), 6, "429", None)]]
    got = streamed(batches, OUTCOMES, lambda d: sp.paced(d, idle_ms=60_000, late="0 seconds"))
    assert {(r.host, r.gap_ms, r.n_requests) for r in got if r.expired} == {("a", 600, 1), ("b", 480, 2)}
    final = {r.host: (r.gap_ms, r.n_429, r.n_requests) for r in got if not r.expired}
    assert final == {"a": (150, 0, 1), "b": (600, 1, 1), "c": (150, 0, 2)}


PAGES = "chain string, at timestamp, page_no long, status string, next_cursor string, n_items long, exception string"


def page_rows(seed, n=25, max_pages=5):
    rng, rows = random.Random(seed), []
    for c in range(n):
        for i in range(1, rng.randrange(2, max_pages + 3)):
            kind = rng.random()
            cursor = rng.choice(["", None]) if kind < 0.15 else "same" if kind < 0.3 else f"c{i}"
            rows.append((f"chain{c}", at(rng.randrange(1000)), i, "failed" if kind > 0.93 else "ok", cursor, rng.randrange(9), "boom" if 0.88 < kind < 0.92 else None))
    return rows


def as_tuples(rows):
    return sorted((r.chain, r.status, r.reason, r.page_count, r.item_count, r.truncated, r.items_lost) for r in rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_of_pages_gives_the_batch_rows(spark, streamed, seed):
    rng, rows = random.Random(seed), page_rows(seed)
    rng.shuffle(rows)
    batches, left = [], list(rows)
    while left:
        n = rng.randrange(1, 40)
        batches.append(left[:n])
        left = left[n:]
    later = ("late", at(100_000_000), 1, "ok", "", 1, None)  # moves the watermark, so that timers close what is unfinished
    got = streamed([*batches, [later]], PAGES, lambda d: sc.chains_of(d, 5, idle_ms=10_000, late="1 hour"))
    want = fold_chains(spark.createDataFrame(rows, PAGES), ["chain"], 5).collect()
    assert as_tuples(r for r in got if r.chain != "late") == as_tuples(want) and any(r.reason == "unfinished" for r in want)


def test_the_end_of_pages_in_order_equals_the_expression(spark):
    rows = page_rows(7, n=120)
    want = {r.chain: tuple(r)[1:] for r in fold_chains(spark.createDataFrame(rows, PAGES), ["chain"], 5).collect()}
    for chain, told in want.items():
        pages = sorted((r[2], r[3], r[4], r[5], r[6]) for r in rows if r[0] == chain and r[2] <= 5)
        assert sc.ended(pages, 5) == told


def test_a_closed_chain_ignores_late_pages_and_repeats(streamed):
    p = lambda ms, n, cursor: ("x", at(ms), n, "ok", cursor, 2, None)
    got = streamed([[p(0, 2, "")], [p(1, 1, "c")], [p(2, 3, "d"), p(2, 1, "other")], [("y", at(10**8), 1, "ok", "", 1, None)]], PAGES, lambda d: sc.chains_of(d, idle_ms=1000, late="1 minute"))
    assert [(r.chain, r.reason, r.page_count, r.item_count) for r in got] == [("x", "complete", 2, 4), ("y", "complete", 1, 1)]
