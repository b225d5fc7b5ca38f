"""Operators that cut hot keys into ranges, against plain versions, with several ranges and AQE on and off."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from registrylake.operators import latest, merging, pacing, state


@pytest.fixture(params=["true", "false"])
def aqe(spark, request):
    spark.conf.set("spark.sql.adaptive.enabled", request.param)
    yield
    spark.conf.unset("spark.sql.adaptive.enabled")


def test_lookup_batches_hold_every_name_once(spark, aqe):
    n = 2_000_000
    rows = spark.range(n).select(F.concat(F.lit("n"), F.col("id")).alias("name"))
    got = merging.lookup_batches(rows.unionByName(rows.limit(1000)), "name", parts=13)
    figures = got.agg(F.count("*"), F.count_distinct("name"), F.count_distinct("batch"), F.max("batch")).first()
    sizes = got.groupBy("batch").count().groupBy("count").count().collect()
    assert tuple(figures) == (n, n, 15625, 15624) and [tuple(r) for r in sizes] == [(128, 15625)]


def test_lookup_batches_are_in_order(spark, aqe):
    names = [f"n{i:05d}" for i in range(15_000)]
    random.Random(1).shuffle(names)
    for parts in (None, 7):
        got = merging.lookup_batches(spark.createDataFrame([(x,) for x in names], "name string").repartition(5), "name", parts=parts).collect()
        assert {r.name: r.batch for r in got} == {x: i // 128 for i, x in enumerate(sorted(names))} and len(got) == 15_000


def test_lookup_results(spark):
    batches = spark.createDataFrame([("a", 0), ("b", 0), ("c", 0), ("d", 1), ("e", 2), ("f", 2)], "name string, batch long")
    bodies = spark.createDataFrame([(0, '{"a": {"x": 1}, "b": null}'), (1, '{"x": 4}'), (2, None)], "batch long, body string")
    got = {r.name: r.value for r in merging.lookup_results(batches, "name", bodies).collect()}
    assert got == {"a": '{"x":1}', "b": None, "c": None, "d": '{"x": 4}', "e": None, "f": None}


T0 = datetime(2024, 1, 1)


def history(seed=3, n=3000):
    r = random.Random(seed)
    return [(("hot" if r.random() < 0.5 else f"k{r.randrange(20)}") if r.random() > 0.01 else None, T0 + timedelta(milliseconds=r.randrange(10**7)), i, r.choice(["429", "ok", "ok", "ok", "error"])) for i in range(n)]


@pytest.mark.parametrize("parts", [1, 9, 200])
def test_gap_fold_slots_and_transitions_over_ranges(spark, parts):
    data = history()
    rows = spark.createDataFrame(data, "host string, ts timestamp, id int, outcome string").repartition(4)
    by: dict = {}
    for row in sorted(data, key=lambda x: (x[1], x[2])):
        by.setdefault(row[0], []).append(row)
    gaps, starts, moved = {}, {}, set()
    for host, xs in by.items():
        gap, at, before = 150, None, None
        for _, ts, i, o in xs:
            gap = pacing.raised(gap) if o == "429" else pacing.decayed(gap) if o == "ok" else gap
            ms = int((ts - T0).total_seconds() * 1000 + 0.5)
            at = ms if at is None else max(ms, at + 4000)
            starts[i] = at
            if before is not None and before != o:
                moved.add((i, before, o))
            before = o
        gaps[host] = (gap, sum(x[3] == "429" for x in xs), len(xs))
    assert {r.host: (r.gap_ms, r.n_429, r.n_requests) for r in pacing.gap_fold(rows, "host", ["ts", "id"], "outcome", parts=parts).collect()} == gaps
    base = int(spark.createDataFrame([(T0,)], "t timestamp").select(F.unix_millis("t")).first()[0])
    assert {r.id: r.start_ms - base for r in pacing.slots(rows, "host", "ts", 4000, "id", parts).collect()} == starts
    told = state.transition_history(rows, ["host"], "ts", "id", "outcome", parts).collect()
    assert {(r.id, r.from_state, r.to_state) for r in told} == moved


def test_runs_with_rows_at_every_scale_of_time(spark):
    r = random.Random(4)
    times = [T0 + timedelta(seconds=r.randrange(86_400 * 4) // 7 * 7, microseconds=r.choice([0, 500_000])) for _ in range(300)]
    runs = []
    for i in range(400):
        a = T0 + timedelta(milliseconds=r.randrange(86_400_000 * 4))
        runs.append((f"r{i}", a, None if i % 17 == 0 else a + timedelta(milliseconds=r.choice([0, 400, 20_000, 3_600_000, 10**8]))))
    runs += [("edge", times[0], times[0]), ("after", times[1] + timedelta(microseconds=1), times[1] + timedelta(microseconds=2))]
    want = {k for k, a, z in runs if z and any(a <= t <= z for t in times)}
    got = latest.runs_with_rows(spark.createDataFrame(runs, "run_id string, started_at timestamp, finished_at timestamp"), spark.createDataFrame([(t,) for t in times] + [(None,)], "ts timestamp"), "ts").collect()
    assert sorted(x.run_id for x in got) == sorted(want) and 0 < len(want) < len(runs)


def test_sorted_arrays(spark):
    texts = ["b", "", "\U0001f600", "a", "B", "ä", "￿", "A"]
    df = spark.createDataFrame([(texts,)], "x array<string>")
    assert df.select(merging.utf16_sorted(F.col("x"))).first()[0] == sorted(texts, key=lambda s: s.encode("utf-16-be"))
    paths = ["b/x", "B/a", "a/Z", "A/y", "ä/q", "a/z"]
    assert df.select(merging.locale_sorted(F.array(*map(F.lit, paths)))).first()[0] == ["ä/q", "A/y", "a/z", "a/Z", "B/a", "b/x"]


def test_pages_pairs_and_objects(spark):
    rows = spark.createDataFrame([(i, i % 3, f"c{i % 4}") for i in range(25)], "id int, k int, name string")
    assert [[r.id for r in merging.paged(rows, ["id"], 10, p).collect()] for p in (0, 2, 3)] == [list(range(10)), list(range(20, 25)), []]
    assert tuple(merging.count_pair(rows, F.col("k") == 1).first()) == (25, 8)
    got = merging.object_of(rows.filter("id < 8").select("k", "name", "id"), ["k"], "name", "id").collect()
    assert {r.k: r.object for r in got} == {0: '{"c0":0,"c2":6,"c3":3}', 1: '{"c0":4,"c1":1,"c3":7}', 2: '{"c1":5,"c2":2}'}
