import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from registrylake.operators import exclusions, merging, state
from registrylake.plans import pipelines as P

URLS = [(i, "http://{x}/" if i == 7 else f"http://h{i}/") for i in range(10)]


@pytest.fixture
def targets(spark, tmp_path):
    """Read from files, so that filters could be pushed to the scan."""
    spark.createDataFrame(URLS, "id int, url string").write.parquet(str(tmp_path / "t"))
    return spark.read.parquet(str(tmp_path / "t"))


def jobs_of(spark, run):
    spark.sparkContext.setJobGroup("refusal", "x")
    run()
    n = len(spark.sparkContext.statusTracker().getJobIdsForGroup("refusal"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return n


def test_building_a_refusal_runs_no_job(spark, targets):
    assert jobs_of(spark, lambda: exclusions.refuse_placeholders(targets, "url")) == 0
    assert jobs_of(spark, lambda: merging.refuse_if_empty(targets, "targets")) == 0


@pytest.mark.parametrize("later", [lambda d: d, lambda d: d.filter("id < 3"), lambda d: d.select("id"), lambda d: d.filter("id = 1").select("id"), lambda d: d.groupBy().count(), lambda d: d.join(d.sparkSession.range(3), "id", "left_semi")])
def test_a_bad_row_fails_the_job_whatever_comes_later(targets, later):
    with pytest.raises(Exception, match="holds a placeholder"):
        later(exclusions.refuse_placeholders(targets, "url")).collect()
    fine = targets.filter("id <> 7")
    assert later(exclusions.refuse_placeholders(fine, "url")).collect() == later(fine).collect()


def test_what_a_join_takes_out_before_is_not_judged(targets):
    held = exclusions.placeholders(targets, "url").select("id")
    assert exclusions.refuse_placeholders(targets.join(held, "id", "left_anti"), "url").count() == 9


def test_empty_tables_null_tests_and_truncated_trees(spark, targets):
    with pytest.raises(Exception, match="things: no rows"):
        merging.refuse_if_empty(targets.filter("id > 99"), "things").collect()
    assert sorted(merging.refuse_if_empty(targets, "things").collect()) == sorted(targets.collect())
    nulls = spark.createDataFrame([(1, None)], "id int, url string")
    assert exclusions.refuse_placeholders(nulls, "url").count() == 1
    trees = spark.createDataFrame([('{"truncated": true, "tree": []}',)], "body string")
    with pytest.raises(Exception, match="truncated"):
        P.refuse_truncated(trees).collect()


def test_counts_come_from_the_write(spark, tmp_path):
    old = spark.createDataFrame([("a", "1"), ("b", "2")], "k string, h string")
    new = spark.createDataFrame([("a", "1"), ("b", "3"), ("c", "4"), ("d", "5")], "k string, h string")
    counts = Observation()
    state.counted(state.changed(old, new, ["k"], ["h"]), counts).write.parquet(str(tmp_path / "s"))
    assert counts.get == {"new": 2, "changed": 1}


def brute_history(rows):
    out = set()
    for e in {r[0] for r in rows}:
        times = sorted({r[1] for r in rows if r[0] == e})
        at = [{r[2]: {p[0]: p[1:] for p in r[3]} for r in rows if r[0] == e and r[1] == t and r[2] is not None} for t in times]
        last = dict(at[0])
        for i, t in enumerate(times[1:], 1):
            out |= {(e, tool, t, None, "tool_removed") for tool in at[i - 1].keys() - at[i].keys()}
            for tool, params in at[i].items():
                if tool in last:
                    if tool not in at[i - 1]:
                        out.add((e, tool, t, None, "tool_returned"))
                    for name, (kind, need) in params.items():
                        was = last[tool].get(name)
                        if need and not (was and was[1]):
                            out.add((e, tool, t, name, "required_added"))
                        elif was and was[0] != kind:
                            out.add((e, tool, t, name, "type_changed"))
            last |= at[i]
    return out


KIND = "endpoint_url string, captured_at int, tool_name string, param_set array<struct<name: string, type: string, required: boolean>>"


@pytest.mark.parametrize("seed, parts", [(1, None), (2, 1), (3, 5)])
def test_breaking_history_against_brute_force(spark, seed, parts):
    rng, rows = random.Random(seed), []
    for e in ("hot", "a", None):
        for t in range(40 if e == "hot" else 6):
            tools = [x for x in "pqr" if rng.random() < 0.6] or [None]
            for tool in tools:
                params = [] if tool is None else [(n, rng.choice(["s", "n", None]), rng.random() < 0.4) for n in "xyz" if rng.random() < 0.6]
                rows.append((e, t * 2, tool, params))
    got = [tuple(r) for r in state.breaking_history(spark.createDataFrame(rows + rows[:5], KIND), parts).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_history(rows) and {g[4] for g in got} == {"tool_removed", "tool_returned", "required_added", "type_changed"}


def test_breaking_history_of_nothing(spark):
    assert state.breaking_history(spark.createDataFrame([], KIND)).count() == 0
    assert state.breaking_history(spark.createDataFrame([("a", 1, "t", [])], KIND)).count() == 0
