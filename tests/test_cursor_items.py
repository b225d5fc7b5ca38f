import json
import os
import random

import pytest
from pyspark.sql import functions as F

from registrylake.sources import pages as S


@pytest.fixture
def chains(tmp_path):
    """Writes chains of pages: {chain: [[updatedAt, ...] of each page]}; pages from ``start`` on, the last one open if ``open_``."""

    def put(content, start=0, open_=False):
        for chain, pages in content.items():
            folder = tmp_path / "chains" / chain
            folder.mkdir(parents=True, exist_ok=True)
            for i, times in enumerate(pages, start):
                last = i == start + len(pages) - 1
                following = None if last and not open_ else f"p{i + 1}"
                body = {"servers": [{"n": f"{chain}{i}-{k}", "updatedAt": t} for k, t in enumerate(times)], "metadata": {"nextCursor": following}}
                (folder / f"{'first' if i == 0 else f'p{i}'}.json").write_text(json.dumps(body))
        return str(tmp_path / "chains")

    return put


def test_filters_are_pushed_and_right(spark, chains):
    rng = random.Random(2)
    content = {c: [[rng.choice([None, "", "2024-01-01", "2024-02-02", "2024-02-03", "é"]) for _ in range(rng.randrange(4))] for _ in range(5)] for c in "abcd"}
    path = chains(content)
    every = [tuple(r) for r in S.items(spark, path).collect()]
    assert len(every) == sum(len(p) for pages in content.values() for p in pages)
    u = F.col("updated_at")
    for column, test in [
        (u >= "2024-02-02", lambda r: r[3] is not None and r[3] >= "2024-02-02"), ((u > "2024-01-01") & (u < "2024-02-03"), lambda r: r[3] is not None and "2024-01-01" < r[3] < "2024-02-03"),
        (F.col("chain") == "b", lambda r: r[0] == "b"), (F.col("chain").isin("a", "d", "x") & (u <= "2024-02-02"), lambda r: r[0] in "ad" and r[3] is not None and r[3] <= "2024-02-02"),
        ((u == "é") & (F.col("page_no") > 1), lambda r: r[3] == "é" and r[1] > 1), (u.isNull() | (u > "2024-02-02"), lambda r: r[3] is None or r[3] > "2024-02-02"),
    ]:
        assert sorted(map(str, map(tuple, S.items(spark, path, column).collect()))) == sorted(map(str, filter(test, every)))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pushed_filters_leave_the_plan(spark, chains):
    path = chains({"a": [["2024-01-01"]], "b": [["2024-01-02"]]})
    df = S.items(spark, path, F.col("updated_at") >= "2024-01-02", F.col("chain") == "b")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Filter (isnotnull" in plan and ">=" not in plan and "2024" not in plan
    assert df.rdd.getNumPartitions() == 1 and df.count() == 1
    kept = S.items(spark, path, F.col("page_no") >= 0)._jdf.queryExecution().executedPlan().toString()
    assert "page_no" in kept and ">= 0" in kept


def stream(spark, path, tmp_path, per_step=2, fail=None):
    S.register(spark)
    rows = spark.readStream.format("cursor_items").option("path", path).option("progress", str(tmp_path / "progress")).option("pagesPerStep", per_step).load()

    def put(batch, epoch):
        batch.write.mode("overwrite").parquet(str(tmp_path / "out" / f"e{epoch:05d}"))
        if fail is not None and epoch == fail:
            raise RuntimeError("the driver dies before the step is committed")

    return rows.writeStream.foreachBatch(put).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()


def drain(spark, path, tmp_path, **how):
    """One run of the stream ends once no page waits; a trigger that sees one step starts the next."""
    for _ in range(20):
        stream(spark, path, tmp_path, **how).awaitTermination()
        last = S._ItemStream({"path": path, "progress": str(tmp_path / "progress")})
        if not any((state := last._state(n, None))["cursor"] and last.has(n, state["cursor"]) for n in last.names()):
            return


def written(spark, tmp_path):
    out = tmp_path / "out"
    parts = [spark.read.parquet(str(out / e)) for e in sorted(os.listdir(out))]
    return sorted((r.chain, r.page_no, r.pos) for p in parts for r in p.collect())


def test_a_restart_reads_no_page_twice(spark, chains, tmp_path):
    path = chains({"a": [["x", "y"]] * 5, "b": [["x"]] * 2, "c": [[]]}, open_=True)
    with pytest.raises(Exception):
        stream(spark, path, tmp_path, fail=1).awaitTermination()
        stream(spark, path, tmp_path, fail=1).awaitTermination()
    drain(spark, path, tmp_path)
    want = [("a", i, k) for i in range(5) for k in (0, 1)] + [("b", i, 0) for i in range(2)]
    assert written(spark, tmp_path) == sorted(want)
    chains({"a": [["z"], ["z"]]}, start=5)
    chains({"d": [["n"]]})
    drain(spark, path, tmp_path)
    assert written(spark, tmp_path) == sorted([*want, ("a", 5, 0), ("a", 6, 0), ("d", 0, 0)])


def test_steps_end_at_a_cursor_that_was_seen(chains, tmp_path):
    path = chains({"a": [["x"], ["y"]]})
    loop = tmp_path / "chains" / "a" / "p1.json"
    loop.write_text(json.dumps({"servers": [{"n": 1}], "metadata": {"nextCursor": "first"}}))
    reader = S._ItemStream({"path": path, "progress": str(tmp_path / "progress"), "pagesPerStep": "1"})
    seen = []
    for step in range(4):
        end = reader.latestOffset()
        if end["step"] == step:
            break
        for part in reader.partitions({"step": step}, end):
            first = list(reader.read(part))
            assert list(reader.read(part)) == first  # a step that is run again reads the same
            seen += [r[:3] for r in first]
    assert seen == [("a", 0, 0), ("a", 1, 0)] and reader.latestOffset() == {"step": 2}


def test_empty_folders(spark, tmp_path):
    assert S.items(spark, str(tmp_path / "none")).count() == 0
    assert S._ItemStream({"path": str(tmp_path / "none"), "progress": str(tmp_path / "p")}).latestOffset() == {"step": 0}
