import json
import os
import random
from datetime import datetime

import pytest

from registrylake.functions import jsonhash as J
from registrylake.plans import quality as q
from registrylake.sources import pages

T0, T1 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def grants(spark, *rows):
    return spark.createDataFrame([("me", *r) for r in rows] + [("other", "items", None, "INSERT")], "role string, relation string, `column` string, privilege string")


def test_access_facts(spark):
    full = [("items", None, "INSERT"), ("items", None, "SELECT"), ("transitions", None, "INSERT"), *[("items", c, "UPDATE") for c in q.UPDATE_COLUMNS]]
    assert q.write_access_problems(q.access_facts(grants(spark, *full), "me")) == []
    assert q.write_access_problems(q.access_facts(grants(spark, *full[:3], ("items", None, "UPDATE")), "me")) == []
    lacking = q.write_access_problems(q.access_facts(grants(spark, *full[1:-1]), "me"))
    assert lacking == ["missing INSERT on items", "missing column-level UPDATE on items (fetched_at)"]
    assert len(q.write_access_problems(q.access_facts(grants(spark), "nobody"))) == 4


def test_constraint(spark):
    table = spark.createDataFrame([("method_check", "CHECK (method = ANY (ARRAY['GET', 'HEAD']))")], "name string, definition string")
    assert q.admitted(table, "method_check", "HEAD") == ("HEAD", None)
    value, note = q.admitted(table, "method_check", "POST")
    assert value is None and "POST" in note
    assert q.admitted(table, "gone", "POST")[0] == "POST"


def test_dry_run_leaves_nothing(spark):
    kept = []

    def work(folder):
        spark.range(3).write.parquet(f"{folder}/t")
        kept.append(folder.removeprefix("file://").removeprefix("file:"))
        return spark.read.parquet(f"{folder}/t").count()

    assert q.rolled_back(spark, work) == 3 and not os.path.exists(kept[0])
    with pytest.raises(ZeroDivisionError):
        q.rolled_back(spark, lambda folder: (work(folder), 1 / 0))
    assert not os.path.exists(kept[1])


def test_a_run_has_one_row(spark):
    records = q.running_record(spark, "a", "s", T0).unionByName(q.running_record(spark, "b", "s", T0)).unionByName(q.run_record(spark, "a", "s", T0, T1, {"pages": 2, "rows": 5}))
    assert {r.id: (r.status, r.finished_at, r.servers_returned) for r in q.runs_of(records).collect()} == {"a": ("completed: pages=2, rows=5", T1, 5), "b": ("running", None, 0)}


def test_chunks_fail_alone():
    seen = []

    def write(part):
        if 3 in part:
            raise ValueError
        seen.extend(part)

    assert q.chunked(list(range(7)), write, 2) == (5, 1) and seen == [0, 1, 4, 5, 6]


def test_a_chain_is_cut_only_on_request_and_says_so(spark, tmp_path):
    pages.register(spark)
    for chain, n in (("a", 4), ("b", 2)):
        (tmp_path / chain).mkdir()
        for i in range(n):
            (tmp_path / chain / f"{'first' if i == 0 else f'c{i}'}.json").write_text(json.dumps({"servers": [], "metadata": {"nextCursor": f"c{i + 1}" if i + 1 < n else None}}))
    for path in (str(tmp_path), f"file://{tmp_path}"):
        assert spark.read.format("cursor_pages").option("path", path).load().count() == 6
    cut = spark.read.format("cursor_pages").option("path", str(tmp_path)).option("maxPages", "2").load().collect()
    assert {(r.chain, r.page_no, json.loads(r.body).get("truncated", False)) for r in cut} == {("a", 0, False), ("a", 1, True), ("b", 0, False), ("b", 1, False)}


def test_one_walk_equals_two():
    r = random.Random(7)

    def value(depth):
        kind = r.randrange(8 if depth else 5)
        if kind == 0:
            return None
        if kind == 1:
            return r.choice([True, False])
        if kind == 2:
            return r.choice([0.0, -0.0, 1e21, 1e-7, 123456789012345680000.0, 0.1, -5.5, 1e15, 1e16, 3.0])
        if kind in (3, 4):
            return r.choice(["", "a", "é ", "\U0001f600", "\ud800", '"\\\n\x01', "10"])
        if kind == 5:
            return [value(depth - 1) for _ in range(r.randrange(4))]
        return {r.choice(["required", "enum", "title", "b", "a", "10", "9", "01", "￮", "\U0001f600", ""]): value(depth - 1) for _ in range(r.randrange(5))}

    for _ in range(3000):
        v = value(4)
        for sets, drop in ((False, False), (True, False), (True, True)):
            assert J.canonical_text(v, sets, drop) == J.stringify(J.canonical(v, sets, drop))


def test_facts_equal_the_single_functions(spark):
    texts = ['{"properties":{"a":{"type":["x","y"],"description":"d"}},"required":["a",1],"$defs":{}}', "[]", "3", "no json", None, '{"required":["b","a"],"title":5}']
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    from pyspark.sql import functions as F

    s = F.col("s")
    for row in df.select(J.schema_facts(s).alias("f"), J.schema_hash(s).alias("h"), J.contract_hash(s).alias("c"), J.param_set(s).alias("p"), J.required_count(s).alias("r"), J.max_depth(s).alias("d"), J.false_drift(s).alias("x")).collect():
        assert (row.f.schema_hash, row.f.contract_hash, row.f.param_set, row.f.required_count, row.f.max_depth) == (row.h, row.c, row.p, row.r, row.d)
        assert tuple(row.f[n] for n in J.FLAGS.names) == tuple(row.x)


def test_a_late_segment_is_interrupted_and_its_peers_stand(spark, tmp_path):
    import time

    def stuck():
        for _ in range(1000):  # interrupted jobs are followed by new ones
            try:
                spark.range(10**13, numPartitions=2).selectExpr("sum(id * id % 7)").collect()
            except Exception:
                time.sleep(0.05)
                if (tmp_path / "stop").exists():
                    raise

    def rows():
        spark.range(5).write.parquet(str(tmp_path / "rows"))
        return "written"

    def broken():
        raise KeyError("x")

    began = time.monotonic()
    done, errors = q.within_deadline(spark, {"stuck": stuck, "rows": rows, "broken": broken}, 8, grace=2)
    assert done == {"rows": "written"} and errors["stuck"].startswith("late") and errors["broken"] == "KeyError: 'x'" and time.monotonic() - began < 40
    assert spark.read.parquet(str(tmp_path / "rows")).count() == 5
    (tmp_path / "stop").write_text("")
    with pytest.raises(q.RunFailed):
        q.within_deadline(spark, {"stuck": lambda: spark.range(10**13, numPartitions=2).selectExpr("sum(id * id % 7)").collect()}, 2)
    assert q.within_deadline(spark, {}, 1) == ({}, {}) and spark.range(3).count() == 3
