import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from registrylake.operators import rangetable as rt

KIND = "k long, v string, w int"


@pytest.fixture
def table(spark, tmp_path):
    return lambda schema=KIND, keys=("k",), rows=50, name="t": rt.RangeTable(spark, f"file://{tmp_path}/{name}", schema, list(keys), rows)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_random_upserts_against_a_dictionary(spark, table):
    rng, t, want = random.Random(4), table(), {}
    for step in range(6):
        batch = {rng.choice([None, *range(-300, 300)]): (rng.choice("abc"), rng.randrange(9)) for _ in range(rng.choice([0, 1, 5, 200]))}
        given = spark.createDataFrame([(k, v, w) for k, (v, w) in batch.items()], KIND)
        told = t.upsert(given if step % 2 else given.select("k", "v"), None if step % 2 else ["v"])
        assert (told["new"], told["changed"]) == (len(batch.keys() - want.keys()), len(batch.keys() & want.keys()))
        for k, (v, w) in batch.items():
            want[k] = (v, w if step % 2 else want.get(k, (0, None))[1])
        assert rows_of(t.read()) == sorted(((k, v, w) for k, (v, w) in want.items()), key=repr)
        files = t.manifest()["files"]
        assert all(a["hi"] < b["lo"] for a, b in zip(files, files[1:])) and sum(f["rows"] for f in files) == len(want)
    assert t.versions() == list(range(1, 7))


def test_one_key_of_a_million_rewrites_one_file(spark, table):
    t = table(rows=20_000)
    t.upsert(spark.range(1_000_000).selectExpr("id k", "'a' v", "1 w"))
    before = t.manifest()["files"]
    told = t.upsert(spark.createDataFrame([(543_210, "b", 2)], KIND))
    after = t.manifest()["files"]
    assert len(before) >= 40 and (told["files_read"], told["changed"], told["new"], told["files_kept"]) == (1, 1, 0, len(before) - 1)
    assert len({f["path"] for f in before} & {f["path"] for f in after}) == len(before) - 1
    assert t.find(spark.createDataFrame([(543_210,), (7,), (-1,)], "k long")).count() == 2
    assert t.read().filter("v = 'b'").collect() == [(543_210, "b", 2)] and t.read(1).filter("v = 'b'").count() == 0


def test_find_reads_only_the_files_of_its_keys(spark, table):
    t = table(rows=100)
    t.upsert(spark.range(1000).selectExpr("id k", "'a' v", "1 w"))
    found = t.find(spark.createDataFrame([(5,), (999,)], "k long"))
    assert len(found.inputFiles()) == 2 < len(t.manifest()["files"]) and rows_of(found) == [(5, "a", 1), (999, "a", 1)]


def test_a_file_given_many_new_keys_is_the_work_of_several_tasks(spark, table):
    t = table(rows=1000)
    t.upsert(spark.range(10).selectExpr("id k", "'a' v", "1 w"))
    told = t.upsert(spark.range(100, 20_100).selectExpr("id k", "'a' v", "1 w"))
    assert told["files_read"] == 1 and told["new"] == 20_000 and told["files_written"] >= 20
    assert len({f["path"].rsplit("part-", 1)[1][:5] for f in t.manifest()["files"]}) > 5


def test_composite_keys_sort_as_columns_do(spark, table):
    kinds = "s string, d date, n int, t timestamp, v int"
    t = table(kinds, ("s", "d", "n", "t"), 3)
    rows = [(s, d, n, at, 0) for s in (None, "", "a", "ab", "b", "ä") for d in (None, date(1960, 1, 1), date(2024, 1, 1)) for n in (-5, 3) for at in (datetime(1950, 1, 1), datetime(2024, 1, 1))]
    t.upsert(spark.createDataFrame(rows, kinds))
    ordered = [tuple(r) for r in t.read().withColumn("p", t.place()).orderBy("p").drop("p").collect()]
    assert ordered == [tuple(r) for r in t.read().orderBy(*[F.asc_nulls_first(c) for c in "sdnt"]).collect()] and len(ordered) == len(rows)
    told = t.upsert(spark.createDataFrame([(None, None, 3, datetime(1950, 1, 1), 9)], kinds))
    assert (told["changed"], told["new"], told["files_read"]) == (1, 0, 1) and t.read().filter("v = 9").count() == 1
    with pytest.raises(ValueError):
        table("k double, v int", name="u").upsert(spark.createDataFrame([(1.0, 2)], "k double, v int"))


def test_shared_keys_missing_columns_and_late_writers(spark, table):
    t = table()
    with pytest.raises(Exception, match="share a key"):
        t.upsert(spark.createDataFrame([(1, "a", 1), (1, "b", 1)], KIND))
    with pytest.raises(ValueError, match="lack"):
        t.upsert(spark.createDataFrame([(1,)], "k long"))
    assert t.versions() == []
    t.upsert(spark.createDataFrame([(1, "a", 1)], KIND))
    with pytest.raises(rt.Conflict):
        t._commit({"version": 0, "epoch": None}, [], None)
    assert t.versions() == [1] and t.read().count() == 1


def test_replays_and_empty_batches(spark, table):
    t = table()
    one = spark.createDataFrame([(1, "a", 1)], KIND)
    assert t.upsert(one, epoch=0)["new"] == 1
    assert t.upsert(one.withColumn("v", F.lit("z")), epoch=0)["changed"] == 0 and t.versions() == [1]
    assert t.upsert(one.limit(0), epoch=1)["version"] == 2 and rows_of(t.read()) == [(1, "a", 1)]
    assert table(name="empty").read().count() == 0 and table(name="empty2").upsert(one.limit(0))["files_kept"] == 0


def test_expired_versions_lose_only_their_own_files(spark, table):
    t = table(rows=100)
    t.upsert(spark.range(1000).selectExpr("id k", "'a' v", "1 w"))
    for k in (5, 500):
        t.upsert(spark.createDataFrame([(k, "b", 2)], KIND))
    assert t.expire(2) == 1 and t.versions() == [2, 3] and t.read(2).filter("v = 'b'").count() == 1
    assert t.expire() == 1 and t.versions() == [3] and t.read().count() == 1000 and t.read().filter("v = 'b'").count() == 2


def test_small_neighbours_are_put_together(spark, table):
    t = table(rows=100)
    t.upsert(spark.range(0, 950, 10).selectExpr("id k", "'a' v", "1 w"))
    t.rows_per_file = 4
    t.upsert(spark.range(1, 950, 10).selectExpr("id k", "'a' v", "1 w"))
    rows, n = rows_of(t.read()), len(t.manifest()["files"])
    t.rows_per_file = 60
    assert t.compact() == n - len(t.manifest()["files"]) > n // 2 and rows_of(t.read()) == rows
    files = t.manifest()["files"]
    assert all(a["hi"] < b["lo"] for a, b in zip(files, files[1:])) and t.compact() == 0
