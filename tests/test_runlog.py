import os
from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registrylake.sources import runlog

KIND = "id long, v string, m map<string,int>, at timestamp"


@pytest.fixture
def path(tmp_path):
    return f"file://{tmp_path}/log"


def files_below(path):
    return sorted(f for _, _, names in os.walk(path.removeprefix("file://")) for f in names if f.endswith(".parquet"))


def rows(spark, lo, hi):
    return spark.range(lo, hi, 1, 4).selectExpr("id", "IF(id % 3 = 0, NULL, concat('v', id)) v", "map('a', CAST(id AS INT)) m", "timestamp_seconds(id) at")


def test_runs_add_up_and_a_replay_adds_nothing(spark, path):
    runlog.append_run(rows(spark, 0, 10), path, "a")
    runlog.append_run(rows(spark, 10, 15), path, "b")
    runlog.append_run(rows(spark, 100, 200), path, "a")
    got = runlog.committed(spark, path, KIND)
    assert sorted(map(str, got.collect())) == sorted(map(str, rows(spark, 0, 15).collect()))
    assert [(r["run"], r["rows"]) for r in runlog.runs(spark, path)] == [("a", 10), ("b", 5)]
    assert runlog.committed(spark, path, KIND, "b").count() == 5 and runlog.swept(spark, path) == 0


def test_failed_tasks_and_dry_runs_leave_nothing(spark, path):
    runlog.append_run(rows(spark, 0, 3), path, "a")
    before = files_below(path)
    broken = rows(spark, 0, 100).withColumn("v", F.when(F.col("id") == 77, F.raise_error(F.lit("broken row"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="broken row"):
        runlog.append_run(broken, path, "b")
    runlog.append_run(rows(spark, 0, 100), path, "c", dry_run=True)
    # Tasks that were still running when the run was given up may leave files; no manifest names them.
    runlog.swept(spark, path)
    assert files_below(path) == before and [r["run"] for r in runlog.runs(spark, path)] == ["a"]
    runlog.append_run(rows(spark, 0, 100), path, "b")
    assert runlog.committed(spark, path, KIND).count() == 103


def test_a_killed_worker_leaves_nothing(spark, path):
    def die(batches):
        for batch in batches:
            if batch.num_rows and batch.column(0)[0].as_py() >= 50:
                os._exit(1)
            yield batch

    with pytest.raises(Exception):
        runlog.append_run(spark.range(0, 100, 1, 4).mapInArrow(die, "id long"), path, "k")
    assert runlog.runs(spark, path) == [] and runlog.committed(spark, path, "id long").count() == 0
    runlog.swept(spark, path)
    assert files_below(path) == []


def writer(path, run="a"):
    return runlog._Writer({"path": path, "runId": run}, T.StructType([T.StructField("id", T.LongType())]))


def test_lost_attempts_are_no_rows(spark, path):
    w = writer(path)
    batch = pa.RecordBatch.from_pydict({"id": pa.array([1, 2], pa.int64())})
    w.write(iter([batch]))  # an attempt whose executor is lost: the driver never gets its message
    w.commit([w.write(iter([batch])), None, w.write(iter([]))])
    assert len(files_below(path)) == 1 and runlog.committed(spark, path, "id long").count() == 2


def test_what_dead_drivers_left_is_swept(spark, path):
    batch = pa.RecordBatch.from_pydict({"id": pa.array([1], pa.int64())})
    writer(path, "dead").write(iter([batch]))
    w = writer(path, "alive")
    w.commit([w.write(iter([batch]))])
    assert runlog.committed(spark, path, "id long").count() == 1 and len(files_below(path)) == 2
    assert runlog.swept(spark, path) == 1 and len(files_below(path)) == 1


def test_empty_runs_and_refusals(spark, path):
    runlog.append_run(rows(spark, 0, 0), path, "none")
    assert runlog.runs(spark, path) == [{"run": "none", "rows": 0, "files": []}] and runlog.committed(spark, path, KIND).count() == 0
    assert runlog.committed(spark, path + "/nothing", KIND).count() == 0
    with pytest.raises(Exception, match="no run id"):
        runlog.append_run(rows(spark, 0, 1), path, "../x")
    with pytest.raises(Exception):
        runlog.append_run(rows(spark, 0, 1), path, "c", columns=["id", "absent"])
    with pytest.raises(ValueError):
        runlog.RunRows({"path": path}).writer(SimpleNamespace(), True)
