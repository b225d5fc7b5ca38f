import os

from registrylake.llm import common


def local(path):
    return path.removeprefix("file://").removeprefix("file:")


def test_scratch_is_dropped_by_mark(spark):
    first, kept_before = common.written_at(spark.range(3), "a")
    mark = common.standing()
    _, gone = common.written_at(spark.range(4), "b")
    last, kept = common.written_at(spark.range(5), "c")
    common.drop_scratch(spark, mark, {kept})
    assert [os.path.exists(local(p)) for p in (kept_before, gone, kept)] == [True, False, True]
    assert first.count() == 3 and last.count() == 5 and common.standing() == mark + 1


def test_rows_come_one_at_a_time(spark):
    _, path = common.written_at(spark.range(10).repartition(3).selectExpr("id", "CAST(id AS STRING) AS s"), "rows")
    assert sorted(common.rows_at(path)) == [(i, str(i)) for i in range(10)]


def test_partitions_follow_the_bytes(spark):
    from pyspark.sql import functions as F

    df = spark.range(1000)
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert common.partitions_of(df, F.lit(10), 1 << 20) == least and common.partitions_of(df, F.lit(10), 100) == 100
    assert common.partitions_of(df.limit(0), F.lit(10), 100) == least
