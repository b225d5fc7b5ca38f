"""Work that must not grow faster than the rows."""

from pyspark.sql import functions as F

from registrylake.functions import classify as C
from registrylake.plans.pipeline_queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_texts_beyond_the_cap_are_not_made(spark, tmp_path):
    rows = [(1, 2_000_000_000, "xx"), (2, 3, "yz"), (3, 33, "x"), (4, None, "x"), (5, 7, None), (6, 0, "x"), (7, -4, "x"), (8, 80, "xyz"), (9, 81, "xyz")]
    spark.createDataFrame(rows, "event_id long, user_id long, props string").write.parquet(str(tmp_path / "events.parquet"))
    got = {r.event_id: r.raw for r in QUERIES["bounded_raw"](spark, str(tmp_path)).collect()}
    told = lambda n: f'{{"_omitted":"result exceeded MAX_RAW_BYTES","bytes":{n},"cap":400}}'
    assert got == {1: told(8_000_000_000), 2: None, 3: None, 4: None, 5: None, 6: "", 7: "", 8: "xyzé" * 80, 9: told(405)}


def test_a_known_size_spares_the_text(spark):
    dear = F.raise_error(F.lit("made")).cast("string")
    got = spark.range(1).select(C.bounded_raw(dear, 3, F.lit(4)).alias("a"), C.bounded_raw(dear, 3, F.lit(None).cast("long")).alias("b"), C.bounded_raw(F.lit("é1"), 3).alias("c")).first()
    assert got.a == '{"_omitted":"result exceeded MAX_RAW_BYTES","bytes":4,"cap":3}' and got.b is None and got.c == "é1"


def dealt(rows):
    """Tasks that compute the rows, after Spark has put small partitions together."""
    return rows.rdd.getNumPartitions()


def test_formulae_are_dealt_to_all_partitions(spark):
    """Some kilobytes of rows, whose parsing and hashing is not the work of one task."""
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert n > 1
    assert dealt(QUERIES["formula_rows"](spark, SF)) == n


def test_rows_of_a_run_are_computed_once(spark):
    plan = QUERIES["artifact_run"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "EvalPython" not in plan and "Generate" not in plan


def test_a_history_is_not_joined_with_itself(spark):
    """Rows are dealt once; the one join is with the endpoints that a range's boundary cuts."""
    plan = QUERIES["breaking_history"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") <= 1
