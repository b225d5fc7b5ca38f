"""Ordered work on keys that may hold a third of all rows: ranges first, then a summary of each key's ranges.

``ranged`` deals rows by (key, order) into ranges, so that a hot key spans many tasks; within a range a window by
(key, range) is bounded by the range. What one range must know of those before it comes from a table with one row for each
key and range, whose windows by key are as long as there are ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from registrylake.operators.shared import written_once

RANGE, RANGE_ROWS = "__rl_range", 1_000_000


def ranged(rows: DataFrame, order: list, parts: int | None = None) -> DataFrame:
    """``rows`` with the number of their range by ``order`` (key columns first) in ``RANGE``; written, since a second evaluation would cut other ranges.

    Without ``parts`` there are as many ranges as keep each at about ``RANGE_ROWS`` rows, and no fewer than shuffle partitions, so that a range does not
    grow with a hot key. Counting, sampling and writing are jobs that run when this is called.
    """
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = rows.repartitionByRange(parts or max(least, -(-rows.count() // RANGE_ROWS)), *order)
    return written_once(cut.withColumn(RANGE, F.spark_partition_id()), "ranges")


def within(keys: list, order: list):
    """The window of a key's rows in one range."""
    return W.partitionBy(*keys, RANGE).orderBy(*order)


def before(keys: list):
    """The window of a key's earlier ranges."""
    return W.partitionBy(*keys).orderBy(RANGE).rowsBetween(W.unboundedPreceding, -1)


def numbered(rows: DataFrame, order: list, name: str, parts: int | None = None) -> DataFrame:
    """``rows`` with their place (from 0) by ``order`` over all rows; counts of ranges replace a window over everything."""
    cut = ranged(rows, order, parts)
    sizes = cut.groupBy(RANGE).agg(F.count(F.lit(1)).alias("__rl_n"))
    base = sizes.select(RANGE, F.coalesce(F.sum("__rl_n").over(W.orderBy(RANGE).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__rl_base"))
    place = F.row_number().over(W.partitionBy(RANGE).orderBy(*order)) - 1 + F.col("__rl_base")
    return cut.join(base, RANGE).withColumn(name, place.cast("long")).drop(RANGE, "__rl_base")


def carried(rows: DataFrame, keys: list, order: list, value: Column, name: str, parts: int | None = None) -> DataFrame:
    """``rows`` with ``value`` of the row before (by ``order`` within ``keys``) as ``name``; NULL at a key's first row."""
    cut = ranged(rows.withColumn("__rl_v", value), [*keys, *order], parts)
    last = cut.groupBy(*keys, RANGE).agg(F.max_by(F.struct(F.col("__rl_v").alias("v")), F.struct(*order)).alias("__rl_last"))
    # The range before is the last one that holds the key.
    tails = last.select(*[F.col(k).alias(f"__rl_k_{k}") for k in keys], F.col(RANGE).alias("__rl_r"), F.lag("__rl_last").over(W.partitionBy(*keys).orderBy(RANGE)).alias("__rl_before"))
    w = within(keys, order)
    here = cut.withColumns({"__rl_lag": F.lag("__rl_v").over(w), "__rl_row": F.row_number().over(w)})
    same = [here[k].eqNullSafe(F.col(f"__rl_k_{k}")) for k in keys]
    both = here.join(tails, [*same, F.col(RANGE) == F.col("__rl_r")], "left")
    found = F.when(F.col("__rl_row") > 1, F.col("__rl_lag")).otherwise(F.col("__rl_before.v"))
    return both.withColumn(name, found).select(*rows.columns, name)
