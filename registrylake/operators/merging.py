"""First-wins and last-wins joins, grouping, caps and unions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrylake.operators import ordered


def last_wins(rows: DataFrame, key: str, ordinal: str) -> DataFrame:
    """One row a key: the one with the greatest ordinal."""
    rest = [c for c in rows.columns if c not in (key, ordinal)]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), ordinal).alias("_r")).select(key, *[F.col(f"_r.{c}").alias(c) for c in rest])


def first_wins(rows: DataFrame, key: str, ordinal: str, attributes: list[str], gather: str) -> DataFrame:
    """Attributes of the first row of a key, and the sorted distinct values of ``gather`` over all its rows."""
    best = F.min_by(F.struct(*attributes), ordinal).alias("_r")
    out = rows.groupBy(key).agg(best, F.array_sort(F.collect_set(gather)).alias(f"{gather}_set"))
    return out.select(key, *[F.col(f"_r.{c}").alias(c) for c in attributes], f"{gather}_set")


def left_measures(rows: DataFrame, measures: DataFrame, key: str) -> DataFrame:
    """Measures beside rows; what was not measured stays NULL, never 0 (I4)."""
    return rows.join(measures, key, "left")


def measured(rows: DataFrame, value) -> DataFrame:
    """How many rows have ``value`` and how many lack it."""
    return rows.agg(F.count(value).alias("measured"), F.count_if(value.isNull()).alias("unmeasured"))


def coverage_by_query(rows: DataFrame, query: str, total: str, ordinal: str, window: int) -> DataFrame:
    """Rows fetched, last total that upstream named, and whether it lies beyond the window."""
    last = F.max_by(total, F.when(F.col(total).isNotNull(), F.col(ordinal)))
    out = rows.groupBy(query).agg(F.count(F.lit(1)).alias("fetched"), last.alias("upstream_total"))
    return out.withColumn("truncated", F.coalesce(F.col("upstream_total") > window, F.lit(False)))


def mode_of_any(first, then, first_name: str = "instant", then_name: str = "poll", rest: str = "unclassified"):
    """Aggregate: any of ``first``, else any of ``then``, else the rest."""
    any_ = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    return F.when(any_(first), first_name).when(any_(then), then_name).otherwise(rest)


def capped(rows: DataFrame, order: list, cap: int) -> tuple[DataFrame, DataFrame]:
    """The first ``cap`` rows, and a one-row table of how many were left out; the cap is the feature.

    The top ``cap`` come from per-task tops (``TakeOrderedAndProject``), not from a window over all rows.
    """
    kept = rows.orderBy(*order).limit(cap)
    left = rows.agg(F.greatest(F.count(F.lit(1)) - cap, F.lit(0)).alias("dropped"))
    return kept, left


def lookup_batches(names: DataFrame, name: str, size: int = 128, parts: int | None = None) -> DataFrame:
    """Batch number of each distinct name, ``size`` names a batch in order of the names."""
    placed = ordered.numbered(names.select(name).distinct(), [name], "batch", parts)
    return placed.withColumn("batch", F.floor(F.col("batch") / size))


def lookup_results(batches: DataFrame, name: str, responses: DataFrame) -> DataFrame:
    """(name, value) of batched lookups; ``responses``: batch, body, NULL where a call failed.

    A body is an object by name; that of a batch of one name is the value itself. Names of a failed batch, names that the
    body lacks and names that it gives as null have a NULL value: unmeasured, never zero.
    """
    sized = batches.groupBy("batch").agg(F.count(F.lit(1)).alias("n"))
    known = batches.join(sized, "batch").join(responses, "batch", "left")
    entry = F.element_at(F.from_json("body", "map<string,string>"), F.col(name))
    single = F.when(F.try_parse_json("body").isNotNull() & (F.col("body") != "null"), F.col("body"))
    return known.select(name, F.when(F.col("n") == 1, single).otherwise(entry).alias("value"))


def paged(rows: DataFrame, order: list, size: int, page: int) -> DataFrame:
    """Page ``page`` (from 0) of ``size`` rows by ``order``; a sort with limit and offset, which are the feature."""
    return rows.orderBy(*order).offset(page * size).limit(size)


def count_pair(rows: DataFrame, sentinel) -> DataFrame:
    """All rows, and those that ``sentinel`` marks, in one pass."""
    return rows.agg(F.count(F.lit(1)).alias("total"), F.count_if(sentinel).alias("marked"))


def object_of(rows: DataFrame, keys: list, name: str, value: str) -> DataFrame:
    """For each key the JSON object of names and values, in order of the names; the caller's names are unique."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(name).cast("string").alias("k"), F.col(value).alias("v"))))
    return rows.groupBy(*keys).agg(F.to_json(F.map_from_entries(pairs)).alias("object"))


def utf16_sorted(texts):
    """T4: an array of texts by UTF-16 code units, as the stored hashes have it; bytes of UTF-16BE compare as its units do."""
    keyed = F.transform(texts, lambda x: F.struct(F.encode(x, "UTF-16BE").alias("k"), x.alias("x")))
    return F.transform(F.array_sort(keyed), lambda e: e["x"])


def locale_sorted(texts):
    """T5: an array of texts by the root collation (letters before case); equal ones by their bytes."""
    keyed = F.transform(texts, lambda x: F.struct(F.collate(x, "UNICODE").alias("k"), x.alias("x")))
    return F.transform(F.array_sort(keyed), lambda e: e["x"])


def bag_union(*tables: DataFrame) -> DataFrame:
    """All rows of all tables, by column name."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def refused(rows: DataFrame, bad: Column, message: str) -> DataFrame:
    """``rows``; a job that meets one for which ``bad`` holds fails with ``message``.

    The test is a filter that also looks at the row's number, which Spark takes for an effect of its own: it neither drops the filter nor moves it
    or later ones past each other. A row is judged even if nobody asks for it afterwards. No job runs for the test alone.
    """
    judged = F.when(F.coalesce(bad, F.lit(False)), F.raise_error(F.lit(message)).cast("boolean")).otherwise(F.monotonically_increasing_id() >= 0)
    return rows.filter(judged)


def refuse_if_empty(rows: DataFrame, what: str) -> DataFrame:
    """An empty corpus is a failure, not a result; the job that reads the rows fails.

    A branch without rows counts up to one row and is part of the same plan.
    """
    seen = rows.limit(1).agg(F.count(F.lit(1)).alias("__rl_n"))
    none = refused(seen, F.col("__rl_n") == 0, f"{what}: no rows").filter(F.col("__rl_n") < 0)
    return rows.unionByName(none.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema]))
