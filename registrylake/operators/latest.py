"""Latest rows, arg-max and range semi-joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrylake.functions.text import semver


def latest_per_key(rows: DataFrame, keys: list[str], at: str, tiebreak: str) -> DataFrame:
    """The newest row of each key; equal times go to the least ``tiebreak``.

    One partial aggregation and one shuffle of its results, not of the rows: the newest (time, tiebreak)
    is a maximum, so a hot key costs one row for each task.
    """
    rest = [c for c in rows.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct(-F.unix_micros(at), F.col(tiebreak))).alias("_row")
    return rows.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(rows.columns)


def latest_with_evidence(rows: DataFrame, keys: list[str], at: str, tiebreak: str, evidence) -> DataFrame:
    """As W1 among rows with evidence, which are chosen first."""
    return latest_per_key(rows.filter(evidence), keys, at, tiebreak)


def argmax_semver(rows: DataFrame, key: str, version: str, flag: str, ordinal: str) -> DataFrame:
    """A1, A2, P20: of each key's rows the greatest version; flagged rows alone if there are any; ties keep the earliest.

    Only a strictly true flag counts. Rows without a key are left out.
    """
    rest = [c for c in rows.columns if c != key]
    flagged = F.coalesce(F.col(flag).cast("boolean"), F.lit(False))
    best = F.max_by(F.struct(*rest), F.struct(flagged, semver(F.col(version)), -F.col(ordinal))).alias("_row")
    kept = rows.filter(F.coalesce(F.col(key).cast("string"), F.lit("")) != "")
    return kept.groupBy(key).agg(best).select(key, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(rows.columns)


def watermark(rows: DataFrame, keys: list[str], at: str) -> DataFrame:
    """A3, A4: newest time of each key (of all rows without keys)."""
    return rows.groupBy(*keys).agg(F.max(at).alias("newest"))


CELLS = {"day": "INTERVAL 1 DAY", "hour": "INTERVAL 1 HOUR", "minute": "INTERVAL 1 MINUTE"}


def runs_with_rows(runs: DataFrame, events: DataFrame, at: str, cells: tuple = ("day", "minute")) -> DataFrame:
    """Finished runs whose window, both ends included, holds an event.

    Events are reduced to the first and the last of each cell of time (one row a cell, summed up before any shuffle), runs
    are spread over the cells that they touch, and an equi-join meets them. A cell's first or last event lies in the
    window, or none does, unless the window lies strictly between the two; such runs, which fit into one cell, are
    tried with the next finer cells, and against the exact times only within the finest.
    """
    open_ = runs.filter(F.col("finished_at").isNotNull())
    times = events.select(F.col(at).alias("_at")).filter(F.col("_at").isNotNull())
    found = None
    for unit in cells:
        cell = lambda c: F.date_trunc(unit, c)  # noqa: B023, E731
        ends = times.groupBy(cell(F.col("_at")).alias("_cell")).agg(F.min("_at").alias("_a"), F.max("_at").alias("_z"))
        spread = open_.withColumn("_cell", F.explode(F.sequence(cell(F.col("started_at")), cell(F.col("finished_at")), F.expr(CELLS[unit]))))
        inside = lambda t: F.col(t).between(F.col("started_at"), F.col("finished_at"))
        met = spread.join(ends, "_cell").withColumn("_in", inside("_a") | inside("_z")).filter(F.col("_in") | ((F.col("_a") < F.col("started_at")) & (F.col("finished_at") < F.col("_z"))))
        sure = met.filter("_in").select(*runs.columns).dropDuplicates(["run_id"])
        found = sure if found is None else found.unionByName(sure)
        open_ = met.filter(~F.col("_in")).select(*runs.columns).dropDuplicates(["run_id"])
    exact = times.withColumn("_cell", F.date_trunc(cells[-1], "_at"))
    last = open_.withColumn("_cell", F.date_trunc(cells[-1], "started_at"))
    same = (last["_cell"] == exact["_cell"]) & exact["_at"].between(last["started_at"], last["finished_at"])
    return found.unionByName(last.join(exact, same, "left_semi").drop("_cell"))


def latest_run_with_rows(runs: DataFrame, events: DataFrame, at: str) -> DataFrame:
    """The newest of those runs, by start and then id."""
    return runs_with_rows(runs, events, at).orderBy(F.desc("started_at"), "run_id").limit(1)


def rows_in_run(events: DataFrame, run: DataFrame, at: str) -> DataFrame:
    """Events within the window of one run; ``run`` has one row, which is all that is broadcast."""
    one = F.broadcast(run.select("run_id", F.col("started_at").alias("_a"), F.col("finished_at").alias("_b")).limit(1))
    return events.join(one, F.col(at).between(F.col("_a"), F.col("_b"))).drop("_a", "_b")
