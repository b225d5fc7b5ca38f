"""Run rules and bookkeeping."""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Callable

from pyspark import InheritableThread
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registrylake.operators.shared import shared_folder
from registrylake.sources.fetching import chunks

# The columns that an item upsert must be able to change.
UPDATE_COLUMNS = ["title", "state", "author", "labels", "created_at", "updated_at", "url", "fetched_at"]
STALE_HOURS = 48.0
RUN = "id string, source string, started_at timestamp, finished_at timestamp, pages_fetched long, servers_returned long, status string"
LOG = "source_slug string, started_at timestamp, completed_at timestamp, items_fetched long, items_new long, items_duplicate long, items_failed long, duration_ms long, error_message string, metadata string"


class RunFailed(RuntimeError):
    """A rule that makes a run fail."""


def new_run_id() -> str:
    """one id for a run, to be stamped on all its rows as a literal."""
    return str(uuid.uuid4())


def refuse_stale(age_hours: float | None, limit: float = STALE_HOURS) -> None:
    """No row at all counts as stale."""
    if age_hours is None or age_hours > limit:
        raise RunFailed(f"newest row is {age_hours if age_hours is not None else 'absent'} hours old, limit {limit}")


def refuse_zero_rows(rows: int, what: str) -> None:
    """A run that completed with nothing is no success."""
    if rows == 0:
        raise RunFailed(f"{what}: completed with zero rows")


def outside_vocabulary(rows: DataFrame, column: str, values: list) -> DataFrame:
    """Rows whose value is none of a closed vocabulary; NULL is outside too."""
    return rows.filter(~F.coalesce(F.col(column).isin(values), F.lit(False)))


def isolated(segments: dict[str, Callable[[], object]]) -> tuple[dict, dict]:
    """Every segment runs; (results, errors); all failing raises."""
    done, errors = {}, {}
    for name, run in segments.items():
        try:
            done[name] = run()
        except Exception as e:  # noqa: BLE001  a segment's failure is recorded, not hidden
            errors[name] = f"{type(e).__name__}: {e}"
    if segments and not done:
        raise RunFailed(f"every segment failed: {errors}")
    return done, errors


def within_deadline(spark: SparkSession, segments: dict[str, Callable[[], object]], seconds: float, grace: float = 30.0) -> tuple[dict, dict]:
    """Segments side by side, each under a job tag of its own; (results, errors).

    When time is up, the jobs of segments that still run are interrupted by their tags, and again until the segment
    ends, since it may start further ones; it is reported as late, whatever it returns. The others' results stand. All failing raises.
    """
    done, errors, late, lock = {}, {}, set(), threading.Lock()
    tags = {name: f"segment-{uuid.uuid4().hex}" for name in segments}

    def run(name: str) -> None:
        spark.addTag(tags[name])
        try:
            result = segments[name]()
            with lock:
                if name not in late:
                    done[name] = result
        except Exception as e:  # noqa: BLE001  a segment's failure is recorded, not hidden
            with lock:
                if name not in late:
                    errors[name] = f"{type(e).__name__}: {e}"
        finally:
            spark.removeTag(tags[name])

    threads = {name: InheritableThread(target=run, args=(name,), daemon=True) for name in segments}
    end = time.monotonic() + seconds
    for t in threads.values():
        t.start()
    for t in threads.values():
        t.join(max(0.0, end - time.monotonic()))
    with lock:
        for name, t in threads.items():
            if t.is_alive() and name not in done and name not in errors:
                late.add(name)
                errors[name] = f"late: not done within {seconds} seconds"
    give_up = time.monotonic() + grace
    while any(threads[n].is_alive() for n in late) and time.monotonic() < give_up:
        for name in late:
            spark.interruptTag(tags[name])
            threads[name].join(0.5)
    if segments and not done:
        raise RunFailed(f"every segment failed: {errors}")
    return done, errors


def write_access_problems(facts: dict) -> list:
    """What a role lacks. Extra columns are no problem, an absent one is."""
    problems = []
    if not facts.get("items_insert"):
        problems.append("missing INSERT on items")
    if not facts.get("items_select"):
        problems.append("missing SELECT on items")
    lacking = [c for c in UPDATE_COLUMNS if (facts.get("items_update_cols") or {}).get(c) is not True]
    if lacking:
        problems.append(f"missing column-level UPDATE on items ({', '.join(lacking)})")
    if not facts.get("transitions_insert"):
        problems.append("missing INSERT on transitions")
    return problems


def write_access_remedy(problems: list) -> str:
    return f"the role cannot write what it needs: {'; '.join(problems)}. Grant SELECT and INSERT on items, UPDATE on exactly ({', '.join(UPDATE_COLUMNS)}) and INSERT on transitions; a table-wide UPDATE would let it move rows to other keys."


def status_text(counts: dict, failed: str | None = None) -> str:
    """a run's status in words, at most 500 characters."""
    body = ", ".join(f"{k}={v}" for k, v in counts.items())
    return (f"failed: {failed}; {body}" if failed else f"completed: {body}")[:500]


def run_record(spark: SparkSession, run_id: str, source: str, started_at, finished_at, counts: dict, failed: str | None = None) -> DataFrame:
    """K5: a run's row at its end; unlike the original it names its source."""
    return spark.createDataFrame([(run_id, source, started_at, finished_at, counts.get("pages", 0), counts.get("rows", 0), status_text(counts, failed))], RUN)


def running_record(spark: SparkSession, run_id: str, source: str, started_at) -> DataFrame:
    """K5: a run's row at its start, without an end."""
    return spark.createDataFrame([(run_id, source, started_at, None, 0, 0, "running")], RUN)


def runs_of(records: DataFrame) -> DataFrame:
    """K5: one row for each run from its appended records: the finished one if there is one, else the running one."""
    rest = [c for c in records.columns if c != "id"]
    best = F.max_by(F.struct(*rest), F.coalesce(F.unix_micros("finished_at"), F.lit(-1)))
    return records.groupBy("id").agg(best.alias("r")).select("id", *[F.col(f"r.{c}").alias(c) for c in rest])


def access_facts(grants: DataFrame, role: str, items: str = "items", moves: str = "transitions") -> dict:
    """The facts that ``write_access_problems`` judges, from a table of grants (role, relation, column, privilege; column NULL for the whole relation).

    A grant on the whole relation covers its columns.
    """
    mine = grants.filter(F.col("role") == role)
    has = lambda relation, privilege, column=None: (F.col("relation") == relation) & (F.col("privilege") == privilege) & (F.col("column").isNull() if column is None else F.col("column").isNull() | (F.col("column") == column))
    any_ = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    row = mine.agg(any_(has(items, "INSERT")).alias("items_insert"), any_(has(items, "SELECT")).alias("items_select"), any_(has(moves, "INSERT")).alias("transitions_insert"), F.create_map(*[x for c in UPDATE_COLUMNS for x in (F.lit(c), any_(has(items, "UPDATE", c)))]).alias("items_update_cols")).first()
    return row.asDict()


def admitted(constraints: DataFrame, name: str, value: str) -> tuple[str | None, str | None]:
    """``value`` if the check constraint ``name`` (table: name, definition) admits it, else NULL and why; an absent constraint admits anything."""
    found = constraints.filter(F.col("name") == name).select(F.max("definition")).first()[0]
    if found is None:
        return value, f"no constraint {name}"
    if f"'{value}'" in found:
        return value, None
    return None, f"{name} does not admit {value}: {found}"


def rolled_back(spark: SparkSession, work: Callable[[str], object]):
    """K4: ``work(folder)`` may write tables below ``folder``; they are deleted whatever happens, and its result or failure is passed on."""
    folder = f"{shared_folder(spark)}/registrylake/dry-run-{uuid.uuid4().hex}"
    try:
        return work(folder)
    finally:
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def chunked(rows: list, write: Callable[[list], None], size: int = 500) -> tuple[int, int]:
    """K7: rows of a driver-side log, written ``size`` at a time; (rows written, chunks failed). A failed chunk does not stop the others."""
    done = failed = 0
    for part in chunks(rows, size):
        try:
            write(part)
            done += len(part)
        except Exception:  # noqa: BLE001  counted
            failed += 1
    return done, failed


def log_record(spark: SparkSession, source: str, started_at, completed_at, counts: dict, error: str | None = None) -> DataFrame:
    """K6: one log row with JSON metadata."""
    took = int((completed_at - started_at).total_seconds() * 1000)
    return spark.createDataFrame([(source, started_at, completed_at, *[counts.get(k, 0) for k in ("fetched", "new", "duplicate", "failed")], took, error, json.dumps(counts, sort_keys=True))], LOG)


def after_success(errors: int, refresh: Callable[[], None]) -> str | None:
    """The refresh runs only after a run without errors; its own failure is returned, the run's log stays."""
    if errors:
        return None
    try:
        refresh()
    except Exception as e:  # noqa: BLE001
        return f"{type(e).__name__}: {e}"
    return None
