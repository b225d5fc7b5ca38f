"""Keyed tables as files of key ranges, whose versions are manifests.

A data file holds a sorted range of keys; ranges of one version are disjoint. A manifest lists a version's files with their
least and largest keys. An upsert finds the files that its keys touch, merges only those with the incoming rows, writes what
comes out as new files and puts a manifest beside the old ones: files that no incoming key touches are neither read nor written. Readers take a
version whole, since a manifest appears in one step; two writers on one version conflict, and the later one is told so.

Keys are compared as texts that sort like them (null first), so a range may begin anywhere in a composite key and a hot first
column is cut like any other. The driver holds a manifest: at most ``MOST_FILES`` entries, since a file's rows grow with the table.

Nulls, ties and repeats: null keys are keys like others; incoming rows that share a key are refused in the plan; an empty batch
makes a version with the same files; new keys have null in the columns that are not given.
"""

from __future__ import annotations

import json
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registrylake.operators import state
from registrylake.operators.shared import Files, written_once

MOST_FILES, ROWS_PER_FILE = 100_000, 4_000_000
PLACE, OWNER, KIND = "__rl_place", "__rl_owner", "__rl_kind"


class Conflict(RuntimeError):
    """Another writer has made the version that this one wanted to make."""


def sortable(column: Column, kind: T.DataType) -> Column:
    """A key as a text of ASCII characters that sorts as the key does, null first."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        number = column.cast("long")
    elif isinstance(kind, T.DateType):
        number = F.unix_date(column).cast("long")
    elif isinstance(kind, T.TimestampType):
        number = F.unix_micros(column)
    elif isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.concat(F.lit("#"), F.hex(column.cast("binary"))), F.lit("!"))
    else:
        raise ValueError(f"no key order for {kind.simpleString()}")
    return F.coalesce(F.lpad(F.hex(number.bitwiseXOR(F.lit(-(1 << 63)))), 16, "0"), F.lit("!"))


def owner_of(place: Column, starts: list) -> Column:
    """The number of the range that holds ``place``: ranges begin at ``starts``, the first one also holds what is before it."""
    from pyspark.sql.functions import pandas_udf

    bounds = np.array(starts[1:], dtype="S") if len(starts) > 1 else None

    @pandas_udf("int")
    def owner(texts: pd.Series) -> pd.Series:
        if bounds is None:
            return pd.Series(np.zeros(len(texts), np.int32))
        return pd.Series(np.searchsorted(bounds, texts.to_numpy().astype("S"), side="right").astype(np.int32))

    return owner(place)


class RangeTable:
    def __init__(self, spark: SparkSession, folder: str, schema: str, keys: list[str], rows_per_file: int = ROWS_PER_FILE):
        self.spark, self.folder, self.schema, self.keys, self.rows_per_file = spark, folder.rstrip("/"), schema, keys, rows_per_file
        self.fields = spark.createDataFrame([], schema).schema
        self.files = Files(spark, self.folder)

    # -- versions --------------------------------------------------------------------------------
    def versions(self) -> list[int]:
        return [int(n[2:10]) for n in self.files.names(f"{self.folder}/versions") if n.startswith("v=")]

    def _manifest_path(self, version: int) -> str:
        return f"{self.folder}/versions/v={version:08d}.json"

    def manifest(self, version: int | None = None) -> dict:
        """A version's files, sorted by range; version 0 is the empty table."""
        found = self.versions()
        version = version if version is not None else (found[-1] if found else 0)
        return json.loads(self.files.text(self._manifest_path(version))) if version else {"version": 0, "epoch": None, "files": []}

    def _frame(self, entries: list) -> DataFrame:
        if not entries:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.folder}/{e['path']}" for e in entries])

    def read(self, version: int | None = None) -> DataFrame:
        return self._frame(self.manifest(version)["files"])

    def place(self) -> Column:
        """The key's place in the order of the table; a space sorts before all that a part can begin with."""
        return F.concat_ws(" ", *[sortable(F.col(k), self.fields[k].dataType) for k in self.keys])

    def find(self, keys: DataFrame) -> DataFrame:
        """The rows of these keys; only files that may hold one are read."""
        files = self.manifest()["files"]
        asked = keys.select(*self.keys).distinct()
        if not files:
            return self._frame([])
        owners = asked.select(owner_of(self.place(), [e["lo"] for e in files]).alias(OWNER)).distinct().collect()  # at most one row a file
        rows = self._frame([files[r[0]] for r in owners])
        named = asked.select(*[F.col(k).alias(f"__rl_k_{k}") for k in self.keys])
        return rows.join(named, [rows[k].eqNullSafe(F.col(f"__rl_k_{k}")) for k in self.keys], "left_semi")

    # -- writing ---------------------------------------------------------------------------------
    def _commit(self, base: dict, entries: list, epoch) -> int:
        version = base["version"] + 1
        body = {"version": version, "epoch": base["epoch"] if epoch is None else epoch, "files": sorted(entries, key=lambda e: e["lo"])}
        if not self.files.put_new(self._manifest_path(version), json.dumps(body)):
            raise Conflict(f"version {version} is there already")
        return version

    def _write(self, rows: DataFrame, starts: list, n: int, total: int, counts: Observation | None = None, whole: bool = False) -> list:
        """Writes rows as files, each within one of the ranges that begin at ``starts``; returns their entries.

        Rows are dealt by ranges of (owner, key), so that a file that is given very many new keys is the work of several tasks.
        ``whole`` says that no range has more rows than a file, and keeps each in one.
        ``counts`` is observed above the exchange: the sample that cuts the ranges must not be counted.
        """
        size = max(self.rows_per_file, -(-2 * total // MOST_FILES))
        placed = rows.withColumn(PLACE, self.place()).withColumn(OWNER, owner_of(F.col(PLACE), starts))
        parts = max(1, -(-n // size))
        dealt = (placed.repartition(parts, OWNER) if whole else placed.repartitionByRange(parts, OWNER, PLACE)).sortWithinPartitions(OWNER, PLACE)
        if counts is not None:
            dealt = dealt.observe(counts, F.count_if(F.col(KIND) == "new").alias("new"), F.count_if(F.col(KIND) == "changed").alias("changed"), F.count(F.lit(1)).alias("written"))
        part = f"data/{uuid.uuid4().hex}"
        dealt.select(*self.fields.names, OWNER).write.option("maxRecordsPerFile", size).partitionBy(OWNER).parquet(f"{self.folder}/{part}")
        made = self.spark.read.schema(self.schema).parquet(f"{self.folder}/{part}").select(F.col("_metadata.file_path").alias("path"), self.place().alias(PLACE))
        found = made.groupBy("path").agg(F.min(PLACE).alias("lo"), F.max(PLACE).alias("hi"), F.count(F.lit(1)).alias("rows"))
        return [{"path": r.path[r.path.index(part) :], "lo": r.lo, "hi": r.hi, "rows": r.rows} for r in found.collect()]  # one row a file

    def upsert(self, incoming: DataFrame, update: list[str] | None = None, epoch: int | None = None) -> dict:
        """K1: merges ``incoming`` (keys and ``update``, by default all other columns) into the next version and counts what happened.

        An ``epoch`` that is not above the newest version's is a replay and changes nothing.
        """
        base = self.manifest()
        if epoch is not None and base["epoch"] is not None and epoch <= base["epoch"]:
            return {"version": base["version"], "new": 0, "changed": 0, "files_read": 0, "files_written": 0, "files_kept": len(base["files"])}
        update = [c for c in self.fields.names if c not in self.keys] if update is None else update
        missing = set(self.keys + update) - set(incoming.columns)
        if missing:
            raise ValueError(f"incoming rows lack {sorted(missing)}")
        one = incoming.groupBy(*self.keys).agg(F.any_value(F.struct(*update)).alias("__rl_r") if update else F.lit(None).alias("__rl_r"), F.count(F.lit(1)).alias("__rl_n"))
        sole = F.when(F.col("__rl_n") > 1, F.raise_error(F.lit("incoming rows share a key")).cast("int")).otherwise(0)
        starts = [e["lo"] for e in base["files"]]
        # The refusal is a column of the written table, so it cannot be pruned.
        given = one.select(*self.keys, *[F.col(f"__rl_r.{c}").cast(self.fields[c].dataType).alias(c) for c in update], sole.alias("__rl_sole"), owner_of(self.place(), starts).alias(OWNER))
        given = written_once(given, "incoming")
        owners = {r[OWNER]: r["count"] for r in given.groupBy(OWNER).count().collect()}  # at most one row a file
        touched = [e for i, e in enumerate(base["files"]) if i in owners]
        kept = [e for i, e in enumerate(base["files"]) if i not in owners]
        if not owners:
            version = self._commit(base, base["files"], epoch)
            return {"version": version, "new": 0, "changed": 0, "files_read": 0, "files_written": 0, "files_kept": len(kept)}
        stored = self._frame(touched).withColumn("__rl_old", F.lit(True))
        values = given.select(*self.keys, *update).withColumn("__rl_given", F.lit(True))
        both = state.upsert(stored.withColumn("__rl_given", F.lit(None).cast("boolean")), values, self.keys, [*update, "__rl_given"])
        kind = F.when(F.col("__rl_old").isNull(), "new").when(F.col("__rl_given"), "changed")
        n, counts = sum(e["rows"] for e in touched) + sum(owners.values()), Observation()
        made = self._write(both.withColumn(KIND, kind), starts, n, n + sum(e["rows"] for e in kept), counts)
        version = self._commit(base, kept + made, epoch)
        told = counts.get
        return {"version": version, "new": told["new"], "changed": told["changed"], "files_read": len(touched), "files_written": len(made), "files_kept": len(kept)}

    def compact(self) -> int:
        """Puts neighbouring files together as far as they fit into one; returns how many files are gone. Other files stay as they are."""
        base, runs = self.manifest(), []
        for e in base["files"]:
            if runs and sum(x["rows"] for x in runs[-1]) + e["rows"] <= self.rows_per_file:
                runs[-1].append(e)
            else:
                runs.append([e])
        small = [run for run in runs if len(run) > 1]
        if not small:
            return 0
        old = [e for run in small for e in run]
        n = sum(e["rows"] for e in old)
        made = self._write(self._frame(old), [run[0]["lo"] for run in small], n, sum(e["rows"] for e in base["files"]), whole=True)
        self._commit(base, [run[0] for run in runs if len(run) == 1] + made, None)
        return len(old) - len(made)

    def expire(self, keep: int = 1) -> int:
        """Deletes all versions but the newest ``keep`` and the files that only they hold; returns how many files."""
        found = self.versions()
        old, live = found[:-keep], found[-keep:]
        held = {e["path"] for v in live for e in self.manifest(v)["files"]}
        gone = {e["path"] for v in old for e in self.manifest(v)["files"]} - held
        for v in old:
            self.files.delete(self._manifest_path(v))
        for path in gone:
            self.files.delete(f"{self.folder}/{path}")
        return len(gone)

