"""Appends that count as a whole: a data source whose runs are committed by the driver (survey ids K2, K4, K5, K6).

``df.write.format("run_rows").mode("append").option("path", ...).option("runId", ...).save()`` writes one Parquet file a task into a folder of
its own. Only the driver, when every task has ended, writes the run's manifest, which names those files; a
reader sees files that a manifest names and nothing else. So a failed task, a killed driver and a dry run (``dryRun``) leave no row, and
files of a task's lost attempts are no rows either. A run whose id has a manifest is a replay: its files go, the first ones stay.

Nulls, empties and repeats: a run without rows has a manifest without files; rows that repeat are appended as often as they
occur; a missing column is an error of the writer's schema; run ids are letters, digits and ``-_.`` only.
"""

from __future__ import annotations

import contextlib
import json
import re
import uuid
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from registrylake.operators.shared import Files
from registrylake.sources.pages import _store


@dataclass
class _Part(WriterCommitMessage):
    name: str | None
    rows: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, options, schema):
        from pyspark.sql.pandas.types import to_arrow_schema

        self.path, self.run, self.dry = options["path"].rstrip("/"), options["runId"], str(options.get("dryRun", "false")).lower() == "true"
        if not re.fullmatch(r"[A-Za-z0-9._-]+", self.run):
            raise ValueError(f"{self.run!r} is no run id")
        self.schema = to_arrow_schema(schema)
        self.part = f"rows/{self.run}-{uuid.uuid4().hex}"

    def _at(self, name: str):
        files, root = _store(self.path)
        return files, f"{root.rstrip('/')}/{name}"

    def write(self, iterator) -> WriterCommitMessage:
        import pyarrow.parquet as pq

        name, rows, writer, sink = f"{uuid.uuid4().hex}.parquet", 0, None, None
        files, folder = self._at(self.part)
        try:
            for batch in iterator:
                if batch.num_rows:
                    if writer is None:
                        files.create_dir(folder, recursive=True)
                        sink = files.open_output_stream(f"{folder}/{name}")
                        writer = pq.ParquetWriter(sink, self.schema)
                    writer.write_table(pa.Table.from_batches([batch]).cast(self.schema))
                    rows += batch.num_rows
        finally:
            if writer is not None:
                writer.close()
                sink.close()
        return _Part(name if rows else None, rows)

    def commit(self, messages) -> None:
        from pyarrow import fs

        parts = [m for m in messages if m is not None and m.name]
        files, manifest = self._at(f"runs/{self.run}.json")
        if self.dry or files.get_file_info(manifest).type != fs.FileType.NotFound:
            self.abort(messages)
            return
        _, folder = self._at(self.part)
        named = {m.name for m in parts}
        for info in files.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
            if info.base_name not in named:  # a lost attempt's
                files.delete_file(info.path)
        body = {"run": self.run, "rows": sum(m.rows for m in parts), "files": sorted(f"{self.part}/{m.name}" for m in parts)}
        files.create_dir(manifest.rsplit("/", 1)[0], recursive=True)
        made = f"{manifest}.{uuid.uuid4().hex}.tmp"
        with files.open_output_stream(made) as out:
            out.write(json.dumps(body).encode())
        files.move(made, manifest)

    def abort(self, messages) -> None:
        files, folder = self._at(self.part)
        with contextlib.suppress(FileNotFoundError):
            files.delete_dir(folder)


class RunRows(DataSource):
    @classmethod
    def name(cls):
        return "run_rows"

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("run_rows only appends")
        return _Writer(self.options, schema)


def append_run(rows: DataFrame, path: str, run_id: str, columns: list[str] | None = None, dry_run: bool = False) -> None:
    """K2: appends ``columns`` of ``rows`` (all, if not given) as run ``run_id``; a dry run (K4) does all the work and keeps nothing."""
    rows.sparkSession.dataSource.register(RunRows)
    some = rows.select(*columns) if columns else rows
    some.write.format("run_rows").mode("append").option("path", path).option("runId", run_id).option("dryRun", str(dry_run).lower()).save()


def runs(spark: SparkSession, path: str) -> list[dict]:
    """The manifests of all committed runs, by run id: one small file each."""
    files = Files(spark, path)
    return [json.loads(files.text(f"{path}/runs/{n}")) for n in files.names(f"{path}/runs") if n.endswith(".json")]


def committed(spark: SparkSession, path: str, schema: str, run_id: str | None = None) -> DataFrame:
    """The rows of all committed runs, or of one."""
    named = [f"{path}/{f}" for r in runs(spark, path) if run_id in (None, r["run"]) for f in r["files"]]
    return spark.read.schema(schema).parquet(*named) if named else spark.createDataFrame([], schema)


def swept(spark: SparkSession, path: str) -> int:
    """Deletes what drivers that died left behind: folders that no manifest names. Not while a run is being written."""
    files = Files(spark, path)
    held = {f.split("/")[1] for r in runs(spark, path) for f in r["files"]}
    gone = [n for n in files.names(f"{path}/rows") if n not in held]
    for n in gone:
        files.delete(f"{path}/rows/{n}")
    return len(gone)
