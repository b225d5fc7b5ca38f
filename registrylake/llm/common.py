"""Shared folders, tables that cut lineage, and small helpers of the training-data operators."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir`` of the session.

    Only a session with a ``local`` master may go without it; it then gets a temporary folder of its
    own. A cluster without the setting is refused, since a machine-local folder would lose data.
    """
    conf = spark.sparkContext.getConf()
    root = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_ROOTS:
        made = tempfile.mkdtemp(prefix="registrylake-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(f"file://{made}")
        _OWN_ROOTS[app] = f"file://{made}"
    return _OWN_ROOTS[app]


#: Scratch paths of this driver that still stand, oldest first.
_STANDING: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nobody else uses; it is deleted when the driver ends, if not before."""
    path = f"{shared_root(spark)}/registrylake/{name}-{uuid.uuid4().hex}"
    if not _STANDING:
        atexit.unregister(_drop_all)
        atexit.register(_drop_all)
    _STANDING.append(path)
    return path


def _drop_all() -> None:
    """Deletes what stands when the driver ends; without a session, and without complaint if the store is gone."""
    from pyarrow import fs

    for path in _STANDING:
        with contextlib.suppress(Exception):
            store, folder = fs.FileSystem.from_uri(path)
            store.delete_dir(folder)
    _STANDING.clear()


def standing() -> int:
    """How many scratch paths stand; what comes later can be dropped by ``drop_scratch`` from this mark on."""
    return len(_STANDING)


def drop_scratch(spark: SparkSession, since: int, keep: set) -> None:
    """Deletes the scratch paths made since the mark, but for those in ``keep``; no DataFrame that is still to run may read them."""
    for path in [p for p in _STANDING[since:] if p not in keep]:
        drop_path(spark, path)


def written(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, safe from lost executors."""
    return written_at(df, name, partition_by)[0]


def written_at(df: DataFrame, name: str, partition_by: list[str] | None = None) -> tuple[DataFrame, str]:
    """As ``written``, and the table's path."""
    spark = df.sparkSession
    path = scratch(spark, name)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def rows_at(path: str):
    """The rows of a table written by ``written_at``, one at a time as tuples: for tasks that go through a whole side table block by block."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    store, folder = fs.FileSystem.from_uri(path)
    for info in sorted(store.get_file_info(fs.FileSelector(folder)), key=lambda i: i.path):
        if info.path.endswith(".parquet"):
            with store.open_input_file(info.path) as f:
                for batch in pq.ParquetFile(f).iter_batches(batch_size=1):
                    yield from zip(*(c.to_pylist() for c in batch.columns))


def drop_path(spark: SparkSession, path: str) -> None:
    """Deletes a scratch path that no live DataFrame reads any more."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    if path in _STANDING:
        _STANDING.remove(path)


def partitions_of(df: DataFrame, size, target: int) -> int:
    """How many partitions of about ``target`` bytes hold ``df``, whose rows have ``size`` bytes: at least the session's shuffle partitions."""
    total = df.agg(F.sum(size)).first()[0] or 0
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-int(total) // target))


def lower_ascii(column) -> object:
    """A-Z to a-z and nothing else (``lower`` would change other scripts too)."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
