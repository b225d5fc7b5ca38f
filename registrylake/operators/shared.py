"""Tables written to the folder that the driver and all executors share, and files of that store."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}
#: Scratch paths of this driver that still stand.
_STANDING: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only a ``local`` session may go without it, and gets a temporary folder."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master or ""
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        made = tempfile.mkdtemp(prefix="registrylake-tables-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        _OWN[app] = f"file://{made}"
    return _OWN[app]


def scratch(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nobody else uses; it is deleted when the driver ends, if not before."""
    path = f"{shared_folder(spark)}/registrylake/{name}-{uuid.uuid4().hex}"
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


def written_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table: whatever reads it sees one evaluation, also where that depends on sampling or partition numbers."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Files:
    """The few file operations that the driver needs on a store that Spark can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.gateway = spark.sparkContext._gateway
        self.fs = self._path(root).getFileSystem(self.conf)

    def _path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def names(self, folder: str) -> list[str]:
        """The names in a folder, sorted; none if it does not exist."""
        if not self.fs.exists(self._path(folder)):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self._path(folder)))

    def text(self, path: str) -> str:
        stream = self.fs.open(self._path(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put_new(self, path: str, text: str) -> bool:
        """Writes a file whole or not at all; false, and nothing written, if it is there already."""
        made = f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
        stream = self.fs.create(self._path(made), False)
        try:
            self.jvm.org.apache.commons.io.IOUtils.write(text, stream, "UTF-8")
        finally:
            stream.close()
        rename = self.gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path(made).toUri(), self.conf).rename(self._path(made), self._path(path), rename)
        except Exception:
            if not self.fs.exists(self._path(path)):
                raise
            self.fs.delete(self._path(made), False)
            return False
        return True

    def delete(self, path: str) -> None:
        self.fs.delete(self._path(path), True)
