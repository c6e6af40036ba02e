"""Tables written between steps, in the folder the cluster shares.

Iterative steps cut their lineage by writing a table and reading it back. The
folder is ``spark.checkpoint.dir``; only a local session may fall back on a
temporary folder, because executors on other machines could not read it.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        _local_roots[app] = tempfile.mkdtemp(prefix="pairloom-")
    return _local_roots[app]


def new_run_dir(spark: SparkSession, purpose: str) -> str:
    folder = f"{scratch_root(spark)}/pairloom-{purpose}-{uuid.uuid4().hex}"
    for scope in _scopes:
        scope.folders.append(folder)
    return folder


def file_system(spark: SparkSession, path: str):
    """The file system of a path and the path in its terms."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that this library wrote."""
    files, where = file_system(spark, path)
    files.delete(where, True)


def replace_folder(spark: SparkSession, staged: str, path: str) -> None:
    """Put the complete folder ``staged`` in the place of ``path``; what was there stays until the new one is in place."""
    files, target = file_system(spark, path)
    new, old = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (staged, f"{path.rstrip('/')}._old-{uuid.uuid4().hex}"))
    if files.exists(target) and not files.rename(target, old):
        raise OSError(f"can't replace {path}")
    if not files.rename(new, target):
        files.rename(old, target)
        raise OSError(f"can't move the written folder to {path}")
    files.delete(old, True)


@contextmanager
def scratch_scope(spark: SparkSession):
    """Collects the folders made within; ``scope.remove(keep)`` removes them but for those that ``keep`` names."""
    scope = Scope(spark)
    _scopes.append(scope)
    try:
        yield scope
    finally:
        _scopes.remove(scope)


class Scope:
    def __init__(self, spark: SparkSession) -> None:
        self._spark = spark
        self.folders: list[str] = []

    def remove(self, *keep: str) -> None:
        for folder in self.folders:
            if folder not in keep:
                remove(self._spark, folder)
        self.folders = [f for f in self.folders if f in keep]


_scopes: list[Scope] = []


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet and return the table as read back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
