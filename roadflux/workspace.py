"""Where intermediate tables and stream checkpoints go.

On a cluster every executor must see the folder, so it comes from
``spark.checkpoint.dir``. Only a local master may fall back to a folder of
its own.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


_local_root: str | None = None


def shared_root(spark: SparkSession) -> str:
    global _local_root
    root = spark.conf.get(SETTING, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder that all executors can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="run-")
    return _local_root


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path nothing has been written to yet."""
    path = f"{shared_root(spark)}/roadflux/{label}-{uuid.uuid4().hex}"
    for made in _scratch:
        made.append(path)
    return path


_scratch: list[list[str]] = []


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """For a job: removes the intermediates made inside when it ends. Results must be elsewhere by then."""
    made: list[str] = []
    _scratch.append(made)
    try:
        yield
    finally:
        _scratch.remove(made)
        for path in made:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it is; nothing happens if it is not there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def make_folder(spark: SparkSession, path: str) -> None:
    """Make a folder in whatever store it is, unless it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(target)


def finished(spark: SparkSession, folder: str, name: str) -> list[int]:
    """The numbers N of the finished folders ``name=N`` in a folder, ascending; what reaches the driver is their names."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(path(folder)):
        return []
    names = [s.getPath().getName() for s in store.listStatus(path(folder))]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{name}=") and store.exists(path(f"{folder}/{n}/_SUCCESS")))


def folders(spark: SparkSession, pattern: str, values: set[str]) -> list[str]:
    """The folders of a pattern that ends in ``name=*`` whose value is among ``values``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return [s.getPath().toString() for s in found if s.getPath().getName().split("=", 1)[1] in values]


def written(rows: DataFrame, label: str) -> DataFrame:
    """The same rows read back from a table in the shared folder.

    Used where several jobs read one expensive result: it is computed once, and
    a lost executor costs a re-read, not a recomputation.
    """
    spark = rows.sparkSession
    path = fresh_path(spark, label)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
