"""Keyed Parquet tables that are merged in place: readers see whole versions, a merge rewrites only what it touches.

A table is a folder. ``files/<commit>/bucket=k`` holds rows whose key hashes to bucket k; ``versions/N.json`` names, for version N,
the folder of each bucket. Files are never changed. A merge reads and writes the buckets that incoming rows fall into, all others
keep their folders; then it puts down the next version's file, which exactly one of several writers can. Who comes second
starts again from the version that is there then. A reader takes the folders of one version and is not disturbed by merges;
``vacuum`` removes what no kept version names.

The number of buckets is fixed when the table is made: choose it so that a bucket suits one task (some 100 MB). What reaches the driver
is a name per bucket.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from roadflux import workspace
from roadflux.operators.upsert import latest_rows, merge_rows

BUCKETS = 64
RETRIES = 10
BUCKET = "bucket"


class Conflict(RuntimeError):
    """Another writer has put down the version."""


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _store(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[int]:
    """The versions that can be read, ascending."""
    folder = _path(spark, f"{path}/versions")
    store = _store(spark, path)
    names = [s.getPath().getName() for s in store.listStatus(folder)] if store.exists(folder) else []
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict:
    """keys, buckets, schema and the folder of each bucket that has rows, of a version (default: the newest)."""
    if version is None:
        version = versions(spark, path)[-1]
    text = spark.read.option("wholetext", True).text(f"{path}/versions/{version}.json").first()[0]
    return json.loads(text)


def _commit(spark: SparkSession, path: str, number: int, content: dict) -> None:
    """Put the version down under its final name at once, unless it is there: a rename that never replaces."""
    workspace.make_folder(spark, f"{path}/versions")
    draft, final = _path(spark, f"{path}/versions/.{uuid.uuid4().hex}"), _path(spark, f"{path}/versions/{number}.json")
    out = _store(spark, path).create(draft)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(draft, final, gateway.new_array(rename, 0))
    except Py4JJavaError as error:
        _store(spark, path).delete(draft, False)
        if "FileAlreadyExistsException" in str(error.java_exception):
            raise Conflict(f"version {number} of {path} is there") from error
        raise


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _write_buckets(rows: DataFrame, path: str, keys: Sequence[str], buckets: int, number: int) -> dict[str, str]:
    """Write rows by bucket; returns the folder of each bucket that got any."""
    spark, made = rows.sparkSession, f"files/{number}-{uuid.uuid4().hex}"
    placed = rows.withColumn(BUCKET, _bucket(keys, buckets))
    placed.repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{path}/{made}")
    found = [s.getPath().getName() for s in _store(spark, path).listStatus(_path(spark, f"{path}/{made}"))]
    return {n.split("=")[1]: f"{made}/{n}" for n in found if n.startswith(f"{BUCKET}=")}


def create(rows: DataFrame, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> int:
    """A new table as version 0; of rows with equal keys one stays."""
    if BUCKET in rows.columns:
        raise ValueError(f"a column may not be called {BUCKET}")
    one = rows.dropDuplicates(list(keys))
    content = {"keys": list(keys), "buckets": buckets, "schema": rows.schema.jsonValue()}
    _commit(rows.sparkSession, path, 0, {**content, "folders": _write_buckets(one, path, keys, buckets, 0)})
    return 0


def read(spark: SparkSession, path: str, version: int | None = None, only: Sequence[str] | None = None) -> DataFrame:
    """The rows of a version (default: the newest), or of some of its buckets."""
    content = manifest(spark, path, version)
    schema = T.StructType.fromJson(content["schema"])
    folders = [f"{path}/{f}" for b, f in content["folders"].items() if only is None or b in only]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def merge(path: str, incoming: DataFrame, update: Sequence[str] | None = None, order: str | None = None, retries: int = RETRIES) -> int:
    """Merge rows by key, as ``operators.upsert.merge_rows`` does; returns the version that holds them.

    ``incoming`` is stored first, reduced to what takes effect: it is read more than once, and again after a conflict.
    """
    spark = incoming.sparkSession
    first = manifest(spark, path)
    keys = first["keys"]
    if order and update is None:
        incoming = latest_rows(incoming, keys, order)
    incoming = workspace.written(incoming, "merge")
    touched = [str(r[0]) for r in incoming.select(_bucket(keys, first["buckets"])).distinct().collect()]  # at most one per bucket
    for _ in range(retries):
        base = versions(spark, path)[-1]
        if not touched:
            return base
        content = manifest(spark, path, base)
        merged = merge_rows(read(spark, path, base, touched), incoming, keys, update, order)
        made = _write_buckets(merged, path, keys, content["buckets"], base + 1)
        try:
            _commit(spark, path, base + 1, {**content, "folders": {**content["folders"], **made}})
        except Conflict:
            for folder in {f.rsplit("/", 1)[0] for f in made.values()}:
                workspace.remove(spark, f"{path}/{folder}")
            continue
        return base + 1
    raise Conflict(f"{path}: no version put down in {retries} tries")


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Drop all but the newest ``keep`` versions, and the folders that none of those names. Readers of a dropped version fail, so
    keep as many as merges happen during the longest read. Not while a merge is running: its files are not named yet."""
    known = versions(spark, path)
    kept, dropped = known[-keep:], known[:-keep]
    named = {f for v in kept for f in manifest(spark, path, v)["folders"].values()}
    old = {f for v in dropped for f in manifest(spark, path, v)["folders"].values()}
    for v in dropped:
        _store(spark, path).delete(_path(spark, f"{path}/versions/{v}.json"), False)
    for folder in sorted(old - named):
        workspace.remove(spark, f"{path}/{folder}")
