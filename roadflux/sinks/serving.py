"""Serving tables: narrow types at the edge, whole-table or keyed writes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from roadflux.operators.upsert import merge_rows
from roadflux.schema import SERVING


def for_serving(rows: DataFrame, table: str) -> DataFrame:
    """Columns and types of a serving table; other columns are left out."""
    return rows.select([F.col(name).cast(kind).alias(name) for name, kind in SERVING[table].items()])


def jdbc_options(url: str, table: str, properties: Mapping[str, str] | None = None) -> dict[str, str]:
    return {"url": url, "dbtable": table, **(properties or {})}


def write_jdbc(
    rows: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None, writers: int = 8
) -> None:
    """Replace a database table. At most ``writers`` connections are open at once; the work before the write keeps its own tasks."""
    options = jdbc_options(url, table, properties)
    rows.repartition(writers).write.format("jdbc").options(**options).mode("overwrite").save()


def merge_table(
    spark, path: str, target: str, incoming: DataFrame, keys: Sequence[str],
    update: Sequence[str] | None = None, order: str | None = None,
) -> DataFrame:
    """Merge into the Parquet table at ``path``, writing the result to ``target``.

    The old version stays readable until the caller switches over.
    """
    merged = merge_rows(spark.read.parquet(path), incoming, keys, update, order)
    merged.write.mode("errorifexists").parquet(target)
    return spark.read.parquet(target)
