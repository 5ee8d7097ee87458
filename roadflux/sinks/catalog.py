"""Catalog tables over written zones."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def register(spark: SparkSession, name: str, path: str) -> None:
    """Point a catalog table at Parquet files; schema and partitions come from the files."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    location = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{location}'")
    if any(column.isPartition for column in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)


def register_all(spark: SparkSession, paths: Mapping[str, str]) -> list[str]:
    for name, path in paths.items():
        register(spark, name, path)
    return list(paths)


def described(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE {name}")


def listed(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW TABLES").select("tableName")


def sample_row(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name).limit(1)
