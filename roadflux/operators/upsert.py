"""Keyed merge of new rows into a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def merge_rows(
    current: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | None = None,
    order: str | None = None,
) -> DataFrame:
    """Insert rows with new keys, update rows with known ones.

    ``update`` names the columns a key clash overwrites; ``None`` replaces the
    whole row. Several incoming rows per key apply in ``order``. One grouped
    aggregate with map-side combining: repeated keys collapse before the
    shuffle, so a key that dominates the input costs no more than any other.
    """
    columns = current.columns
    values = [c for c in columns if c not in keys]
    changed = set(values if update is None else update)

    # Stored rows come first; incoming rows follow in their own order.
    position = F.col(order) if order else F.lit(None)
    stored = current.select(*columns, F.struct(F.lit(0).alias("late"), F.lit(None).cast(_type(incoming, order)).alias("at")).alias("_seq"))
    fresh = incoming.select(*columns, F.struct(F.lit(1).alias("late"), position.cast(_type(incoming, order)).alias("at")).alias("_seq"))

    row = F.struct(*values)
    merged = stored.unionByName(fresh).groupBy(*keys).agg(
        F.min_by(row, "_seq").alias("_first"), F.max_by(row, "_seq").alias("_last")
    )
    picked = {c: F.col(f"_last.{c}" if c in changed else f"_first.{c}").alias(c) for c in values}
    return merged.select([picked.get(c, F.col(c)) for c in columns])


def _type(frame: DataFrame, column: str | None):
    return frame.schema[column].dataType if column else "int"


def latest_rows(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Last row per key; also what a replay of change rows boils down to."""
    values = [c for c in rows.columns if c not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col(order)).alias("_row"))
    return last.select(*keys, "_row.*").select(*rows.columns)
