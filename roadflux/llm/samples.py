"""Bounded samples that are the same in every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

MARGIN = 4


def smallest(rows: DataFrame, key: Column, most: int, total: int, *ties: str) -> DataFrame:
    """The ``most`` rows with the smallest ``key``, a 64-bit hash; ``total`` is the number of rows.

    A plain ordered limit sends that many rows of every partition to the last step. Hashes are spread evenly, so
    only those below a bound that about ``MARGIN`` times ``most`` rows pass are ordered at all.
    """
    if total > MARGIN * most:
        rows = rows.where(key < F.lit(-(1 << 63) + (1 << 64) * MARGIN * most // total))
    return rows.orderBy(key, *ties).limit(most)
