"""Ranks over few, large groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

BANDS = 256  # about as many tasks can share the values of one group


def banded(values: DataFrame, bands: int = BANDS) -> DataFrame:
    """Distinct ``_v`` per ``_g`` with ``_b``, the band of the value: higher values, higher bands; NULL has none.

    The cuts are approximate quantiles of each group, sketched per task and merged, so bands are about equally full wherever the
    values lie. Their accuracy decides the size of bands only.
    """
    shares = [n / bands for n in range(1, bands)]
    cuts = values.groupBy(F.col("_g").alias("_of")).agg(F.percentile_approx("_v", shares, 20 * bands).alias("_cuts"))
    below = F.size(F.filter("_cuts", lambda c: c < F.col("_v")))
    return values.join(cuts, F.col("_g").eqNullSafe(F.col("_of"))).select("_g", "_v", F.when(F.col("_v").isNotNull(), below).alias("_b"))


def dense_rank_desc(rows: DataFrame, group: str, value: str, out: str = "rank", bands: int = BANDS) -> DataFrame:
    """Dense rank of ``value`` inside ``group``, highest first, NULL last.

    A dense rank depends on the distinct values only, so those are ranked: rows that share a value, or have none, count
    once. A group may still hold most of the distinct values; it is split into value bands, each ranked on its own, and the
    number of values in higher bands, a table of groups times bands, is the offset. The ranks go back to the rows by a join,
    whose hot values adaptive execution splits.
    """
    values = banded(rows.select(F.col(group).alias("_g"), F.col(value).alias("_v")).distinct(), bands)
    local = values.withColumn("_in_band", F.dense_rank().over(Window.partitionBy("_g", "_b").orderBy(F.desc("_v"))))
    above = Window.partitionBy("_og").orderBy(F.desc_nulls_last("_ob")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        values.groupBy(F.col("_g").alias("_og"), F.col("_b").alias("_ob"))
        .agg(F.count("*").alias("_n"))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(above), F.lit(0)))
    )
    ranks = local.join(offsets, F.col("_g").eqNullSafe(F.col("_og")) & F.col("_b").eqNullSafe(F.col("_ob"))).select(
        "_g", "_v", (F.col("_in_band") + F.col("_offset")).cast("int").alias("_rank"))
    same = F.col(group).eqNullSafe(F.col("_g")) & F.col(value).eqNullSafe(F.col("_v"))
    return rows.join(ranks, same, "left").select(*rows.columns, F.col("_rank").alias(out))
