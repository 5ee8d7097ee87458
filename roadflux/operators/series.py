"""Row frames over long time series.

Lag, lead and short rolling frames need a series in time order. One series may hold a large share of all rows, so every
series is cut into chunks of a fixed stretch of time, whatever its length: there is one plan for all sizes, and nothing is
counted beforehand.

Rows are shuffled once, by series and chunk. Frames of rows that lie far enough inside a chunk are complete there. The few
rows at either edge of each chunk are taken out of the same exchange, put side by side per series, and framed again there:
the edge of a chunk and that of the next are neighbours in that short series as they are in the whole one.

A chunk holds the readings of one series in ``SECONDS_PER_CHUNK``; simultaneous readings share a chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from roadflux.functions.timeparts import epoch_micros

SECONDS_PER_CHUNK = 86_400
CHUNK = "_chunk"
_EDGE, _NEAR = "_edge", "_near_edge"


def chunked(rows: DataFrame, time: str, seconds_per_chunk: float = SECONDS_PER_CHUNK) -> DataFrame:
    """Rows with the number of the stretch of time they lie in; rows without a time form one of their own."""
    return rows.withColumn(CHUNK, F.floor(epoch_micros(F.col(time)) / F.lit(seconds_per_chunk * 1_000_000)))


def framed(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    back: int,
    ahead: int,
    columns: Callable[[WindowSpec], Mapping[str, Column]],
    seconds_per_chunk: float = SECONDS_PER_CHUNK,
) -> DataFrame:
    """Rows plus ``columns(window)``, as over whole series.

    No column may look further than ``back`` rows back and ``ahead`` rows ahead. ``order`` starts with the time. The other columns of
    ``rows`` come after it, so that a row which is taken out as an edge is the same one in both readings of the exchange:
    they must have an order (no maps), and what is not needed should be dropped before.
    """
    whole_order = [*order, *[c for c in rows.columns if c not in (*keys, *order)]]
    # Shuffled by name: what the two readings add for their windows stays above the exchange, which thus is one and the same.
    placed = chunked(rows, order[0], seconds_per_chunk).repartition(*keys, CHUNK)
    inside = Window.partitionBy(*keys, CHUNK).orderBy(*whole_order)

    def within(first: int, last: int) -> Column:
        """Whether a row is one of the ``first`` or ``last`` rows of its chunk."""
        return F.lag(F.lit(1), first).over(inside).isNull() | F.lead(F.lit(1), last).over(inside).isNull()

    done = placed.withColumns({**columns(inside), _EDGE: within(back, ahead)}).filter(~F.col(_EDGE))
    # An edge row looks at rows of its own chunk as well, up to `back + ahead` of them.
    depth = back + ahead
    edges = placed.withColumns({_EDGE: within(back, ahead), _NEAR: within(depth, depth)}).filter(_NEAR)
    along = Window.partitionBy(*keys).orderBy(*whole_order)
    mended = edges.withColumns(columns(along)).filter(_EDGE)
    made = [c for c in done.columns if c not in (CHUNK, _EDGE)]
    return done.select(*made).unionByName(mended.select(*made))
