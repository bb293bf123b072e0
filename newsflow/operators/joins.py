"""Join helpers: broadcast only behind a measured size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A dimension side above this many rows is left to AQE's runtime choice.
DEFAULT_BROADCAST_ROWS = 1_000_000


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when ``df`` provably has at most ``max_rows`` rows.

    The bound is checked with ``limit(max_rows + 1).count()`` – a cheap action
    on a dimension table that stops after ``max_rows + 1`` rows.  Above the
    bound the frame is returned unhinted: the planner keeps a shuffle join and
    AQE may still broadcast it from measured shuffle statistics.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
