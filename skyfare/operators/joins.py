"""Join helpers: broadcast only sides whose size is bounded and checked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unhinted(df: DataFrame) -> DataFrame:
    """The default hint of every lookup join: none.  Spark chooses by its size
    estimates; callers that counted a side pass ``F.broadcast`` instead."""
    return df


def bounded_broadcast(df: DataFrame, rows: int | None, max_rows: int) -> DataFrame:
    """Hint a broadcast when the side's row count is known to be <= max_rows.

    ``rows`` must be a proven bound (a counted, materialised dimension or a
    bound that follows from its construction).  Unknown or larger sides are
    returned unhinted and Spark joins them by shuffle (AQE may still switch
    to a broadcast at run time from measured shuffle sizes).
    """
    if rows is not None and rows <= max_rows:
        return F.broadcast(df)
    return df
