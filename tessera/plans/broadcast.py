"""Broadcast only what has a checked size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest number of rows of a small side that we broadcast after checking.
DEFAULT_MAX_BROADCAST_ROWS = 1_000_000


def max_broadcast_rows(spark) -> int:
    v = spark.conf.get("spark.tessera.broadcast.maxRows", None)
    return int(v) if v else DEFAULT_MAX_BROADCAST_ROWS


def bounded_broadcast(df: DataFrame, bound: int | None, max_rows: int | None = None) -> DataFrame:
    """Broadcast ``df`` when a static bound on its row count is small enough.

    ``bound`` must be a proof from the plan (e.g. shards x query leaves), not
    a guess; None where there is no such proof.  Beyond the limit the frame is returned as is and the join falls
    back to a shuffle join (AQE may still pick a broadcast from runtime sizes).
    """
    limit = max_rows if max_rows is not None else max_broadcast_rows(df.sparkSession)
    return F.broadcast(df) if bound is not None and bound <= limit else df


def checked_broadcast(df: DataFrame, max_rows: int | None = None) -> tuple[DataFrame, bool]:
    """Broadcast ``df`` if it has at most ``max_rows`` rows.

    Runs one bounded job (``limit(max_rows + 1).count()``), so the check costs
    at most ``max_rows + 1`` rows however large ``df`` is.  Returns the frame
    to join and whether it is broadcast.
    """
    limit = max_rows if max_rows is not None else max_broadcast_rows(df.sparkSession)
    n = df.limit(limit + 1).count()
    if n <= limit:
        return F.broadcast(df), True
    return df, False
