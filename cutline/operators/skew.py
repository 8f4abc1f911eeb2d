"""Telling very frequent keys from ordinary ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
HOT_KEYS = 1_000_000


def split_hot(rows: DataFrame, key: str, times: int = 1) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary keys, rows of keys with more than ``HOT_ROWS`` rows or None).

    One small job counts rows per key. Ordinary keys may be collected in one task afterwards;
    ``times`` says how often a row is repeated there. A NULL key counts as ordinary: callers
    treat it apart.
    """
    big = rows.groupBy(key).agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") * times > HOT_ROWS).select(key)
    found = [r[0] for r in big.limit(HOT_KEYS + 1).collect()]
    if not found:
        return rows, None
    if len(found) <= HOT_KEYS:
        big = F.broadcast(rows.sparkSession.createDataFrame([(k,) for k in found], rows.select(key).schema))
    return rows.join(big, key, "left_anti"), rows.join(big, key, "left_semi")
