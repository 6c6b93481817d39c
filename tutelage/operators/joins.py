"""Joins that stay safe when a side or a key grows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMALL_ROWS = 10_000
HOT_KEYS = 2_000


def join_lookup(left: DataFrame, lookup: DataFrame, on: str | Sequence[str], how: str = "left",
                max_rows: int = SMALL_ROWS) -> DataFrame:
    """Join to a table that should be small (a registry, priors): fetched up to ``max_rows``, then broadcast.

    A larger one is never fetched whole: it is joined by shuffle, hot keys apart (``join_skewed``).
    """
    keys = [on] if isinstance(on, str) else list(on)
    rows = lookup.limit(max_rows + 1).collect()
    if len(rows) <= max_rows:
        return left.join(F.broadcast(lookup.sparkSession.createDataFrame(rows, lookup.schema)), keys, how)
    return join_skewed(left, lookup, keys, how)


def join_skewed(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left",
                hot_keys: int = HOT_KEYS) -> DataFrame:
    """Equi-join to a right side with unique keys, with the left's hot keys kept out of the shuffle.

    The ``hot_keys`` most frequent left keys, at most that many rows, are joined by broadcast. A key
    outside that list holds less than ``1 / hot_keys`` of the left rows, so the shuffle that
    joins the rest has no hot partition. Every left row takes exactly one of these ways.
    """
    if how not in ("left", "inner"):
        raise ValueError(how)
    keys = list(keys)
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    hot = (left.filter(known).groupBy(*keys).agg(F.count("*").alias("__n")).orderBy(F.desc("__n"), *keys).limit(hot_keys)
           .select(*keys))
    hot_right = hot.join(right, keys, how)
    by_hot = left.join(F.broadcast(hot_right), keys, "inner")
    cold = left.filter(known).join(F.broadcast(hot), keys, "left_anti").join(right, keys, how)
    parts = by_hot.unionByName(cold)
    if how == "inner":
        return parts
    # Null keys match nothing; in the shuffle they would all meet in one partition.
    missing = {f.name: F.lit(None).cast(f.dataType) for f in right.schema if f.name not in keys}
    return parts.unionByName(left.filter(~known).withColumns(missing))
