"""Joins to a table with one row per key, when a few keys hold much of the other side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot if it holds at least this share of the rows; so at most HOT_PARTS keys are.
HOT_PARTS = 1000


def join_by_heat(rows: DataFrame, lookup: DataFrame, key: str, weight: str) -> DataFrame:
    """Inner join of ``rows`` to ``lookup`` (one row per key, ``weight`` = its number of rows).

    Hot keys, at most ``HOT_PARTS`` of them whatever the data, are broadcast, so that their rows stay
    where they are; the others are joined by a shuffle. ``lookup`` should be a materialized table.
    """
    total = lookup.agg(F.coalesce(F.sum(weight), F.lit(0)).alias("all_rows")).collect()[0]["all_rows"]
    hot = F.col(weight) * HOT_PARTS >= F.lit(total)
    few = lookup.filter(hot).drop(weight)
    warm = rows.join(F.broadcast(few), key)
    cold = rows.join(F.broadcast(few.select(key)), key, "left_anti").join(lookup.filter(~hot).drop(weight), key)
    return warm.unionByName(cold)
