"""Counts and coverage that the pipeline reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alinea.functions.text import round_at


def group_sizes(df: DataFrame, key: str) -> DataFrame:
    """One row: number of groups, and mean, median, least and most rows per group."""
    sizes = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    return sizes.agg(F.count("*").alias("groups"), round_at(F.avg("n"), 4).alias("mean_size"), F.median("n").alias("median_size"), F.min("n").alias("min_size"), F.max("n").alias("max_size"))


def coverage(all_keys: DataFrame, covered: DataFrame, key: str) -> DataFrame:
    """One row: distinct keys, how many are covered, and the percentage (null without keys)."""
    marked = all_keys.select(key).distinct().join(covered.select(key).distinct().withColumn("hit", F.lit(1)), key, "left")
    n, hits = F.count("*"), F.count("hit")
    return marked.agg(n.alias("total"), hits.alias("covered"), F.when(n > 0, round_at(100.0 * hits / n, 1)).alias("pct"))
