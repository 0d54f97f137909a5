"""Weighted Jaccard scores of set against set, with ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alinea.functions.text import round_at

#: Tiers and their weights in tenths, so that sums are whole numbers in any order.
TIER_TENTHS = {"merge": 10, "link_regional": 7, "link": 5, "none": 0}


def tier_tenths(tier: Column) -> Column:
    out = F.lit(0)
    for name, w in TIER_TENTHS.items():
        out = F.when(tier == name, w).otherwise(out)
    return out


def last_per_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row of the highest ``order`` per key; one aggregation whose state is one row per key."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("x")).select(*keys, "x.*")


def first_per_key(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row of the lowest ``order`` per key."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("x")).select(*keys, "x.*")


def weighted_jaccard(left: DataFrame, matches: DataFrame, right: DataFrame) -> DataFrame:
    """Score W / (|H| + |S| - W) for each left and right set that share weight.

    ``left`` has left_id, element; ``matches`` has element, target, tier and ord; ``right`` has
    right_id, target and ord. Repeated elements count each, and a repeated element or target of a
    lookup counts by its last row in ``ord``. W sums the tiers' weights; pairs without weight give no
    row, but their rows count as ``n_none`` where the pair has weight from others. Null keys never match.
    """
    n_left = left.groupBy("left_id").agg(F.count("*").cast("int").alias("n_left"))
    n_right = right.groupBy("right_id").agg(F.count("*").cast("int").alias("n_right"))
    by_element = last_per_key(matches.filter("element is not null").select("element", "target", "tier", "ord"), ["element"], "ord").drop("ord")
    by_target = last_per_key(right.filter("target is not null").select("target", "right_id", "ord"), ["target"], "ord").drop("ord")
    pairs = left.join(by_element, "element").join(by_target, "target").withColumn("tenths", tier_tenths(F.col("tier")))
    tiers = [F.count_if(F.col("tier") == t).cast("int").alias(f"n_{t}") for t in TIER_TENTHS]
    scored = pairs.groupBy("left_id", "right_id").agg(F.sum("tenths").alias("tenths"), *tiers).filter("tenths > 0")
    scored = scored.join(n_left, "left_id").join(n_right, "right_id")
    denominator = (F.col("n_left") + F.col("n_right")) * 10 - F.col("tenths")
    score = F.when(denominator > 0, round_at(F.col("tenths") / denominator, 6)).otherwise(0.0)
    return scored.withColumn("score", score).drop("tenths")


def rank_top(scored: DataFrame, group: str, score: str, tie: str, n: int) -> DataFrame:
    """The ``n`` best rows per group with their rank; Spark limits groups before the shuffle too."""
    w = Window.partitionBy(group).orderBy(F.desc(score), F.asc(tie))
    return scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def blended_best(matches: DataFrame, group: str, item: str, yes: str, total: str, similarity: str) -> DataFrame:
    """The best item per group by 0.7 * yes / total + 0.3 * similarity, ties by item."""
    blend = round_at(0.7 * F.col(yes) / F.nullif(F.col(total), F.lit(0)) + 0.3 * F.col(similarity), 6)
    scored = matches.withColumn("blend", blend).filter("blend is not null")
    return rank_top(scored, group, "blend", item, 1).drop("rank")
