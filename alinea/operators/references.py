"""References to records that do not exist: orphans by null mask, target lifetime and period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

END_OF_TIME = "9999-12-31 00:00:00"



def _live_spans(targets: DataFrame, keys: Sequence[str], loaded: str, deleted: str) -> DataFrame:
    """One row per key: when it was first loaded, and its disjoint spans of life in order of time."""
    rows = targets.select(*keys, F.col(loaded).alias("lo"), F.coalesce(F.col(deleted), F.lit(END_OF_TIME).cast(targets.schema[loaded].dataType)).alias("hi"))
    # A row that was never loaded, or deleted before it was loaded, never lived and joins no spans.
    rows = rows.withColumn("hi", F.when(F.col("hi") > F.col("lo"), F.col("hi")))
    # Repeated rows fall away by partial aggregation before the shuffle.
    spans = rows.groupBy(*keys, "lo").agg(F.max("hi").alias("hi"))
    before = Window.partitionBy(*keys).orderBy("lo").rowsBetween(Window.unboundedPreceding, -1)
    until_here = Window.partitionBy(*keys).orderBy("lo")
    isles = spans.withColumn("open", F.max("hi").over(before)).withColumn("isle", F.sum(F.when(F.col("lo") <= F.col("open"), 0).otherwise(1)).over(until_here))
    merged = isles.groupBy(*keys, "isle").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return merged.groupBy(*keys).agg(F.lit(True).alias("known"), F.min("lo").alias("first_loaded"), F.collect_list(F.when(F.col("lo") < F.col("hi"), F.struct("lo", "hi"))).alias("spans"))


def _masks(refs: DataFrame, keys: Sequence[str], match: str) -> list[tuple[int, ...]]:
    """Positions of the non-null columns, for each null mask that the match semantics compares."""
    n = len(keys)
    if match == "simple":
        return [tuple(range(n))]
    mask = sum((F.when(F.col(k).isNotNull(), 1 << i).otherwise(0) for i, k in enumerate(keys)), F.lit(0))
    seen = refs.select(mask.alias("m")).distinct().collect()  # at most 2^n rows
    return [tuple(i for i in range(n) if r["m"] >> i & 1) for r in sorted(seen) if r["m"]]


def find_orphans(
    refs: DataFrame,
    targets: DataFrame,
    keys: Sequence[tuple[str, str]],
    at: str,
    loaded: str,
    deleted: str,
    match: str = "simple",
    broken: Column | None = None,
) -> DataFrame:
    """Rows of ``refs`` whose target does not live at time ``at``, with ``kind`` and ``period``.

    ``keys`` pairs each reference column with its target column. References are grouped by which of
    their columns are null; each group is compared on its non-null columns. ``match`` is "simple"
    (a null in any column: no case), "partial" (the non-null columns must meet a target; all null:
    no case) or "full" (all null: no case; partly null: missing). ``kind`` is "missing" without a target row of
    that key, "deleted" if some target was loaded at or before ``at``, else "late". Where ``broken``
    holds, the reference has a value that no target can have, whatever its key columns hold: missing.
    A null ``at`` takes every target as live. Repeated rows count each; empty tables give no rows; a
    target row without a load time never lives, but its key isn't missing.
    """
    if match not in ("simple", "partial", "full"):
        raise ValueError(f"unknown match semantics: {match}")
    own = [a for a, _ in keys]
    flagged = refs.withColumn("_broken", F.coalesce(broken, F.lit(False)) if broken is not None else F.lit(False))
    live = flagged.filter(~F.col("_broken"))
    parts = [flagged.filter("_broken").withColumn("kind", F.lit("missing"))]
    for mask in _masks(refs, own, match):
        group = live
        for i, k in enumerate(own):
            group = group.filter(F.col(k).isNotNull() if i in mask else F.col(k).isNull())
        if match == "full" and len(mask) < len(own):
            parts.append(group.withColumn("kind", F.lit("missing")))
            continue
        on = [own[i] for i in mask]
        known = targets.select(*(F.col(keys[i][1]).alias(keys[i][0]) for i in mask), F.col(loaded).alias("_lo"), F.col(deleted).alias("_hi"))
        known = known.filter(" and ".join(f"{k} is not null" for k in on))
        parts.append(_judge(group, _live_spans(known, on, "_lo", "_hi"), on, at))
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    return found.drop("_broken").withColumn("period", F.date_format(at, "yyyy-MM"))


def _judge(group: DataFrame, spans: DataFrame, on: Sequence[str], at: str) -> DataFrame:
    # AQE splits hot reference keys on the left side of this join; each meets one row of spans.
    joined = group.join(spans, list(on), "left")
    t = F.col(at)
    lives = F.exists("spans", lambda s: (s["lo"] <= t) & (s["hi"] > t)) | t.isNull()
    kind = F.when(F.col("known").isNull(), "missing").when(lives, None).when(F.col("first_loaded") <= t, "deleted").otherwise("late")
    return joined.withColumn("kind", kind).filter("kind is not null").drop("known", "first_loaded", "spans")


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Orphans per table (column ref_table), kind and period."""
    return orphans.groupBy("ref_table", "kind", "period").agg(F.count("*").alias("orphans"))
