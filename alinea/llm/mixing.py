"""Mixing sources to target shares of the total size, with capped repeats."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from alinea.workspace import materialize

#: Parts that the documents of one source and length are spread over by a seeded hash.
BUCKETS = 1024


def same_share(counts: np.ndarray, part: int, total: int) -> np.ndarray:
    """About ``part / total`` of each length's documents; ``counts`` goes from the longest length down.

    Shares are rounded on the counts added up from the longest length, so that lengths that occur
    once are thinned out evenly. Sizes never exceed ``part`` and lack less than the longest document.
    """
    return np.diff(np.array([0, *(int(c) * part // total for c in np.cumsum(counts))], dtype=np.int64))


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int, window: int = 1 << 15) -> np.ndarray:
    """How many documents of each length to take so that their sizes add up to ``budget`` or just below.

    Seven eighths of the budget, all but half of ``window`` at most, take the same share of every
    length, so that the choice has the lengths of the source (``same_share``). What is left is brought
    below ``window`` by whole documents, the longest that fit first; the rest is a bounded knapsack:
    the reachable sums up to it are one bit set, extended by each length's remaining count in binary
    parts, and read back from the largest sum.
    """
    order = np.argsort(-lengths, kind="stable")
    lengths, counts = lengths[order].astype(np.int64), counts[order].astype(np.int64)
    total = int((lengths * counts).sum())
    if budget >= total:
        take = counts.copy()
    else:
        take = same_share(counts, budget - min(budget // 8, window // 2), total)
        left = budget - int((lengths * take).sum())
        for i, n in enumerate(lengths):
            if left <= window:
                break
            more = min(int(counts[i] - take[i]), left // int(n))
            take[i] += more
            left -= more * int(n)
        left = min(left, budget)
        parts, sums = [], 1
        mask = (1 << (left + 1)) - 1
        layers = [sums]
        for i, n in enumerate(lengths):
            n, spare, k = int(n), int(min(counts[i] - take[i], left // int(n))), 1
            while spare > 0 and n * min(k, spare) <= left:
                k = min(k, spare)
                sums |= (sums << (n * k)) & mask
                parts.append((i, k))
                layers.append(sums)
                spare, k = spare - k, k * 2
            if sums >> left & 1:
                break
        at = sums.bit_length() - 1
        for (i, k), before in zip(reversed(parts), reversed(layers[:-1])):
            if not before >> at & 1:
                take[i] += k
                at -= k * int(lengths[i])
    out = np.empty_like(take)
    out[order] = take
    return out


def _budgets(spark_totals: DataFrame, targets: DataFrame, total: int | str) -> pd.DataFrame:
    """One row per source: supply, budget, whole repeats and rest. Sources are as few as the targets."""
    t = targets.join(spark_totals, "source", "left").toPandas()
    t["tokens"] = t["tokens"].fillna(0).astype("int64")
    t["supply"] = t["tokens"] * t["max_repeats"]
    if total == "targets":
        total = int(t["tokens"].sum())
    elif total == "no shortfall":
        has = t[(t["tokens"] > 0) & (t["target_share"] > 0)]
        total = int((has["supply"] // has["target_share"]).min()) if len(has) else 0
    t["budget"] = [int(round(total * s)) for s in t["target_share"]]
    reach = np.minimum(t["budget"], t["supply"])
    t["passes"] = [int(r // n) if n else 0 for r, n in zip(reach, t["tokens"])]
    t["rest"] = reach - t["passes"] * t["tokens"]
    return t


def plan_mixture(docs: DataFrame, targets: DataFrame, item: str, size: str, total: int | str = "targets", seed: int = 1) -> tuple[DataFrame, DataFrame]:
    """(mixture, shares): which documents are used how often, and what each source reaches.

    ``docs`` has item, source and size; ``targets`` (a small table: at most 10,000 sources) has
    source, target_share and max_repeats. The total size is a number or one of "targets", the size of
    all documents of the target sources, so that the mixture follows the input; "all", the size of
    all documents; "no shortfall", the largest at which every source that has documents can hold its
    share within max_repeats, however small the scarcest source makes it. Each source gets its share
    of the total as its budget: as many whole passes over the source as fit, then documents whose
    sizes fill the rest exactly or as nearly as their sizes allow (``fit_budget``, on the counts of documents per exact size). A source
    that can't meet its budget within max_repeats is used max_repeats times in full and its shortfall
    is reported. Within a size, documents are picked by a seeded hash of their id, then by id.

    Mixture: source, item, size, repeats (1 or more). Shares: a row per target, also for sources
    without documents. Documents of other sources, or of size 0 or null, aren't used; an empty table
    gives an empty mixture and shares of 0.
    """
    if targets.count() > 10_000:
        raise ValueError("the table of targets is too large")
    spark = docs.sparkSession
    if total == "all":  # sizes may be costly: they are worked out once
        docs = materialize(docs.select(item, "source", size), "all_sized")
        total = docs.agg(F.coalesce(F.sum(size), F.lit(0)).alias("all_sizes")).collect()[0]["all_sizes"]
    wanted = docs.filter(F.col(size) > 0).join(F.broadcast(targets.select("source")), "source", "left_semi")
    bucket = F.pmod(F.xxhash64(item, F.lit(seed)), F.lit(BUCKETS)).cast("int")
    wanted = materialize(wanted.select("source", F.col(item).alias("item"), F.col(size).cast("long").alias("size"), bucket.alias("bucket")), "sized")
    hist = materialize(wanted.groupBy("source", "size", "bucket").agg(F.count("*").alias("n")), "lengths")
    budgets = _budgets(hist.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("tokens")), targets, total)
    known = spark.createDataFrame(budgets[["source", "passes", "rest"]], "source string, passes long, rest long")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        take = fit_budget(pdf["size"].to_numpy(), pdf["n"].to_numpy(), int(pdf["rest"].iloc[0]))
        return pdf.assign(take=take)[["source", "size", "passes", "take"]]

    # A group is a source's distinct sizes with their counts, never its documents.
    per_size = hist.groupBy("source", "size").agg(F.sum("n").alias("n")).join(F.broadcast(known), "source")
    chosen = materialize(per_size.groupBy("source").applyInPandas(fit, "source string, size long, passes long, take long"), "chosen")

    # Buckets before the one where the count is reached are taken whole; only that one is ranked.
    before = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    quota = hist.withColumn("seen", F.coalesce(F.sum("n").over(before), F.lit(0))).join(chosen, ["source", "size"])
    quota = quota.select("source", "size", "bucket", "passes", F.greatest(F.lit(0), F.least(F.col("n"), F.col("take") - F.col("seen"))).alias("k"), "n")
    quota = materialize(quota.filter("k > 0 or passes > 0"), "quota")
    joined = wanted.join(quota, ["source", "size", "bucket"])
    rank = Window.partitionBy("source", "size", "bucket").orderBy(F.xxhash64("item", F.lit(seed)), "item")
    whole = joined.filter("k = 0 or k = n").withColumn("extra", F.when(F.col("k") > 0, 1).otherwise(0))
    split = joined.filter("k > 0 and k < n").withColumn("extra", F.when(F.row_number().over(rank) <= F.col("k"), 1).otherwise(0))
    mixture = whole.unionByName(split).select("source", "item", "size", (F.col("passes") + F.col("extra")).alias("repeats")).filter("repeats > 0")

    reached = chosen.join(hist.groupBy("source", "size").agg(F.sum("n").alias("n")), ["source", "size"])
    reached = reached.groupBy("source").agg(F.sum(F.col("size") * (F.col("n") * F.col("passes") + F.col("take"))).alias("reached"))
    facts = spark.createDataFrame(budgets[["source", "target_share", "max_repeats", "tokens", "budget"]], "source string, target_share double, max_repeats int, tokens long, budget long")
    shares = facts.join(F.broadcast(reached), "source", "left").withColumn("reached", F.coalesce("reached", F.lit(0)))
    all_reached = F.sum("reached").over(Window.partitionBy())  # over the few rows of the targets
    share = F.when(all_reached > 0, F.col("reached") / all_reached).otherwise(0.0)
    return mixture, shares.withColumn("actual_share", share).withColumn("shortfall", F.col("budget") - F.col("reached"))
