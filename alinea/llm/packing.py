"""Filling containers of fixed capacity by sum-of-squares packing."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alinea.workspace import materialize


def sum_of_squares(sizes: Sequence[int], capacity: int) -> list[int]:
    """The container of each item: where the squared counts of open containers per gap become smallest.

    With N(g) open containers of gap g, an item of size s goes into the gap g for which the sum of
    N(g)^2 is smallest afterwards; opening a container is the gap ``capacity``, and full containers
    don't count. On ties the smallest gap is taken, so a perfect fit comes before others. Sizes are
    from 1 to ``capacity``.
    """
    count = np.zeros(capacity + 1, dtype=np.int64)  # N(g); N(0) and N(capacity) stay 0
    open_at: dict[int, list[int]] = {}
    place, made = [], 0
    for s in sizes:
        s = int(s)
        # Change of the sum for each gap g = s .. capacity: leaving g gives 1 - 2 N(g), entering g - s gives 1 + 2 N(g - s).
        before, after = count[s:], count[: capacity - s + 1]
        change = (1 - 2 * before) + (1 + 2 * after)
        change[before == 0] = np.iinfo(np.int64).max
        if s <= capacity:
            change[0] -= 1 if before[0] else 0  # a container that becomes full leaves the sum
            change[-1] = 1 + 2 * after[-1] if s < capacity else 0  # a new container
        g = s + int(change.argmin())
        if g == capacity:
            bin_no, made = made, made + 1
        else:
            bin_no = open_at[g].pop()
            count[g] -= 1
        place.append(bin_no)
        if g > s:
            count[g - s] += 1
            open_at.setdefault(g - s, []).append(bin_no)
    return place


def pack(items: DataFrame, item: str, size: str, capacities: dict[str, int], per_shard: int = 20_000, seed: int = 1) -> DataFrame:
    """Put items into containers of each capacity: (capacity_name, item, piece, size, container, fill).

    Items are spread over shards of about ``per_shard`` by a hash of their id; each shard is one task
    that packs its items by the sum of squares, in decreasing order of size, then of hash and id. Its
    state is one count per gap and the shard's list of ids and sizes, never texts. A shard leaves a
    few containers open, which is little next to the thousands it fills: against one shard for all,
    shards of 20,000 texts cost less than one container each (README).

    Only an item larger than the capacity is split: into pieces that fill whole containers, numbered
    from 0, and a rest that is packed like an item. An item of size 0 or null takes no room: container
    null, fill 0. Items with the same id and size are different items if they are different rows. An
    empty table gives no rows.
    """
    sizes = items.select(F.col(item).alias("item"), F.coalesce(F.col(size), F.lit(0)).cast("int").alias("size"))
    sizes = materialize(sizes, "sizes")
    shards = max(1, -(-sizes.count() // per_shard))
    names = F.array(*(F.struct(F.lit(n).alias("capacity_name"), F.lit(c).alias("capacity")) for n, c in sorted(capacities.items())))
    each = sizes.withColumn("hash", F.xxhash64("item", F.lit(seed))).select("*", F.explode(names).alias("x")).select("item", "size", "hash", "x.*")
    kind = dict(items.dtypes)[item]
    schema = f"capacity_name string, item {kind}, piece int, size int, container string, fill int"

    def shard(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        name, no = key
        capacity = int(pdf["capacity"].iloc[0])
        pdf = pdf.sort_values(["hash", "item"], kind="stable")
        whole, rest = pdf["size"].to_numpy() // capacity, pdf["size"].to_numpy() % capacity
        ids = pdf["item"].to_numpy()
        rows = []
        if whole.any():
            n = np.repeat(np.arange(len(pdf)), whole)
            piece = np.arange(len(n)) - np.repeat(np.cumsum(whole) - whole, whole)
            rows.append(pd.DataFrame({"item": ids[n], "piece": piece, "size": capacity, "container": [f"{name}-{no}-w{k}" for k in range(len(n))], "fill": capacity}))
        left = np.flatnonzero(rest)
        left = left[np.argsort(-rest[left], kind="stable")]
        bins = np.array(sum_of_squares(rest[left], capacity), dtype=np.int64)
        fills = np.bincount(bins, weights=rest[left]).astype(np.int64) if len(bins) else np.zeros(0, np.int64)
        rows.append(pd.DataFrame({"item": ids[left], "piece": whole[left], "size": rest[left], "container": [f"{name}-{no}-{b}" for b in bins], "fill": fills[bins] if len(bins) else []}))
        return pd.concat(rows).assign(capacity_name=name)[["capacity_name", "item", "piece", "size", "container", "fill"]]

    filled = each.filter("size > 0").withColumn("shard", F.pmod("hash", F.lit(shards)).cast("int")).groupBy("capacity_name", "shard").applyInPandas(shard, schema)
    empty = each.filter("size <= 0").select("capacity_name", "item", F.lit(0).alias("piece"), F.lit(0).alias("size"), F.lit(None).cast("string").alias("container"), F.lit(0).alias("fill"))
    return filled.unionByName(empty)
