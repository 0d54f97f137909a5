"""Top N items within every group, by score histograms that bound what has to be ranked."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from alinea.workspace import materialize

#: Bits of a mask that proves distinct items: each item sets one bit, so b set bits mean at least b items.
BITS = 64
#: The largest finite double; infinite scores share the outermost bin.
_MOST = 1.7976931348623157e308


def _half(score: Column | str) -> Column:
    """Half a score as a finite double: an order that neither infinities nor differences leave."""
    c = F.col(score) if isinstance(score, str) else score
    return F.greatest(F.lit(-_MOST), F.least(F.lit(_MOST), c.cast("double"))) / 2


def _level(score: str, bins: int) -> Column:
    """The bin of a score between its group's least (``_lo``) and highest (``_hi``): higher scores never have lower bins."""
    width = F.col("_hi") - F.col("_lo")
    return F.when(width > 0, F.floor((_half(score) - F.col("_lo")) / width * bins)).otherwise(0).cast("int")


def _large_groups(rows: DataFrame, group: Sequence[str], score: str, large: int) -> DataFrame:
    """(group, _lo, _hi): the range of scores of each group of at least ``large`` rows."""
    sizes = rows.groupBy(*group).agg(F.count("*").alias("_n"), F.min(_half(score)).alias("_lo"), F.max(_half(score)).alias("_hi"))
    return materialize(sizes.filter(F.col("_n") >= large).drop("_n"), "large_groups")


def _join_bounds(rows: DataFrame, side: DataFrame, group: Sequence[str], how: str, broadcast_rows: int) -> DataFrame:
    """A join to a written table with one row per large group: broadcast up to ``broadcast_rows`` rows, beyond that by a shuffle."""
    return rows.join(F.broadcast(side) if side.count() <= broadcast_rows else side, list(group), how)


def _thresholds(binned: DataFrame, group: Sequence[str], item: str, n: int, distinct: bool) -> DataFrame:
    """For each group of ``binned`` (group, item, _level), the lowest bin that the top ``n`` distinct items need.

    Where the rows are distinct items, counts per bin are summed from the top. Else a bit mask of
    hashed items is gathered per bin (one long each), and as soon as the masks of the bins so far show
    ``n`` bits, at least ``n`` distinct items lie in them. Groups where they never do aren't listed.
    """
    bit = F.expr(f"shiftleft(1L, CAST(pmod(xxhash64({item}), {BITS}) AS INT))")
    seen = F.count("*") if distinct else F.bit_or(bit)
    hist = binned.groupBy(*group, "_level").agg(seen.alias("_seen"))
    down = F.sort_array(F.collect_list(F.struct(F.col("_level").alias("level"), F.col("_seen").alias("seen"))), asc=False)  # at most bins + 1 entries
    start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("int").alias("level"))
    both = lambda a, x: a["seen"] + x["seen"] if distinct else a["seen"].bitwiseOR(x["seen"])
    enough = lambda s: (s if distinct else F.bit_count(s)) >= n
    step = lambda a, x: F.struct(
        both(a, x).alias("seen"), F.when(a["level"].isNull() & enough(both(a, x)), x["level"]).otherwise(a["level"]).alias("level")
    )
    per_group = hist.groupBy(*group).agg(down.alias("_down"))
    return per_group.select(*group, F.aggregate("_down", start, step)["level"].alias("_least")).filter("_least is not null")


def _above_threshold(rows: DataFrame, group: Sequence[str], item: str, score: str, n: int, bins: int, large: int, broadcast_rows: int, distinct: bool) -> DataFrame:
    """``rows`` without those that can't be among the top ``n`` of their group."""
    ranges = _large_groups(rows, group, score, large)
    if ranges.isEmpty():
        return rows
    binned = _join_bounds(rows, ranges, group, "inner", broadcast_rows).select(*group, item, _level(score, bins).alias("_level"))
    bounds = materialize(_thresholds(binned, group, item, n, distinct).join(ranges, list(group)), "thresholds")
    joined = _join_bounds(rows, bounds, group, "left", broadcast_rows)
    return joined.filter(F.col("_least").isNull() | (_level(score, bins) >= F.col("_least"))).select(*rows.columns)


def top_n(
    rows: DataFrame,
    group: Sequence[str],
    item: str,
    score: str,
    n: int,
    tie: Sequence[str] = (),
    bins: int = 256,
    large: int = 2000,
    broadcast_rows: int = 50_000,
) -> DataFrame:
    """The ``n`` best distinct items of each group: (group, item, score, tie columns, place from 1).

    Rows whose group, item or score is null or NaN don't count; any other score does, infinite ones
    included. An item counts once, with its highest score and, of the rows that have it, the least
    ``tie`` columns. Equal scores go by ``tie``, ascending with nulls first, then by the item, so the
    order is total. Groups with fewer items give what they have; an empty table gives no rows; other
    columns are left out.

    1. The narrow rows are written once; histograms of each large group's scores give a safe lower
       threshold, and rows below it are dropped. Up to half of ``BITS`` items are proved by bit masks
       on the rows as they come; beyond that by exact counts, after step 2. Large groups are few (at
       most rows / ``large``) and are broadcast up to ``broadcast_rows``, beyond that joined by a shuffle.
    2. The rest is reduced to one row per group and item, spread over both, so no group is hot.
    3. Each partition keeps its own ``n`` best of a group before the final ranking per group, which
       therefore reads at most n rows per partition whatever the size of the group.
    """
    if n < 1:
        raise ValueError("n must be 1 or more")
    named = [*group, item, score]
    valid = " and ".join(f"`{c}` is not null" for c in named) + f" and not isnan(cast(`{score}` as double))"
    keep = materialize(rows.select(*named, *tie).filter(valid), "rows")
    bounds = (bins, large, broadcast_rows)
    by_masks = n <= BITS // 2
    if by_masks:
        keep = _above_threshold(keep, group, item, score, n, *bounds, distinct=False)
    first = [F.min_by(F.struct(*tie), F.struct((-F.col(score)).alias("s"), *tie)).alias("_tie")] if tie else []
    best = keep.groupBy(*group, item).agg(F.max(score).alias(score), *first)
    if tie:
        best = best.select(*named, "_tie.*")
    if not by_masks:
        best = _above_threshold(materialize(best, "best"), group, item, score, n, *bounds, distinct=True)
    order = Window.partitionBy(*group).orderBy(F.desc(score), *(F.asc(t) for t in tie), F.asc(item))
    # The filter on the row number makes Spark limit each group before the shuffle as well.
    return best.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= n)
