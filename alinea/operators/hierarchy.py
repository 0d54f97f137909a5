"""Parent-child links of unknown depth: paths, depths, roots, descendants and cycles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alinea.workspace import materialize

CYCLE = "CYCLE"


def parent_links(links: DataFrame, child: str, parent: str) -> DataFrame:
    """One row (code, parent) for each code in either column; parent is null for roots.

    Repeated links count once and a null parent only counts if there is no other. If a code has
    several distinct parents, the smallest is its parent; ``further_parents`` reports the others. Rows
    without a child and a parent give nothing; a row without a child names its parent only.
    """
    both = links.select(F.col(child).alias("c"), F.col(parent).alias("p"))
    named = both.select(F.explode(F.array(F.struct(F.col("c").alias("code"), F.col("p").alias("parent")), F.struct(F.col("p").alias("code"), F.lit(None).cast("string").alias("parent")))).alias("x"))
    return named.select("x.*").filter("code is not null").groupBy("code").agg(F.min("parent").alias("parent"))


def further_parents(links: DataFrame, child: str, parent: str) -> DataFrame:
    """(code, parent, further): the links that ``parent_links`` leaves out, with the parent that it takes."""
    rows = links.select(F.col(child).alias("code"), F.col(parent).alias("further")).filter("code is not null and further is not null").distinct()
    return rows.join(parent_links(links, child, parent), "code").filter("further <> parent").select("code", "parent", "further")


def _hops(edges: DataFrame, stride: int) -> DataFrame:
    """(top, code, distance, way) for each code and its ancestors up to ``stride`` links above.

    ``way`` holds the codes below ``top`` down to ``code``. Built by doubling: log2(stride) joins.
    """
    one = edges.filter("parent is not null").select(F.col("parent").alias("top"), "code", F.lit(1).alias("distance"), F.array("code").alias("way"))
    near, reach = materialize(one, "hops"), 1
    while reach < stride:
        far = near.filter(F.col("distance") == reach).select(F.col("top").alias("mid"), "code", F.col("way").alias("low"))
        above = near.select(F.col("code").alias("mid"), "top", "distance", F.col("way").alias("high"))
        longer = far.join(above, "mid").select("top", "code", (F.col("distance") + reach).alias("distance"), F.concat("high", "low").alias("way"))
        near, reach = materialize(near.unionByName(longer), "hops"), 2 * reach
    return near


def resolve_hierarchy(links: DataFrame, child: str, parent: str, stride: int = 16) -> DataFrame:
    """(code, root_code, depth, path) for each code in either column.

    Frontier joins go down from the roots; each extends paths and depths by up to ``stride`` levels,
    so that a tree of depth d takes d / stride rounds. Each round reads the written result of the
    last one. A code has at most one parent, so no round reaches a code twice; codes that no round
    reaches are on a circle or below one: root_code CYCLE, depth -1, null path. ``path`` runs from
    the root to the code itself. An empty table gives no rows; see ``parent_links`` for nulls.
    """
    nodes = materialize(parent_links(links, child, parent), "nodes")
    hops = _hops(nodes, stride)
    found = [nodes.filter("parent is null").select("code", F.col("code").alias("root_code"), F.lit(0).alias("depth"), F.array("code").alias("path"))]
    front = found[0]
    while True:
        start = front.select(F.col("code").alias("top"), "root_code", F.col("depth").alias("above"), F.col("path").alias("head"))
        reached = start.join(hops, "top").select("code", "root_code", (F.col("above") + F.col("distance")).alias("depth"), F.concat("head", "way").alias("path"), "distance")
        reached = materialize(reached, "reached")
        found.append(reached.drop("distance"))
        front = reached.filter(F.col("distance") == stride).drop("distance")
        if front.isEmpty():
            break
    tree = found[0]
    for more in found[1:]:
        tree = tree.unionByName(more)
    unreached = nodes.join(tree.select("code"), "code", "left_anti")
    caught = unreached.select("code", F.lit(CYCLE).alias("root_code"), F.lit(-1).alias("depth"), F.lit(None).cast("array<string>").alias("path"))
    return tree.unionByName(caught)


def ancestor_pairs(tree: DataFrame) -> DataFrame:
    """(ancestor, descendant, distance) for each pair on one path, from ``resolve_hierarchy``."""
    pairs = tree.filter("depth > 0").select(F.col("code").alias("descendant"), "depth", F.posexplode(F.slice("path", 1, F.size("path") - 1)).alias("level", "ancestor"))
    return pairs.select("ancestor", "descendant", (F.col("depth") - F.col("level")).alias("distance"))
