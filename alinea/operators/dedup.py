"""Duplicates: by key, by widest grade, and by string similarity inside groups."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alinea.functions.grammar import grade_width
from alinea.operators.scoring import first_per_key
from alinea.workspace import materialize


def keep_first(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row per key in the order of ``order``, which has to be unique; a null key is a key."""
    return first_per_key(df, keys, order)


def widest_grade(df: DataFrame, keys: list[str], grade: str, order: str) -> DataFrame:
    """Per key the row whose grade label lists most years, then the first in ``order``."""
    rest = [c for c in df.columns if c not in keys]
    best = F.struct(-grade_width(F.col(grade)), F.col(order))
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), best).alias("x")).select(*keys, "x.*")


def similar(new: str, kept: str, least: float) -> bool:
    """True if the matching-blocks ratio of the two is above ``least``; cheap bounds come first."""
    if 2 * min(len(new), len(kept)) <= least * (len(new) + len(kept)):
        return False
    m = SequenceMatcher(None, new, kept)
    return m.real_quick_ratio() > least and m.quick_ratio() > least and m.ratio() > least


def greedy_near_duplicates(df: DataFrame, group: str, text: str, order: str, least: float = 0.82, protected: str | None = None, block: int = 2000) -> DataFrame:
    """``df`` without rows whose text is too similar to one kept before it in the same group.

    Rows go in the order of ``order``; where ``protected`` (a boolean column) holds they are kept
    first, whatever they resemble. Texts are compared in lower case without outer blanks; null texts
    count as empty, and the two empty texts of a group are equal. Exact copies are folded first.

    Which text survives depends on those before it. Groups of up to ``block`` different texts are
    walked through in order, many to a task. Larger ones are spread over blocks of about that size:
    every two blocks meet in a task of bounded size that gives the similar pairs, and the order is
    settled on these by rounds of joins (``_settle``), so that no task holds a whole large group.
    """
    low = F.lower(F.trim(F.coalesce(F.col(text), F.lit(""))))
    guard = F.col(protected) if protected else F.lit(False)
    rows = df.withColumn("_text", low).withColumn("_guard", F.coalesce(guard, F.lit(False))).withColumn("_id", F.unhex(F.md5("_text")))
    firsts = rows.groupBy(group, "_id").agg(F.first("_text").alias("_text"), F.min(F.when(~F.col("_guard"), F.col(order))).alias("_first"), F.max("_guard").alias("_any_guard"))
    firsts = materialize(firsts.withColumnRenamed(group, "_group"), "texts")
    sizes = firsts.groupBy("_group").agg(F.count("*").alias("_n")).filter(F.col("_n") > block).withColumn("_blocks", F.ceil(F.col("_n") / block).cast("int"))
    sizes = materialize(sizes.drop("_n"), "large_groups")
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    small = firsts.alias("t").join(sizes.alias("s"), same("t._group", "s._group"), "left_anti")
    judged = _walk(small, least)
    if not sizes.isEmpty():
        large = firsts.alias("t").join(sizes.alias("s"), same("t._group", "s._group")).select("t.*", "s._blocks")
        judged = judged.unionByName(_settle(large, _similar_pairs(large, least)))
    judged = materialize(judged, "judged")
    joined = rows.alias("a").join(judged.alias("j"), same("a." + group, "j._group") & (F.col("a._id") == F.col("j._id")))
    kept = joined.filter(F.col("a._guard") | (F.col("j._keep") & (F.col("a." + order) == F.col("j._first"))))
    return kept.select(*(F.col("a." + c) for c in df.columns))


def _walk(texts: DataFrame, least: float) -> DataFrame:
    """(_group, _id, _first, _keep) of groups that lie behind each other in one partition."""
    schema = texts.select("_group", "_id", "_first").withColumn("_keep", F.lit(True)).schema

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, kept = object(), []
        for pdf in batches:
            keep = []
            for g, t, guarded in zip(pdf["_group"], pdf["_text"], pdf["_any_guard"]):
                g = None if g is None or g != g else g
                if g != current:
                    current, kept = g, []
                fresh = not guarded and not any(similar(t, k, least) for k in kept)
                keep.append(fresh)
                if fresh or guarded:
                    kept.append(t)
            yield pdf[["_group", "_id", "_first"]].assign(_keep=keep)

    ordered = texts.repartition("_group").sortWithinPartitions("_group", F.desc("_any_guard"), "_first")
    return ordered.select("_group", "_id", "_first", "_text", "_any_guard").mapInPandas(walk, schema)


def _similar_pairs(texts: DataFrame, least: float) -> DataFrame:
    """(_group, later, earlier): ids of similar texts of one group, by blocks against blocks."""
    own = texts.withColumn("_b", F.pmod(F.hash("_id"), F.col("_blocks")))
    pairs = own.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).withColumns({"_i": F.least("_b", "_o"), "_j": F.greatest("_b", "_o")})
    kind = dict(texts.dtypes)["_group"]

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_any_guard", "_first"], ascending=[False, True], kind="stable").reset_index(drop=True)
        words, one = pdf["_text"].tolist(), pdf["_i"].iloc[0] == pdf["_j"].iloc[0]
        size = np.array([len(t) for t in words])
        # Shared signs bound the ratio from above; signs that fall together only raise the bound.
        signs = np.stack([np.bincount(np.frombuffer(t.encode("utf-32-le"), np.uint32) % 128, minlength=128) for t in words]).astype(np.int32)
        later, earlier = [], []
        for k in range(1, len(words)):
            if pdf["_any_guard"][k]:
                continue
            may = 2 * np.minimum(signs[:k], signs[k]).sum(axis=1) > least * (size[:k] + size[k])
            if not one:
                may &= (pdf["_b"][:k] != pdf["_b"][k]).to_numpy()
            hits = [i for i in np.flatnonzero(may) if similar(words[k], words[i], least)]
            later += [k] * len(hits)
            earlier += hits
        return pd.DataFrame({"_group": pdf["_group"].iloc[0], "later": pdf["_id"].iloc[later].tolist(), "earlier": pdf["_id"].iloc[earlier].tolist()})

    found = pairs.select("_group", "_id", "_text", "_first", "_any_guard", "_b", "_i", "_j").groupBy("_group", "_i", "_j").applyInPandas(compare, f"_group {kind}, later binary, earlier binary")
    return materialize(found, "similar")


def _settle(texts: DataFrame, pairs: DataFrame) -> DataFrame:
    """(_group, _id, _first, _keep): a text stays if every earlier similar one falls; each round reads the last one's result.

    Texts without an earlier undecided neighbour are kept, which drops their later neighbours; what is
    dropped no longer stands in the way of others. There are as many rounds as the longest chain of
    neighbours that depend on each other.
    """
    key = F.struct("_group", "_id")
    state = materialize(texts.select("_group", "_id", "_first", "_any_guard", key.alias("_key")), "open")
    edges = materialize(pairs.select(F.struct("_group", F.col("later").alias("_id")).alias("later"), F.struct("_group", F.col("earlier").alias("_id")).alias("earlier")), "edges")
    kept = state.filter("_any_guard").select("_key")  # these stay whatever they resemble
    undecided, done = state.filter("not _any_guard"), state.filter("_any_guard").withColumn("_keep", F.lit(False))
    on = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    while True:
        dropped = materialize(edges.join(kept, on("earlier", "_key"), "left_semi").select(F.col("later").alias("_key")).distinct(), "dropped")
        left = undecided.alias("u").join(dropped.alias("d"), on("u._key", "d._key"), "left_anti")
        done = done.unionByName(undecided.alias("u").join(dropped.alias("d"), on("u._key", "d._key"), "left_semi").withColumn("_keep", F.lit(False)))
        waiting = edges.join(dropped, on("later", "_key"), "left_anti").join(dropped, on("earlier", "_key"), "left_anti").join(kept, on("earlier", "_key"), "left_anti")
        edges = materialize(waiting, "edges")
        free = materialize(left.alias("u").join(edges.alias("e"), on("u._key", "e.later"), "left_anti"), "free")
        done = done.unionByName(free.withColumn("_keep", F.lit(True)))
        undecided = materialize(left.alias("u").join(free.alias("f"), on("u._key", "f._key"), "left_anti"), "open")
        if undecided.isEmpty():
            return done.select("_group", "_id", "_first", "_keep")
        kept = free.select("_key")
