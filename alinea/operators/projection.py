"""Projecting a graph's edges through a mapping of its nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alinea.functions.grammar import grade_order_ok
from alinea.functions.text import round_at


def project_edges(edges: DataFrame, mapping: DataFrame, min_score: float = 0.08, strict_range: bool = False) -> DataFrame:
    """Edges (node, prerequisite) carried over to the codes that map to both ends.

    ``edges`` has node, prerequisite; ``mapping`` has node, code and score, of which rows from
    ``min_score`` count. Pairs of one code and pairs against the order of grades are left out. Each
    pair of codes gives one row: how many sources it has, repeats included, and its best source by
    the sum of both scores, ties by the ids of the source. Two equi-joins; nulls never match.
    """
    m = mapping.filter(F.col("score") >= min_score).select("node", "code", "score")
    a = m.toDF("node", "habilidade_code", "hab_score")
    b = m.toDF("prerequisite", "prerequisite_code", "pre_score")
    pairs = edges.join(a, "node").join(b, "prerequisite").filter(F.col("habilidade_code") != F.col("prerequisite_code"))
    pairs = pairs.filter(grade_order_ok(F.col("habilidade_code"), F.col("prerequisite_code"), strict_range))
    source = F.struct((-round_at(F.col("hab_score") + F.col("pre_score"), 9)).alias("s"), "node", "prerequisite", "hab_score", "pre_score")
    best = pairs.groupBy("habilidade_code", "prerequisite_code").agg(F.count("*").alias("n_cc_sources"), F.min(source).alias("x"))
    return best.select(
        "habilidade_code", "prerequisite_code", "n_cc_sources",
        round_at(F.col("x.hab_score"), 6).alias("best_hab_cc_score"), round_at(F.col("x.pre_score"), 6).alias("best_pre_cc_score"),
        F.col("x.node").alias("source_cc_standard_id"), F.col("x.prerequisite").alias("source_cc_prereq_id"),
    )


def orient_edges(rels: DataFrame, label: str, source: str, target: str, forward: str, backward: str) -> DataFrame:
    """Distinct (node, prerequisite) from two labels that name the same relation in opposite directions."""
    flip = F.col(label) == forward
    kept = rels.filter(F.col(label).isin(forward, backward))
    return kept.select(F.when(flip, F.col(target)).otherwise(F.col(source)).alias("node"), F.when(flip, F.col(source)).otherwise(F.col(target)).alias("prerequisite")).distinct()


def neighbours(edges: DataFrame, key: str, other: str, name: str) -> DataFrame:
    """Per key the ordered list of its neighbours: prerequisites one way, what it unlocks the other way."""
    return edges.groupBy(key).agg(F.sort_array(F.collect_set(other)).alias(name))
