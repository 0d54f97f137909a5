"""Match decisions: near candidates merge by themselves, the others go to a classifier; merges are applied."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alinea.operators.annotate import Backend, check_reply, check_tier, with_retry
from alinea.operators.scoring import first_per_key


def similarity_backend(regional: float = 0.75, link: float = 0.5) -> Backend:
    """A classifier without a model: the first candidate, with a tier by its similarity."""

    def decide(batch: Sequence[dict]) -> dict[str, object]:
        def tier(s: float) -> str:
            return "link_regional" if s >= regional else "link" if s >= link else "none"

        return {r["key"]: {"tier": tier(r["similarities"][0]), "cc_idx": 0} for r in batch}

    return decide


def candidate_lists(nearest: DataFrame, right_texts: DataFrame) -> DataFrame:
    """(left_id, choices): each left text's candidates in order, with their texts; ``nearest`` bounds how many.

    ``nearest``: left_id, right_id, similarity, place. ``right_texts``: right_id, right_text.
    """
    full = nearest.join(right_texts, "right_id", "left")
    return full.groupBy("left_id").agg(F.sort_array(F.collect_list(F.struct("place", "right_id", "similarity", "right_text"))).alias("choices"))


def classify(left: DataFrame, lists: DataFrame, backend: Backend, merge: float = 0.92, batch_size: int = 5, attempts: int = 5, wait: float = 2.0) -> DataFrame:
    """(left_id, right_id, similarity, match_tier): one row for every row of ``left`` (left_id, left_text).

    A first candidate from ``merge`` on is a merge without asking. Of the others the backend is asked
    in batches inside the tasks: records with key, text, candidates and similarities; replies of tier
    and cc_idx, which are checked. A batch that fails after all attempts, and a reply that breaks the
    contract, give tier none. Where no candidate is chosen the first one stands in the row; texts
    without candidates have null. Similarity is always that of the first candidate.
    """
    asked = left.join(lists, "left_id", "left").withColumn("best", F.get("choices", F.lit(0)))
    is_merge = F.coalesce(F.col("best.similarity") >= merge, F.lit(False))
    kind = dict(asked.dtypes)
    schema = f"left_id {kind['left_id']}, right_id {dict(lists.select(F.get('choices', F.lit(0))['right_id'].alias('r')).dtypes)['r']}, similarity double, match_tier string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for start in range(0, len(pdf), batch_size):
                part = pdf.iloc[start : start + batch_size]
                records = [
                    {"key": str(i), "text": t, "candidates": [c["right_text"] for c in cs], "similarities": [c["similarity"] for c in cs]}
                    for i, t, cs in zip(part["left_id"], part["left_text"], part["choices"])
                ]
                keys = [r["key"] for r in records]

                def ask(records: list[dict] = records, keys: list[str] = keys) -> list[tuple[str, int | None]]:
                    replies = check_reply(backend(records), keys)
                    return [check_tier(replies[r["key"]], len(r["candidates"])) for r in records]

                try:
                    decisions = with_retry(ask, attempts, wait)
                except Exception:
                    decisions = [("none", None)] * len(part)
                rows = [(i, cs[at or 0]["right_id"], cs[0]["similarity"], tier) for i, cs, (tier, at) in zip(part["left_id"], part["choices"], decisions)]
                yield pd.DataFrame(rows, columns=["left_id", "right_id", "similarity", "match_tier"])

    row = lambda tier: ("left_id", F.col("best.right_id").alias("right_id"), F.col("best.similarity").alias("similarity"), F.lit(tier).alias("match_tier"))
    merged = asked.filter(is_merge).select(*row("merge"))
    alone = asked.filter(F.col("best").isNull()).select(*row("none"))
    judged = asked.filter(F.col("best").isNotNull() & ~is_merge).select("left_id", "left_text", "choices").mapInPandas(run, schema)
    return merged.unionByName(judged).unionByName(alone)


def apply_merges(components: DataFrame, matches: DataFrame, right_texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(components, matches) after merges: a merged component takes its counterpart's id and description.

    ``components``: element, description and other columns; ``matches``: element, target, tier and ord,
    of which a component's first merge counts; ``right_texts``: target, right_text. Rows without a
    merge stay as they are. Merged match rows then name the counterpart at both ends. A counterpart
    without a text gives a null description.
    """
    merges = first_per_key(matches.filter("tier = 'merge' and element is not null and target is not null").select("element", F.col("target").alias("_target"), "ord"), ["element"], "ord").drop("ord")
    texts = right_texts.select(F.col("target").alias("_target"), "right_text")
    joined = components.join(merges, "element", "left").join(texts, "_target", "left")
    is_merged = F.col("_target").isNotNull()
    out = joined.withColumns({"element": F.when(is_merged, F.col("_target")).otherwise(F.col("element")), "description": F.when(is_merged, F.col("right_text")).otherwise(F.col("description"))})
    shared = matches.withColumn("element", F.when((F.col("tier") == "merge") & F.col("target").isNotNull(), F.col("target")).otherwise(F.col("element")))
    return out.select(*components.columns), shared
