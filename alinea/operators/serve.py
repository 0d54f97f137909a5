"""Denormalised documents, the search index, filtered and ranked search, and the sheets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alinea.functions.clean import fold
from alinea.functions.text import round_at


def skill_documents(skills: DataFrame, components: DataFrame, matches: DataFrame, prerequisites: DataFrame, top: int = 5) -> DataFrame:
    """One document per skill: components, best standards, prerequisites and what it unlocks.

    ``skills``: code, stage, grade, subject, description_pt. ``components``: code, id, description,
    match_tier, cc_component_id. ``matches``: code, standard_id, score, rank. ``prerequisites``: code,
    prerequisite_code. Lists are in a fixed order; a skill without entries has empty lists. A
    component whose tier is none or unknown shows no counterpart.
    """
    tier = F.coalesce("match_tier", F.lit("none"))
    entry = F.struct("id", "description", tier.alias("match_tier"), F.when(tier != "none", F.col("cc_component_id")).alias("cc_component_id"))
    comps = components.groupBy("code").agg(F.sort_array(F.collect_list(entry)).alias("components"))
    best = matches.filter(F.col("rank") <= top).groupBy("code").agg(F.sort_array(F.collect_list(F.struct("rank", "standard_id", round_at(F.col("score"), 4).alias("score")))).alias("cc_matches"))
    up = prerequisites.groupBy("code").agg(F.sort_array(F.collect_set("prerequisite_code")).alias("prerequisites"))
    down = prerequisites.groupBy(F.col("prerequisite_code").alias("code")).agg(F.sort_array(F.collect_set("code")).alias("unlocks"))
    out = skills
    for part in (comps, best, up, down):
        out = out.join(part, "code", "left")
    lists = {c: F.coalesce(c, F.array().cast(out.schema[c].dataType)) for c in ("components", "cc_matches", "prerequisites", "unlocks")}
    out = out.withColumns(lists)
    return out.withColumn("has_prereq_data", (F.size("prerequisites") + F.size("unlocks")) > 0)


def search_filter(index: DataFrame, stage: str | None = None, subjects: list[str] | None = None) -> DataFrame:
    """Records of a stage and of a group of subjects; what isn't given doesn't restrict."""
    if stage:
        index = index.filter(F.col("stage") == stage)
    if subjects:
        index = index.filter(F.col("subject").isin(*subjects))
    return index


def _gap(text: Column, query: str) -> Column:
    """0 where the text holds the query, else the share of the query's three-letter parts it lacks."""
    q = query.lower()
    parts = sorted({q[i : i + 3] for i in range(max(1, len(q) - 2))})
    low = fold(F.coalesce(text, F.lit("")))
    hits = sum((F.when(F.contains(low, F.lit(p)), 1).otherwise(0) for p in parts), F.lit(0))
    return F.when(F.contains(low, F.lit(q)), 0.0).otherwise(1.0 - hits / float(len(parts)))


def search_ranked(index: DataFrame, query: str, most: int = 100, least_match: float = 0.35) -> DataFrame:
    """Up to ``most`` records by weighted distance to the query: code twice, text once, subject half.

    A record counts if one field's distance is at most ``least_match``. The distance is the share of
    missing three-letter parts, an approximation of interactive fuzzy search. Queries of fewer than
    two letters find nothing. ``query`` is given folded: lower case, no accents.
    """
    if len(query) < 2:
        return index.withColumn("distance", F.lit(0.0)).limit(0)
    code, text, subject = _gap(F.col("code"), query), _gap(F.col("description_pt"), query), _gap(F.col("subject"), query)
    near = F.least(code, text, subject)
    score = round_at((2.0 * code + text + 0.5 * subject) / 3.5, 6)
    return index.filter(near <= least_match).withColumn("distance", score).orderBy("distance", "code", "record_id").limit(most)


def lookup(documents: DataFrame, code: str) -> DataFrame:
    """The document of one code; no row if there is none."""
    return documents.filter(F.col("code") == code)
