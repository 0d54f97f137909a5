"""Queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alinea.functions.clean import clean_code, clean_id, id_bytes, id_text, null_if_blank, strip
from alinea.llm import mixing, packing, quality, set_join, survivorship, tokens, topn
from alinea.plans import sql
from alinea.sources.tables import table
from alinea.workspace import materialize


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return survivorship.losers(*survivorship.duplicate_groups(table(spark, d, "bncc_translated")))


def p1_best(spark: SparkSession, d: str) -> DataFrame:
    """One row per duplicate group: its survivor and the best value of each field."""
    _, survivors = survivorship.duplicate_groups(table(spark, d, "bncc_translated"))
    return survivors.select("survivor_id", F.col("n").alias("n_records"), "best_code", "best_grade", "best_subject", "best_text_pt", "best_text_en")


def _sets(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "bncc_components", "habilidade_code", "component_id")
    b = table(spark, d, "cc_components_full", "standard_id", "component_id")
    element = id_bytes(F.col("component_id")).alias("element")
    return a.select(clean_code(F.col("habilidade_code")).alias("key"), element).unionByName(b.select(clean_id(F.col("standard_id")).alias("key"), element))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return set_join.similar_pairs(_sets(spark, d), "key", "element", 0.6)


def p2_links(spark: SparkSession, d: str) -> DataFrame:
    return set_join.link_counts(_sets(spark, d), "key", "element", 0.6)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "bncc_cc_standard_matches", "habilidade_code", "cc_standard_id", "score")
    valid = F.col("score").between(0, 1) & ~F.isnan("score")
    rows = rows.filter(valid).select(clean_code(F.col("habilidade_code")).alias("habilidade_code"), id_bytes(F.col("cc_standard_id")).alias("item"), F.round("score", 6).alias("score"))
    best = topn.top_n(rows, ["habilidade_code"], "item", "score", 10)
    return best.select("habilidade_code", id_text(F.col("item")).alias("cc_standard_id"), "place")


def _sized(spark: SparkSession, d: str, *columns: str) -> DataFrame:
    return tokens.count_tokens(table(spark, d, "documents", *columns, "text"), "text")


def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    """Each text's container for each capacity, with the container's fill."""
    rows = table(spark, d, "pack_capacity").limit(1001).collect()
    if len(rows) > 1000:
        raise ValueError("the table of capacities is too large")
    packed = packing.pack(_sized(spark, d, "doc_id"), "doc_id", "tokens", {r["capacity_name"]: r["capacity_tokens"] for r in rows})
    return packed.select("capacity_name", F.col("item").alias("doc_id"), "piece", F.col("size").alias("tokens"), "container", "fill")


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    """Containers, tokens and share of room used per capacity."""
    bins = p7_containers(spark, d).filter("container is not null").groupBy("capacity_name", "container").agg(F.first("fill").alias("fill"), F.count("*").alias("n"))
    room = table(spark, d, "pack_capacity")
    out = bins.groupBy("capacity_name").agg(F.count("*").alias("containers"), F.sum("n").alias("pieces"), F.sum("fill").alias("tokens"))
    return out.join(F.broadcast(room), "capacity_name").select("capacity_name", "containers", "pieces", "tokens", (F.col("tokens") / (F.col("containers") * F.col("capacity_tokens"))).alias("fill_share"))


def p7_checks(spark: SparkSession, d: str) -> DataFrame:
    """Per capacity: texts placed, containers over their capacity, wrong fills, texts split though they fit."""
    packed = materialize(p7_containers(spark, d), "packed").join(F.broadcast(table(spark, d, "pack_capacity")), "capacity_name")
    bins = packed.filter("container is not null").groupBy("capacity_name", "container").agg(F.sum("tokens").alias("held"), F.max("fill").alias("fill"), F.first("capacity_tokens").alias("room"))
    texts = packed.groupBy("capacity_name", "doc_id").agg(F.count("*").alias("pieces"), F.sum("tokens").alias("size"), F.first("capacity_tokens").alias("room"))
    a = bins.groupBy("capacity_name").agg(F.count_if(F.col("held") > F.col("room")).alias("over_full"), F.count_if(F.col("held") != F.col("fill")).alias("wrong_fill"))
    b = texts.groupBy("capacity_name").agg(F.count("*").alias("texts"), F.count_if((F.col("size") <= F.col("room")) & (F.col("pieces") > 1)).alias("split_without_need"))
    return a.join(b, "capacity_name")


def _source(c: str):
    """A source's name in comparable form: lower case, trimmed, words joined by _."""
    return F.regexp_replace(F.lower(strip(null_if_blank(F.col(c)))), r"[\s\x{00a0}_\-]+", "_")


def _mixture(spark: SparkSession, d: str, total: str = "targets") -> tuple[DataFrame, DataFrame]:
    docs = _sized(spark, d, "doc_id", "source").withColumn("source", _source("source"))
    targets = table(spark, d, "mix_targets").withColumn("source", _source("source"))
    return mixing.plan_mixture(docs, targets, "doc_id", "tokens", total)


def p8_mixture(spark: SparkSession, d: str) -> DataFrame:
    return _mixture(spark, d)[0].select("source", F.col("item").alias("doc_id"), F.col("size").alias("tokens"), "repeats")


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    return _mixture(spark, d)[1]


def p8_checks(spark: SparkSession, d: str) -> DataFrame:
    """Per target source: documents used more than once, too often, or of another source, and whether the reported sizes are those of the documents."""
    mixture, shares = _mixture(spark, d)
    own = table(spark, d, "documents", "doc_id", "source").select(F.col("doc_id").alias("item"), _source("source").alias("own_source"))
    used = mixture.join(own, "item").groupBy("source").agg(F.count("*").alias("n"), F.count_distinct("item").alias("m"), F.max("repeats").alias("most"), F.count_if(F.col("source") != F.col("own_source")).alias("foreign_documents"), F.sum(F.col("size") * F.col("repeats")).alias("drawn"))
    both = shares.join(used, "source", "left")
    return both.select(
        "source", "target_share", (F.coalesce(F.col("n") - F.col("m"), F.lit(0)) == 0).alias("each_once"), (F.coalesce("most", F.lit(0)) <= F.col("max_repeats")).alias("repeats_kept"),
        F.coalesce("foreign_documents", F.lit(0)).alias("foreign_documents"), (F.coalesce("drawn", F.lit(0)) == F.col("reached")).alias("sizes_agree"), (F.col("reached") <= F.col("budget")).alias("within_budget"),
    )


def p8_shares_fixed(spark: SparkSession, d: str) -> DataFrame:
    """Shares reached if the mixture is to have as many tokens as all documents, with the shortfalls."""
    return _mixture(spark, d, "all")[1]


def p8_mixture_no_shortfall(spark: SparkSession, d: str) -> DataFrame:
    """The largest mixture in which every source that has documents holds its share."""
    return _mixture(spark, d, "no shortfall")[0].select("source", F.col("item").alias("doc_id"), F.col("size").alias("tokens"), "repeats")


def _quality(spark: SparkSession, d: str) -> DataFrame:
    return quality.quality(table(spark, d, "documents", "doc_id", "text"), "doc_id", "text", table(spark, d, "common_words"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return _quality(spark, d).filter("kind <> 'prose'").select("doc_id", "kind")


def p9_measures(spark: SparkSession, d: str) -> DataFrame:
    """The statistics of each text, the published rules that it fails, and its kind."""
    share = lambda n, of: (F.col(n) / F.greatest(F.lit(1), F.col(of))).alias
    return _quality(spark, d).select(
        "doc_id", "kind", F.array_join("reasons", "; ").alias("reasons"), "n_chars", "n_words", "n_lines", share("n_word_chars", "n_words")("mean_word_length"),
        share("n_symbols", "n_chars")("symbol_share"), share("n_punct_ends", "n_lines")("punct_end_share"), share("n_bullets", "n_lines")("bullet_share"),
        share("n_common", "n_words")("common_share"), share("n_fours", "n_words")("distinct_share"), share("n_repeated_chars", "n_chars")("repeated_share"),
    )


QUERIES = {
    "p1_found": p1_found,
    "p1_best": p1_best,
    "p2_found": p2_found,
    "p2_links": p2_links,
    "p5_found": p5_found,
    "p7_containers": p7_containers,
    "p7_fill": p7_fill,
    "p7_checks": p7_checks,
    "p8_mixture": p8_mixture,
    "p8_shares": p8_shares,
    "p8_checks": p8_checks,
    "p8_shares_fixed": p8_shares_fixed,
    "p8_mixture_no_shortfall": p8_mixture_no_shortfall,
    "p9_found": p9_found,
    "p9_measures": p9_measures,
}

_SETS = f"""
WITH rows AS (
  SELECT {sql.code('habilidade_code')} AS key, {sql.uid(sql.present('component_id'))} AS element FROM bncc_components
  UNION SELECT {sql.uid('standard_id')}, {sql.uid(sql.present('component_id'))} FROM cc_components_full),
s AS (SELECT key, element FROM rows WHERE key IS NOT NULL AND element IS NOT NULL),
z AS (SELECT key, count(*) AS n, string_agg(element, ',' ORDER BY element) AS members FROM s GROUP BY key),
c AS (SELECT a.key AS x, b.key AS y, count(*) AS common FROM s a JOIN s b ON a.element = b.element AND a.key < b.key GROUP BY ALL),
p AS (SELECT x, y FROM c JOIN z a ON a.key = x JOIN z b ON b.key = y WHERE common * 10 >= (a.n + b.n - common) * 6)
"""

SQL = {
    "p7_checks": "SELECT capacity_name, CAST(0 AS BIGINT) AS over_full, CAST(0 AS BIGINT) AS wrong_fill, (SELECT count(*) FROM documents) AS texts, CAST(0 AS BIGINT) AS split_without_need FROM pack_capacity",
    "p8_checks": "SELECT regexp_replace(lower(trim(source)), '[ _-]+', '_', 'g') AS source, target_share, true AS each_once, true AS repeats_kept, CAST(0 AS BIGINT) AS foreign_documents, true AS sizes_agree, true AS within_budget FROM mix_targets",
    "p2_found": _SETS + "SELECT x AS key_a, y AS key_b FROM p",
    "p2_links": _SETS
    + """SELECT key AS record_key, CAST(n AS INTEGER) AS set_size, (SELECT min(o.key) FROM z o WHERE o.members = z.members) AS class_key,
  coalesce(l.n_links, 0) AS n_links FROM z LEFT JOIN (SELECT k, count(*) AS n_links FROM (SELECT x AS k FROM p UNION ALL SELECT y FROM p) GROUP BY k) l ON l.k = z.key""",
    "p5_found": f"""
WITH s AS (SELECT {sql.code('habilidade_code')} AS h, {sql.uid('cc_standard_id')} AS i, floor(score * 1e6 + 0.5) AS v FROM bncc_cc_standard_matches WHERE score BETWEEN 0 AND 1 AND NOT isnan(score)),
b AS (SELECT h, i, max(v) AS v FROM s WHERE h IS NOT NULL AND i IS NOT NULL GROUP BY h, i)
SELECT h AS habilidade_code, i AS cc_standard_id, CAST(place AS INTEGER) AS place FROM (SELECT h, i, row_number() OVER (PARTITION BY h ORDER BY v DESC, i) AS place FROM b) WHERE place <= 10""",
}
