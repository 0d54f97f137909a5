"""Queries of the general data problems: hierarchies (p3), orphan references (p4), nested records (p6)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alinea.functions.clean import clean_code, id_bytes, null_if_blank, opening_code
from alinea.operators import hierarchy, nested, references
from alinea.plans import sql
from alinea.sources.tables import table


def _tree(spark: SparkSession, d: str) -> DataFrame:
    links = table(spark, d, "bncc_prerequisites", "habilidade_code", "prerequisite_code")
    links = links.select(clean_code(F.col("habilidade_code")).alias("code"), clean_code(F.col("prerequisite_code")).alias("above"))
    return hierarchy.resolve_hierarchy(links, "code", "above")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _tree(spark, d).select("code", "root_code", "depth")


def p3_paths(spark: SparkSession, d: str) -> DataFrame:
    return _tree(spark, d).select("code", "depth", F.array_join("path", " > ").alias("full_path"))


def p3_descendants(spark: SparkSession, d: str) -> DataFrame:
    return hierarchy.ancestor_pairs(_tree(spark, d))


def _named(refs: DataFrame, column: str, clean: Callable[[Column], Column]) -> DataFrame:
    """References that name something, with their clean ``key``; null keys are values without a clean form."""
    keyed = refs.withColumn("key", clean(F.col(column)))
    return keyed.filter(F.col("key").isNotNull() | null_if_blank(F.col(column)).isNotNull()).drop(column)


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    """Both references of problem 4: (ref_table, row_id, kind, period)."""
    refs = table(spark, d, "bncc_component_matches", "match_id", "cc_component_id", "matched_at")
    refs = _named(refs, "cc_component_id", id_bytes)
    targets = table(spark, d, "cc_components_full", "component_id", "loaded_at", "deleted_at")
    targets = targets.withColumn("component_id", id_bytes(F.col("component_id")))
    a = references.find_orphans(refs, targets, [("key", "component_id")], "matched_at", "loaded_at", "deleted_at", broken=F.col("key").isNull())
    a = a.select(F.lit("bncc_component_matches").alias("ref_table"), F.col("match_id").alias("row_id"), "kind", "period")

    refs = table(spark, d, "bncc_prerequisites", "row_id", "prerequisite_code", "created_at")
    refs = _named(refs, "prerequisite_code", clean_code)
    targets = table(spark, d, "bncc_standards", "bncc_code", "loaded_at", "deleted_at")
    targets = targets.withColumn("bncc_code", clean_code(F.col("bncc_code")))
    b = references.find_orphans(refs, targets, [("key", "bncc_code")], "created_at", "loaded_at", "deleted_at", broken=F.col("key").isNull())
    return a.unionByName(b.select(F.lit("bncc_prerequisites").alias("ref_table"), "row_id", "kind", "period"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d)


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    return references.orphan_report(_orphans(spark, d))


def p4_composite(spark: SparkSession, d: str) -> DataFrame:
    """Prerequisite rows whose pair (habilidade, source standard) no match row scored, by null mask."""
    refs = table(spark, d, "bncc_prerequisites", "row_id", "habilidade_code", "source_cc_standard_id", "created_at")
    refs = refs.select("row_id", "created_at", clean_code(F.col("habilidade_code")).alias("hab"), id_bytes(F.col("source_cc_standard_id")).alias("std"))
    targets = table(spark, d, "bncc_cc_standard_matches", "habilidade_code", "cc_standard_id", "scored_at")
    targets = targets.select(clean_code(F.col("habilidade_code")).alias("habilidade"), id_bytes(F.col("cc_standard_id")).alias("standard"), F.col("scored_at").alias("loaded_at"), F.lit(None).cast("timestamp_ntz").alias("deleted_at"))
    found = references.find_orphans(refs, targets, [("hab", "habilidade"), ("std", "standard")], "created_at", "loaded_at", "deleted_at", match="partial")
    return found.select("row_id", "kind", "period")


def _payloads(spark: SparkSession, d: str) -> nested.Shredded:
    return nested.shred(table(spark, d, "bncc_fundamental", "raw_id", "payload"), "raw_id", "payload")


def _skills(parts: nested.Shredded) -> DataFrame:
    """Skills below objects, or directly below units (object_no -1), with the keys of their parents."""
    rows = parts.table("habilidades", "nome_habilidade")
    text = null_if_blank(F.coalesce(F.col("nome_habilidade"), F.col("value")))
    path = F.array_join("path", "/")
    below_object, below_unit = "entry/ano/unidades_tematicas/objeto_conhecimento/habilidades", "entry/ano/unidades_tematicas/habilidades"
    rows = rows.filter(path.isin(below_object, below_unit)).withColumn("text", text).filter("text is not null")
    at = lambda i: F.get("places", F.lit(i))
    return rows.select(
        F.col("doc_id").alias("raw_id"), F.col("entry").alias("discipline"), at(1).alias("year_no"), at(2).alias("unit_no"),
        F.when(path == below_object, at(3)).otherwise(-1).alias("object_no"), F.col("position").alias("skill_no"),
        opening_code(F.col("text")).alias("bncc_code"), "text",
    )


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _skills(_payloads(spark, d)).drop("text")


def p6_years(spark: SparkSession, d: str) -> DataFrame:
    rows = _payloads(spark, d).table("ano").filter(F.array_join("path", "/") == "entry/ano")
    return rows.select(F.col("doc_id").alias("raw_id"), F.col("entry").alias("discipline"), F.col("position").alias("year_no"))


def p6_units(spark: SparkSession, d: str) -> DataFrame:
    rows = _payloads(spark, d).table("unidades_tematicas", "nome_unidade").filter(F.array_join("path", "/") == "entry/ano/unidades_tematicas")
    return rows.select(F.col("doc_id").alias("raw_id"), F.col("entry").alias("discipline"), F.get("places", F.lit(1)).alias("year_no"), F.col("position").alias("unit_no"), F.col("nome_unidade").alias("unit_name"))


def p6_objects(spark: SparkSession, d: str) -> DataFrame:
    rows = _payloads(spark, d).table("objeto_conhecimento", "nome_objeto").filter(F.array_join("path", "/") == "entry/ano/unidades_tematicas/objeto_conhecimento")
    return rows.select(F.col("doc_id").alias("raw_id"), F.col("entry").alias("discipline"), F.get("places", F.lit(1)).alias("year_no"), F.get("places", F.lit(2)).alias("unit_no"), F.col("position").alias("object_no"), F.col("nome_objeto").alias("object_name"))


def p6_year_labels(spark: SparkSession, d: str) -> DataFrame:
    rows = _payloads(spark, d).table("nome_ano").filter(F.array_join("path", "/") == "entry/ano/nome_ano")
    return rows.select(F.col("doc_id").alias("raw_id"), F.col("entry").alias("discipline"), F.get("places", F.lit(1)).alias("year_no"), F.col("position").alias("label_no"), F.col("value").alias("label"))


def p6_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Payloads that give no rows, with the reason."""
    return _payloads(spark, d).rejects().withColumnRenamed("doc_id", "raw_id")


QUERIES = {
    "p3_found": p3_found,
    "p3_paths": p3_paths,
    "p3_descendants": p3_descendants,
    "p4_found": p4_found,
    "p4_report": p4_report,
    "p4_composite": p4_composite,
    "p6_found": p6_found,
    "p6_years": p6_years,
    "p6_units": p6_units,
    "p6_objects": p6_objects,
    "p6_year_labels": p6_year_labels,
    "p6_rejects": p6_rejects,
}

_TREE = f"""
WITH RECURSIVE l AS (SELECT {sql.code('habilidade_code')} AS c, {sql.code(sql.present('prerequisite_code'))} AS p FROM bncc_prerequisites),
n AS (SELECT code, min(parent) AS parent FROM (SELECT c AS code, p AS parent FROM l UNION ALL SELECT p, NULL FROM l) WHERE code IS NOT NULL GROUP BY code),
t AS (SELECT code, code AS root_code, 0 AS depth, [code] AS path FROM n WHERE parent IS NULL
      UNION ALL SELECT n.code, t.root_code, t.depth + 1, list_append(t.path, n.code) FROM t JOIN n ON n.parent = t.code),
r AS (SELECT n.code, coalesce(t.root_code, 'CYCLE') AS root_code, CAST(coalesce(t.depth, -1) AS INTEGER) AS depth, t.path FROM n LEFT JOIN t USING (code))
"""

_ORPHANS = f"""
WITH refs AS (
  SELECT 'bncc_component_matches' AS ref_table, match_id AS row_id, {sql.uid('cc_component_id')} AS k, matched_at AS t FROM bncc_component_matches WHERE {sql.present('cc_component_id')} IS NOT NULL
  UNION ALL SELECT 'bncc_prerequisites', row_id, {sql.code('prerequisite_code')}, created_at FROM bncc_prerequisites WHERE {sql.present('prerequisite_code')} IS NOT NULL),
targets AS (
  SELECT 'bncc_component_matches' AS ref_table, {sql.uid('component_id')} AS k, loaded_at, deleted_at FROM cc_components_full
  UNION ALL SELECT 'bncc_prerequisites', {sql.code('bncc_code')}, loaded_at, deleted_at FROM bncc_standards),
judged AS (
  SELECT r.ref_table, r.row_id, r.t, count(x.k) AS n, count(*) FILTER (WHERE x.loaded_at <= r.t AND (x.deleted_at IS NULL OR x.deleted_at > r.t)) AS live, count(*) FILTER (WHERE x.loaded_at <= r.t) AS loaded
  FROM refs r LEFT JOIN targets x ON x.ref_table = r.ref_table AND x.k = r.k GROUP BY ALL),
o AS (SELECT ref_table, row_id, CASE WHEN n = 0 THEN 'missing' WHEN loaded > 0 THEN 'deleted' ELSE 'late' END AS kind, strftime(t, '%Y-%m') AS period FROM judged WHERE live = 0)
"""

def _items(v: str) -> str:
    """Places and elements of a JSON list; any other value as its only element."""
    return f"unnest(CASE WHEN json_type({v}) = 'ARRAY' THEN list_transform(range(CAST(json_array_length({v}) AS BIGINT)), lambda i: {{'no': CAST(i AS INTEGER), 'v': json_extract({v}, CAST(i AS BIGINT))}}) ELSE [{{'no': 0, 'v': {v}}}] END)"


_TEXT = sql.present("coalesce(json_extract_string(h.v, '$.nome_habilidade'), CASE WHEN json_type(h.v) = 'VARCHAR' THEN json_extract_string(h.v, '$') END)")
_OPENING = "(?i)^[^\\p{L}\\p{N}]*(E[IFM][\\x{200b}\\-.]?[0-9]{2}[\\x{200b}\\x{00a0} \\-.]?[A-Z]{2,3}[\\x{200b}\\x{00a0} \\-.]?[0-9]{2,7})(?:[^\\p{L}\\p{N}]|$)"
_NESTED = f"""
WITH a AS (SELECT raw_id, regexp_replace(payload, '^\\x{{feff}}', '') AS p FROM bncc_fundamental),
b AS (SELECT raw_id, CASE WHEN json_valid(p) AND json_type(p) = 'VARCHAR' THEN json_extract_string(p, '$') ELSE p END AS p FROM a),
c AS (SELECT raw_id, CAST(p AS JSON) AS j FROM b WHERE json_valid(p)),
e AS (SELECT raw_id, unnest(json_keys(j)) AS discipline, j FROM c WHERE json_type(j) = 'OBJECT'),
e2 AS (SELECT raw_id, discipline, {_items("json_extract(j, '$.' || discipline)")} AS x FROM e),
y AS (SELECT raw_id, discipline, {_items("json_extract(x.v, '$.ano')")} AS y FROM e2 WHERE json_type(x.v) = 'OBJECT' AND json_exists(x.v, '$.ano')),
yy AS (SELECT raw_id, discipline, y.no AS year_no, y.v FROM y WHERE json_type(y.v) <> 'NULL'),
u AS (SELECT raw_id, discipline, year_no, {_items("json_extract(v, '$.unidades_tematicas')")} AS u FROM yy WHERE json_type(v) = 'OBJECT' AND json_exists(v, '$.unidades_tematicas')),
uu AS (SELECT raw_id, discipline, year_no, u.no AS unit_no, u.v FROM u WHERE json_type(u.v) <> 'NULL'),
o AS (SELECT raw_id, discipline, year_no, unit_no, {_items("json_extract(v, '$.objeto_conhecimento')")} AS o FROM uu WHERE json_type(v) = 'OBJECT' AND json_exists(v, '$.objeto_conhecimento')),
oo AS (SELECT raw_id, discipline, year_no, unit_no, o.no AS object_no, o.v FROM o WHERE json_type(o.v) <> 'NULL'),
hp AS (SELECT raw_id, discipline, year_no, unit_no, object_no, v FROM oo WHERE json_type(v) = 'OBJECT' UNION ALL SELECT raw_id, discipline, year_no, unit_no, -1, v FROM uu WHERE json_type(v) = 'OBJECT'),
h AS (SELECT raw_id, discipline, year_no, unit_no, object_no, {_items("json_extract(v, '$.habilidades')")} AS h FROM hp WHERE json_exists(v, '$.habilidades')),
t AS (SELECT raw_id, discipline, year_no, unit_no, object_no, h.no AS skill_no, {_TEXT} AS text FROM h)
"""

SQL = {
    "p3_found": _TREE + "SELECT code, root_code, depth FROM r",
    "p3_paths": _TREE + "SELECT code, depth, array_to_string(path, ' > ') AS full_path FROM r",
    "p3_descendants": _TREE + "SELECT path[i] AS ancestor, code AS descendant, CAST(depth + 1 - i AS INTEGER) AS distance FROM (SELECT code, depth, path, unnest(range(1, len(path))) AS i FROM r)",
    "p4_found": _ORPHANS + "SELECT ref_table, row_id, kind, period FROM o",
    "p4_report": _ORPHANS + "SELECT ref_table, kind, period, count(*) AS orphans FROM o GROUP BY ALL",
    "p4_composite": f"""
WITH refs AS (SELECT row_id, created_at AS t, {sql.code('habilidade_code')} AS h, {sql.uid(sql.present('source_cc_standard_id'))} AS s FROM bncc_prerequisites),
m AS (SELECT {sql.code('habilidade_code')} AS h, {sql.uid('cc_standard_id')} AS s, min(scored_at) AS first FROM bncc_cc_standard_matches GROUP BY ALL),
mh AS (SELECT h, min(first) AS first FROM m WHERE h IS NOT NULL GROUP BY h),
ms AS (SELECT s, min(first) AS first FROM m WHERE s IS NOT NULL GROUP BY s),
j AS (SELECT row_id, t, first FROM refs LEFT JOIN m USING (h, s) WHERE refs.h IS NOT NULL AND refs.s IS NOT NULL
      UNION ALL SELECT row_id, t, first FROM refs LEFT JOIN mh USING (h) WHERE refs.h IS NOT NULL AND refs.s IS NULL
      UNION ALL SELECT row_id, t, first FROM refs LEFT JOIN ms USING (s) WHERE refs.h IS NULL AND refs.s IS NOT NULL)
SELECT row_id, CASE WHEN first IS NULL THEN 'missing' ELSE 'late' END AS kind, strftime(t, '%Y-%m') AS period FROM j WHERE first IS NULL OR first > t""",
    "p6_found": _NESTED + f"SELECT raw_id, discipline, year_no, unit_no, object_no, skill_no, coalesce({sql.code(f"regexp_extract(text, '{_OPENING}', 1)")}, '') AS bncc_code FROM t WHERE text IS NOT NULL",
    "p6_years": _NESTED + "SELECT raw_id, discipline, year_no FROM yy",
    "p6_units": _NESTED + "SELECT raw_id, discipline, year_no, unit_no, CASE WHEN json_type(v) = 'OBJECT' THEN json_extract_string(v, '$.nome_unidade') END AS unit_name FROM uu",
    "p6_objects": _NESTED + "SELECT raw_id, discipline, year_no, unit_no, object_no, CASE WHEN json_type(v) = 'OBJECT' THEN json_extract_string(v, '$.nome_objeto') END AS object_name FROM oo",
    "p6_rejects": _NESTED + """SELECT raw_id, CASE WHEN p IS NULL OR trim(p, ' ' || chr(9) || chr(10) || chr(13) || chr(160)) = '' THEN 'empty' WHEN NOT json_valid(p) THEN 'unreadable' ELSE 'no object' END AS reason FROM b
WHERE p IS NULL OR NOT json_valid(p) OR json_type(p) <> 'OBJECT'""",
    "p6_year_labels": _NESTED + f"SELECT raw_id, discipline, year_no, l.no AS label_no, json_extract_string(l.v, '$') AS label FROM (SELECT raw_id, discipline, year_no, {_items("json_extract(v, '$.nome_ano')")} AS l FROM yy WHERE json_type(v) = 'OBJECT' AND json_exists(v, '$.nome_ano')) WHERE json_type(l.v) <> 'NULL'",
}
