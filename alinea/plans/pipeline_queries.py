"""Queries of files, layouts, replies, match decisions and reports, over the given tables, and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from alinea.functions import grammar, text
from alinea.functions.clean import clean_code, id_bytes, id_text, null_if_blank
from alinea.operators import annotate, classify, curriculum, dedup, matching, scoring
from alinea.plans import align_queries as align
from alinea.plans import sql
from alinea.sources import readers, sinks
from alinea.sources.tables import table
from alinea.workspace import folder, materialize


def _path(s: SparkSession, label: str) -> str:
    return f"{folder(s)}/{label}-{uuid.uuid4().hex}"


# Files


def csv_round_trip(s: SparkSession, d: str) -> DataFrame:
    """A table written as CSV with a mark and read again, with a missing file beside it."""
    rows = table(s, d, "bncc_translated", "record_id", "bncc_code", "stage", "grade", "subject", "description_pt")
    path = _path(s, "csv")
    sinks.write_csv(rows, path)
    read = readers.read_csv(s, path, rows.schema).unionByName(readers.read_csv(s, path + "-missing", rows.schema, allow_missing=True))
    return read.select("record_id", "bncc_code", "stage", "grade", "subject", F.md5("description_pt").alias("text_md5"))


def _event_lines(s: SparkSession, d: str) -> str:
    """Events as JSON lines; of every fiftieth only the first part, and a blank line after it."""
    rows = table(s, d, "events", "event_id", "event_type", "user_id", "props")
    line = F.to_json(F.struct("event_id", "event_type", "user_id", "props"))
    broken = F.col("event_id") % 50 == 0
    path = _path(s, "lines")
    rows.select(F.explode(F.when(broken, F.array(F.left(line, F.lit(20)), F.lit("  "))).otherwise(F.array(line))).alias("value")).write.text(path)
    return path


def json_lines(s: SparkSession, d: str) -> DataFrame:
    good, _ = readers.read_json_lines(s, _event_lines(s, d), "event_id long, event_type string, user_id long, props string")
    return good


def json_lines_bad(s: SparkSession, d: str) -> DataFrame:
    """Lines that are no JSON, each with how often it occurs."""
    _, bad = readers.read_json_lines(s, _event_lines(s, d), "event_id long, event_type string, user_id long, props string")
    return bad.groupBy("line").agg(F.count("*").alias("n"))


def line_count(s: SparkSession, d: str) -> DataFrame:
    return s.read.text(_event_lines(s, d)).agg(F.count("*").alias("n_lines"))


def document_files(s: SparkSession, d: str) -> DataFrame:
    """One JSON file per record, read again as whole files."""
    rows = table(s, d, "bncc_fundamental", "raw_id", "payload")
    path = _path(s, "documents")
    sinks.write_documents(rows, "raw_id", path)
    docs = readers.read_documents(s, path).select(F.from_json("payload", "raw_id long, payload string").alias("x"))
    return docs.select("x.raw_id", F.md5("x.payload").alias("payload_md5"))


def search_index(s: SparkSession, d: str) -> DataFrame:
    """The search index written as lines and read as a whole."""
    rows = table(s, d, "bncc_translated", "record_id", "bncc_code", "stage", "subject").select("record_id", clean_code(F.col("bncc_code")).alias("code"), "stage", "subject")
    path = _path(s, "index")
    sinks.write_lines(rows, path)
    return s.read.schema(rows.schema).json(path)


def batches_resume(s: SparkSession, d: str) -> DataFrame:
    """Documents left to do after two batches of results, one of them written twice."""
    docs, path = table(s, d, "documents", "doc_id", "lang"), _path(s, "batches")
    for lang, batch in (("pt", "b1"), ("en", "b2"), ("pt", "b1")):
        sinks.append_batch(docs.filter(F.col("lang") == lang).select("doc_id"), path, batch)
    return sinks.remaining(s, docs, path, "doc_id")


def table_versions(s: SparkSession, d: str) -> DataFrame:
    """A table replaced by its next version while the old one is read."""
    path = _path(s, "versions")
    first = sinks.write_version(table(s, d, "cc_components_full", "row_id", "standard_id", "source"), path, "1")
    second = sinks.write_version(s.read.parquet(first).filter("standard_id is not null").withColumn("source", F.lower("source")), path, "2")
    return s.read.parquet(second).groupBy("source").agg(F.count("*").alias("n"))


def _nodes(s: SparkSession, d: str) -> DataFrame:
    """Components and skills as lines of a graph export, read again as nodes."""
    std = table(s, d, "bncc_standards", "row_id", "bncc_code", "stage", "subject", "description_pt")
    props = lambda **c: F.map_from_arrays(F.array(*map(F.lit, c)), F.array(*(F.col(x) for x in c.values())))
    both = F.when(F.col("row_id") % 7 == 0, F.array(F.lit("Standard"), F.lit("Component"))).otherwise(F.array(F.lit("Standard")))
    a = std.select(F.concat(F.lit("s"), "row_id").alias("identifier"), both.alias("labels"), props(jurisdiction="stage", statementCode="bncc_code", academicSubject="subject", description="description_pt").alias("properties"))
    comp = table(s, d, "cc_components_full", "row_id", "description")
    b = comp.select(F.concat(F.lit("c"), "row_id").alias("identifier"), F.array(F.lit("Component")).alias("labels"), props(description="description").alias("properties"))
    path = _path(s, "nodes")
    sinks.write_lines(a.unionByName(b), path)
    return readers.read_json_lines(s, path, readers.GRAPH_NODE)[0]


def graph_standards(s: SparkSession, d: str) -> DataFrame:
    standards, _ = readers.graph_nodes(_nodes(s, d), "Standard", "Component", "EF")
    return standards.select("identifier", "statement_code", "academic_subject", "grade_level", F.md5("description").alias("text_md5"))


def graph_components(s: SparkSession, d: str) -> DataFrame:
    _, components = readers.graph_nodes(_nodes(s, d), "Standard", "Component", "EF")
    return components.select("identifier", "name", "description")


# Layouts


def _layout_rows(s: SparkSession, d: str, stage: str) -> DataFrame:
    """Skills of a stage whose code is valid, with the parts that documents are built of."""
    rows = table(s, d, "bncc_standards", "row_id", "bncc_code", "grade", "description_pt", "thematic_unit", "knowledge_object").withColumn("code", clean_code(F.col("bncc_code")))
    return rows.filter(grammar.is_valid_code(F.col("code"), F.lit(stage))).withColumn("d", grammar.code_part(F.col("code"), "subject"))


def _layout(parsed: DataFrame) -> DataFrame:
    return parsed.select("bncc_code", "stage", "grade", "grade_code", "subject", "subject_code", F.md5("description_pt").alias("text_md5"), "thematic_unit", "knowledge_object")


def layout_early(s: SparkSession, d: str) -> DataFrame:
    """Early years: fields, bands and goals, one document per code."""
    rows = _layout_rows(s, d, "EI")
    goal = F.struct(F.col("code").alias("codigo"), F.col("description_pt").alias("descricao"))
    bands = rows.groupBy("code", F.col("grade").alias("nome_faixa")).agg(F.collect_list(goal).alias("objetivos"))
    fields = bands.groupBy("code").agg(F.collect_list(F.struct("nome_faixa", "objetivos")).alias("faixas_etarias"))
    docs = fields.select(F.to_json(F.struct(F.struct(F.array(F.struct("faixas_etarias")).alias("campos_experiencia")).alias("educacao_infantil"))).alias("payload"))
    return _layout(curriculum.parse_early(docs, "payload"))


def layout_primary(s: SparkSession, d: str) -> DataFrame:
    """Primary years: the code opens the text, the year label is a list, other members are skipped."""
    rows = _layout_rows(s, d, "EF")
    skill = F.struct(F.concat(F.lit("("), "code", F.lit(") "), F.coalesce("description_pt", F.lit(""))).alias("nome_habilidade"))
    objects = rows.groupBy("code", "d", "grade", "thematic_unit", F.col("knowledge_object").alias("nome_objeto")).agg(F.collect_list(skill).alias("habilidades"))
    units = objects.groupBy("code", "d", "grade", F.col("thematic_unit").alias("nome_unidade")).agg(F.collect_list(F.struct("nome_objeto", "habilidades")).alias("objeto_conhecimento"))
    years = units.groupBy("code", "d", F.array("grade").alias("nome_ano")).agg(F.collect_list(F.struct("nome_unidade", "objeto_conhecimento")).alias("unidades_tematicas"))
    docs = years.groupBy("code", "d").agg(F.to_json(F.struct(F.collect_list(F.struct("nome_ano", "unidades_tematicas")).alias("ano"))).alias("v"))
    payload = F.concat(F.lit('{"versao": "2", "nota": null, "'), "d", F.lit('": '), "v", F.lit("}"))
    return _layout(curriculum.parse_primary(docs.select(payload.alias("payload")), "payload"))


def layout_secondary(s: SparkSession, d: str) -> DataFrame:
    """Secondary years: codes and texts side by side, the year label is a text."""
    rows = _layout_rows(s, d, "EM")
    skill = F.struct(F.col("code").alias("nome_codigo"), F.col("description_pt").alias("nome_habilidade"))
    years = rows.groupBy("code", "d", F.col("grade").alias("nome_ano")).agg(F.collect_list(skill).alias("codigo_habilidade"))
    docs = years.groupBy("code", "d").agg(F.to_json(F.struct(F.collect_list(F.struct("nome_ano", "codigo_habilidade")).alias("ano"))).alias("v"))
    return _layout(curriculum.parse_secondary(docs.select(F.concat(F.lit('{"versao": 2, "'), "d", F.lit('": '), "v", F.lit("}")).alias("payload")), "payload"))


# Texts, prompts and replies


def reply_fields(s: SparkSession, d: str) -> DataFrame:
    """Fields of JSON objects taken out of replies with fences and prose around them."""
    rows = table(s, d, "bncc_translated", "record_id", "bncc_code", "description_en")
    body = F.to_json(F.struct("bncc_code", "description_en"), {"ignoreNullFields": "false"})
    reply = F.when(F.col("record_id") % 3 == 0, F.concat(F.lit("Here it is:\n```json\n"), body, F.lit("\n```"))).when(F.col("record_id") % 3 == 1, F.concat(F.lit("```"), body, F.lit("```\nDone."))).otherwise(body)
    fields = F.from_json(text.reply_json(reply), "bncc_code string, description_en string")
    return rows.select("record_id", fields.alias("x")).select("record_id", "x.bncc_code", F.md5("x.description_en").alias("text_md5"))


def text_forms(s: SparkSession, d: str) -> DataFrame:
    """Stable ids, escaped and lowered texts."""
    rows = table(s, d, "documents", "doc_id", "source", "text")
    low = F.lower(F.trim("text"))
    return rows.select("doc_id", text.stable_id(F.col("doc_id").cast("string"), F.col("source")).alias("id"), F.md5(text.html_escape(F.col("text"))).alias("escaped_md5"), F.md5(low).alias("low_md5"))


def prompts(s: SparkSession, d: str) -> DataFrame:
    """A prompt per batch of five components of one habilidade: a template with a numbered list in it."""
    rows = align._left(s, d).filter("left_id is not null and description is not null").select("row_id", "left_id", "description")
    numbered = annotate.numbered_batches(rows, "left_id", "row_id", 5)
    entries = F.sort_array(F.collect_list(F.struct("row_id", "description")))
    lists = numbered.groupBy("left_id", "batch").agg(entries.alias("e"))
    listed = F.array_join(F.transform("e", lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x["description"])), "\n")
    return lists.select(F.col("left_id").alias("habilidade_code"), "batch", F.md5(annotate.fill("Skill: {code}\nComponents:\n{components}\nReturn JSON only.", code=F.col("left_id"), components=listed)).alias("prompt_md5"))


def _upper(batch: Sequence[dict]) -> dict[str, object]:
    return {r["key"]: r["description"].upper() for r in batch}


def translated_components(s: SparkSession, d: str) -> DataFrame:
    """Replies for distinct components joined back to all rows that hold them."""
    rows = align._left(s, d).filter("element is not null and description is not null").withColumn("component_id", id_text(F.col("element")))
    once = dedup.keep_first(rows.select("component_id", "description", "row_id"), ["component_id"], "row_id").drop("row_id")
    replies = annotate.annotate(once, "component_id", ["description"], _upper, batch_size=50).filter("error is null")
    said = replies.select("component_id", F.from_json(F.concat(F.lit('{"v": '), "reply", F.lit("}")), "v string")["v"].alias("description_pt"))
    return rows.join(said, "component_id").select("row_id", F.col("left_id").alias("habilidade_code"), "component_id", "description_pt")


def _long_enough(batch: Sequence[dict]) -> dict[str, object]:
    return {r["key"]: {"required": "YES" if len(r["description"].split(" ")) >= 8 else "NO"} for r in batch}


def required_components(s: SparkSession, d: str) -> DataFrame:
    """Components that the annotator calls required."""
    rows = align._left(s, d).filter("element is not null and description is not null")
    replies = annotate.annotate(rows.select("row_id", "description"), "row_id", ["description"], _long_enough)
    return replies.filter(F.get_json_object("reply", "$.required") == "YES").select("row_id")


# Candidates, decisions and merges

#: Areas of subjects, by letters of codes; others have no pool of their own.
AREAS = {"MA": "numbers", "MAT": "numbers", "CI": "nature", "CNT": "nature", "LP": "language", "LI": "language", "LGG": "language"}


def _area(code: Column) -> Column:
    return F.coalesce(F.create_map(*(F.lit(x) for kv in AREAS.items() for x in kv))[grammar.code_part(code, "subject")], F.lit("all"))


def tfidf_topk_blocked(s: SparkSession, d: str) -> DataFrame:
    """The five nearest standards of each record's area; records without one look among all."""
    left = table(s, d, "bncc_translated", "record_id", "bncc_code", "description_pt").filter("description_pt is not null").withColumn("area", _area(clean_code(F.col("bncc_code"))))
    right = table(s, d, "bncc_standards", "row_id", "bncc_code", "description_pt").filter("description_pt is not null").withColumn("own", _area(clean_code(F.col("bncc_code"))))
    right = right.withColumn("area", F.explode(F.array_distinct(F.array(F.col("own"), F.lit("all")))))
    a = matching.term_counts(left.withColumn("id", F.col("record_id").cast("string")), "id", "description_pt", "area")
    b = matching.term_counts(right.withColumn("id", F.col("row_id").cast("string")), "id", "description_pt", "area")
    return matching.cosine_nearest(matching.tfidf(a, b), 5)


def area_lists(s: SparkSession, d: str) -> DataFrame:
    """Per code the sorted subjects that its records state, in one column."""
    rows = table(s, d, "bncc_translated", "bncc_code", "subject").select(clean_code(F.col("bncc_code")).alias("code"), null_if_blank(F.col("subject")).alias("subject")).filter("code is not null and subject is not null")
    return rows.groupBy("code").agg(F.array_join(F.sort_array(F.collect_set("subject")), ", ").alias("subjects"))


def _decisions(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Left components, right components (first rows by id) and a decision for every left one."""
    left = dedup.keep_first(align._left(s, d).filter("element is not null").select("element", "description", "row_id"), ["element"], "row_id")
    right = dedup.keep_first(align._right(s, d).filter("target is not null").select("target", "description", "ord"), ["target"], "ord")
    texts = right.select(id_text(F.col("target")).alias("right_id"), F.col("description").alias("right_text"))
    lists = classify.candidate_lists(matching.cosine_nearest(align._vectors(s, d), 20), texts)
    found = classify.classify(left.select(id_text(F.col("element")).alias("left_id"), F.col("description").alias("left_text")), lists, classify.similarity_backend())
    return left, right, materialize(found, "decisions")


def match_all(s: SparkSession, d: str) -> DataFrame:
    """A decision for every left component: merge, link_regional, link or none."""
    return _decisions(s, d)[2].select(F.col("left_id").alias("bncc_component_id"), F.col("right_id").alias("cc_component_id"), "similarity", "match_tier")


def apply_merges(s: SparkSession, d: str) -> DataFrame:
    """Left components after the merges of the match table: shared ids and descriptions."""
    right = dedup.keep_first(align._right(s, d).filter("target is not null").select("target", "description", "ord"), ["target"], "ord")
    out, _ = classify.apply_merges(align._left(s, d), align._matches(s, d), right.select("target", F.col("description").alias("right_text")))
    return out.select("row_id", F.col("left_id").alias("habilidade_code"), id_text(F.col("element")).alias("component_id"), "description")


def merged_matches(s: SparkSession, d: str) -> DataFrame:
    """The match table after its merges: merged rows name the counterpart at both ends."""
    right = align._right(s, d).select("target", F.col("description").alias("right_text"))
    _, out = classify.apply_merges(align._left(s, d), align._matches(s, d), right)
    return out.select(F.col("ord").alias("match_id"), id_text(F.col("element")).alias("bncc_component_id"), id_text(F.col("target")).alias("cc_component_id"), "tier")


def component_sheet(s: SparkSession, d: str) -> DataFrame:
    """Each component row with its tier, its source (LC for merges, else AI) and, of merges, the counterpart's text."""
    last = scoring.last_per_key(align._matches(s, d).filter("element is not null").select("element", "target", "tier", "ord"), ["element"], "ord").drop("ord")
    right = dedup.keep_first(align._right(s, d).filter("target is not null").select("target", "description", "ord"), ["target"], "ord").select("target", F.col("description").alias("text"))
    rows = align._left(s, d).join(last, "element", "left").join(right, "target", "left")
    merged = F.coalesce(F.col("tier") == "merge", F.lit(False))
    return rows.select("row_id", F.coalesce("tier", F.lit("none")).alias("tier"), F.when(merged, "LC").otherwise("AI").alias("source"), F.when(merged, F.col("text")).alias("cc_description"))


def pruned_components(s: SparkSession, d: str) -> DataFrame:
    """Left components without those whose last match is of tier none."""
    last = scoring.last_per_key(align._matches(s, d).filter("element is not null").select("element", "tier", "ord"), ["element"], "ord")
    return align._left(s, d).filter("element is not null").join(last.filter("tier = 'none'").select("element"), "element", "left_anti").select("row_id")


# Reports


def _scores(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "bncc_cc_standard_matches", "habilidade_code", "cc_standard_id", "score").filter("score between 0 and 1 and not isnan(score)")
    rows = rows.select(clean_code(F.col("habilidade_code")).alias("code"), id_bytes(F.col("cc_standard_id")).alias("item"), "score").filter("code is not null and item is not null")
    return rows.groupBy("code", "item").agg(F.max("score").alias("score"))


def top3_from_040(s: SparkSession, d: str) -> DataFrame:
    """Up to three standards of each habilidade with a score of 0.4 or more."""
    best = scoring.rank_top(_scores(s, d).filter("score >= 0.4"), "code", "score", "item", 3)
    return best.select(F.col("code").alias("habilidade_code"), id_text(F.col("item")).alias("cc_standard_id"), "rank")


def _best(s: SparkSession, d: str) -> DataFrame:
    return scoring.rank_top(_scores(s, d), "code", "score", "item", 1).select("code", "item")


def prerequisites_by_best(s: SparkSession, d: str) -> DataFrame:
    """Prerequisites that follow from the standards' edges through the reverse index of best matches."""
    best = materialize(_best(s, d), "best")
    edges = align._edges(s, d)
    a, b = best.toDF("habilidade_code", "node"), best.toDF("prerequisite_code", "prerequisite")
    return edges.join(a, "node").join(b, "prerequisite").filter("habilidade_code <> prerequisite_code").groupBy("habilidade_code", "prerequisite_code").agg(F.count("*").alias("n_edges"))


def unmapped(s: SparkSession, d: str) -> DataFrame:
    """Codes without a match, and prerequisite standards that no code has as its best match."""
    best = materialize(_best(s, d), "best")
    codes = table(s, d, "bncc_standards", "bncc_code").select(clean_code(F.col("bncc_code")).alias("code")).filter("code is not null").distinct()
    a = codes.join(best.select("code"), "code", "left_anti").select("code", F.lit("no match").alias("issue"), F.lit(None).cast("string").alias("cc_standard_id"))
    ends = align._edges(s, d).select(F.col("prerequisite").alias("item")).distinct().join(best.select("item"), "item", "left_anti")
    return a.unionByName(ends.select(F.lit(None).cast("string").alias("code"), F.lit("prerequisite without a best match").alias("issue"), id_text(F.col("item")).alias("cc_standard_id")))


def coverage_summary(s: SparkSession, d: str) -> DataFrame:
    """Codes, matched codes and their percentage by stage and subject."""
    codes = table(s, d, "bncc_standards", "bncc_code").select(clean_code(F.col("bncc_code")).alias("code")).filter("code is not null").distinct()
    marked = codes.join(_best(s, d).select("code", F.lit(1).alias("hit")), "code", "left")
    part = lambda p: grammar.code_part(F.col("code"), p).alias(p)
    return marked.groupBy(part("stage"), part("subject")).agg(F.count("*").alias("total"), F.count("hit").alias("matched"), text.round_at(100.0 * F.count("hit") / F.count("*"), 1).alias("pct"))


def source_by_subject(s: SparkSession, d: str) -> DataFrame:
    """Percentage of merged (LC) and other (AI) components of each subject."""
    rows = component_sheet(s, d).join(align._left(s, d).select("row_id", grammar.code_part(F.col("left_id"), "subject").alias("subject")), "row_id")
    counts = rows.groupBy("subject", "source").agg(F.count("*").alias("n"))
    whole = F.sum("n").over(Window.partitionBy("subject"))
    return counts.select("subject", "source", "n", text.round_at(100.0 * F.col("n") / whole, 1).alias("pct"))


_NAMES = """csv_round_trip json_lines json_lines_bad line_count document_files search_index batches_resume table_versions graph_standards graph_components
layout_early layout_primary layout_secondary reply_fields text_forms prompts translated_components required_components tfidf_topk_blocked area_lists
match_all apply_merges merged_matches component_sheet pruned_components top3_from_040 prerequisites_by_best unmapped coverage_summary source_by_subject"""
QUERIES = {name: globals()[name] for name in _NAMES.split()}

_S = align._SCORED
_BROKEN = "substr('{\"event_id\":' || event_id || ',\"event_type\":\"' || event_type || '\"', 1, 20)"


def _squeezed(c: str) -> str:
    return align._SQUEEZE.replace("coalesce(text, '')", f"coalesce({c}, '')")


def _sql_area(c: str) -> str:
    letters = f"regexp_extract({c}, '^..\\d\\d([A-Z]+)', 1)"
    return f"coalesce({align._case(AREAS, letters, 'NULL')}, 'all')"



def _layout_sql(stage: str, unit: str = "''", thing: str = "''") -> str:
    sq = _squeezed
    parts = "SELECT *, substr(code, 1, 2) AS st, substr(code, 3, 2) AS gr, regexp_extract(code, '^..\\d\\d([A-Z]+)', 1) AS su"
    name = f"CASE WHEN su = 'EF' THEN CASE WHEN st = 'EI' THEN '{grammar.EARLY_EF}' ELSE '{grammar.LATER_EF}' END ELSE {align._case(grammar.SUBJECT_NAMES, 'su', 'su')} END"
    return f"""WITH p AS ({parts} FROM (SELECT *, {sql.code('bncc_code')} AS code FROM bncc_standards))
SELECT code AS bncc_code, st AS stage, coalesce(nullif({sq('grade')}, ''), {align._case(align._LABELS, 'st || gr', 'gr')}) AS grade, gr AS grade_code, {name} AS subject, su AS subject_code,
md5({sq('description_pt')}) AS text_md5, {unit} AS thematic_unit, {thing} AS knowledge_object FROM p WHERE st = '{stage}' AND ({align._VALID})"""


_BEST = f"""WITH s AS (SELECT {sql.code('habilidade_code')} AS code, {sql.uid('cc_standard_id')} AS item, max(score) AS score FROM bncc_cc_standard_matches WHERE score BETWEEN 0 AND 1 AND NOT isnan(score) GROUP BY ALL),
k AS (SELECT *, CAST(row_number() OVER (PARTITION BY code ORDER BY score DESC, item) AS INTEGER) AS rank FROM s WHERE code IS NOT NULL AND item IS NOT NULL), b AS (SELECT code, item FROM k WHERE rank = 1),
e AS (SELECT DISTINCT {sql.uid('source_cc_standard_id')} AS node, {sql.uid('source_cc_prereq_id')} AS pre FROM bncc_prerequisites),
c AS (SELECT DISTINCT {sql.code('bncc_code')} AS code FROM bncc_standards WHERE {sql.code('bncc_code')} IS NOT NULL)
"""
_SHEET = _S + """, fr AS (SELECT t, description AS text FROM r WHERE t IS NOT NULL QUALIFY row_number() OVER (PARTITION BY t ORDER BY row_id) = 1),
sh AS (SELECT l.row_id, l.h, coalesce(lm.tier, 'none') AS tier, CASE WHEN lm.tier = 'merge' THEN 'LC' ELSE 'AI' END AS source, CASE WHEN lm.tier = 'merge' THEN fr.text END AS cc_description
  FROM l LEFT JOIN lm ON lm.e = l.e LEFT JOIN fr ON fr.t = lm.t)
"""
_BLOCKED = f"""WITH a AS (SELECT CAST(record_id AS VARCHAR) AS id, {_sql_area(sql.code('bncc_code'))} AS area, description_pt AS x FROM bncc_translated WHERE description_pt IS NOT NULL),
b0 AS (SELECT CAST(row_id AS VARCHAR) AS id, {_sql_area(sql.code('bncc_code'))} AS area, description_pt AS x FROM bncc_standards WHERE description_pt IS NOT NULL),
b AS (SELECT * FROM b0 UNION SELECT id, 'all', x FROM b0),
d AS (SELECT 'l' AS side, * FROM a UNION ALL SELECT 'r', * FROM b),
w AS (SELECT side, id, area, regexp_extract_all(lower(x), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS w FROM d),
g AS (SELECT side, id, area, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM w),
c AS (SELECT side, id, area, term, count(*) AS n FROM g GROUP BY ALL),
u AS (SELECT DISTINCT side, id, term FROM c),
idf AS (SELECT term, ln((1.0 + (SELECT count(*) FROM (SELECT DISTINCT side, id FROM c))) / (1.0 + count(*))) + 1.0 AS idf FROM u GROUP BY term),
y AS (SELECT side, id, area, term, (1.0 + ln(CAST(n AS DOUBLE))) * idf AS raw FROM c JOIN idf USING (term)),
v AS (SELECT side, id, area, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY side, id, area)) AS weight FROM y),
z AS (SELECT p.id AS left_id, q.id AS right_id, sum(p.weight * q.weight) AS dot FROM v p JOIN v q ON p.side = 'l' AND q.side = 'r' AND p.area = q.area AND p.term = q.term GROUP BY ALL),
pairs AS (SELECT p.id AS left_id, q.id AS right_id FROM (SELECT DISTINCT id, area FROM v WHERE side = 'l') p JOIN (SELECT DISTINCT id, area FROM v WHERE side = 'r') q USING (area)),
k AS (SELECT left_id, right_id, floor(coalesce(dot, 0.0) * 1e6 + 0.5) / 1e6 AS similarity FROM pairs LEFT JOIN z USING (left_id, right_id))
SELECT left_id, right_id, similarity, place FROM (SELECT *, CAST(row_number() OVER (PARTITION BY left_id ORDER BY similarity DESC, right_id) AS INTEGER) AS place FROM k) WHERE place <= 5"""

SQL = {
    "csv_round_trip": f"SELECT record_id, {', '.join(f'{sql.present(c)} AS {c}' for c in ('bncc_code', 'stage', 'grade', 'subject'))}, md5({sql.present('description_pt')}) AS text_md5 FROM bncc_translated",
    "json_lines": "SELECT event_id, event_type, user_id, props FROM events WHERE event_id % 50 <> 0",
    "json_lines_bad": f"SELECT {_BROKEN} AS line, count(*) AS n FROM events WHERE event_id % 50 = 0 GROUP BY 1",
    "line_count": "SELECT count(*) + count(*) FILTER (WHERE event_id % 50 = 0) AS n_lines FROM events",
    "document_files": "SELECT raw_id, md5(payload) AS payload_md5 FROM bncc_fundamental",
    "search_index": f"SELECT record_id, {sql.code('bncc_code')} AS code, stage, subject FROM bncc_translated",
    "batches_resume": "SELECT doc_id, lang FROM documents WHERE lang IS NULL OR lang NOT IN ('pt', 'en')",
    "table_versions": "SELECT lower(source) AS source, count(*) AS n FROM cc_components_full WHERE standard_id IS NOT NULL GROUP BY 1",
    "graph_standards": "SELECT 's' || row_id AS identifier, bncc_code AS statement_code, subject AS academic_subject, '' AS grade_level, md5(description_pt) AS text_md5 FROM bncc_standards WHERE stage = 'EF'",
    "graph_components": "SELECT 'c' || row_id AS identifier, '' AS name, description FROM cc_components_full",
    "layout_early": _layout_sql("EI"),
    "layout_primary": _layout_sql("EF", _squeezed("thematic_unit"), _squeezed("knowledge_object")),
    "layout_secondary": _layout_sql("EM"),
    "reply_fields": "SELECT record_id, bncc_code, md5(description_en) AS text_md5 FROM bncc_translated",
    "text_forms": """SELECT doc_id, sha256(concat_ws('|', CAST(doc_id AS VARCHAR), source)) AS id, md5(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;')) AS escaped_md5, md5(lower(trim(text, ' '))) AS low_md5 FROM documents""",
    "prompts": _S + """, n AS (SELECT h, row_id, description, (row_number() OVER (PARTITION BY h ORDER BY row_id) - 1) AS k FROM l WHERE h IS NOT NULL AND description IS NOT NULL)
SELECT h AS habilidade_code, CAST(k // 5 AS INTEGER) AS batch, md5('Skill: ' || h || chr(10) || 'Components:' || chr(10) || string_agg((k % 5 + 1) || '. ' || description, chr(10) ORDER BY row_id) || chr(10) || 'Return JSON only.') AS prompt_md5 FROM n GROUP BY h, k // 5""",
    "translated_components": _S + "SELECT row_id, h AS habilidade_code, e AS component_id, upper(first_value(description) OVER (PARTITION BY e ORDER BY row_id)) AS description_pt FROM l WHERE e IS NOT NULL AND description IS NOT NULL",
    "required_components": _S + "SELECT row_id FROM l WHERE e IS NOT NULL AND description IS NOT NULL AND len(string_split(description, ' ')) >= 8",
    "tfidf_topk_blocked": _BLOCKED,
    "area_lists": f"SELECT code, string_agg(DISTINCT subject, ', ' ORDER BY subject) AS subjects FROM (SELECT {sql.code('bncc_code')} AS code, {sql.present('subject')} AS subject FROM bncc_translated) WHERE code IS NOT NULL AND subject IS NOT NULL GROUP BY code",
    "match_all": align._TFIDF + align._DECIDED + "SELECT bncc_component_id, cc_component_id, similarity, match_tier FROM decided",
    "apply_merges": _S + """, mm AS (SELECT e, t FROM m WHERE tier = 'merge' AND e IS NOT NULL AND t IS NOT NULL QUALIFY row_number() OVER (PARTITION BY e ORDER BY match_id) = 1),
fr AS (SELECT t, description AS text FROM r WHERE t IS NOT NULL QUALIFY row_number() OVER (PARTITION BY t ORDER BY row_id) = 1)
SELECT l.row_id, l.h AS habilidade_code, coalesce(mm.t, l.e) AS component_id, CASE WHEN mm.t IS NULL THEN l.description ELSE fr.text END AS description FROM l LEFT JOIN mm ON mm.e = l.e LEFT JOIN fr ON fr.t = mm.t""",
    "merged_matches": _S + "SELECT match_id, CASE WHEN tier = 'merge' AND t IS NOT NULL THEN t ELSE e END AS bncc_component_id, t AS cc_component_id, tier FROM m",
    "component_sheet": _SHEET + "SELECT row_id, tier, source, cc_description FROM sh",
    "pruned_components": _S + "SELECT row_id FROM l WHERE e IS NOT NULL AND e NOT IN (SELECT e FROM lm WHERE tier = 'none')",
    "top3_from_040": _BEST + "SELECT code AS habilidade_code, item AS cc_standard_id, rank FROM k WHERE rank <= 3 AND score >= 0.4",
    "prerequisites_by_best": _BEST + "SELECT x.code AS habilidade_code, y.code AS prerequisite_code, count(*) AS n_edges FROM e JOIN b x ON x.item = e.node JOIN b y ON y.item = e.pre WHERE x.code <> y.code GROUP BY ALL",
    "unmapped": _BEST + "SELECT code, 'no match' AS issue, NULL::VARCHAR AS cc_standard_id FROM c WHERE code NOT IN (SELECT code FROM b) UNION ALL SELECT DISTINCT NULL, 'prerequisite without a best match', pre FROM e WHERE node IS NOT NULL AND pre NOT IN (SELECT item FROM b)",
    "coverage_summary": _BEST + "SELECT substr(c.code, 1, 2) AS stage, regexp_extract(c.code, '^..\\d\\d([A-Z]+)', 1) AS subject, count(*) AS total, count(b.code) AS matched, floor(100.0 * count(b.code) / count(*) * 10.0 + 0.5) / 10.0 AS pct FROM c LEFT JOIN b USING (code) GROUP BY 1, 2",
    "source_by_subject": _SHEET + "SELECT subject, source, n, floor(100.0 * n / sum(n) OVER (PARTITION BY subject) * 10.0 + 0.5) / 10.0 AS pct FROM (SELECT regexp_extract(h, '^..\\d\\d([A-Z]+)', 1) AS subject, source, count(*) AS n FROM sh GROUP BY ALL)",
}
