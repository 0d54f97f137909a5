"""Queries of the alignment pipeline: relational steps, scoring, projection, texts, search, serving."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from alinea.functions import grammar, text
from alinea.functions.clean import clean_code, clean_id, id_bytes, id_text, null_if_blank
from alinea.operators import annotate, dedup, matching, metrics, projection, scoring, serve
from alinea.plans import sql
from alinea.sources.tables import table
from alinea.workspace import materialize


def _left(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "bncc_components", "row_id", "habilidade_code", "component_id", "description")
    return rows.select("row_id", clean_code(F.col("habilidade_code")).alias("left_id"), id_bytes(F.col("component_id")).alias("element"), "description")


def _matches(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "bncc_component_matches", "match_id", "bncc_component_id", "cc_component_id", "match_tier", "similarity")
    return rows.select(F.col("match_id").alias("ord"), id_bytes(F.col("bncc_component_id")).alias("element"), id_bytes(F.col("cc_component_id")).alias("target"), null_if_blank(F.col("match_tier")).alias("tier"), "similarity")


def _right(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "cc_components_full", "row_id", "standard_id", "component_id", "source", "description")
    return rows.select(F.col("row_id").alias("ord"), id_bytes(F.col("standard_id")).alias("right_id"), id_bytes(F.col("component_id")).alias("target"), F.lower("source").alias("source"), "description")


def _scored(s: SparkSession, d: str) -> DataFrame:
    return scoring.weighted_jaccard(_left(s, d).select("left_id", "element"), _matches(s, d), _right(s, d))


def _named(df: DataFrame) -> DataFrame:
    return df.withColumn("cc_standard_id", id_text(F.col("right_id"))).withColumnRenamed("left_id", "habilidade_code").drop("right_id")


def jaccard_topn(s: SparkSession, d: str) -> DataFrame:
    return _named(scoring.rank_top(_scored(s, d), "left_id", "score", "right_id", 10)).withColumnsRenamed({"n_left": "n_bncc_components", "n_right": "n_cc_components"})


def jaccard_top1_stats(s: SparkSession, d: str) -> DataFrame:
    best = scoring.rank_top(_scored(s, d), "left_id", "score", "right_id", 1)
    return best.agg(F.count("*").alias("matched"), F.min("score").alias("min_score"), F.max("score").alias("max_score"), F.median("score").alias("median_score"), F.sum("n_merge").alias("merge"), F.sum("n_link").alias("link"))


def unmatched_left(s: SparkSession, d: str) -> DataFrame:
    return _left(s, d).select("left_id").distinct().join(_scored(s, d).select("left_id"), "left_id", "left_anti").withColumnRenamed("left_id", "habilidade_code")


def coverage(s: SparkSession, d: str) -> DataFrame:
    return metrics.coverage(_left(s, d).select("left_id"), _scored(s, d).select("left_id"), "left_id")


def tier_counts(s: SparkSession, d: str) -> DataFrame:
    return _matches(s, d).groupBy(F.coalesce("tier", F.lit("unknown")).alias("tier")).agg(F.count("*").alias("n"), F.count_if(F.col("similarity") >= 0.92).alias("auto"))


def _edges(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "bncc_prerequisites", "source_cc_standard_id", "source_cc_prereq_id")
    return rows.select(id_bytes(F.col("source_cc_standard_id")).alias("node"), id_bytes(F.col("source_cc_prereq_id")).alias("prerequisite")).filter("node is not null and prerequisite is not null").distinct()


def _mapping(s: SparkSession, d: str) -> DataFrame:
    best = scoring.rank_top(_scored(s, d), "left_id", "score", "right_id", 10)
    return materialize(best.select(F.col("right_id").alias("node"), F.col("left_id").alias("code"), "score"), "mapping")  # read for both ends


def edge_projection(s: SparkSession, d: str) -> DataFrame:
    out = projection.project_edges(_edges(s, d), _mapping(s, d))
    return out.withColumns({c: id_text(F.col(c)) for c in ("source_cc_standard_id", "source_cc_prereq_id")})


def _prerequisites(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "bncc_prerequisites", "habilidade_code", "prerequisite_code")
    return rows.select(clean_code(F.col("habilidade_code")).alias("code"), clean_code(F.col("prerequisite_code")).alias("prerequisite_code")).filter("prerequisite_code is not null")


def unlocks(s: SparkSession, d: str) -> DataFrame:
    out = projection.neighbours(_prerequisites(s, d), "prerequisite_code", "code", "unlocks")
    return out.select(F.col("prerequisite_code").alias("code"), F.size("unlocks").alias("n_unlocks"), F.array_join("unlocks", ",").alias("unlocks"))


def grade_inversions(s: SparkSession, d: str) -> DataFrame:
    """Links whose prerequisite lies above the code, by the default rule and by first years."""
    rows = _prerequisites(s, d).distinct()
    a, b = F.col("code"), F.col("prerequisite_code")
    return rows.select("code", "prerequisite_code", grammar.grade_level(a).alias("level"), grammar.grade_level(b).alias("prerequisite_level"), grammar.grade_order_ok(a, b).alias("in_order"), grammar.grade_order_ok(a, b, True).alias("in_order_by_first_year"))


def semi_join_known_ids(s: SparkSession, d: str) -> DataFrame:
    """Match rows whose both ends are known components."""
    m = _matches(s, d).filter("element is not null and target is not null")
    known = m.join(_left(s, d).select("element").distinct(), "element", "left_semi").join(_right(s, d).select("target").distinct(), "target", "left_semi")
    return known.select(F.col("ord").alias("match_id"))


def anti_join_uncovered(s: SparkSession, d: str) -> DataFrame:
    """Codes of the standards that no match row scores."""
    codes = table(s, d, "bncc_standards", "bncc_code").select(clean_code(F.col("bncc_code")).alias("bncc_code")).filter("bncc_code is not null").distinct()
    scored = table(s, d, "bncc_cc_standard_matches", "habilidade_code").select(clean_code(F.col("habilidade_code")).alias("bncc_code"))
    return codes.join(scored, "bncc_code", "left_anti")


def left_join_attach(s: SparkSession, d: str) -> DataFrame:
    """Components per source and number of match rows that point at them."""
    r = _right(s, d).filter("target is not null").groupBy("target").agg(F.min("source").alias("source"))
    m = _matches(s, d).filter("target is not null").groupBy("target").agg(F.count("*").alias("n"))
    return r.join(m, "target", "left").groupBy("source").agg(F.count("*").alias("components"), F.count("n").alias("matched"), F.coalesce(F.sum("n"), F.lit(0)).alias("match_rows"))


def lookup_last_wins(s: SparkSession, d: str) -> DataFrame:
    out = scoring.last_per_key(_matches(s, d).filter("element is not null").select("element", "target", "tier", "ord"), ["element"], "ord")
    return out.select(id_text(F.col("element")).alias("bncc_component_id"), id_text(F.col("target")).alias("cc_component_id"), "tier", F.col("ord").alias("match_id"))


def lookup_first_wins(s: SparkSession, d: str) -> DataFrame:
    out = scoring.first_per_key(_right(s, d).filter("target is not null").select("target", "description", "ord"), ["target"], "ord")
    return out.select(id_text(F.col("target")).alias("component_id"), "description", F.col("ord").alias("row_id"))


def membership_pct(s: SparkSession, d: str) -> DataFrame:
    """Share of left components per stage that the right side holds too."""
    known = _right(s, d).select(F.col("target").alias("element")).filter("element is not null").distinct().withColumn("hit", F.lit(1))
    left = _left(s, d).filter("element is not null").withColumn("stage", grammar.code_part(F.col("left_id"), "stage"))
    return left.join(known, "element", "left").groupBy("stage").agg(F.count("*").alias("n"), F.count("hit").alias("shared"), text.round_at(100.0 * F.count("hit") / F.count("*"), 1).alias("pct"))


def count_by_3(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "bncc_standards", "stage", "subject_code", "subject")
    return rows.groupBy("stage", "subject_code", "subject").agg(F.count("*").alias("n"))


def value_counts(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "documents", "source").groupBy("source").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "source")


def nunique(s: SparkSession, d: str) -> DataFrame:
    return _right(s, d).agg(F.count_distinct("right_id").alias("standards"), F.count_distinct("target").alias("components"), F.count_distinct("source").alias("sources"))


def group_size_stats(s: SparkSession, d: str) -> DataFrame:
    return metrics.group_sizes(_left(s, d), "left_id")


def survivorship_dedup(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "bncc_standards", "row_id", "bncc_code", "grade", "subject", "description_pt").filter("description_pt is not null and subject is not null")
    return dedup.widest_grade(rows, ["subject", "description_pt"], "grade", "row_id").select("row_id", "bncc_code", "grade")


def keep_first_dedup(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "bncc_standards", "row_id", "bncc_code", "grade").withColumn("bncc_code", clean_code(F.col("bncc_code"))).filter("bncc_code is not null")
    return dedup.keep_first(rows, ["bncc_code"], "row_id")


def union_corpora(s: SparkSession, d: str) -> DataFrame:
    both = _left(s, d).select("description").unionByName(_right(s, d).select("description"))
    return both.filter("description is not null").distinct().agg(F.count("*").alias("texts"), F.sum(F.length("description")).alias("chars"))


def json_props_flatten(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "events", "event_id", "event_type", "props")
    return rows.select("event_id", "event_type", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))


def label_filter_orient(s: SparkSession, d: str) -> DataFrame:
    """Two event types as the two directions of one relation between users and values of k."""
    rows = table(s, d, "events", "event_type", "user_id", "props")
    rows = rows.select("event_type", "user_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"))
    return projection.orient_edges(rows, "event_type", "user_id", "k", "click", "view")


def code_parse(s: SparkSession, d: str) -> DataFrame:
    code = clean_code(F.col("bncc_code"))
    rows = table(s, d, "bncc_standards", "row_id", "bncc_code").select("row_id", code.alias("code"))
    c = F.col("code")
    parts = {p: grammar.code_part(c, p) for p in ("stage", "grade", "subject", "number")}
    return rows.select("row_id", "code", *(v.alias(k) for k, v in parts.items()), grammar.is_valid_code(c).alias("valid"), grammar.subject_name(c).alias("subject_name"), grammar.grade_label(c).alias("grade_label"), grammar.grade_level(c).alias("level"))


def text_clean(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "documents", "doc_id", "text")
    clean = text.squeeze(F.col("text"))
    return rows.select("doc_id", F.length(clean).alias("n_clean"), F.md5(clean).alias("clean_md5"), (F.length(clean) < 5).alias("near_empty"))


def text_truncate(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "bncc_translated", "record_id", "bncc_code", "description_pt")
    return rows.select("record_id", text.shorten(F.col("description_pt"), 110).alias("short"), text.position_key("h", F.col("record_id"), 4).alias("key"), text.lookup_key(F.col("bncc_code"), F.md5("description_pt")).alias("lookup"))


def line_explode(s: SparkSession, d: str) -> DataFrame:
    lines = table(s, d, "documents", "doc_id", "text").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return lines.filter(F.trim("line") != "").select("doc_id", "line_no", F.length("line").alias("n_chars"), F.md5("line").alias("line_md5"))


def resume_todo(s: SparkSession, d: str) -> DataFrame:
    """Documents without a label, in numbered batches of 20 per source."""
    docs = table(s, d, "documents", "doc_id", "source").withColumn("source", F.coalesce("source", F.lit("")))
    return annotate.numbered_batches(annotate.todo(docs, table(s, d, "doc_labels", "doc_id"), "doc_id"), "source", "doc_id", 20)


def _vectors(s: SparkSession, d: str) -> DataFrame:
    l = dedup.keep_first(_left(s, d).filter("element is not null and description is not null").select("element", "description", "row_id"), ["element"], "row_id")
    r = dedup.keep_first(_right(s, d).filter("target is not null and description is not null").select("target", "description", "ord"), ["target"], "ord")
    left = matching.term_counts(l.withColumn("id", id_text(F.col("element"))), "id", "description")
    right = matching.term_counts(r.withColumn("id", id_text(F.col("target"))), "id", "description")
    return matching.tfidf(left, right)


def tfidf_weights(s: SparkSession, d: str) -> DataFrame:
    v = _vectors(s, d)
    return v.groupBy("side", "doc_id").agg(F.count("*").alias("terms"), text.round_at(F.sum(F.col("weight") * F.col("weight")), 6).alias("norm"), F.max(text.round_at(F.col("weight"), 6)).alias("top_weight"))


def tfidf_topk(s: SparkSession, d: str) -> DataFrame:
    return matching.cosine_nearest(_vectors(s, d), 20)


def auto_merge(s: SparkSession, d: str) -> DataFrame:
    """The nearest component and its tier for every left component; those without words or a counterpart have tier none."""
    best = matching.cosine_nearest(_vectors(s, d), 1).withColumnRenamed("left_id", "bncc_component_id")
    known = _left(s, d).filter("element is not null").select(id_text(F.col("element")).alias("bncc_component_id")).distinct()
    return known.join(best, "bncc_component_id", "left").select("bncc_component_id", F.col("right_id").alias("cc_component_id"), "similarity", matching.auto_tier(F.col("similarity")).alias("match_tier"))


def cosine_topk_blocked(s: SparkSession, d: str) -> DataFrame:
    """Nearest neighbours within the label for the stated queries: every vector whose id is divisible by 100."""
    rows = table(s, d, "embeddings", "vec_id", "embedding", "label")
    return matching.vector_top(rows.filter("vec_id % 100 = 0"), rows, "label", "vec_id", "embedding", 5)


def greedy_near_dup(s: SparkSession, d: str) -> DataFrame:
    rows = _right(s, d).filter("right_id is not null").withColumn("existing", F.col("source") == "lc_existing")
    kept = dedup.greedy_near_duplicates(rows, "right_id", "description", "ord", 0.82, "existing")
    return kept.select(F.col("ord").alias("row_id"))


def _index(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "bncc_translated", "record_id", "bncc_code", "stage", "grade", "subject", "description_pt")
    return rows.withColumn("code", clean_code(F.col("bncc_code"))).drop("bncc_code")


def search_filter(s: SparkSession, d: str) -> DataFrame:
    found = serve.search_filter(_index(s, d), "EF", ["Matemática", "Ciências"])
    return found.select("record_id", "code", "subject").orderBy("code", "record_id").limit(100)


def search_ranked(s: SparkSession, d: str) -> DataFrame:
    return serve.search_ranked(_index(s, d), "simetrias", 100).select("record_id", "code", "distance")


def skill_documents(s: SparkSession, d: str) -> DataFrame:
    skills = dedup.keep_first(_index(s, d).filter("code is not null"), ["code"], "record_id").select("code", "stage", "grade", "subject", "description_pt")
    found = scoring.last_per_key(_matches(s, d).filter("element is not null").select("element", "target", "tier", "ord"), ["element"], "ord")
    comps = _left(s, d).filter("element is not null and left_id is not null").join(found, "element", "left")
    comps = comps.select(F.col("left_id").alias("code"), id_text(F.col("element")).alias("id"), "description", F.col("tier").alias("match_tier"), id_text(F.col("target")).alias("cc_component_id"))
    best = scoring.rank_top(_scored(s, d), "left_id", "score", "right_id", 5).select(F.col("left_id").alias("code"), id_text(F.col("right_id")).alias("standard_id"), "score", "rank")
    return serve.skill_documents(skills, comps, best, _prerequisites(s, d))


def nested_documents(s: SparkSession, d: str) -> DataFrame:
    """What each document holds, flat: sizes of its lists, its best standard and its links."""
    docs = skill_documents(s, d)
    return docs.select(
        "code", F.size("components").alias("n_components"), F.size(F.filter("components", lambda c: c["match_tier"] != "none")).alias("n_matched"),
        F.get("cc_matches", F.lit(0))["standard_id"].alias("best_standard"), F.get("cc_matches", F.lit(0))["score"].alias("best_score"),
        F.array_join("prerequisites", ",").alias("prerequisites"), F.array_join("unlocks", ",").alias("unlocks"), "has_prereq_data",
    )


def best_match_blend(s: SparkSession, d: str) -> DataFrame:
    rows = table(s, d, "bncc_cc_standard_matches", "habilidade_code", "cc_standard_id", "score", "n_none", "n_bncc_components")
    rows = rows.filter("score between 0 and 1 and not isnan(score) and n_bncc_components > 0")
    rows = rows.select(clean_code(F.col("habilidade_code")).alias("habilidade_code"), id_bytes(F.col("cc_standard_id")).alias("item"), (F.col("n_bncc_components") - F.col("n_none")).alias("yes"), "n_bncc_components", "score").filter("yes is not null")
    one = rows.groupBy("habilidade_code", "item").agg(F.max(F.struct("score", "yes", "n_bncc_components")).alias("x")).select("habilidade_code", "item", "x.*")
    best = scoring.blended_best(one, "habilidade_code", "item", "yes", "n_bncc_components", "score")
    quality = F.when(F.col("blend") >= 0.7, "direct").when(F.col("blend") >= 0.4, "partial").otherwise("no-direct-equivalent")
    return best.select("habilidade_code", id_text(F.col("item")).alias("cc_standard_id"), "blend", quality.alias("match_quality"))


def grade_window_candidates(s: SparkSession, d: str) -> DataFrame:
    """Per code, how many codes of its subject lie at most two levels away."""
    rows = table(s, d, "bncc_standards", "bncc_code").select(clean_code(F.col("bncc_code")).alias("code")).filter("code is not null").distinct()
    rows = rows.select("code", grammar.code_part(F.col("code"), "subject").alias("subject"), grammar.grade_level(F.col("code"), True).alias("level"))
    per_level = rows.groupBy("subject", "level").agg(F.count("*").alias("n"))
    near = Window.partitionBy("subject").orderBy("level").rangeBetween(-2, 2)
    counts = per_level.withColumn("within", F.sum("n").over(near)).drop("n")
    return rows.join(counts, ["subject", "level"]).select("code", "level", (F.col("within") - 1).alias("candidates"))


def source_audit(s: SparkSession, d: str) -> DataFrame:
    """Share of sources per match tier, with totals."""
    r = scoring.first_per_key(_right(s, d).filter("target is not null").select("target", "source", "ord"), ["target"], "ord").drop("ord")
    m = _matches(s, d).filter("target is not null and tier is not null")
    return m.join(r, "target").rollup("tier", "source").agg(F.count("*").alias("n")).select(F.coalesce("tier", F.lit("all")).alias("tier"), F.coalesce("source", F.lit("all")).alias("source"), "n")


_NAMES = """jaccard_topn jaccard_top1_stats unmatched_left coverage tier_counts edge_projection unlocks grade_inversions semi_join_known_ids
anti_join_uncovered left_join_attach lookup_last_wins lookup_first_wins membership_pct count_by_3 value_counts nunique group_size_stats
survivorship_dedup keep_first_dedup union_corpora json_props_flatten label_filter_orient code_parse text_clean text_truncate line_explode
resume_todo tfidf_weights tfidf_topk auto_merge cosine_topk_blocked greedy_near_dup search_filter search_ranked nested_documents
best_match_blend grade_window_candidates source_audit"""
QUERIES = {name: globals()[name] for name in _NAMES.split()}

_SCORED = f"""
WITH l AS (SELECT {sql.code('habilidade_code')} AS h, {sql.uid(sql.present('component_id'))} AS e, row_id, description FROM bncc_components),
m AS (SELECT match_id, {sql.uid(sql.present('bncc_component_id'))} AS e, {sql.uid(sql.present('cc_component_id'))} AS t, {sql.present('match_tier')} AS tier, similarity FROM bncc_component_matches),
r AS (SELECT row_id, {sql.uid('standard_id')} AS s, {sql.uid(sql.present('component_id'))} AS t, lower(source) AS source, description FROM cc_components_full),
nl AS (SELECT h, count(*) AS n FROM l GROUP BY h), nr AS (SELECT s, count(*) AS n FROM r GROUP BY s),
lm AS (SELECT e, t, tier, match_id FROM m WHERE e IS NOT NULL QUALIFY row_number() OVER (PARTITION BY e ORDER BY match_id DESC) = 1),
lr AS (SELECT t, s FROM r WHERE t IS NOT NULL QUALIFY row_number() OVER (PARTITION BY t ORDER BY row_id DESC) = 1),
p AS (SELECT h, s, sum(CASE tier WHEN 'merge' THEN 10 WHEN 'link_regional' THEN 7 WHEN 'link' THEN 5 ELSE 0 END) AS w,
  count(*) FILTER (WHERE tier = 'merge') AS n_merge, count(*) FILTER (WHERE tier = 'link_regional') AS n_link_regional, count(*) FILTER (WHERE tier = 'link') AS n_link, count(*) FILTER (WHERE tier = 'none') AS n_none
  FROM l JOIN lm USING (e) JOIN lr USING (t) GROUP BY h, s),
sc AS (SELECT p.*, nl.n AS nh, nr.n AS ns, CASE WHEN (nl.n + nr.n) * 10 - w > 0 THEN floor(CAST(w AS DOUBLE) / ((nl.n + nr.n) * 10 - w) * 1e6 + 0.5) / 1e6 ELSE 0.0 END AS score
  FROM p JOIN nl USING (h) JOIN nr USING (s) WHERE w > 0),
rk AS (SELECT *, CAST(row_number() OVER (PARTITION BY h ORDER BY score DESC, s) AS INTEGER) AS rank FROM sc)
"""
_I = "CAST({0} AS INTEGER) AS {0}"
_PRE = f"SELECT {sql.code('habilidade_code')} AS code, {sql.code(sql.present('prerequisite_code'))} AS pre FROM bncc_prerequisites"


def _level(c: str, strict: bool = False) -> str:
    digits = f"CAST(substr({c}, 3, 2) AS INTEGER)"
    if strict:
        digits = f"(CASE WHEN {digits} > 9 THEN {digits} // 10 ELSE {digits} END)"
    return f"(CASE substr({c}, 1, 2) WHEN 'EI' THEN {digits} WHEN 'EF' THEN {digits} + 10 WHEN 'EM' THEN 20 END)"


def _in_order(a: str, b: str, strict: bool = False) -> str:
    return f"({_level(a, strict)} IS NULL OR {_level(b, strict)} IS NULL OR (substr({a}, 1, 2) = 'EM' AND substr({b}, 1, 2) = 'EM') OR {_level(b, strict)} <= {_level(a, strict)})"


def _case(pairs: dict[str, str], c: str, otherwise: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs.items())
    return f"CASE {c} {whens} ELSE {otherwise} END"


_SPACE = "[\\s\\x{0085}\\x{00a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}\\x{001c}-\\x{001f}\\x{000b}]+"
_SQUEEZE = f"trim(regexp_replace(coalesce(text, ''), '{_SPACE}', ' ', 'g'), ' ')"
_VALID = " OR ".join(f"(st = '{s}' AND su IN ({', '.join(repr(x) for x in grammar.STAGE_SUBJECTS[s])}) AND gr IN ({', '.join(repr(x) for x in grammar.GRADE_LABELS[s])}))" for s in grammar.STAGE_SUBJECTS)
_LABELS = {s + g: v for s, x in grammar.GRADE_LABELS.items() for g, v in x.items()}
_TFIDF = (
    _SCORED
    + """, d AS (SELECT 'l' AS side, e AS id, description FROM l WHERE e IS NOT NULL AND description IS NOT NULL QUALIFY row_number() OVER (PARTITION BY e ORDER BY row_id) = 1
  UNION ALL SELECT 'r', t, description FROM r WHERE t IS NOT NULL AND description IS NOT NULL QUALIFY row_number() OVER (PARTITION BY t ORDER BY row_id) = 1),
w AS (SELECT side, id, regexp_extract_all(lower(description), '[\\p{L}\\p{N}_]{2,}') AS w FROM d),
g AS (SELECT side, id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM w),
c AS (SELECT side, id, term, count(*) AS n FROM g GROUP BY ALL),
idf AS (SELECT term, ln((1.0 + (SELECT count(*) FROM (SELECT DISTINCT side, id FROM c))) / (1.0 + count(*))) + 1.0 AS idf FROM c GROUP BY term),
x AS (SELECT side, id, term, (1.0 + ln(CAST(n AS DOUBLE))) * idf AS raw FROM c JOIN idf USING (term)),
v AS (SELECT side, id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY side, id)) AS weight FROM x),
z AS (SELECT a.id AS left_id, b.id AS right_id, sum(a.weight * b.weight) AS dot FROM v a JOIN v b ON a.side = 'l' AND b.side = 'r' AND a.term = b.term GROUP BY ALL),
ids AS (SELECT DISTINCT side, id FROM v),
k AS (SELECT a.id AS left_id, b.id AS right_id, floor(coalesce(dot, 0.0) * 1e6 + 0.5) / 1e6 AS similarity FROM ids a JOIN ids b ON a.side = 'l' AND b.side = 'r' LEFT JOIN z ON z.left_id = a.id AND z.right_id = b.id),
o AS (SELECT left_id, right_id, similarity, CAST(row_number() OVER (PARTITION BY left_id ORDER BY similarity DESC, right_id) AS INTEGER) AS place FROM k)
"""
)
#: Every left component with its nearest one; those without words or counterpart have tier none.
_DECIDED = """, decided AS (SELECT le.e AS bncc_component_id, right_id AS cc_component_id, similarity, CASE WHEN similarity >= 0.92 THEN 'merge' WHEN similarity >= 0.75 THEN 'link_regional' WHEN similarity >= 0.5 THEN 'link' ELSE 'none' END AS match_tier
  FROM (SELECT DISTINCT e FROM l WHERE e IS NOT NULL) le LEFT JOIN (SELECT * FROM o WHERE place = 1) ON left_id = le.e)
"""
_FOLD = "translate(regexp_replace(lower({0}), '\\p{{M}}+', '', 'g'), 'áàâãäåéèêëíìîïóòôõöúùûüçñºª°', 'aaaaaaeeeeiiiiooooouuuucnoao')"


def _sql_gap(c: str, q: str) -> str:
    parts = sorted({q[i : i + 3] for i in range(len(q) - 2)})
    low = _FOLD.format(f"coalesce({c}, '')")
    hits = " + ".join(f"(CASE WHEN contains({low}, '{p}') THEN 1 ELSE 0 END)" for p in parts)
    return f"(CASE WHEN contains({low}, '{q}') THEN 0.0::DOUBLE ELSE 1.0::DOUBLE - ({hits}) / {float(len(parts))}::DOUBLE END)"


SQL = {
    "jaccard_topn": _SCORED + f"SELECT h AS habilidade_code, s AS cc_standard_id, score, rank, {', '.join(_I.format(c) for c in ('n_merge', 'n_link_regional', 'n_link', 'n_none'))}, CAST(nh AS INTEGER) AS n_bncc_components, CAST(ns AS INTEGER) AS n_cc_components FROM rk WHERE rank <= 10",
    "jaccard_top1_stats": _SCORED + "SELECT count(*) AS matched, min(score) AS min_score, max(score) AS max_score, median(score) AS median_score, CAST(sum(n_merge) AS BIGINT) AS merge, CAST(sum(n_link) AS BIGINT) AS link FROM rk WHERE rank = 1",
    "unmatched_left": _SCORED + "SELECT DISTINCT h AS habilidade_code FROM l WHERE h NOT IN (SELECT h FROM sc WHERE h IS NOT NULL)",
    "coverage": _SCORED + "SELECT count(*) AS total, count(x.h) AS covered, floor(100.0 * count(x.h) / count(*) * 10.0 + 0.5) / 10.0 AS pct FROM (SELECT DISTINCT h FROM l) a LEFT JOIN (SELECT DISTINCT h FROM sc) x USING (h)",
    "tier_counts": _SCORED + "SELECT coalesce(tier, 'unknown') AS tier, count(*) AS n, count(*) FILTER (WHERE similarity >= 0.92) AS auto FROM m GROUP BY 1",
    "edge_projection": _SCORED
    + f""", e AS (SELECT DISTINCT {sql.uid(sql.present('source_cc_standard_id'))} AS node, {sql.uid(sql.present('source_cc_prereq_id'))} AS pre FROM bncc_prerequisites),
q AS (SELECT s, h, score FROM rk WHERE rank <= 10 AND score >= 0.08),
x AS (SELECT a.h AS a, b.h AS b, e.node, e.pre, a.score AS sa, b.score AS sb FROM e JOIN q a ON a.s = e.node JOIN q b ON b.s = e.pre WHERE a.h <> b.h AND {_in_order('a.h', 'b.h')}),
y AS (SELECT *, count(*) OVER (PARTITION BY a, b) AS n, row_number() OVER (PARTITION BY a, b ORDER BY floor((sa + sb) * 1e9 + 0.5) DESC, node, pre) AS k FROM x)
SELECT a AS habilidade_code, b AS prerequisite_code, n AS n_cc_sources, floor(sa * 1e6 + 0.5) / 1e6 AS best_hab_cc_score, floor(sb * 1e6 + 0.5) / 1e6 AS best_pre_cc_score, node AS source_cc_standard_id, pre AS source_cc_prereq_id FROM y WHERE k = 1""",
    "unlocks": f"WITH p AS ({_PRE}) SELECT pre AS code, CAST(count(DISTINCT code) AS INTEGER) AS n_unlocks, string_agg(DISTINCT code, ',' ORDER BY code) AS unlocks FROM p WHERE pre IS NOT NULL GROUP BY pre",
    "grade_inversions": f"WITH p AS (SELECT DISTINCT code, pre FROM ({_PRE}) WHERE pre IS NOT NULL) SELECT code, pre AS prerequisite_code, {_level('code')} AS level, {_level('pre')} AS prerequisite_level, {_in_order('code', 'pre')} AS in_order, {_in_order('code', 'pre', True)} AS in_order_by_first_year FROM p",
    "semi_join_known_ids": _SCORED + "SELECT match_id FROM m WHERE e IN (SELECT e FROM l WHERE e IS NOT NULL) AND t IN (SELECT t FROM r WHERE t IS NOT NULL)",
    "anti_join_uncovered": f"SELECT DISTINCT {sql.code('bncc_code')} AS bncc_code FROM bncc_standards WHERE {sql.code('bncc_code')} NOT IN (SELECT {sql.code('habilidade_code')} FROM bncc_cc_standard_matches WHERE {sql.code('habilidade_code')} IS NOT NULL)",
    "left_join_attach": _SCORED + "SELECT a.source, count(*) AS components, count(b.n) AS matched, CAST(coalesce(sum(b.n), 0) AS BIGINT) AS match_rows FROM (SELECT t, min(source) AS source FROM r WHERE t IS NOT NULL GROUP BY t) a LEFT JOIN (SELECT t, count(*) AS n FROM m WHERE t IS NOT NULL GROUP BY t) b USING (t) GROUP BY a.source",
    "lookup_last_wins": _SCORED + "SELECT e AS bncc_component_id, t AS cc_component_id, tier, match_id FROM lm",
    "lookup_first_wins": _SCORED + "SELECT t AS component_id, description, row_id FROM r WHERE t IS NOT NULL QUALIFY row_number() OVER (PARTITION BY t ORDER BY row_id) = 1",
    "membership_pct": _SCORED + "SELECT substr(h, 1, 2) AS stage, count(*) AS n, count(x.t) AS shared, floor(100.0 * count(x.t) / count(*) * 10.0 + 0.5) / 10.0 AS pct FROM l LEFT JOIN (SELECT DISTINCT t FROM r WHERE t IS NOT NULL) x ON x.t = l.e WHERE l.e IS NOT NULL GROUP BY 1",
    "count_by_3": "SELECT stage, subject_code, subject, count(*) AS n FROM bncc_standards GROUP BY ALL",
    "value_counts": "SELECT source, count(*) AS n FROM documents GROUP BY source",
    "nunique": _SCORED + "SELECT count(DISTINCT s) AS standards, count(DISTINCT t) AS components, count(DISTINCT source) AS sources FROM r",
    "group_size_stats": _SCORED + "SELECT count(*) AS groups, floor(avg(n) * 10000.0 + 0.5) / 10000.0 AS mean_size, median(n) AS median_size, min(n) AS min_size, max(n) AS max_size FROM nl WHERE h IS NOT NULL",
    "survivorship_dedup": "SELECT row_id, bncc_code, grade FROM bncc_standards WHERE description_pt IS NOT NULL AND subject IS NOT NULL QUALIFY row_number() OVER (PARTITION BY subject, description_pt ORDER BY coalesce(len(regexp_extract_all(grade, '\\d+º')), 0) DESC, row_id) = 1",
    "keep_first_dedup": f"SELECT {sql.code('bncc_code')} AS bncc_code, row_id, grade FROM bncc_standards WHERE {sql.code('bncc_code')} IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {sql.code('bncc_code')} ORDER BY row_id) = 1",
    "union_corpora": "SELECT count(*) AS texts, CAST(sum(length(description)) AS BIGINT) AS chars FROM (SELECT description FROM bncc_components UNION SELECT description FROM cc_components_full) WHERE description IS NOT NULL",
    "json_props_flatten": "SELECT event_id, event_type, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
    "label_filter_orient": "SELECT DISTINCT CASE WHEN event_type = 'click' THEN k ELSE user_id END AS node, CASE WHEN event_type = 'click' THEN user_id ELSE k END AS prerequisite FROM (SELECT event_type, user_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE event_type IN ('click', 'view'))",
    "code_parse": f"""WITH c AS (SELECT row_id, {sql.code('bncc_code')} AS code FROM bncc_standards),
p AS (SELECT *, substr(code, 1, 2) AS st, substr(code, 3, 2) AS gr, regexp_extract(code, '^..\\d\\d([A-Z]+)', 1) AS su, regexp_extract(code, '(\\d+)$', 1) AS nu FROM c)
SELECT row_id, code, st AS stage, gr AS grade, CASE WHEN code IS NOT NULL THEN su END AS subject, CASE WHEN code IS NOT NULL THEN nu END AS number, coalesce({_VALID}, false) AS valid,
CASE WHEN code IS NULL THEN NULL WHEN su = 'EF' THEN CASE WHEN st = 'EI' THEN '{grammar.EARLY_EF}' ELSE '{grammar.LATER_EF}' END ELSE {_case(grammar.SUBJECT_NAMES, 'su', 'su')} END AS subject_name,
{_case(_LABELS, 'st || gr', 'gr')} AS grade_label, {_level('code')} AS level FROM p""",
    "text_clean": f"SELECT doc_id, CAST(length({_SQUEEZE}) AS INTEGER) AS n_clean, md5({_SQUEEZE}) AS clean_md5, length({_SQUEEZE}) < 5 AS near_empty FROM documents",
    "text_truncate": "SELECT record_id, CASE WHEN length(description_pt) > 110 THEN left(description_pt, 110) || '…' ELSE description_pt END AS short, 'h' || CASE WHEN record_id < 10000 THEN lpad(CAST(record_id AS VARCHAR), 4, '0') ELSE CAST(record_id AS VARCHAR) END AS key, CASE WHEN bncc_code IS NOT NULL AND lower(trim(bncc_code)) NOT IN ('', 'nan', 'none') THEN bncc_code ELSE left(md5(description_pt), 8) END AS lookup FROM bncc_translated",
    "line_explode": "SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no, CAST(length(lines[i]) AS INTEGER) AS n_chars, md5(lines[i]) AS line_md5 FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)) WHERE trim(lines[i], ' ') <> ''",
    "resume_todo": "SELECT doc_id, source, CAST((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 20 AS INTEGER) AS batch FROM (SELECT doc_id, coalesce(source, '') AS source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM doc_labels))",
    "tfidf_weights": _TFIDF + "SELECT side, id AS doc_id, count(*) AS terms, floor(sum(weight * weight) * 1e6 + 0.5) / 1e6 AS norm, max(floor(weight * 1e6 + 0.5) / 1e6) AS top_weight FROM v GROUP BY side, id",
    "tfidf_topk": _TFIDF + "SELECT left_id, right_id, similarity, place FROM o WHERE place <= 20",
    "auto_merge": _TFIDF + _DECIDED + "SELECT bncc_component_id, cc_component_id, similarity, match_tier FROM decided",
    "cosine_topk_blocked": """WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings), n AS (SELECT *, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm FROM e),
k AS (SELECT a.vec_id AS left_id, b.vec_id AS right_id, floor(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) / (a.norm * b.norm) * 1e6 + 0.5) / 1e6 AS similarity FROM n a JOIN n b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0)
SELECT left_id, right_id, similarity, place FROM (SELECT *, CAST(row_number() OVER (PARTITION BY left_id ORDER BY similarity DESC, right_id) AS INTEGER) AS place FROM k) WHERE place <= 5""",
    "search_filter": f"SELECT record_id, {sql.code('bncc_code')} AS code, subject FROM bncc_translated WHERE stage = 'EF' AND subject IN ('Matemática', 'Ciências') ORDER BY code NULLS FIRST, record_id LIMIT 100",
    "search_ranked": f"""WITH i AS (SELECT record_id, {sql.code('bncc_code')} AS code, subject, description_pt FROM bncc_translated),
g AS (SELECT record_id, code, {_sql_gap('code', 'simetrias')} AS a, {_sql_gap('description_pt', 'simetrias')} AS b, {_sql_gap('subject', 'simetrias')} AS c FROM i)
SELECT record_id, code, floor((2.0::DOUBLE * a + b + 0.5::DOUBLE * c) / 3.5::DOUBLE * 1e6 + 0.5) / 1e6 AS distance FROM g WHERE least(a, b, c) <= 0.35 ORDER BY distance, code NULLS FIRST, record_id LIMIT 100""",
    "nested_documents": _SCORED
    + f""", sk AS (SELECT DISTINCT {sql.code('bncc_code')} AS code FROM bncc_translated WHERE {sql.code('bncc_code')} IS NOT NULL),
cm AS (SELECT h AS code, count(*) AS n, count(*) FILTER (WHERE coalesce(tier, 'none') <> 'none') AS k FROM l LEFT JOIN lm USING (e) WHERE e IS NOT NULL AND h IS NOT NULL GROUP BY h),
b AS (SELECT h AS code, s, floor(score * 1e4 + 0.5) / 1e4 AS score FROM rk WHERE rank = 1), pl AS ({_PRE}),
u AS (SELECT code, string_agg(DISTINCT pre, ',' ORDER BY pre) AS x FROM pl WHERE pre IS NOT NULL GROUP BY code), dn AS (SELECT pre AS code, string_agg(DISTINCT code, ',' ORDER BY code) AS x FROM pl WHERE pre IS NOT NULL GROUP BY pre)
SELECT sk.code, CAST(coalesce(cm.n, 0) AS INTEGER) AS n_components, CAST(coalesce(cm.k, 0) AS INTEGER) AS n_matched, b.s AS best_standard, b.score AS best_score, coalesce(u.x, '') AS prerequisites, coalesce(dn.x, '') AS unlocks, u.x IS NOT NULL OR dn.x IS NOT NULL AS has_prereq_data
FROM sk LEFT JOIN cm USING (code) LEFT JOIN b USING (code) LEFT JOIN u USING (code) LEFT JOIN dn USING (code)""",
    "best_match_blend": f"""WITH s AS (SELECT {sql.code('habilidade_code')} AS h, {sql.uid('cc_standard_id')} AS i, score, n_bncc_components - n_none AS yes, n_bncc_components AS n FROM bncc_cc_standard_matches WHERE score BETWEEN 0 AND 1 AND NOT isnan(score) AND n_bncc_components > 0),
o AS (SELECT * FROM s WHERE yes IS NOT NULL QUALIFY row_number() OVER (PARTITION BY h, i ORDER BY score DESC, yes DESC, n DESC) = 1),
b AS (SELECT h, i, floor((0.7::DOUBLE * yes / n + 0.3::DOUBLE * score) * 1e6 + 0.5) / 1e6 AS blend FROM o)
SELECT h AS habilidade_code, i AS cc_standard_id, blend, CASE WHEN blend >= 0.7 THEN 'direct' WHEN blend >= 0.4 THEN 'partial' ELSE 'no-direct-equivalent' END AS match_quality FROM b QUALIFY row_number() OVER (PARTITION BY h ORDER BY blend DESC, i) = 1""",
    "grade_window_candidates": f"""WITH c AS (SELECT DISTINCT {sql.code('bncc_code')} AS code FROM bncc_standards), p AS (SELECT code, regexp_extract(code, '^..\\d\\d([A-Z]+)', 1) AS su, {_level('code', True)} AS level FROM c WHERE code IS NOT NULL)
SELECT a.code, a.level, count(*) - 1 AS candidates FROM p a JOIN p b ON a.su = b.su AND b.level BETWEEN a.level - 2 AND a.level + 2 GROUP BY a.code, a.level""",
    "source_audit": _SCORED + ", f AS (SELECT t, source FROM r WHERE t IS NOT NULL QUALIFY row_number() OVER (PARTITION BY t ORDER BY row_id) = 1) SELECT coalesce(tier, 'all') AS tier, coalesce(source, 'all') AS source, count(*) AS n FROM m JOIN f USING (t) WHERE tier IS NOT NULL GROUP BY ROLLUP (tier, source)",
}
