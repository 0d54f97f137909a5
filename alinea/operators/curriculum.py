"""The three layouts of curriculum documents as tables of skills."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alinea.functions.grammar import code_part, grade_label, is_valid_code, subject_name
from alinea.functions.text import coded_text, squeeze

EARLY = "struct<educacao_infantil: struct<campos_experiencia: array<struct<faixas_etarias: array<struct<nome_faixa: string, objetivos: array<struct<codigo: string, descricao: string>>>>>>>>"
_OBJECT = "struct<nome_objeto: string, habilidades: array<struct<nome_habilidade: string>>>"
PRIMARY = f"struct<ano: array<struct<nome_ano: string, unidades_tematicas: array<struct<nome_unidade: string, objeto_conhecimento: array<{_OBJECT}>>>>>>"
SECONDARY = "struct<ano: array<struct<nome_ano: string, codigo_habilidade: array<struct<nome_codigo: string, nome_habilidade: string>>>>>"


def _year_label(c: Column) -> Column:
    """A year label given as text or as a list of texts."""
    listed = F.from_json(c, "array<string>")
    return F.when(c.startswith("["), F.array_join(F.transform(listed, squeeze), ", ")).otherwise(squeeze(c))


def _disciplines(docs: DataFrame, payload: str, layout: str) -> DataFrame:
    """(d, v): the members of the top object that are objects themselves; others are skipped."""
    members = docs.select(F.explode(F.from_json(payload, "map<string,string>")).alias("d", "json"))
    return members.filter(F.col("json").startswith("{")).select("d", F.from_json("json", layout).alias("v"))


def _skills(rows: DataFrame, stage: str) -> DataFrame:
    """Rows with a valid code in the common form; the document's own label goes before the table's."""
    code = F.col("code")
    own = F.nullif(F.col("label"), F.lit(""))
    return rows.filter(is_valid_code(code, F.lit(stage))).select(
        code.alias("bncc_code"), F.lit(stage).alias("stage"), F.coalesce(own, grade_label(code)).alias("grade"), code_part(code, "grade").alias("grade_code"),
        subject_name(code).alias("subject"), code_part(code, "subject").alias("subject_code"), "description_pt", "thematic_unit", "knowledge_object", "ord",
    )


def parse_early(docs: DataFrame, payload: str) -> DataFrame:
    fields = docs.select(F.posexplode(F.from_json(payload, EARLY)["educacao_infantil"]["campos_experiencia"]).alias("a", "x"))
    bands = fields.select("a", F.posexplode("x.faixas_etarias").alias("b", "y"))
    goals = bands.select("a", "b", "y.nome_faixa", F.posexplode("y.objetivos").alias("c", "z"))
    return _skills(goals.select(squeeze(F.col("z.codigo")).alias("code"), squeeze(F.col("nome_faixa")).alias("label"), squeeze(F.col("z.descricao")).alias("description_pt"), F.lit("").alias("thematic_unit"), F.lit("").alias("knowledge_object"), F.array("a", "b", "c").alias("ord")), "EI")


def parse_primary(docs: DataFrame, payload: str) -> DataFrame:
    """The code opens the text: "(CODE) text"; texts without one, or with an invalid one, are left out."""
    disciplines = _disciplines(docs, payload, PRIMARY)
    years = disciplines.select("d", F.posexplode("v.ano").alias("a", "y"))
    units = years.select("a", "y.nome_ano", F.posexplode("y.unidades_tematicas").alias("b", "u"))
    objects = units.select("a", "nome_ano", "b", "u.nome_unidade", F.posexplode("u.objeto_conhecimento").alias("c", "o"))
    texts = objects.select("a", "b", "c", "nome_ano", "nome_unidade", "o.nome_objeto", F.posexplode("o.habilidades").alias("e", "h"))
    text = squeeze(F.col("h.nome_habilidade"))
    return _skills(texts.select(squeeze(coded_text(text, "code")).alias("code"), _year_label(F.col("nome_ano")).alias("label"), coded_text(text, "text").alias("description_pt"), squeeze(F.col("nome_unidade")).alias("thematic_unit"), squeeze(F.col("nome_objeto")).alias("knowledge_object"), F.array("a", "b", "c", "e").alias("ord")), "EF")


def parse_secondary(docs: DataFrame, payload: str) -> DataFrame:
    disciplines = _disciplines(docs, payload, SECONDARY)
    years = disciplines.select(F.posexplode("v.ano").alias("a", "y"))
    skills = years.select("a", "y.nome_ano", F.posexplode("y.codigo_habilidade").alias("b", "h"))
    return _skills(skills.select(squeeze(F.col("h.nome_codigo")).alias("code"), _year_label(F.col("nome_ano")).alias("label"), squeeze(F.col("h.nome_habilidade")).alias("description_pt"), F.lit("").alias("thematic_unit"), F.lit("").alias("knowledge_object"), F.array("a", "b").alias("ord")), "EM")


PARSERS = {"EI": parse_early, "EF": parse_primary, "EM": parse_secondary}
