"""The grammar of codes: stage, grade, subject and level, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Subject letters that each stage allows.
STAGE_SUBJECTS = {
    "EI": ("EO", "CG", "TS", "EF", "ET"),
    "EF": ("MA", "LP", "CI", "GE", "HI", "AR", "EF", "ER", "CO", "LI"),
    "EM": ("LGG", "MAT", "CNT", "CHS", "LP", "LI", "ART", "EDF", "CO"),
}
#: Names of subjects; EF in the early years is another subject.
SUBJECT_NAMES = {
    "MA": "Matemática", "LP": "Língua Portuguesa", "CI": "Ciências", "GE": "Geografia", "HI": "História", "AR": "Arte",
    "ER": "Ensino Religioso", "CO": "Computação", "LI": "Língua Inglesa", "EO": "O eu, o outro e o nós",
    "CG": "Corpo, Gestos e Movimentos", "TS": "Traços, Sons, Cores e Formas",
    "ET": "Espaços, Tempos, Quantidades, Relações e Transformações", "LGG": "Linguagens e suas Tecnologias",
    "MAT": "Matemática e suas Tecnologias", "CNT": "Ciências da Natureza e suas Tecnologias",
    "CHS": "Ciências Humanas e Sociais Aplicadas", "ART": "Arte", "EDF": "Educação Física",
}
EARLY_EF, LATER_EF = "Escuta, Fala, Pensamento e Imaginação", "Educação Física"
#: Labels of grade digits per stage.
GRADE_LABELS = {
    "EI": {"01": "Bebês (0–1a6m)", "02": "Crianças bem pequenas (1a7m–3a11m)", "03": "Crianças pequenas (4a–5a11m)"},
    "EF": {
        "01": "1º ano", "02": "2º ano", "03": "3º ano", "04": "4º ano", "05": "5º ano", "06": "6º ano", "07": "7º ano",
        "08": "8º ano", "09": "9º ano", "12": "1º–2º ano", "15": "1º–5º ano", "35": "3º–5º ano", "67": "6º–7º ano",
        "69": "6º–9º ano", "89": "8º–9º ano",
    },
    "EM": {"13": "1º–3º ano (Ensino Médio)"},
}

_PARTS = r"^(EI|EF|EM)(\d{2})([A-Z]{2,3})(\d{2,7})$"


def _lookup(pairs: dict[str, str], key: Column) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for kv in pairs.items() for x in kv)), key)


def code_part(code: Column, part: str) -> Column:
    """stage, grade, subject or number of a clean code; null where the code has no such part."""
    group = {"stage": 1, "grade": 2, "subject": 3, "number": 4}[part]
    return F.nullif(F.regexp_extract(code, _PARTS, group), F.lit(""))


def is_valid_code(code: Column, stage: Column | None = None) -> Column:
    """True if grade and subject exist in the code's stage (and the stage is the one asked for)."""
    s, g, subject = (code_part(code, p) for p in ("stage", "grade", "subject"))
    known = F.lit(False)
    for name, subjects in STAGE_SUBJECTS.items():
        known = known | ((s == name) & subject.isin(*subjects) & g.isin(*GRADE_LABELS[name]))
    if stage is not None:
        known = known & (s == stage)
    return F.coalesce(known, F.lit(False))


def subject_name(code: Column) -> Column:
    """Name of the code's subject; its letters where they are unknown."""
    letters = code_part(code, "subject")
    ef = F.when(code_part(code, "stage") == "EI", EARLY_EF).otherwise(LATER_EF)
    return F.when(letters == "EF", ef).otherwise(F.coalesce(_lookup(SUBJECT_NAMES, letters), letters))


def grade_label(code: Column) -> Column:
    """Label of the code's grade; its digits where they are unknown."""
    stage, digits = code_part(code, "stage"), code_part(code, "grade")
    return F.coalesce(_lookup({s + g: v for s, labels in GRADE_LABELS.items() for g, v in labels.items()}, F.concat(stage, digits)), digits)


def grade_level(code: Column, strict_range: bool = False) -> Column:
    """An integer to order codes by: early years by band, then 10 + grade digits, then 20.

    Codes that span years ("69") give levels above 20 by this rule; with ``strict_range`` they count
    as their first year. Case doesn't matter. Null for codes of no stage.
    """
    up = F.upper(code)
    digits = F.regexp_extract(up, r"^E[IFM](\d{2})", 1).try_cast("int")
    if strict_range:
        digits = F.when(digits > 9, F.floor(digits / 10).cast("int")).otherwise(digits)
    return F.when(up.startswith("EI"), digits).when(up.startswith("EF"), digits + 10).when(up.startswith("EM"), 20)


def grade_order_ok(code: Column, prerequisite: Column, strict_range: bool = False) -> Column:
    """True unless the prerequisite lies above the code; unknown codes and pairs of the last stage pass."""
    a, b = grade_level(code, strict_range), grade_level(prerequisite, strict_range)
    both_last = F.upper(code).startswith("EM") & F.upper(prerequisite).startswith("EM")
    return a.isNull() | b.isNull() | both_last | (b <= a)


def grade_width(label: Column) -> Column:
    """How many single years ("6º") a label lists."""
    return F.coalesce(F.size(F.regexp_extract_all(label, F.lit(r"(\d+º)"), 1)), F.lit(0))
