import datetime as dt
import unicodedata

from pyspark.sql import functions as F

from alinea.llm import survivorship as sv

COLUMNS = "record_id long, bncc_code string, stage string, grade string, subject string, description_pt string, description_en string, loaded_at timestamp_ntz, n int, part string"
TEXT = "Comparar usos da água, segundo critérios combinados, com apoio de lupas e bandejas, em uma carta aberta, com até 20 registros."
OTHER = ["Explicar fontes de calor em uma linha do tempo.", "Registrar usos da água em critérios combinados, em um mapa."]


def skill(i, text=TEXT, code="EF05CI01", subject="Ciências", grade="5º ano", en="x", day=1, stage="EF"):
    return (i, code, stage, grade, subject, text, en, dt.datetime(2024, 1, day), 0, "p")


def losers(spark, records):
    members, survivors = sv.duplicate_groups(spark.createDataFrame(records, COLUMNS))
    return sorted(tuple(r) for r in sv.losers(members, survivors).collect())


def filler(n=30):
    """Texts that make the words known, so that slips are rare words among them."""
    words = ["Comparar", "usos", "água", "segundo", "critérios", "combinados", "apoio", "lupas", "bandejas", "carta", "aberta", "registros"]
    return [skill(1000 + i, f"{' '.join(words)} número {i} de {OTHER[i % 2]}") for i in range(n)]


VARIANTS = [
    TEXT.upper(),
    "(EF05CI01) " + TEXT,
    "EF05CI01 – " + TEXT,
    TEXT.encode().decode("latin-1"),
    "<p>" + TEXT.replace("é", "&eacute;").replace(", ", ",\xa0") + "</p>",
    TEXT.replace(" ", "  ").replace(".", ""),
    "﻿" + TEXT.replace("combinados", "combi\xadnados"),
    TEXT.replace("combinados", "combiandos").replace("registros", "regisstros"),
    TEXT.replace(", com até 20 registros.", " [...]"),
    unicodedata.normalize("NFD", TEXT),
]


def test_same_skill_however_written(spark):
    records = [skill(1), *(skill(2 + i, t) for i, t in enumerate(VARIANTS)), *filler()]
    assert losers(spark, records) == [(2 + i, 1) for i in range(len(VARIANTS))]


def test_other_skills(spark):
    others = [TEXT.replace("20", "200"), TEXT.replace("com apoio", "sem apoio"), TEXT.replace("Comparar", "Descrever"), TEXT.replace(", com até 20 registros", ""), None, " "]
    assert losers(spark, [skill(1), *(skill(2 + i, t) for i, t in enumerate(others)), *filler()]) == []


def test_subjects(spark):
    records = [skill(1), skill(2, subject="Geografia"), skill(3, subject=None), skill(4, subject="CI", code=None), skill(5, subject=" CIENCIAS "), skill(6, subject=None, code=None)]
    assert losers(spark, records) == [(3, 1), (4, 1), (5, 1)]
    ef = [skill(1, code="EI01EF01", subject="EF", stage="EI"), skill(2, code="EI01EF02", subject=None, stage="EI"), skill(3, code="EF01EF01", subject="EF"), skill(4, code=None, subject="Educação Física"), skill(5, code=None, subject="Escuta, fala, pensamento e imaginação")]
    assert losers(spark, ef) in ([(2, 1), (4, 3), (5, 1)], [(2, 1), (3, 4), (5, 1)])


def test_survivor(spark):
    cases = [
        ([{}, {"grade": "5º ao 7º ano", "en": None}], 2),
        ([{"en": " "}, {}], 2),
        ([{"day": 1}, {"day": 2}], 2),
        ([{}, {}], 1),
        ([{"grade": None}, {"grade": "Bebês", "en": None, "code": None}], 2),
    ]
    records = [skill(10 * k + i, f"{k} {TEXT}", **kw) for k, (pair, _) in enumerate(cases, 1) for i, kw in enumerate(pair, 1)]
    assert losers(spark, records) == [(10 * k + 3 - w, 10 * k + w) for k, (_, w) in enumerate(cases, 1)]


def test_field_by_field(spark):
    records = [skill(1, code=" ef05ci.01", grade="5º", subject="CI", en=None, day=9), skill(2, code="EF05CI01", grade="4º, 5º", en="old", day=1), skill(3, code=None, grade=None, subject=None, en="new", day=5, text=TEXT[:-1])]
    records[2] = (*records[2][:1], "EF05CI02", *records[2][2:])
    _, survivors = sv.duplicate_groups(spark.createDataFrame(records, COLUMNS))
    r = survivors.collect()[0]
    assert (r["n"], r["survivor_id"], r["best_grade"], r["best_subject"], r["best_text_en"]) == (3, 2, "4º, 5º", "Ciências", "new")
    assert r["best_code"] == "EF05CI02" and r["best_text_pt"] == TEXT


def test_hot_group_and_empty(spark):
    records = [skill(i) for i in range(500)] + [skill(900 + i, f"Texto {i} próprio") for i in range(50)]
    got = losers(spark, records)
    assert len(got) == 499 and {s for _, s in got} == {0}
    assert losers(spark, []) == []


def test_long_text(spark):
    long = " ".join(f"palavra{i}" for i in range(20_000))
    assert losers(spark, [skill(1, long), skill(2, long.upper())]) == [(2, 1)]


def test_ambiguous_slip_takes_its_neighbours(spark):
    known = [skill(10 + i, f"em visitas ao pátio {i}") for i in range(30)] + [skill(60 + i, f"pontos de vista distintos {i}") for i in range(30)]
    texts = spark.createDataFrame([(k, r[5]) for k, r in enumerate([*known, skill(1, "em vistas ao pátio 3")])], "id int, t string").select("id", sv.plain_words(F.col("t")).alias("w"))
    fixed = {r["id"]: r["w"] for r in sv.repair_spelling(texts, "id", "w").collect()}
    assert fixed[60] == ["em", "visitas", "ao", "patio", "3"] and fixed[0] == ["em", "visitas", "ao", "patio", "0"]


def test_longer_texts_without_full_stop_complete_cut_ones(spark):
    cut, bare = TEXT.replace(", com até 20 registros.", " [...]"), TEXT.rstrip(".")
    assert losers(spark, [skill(1, bare), skill(2, cut), *filler()]) == [(2, 1)]
    between = TEXT.replace(" registros.", "")
    assert losers(spark, [skill(1, bare), skill(2, cut), skill(3, between), *filler()]) == [(2, 1), (3, 1)]
    assert losers(spark, [skill(1), skill(2, cut), skill(3, between), *filler()]) == [(2, 1), (3, 1)]
    # An ellipsis is no whole text.
    assert losers(spark, [skill(1, TEXT.replace(" registros.", "...")), skill(2, cut), *filler()]) == []


def test_short_cut_texts(spark):
    assert losers(spark, [skill(1, "Ler mapas da cidade."), skill(2, "Ler mapas..."), skill(3, "Ver mapas..."), *filler()]) == [(2, 1)]
