import pytest
from pyspark.sql import functions as F

from alinea.functions import clean, grammar, text


def one(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.select("i", f(F.col("v")).alias("x")).orderBy("i").select("x").collect()]


def test_codes(spark):
    values = ["EF12LI02", " ef03lp.01", "EM13-LP-04", "(EI01CG03)", "EF​03LP14", "\xa0EF03MA14", "EF03LP", "EF3LP01", None, "", "EM13LGG1234567", "EM13LGG12345678"]
    assert one(spark, values, clean.clean_code) == ["EF12LI02", "EF03LP01", "EM13LP04", "EI01CG03", "EF03LP14", "EF03MA14", None, None, None, None, "EM13LGG1234567", None]


def test_ids(spark):
    good = "01ed96e5-7255-0f75-d396-591ca4a9b2a4"
    values = [good, good.upper(), "{" + good + "}", "urn:uuid:" + good, good.replace("-", ""), f"  {good}\r\n", "\xa0" + good.upper(), good[:-1], good[:8] + "-bz" + good[11:], None, "NaN"]
    assert one(spark, values, clean.clean_id) == [good] * 7 + [None] * 4


def test_null_words_and_blanks(spark):
    assert one(spark, ["x", " ", "\xa0", "NaN", " null ", "None", "NONE", None], clean.null_if_blank) == ["x", None, None, None, None, None, "NONE", None]


def test_opening_code(spark):
    values = ["(EF02LI225)\nTestar", "[EF02AR115] Relacionar", "( ef12er.14) Comparar", "EF89LP08: Ler", "EF67LP18 – Ler", "Ler (EF67LP18)", "Em 10 de maio", None]
    assert one(spark, values, clean.opening_code) == ["EF02LI225", "EF02AR115", "EF12ER14", "EF89LP08", "EF67LP18", "", "", ""]


@pytest.mark.parametrize(
    ("label", "years"),
    [("6º–9º ano", 4), ("6º ao 9º ano", 4), ("1º, 2º e 3º anos", 3), ("9o ano", 1), ("1°-3° (Ensino Médio)", 3), ("Bebês (0–1a6m)", 1), ("Crianças bem pequenas (1 ano e 7 meses a 3 anos e 11 meses)", 1), ("3o e 4o anos", 2), (None, 0), (" ", 0), ("NaN", 0), ("livre", 1), ("9º-6º", 2)],
)
def test_grade_years(spark, label, years):
    assert one(spark, [label], clean.grade_years) == [years]


def test_grammar(spark):
    codes = ["EI01EF02", "EF69EF01", "EM13LGG03", "EF01XX01", "EI04EO01", None]
    assert one(spark, codes, grammar.is_valid_code) == [True, True, True, False, False, False]
    assert one(spark, codes, grammar.subject_name)[:4] == [grammar.EARLY_EF, grammar.LATER_EF, "Linguagens e suas Tecnologias", "XX"]
    assert one(spark, codes, grammar.grade_level) == [1, 79, 20, 11, 4, None]
    assert one(spark, codes, lambda c: grammar.grade_level(c, True)) == [1, 16, 20, 11, 4, None]


def test_grade_order(spark):
    pairs = [("EF01MA01", "EI03EO01", True), ("EF02MA01", "EF05MA01", False), ("EM13MAT01", "EF15MA01", False), ("EF15MA01", "EM13MAT01", True), ("??", "EF05MA01", True), ("EM13LP01", "EM13LP02", True)]
    df = spark.createDataFrame(pairs, "a string, b string, ok boolean")
    assert df.filter(grammar.grade_order_ok(F.col("a"), F.col("b")) != F.col("ok")).count() == 0


def test_texts(spark):
    assert one(spark, ["  a\xa0\n b ", None], text.squeeze) == ["a b", ""]
    assert one(spark, ["(X1) a\nb", "a"], lambda c: text.coded_text(c, "text")) == ["a\nb", ""]
    assert one(spark, ['```json\n{"a": 1}\n```', 'Sure: {"a": 1} ok', "none"], text.reply_json) == ['{"a": 1}', '{"a": 1}', None]
    assert one(spark, ['<a href="x">&'], text.html_escape) == ["&lt;a href=&quot;x&quot;&gt;&amp;"]
    assert one(spark, ["abc", "abcdef"], lambda c: text.shorten(c, 3)) == ["abc", "abc…"]
    assert one(spark, ["Ação de X", None], text.tokens) == [["ação", "de"], []]
