import random
import re

import pytest

from alinea.llm.quality import quality

PROSE = "Ao final, a professora leu em voz alta o que tinha escrito sobre os mapas do bairro. A proposta era trabalhar com a turma toda, e não apenas copiar do quadro, mas o tempo foi curto. Em seguida, cada grupo contou como fez a sua parte e o que ainda faltava para a semana que vem."
WORDS = "a o as os de da do e em no na um uma que para por com não se ao mais como mas foi sua cada".split()

CASES = {
    "prose": [PROSE, PROSE.upper(), f"<p>{PROSE}</p>", "— " + PROSE, PROSE.lower().replace(".", "").replace(",", ""), PROSE.replace(" o ", "\no ").replace(" de ", "\nde "), "﻿" + PROSE, "Mapas do bairro\n" + PROSE, PROSE.replace("ã", "a").replace("é", "e")],
    "list": [
        "- mapas do bairro\n- usos da água\n- fontes de calor\n- rotas de comércio",
        "1. Mapas do bairro.\n2. Usos da água.\n3. Fontes de calor.",
        "[ ] mapas\n[x] usos da água\n[ ] fontes",
        "Mapas do bairro\nUsos da água\nFontes de calor\nRotas de comércio",
        "Mapas: usos da água\nFontes: rotas de comércio\nGestos: lupas e bandejas",
        "mapas do bairro, usos da água, fontes de calor, rotas de comércio, lupas e bandejas",
        "mapas do bairro; usos da água, segundo a origem; fontes de calor; rotas de comércio, em trios",
        "EF04LI170 EF69GE278 EF04HI393 EF05HI30",
        "Mapas do bairro .............. 10\nUsos da água ................. 12",
    ],
    "table": [
        "code\tgroup\tscore\nEF04LI170\tA1\t2,4\nEF04LI171\tA2\t2,5",
        "code;group;score\nEF04LI170;A1;2,4\nEF04LI171;A2;2,5",
        '"code","group"\n"EF04LI170","A1"\n"EF04LI171","A2"',
        "| code | group |\n| --- | --- |\n| EF04LI170 | A1 |",
        "+------+------+\n| code | x    |\n+------+------+\n| EF04 | A1   |\n+------+------+",
        "code: EF04LI170\ngroup: A1\nscore: 2,4\n\ncode: EF04LI171\ngroup: A2\nscore: 2,5",
        "<table>\n<tr><td>code</td><td>group</td></tr>\n<tr><td>EF04LI170</td><td>A1</td></tr>\n</table>",
        "70.1 35.75 62.59 3.2\n61.73 55.814 60.519 39.24",
        "code      group     score\nEF04LI170    A1      2,4\nEF04LI171    A2      2,5",
    ],
    "junk": [
        "Voltar ao topo " * 40,
        (PROSE[:86] + "\n") * 12,
        "aaaaaaaaaaaaaaaa ################ kkkkkkkkkkkk !!!!!!!!!!!!",
        "data:image/png;base64," + "hCZvinRA5DHU7TAmB0E1T2yh7Ab5ULFG5O6xJRbspK7clZFOKv3" * 6,
        "M o 0 t o f t 0 e s t 0 e n s o f t h e I m i x e d a g e",
        "Urm iasg fmxxdrd hflcr uj izhlrhaj hlbcuqaja uri zgcdpv hzaioehq zr avmv sveitxp btfsmd rdlftdbr moafeqdm nqbdajar lp cjbrbuc qffvedpxs abz lnvz zcm xud rtte qpl.",
        "2024-11-09T07:30:00 INFO step5 worker-1 code=0xd26784 retry=3\n2024-03-24T21:50:00 ERROR step10 worker-9 code=0xef01d5 retry=3",
        '<div class="c83"><script>var a0=function(x){return x+32;};</script></div>\n' * 3,
        "0e 07 09 8c 38 d8 bc 0e 20 52 40 ca 66 d8 99 f6\n19 1f e1 75 b2 5e 69 43 0c dd a3 42 d7 79 de 4d",
        "Â¤ prof�ssora§le� em ¤oz�alta§o q�e t¤nha�escr�to so§re ¤s m�pas",
    ],
}


def kinds(spark, texts):
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "id int, body string, kind string, n_words int")
    common = spark.createDataFrame([("pt", w) for w in WORDS] + [("pt", None)], "lang string, word string")
    return {r["doc_id"]: r for r in quality(df, "id", "body", common).collect()}


@pytest.mark.parametrize("kind", list(CASES))
def test_kinds(spark, kind):
    got = kinds(spark, CASES[kind])
    assert [got[i]["kind"] for i in range(len(CASES[kind]))] == [kind] * len(CASES[kind])
    # What isn't prose failed a rule; prose may have failed one that only counts words or line ends.
    assert all(r["reasons"] for r in got.values() if kind != "prose")


def test_no_text_and_repeats(spark):
    got = kinds(spark, [None, "", " \n\t\xa0", "a", "!", PROSE, PROSE])
    assert sorted(got) == [3, 4, 5, 6]
    assert kinds(spark, []) == {}


def test_measures_and_long_text(spark):
    got = kinds(spark, ["Um dia, foi.", "\n".join(f"{PROSE} {i} {i * 7}." for i in range(3000))])
    assert got[0]["n_words"] == 3 and got[0]["n_common"] == 2 and got[0]["n_common_kinds"] == 2 and got[0]["n_word_chars"] == 8
    assert got[1]["n_lines"] == 3000 and got[1]["n_punct_ends"] == 3000


def plain_counts(text):
    """Some of the counts by plain loops over one text."""
    tokens, lines = text.split(), [x.strip() for x in re.split(r"[\r\n]", text) if x.strip()]
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    fours = {tuple(words[i : i + 4]) for i in range(len(words))}
    return {
        "n_tokens": len(tokens), "n_token_chars": sum(map(len, tokens)), "n_with_letters": sum(any(c.isalpha() for c in t) for t in tokens), "n_curly": text.count("{"), "n_lines": len(lines),
        "n_marks": text.count("#") + text.count("…") + text.count("..."), "n_short_lines": sum(len(x) < 30 for x in lines), "n_repeated_lines": len(lines) - len(set(lines)),
        "n_ellipses": sum(x.endswith(("...", "…")) for x in lines), "n_words": len(words), "n_word_chars": sum(map(len, words)), "n_common": sum(w in WORDS for w in words),
        "n_common_kinds": len(set(words) & set(WORDS)), "n_fours": len(fours), "n_numbered": sum(bool(re.match(r"\d{1,3}[.)]", x)) for x in lines),
    }


def test_counts_against_plain_loops(spark):
    rng = random.Random(3)
    signs = ["a", "de", "mapas", "Água", "e", "#", "...", "…", "{", "12", "3.", "b)", ".", "\n", "\n", "\r\n", "  ", "-", "x" * 45]
    texts = [" ".join(rng.choice(signs) for _ in range(rng.randrange(1, 120))) for _ in range(200)] + [t for ts in CASES.values() for t in ts if "\ufeff" not in t and "�" not in t]
    texts = [t for t in texts if t.strip()]
    got = kinds(spark, texts)
    for i, t in enumerate(texts):
        want = plain_counts(t)
        assert {k: got[i][k] for k in want} == want, t


def test_published_rules(spark):
    many = " ".join(f"Foi para a escola {i}." for i in range(20))
    fails = {
        "few words": "Foi para a escola. Foi de novo. Foi mais.", "long mean word": "a o " + " ".join(["interdisciplinaridade."] * 60), "symbols to words": many + " # # # # # # # # # # # # # # # # # # # # #",
        "ellipsis lines": "\n".join([many] + ["Foi para a escola..."] * 3), "words without letters": many + " 1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 20 21 22 23 24 25 26 27 28 29",
        "few sentences": many.replace(".", ""), "curly bracket": many + " {", "open line ends": "\n".join(["sem ponto " * 6] * 9 + [many]), "duplicate lines": "\n".join([many] * 3),
    }
    got = kinds(spark, [many, *fails.values()])
    assert got[0]["reasons"] == []
    for i, name in enumerate(fails, 1):
        assert name in got[i]["reasons"], name
