import json

from alinea.operators.nested import shred

KEYS = ("doc_id", "entry", "parent", "places", "value")


def parts(spark, payloads, **kw):
    df = spark.createDataFrame([(i, p, "x", "y") for i, p in enumerate(payloads)], "raw int, payload string, entry string, element string")
    return shred(df, "raw", "payload", **kw)


def test_tables_and_links(spark, rows):
    doc = {"art": {"year": [{"label": ["1", "2"], "unit": {"name": "u", "skill": [{"text": "a"}, None, "b"]}}, None, {"label": "3", "unit": [{"name": "v", "object": [{"skill": {"text": "c", "note": {"by": "x"}}}]}]}]}, "version": 2}
    p = parts(spark, [json.dumps(doc)])
    assert {n for n in p.shape.parents if p.shape.needs_table(n)} == {"year", "label", "unit", "object", "skill"}
    skills = p.table("skill")
    assert rows(skills, *KEYS, "text", "note_by") == [
        (0, "art", "object", [0, 2, 0, 0, 0], None, "c", "x"),
        (0, "art", "unit", [0, 0, 0, 0], None, "a", None),
        (0, "art", "unit", [0, 0, 0, 2], "b", None, None),
    ]
    assert rows(p.table("label"), "places", "value") == [([0, 0, 0], "1"), ([0, 0, 1], "2"), ([0, 2, 0], "3")]
    assert rows(p.table("unit"), "places", "position", "name") == [([0, 0, 0], 0, "u"), ([0, 2, 0], 0, "v")]


def test_wrapped_broken_and_empty(spark, rows):
    good = {"a": {"b": [1, 2]}}
    payloads = ["﻿" + json.dumps(good), json.dumps(json.dumps(good)), '{"a" 1}', "", None, "<html>", "[]", "null", json.dumps({"a": None, "c": []}), '{"a": {"b": [1'] + [json.dumps(good)] * 2
    p = parts(spark, payloads)
    assert [r[0] for r in rows(p.table("b"), "doc_id")] == [0, 0, 1, 1, 10, 10, 11, 11]


def test_wrapped_many_times_and_rejects(spark, rows):
    payloads, text = [], json.dumps({"a": {"b": 1}})
    for _ in range(6):
        payloads.append(text)
        text = json.dumps(text)
    p = parts(spark, [*payloads, None, " ", "{", "[1]", json.dumps(json.dumps("no JSON in here")), json.dumps(json.dumps(json.dumps("nor here")))])
    assert [r[0] for r in rows(p.table("entry"), "doc_id")] == [0, 1, 2, 3, 4, 5]
    assert rows(p.rejects(), "doc_id", "reason") == [(10, "unreadable"), (11, "unreadable"), (6, "empty"), (7, "empty"), (8, "unreadable"), (9, "no object")]


def test_deep_documents(spark):
    deep = {"end": "x"}
    for i in range(40):
        deep = {f"n{i}": deep}
    p = parts(spark, [json.dumps({"a": deep})])
    assert p.table("entry").count() == 1 and len(p.levels) >= 40


def test_empty_table_and_recursion(spark, rows):
    assert parts(spark, []).table("entry").count() == 0
    p = parts(spark, [json.dumps({"a": {"node": {"name": "x", "node": {"name": "y"}}}})])
    assert p.shape.needs_table("node")
    assert rows(p.table("node"), "path", "name") == [(["entry", "node", "node"], "y"), (["entry", "node"], "x")]


def test_one_list_valued_name_keeps_the_others(spark, rows, monkeypatch):
    import duckdb

    from alinea.plans import data_queries

    def payload(skill, unit="u", thing="o"):
        return json.dumps({"arte": {"ano": [{"nome_ano": "1", "unidades_tematicas": [{"nome_unidade": unit, "objeto_conhecimento": [{"nome_objeto": thing, "habilidades": [{"nome_habilidade": skill}, "(EF01AR02) b"]}]}]}]}})

    data = [(1, payload("(EF01AR01) a")), (2, payload(["(EF01AR03) c"], ["u"], ["o", "p"])), (3, payload("(EF01AR04) d"))]
    docs = spark.createDataFrame(data, "raw_id long, payload string")
    monkeypatch.setattr(data_queries, "table", lambda s, d, name, *columns: docs.select(*columns))
    db = duckdb.connect()
    db.sql("create table bncc_fundamental (raw_id bigint, payload varchar)")
    db.executemany("insert into bncc_fundamental values (?, ?)", data)
    for name in ("p6_found", "p6_units", "p6_objects"):
        got = data_queries.QUERIES[name](spark, "")
        want = db.sql(data_queries.SQL[name])
        assert rows(got, *want.columns) == sorted(want.fetchall(), key=str), name
    found = {(r["raw_id"], r["skill_no"]): r["bncc_code"] for r in data_queries.p6_found(spark, "").collect()}
    assert found == {(1, 0): "EF01AR01", (1, 1): "EF01AR02", (2, 0): "EF01AR03", (2, 1): "EF01AR02", (3, 0): "EF01AR04", (3, 1): "EF01AR02"}
    assert {r["unit_name"] for r in data_queries.p6_units(spark, "").collect() if r["raw_id"] != 2} == {"u"}
