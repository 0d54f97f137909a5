import json
import zipfile

import pytest
from pyspark.sql import functions as F

from alinea.operators import annotate as an
from alinea.operators.curriculum import parse_early, parse_primary, parse_secondary
from alinea.sources import readers, rest, sinks
from alinea.streaming.resume import annotate_stream


def test_csv(spark, tmp_path, rows):
    p = tmp_path / "a.csv"
    p.write_text('﻿id,t\n1,"a ""q"",\nb"\n2,NA\n3,\n', encoding="utf-8")
    assert rows(readers.read_csv(spark, str(p), "id int, t string")) == [(1, 'a "q",\nb'), (2, None), (3, None)]
    assert readers.read_csv(spark, str(tmp_path / "no.csv"), "id int", allow_missing=True).count() == 0
    (tmp_path / "empty.csv").write_text("")
    assert readers.read_csv(spark, str(tmp_path / "empty.csv"), "id int", allow_missing=True).count() == 0
    sinks.write_csv(spark.createDataFrame([(1, "x\ny")], "id int, t string"), str(tmp_path / "out"))
    part = next((tmp_path / "out").glob("part-*"))
    assert part.read_bytes().startswith(b"\xef\xbb\xbfid,t")
    assert rows(readers.read_csv(spark, str(tmp_path / "out"), "id int, t string")) == [(1, "x\ny")]


def test_json_lines_and_graph(spark, tmp_path, rows):
    both = {"identifier": "n1", "labels": ["Std", "Cmp"], "properties": {"jurisdiction": "M", "statementCode": None}}
    comp = {"identifier": "n2", "labels": ["Cmp"], "properties": {"name": "c"}}
    (tmp_path / "n.jsonl").write_text("\n".join(["", json.dumps(both), "{bad", json.dumps(comp), " "]))
    good, bad = readers.read_json_lines(spark, str(tmp_path / "n.jsonl"), readers.GRAPH_NODE)
    assert rows(bad) == [("{bad",)] and good.count() == 2
    standards, components = readers.graph_nodes(good, "Std", "Cmp", "M")
    assert rows(standards, "identifier", "statement_code", "description") == [("n1", None, "")]
    assert rows(components, "identifier", "name") == [("n2", "c")]
    edges = spark.createDataFrame([("n1", "n2"), ("n1", "n9")], "source_identifier string, target_identifier string")
    assert readers.known_ends(edges, standards, components).count() == 1
    assert readers.count_lines(spark, str(tmp_path / "n.jsonl")) == 5


def test_pages_and_retry():
    calls = []

    def fetch(url):
        calls.append(url)
        if len(calls) == 1:
            raise rest.RetryableError("busy")
        return {"data": [{"n": len(calls)}], "pagination": {"hasMore": len(calls) < 4, "nextCursor": str(len(calls))}}

    real, rest.time.sleep = rest.time.sleep, lambda s: None
    try:
        assert [x["n"] for x in rest.pages("http://x", "r", {}, fetch)] == [2, 3, 4]
        assert "cursor=3" in calls[-1]
        with pytest.raises(RuntimeError):
            list(rest.pages("http://x", "r", {}, lambda u: {"data": [], "pagination": {"hasMore": True, "nextCursor": "c"}}, most_pages=3))
        with pytest.raises(rest.RetryableError):
            rest.get("u", lambda u: (_ for _ in ()).throw(rest.RetryableError("x")), attempts=2)
    finally:
        rest.time.sleep = real


def test_paged_source_over_files(spark, tmp_path):
    import functools
    import http.server
    import threading

    (tmp_path / "a").write_text(json.dumps({"data": [{"n": 1}, {"n": 2}], "pagination": {"hasMore": False}}))
    (tmp_path / "b").write_text(json.dumps({"data": []}))

    class Quiet(http.server.SimpleHTTPRequestHandler):
        def log_message(self, *args):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), functools.partial(Quiet, directory=str(tmp_path)))
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    spark.dataSource.register(rest.PagedSource)
    df = spark.read.format("paged_rest").option("base", base).option("resources", "a,b,missing").load()
    assert sorted((r["resource"], json.loads(r["item"])["n"]) for r in df.collect()) == [("a", 1), ("a", 2)]
    keys = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    assert rest.enrich(keys, "k", base, "{key}", 2).count() == 2
    server.shutdown()


def test_curriculum(spark, rows):
    early = {"educacao_infantil": {"campos_experiencia": [{"faixas_etarias": [{"nome_faixa": "Bebês", "objetivos": [{"codigo": "EI01EO01", "descricao": " a  b "}, {"codigo": "XX", "descricao": ""}]}]}]}}
    primary = {"arte": {"ano": [{"nome_ano": ["6º", "7º"], "unidades_tematicas": [{"nome_unidade": "U", "objeto_conhecimento": [{"nome_objeto": "O", "habilidades": [{"nome_habilidade": "(EF67AR01) Ler\nmais"}, {"nome_habilidade": "sem código"}]}]}]}]}, "versao": 3}
    secondary = {"ling": {"ano": [{"nome_ano": "", "codigo_habilidade": [{"nome_codigo": "EM13LGG01", "nome_habilidade": "x"}]}]}}
    make = lambda d: spark.createDataFrame([(json.dumps(d),), (None,), ("{",)], "p string")
    cols = ("bncc_code", "grade", "subject", "description_pt", "thematic_unit", "knowledge_object")
    assert rows(parse_early(make(early), "p"), *cols) == [("EI01EO01", "Bebês", "O eu, o outro e o nós", "a b", "", "")]
    assert rows(parse_primary(make(primary), "p"), *cols) == [("EF67AR01", "6º, 7º", "Arte", "Ler mais", "U", "O")]
    assert rows(parse_secondary(make(secondary), "p"), *cols) == [("EM13LGG01", "1º–3º ano (Ensino Médio)", "Linguagens e suas Tecnologias", "x", "", "")]


def test_annotate_and_contracts(spark):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(50)], "id long, t string").repartition(3)

    def backend(batch):
        if any(r["t"] == "t7" for r in batch):
            return {"only": 1}
        return {r["key"]: {"up": r["t"].upper()} for r in batch}

    got = an.annotate(df, "id", ["t"], backend, batch_size=5, attempts=2, wait=0.0).collect()
    failed = [r for r in got if r["error"]]
    assert len(got) == 50 and 1 <= len(failed) <= 5 and all(r["reply"] is None for r in failed)
    assert json.loads(next(r["reply"] for r in got if r["id"] == 3 or (r["id"] == 40 and r["reply"])))["up"] in ("T3", "T40")
    assert an.check_tier({"tier": "link", "cc_idx": 9}, 3) == ("none", None)
    assert an.check_tier({"tier": "link", "cc_idx": 1}, 3) == ("link", 1)
    with pytest.raises(an.ContractError):
        an.check_tier({"tier": "bad"}, 3)
    with pytest.raises(an.ContractError):
        an.check_reply([], ["a"])
    assert an.replay_backend({"a": 1})([{"key": "a"}, {"key": "b"}]) == {"a": 1}


def test_batches_and_resume(spark, tmp_path, rows):
    df = spark.createDataFrame([(i, "s" if i < 5 else "u") for i in range(8)], "id long, p string")
    assert rows(an.numbered_batches(df, "p", "id", 2).groupBy("p", "batch").count()) == [("s", 0, 2), ("s", 1, 2), ("s", 2, 1), ("u", 0, 2), ("u", 1, 1)]
    out = str(tmp_path / "done")
    assert sinks.remaining(spark, df, out, "id").count() == 8
    for _ in range(2):
        sinks.append_batch(df.filter("id < 3"), out, "b1")
    sinks.append_batch(df.filter("id = 4"), out, "b2")
    assert spark.read.parquet(out).count() == 4 and sinks.remaining(spark, df, out, "id").count() == 4


def test_stream_resumes(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    df = spark.createDataFrame([(i, f"t{i}") for i in range(6)], "id long, t string")
    mark = lambda b: b.withColumn("reply", F.upper("t")).withColumn("error", F.when(F.col("id") == 5, "x"))
    df.filter("id < 4").write.parquet(src)
    annotate_stream(spark, src, df.schema, "id", mark, out, cp).awaitTermination()
    df.filter("id >= 2").write.mode("append").parquet(src)
    annotate_stream(spark, src, df.schema, "id", mark, out, cp).awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [0, 1, 2, 3, 4]
    heal = lambda b: b.withColumn("reply", F.upper("t")).withColumn("error", F.lit(None).cast("string"))
    annotate_stream(spark, src, df.schema, "id", heal, out, cp).awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [0, 1, 2, 3, 4, 5]


def test_stream_after_an_outage(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    df = spark.createDataFrame([(i, f"t{i}") for i in range(4)], "id long, t string")
    df.write.parquet(src)
    for error, want in (("down", []), (None, [0, 1, 2, 3]), (None, [0, 1, 2, 3])):
        reply = lambda b, e=error: b.withColumn("reply", F.upper("t")).withColumn("error", F.lit(e).cast("string"))
        annotate_stream(spark, src, df.schema, "id", reply, out, cp).awaitTermination()
        got = spark.read.schema("id long, reply string").parquet(out)
        assert sorted(r["id"] for r in got.collect()) == want


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("A", None, 1), ("B", "<b>", 2)], "code string, t string, n int")
    sinks.write_documents(df, "code", str(tmp_path / "docs"))
    assert json.loads(next((tmp_path / "docs" / "key=A").glob("part-*")).read_text()) == {"code": "A", "t": None, "n": 1}
    sinks.write_lines(df, str(tmp_path / "index"))
    assert spark.read.text(str(tmp_path / "index")).count() == 2
    sinks.write_workbook({"One": df, "Two": df.limit(0)}, str(tmp_path / "w.xlsx"))
    with zipfile.ZipFile(tmp_path / "w.xlsx") as z:
        sheet = z.read("xl/worksheets/sheet1.xml").decode()
        assert "&lt;b&gt;" in sheet and sheet.count("<row>") == 3 and "xl/worksheets/sheet2.xml" in z.namelist()
    with pytest.raises(ValueError):
        sinks.write_workbook({"One": df}, str(tmp_path / "x.xlsx"), most_rows=1)
    assert sinks.write_version(df, str(tmp_path / "v"), "1").endswith("version=1")
