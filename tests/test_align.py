import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from alinea.operators import dedup, matching, projection, scoring, serve


def jaccard(spark, left, matches, right):
    l = spark.createDataFrame(left, "left_id string, element string")
    m = spark.createDataFrame([(*x, i) for i, x in enumerate(matches)], "element string, target string, tier string, ord long")
    r = spark.createDataFrame([(*x, i) for i, x in enumerate(right)], "right_id string, target string, ord long")
    return scoring.weighted_jaccard(l, m, r)


def test_weighted_jaccard(spark, rows):
    got = jaccard(spark, [("H", "a"), ("H", "b"), ("H", "c")], [("a", "x", "merge"), ("b", "y", "link"), ("c", "z", "none")], [("S1", "x"), ("S1", "y"), ("S1", "q"), ("S1", "r"), ("S2", "z")])
    assert rows(got, "left_id", "right_id", "score", "n_merge", "n_link", "n_none") == [("H", "S1", 0.272727, 1, 1, 0)]


def test_jaccard_repeats_and_shared(spark, rows):
    got = jaccard(spark, [("H", "a"), ("H", "a")], [("a", "x", "link"), ("a", "x", "merge")], [("S1", "x"), ("S2", "x"), ("S2", "w"), ("S2", "v"), ("S2", "u")])
    assert rows(got, "right_id", "score", "n_merge") == [("S2", 0.5, 2)]
    assert jaccard(spark, [], [], []).count() == 0


def test_projection(spark, rows):
    edges = spark.createDataFrame([("s", "p"), ("t", "p"), (None, "p")], "node string, prerequisite string")
    m = spark.createDataFrame([("s", "EF05MA01", 0.5), ("t", "EF05MA01", 0.08), ("p", "EF02MA01", 0.3), ("p", "EF05MA01", 0.9), ("p", "EF09MA01", 0.9), ("t", "EF03MA01", 0.079999)], "node string, code string, score double")
    got = projection.project_edges(edges, m)
    assert rows(got) == [("EF05MA01", "EF02MA01", 2, 0.5, 0.3, "s", "p")]
    rels = spark.createDataFrame([("isPre", "s", "t"), ("hasPre", "s", "t"), ("hasPre", "t", "s"), ("other", "s", "t")], "label string, src string, tgt string")
    assert rows(projection.orient_edges(rels, "label", "src", "tgt", "isPre", "hasPre")) == [("s", "t"), ("t", "s")]


def greedy(items, least=0.82):
    kept = [t for _, t, g in items if g]
    ids = [i for i, _, g in items if g]
    for i, t, g in sorted(items):
        if not g and not any(SequenceMatcher(None, t, k).ratio() > least for k in kept):
            kept.append(t)
            ids.append(i)
    return sorted(ids)


@pytest.mark.parametrize("seed", range(4))
def test_greedy_near_duplicates(spark, seed):
    rng = random.Random(seed)
    base = ["explain plant cycles by causes", "record old crafts in trios", "compare maps of the area"]
    items = []
    for i in range(40):
        t = list(rng.choice(base))
        for _ in range(rng.randrange(9)):
            t[rng.randrange(len(t))] = rng.choice("abcdefg")
        items.append((i, "".join(t).strip(), rng.random() < 0.2))
    items += [(100 + i, *items[i][1:]) for i in range(5)]
    df = spark.createDataFrame([("g", i, " " + t.upper() + " ", g, "k") for i, t, g in items], "grp string, ord long, txt string, guard boolean, _keep2 string")
    for block in (2000, 9):  # one walk; blocks against blocks
        got = dedup.greedy_near_duplicates(df, "grp", "txt", "ord", 0.82, "guard", block=block)
        assert sorted(r["ord"] for r in got.collect()) == greedy(items)


def test_greedy_edges(spark):
    empty = spark.createDataFrame([], "grp string, ord long, txt string")
    assert dedup.greedy_near_duplicates(empty, "grp", "txt", "ord").count() == 0
    nulls = spark.createDataFrame([(None, 1, None), (None, 2, None), ("g", 3, "x")], "grp string, ord long, txt string")
    assert sorted(r["ord"] for r in dedup.greedy_near_duplicates(nulls, "grp", "txt", "ord").collect()) == [1, 3]


def test_widest_grade(spark, rows):
    df = spark.createDataFrame([("m", "t", "6º", 1), ("m", "t", "6º, 7º, 8º", 2), ("m", "t", "7º, 8º, 9º", 3), ("n", "t", None, 4)], "s string, d string, g string, ord long")
    assert rows(dedup.widest_grade(df, ["s", "d"], "g", "ord"), "s", "ord") == [("m", 2), ("n", 4)]


def test_cosine_prefix_is_exact(spark):
    import numpy as np

    rng = random.Random(3)
    words = [f"w{i}" for i in range(25)] + ["the"] * 20
    text = lambda: " ".join(rng.choice(words) for _ in range(8))
    l = spark.createDataFrame([(f"l{i}", text()) for i in range(40)] + [("lx", None), ("ly", "")], "i string, t string")
    r = spark.createDataFrame([(f"r{i}", text()) for i in range(40)], "i string, t string")
    v = matching.tfidf(matching.term_counts(l, "i", "t"), matching.term_counts(r, "i", "t")).toPandas()
    m = v.pivot_table(index=["side", "doc_id"], columns="term", values="weight", fill_value=0.0)
    sims = m.loc["l"].to_numpy() @ m.loc["r"].to_numpy().T
    assert np.allclose(np.linalg.norm(m.to_numpy(), axis=1), 1)
    want = {(a, b) for i, a in enumerate(m.loc["l"].index) for j, b in enumerate(m.loc["r"].index) if sims[i, j] >= 0.3}
    got = matching.cosine_top(matching.tfidf(matching.term_counts(l, "i", "t"), matching.term_counts(r, "i", "t")), 100, 0.3)
    assert {(x["left_id"], x["right_id"]) for x in got.collect()} == want and want


def test_cosine_nearest_has_no_floor(spark):
    import numpy as np

    rng = random.Random(4)
    words = [f"w{i}" for i in range(30)] + ["the"] * 20
    text = lambda: " ".join(rng.choice(words) for _ in range(rng.randrange(2, 9)))
    l = spark.createDataFrame([(f"l{i:02}", text()) for i in range(40)] + [("lx", None), ("ly", ""), ("lz", "unheard things"), ("lzz", "unheard things")], "i string, t string")
    r = [(f"r{i:02}", text()) for i in range(60)]
    r = spark.createDataFrame(r + [(f"s{i:02}", r[3][1]) for i in range(12)], "i string, t string")
    both = lambda: matching.tfidf(matching.term_counts(l, "i", "t"), matching.term_counts(r, "i", "t"))
    m = both().toPandas().pivot_table(index=["side", "doc_id"], columns="term", values="weight", fill_value=0.0)
    sims = np.floor(m.loc["l"].to_numpy() @ m.loc["r"].to_numpy().T * 1e6 + 0.5) / 1e6
    for k, shards in ((1, (1 << 15, 1 << 16)), (8, (1 << 15, 1 << 16)), (8, (7, 11))):
        want = {}
        for i, a in enumerate(m.loc["l"].index):
            want[a] = [(b, s) for s, b in sorted((-s, b) for s, b in zip(sims[i], m.loc["r"].index))[:k]]
        got = {}
        for x in sorted(matching.cosine_nearest(both(), k, *shards).collect(), key=lambda x: x["place"]):
            got.setdefault(x["left_id"], []).append((x["right_id"], -x["similarity"]))
        assert got == want and len(got) == 42
    assert [s for _, s in got["lz"]] == [0] * 8


def test_auto_merge_has_every_tier_and_component(spark, monkeypatch):
    from alinea.plans import align_queries

    ids = [f"00000000-0000-4000-8000-00000000000{i}" for i in range(5)]
    tables = {
        "bncc_components": spark.createDataFrame([(0, "EF01MA01", ids[0], "count coins"), (1, "EF01MA01", ids[1], "count big coins"), (2, "EF01MA01", ids[2], "sing songs"), (3, "EF01MA01", ids[3], None)], "row_id long, habilidade_code string, component_id string, description string"),
        "cc_components_full": spark.createDataFrame([(0, ids[4], ids[4], "lc", "count coins")], "row_id long, standard_id string, component_id string, source string, description string"),
    }
    monkeypatch.setattr(align_queries, "table", lambda s, d, name, *columns: tables[name].select(*columns))
    got = {r["bncc_component_id"]: (r["cc_component_id"], r["match_tier"]) for r in align_queries.auto_merge(spark, "").collect()}
    assert got == {ids[0]: (ids[4], "merge"), ids[1]: (ids[4], "none"), ids[2]: (ids[4], "none"), ids[3]: (None, "none")}


def test_documents_and_search(spark, rows):
    skills = spark.createDataFrame([("A", "EF", "1º", "Arte", "Ler mapas"), ("B", "EF", "2º", "Arte", "Ver simetria")], "code string, stage string, grade string, subject string, description_pt string")
    comps = spark.createDataFrame([("A", "c1", "d", "none", "x"), ("A", "c2", "d", "merge", "y")], "code string, id string, description string, match_tier string, cc_component_id string")
    best = spark.createDataFrame([("A", "s1", 0.12345, 1), ("A", "s9", 0.1, 9)], "code string, standard_id string, score double, rank int")
    pre = spark.createDataFrame([("B", "A")], "code string, prerequisite_code string")
    docs = {r["code"]: r for r in serve.skill_documents(skills, comps, best, pre).collect()}
    assert [(c["id"], c["cc_component_id"]) for c in docs["A"]["components"]] == [("c1", None), ("c2", "y")]
    assert [(m["rank"], m["score"]) for m in docs["A"]["cc_matches"]] == [(1, 0.1235)]
    assert docs["A"]["unlocks"] == ["B"] and docs["B"]["prerequisites"] == ["A"] and docs["B"]["components"] == []
    index = skills.withColumn("record_id", F.lit(1))
    assert [r["code"] for r in serve.search_ranked(index, "simetrias").collect()] == ["B"]
    assert serve.search_ranked(index, "s").count() == 0
    assert serve.search_filter(index, "EF", ["Arte"]).count() == 2 and serve.lookup(index, "Z").count() == 0
