from alinea.functions.text import reply_json
from alinea.operators import annotate, classify


def lists(spark):
    near = [("a", "x", 0.95, 1), ("b", "x", 0.8, 1), ("b", "y", 0.7, 2), ("c", "y", 0.3, 1), ("d", "y", 0.6, 1)]
    nearest = spark.createDataFrame(near, "left_id string, right_id string, similarity double, place int")
    texts = spark.createDataFrame([("x", "text x"), ("y", None)], "right_id string, right_text string")
    left = spark.createDataFrame([(i, f"text {i}") for i in "abcde"], "left_id string, left_text string")
    return left, classify.candidate_lists(nearest, texts)


def test_every_component_has_a_row(spark, rows):
    got = rows(classify.classify(*lists(spark), classify.similarity_backend()))
    assert got == [("a", "x", 0.95, "merge"), ("b", "x", 0.8, "link_regional"), ("c", "y", 0.3, "none"), ("d", "y", 0.6, "link"), ("e", None, None, "none")]


def test_choices_failures_and_broken_replies(spark, rows):
    def second(batch):
        return {r["key"]: {"tier": "link", "cc_idx": len(r["candidates"]) - 1} for r in batch}

    assert ("b", "y", 0.8, "link") in rows(classify.classify(*lists(spark), second))

    def out_of_range(batch):
        return {r["key"]: {"tier": "link", "cc_idx": 7} for r in batch}

    def broken(batch):
        return {r["key"]: {"tier": "same"} for r in batch}

    def silent(batch):
        return {}

    def down(batch):
        raise OSError("down")

    for backend in (out_of_range, broken, silent, down):
        got = rows(classify.classify(*lists(spark), backend, attempts=2, wait=0.0))
        assert got == [("a", "x", 0.95, "merge"), ("b", "x", 0.8, "none"), ("c", "y", 0.3, "none"), ("d", "y", 0.6, "none"), ("e", None, None, "none")]


def test_apply_merges(spark, rows):
    comps = spark.createDataFrame([(1, "a", "old"), (2, "a", "other"), (3, "b", "b"), (4, None, "n"), (5, "c", "c")], "row_id int, element string, description string")
    matches = spark.createDataFrame([("a", "x", "merge", 2), ("a", "y", "merge", 5), ("b", "x", "link", 1), ("c", "z", "merge", 3), (None, "x", "merge", 4), ("b", None, "merge", 6)], "element string, target string, tier string, ord int")
    texts = spark.createDataFrame([("x", "text x"), ("y", "text y")], "target string, right_text string")
    out, shared = classify.apply_merges(comps, matches, texts)
    assert rows(out) == [(1, "x", "text x"), (2, "x", "text x"), (3, "b", "b"), (4, None, "n"), (5, "z", None)]
    assert rows(shared, "ord", "element") == [(1, "b"), (2, "x"), (3, "z"), (4, "x"), (5, "y"), (6, "b")]


def test_empty_tables(spark):
    left, known = lists(spark)
    assert classify.classify(left.limit(0), known, classify.similarity_backend()).count() == 0
    assert {r["match_tier"] for r in classify.classify(left, known.limit(0), classify.similarity_backend()).collect()} == {"none"}


def test_prompt_and_reply(spark):
    df = spark.createDataFrame([("EF01", 'Here: ```json\n{"a": {"b": 1}}\n``` ok'), (None, "no object")], "code string, reply string")
    from pyspark.sql import functions as F

    got = df.select(annotate.fill("Skill {code}!", code=F.col("code")).alias("p"), reply_json(F.col("reply")).alias("r")).collect()
    assert [tuple(r) for r in got] == [("Skill EF01!", '{"a": {"b": 1}}'), (None, None)]
