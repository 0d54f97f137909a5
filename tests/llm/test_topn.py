import math
import random

import pytest

from alinea.llm.topn import top_n

ROWS = "g string, item string, score double, least int, place int, level int"


def run(spark, data, n=3, **kw):
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in data], ROWS)
    return sorted((r["g"], r["item"], r["place"]) for r in top_n(df, ["g"], "item", "score", n, **kw).collect())


def brute(data, n):
    best = {}
    for g, i, s in data:
        if g is not None and i is not None and s is not None and s == s:
            best[g, i] = max(s, best.get((g, i), -math.inf))
    out = []
    for g in {k[0] for k in best}:
        ranked = sorted((-s, i) for (h, i), s in best.items() if h == g)[:n]
        out += [(g, i, p) for p, (_, i) in enumerate(ranked, 1)]
    return sorted(out)


@pytest.mark.parametrize(("seed", "large"), [(1, 1), (2, 50), (3, 10**9)])
def test_against_brute_force(spark, seed, large):
    rng = random.Random(seed)
    scores = [None, float("nan"), float("inf"), float("-inf"), 1e308, -1e308, -1.0, 1.5, 0.0, 1.0] + [round(rng.random(), 1) for _ in range(5)] + [rng.random() for _ in range(20)]
    data = [(rng.choice(["hot"] * 20 + ["a", "b", None]), rng.choice([f"i{k}" for k in range(60)] + [None]), rng.choice(scores)) for _ in range(3000)]
    assert run(spark, data, 5, large=large, bins=16) == brute(data, 5)
    assert run(spark, data, 5, large=large, broadcast_rows=0) == brute(data, 5)
    assert run(spark, data, 40, large=large, bins=16) == brute(data, 40)  # more than masks can prove


def test_ties_repeats_and_small_groups(spark):
    data = [("g", f"i{k:03}", 0.5) for k in range(400)] * 2 + [("s", "x", 0.1)]
    assert run(spark, data, 2, large=10) == [("g", "i000", 1), ("g", "i001", 2), ("s", "x", 1)]


def test_tie_by_another_column(spark):
    data = [("g", "a", 1, 9), ("g", "b", 1, 2), ("g", "b", 1, 7), ("g", "c", 1, None), ("g", "d", 0, 1), ("lo", "a", 5, 3)]
    df = spark.createDataFrame(data, "_g string, item string, score int, date int")
    got = [tuple(r) for r in top_n(df, ["_g"], "item", "score", 3, tie=["date"], large=1).select("_g", "item", "date", "place").collect()]
    assert sorted(got) == [("g", "a", 9, 3), ("g", "b", 2, 2), ("g", "c", None, 1), ("lo", "a", 3, 1)]


def test_empty_and_bounds(spark):
    assert run(spark, []) == []
    with pytest.raises(ValueError):
        run(spark, [], n=0)
