import itertools
import random

import numpy as np
import pytest

from alinea.llm.mixing import fit_budget, plan_mixture, same_share

DOCS = "doc long, source string, n int, size int, repeats string"


def reachable(lengths, counts):
    return {sum(n * k for n, k in zip(lengths, ks)) for ks in itertools.product(*(range(c + 1) for c in counts))}


@pytest.mark.parametrize("seed", range(20))
def test_fit_against_brute_force(seed):
    rng = random.Random(seed)
    lengths = np.array(sorted(rng.sample(range(2, 40), 4), reverse=True))
    counts = np.array([rng.randrange(1, 6) for _ in lengths])
    total = int((lengths * counts).sum())
    budget = rng.randrange(total + 10)
    take = fit_budget(lengths, counts, budget)
    assert (take >= 0).all() and (take <= counts).all()
    # The proportional part is fixed first; the rest is the best that the remaining counts allow.
    base = same_share(counts, budget - budget // 8, total) if budget < total else counts
    assert budget >= total or 0 <= budget - budget // 8 - (lengths * base).sum() <= lengths[0]
    best = max(x for x in reachable(lengths, counts - base) if x <= budget - (lengths * base).sum()) if budget < total else 0
    assert (lengths * take).sum() == (lengths * base).sum() + best


def test_fit_large():
    rng = np.random.default_rng(1)
    lengths = np.arange(50, 3000, 7)
    counts = rng.integers(1, 5000, len(lengths))
    budget = int((lengths * counts).sum() * 0.37)
    take = fit_budget(lengths, counts, budget)
    assert (take <= counts).all() and (lengths * take).sum() == budget


def run(spark, docs, targets, **kw):
    d = spark.createDataFrame([(i, s, n, 0, "x") for i, s, n in docs], DOCS)
    t = spark.createDataFrame(targets, "source string, target_share double, max_repeats int")
    mix, shares = plan_mixture(d, t, "doc", "n", **kw)
    return mix.collect(), {r["source"]: r.asDict() for r in shares.collect()}


def test_shares_and_repeats(spark):
    rng = random.Random(5)
    docs = [(i, rng.choice("aaaaaabbc"), rng.randrange(1, 300)) for i in range(3000)] + [(9000, "other", 10), (9001, "a", 0), (9002, "a", None), (9003, None, 5)]
    targets = [("a", 0.5, 1), ("b", 0.3, 3), ("c", 0.15, 2), ("none", 0.05, 2)]
    mix, shares = run(spark, docs, targets)
    size = {i: n for i, _, n in docs}
    for s, share, most in targets:
        own = [r for r in mix if r["source"] == s]
        assert len({r["item"] for r in own}) == len(own) and all(1 <= r["repeats"] <= most for r in own)
        assert sum(size[r["item"]] * r["repeats"] for r in own) == shares[s]["reached"]
        if s != "none":
            assert abs(shares[s]["actual_share"] - share / 0.95) < 1e-3 and shares[s]["shortfall"] < 300
    assert shares["none"]["reached"] == 0 and shares["none"]["shortfall"] > 0
    assert {r["source"] for r in mix} == {"a", "b", "c"}


def test_fixed_total_with_shortfall(spark):
    mix, shares = run(spark, [(1, "a", 100), (2, "a", 100), (3, "b", 10)], [("a", 0.5, 1), ("b", 0.5, 4)], total=200)
    assert shares["a"]["reached"] == 100 and shares["b"]["reached"] == 40 and shares["b"]["shortfall"] == 60
    assert {(r["item"], r["repeats"]) for r in mix if r["source"] == "b"} == {(3, 4)}


def test_scarce_source_does_not_shrink_the_mixture(spark):
    docs = [(i, "a", 10) for i in range(900)] + [(9000, "b", 10)]
    targets = [("a", 0.75, 1), ("b", 0.25, 4)]
    mix, shares = run(spark, docs, targets)
    assert shares["a"]["reached"] == 6750 and shares["a"]["shortfall"] < 10
    assert shares["b"]["budget"] == 2252 and shares["b"]["reached"] == 40 and shares["b"]["shortfall"] == 2212
    assert len(mix) == 676 and [(r["item"], r["repeats"]) for r in mix if r["source"] == "b"] == [(9000, 4)]
    mix, shares = run(spark, docs, targets, total="no shortfall")
    assert shares["a"]["reached"] == 120 and shares["b"]["shortfall"] == 0 and len(mix) == 13


def test_equal_sizes_seed_and_empty(spark):
    docs = [(i, "a", 10) for i in range(5000)]
    mix, shares = run(spark, docs, [("a", 1.0, 1)], total=12345)
    assert len(mix) == 1234 and shares["a"]["reached"] == 12340
    again, _ = run(spark, docs[::-1], [("a", 1.0, 1)], total=12345)
    other, _ = run(spark, docs, [("a", 1.0, 1)], total=12345, seed=2)
    ids = lambda m: {r["item"] for r in m}
    assert ids(mix) == ids(again) != ids(other)
    mix, shares = run(spark, [], [("a", 1.0, 1)])
    assert mix == [] and shares["a"]["reached"] == 0
