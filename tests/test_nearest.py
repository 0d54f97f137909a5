import time

import numpy as np
import pyarrow as pa
import pytest

from alinea.operators.matching import _nearest


def texts(rows):
    """rows: (text, {term: weight})."""
    ids = [i for i, _ in rows]
    return pa.table({
        "block": pa.array(["all"] * len(rows)), "text_id": pa.array([i.encode() for i in ids]), "first_id": pa.array(ids),
        "terms": pa.array([sorted(x) for _, x in rows], pa.list_(pa.int64())), "weights": pa.array([[x[t] for t in sorted(x)] for _, x in rows], pa.list_(pa.float64())),
    })


def unit(terms):
    return dict.fromkeys(terms, 1 / np.sqrt(len(terms)))


def slots(rng, n, name):
    """Texts of one term from each of 30 slots of 20 terms, and two terms in all texts."""
    return [(f"{name}{i:05}", unit([*(np.arange(30) * 20 + rng.integers(0, 20, 30)).tolist(), 900, 901])) for i in range(n)]


@pytest.mark.parametrize("cells", [0, 1 << 10, 1 << 23])
@pytest.mark.parametrize("k", [1, 5, 20])
def test_against_all_pairs(cells, k):
    rng = np.random.default_rng(3)
    rare = [(f"r9{i:04}", unit([1000 + i, 1001 + i])) for i in range(40)]
    right = [*slots(rng, 400, "r"), *rare, ("r9999", unit([1000]))]
    left = [*slots(rng, 70, "l"), ("l8", unit([1010, 1011])), ("l9", unit([5000])), ("l99", unit([900, 1000]))]
    got = _nearest(k, cells, 16)(texts(left), texts(right)).to_pylist()
    want = []
    for i, x in left:
        scored = [(-np.floor(sum(x[t] * y.get(t, 0.0) for t in x) * 1e6 + 0.5) / 1e6, j) for j, y in right]
        want += [(i, j, -s) for s, j in sorted(scored)[:k]]
    assert [(r["left_text"].decode(), r["first_id"], r["similarity"]) for r in got] == want


def test_similarities_that_round_to_nothing_tie_with_those_of_no_common_term():
    left, right = [("l", {1: 1.0})], [("a", {2: 1.0}), ("b", {1: 1e-8, 2: 1.0}), ("c", {1: 1e-8, 3: 1.0})]
    got = _nearest(2)(texts(left), texts(right)).to_pylist()
    assert [(r["first_id"], r["similarity"]) for r in got] == [("a", 0.0), ("b", 0.0)]


def test_costs_a_few_times_the_adding_up_of_every_list_at_most():
    rng = np.random.default_rng(4)
    left, right = texts(slots(rng, 201, "l")), texts(slots(rng, 20_000, "r"))
    run = _nearest(5)
    times = []
    for part in (left.slice(0, 1), left):
        began = time.process_time()
        run(part, right)
        times.append(time.process_time() - began)
    terms = right.column("terms").combine_chunks().flatten().to_numpy()
    rows = {int(t): np.flatnonzero(terms == t) // 32 for t in np.unique(terms)}
    began = time.process_time()
    for own in left.column("terms").to_pylist()[:50]:
        sums = np.zeros(20_000)
        for t in own:
            sums[rows[t]] += 0.03 * np.full(len(rows[t]), 0.2)
    plain = 4 * (time.process_time() - began)
    assert times[1] - times[0] < 8 * plain
