import random

import pytest

from alinea.llm.packing import pack, sum_of_squares
from alinea.llm.tokens import count_tokens


def brute_place(sizes, capacity):
    """The same rule with the sum of squares worked out anew for every gap."""
    gaps, place = [], []
    for s in sizes:
        def total(after):
            open_ = [g for g in after if 0 < g < capacity]
            return sum(open_.count(g) ** 2 for g in set(open_))

        options = []
        for g in sorted({x for x in gaps if s <= x < capacity}):
            k = max(i for i, x in enumerate(gaps) if x == g)
            options.append((total([*gaps[:k], g - s, *gaps[k + 1 :]]), g))
        options.append((total([*gaps, capacity - s]), capacity))
        place.append(min(options))
        g = place[-1][1]
        if g == capacity:
            gaps.append(capacity - s)
        else:
            gaps[next(i for i, x in enumerate(gaps) if x == g)] = g - s
    return place, gaps


@pytest.mark.parametrize("seed", range(5))
def test_rule_against_brute_force(seed):
    rng = random.Random(seed)
    sizes = [rng.randrange(1, 21) for _ in range(120)]
    bins = sum_of_squares(sizes, 20)
    fills = [sum(s for s, b in zip(sizes, bins) if b == k) for k in range(max(bins) + 1)]
    _, gaps = brute_place(sizes, 20)
    assert max(fills) <= 20 and sorted(20 - f for f in fills) == sorted(gaps)


def check(rows, capacities, sizes):
    for name, cap in capacities.items():
        own = [r for r in rows if r["capacity_name"] == name]
        for i, s in sizes.items():
            mine = sorted((r for r in own if r["item"] == i), key=lambda r: r["piece"])
            assert sum(r["size"] for r in mine) == (s or 0)
            assert [r["piece"] for r in mine] == list(range(len(mine)))
            assert len(mine) == max(1, -(-(s or 0) // cap))
        fill = {}
        for r in own:
            if r["container"] is not None:
                fill[r["container"]] = fill.get(r["container"], 0) + r["size"]
        assert all(v <= cap for v in fill.values())
        assert all(r["fill"] == fill.get(r["container"], 0) for r in own)
        yield name, sum(fill.values()) / (cap * len(fill)) if fill else 1.0


def test_pack(spark):
    rng = random.Random(2)
    sizes = {i: rng.choice([None, 0, 1, 50, 200, 700, 1000, rng.randrange(1, 3000)]) for i in range(2000)}
    capacities = {"a": 100, "b": 1000}
    df = spark.createDataFrame([(i, s, 1, "x") for i, s in sizes.items()], "item_id long, n int, size int, container string")
    got = pack(df, "item_id", "n", capacities, per_shard=700).collect()
    fills = dict(check(got, capacities, sizes))
    assert fills["a"] > 0.97 and fills["b"] > 0.95
    again = pack(df.repartition(7), "item_id", "n", capacities, per_shard=700).collect()
    assert sorted(got, key=str) == sorted(again, key=str)


def test_pack_edges(spark):
    df = spark.createDataFrame([], "item_id long, n int")
    assert pack(df, "item_id", "n", {"a": 10}).count() == 0
    ties = spark.createDataFrame([(i, 5) for i in range(100)] + [(5, 5)], "item_id long, n int")
    got = pack(ties, "item_id", "n", {"a": 10}).collect()
    assert len(got) == 101 and len({r["container"] for r in got}) == 51


def test_token_counts(spark):
    from tokenizers import Tokenizer

    from alinea.llm.tokens import TOKENIZER

    own = Tokenizer.from_file(TOKENIZER)
    long = "Comparar usos da água, 20 vezes.\n\n  It's fine " * 20_000
    texts = [None, "", " ", "Olá, mundo!", long, "x" * 200_000, "<|endoftext|>", "a​ b"]
    df = spark.createDataFrame([(i, t, 0, "z") for i, t in enumerate(texts)], "id int, text string, size int, tokens_ string")
    got = {r["id"]: r["tokens"] for r in count_tokens(df, "text").collect()}
    own.encode_special_tokens = True
    assert got == {i: len(own.encode(t, add_special_tokens=False).ids) if t else 0 for i, t in enumerate(texts)}
