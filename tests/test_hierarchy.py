import random

import pytest

from alinea.operators import hierarchy
from alinea.operators.hierarchy import ancestor_pairs, resolve_hierarchy

LINKS = "child string, parent string, parent_code string, code string"


def tree(spark, links, stride=4):
    df = spark.createDataFrame([(c, p, "x", "y") for c, p in links], LINKS)
    return resolve_hierarchy(df, "child", "parent", stride)


def brute(links):
    parent = {}
    for c, p in links:
        for x in (c, p):
            if x is not None:
                parent.setdefault(x, None)
        if c is not None and p is not None:
            parent[c] = min(p, parent[c] or p)
    out = set()
    for code in parent:
        path, x = [code], code
        while parent[x] is not None and len(path) <= len(parent) + 1:
            x = parent[x]
            path.append(x)
        out.add((code, "CYCLE", -1) if len(path) > len(parent) else (code, x, len(path) - 1))
    return out


@pytest.mark.parametrize("stride", [1, 2, 8])
def test_against_brute_force(spark, rows, stride):
    rng = random.Random(stride)
    links = [(f"n{i}", f"n{rng.randrange(max(0, i - 3), i)}") for i in range(1, 60)]
    links += [("a", "b"), ("b", "c"), ("c", "a"), ("d", "a"), ("s", "s"), ("e", "d")]
    links += [("n7", None), ("lone", None), (None, "top"), (None, None), links[3], links[3]]
    got = tree(spark, links, stride)
    assert set(rows(got, "code", "root_code", "depth")) == brute(links)
    assert got.count() == got.select("code").distinct().count()


def test_paths_and_pairs(spark, rows):
    got = tree(spark, [("b", "a"), ("c", "b"), ("d", "b")], 2)
    assert rows(got.selectExpr("code", "array_join(path, '>') as p")) == [("a", "a"), ("b", "a>b"), ("c", "a>b>c"), ("d", "a>b>d")]
    assert rows(ancestor_pairs(got)) == [("a", "b", 1), ("a", "c", 2), ("a", "d", 2), ("b", "c", 1), ("b", "d", 1)]


def test_several_parents_and_hot_parent(spark, rows):
    got = tree(spark, [("k", "z"), ("k", "y")] + [(f"c{i}", "y") for i in range(300)])
    assert rows(got.filter("code = 'k'"), "root_code", "depth") == [("y", 1)]
    assert got.filter("root_code = 'y' and depth = 1").count() == 301


def test_empty_and_only_cycles(spark, rows):
    assert tree(spark, [], 2).count() == 0
    assert rows(tree(spark, [("a", "b"), ("b", "a")], 2), "code", "root_code", "depth") == [("a", "CYCLE", -1), ("b", "CYCLE", -1)]


def test_further_parents(spark, rows):
    links = spark.createDataFrame([("c", "b"), ("c", "a"), ("c", "a"), ("c", None), ("d", "c"), (None, "z")], "child string, parent string")
    assert rows(hierarchy.further_parents(links, "child", "parent")) == [("c", "a", "b")]
