import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from alinea.operators.references import find_orphans, orphan_report

REFS = "id long, a string, b string, at timestamp_ntz, kind_ string"
TARGETS = "x string, y string, lo timestamp_ntz, hi timestamp_ntz, id long"


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def run(spark, refs, targets, keys, **kw):
    r = spark.createDataFrame([(*x, "extra") for x in refs], REFS)
    t = spark.createDataFrame([(*x, 1) for x in targets], TARGETS)
    return find_orphans(r, t, keys, "at", "lo", "hi", **kw)


def judge(refs, targets):
    out = []
    for i, a, _, at in refs:
        own = [t for t in targets if t[0] == a and a is not None]
        if a is None or any(t[2] is not None and t[2] <= at and (t[3] is None or t[3] > at) for t in own):
            continue
        out.append((i, "missing" if not own else "deleted" if any(t[2] is not None and t[2] <= at for t in own) else "late", at.strftime("%Y-%m")))
    return sorted(out, key=str)


def test_single_key_against_brute_force(spark, rows):
    rng = random.Random(1)
    targets = [(rng.choice("pqrs"), None, rng.choice([None, day(rng.randrange(60))]), rng.choice([None, day(rng.randrange(60))])) for _ in range(25)]
    targets += [("u", None, day(1), day(5)), ("u", None, day(4), day(8)), ("u", None, day(20), day(30)), ("w", None, day(9), day(3))]
    refs = [(i, rng.choice(["p", "q", "r", "s", "u", "w", "gone", None]), None, day(rng.randrange(70))) for i in range(400)]
    refs += [refs[0], refs[0]]
    got = run(spark, refs, targets, [("a", "x")])
    assert rows(got, "id", "kind", "period") == judge(refs, targets)


@pytest.mark.parametrize(("match", "ids"), [("simple", [1, 2]), ("partial", [1, 2, 4, 6]), ("full", [1, 2, 3, 4, 5, 6])])
def test_null_masks(spark, rows, match, ids):
    targets = [("p", "1", day(0), None), ("q", "2", day(0), None)]
    refs = [(0, "p", "1", day(9)), (1, "p", "2", day(9)), (2, "z", "1", day(9)), (3, "p", None, day(9)), (4, "z", None, day(9)), (5, None, "2", day(9)), (6, None, "9", day(9)), (7, None, None, day(9))]
    got = run(spark, refs, targets, [("a", "x"), ("b", "y")], match=match)
    assert [r[0] for r in rows(got, "id")] == ids


def test_broken_values_and_report(spark, rows):
    refs = [(1, None, "damaged", day(3)), (2, None, None, day(3)), (3, "p", None, None)]
    got = run(spark, refs, [("p", None, day(0), None)], [("a", "x")], broken=F.col("b").isNotNull())
    assert rows(got, "id", "kind") == [(1, "missing")]
    assert rows(orphan_report(got.withColumn("ref_table", F.lit("t"))), "ref_table", "kind", "period", "orphans") == [("t", "missing", "2024-01", 1)]


def test_empty_tables(spark):
    assert run(spark, [], [("p", None, day(0), None)], [("a", "x")]).count() == 0
    assert run(spark, [(1, "p", None, day(0))], [], [("a", "x")], match="partial").count() == 1
    with pytest.raises(ValueError):
        run(spark, [], [], [("a", "x")], match="other")
