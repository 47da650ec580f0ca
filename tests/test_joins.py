"""Joins with unbound variables against brute force over all pairs."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from graphloom.operators import joins as j, modifiers as m


def compatible(a, b, on):
    return all(a[c] is None or b[c] is None or a[c] == b[c] for c in on)


def agree(a, b, on):
    return any(a[c] is not None and b[c] is not None for c in on)


def merged(a, b, columns):
    return tuple(a.get(c) if a.get(c) is not None else b.get(c) for c in columns)


def table(seed, names, n=14):
    rng = random.Random(seed)
    out = [{c: (rng.choice([None, "a", "b"]) if c in "xy" else f"{c}{i}") for c in names} for i in range(n)]
    return out + out[:2]


def frame(spark, data, names):
    return spark.createDataFrame([tuple(r[c] for c in names) for r in data], ", ".join(f"{c} string" for c in names))


@pytest.fixture(params=[("x", "xz"), ("xu", "xyz"), ("xyu", "xyz")], ids=["one", "one-of-two", "two"])
def sides(request, spark):
    left, right = request.param
    if left == "x":
        left = "xu"
    a, b = table(1, left), table(2, right)
    on = [c for c in left if c in right]
    return a, b, on, frame(spark, a, left), frame(spark, b, right), list(left), list(right)


def test_compatible_join(sides):
    a, b, on, left, right, lc, rc = sides
    columns = lc + [c for c in rc if c not in lc]
    want = sorted((merged(x, y, columns) for x, y in itertools.product(a, b) if compatible(x, y, on)), key=repr)
    assert rows(j.compat_join(left, right), *columns) == want


def test_optional(sides):
    a, b, on, left, right, lc, rc = sides
    columns = lc + [c for c in rc if c not in lc]
    want = []
    for x in a:
        hits = [merged(x, y, columns) for y in b if compatible(x, y, on)]
        want += hits or [merged(x, {}, columns)]
    assert rows(j.optional_join(left, right), *columns) == sorted(want, key=repr)


def test_minus_and_exists(sides):
    a, b, on, left, right, lc, _ = sides
    cells = lambda x: tuple(x[c] for c in lc)
    minus = [cells(x) for x in a if not any(compatible(x, y, on) and agree(x, y, on) for y in b)]
    has = [cells(x) for x in a if any(compatible(x, y, on) for y in b)]
    has_not = [cells(x) for x in a if not any(compatible(x, y, on) for y in b)]
    assert rows(j.minus(left, right)) == sorted(minus, key=repr)
    assert rows(j.where_exists(left, right)) == sorted(has, key=repr)
    assert rows(j.where_not_exists(left, right)) == sorted(has_not, key=repr)
    flags = j.exists_flag(left, right, "hit").collect()
    assert sorted(r["hit"] for r in flags) == [False] * len(has_not) + [True] * len(has)


def test_no_shared_variable(spark):
    left = spark.createDataFrame([("a",), (None,)], "x string")
    right = spark.createDataFrame([("1",)], "z string")
    empty = right.where("false")
    assert rows(j.minus(left, right)) == rows(left)
    assert rows(j.optional_join(left, empty)) == [("a", None), (None, None)]
    assert rows(j.optional_join(left, right)) == [("a", "1"), (None, "1")]
    assert j.where_exists(left, empty).count() == 0 and j.where_exists(left, right).count() == 2
    assert j.where_not_exists(left, empty).count() == 2
    assert rows(j.exists_flag(left, right, "e"), "e") == [(True,), (True,)]
    with pytest.raises(ValueError):
        j.product(left, left)


def test_empty_sides(spark):
    left = spark.createDataFrame([("a",), (None,)], "x string")
    none = left.where("false")
    assert j.compat_join(left, none).count() == 0
    assert rows(j.optional_join(left, none)) == rows(left)
    assert rows(j.minus(left, none)) == rows(left)
    assert j.where_not_exists(left, none).count() == 2


def test_plain_keys_use_one_equi_join(spark):
    left, right = spark.range(5).toDF("k"), spark.range(3).toDF("k")
    plan = j.compat_join(left, right)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.count("Join Inner") == 1


def test_modifiers(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, None), (2, "b"), (3, "a")], "k int, v string")
    assert [r.k for r in m.order_by(df, "v").collect()] == [1, 3, 2]
    assert [r.k for r in m.order_by(df, ("v", "desc")).collect()] == [2, 3, 1]
    assert [r.k for r in m.limit(m.order_by(df, "k"), 1, offset=1).collect()] == [2]
    assert rows(m.filter_rows(df, F.col("k") - 1), "k") == [(2,), (3,)]
    assert m.ask(df.where("k > 9")).first()["result"] is False
    with pytest.raises(ValueError):
        m.bind(df, "k", F.lit(1))
    inline = m.values(spark, "k int, w string", [(1, "x"), (None, "y")])
    assert rows(m.join_values(df, inline, unbound=["k"]), "k", "w") == [(1, "x"), (1, "y"), (2, "y"), (3, "y")]


def test_spread_join_deals_a_product_over_tasks(spark):
    left = spark.range(1, 3001).select(F.lit(1).alias("x"), F.col("id").alias("l")).union(spark.createDataFrame([(2, 0), (None, 9)], "x int, l bigint"))
    right = spark.range(1, 3001).select(F.lit(1).alias("x"), F.col("id").alias("r")).union(spark.createDataFrame([(2, 0), (2, 0), (None, 9)], "x int, r bigint"))
    got = j.natural_join(left, right, spread=True)
    assert got.columns == ["x", "l", "r"]
    assert rows(got.where("x <> 1")) == [(2, 0, 0), (2, 0, 0)]
    assert got.where("x = 1").distinct().count() == 9_000_000
    tasks = [r["count"] for r in got.groupBy(F.spark_partition_id().alias("t")).count().collect()]
    assert sum(tasks) == 9_000_002 and max(tasks) < 7_000_000
