"""Rows selected by counting: the same as sorting everything, without ranking or writing anything."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark import batch_delete, batch_update
from tidemark.operators import first_rows, identity, topn
from tidemark.operators.topn import Order, nth_row

SCHEMA = "id long, a int, b string, c double, d decimal(9,2), at timestamp, raw binary, list array<int>"


@pytest.fixture(scope="module")
def data():
    random.seed(6)
    maybe = lambda v: v if random.random() < 0.9 else None
    return [(i, maybe(random.randrange(9)), maybe(random.choice(["x", "y", "", "ab"])), maybe(random.choice([1.5, -2.0, float("inf"), 0.0])), maybe(Decimal(random.randrange(500)) / 100),
             maybe(dt.datetime(2020, 3, 29, random.randrange(24), 0, 0, random.randrange(3))), maybe(bytes([random.randrange(4)])), [i % 2]) for i in range(3000)]


@pytest.fixture(params=[(topn._SAMPLE, topn._CUTS), (64, 7), (16, 3)])
def small(request, monkeypatch):
    monkeypatch.setattr(topn, "_SAMPLE", request.param[0])
    monkeypatch.setattr(topn, "_CUTS", request.param[1])


def _sorted(data, *by):
    """``by``: place, whether rising, whether NULL first."""
    for at, rising, nulls_first in reversed(by):
        some = sorted([r for r in data if r[at] is not None], key=lambda r: r[at], reverse=not rising)
        none = [r for r in data if r[at] is None]
        data = none + some if nulls_first else some + none
    return data


ORDERS = [
    (lambda: [F.col("a").desc(), F.col("id").asc()], [(1, False, False), (0, True, True)]),
    (lambda: [F.col("b"), F.col("c").desc_nulls_first(), "id"], [(2, True, True), (3, False, True), (0, True, True)]),
    (lambda: [F.col("d").asc_nulls_last(), F.col("at").desc(), F.col("raw"), F.col("id").desc()], [(4, True, False), (5, False, False), (6, True, True), (0, False, False)]),
    (lambda: ["id"], [(0, True, True)]),
]


@pytest.mark.parametrize("columns, by", ORDERS)
def test_against_a_sort(spark, data, small, columns, by):
    df, columns = spark.createDataFrame(data, SCHEMA).repartition(5), columns()
    want = [r[0] for r in _sorted(sorted(data), *by)]
    for n, offset in ((10, 5), (1500, 700), (5000, 2990), (4, 3000)):
        found = first_rows(df, columns, n, offset).select("id").collect()
        assert sorted(r[0] for r in found) == sorted(want[offset:offset + n])
    order = Order(df, columns, unique=True)
    for n in (1, 1234, 3000):
        assert nth_row(df, order, n).values[[b[0] for b in by].index(0)] == want[n - 1]
    assert nth_row(df, order, 3001) is None


def test_equal_rows_are_counted(spark, small):
    df = spark.createDataFrame([(1, "x")] * 700 + [(2, "y")] * 9000 + [(3, None)] * 50, "k int, v string").repartition(4)
    counts = lambda *a: {r["k"]: r["n"] for r in first_rows(df, ["k"], *a).groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts(5) == {1: 5} and counts(701) == {1: 700, 2: 1} and counts(6000, 100) == {1: 600, 2: 5400}
    assert counts(5000, 800) == {2: 5000} and counts(100, 9699) == {2: 1, 3: 50} and counts(10_000) == {1: 700, 2: 9000, 3: 50}
    assert first_rows(df, ["k"], 0).count() == 0 == first_rows(df.limit(0), ["k"], 5).count()


def test_only_ties_differ(spark, small):
    """Rows equal in the order but not otherwise: as many as asked for, the same ones each time, none twice."""
    df = spark.range(4000).select(F.lit(1).alias("k"), "id")
    taken = [rows(first_rows(df.repartition(p), ["k"], 1234), "id") for p in (2, 7)]
    assert taken[0] == taken[1] and len(set(taken[0])) == 1234


def test_nothing_is_ranked_or_joined(spark, data, monkeypatch):
    monkeypatch.setattr(identity, "stage", None)
    df = spark.createDataFrame(data, SCHEMA)
    done = batch_delete(df, key=["id"], order_by=[F.col("a").desc()], limit=100, where="c > 0")
    kept = _sorted(sorted(r for r in data if r[3] is not None and r[3] > 0), (1, False, False))[:100]
    assert rows(done.affected, "id") == sorted((r[0],) for r in kept) and done.result.count() == 2900
    plan = done.result._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan and "Window" not in plan


def test_order_columns_named_like_a_lookups(spark):
    from tidemark.operators.batch import Lookup

    t = spark.createDataFrame([(i, i % 3, 0) for i in range(30)], "id int, ref int, price int")
    other = spark.createDataFrame([(0, 5), (1, 6), (2, 7)], "ref int, price int")
    done = batch_update(t, {"price": F.col("o.price")}, "o.price > 5", lookups=[Lookup("o", other, {"ref": "ref"})],
                        key=["id"], order_by=[F.col("price").desc(), F.col("id").desc()], limit=4)
    assert {r["id"]: r["price"] for r in done.affected.collect()} == {29: 7, 28: 6, 26: 7, 25: 6}
    assert {r["id"]: r["price"] for r in done.result.collect() if r["price"]} == {29: 7, 28: 6, 26: 7, 25: 6}


def test_refused(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    with pytest.raises(ValueError, match="plain values"):
        Order(df, ["list"])
    with pytest.raises(ValueError, match="negative"):
        first_rows(df, ["id"], -1)
