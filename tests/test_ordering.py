import math
from decimal import Decimal, localcontext

import numpy as np
import pytest
from pyspark.sql import functions as F

from medallion.operators import ordering
from medallion.operators.ordering import approx_quantiles, exact_quantiles, neighbours, order_statistics, range_splits, running_total

PROBABILITIES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


def column(name):
    rng = np.random.default_rng(7)
    return {
        "uniform": rng.uniform(-5, 5, 3000),
        "cents": rng.integers(0, 10_000_000, 3000) / 100,
        "hot": np.where(rng.random(3000) < 0.4, 42.0, rng.normal(40, 3, 3000)),
        "constant": np.full(3000, 7.5),
        "tailed": np.exp(rng.normal(0, 60, 3000)),
        "sentinel": np.where(rng.random(3000) < 0.01, 1.7e308, rng.uniform(0, 1, 3000)),
        "signed": np.where(rng.random(3000) < 0.01, -1e300, rng.uniform(-1, 1, 3000) * 1e17),
    }[name]


NAMES = ["uniform", "cents", "hot", "constant", "tailed", "sentinel", "signed"]


@pytest.mark.parametrize("buckets, names", [(64, ["cents", "hot"]), (8192, NAMES)])
def test_exact_quantiles_match_a_sort(spark, buckets, names):
    data = np.column_stack([column(n) for n in names])
    df = spark.createDataFrame(data.tolist(), names).repartition(5)
    found = exact_quantiles(df, names, PROBABILITIES, buckets)
    for i, name in enumerate(names):
        values = np.sort(data[:, i])
        for p, q in zip(PROBABILITIES, found[name]):
            at = p * (len(values) - 1)
            a, b = values[math.floor(at)], values[math.ceil(at)]
            assert q == (a if a == b else a + (b - a) * (at - math.floor(at))), (name, p)


def test_null_nan_infinity_and_empty(spark):
    rows = [(1.0, None), (None, None), (float("nan"), None), (3.0, None), (float("inf"), None), (-math.inf, None)]
    df = spark.createDataFrame(rows, "x double, nothing double")
    found = exact_quantiles(df, ["x", "nothing"], [0.0, 0.5, 1.0])
    assert found == {"x": [-math.inf, 2.0, math.inf], "nothing": [None, None, None]}
    assert exact_quantiles(df.limit(0), ["x"], [0.5]) == {"x": [None]}


def test_integers_and_decimals(spark):
    df = spark.range(101).select(F.col("id").alias("n"), F.col("id").cast("decimal(10,2)").alias("d"))
    assert exact_quantiles(df, ["n", "D"], [0.25, 0.5]) == {"n": [25.0, 50.0], "D": [25.0, 50.0]}


def test_approximate_quantiles_skip_nan_and_null(spark):
    df = spark.createDataFrame([(float(i),) for i in range(100)] + [(float("nan"),), (None,)], "x double")
    (median,) = approx_quantiles(df, ["x"], [0.5], 0.05)["x"]
    assert 40 <= median <= 60


@pytest.mark.parametrize("rows_per_range", [3, 1000])
def test_neighbours_across_ranges(spark, rows_per_range):
    values = {0: [1.0, 2.0, 5.0, 9.0, 9.5, 40.0, 41.0, 100.0], 1: [-3.0, 2.0, 50.0]}
    df = spark.createDataFrame([(t, x) for t, xs in values.items() for x in xs], "t int, x double")
    splits = range_splits(df, "x", df.count(), rows_per_range)
    assert splits
    found = {(r.t, r.x): (r.previous, r.next) for r in neighbours(df, df, "x", "t", splits).collect()}
    for t, xs in values.items():
        for before, x, after in zip([None, *xs], xs, [*xs[1:], None]):
            assert found[t, x] == (before, after)


@pytest.mark.parametrize("rows_per_range", [4, 1000])
def test_running_total_across_ranges(spark, rows_per_range):
    amounts = [3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5]
    df = spark.createDataFrame([(float(i * i), a) for i, a in enumerate(amounts)], "x double, a long")
    splits = range_splits(df, "x", len(amounts), rows_per_range)
    found = {r.x: r.below for r in running_total(df, df, "x", "a", "below", splits).collect()}
    assert found == {float(i * i): sum(amounts[:i]) for i in range(len(amounts))}


def test_splits_survive_one_hot_value(spark):
    """A value that holds most rows is one cut point, the rest is still divided."""
    df = spark.range(1000).select(F.when(F.col("id") % 3 > 0, 5.0).otherwise(F.col("id").cast("double")).alias("x"))
    splits = range_splits(df, "x", 1000, 50)
    assert len(splits) == len(set(splits)) > 3


def test_whole_numbers_and_decimals_keep_their_type(spark):
    """Neighbours above 2^53, both ends of bigint, and decimals of 38 digits, at every rank and with few buckets."""
    rng = np.random.default_rng(4)
    big = [2**53 + 1, 2**53 + 2, 2**53 + 3, -(2**63), 2**63 - 1, 0, None, *map(int, rng.integers(-(2**62), 2**62, 40))]
    wide = [Decimal(f"{'-' if i % 3 else ''}{'9' * 26}{i:012d}") for i in range(44)] + [None, Decimal(0), Decimal("1e37")]
    with localcontext() as context:
        context.prec = 60
        close = [Decimal("99999999.999999999999999999999999999999") - Decimal(i).scaleb(-30) for i in range(47)]
        fine = [Decimal(i).scaleb(-30) + (Decimal(12345678) if i % 2 else 0) for i in range(46)] + [None]
    df = spark.createDataFrame(list(zip(big, wide, fine, close, map(float, range(47)))), "b long, w decimal(38,0), f decimal(38,30), c decimal(38,30), x double").repartition(3)
    for buckets in (4, 8192):
        found = order_statistics(df, df.columns, lambda n: set(range(n)), buckets)
        for name, values in (("b", big), ("w", wide), ("f", fine), ("c", close), ("x", map(float, range(47)))):
            want = sorted(v for v in values if v is not None)
            n, got = found[name]
            assert n == len(want) and [got[i] for i in range(n)] == want, (name, buckets)
            assert all(type(v) is type(want[0]) for v in got.values())


def test_quantiles_between_large_values(spark):
    df = spark.createDataFrame([(9007199254740993, Decimal("0.1")), (9007199254740995, Decimal("0.2"))], "n long, d decimal(38,18)")
    assert exact_quantiles(df.limit(1), ["n"], [0.5]) == {"n": [9007199254740993]}
    assert exact_quantiles(df, ["n", "d"], [0.0, 0.5]) == {"n": [9007199254740993, float(9007199254740994)], "d": [Decimal("0.1"), Decimal("0.15")]}


def test_only_the_values_between_the_bounds_are_read_again(spark, monkeypatch):
    df = spark.range(30_000).select((F.col("id") * 7919 % 30_011).alias("n"), (F.col("id") * 104_729 % 30_011).cast("decimal(38,4)").alias("d")).repartition(3)
    read, narrow = [], ordering._narrow
    monkeypatch.setattr(ordering, "_narrow", lambda values, *rest: read.append(values.count()) or narrow(values, *rest))
    found = order_statistics(df, ["n", "d"], lambda n: {0, n // 2, n - 1})
    for name, place in (("n", 7919), ("d", 104_729)):
        want = sorted(i * place % 30_011 for i in range(30_000))
        assert found[name] == (30_000, {r: want[r] for r in (0, 15_000, 29_999)})
    assert read and max(read) < 3_000


def test_wrong_guesses_are_replaced(spark, monkeypatch):
    def wrong(spark, whole, kinds, sketches):
        return [ordering._Interval(iv.column, lo, lo + 1.0, iv.below, frozenset([r]), True) for iv in whole for lo, r in zip((50.0, 700.0, 900.0), sorted(iv.ranks))]

    monkeypatch.setattr(ordering, "_guesses", wrong)
    df = spark.range(1000).select(F.col("id").cast("double").alias("x")).union(spark.createDataFrame([(-math.inf,), (math.inf,), (None,)], "x double"))
    assert order_statistics(df, ["x"], lambda n: {1, 500, 1000}) == {"x": (1002, {1: 0.0, 500: 499.0, 1000: 999.0})}
