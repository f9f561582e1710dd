import math
import random

import pytest
from pyspark.sql import functions as F

from medallion.operators import ordering
from medallion.operators.ordering import exact_quantiles, order_statistics
from medallion.operators.outliers import treat_outliers
from medallion.operators.sketches import merge_sketches, read_sketches, sketched_fences, sketched_quantiles, store_sketches


def values(seed, n, spread):
    rng = random.Random(seed)
    return [rng.lognormvariate(0, spread) for _ in range(n)]


def test_deliveries_merge_and_replace_themselves(spark, tmp_path):
    path, one, two = str(tmp_path / "s"), values(1, 30000, 2), values(2, 10000, 0.5)
    frame = lambda v: spark.createDataFrame([(x, None) for x in v], "x double, nothing double").repartition(3)
    for delivery, rows in (("a", one[:50]), ("a", one), ("b", two), ("c", [])):
        store_sketches(frame(rows), ["x", "nothing"], path, delivery)
    sketches = read_sketches(spark, path)
    merged = {r["column"]: r for r in merge_sketches(sketches).collect()}
    everything = sorted(one + two)
    assert merged["x"].n == 40000 and (merged["x"].least, merged["x"].greatest) == (everything[0], everything[-1])
    assert merged["nothing"].n == 0
    found = sketched_quantiles(sketches, [0.1, 0.5, 0.9])
    for p, q in zip((0.1, 0.5, 0.9), found["x"]):
        assert q in everything and abs(everything.index(q) / 40000 - p) < 0.01
    assert found["nothing"] == [None] * 3


def test_fences_out_of_sketches_treat_rows(spark, tmp_path):
    path = str(tmp_path / "s")
    rows = spark.createDataFrame([(float(i % 100),) for i in range(5000)] + [(1e6,), (float("nan"),), (None,)], "x double")
    store_sketches(rows, ["x"], path, "1")
    (fence,) = sketched_fences(read_sketches(spark, path))
    assert fence.lower == pytest.approx(24 - 75, abs=5) and fence.upper == pytest.approx(74 + 75, abs=5)
    assert treat_outliers(rows, [fence], "cap").agg(F.max(F.nanvl("x", F.lit(0.0)))).first()[0] == fence.upper


@pytest.fixture
def passes(monkeypatch):
    """How many passes an exact lookup takes after the first."""
    seen = []
    narrow = ordering._narrow

    def counted(*args):
        seen.append([iv.guess for iv in args[1]])
        return narrow(*args)

    monkeypatch.setattr(ordering, "_narrow", counted)
    return seen


def test_brackets_take_one_counting_pass(spark, passes):
    """Also where a few values are far out, which would leave nearly all rows in one bucket of the whole range."""
    heavy = [x * 10 ** (200 if i % 25 == 0 else 0) for i, x in enumerate(values(3, 20000, 3))]
    df = spark.createDataFrame([(x, i) for i, x in enumerate(heavy)], "x double, n long").repartition(4)
    found = exact_quantiles(df, ["x", "n"], [0.0, 0.25, 0.5, 0.75, 1.0])
    ranked = sorted(heavy)
    for p, q in zip((0.0, 0.25, 0.5, 0.75, 1.0), found["x"]):
        at = p * (len(ranked) - 1)
        a, b = ranked[math.floor(at)], ranked[math.ceil(at)]
        assert q == (a if a == b else a + (b - a) * (at - math.floor(at)))
    assert found["n"] == [0, 4999.75, 9999.5, 14999.25, 19999]
    assert len(passes) == 1 and all(passes[0])


@pytest.mark.parametrize("shift", [-1, 1])
def test_wrong_brackets_are_noticed(spark, passes, monkeypatch, shift):
    """Bounds beside the rank: the counts show it, and the lookup goes on in the part that is left."""
    monkeypatch.setattr(ordering, "SKETCH_MARGIN", 0.0)
    df = spark.createDataFrame([(float(x),) for x in range(-6000, 6000)] + [(math.inf,), (-math.inf,), (float("nan"),)], "x double").repartition(3)
    guesses = ordering._guesses

    def moved(*args):
        out = guesses(*args)
        for iv in out:
            iv.lo, iv.hi = iv.lo + shift * 300, iv.hi + shift * 300
        return out

    monkeypatch.setattr(ordering, "_guesses", moved)
    n, found = order_statistics(df, ["x"], lambda n: {0, 1, 500, 6000, n - 1})["x"]
    assert n == 12002 and found == {0: -math.inf, 1: -6000.0, 500: -5501.0, 6000: -1.0, 12001: math.inf}
    assert len(passes) > 1
