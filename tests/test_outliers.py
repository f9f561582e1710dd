import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F, types as T

from medallion.operators.outliers import (
    Fence,
    fences_from_frame,
    fences_to_frame,
    fit_fences,
    flag_outliers,
    replace_by_neighbour,
    treat_outliers,
)


@pytest.fixture(scope="module")
def pdf():
    rng = np.random.default_rng(3)
    n = 400
    a = rng.normal(100, 5, n).round(1)
    a[:30] = 500.0
    a[30:40] = rng.uniform(300, 900, 10).round(1)
    a[40:50] = rng.uniform(-500, -200, 10).round(1)
    b = rng.integers(0, 50, n)
    b[100:106] = [1000, 1000, 2000, -700, -700, -900]
    return pd.DataFrame({"id": rng.permutation(n), "a": a, "b": b, "tag": [f"t{i % 3}" for i in range(n)]})


def fences_of(values):
    q1, q3 = np.quantile(values, [0.25, 0.75])
    return q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)


def sorted_by_id(df):
    return df.orderBy("id").toPandas()


def test_fences_per_column(spark, pdf):
    fences = fit_fences(spark.createDataFrame(pdf), ["a", "B"])
    for f in fences:
        assert (f.lower, f.upper) == pytest.approx(fences_of(pdf[f.column]))
    assert [f.column for f in fences] == ["a", "b"]


def test_clamp_takes_the_nearest_inner_value(spark, pdf):
    df = spark.createDataFrame(pdf)
    fences = fit_fences(df, ["a", "b"])
    out = sorted_by_id(treat_outliers(df, fences))
    expected = pdf.sort_values("id").reset_index(drop=True)
    for c in ("a", "b"):
        lo, hi = fences_of(pdf[c])
        inner = pdf[c][(pdf[c] >= lo) & (pdf[c] <= hi)]
        expected[c] = expected[c].clip(inner.min(), inner.max())
        assert out[c].between(lo, hi).all()
    pd.testing.assert_frame_equal(out, expected)
    assert treat_outliers(df, fences).schema == df.schema


def test_median_counts_outliers_too(spark, pdf):
    df = spark.createDataFrame(pdf)
    out = sorted_by_id(treat_outliers(df, fit_fences(df, ["a", "b"], method="median"), "median"))
    expected = pdf.sort_values("id").reset_index(drop=True)
    for c in ("a", "b"):
        lo, hi = fences_of(pdf[c])
        expected[c] = expected[c].where(expected[c].between(lo, hi), pdf[c].median()).astype(float)
    pd.testing.assert_frame_equal(out, expected)


def brute_neighbour(pdf, column, lo, hi):
    """The previous value in sorted order, the next one for the very first row."""
    ordered = pdf.sort_values([column, "id"])
    adjacent = ordered[column].shift(1).fillna(ordered[column].shift(-1)).fillna(ordered[column])
    return ordered[column].where(ordered[column].between(lo, hi), adjacent).sort_index()


@pytest.mark.parametrize("rows_per_range", [5, 1000])
def test_neighbour_equals_a_sorted_window(spark, pdf, rows_per_range):
    df = spark.createDataFrame(pdf).repartition(6)
    fences = fit_fences(df, ["a", "b"], method="neighbor")
    out = sorted_by_id(replace_by_neighbour(df, fences, ["id"], rows_per_range))
    expected = pdf.copy()
    for c in ("a", "b"):
        expected[c] = brute_neighbour(pdf, c, *fences_of(pdf[c])).astype(pdf[c].dtype)
    pd.testing.assert_frame_equal(out, expected.sort_values("id").reset_index(drop=True))


def test_neighbour_with_fixed_bounds_and_two_key_columns(spark, pdf):
    df = spark.createDataFrame(pdf)
    fences = fit_fences(df, ["a"], bounds=(95.0, 105.0), method="neighbor")
    out = sorted_by_id(treat_outliers(df, fences, "neighbor", key=["id", "tag"]))
    expected = pdf.copy()
    expected["a"] = brute_neighbour(pdf, "a", 95.0, 105.0)
    pd.testing.assert_frame_equal(out, expected.sort_values("id").reset_index(drop=True))


def test_neighbour_with_stored_fences_looks_at_the_new_rows(spark):
    fences = fit_fences(spark.createDataFrame([(i, float(i)) for i in range(10)], "id long, x double"), ["x"], method="neighbor")
    new = spark.createDataFrame([(1, 4.0), (2, 5.0), (3, 99.0), (4, 98.0)], "id long, x double")
    out = {r.id: r.x for r in treat_outliers(new, fences, "neighbor", ["id"]).collect()}
    assert out == {1: 4.0, 2: 5.0, 3: 98.0, 4: 5.0}


def test_neighbour_when_every_value_is_outside(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 90.0)], "id long, x double")
    fences = fit_fences(df, ["x"], bounds=(10.0, 20.0), method="neighbor")
    out = {r.id: r.x for r in treat_outliers(df, fences, "neighbor", ["id"]).collect()}
    assert out == {1: 2.0, 2: 1.0, 3: 2.0}


def test_neighbour_needs_a_key(spark, pdf):
    df = spark.createDataFrame(pdf)
    with pytest.raises(ValueError):
        treat_outliers(df, [], "neighbor")
    with pytest.raises(ValueError):
        treat_outliers(df, [Fence("a", 0, 1)], "neighbor", key=["a"])


@pytest.mark.parametrize("method", ["clamp", "median", "cap", "neighbor"])
def test_null_and_nan_stay(spark, method):
    rows = [(i, float(i % 10)) for i in range(40)] + [(100, None), (101, float("nan")), (102, 1e6), (103, -1e6)]
    df = spark.createDataFrame(rows, "id long, x double")
    out = {r.id: r.x for r in treat_outliers(df, fit_fences(df, ["x"], method=method), method, ["id"]).collect()}
    assert len(out) == len(rows)
    assert out[100] is None and np.isnan(out[101])
    assert out[102] < 100 and out[103] > -100
    assert all(out[i] == float(i % 10) for i in range(40))


def test_cap_uses_the_limits(spark):
    df = spark.createDataFrame([(1, 5), (2, 50), (3, 95), (4, None)], "id long, x int")
    out = treat_outliers(df, fit_fences(df, ["x"], bounds={"X": (10, 90)}, method="cap"), "cap")
    assert sorted((r.id, r.x) for r in out.collect()) == [(1, 10.0), (2, 50.0), (3, 90.0), (4, None)]


def test_every_numeric_type_keeps_its_type_when_clamped(spark):
    kinds = {"i": "int", "l": "bigint", "f": "float", "d": "decimal(12,3)", "s": "smallint"}
    base = spark.range(200).select(*[(F.col("id") % 50).cast(k).alias(c) for c, k in kinds.items()])
    high = spark.range(1).select(*[F.lit(9999).cast(k).alias(c) for c, k in kinds.items()])
    df = base.unionByName(high)
    out = treat_outliers(df, fit_fences(df, list(kinds)))
    assert [f.dataType for f in out.schema] == [f.dataType for f in df.schema]
    assert [float(v) for v in out.agg(*[F.max(c) for c in kinds]).first()] == [49.0] * len(kinds)


def test_empty_column_gets_no_fence(spark):
    df = spark.createDataFrame([(1, None)], "id long, x double")
    assert fit_fences(df, ["x"]) == []
    assert fit_fences(df, ["x"], method="median") == []
    assert treat_outliers(df, []).collect() == df.collect()


def test_infinite_quartiles(spark):
    df = spark.createDataFrame([(1.0, float("inf"))] * 9 + [(2.0, 1.0), (3.0, -float("inf"))], "x double, y double")
    assert [f.column for f in fit_fences(df, ["x", "y"])] == ["x"]


def test_flags(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 50.0), (3, None), (4, float("nan"))], "id long, x double")
    out = flag_outliers(df, [Fence("x", 10, 90)]).orderBy("id")
    assert [r.outlier_x for r in out.collect()] == [True, False, False, False]


def test_fences_survive_storage(spark, pdf, tmp_path):
    fences = fit_fences(spark.createDataFrame(pdf), ["a", "b"])
    fences_to_frame(spark, fences).write.parquet(str(tmp_path / "fences"))
    assert sorted(fences_from_frame(spark.read.parquet(str(tmp_path / "fences"))), key=lambda f: f.column) == fences


def test_unknown_method(spark, pdf):
    with pytest.raises(ValueError):
        fit_fences(spark.createDataFrame(pdf), ["a"], method="other")
