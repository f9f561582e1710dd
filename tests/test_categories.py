import collections

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from medallion.operators import categories
from medallion.operators.categories import CategoryIndexer
from medallion.operators.features import build_preprocessor


@pytest.fixture(scope="module")
def rows(spark):
    """A hot category, ties, nulls, empty text, and many that occur once."""
    values = ["hot"] * 50 + ["b", "a", "b", "a", "", None, None, "Ä", "ä"] + [f"v{i}" for i in range(40)]
    return spark.createDataFrame([(i, v, "x" if i % 2 else "y") for i, v in enumerate(values)], "n long, c string, d string").repartition(6)


def expected(df, column):
    counts = collections.Counter(r[0] for r in df.select(column).collect() if r[0] is not None)
    return {v: i for i, (v, _) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0].encode())))}


@pytest.mark.parametrize("limits", [{}, {"BROADCAST_ROWS": 3, "FREQUENT_ROWS": 2}, {"BROADCAST_BYTES": 1}], ids=["broadcast", "frequent apart", "join only"])
def test_numbers_by_frequency(spark, rows, limits, monkeypatch):
    for name, value in limits.items():
        monkeypatch.setattr(categories, name, value)
    model = CategoryIndexer(inputCols=["c", "d"], outputCols=["ci", "di"]).fit(rows)
    new = rows.unionByName(spark.createDataFrame([(1000, "never", "z"), (1001, None, None)], rows.schema))
    want = {c: expected(rows, c) for c in "cd"}
    for r in model.transform(new).collect():
        assert r.ci == want["c"].get(r.c, len(want["c"])) and r.di == want["d"].get(r.d, len(want["d"]))
    assert model.transform(new).count() == new.count()
    if limits:
        assert model.getOrDefault("known")[0] < model.getOrDefault("sizes")[0]


def test_table_travels_with_the_stored_model(spark, rows, tmp_path):
    fitted = build_preprocessor(["n"], ["c", "d"]).fit(rows)
    path = str(tmp_path / "model")
    fitted.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    (stage,) = [s for s in loaded.stages if isinstance(s, categories.CategoryIndexerModel)]
    assert stage.getOrDefault("path").startswith(path)
    read = lambda m: sorted((r.n, r.v) for r in m.transform(rows).select("n", vector_to_array("features").alias("v")).collect())
    assert read(loaded) == read(fitted)


def test_estimator_can_be_stored(rows, tmp_path):
    path = str(tmp_path / "p")
    Pipeline(stages=[CategoryIndexer(inputCols=["c"], outputCols=["i"])]).write().save(path)
    assert Pipeline.load(path).fit(rows).transform(rows).where("c = 'hot' and i = 0").count() == 50


def test_a_category_for_almost_every_row(spark):
    rows = spark.range(12000).select(F.concat(F.lit("v"), "id").alias("c"))
    model = CategoryIndexer(inputCols=["c"], outputCols=["i"]).fit(rows)
    found = model.transform(rows).agg(F.count_distinct("i"), F.min("i"), F.max("i")).first()
    assert tuple(found) == (12000, 0, 11999)


def test_no_values_and_taken_names(spark):
    rows = spark.createDataFrame([(None,), (None,)], "c string")
    assert [r.i for r in CategoryIndexer(inputCols=["c"], outputCols=["i"]).fit(rows).transform(rows).collect()] == [0.0, 0.0]
    taken = spark.createDataFrame([("a", 1)], "c string, __salt int")
    with pytest.raises(ValueError, match="__salt"):
        CategoryIndexer(inputCols=["c"], outputCols=["i"]).fit(taken).transform(taken)
