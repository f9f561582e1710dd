import collections
import random

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from medallion.operators import models
from medallion.operators.features import hash_split
from medallion.operators.metrics import binary_metrics, regression_metrics
from medallion.operators.models import (
    build_model,
    load_model,
    make_estimator,
    save_model,
    score,
    score_python_model,
    train_model,
)


@pytest.fixture(scope="module")
def listings(spark):
    """Price depends on distance, age and fuel; some values are missing."""
    i = F.col("id")
    return spark.range(600).select(
        "id",
        F.when(i % 17 != 0, i * 37 % 1000).alias("KM"),
        (i % 13).cast("int").alias("Age"),
        F.when(i % 19 != 0, F.when(i % 3 == 0, "diesel").otherwise("petrol")).alias("Fuel"),
        (20000.0 - 3 * (i * 37 % 1000) - 500 * (i % 13) + F.when(i % 3 == 0, 1500.0).otherwise(0.0)).alias("Price"),
    )


def test_linear_regression_learns_the_rule(listings, tmp_path):
    train, test = hash_split(listings, key=["id"])
    model = train_model(train, make_estimator("linear_regression"), "price", exclude=["id"])
    scored = score(test, model)
    assert scored.columns == [*test.columns, "predictions"]
    assert regression_metrics(scored, "Price", "predictions").first().R2 > 0.9
    save_model(model, str(tmp_path / "m"))
    assert score(test, load_model(str(tmp_path / "m"))).orderBy("id").collect() == scored.orderBy("id").collect()


def test_target_is_not_a_feature(listings):
    model = train_model(listings, make_estimator("linear_regression"), "Price", exclude=["id"])
    without = listings.drop("Price")
    assert score(without, model).columns == [*without.columns, "predictions"]


def test_rows_without_target_are_left_out(listings):
    holes = listings.withColumn("Price", F.when(F.col("id") % 5 != 0, F.col("Price")))
    model = train_model(holes, make_estimator("linear_regression"), "Price", exclude=["id"])
    assert score(holes, model).where("predictions IS NULL").count() == 0


def test_forests_repeat_with_a_seed(listings):
    sold = listings.withColumn("cheap", (F.col("Price") < 17000).cast("double")).drop("Price")
    train, test = hash_split(sold, key=["id"])
    forest = make_estimator("random_forest_classifier", numTrees=10)
    first, second = (score(test, train_model(train, forest, "cheap", exclude=["id"])).orderBy("id").collect() for _ in range(2))
    assert first == second
    scored = score(test, train_model(train, forest, "cheap", exclude=["id"]))
    assert binary_metrics(scored, "cheap", "predictions").first().Accuracy > 0.8
    regressor = make_estimator("random_forest_regressor", maxDepth=6)
    fitted = train_model(listings, regressor, "Price", exclude=["id"])
    assert regression_metrics(score(listings, fitted), "Price", "predictions").first().R2 > 0.6


def test_forest_defaults():
    assert make_estimator("random_forest_classifier").getNumTrees() == 100
    assert make_estimator("random_forest_regressor").getSeed() == 42
    with pytest.raises(ValueError):
        make_estimator("svm")


def test_any_estimator_on_an_assembled_vector(listings):
    assembled = VectorAssembler(inputCols=["Age"], outputCol="vec").transform(listings)
    estimator = make_estimator("linear_regression")
    model = build_model(assembled, estimator, "price", "vec")
    assert "prediction" in model.transform(assembled).columns
    assert estimator.getFeaturesCol() == "features"


def test_missing_model_raises(spark, tmp_path):
    with pytest.raises(Exception):
        load_model(str(tmp_path / "nothing"))


@pytest.fixture
def make_rule():
    """A model class made in place, so that it travels by value."""

    def make(factor):
        class Rule:
            def predict(self, frame):
                return factor * frame["Age"] + len(frame.columns)

        return Rule()

    return make


def test_python_model_by_value_and_by_loader(listings, make_rule):
    whole = score_python_model(listings, make_rule(2.0))
    assert whole.where("predictions != 2.0 * Age + 5").count() == 0
    assert whole.columns[-1] == "predictions"
    loaded = score_python_model(listings, load=lambda: make_rule(3.0), columns=["AGE"], output="p")
    assert loaded.where("p != 3.0 * Age + 1").count() == 0


def test_python_model_size_is_checked(listings, make_rule):
    rule = make_rule(1.0)
    rule.weights = b"x" * 5000
    with pytest.raises(ValueError, match="load="):
        score_python_model(listings, rule, max_bytes=4000)
    with pytest.raises(ValueError):
        score_python_model(listings)


def test_prediction_column_must_be_free(listings):
    model = train_model(listings, make_estimator("linear_regression"), "Price", exclude=["id"])
    with pytest.raises(ValueError):
        score(listings.withColumn("predictions", F.lit(1)), model)


def forest_rows(spark):
    """A third of the rows are one row; some have no target."""
    rng = random.Random(5)
    rows = [(float(rng.randrange(50)), rng.choice(["a", "b", "c"]), None if i % 40 == 0 else float(i % 17)) for i in range(1500)]
    return spark.createDataFrame(rows + [(7.0, "a", 3.0)] * 700, "x double, c string, y double")


@pytest.mark.parametrize("name", ["random_forest_regressor", "random_forest_classifier"])
def test_forests_do_not_depend_on_the_layout(spark, name):
    rows, seen = forest_rows(spark), []
    for layout in (rows.repartition(4), rows.repartition(12), rows.orderBy("x").coalesce(1)):
        model = train_model(layout, make_estimator(name, numTrees=6, maxDepth=4), "y", rows_per_piece=150)
        seen.append((model.stages[-1].toDebugString.split("\n", 1)[1], sorted(r.p for r in score(rows, model, "p").select("p").collect())))
    assert seen[0] == seen[1] == seen[2]


def test_rows_are_dealt_by_content(spark, monkeypatch):
    monkeypatch.setattr(models, "EQUAL_ROWS", 16)
    rows = forest_rows(spark)
    pieces = []
    for n in (3, 11):
        placed = models.dealt(rows.repartition(n), 150).withColumn("piece", F.spark_partition_id())
        pieces.append([tuple(r) for r in placed.collect()])
    assert pieces[0] == pieces[1]
    assert collections.Counter(p[:3] for p in pieces[0]) == collections.Counter(map(tuple, rows.collect()))
    sizes = collections.Counter(p[3] for p in pieces[0])
    assert len(sizes) == 15 and max(sizes.values()) < 300  # the frequent row alone has 700
    assert models.dealt(rows.limit(0)).count() == 0
