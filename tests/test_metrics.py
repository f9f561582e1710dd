import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator

from medallion.operators.metrics import (
    auc_roc,
    binary_metrics,
    class_report,
    classification_metrics,
    confusion,
    regression_metrics,
)


def test_regression_metrics_match_the_evaluator(spark):
    rng = np.random.default_rng(1)
    y = rng.normal(0, 10, 500)
    df = spark.createDataFrame(np.column_stack([y, y + rng.normal(0, 3, 500)]).tolist(), ["label", "prediction"])
    row = regression_metrics(df, "label").first()
    for name, metric in (("MAE", "mae"), ("MSE", "mse"), ("RMSE", "rmse"), ("R2", "r2")):
        assert row[name] == pytest.approx(RegressionEvaluator(metricName=metric).evaluate(df))


def test_rows_without_label_or_prediction_do_not_count(spark):
    df = spark.createDataFrame([(1.0, 1.5), (3.0, 2.5), (None, 9.0), (100.0, None)], "label double, prediction double")
    row = regression_metrics(df, "label").first()
    assert (row.MAE, row.R2) == (0.5, 0.75)


def test_constant_label_has_no_r2(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "label double, prediction double")
    assert regression_metrics(df, "label").first().R2 is None


def test_binary_metrics_and_their_zero_cases(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 0.0), (0, 1.0), (0, 0.0), (1, 1.0)], "label int, prediction double")
    assert tuple(binary_metrics(df, "label").first()) == pytest.approx((0.6, 2 / 3, 2 / 3, 2 / 3))
    assert tuple(binary_metrics(df.where("prediction = 0"), "label").first()) == (0.5, 0.0, 0.0, 0.0)
    assert tuple(binary_metrics(df.where("label = 0"), "label").first()) == (0.5, 0.0, 0.0, 0.0)


def test_classification_metrics(spark):
    df = spark.createDataFrame([(0, 0), (1, 2), (2, 2), (1, 1)], "label int, prediction int")
    row = classification_metrics(df, "label").first()
    assert (row.Accuracy, row.MAE, row.MSE, row.R2) == (0.75, 0.25, 0.25, 0.5)


def test_confusion_and_report(spark):
    pairs = [("a", "a"), ("a", "b"), ("b", "b"), ("b", "b"), ("c", "a")]
    df = spark.createDataFrame(pairs, "label string, prediction string")
    counts = {(r.label, r.prediction): r["count"] for r in confusion(df, "label").collect()}
    assert counts == {("a", "a"): 1, ("a", "b"): 1, ("b", "b"): 2, ("c", "a"): 1}
    report = {r["class"]: tuple(r)[1:] for r in class_report(df, "label").collect()}
    assert report["a"] == (0.5, 0.5, 0.5, 2)
    assert report["b"] == pytest.approx((2 / 3, 1.0, 0.8, 2))
    assert report["c"] == (0.0, 0.0, 0.0, 1)


@pytest.mark.parametrize("rows_per_range", [7, 10_000])
def test_auc_with_ties_and_ranges(spark, rows_per_range):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 400)
    s = np.where(rng.random(400) < 0.4, 0.5, (rng.random(400) + y * 0.3).round(2))
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double")
    pos, neg = s[y == 1], s[y == 0]
    expected = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    assert auc_roc(df, "label", "score", rows_per_range).first().AUC == pytest.approx(expected, abs=1e-12)
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0)
    assert evaluator.evaluate(df) == pytest.approx(expected, abs=1e-9)


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.3), (1, 0.4)], "label int, score double")
    assert auc_roc(df, "label", "score").first().AUC is None
