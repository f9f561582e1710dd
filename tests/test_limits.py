"""One algorithm at every size, clear errors for options and keys, and nothing lost on the way in."""

import json

import pytest
from pyspark.sql import functions as F

from medallion.operators.features import build_preprocessor, hash_split
from medallion.operators.metrics import auc_roc
from medallion.operators.outliers import Fence, fit_fences, replace_by_neighbour
from medallion.plans.config import DocumentConfig, TrainConfig
from medallion.plans.jobs import extract_documents_job, train_job
from medallion.streaming.ingest import ingest_bounded


@pytest.mark.parametrize("rows_per_range", [2, 1000])
def test_auc_leaves_nan_out_at_every_size(spark, rows_per_range):
    rows = [(float(i % 7), i % 2) for i in range(40)] + [(float("nan"), 1), (None, 0), (3.0, None)]
    df = spark.createDataFrame(rows, "s double, y int")
    clean = [(s, y) for s, y in rows if s is not None and s == s and y is not None]
    pos, neg = [s for s, y in clean if y == 1], [s for s, y in clean if y == 0]
    won = sum((p > n) + (p == n) / 2 for p in pos for n in neg)
    assert auc_roc(df, "y", "s", rows_per_range).first()[0] == pytest.approx(won / len(pos) / len(neg))


def test_bounded_ingest_takes_exactly_the_limit(spark):
    rows = [(p, json.dumps({"id": i})) for p, i in [(1, 1), (1, 9), (2, 11), (2, 2), (None, 3), (3, 22)]]
    messages = spark.createDataFrame(rows, "offset long, value string")
    for limit, wanted in ((1, {1}), (3, {1, 9, 11}), (5, {1, 9, 11, 2, 22}), (6, {1, 9, 11, 2, 22, 3}), (9, {1, 9, 11, 2, 22, 3})):
        assert {r.id for r in ingest_bounded(messages, "id long", limit, ["offset"]).collect()} == wanted


def test_neighbour_keeps_large_integers(spark):
    big = 9007199254740993
    df = spark.createDataFrame([(i, v) for i, v in enumerate([1, 2, big, big + 2, big + 3])], "k long, v long")
    out = replace_by_neighbour(df, [Fence("v", 0.0, 10.0)], ["k"])
    assert {r.k: r.v for r in out.collect()} == {0: 1, 1: 2, 2: 2, 3: big, 4: big + 2}


@pytest.mark.parametrize("keys", [[1, 1, 2], [None, 1, 2]])
def test_neighbour_needs_good_keys(spark, keys):
    df = spark.createDataFrame([(k, 100.0 + i) for i, k in enumerate(keys)], "k long, v double")
    with pytest.raises(ValueError, match="key columns"):
        replace_by_neighbour(df, [Fence("v", 0.0, 10.0)], ["k"])


def test_misspelt_options_raise(spark):
    df = spark.createDataFrame([(1.0,)], "v double")
    with pytest.raises(ValueError, match="quantiles"):
        fit_fences(df, ["v"], quantiles="exct")
    with pytest.raises(ValueError, match="median"):
        build_preprocessor(["v"], [], median="exct")
    with pytest.raises(ValueError, match="whole"):
        hash_split(df, 12.5)


def test_categories_are_measured_exactly_on_fit(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("c"))
    build_preprocessor([], ["c"], max_categories=50).fit(df)
    with pytest.raises(ValueError, match="too many"):
        build_preprocessor([], ["c"], max_categories=49).fit(df)


def test_documents_keep_ages_and_bad_lines(spark, tmp_path):
    person = lambda name, age: json.dumps({"patient": {"personal_information": {"name": name, "age": age}}})
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join([person("a", 51), person("b", "52"), person("c", 51.5), "no json", ""]))
    extract_documents_job(spark, DocumentConfig(str(tmp_path / "in"), str(tmp_path / "out")))
    rows = spark.read.csv(str(tmp_path / "out"), header=True).collect()
    assert {(r.patient_name, r.patient_age) for r in rows} == {("a", "51"), ("b", "52"), ("c", "51.5")}
    assert [r.value for r in spark.read.text(str(tmp_path / "out.rejects")).collect()] == ["no json"]


def test_classifier_run_records_binary_metrics(spark, tmp_path):
    df = spark.range(400).select("id", (F.col("id") % 20).cast("double").alias("x"), (F.col("id") % 20 >= 10).cast("int").alias("y"))
    df.write.parquet(str(tmp_path / "rows"))
    config = TrainConfig(
        source=str(tmp_path / "rows"), target_feature="y", models=str(tmp_path / "models"), runs=str(tmp_path / "runs"),
        estimator="random_forest_classifier", params={"numTrees": 3}, split_key=["id"], experiment_name="e",
    )
    _, metrics = train_job(spark, config)
    assert metrics["AUC"] == metrics["F1"] == metrics["Precision"] == metrics["Recall"] == 1.0
