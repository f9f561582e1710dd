import json
import textwrap
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from medallion.operators.documents import PATIENT_SPEC
from medallion.plans.config import (
    DocumentConfig,
    InferenceConfig,
    IngestConfig,
    PublishConfig,
    RelationalConfig,
    SelectConfig,
    TrainConfig,
    TransformConfig,
    from_map,
    from_yaml,
)
from medallion.plans.jobs import (
    extract_documents_job,
    extract_relational_job,
    inference_job,
    inference_pipeline_job,
    ingest_job,
    publish_job,
    select_job,
    train_job,
    transform_job,
)
from medallion.sources.sinks import write_csv, write_if_any
from test_documents import FULL, NO_CONTACT


def listings(spark, n, with_price=True):
    i = F.col("id")
    df = spark.range(n).select(
        i.alias("Id"),
        F.concat(F.lit("Modèle "), (i % 4)).alias("Model"),
        (2024 - i % 12).alias("Mfg_Year"),
        F.when(i == 7, 9_999_999).otherwise(i * 731 % 90_000).cast("string").alias("KM"),
        F.when(i % 2 == 0, "petrol").otherwise("diesel").alias("Fuel_Type"),
        F.when(i % 25 == 0, "1").otherwise("0").alias("ABS"),
        (i % 5).cast("string").alias("Tow_Bar"),
        (30_000 - 900 * (i % 12) - (i * 731 % 90_000) / 10).alias("Price"),
    )
    return df if with_price else df.drop("Price")


CAR_YAML = """
transformation_params:
  source_bucket: "bronze-data"
  source_object_key: "cars.csv"
  destination_bucket: "silver-data"
  destination_object_key: "cars"
  column_types_to_convert: {Model: "string", Price: "double", Mfg_Year: "int", km: "int", ABS: "string"}
  columns_to_remove: ["Id", "Tow_Bar", "Cylinders"]
  feature_engineering_transformations:
    Car_Age: "year({as_of}) - Mfg_Year"
    Mileage: "try_divide(KM, Car_Age)"
  numerical_columns_list: ["KM", "Mfg_Year", "Price"]
  as_of: "2024-06-01"
"""


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """Bronze, silver, a trained model and its run, made once."""
    base = tmp_path_factory.mktemp("lake")
    (base / "etl.yaml").write_text(CAR_YAML)
    write_csv(listings(spark, 600), f"{base}/bronze-data/cars.csv", encoding="ISO-8859-1")
    config = from_yaml(TransformConfig, str(base / "etl.yaml"), "transformation_params", root=f"{base}/")
    config.fences = f"{base}/fences"
    fences = transform_job(spark, config)
    training = TrainConfig(
        source=config.destination, target_feature="price", experiment_name="cars_", models=f"{base}/models",
        runs=f"{base}/runs", estimator="random_forest_regressor", params={"numTrees": 15, "maxDepth": 7},
    )
    return base, config, fences, training, train_job(spark, training)


def test_transform_job(spark, lake):
    base, config, fences, _, _ = lake
    silver = spark.read.parquet(config.destination)
    assert silver.columns == ["Model", "Mfg_Year", "KM", "Fuel_Type", "ABS", "Price", "Car_Age", "Mileage"]
    assert dict(silver.dtypes)["ABS"] == "string" and dict(silver.dtypes)["KM"] == "int"
    assert silver.count() == 600
    assert [f.column for f in fences] == ["KM", "Mfg_Year", "Price"]
    assert silver.agg(F.max("KM")).first()[0] < 90_000
    assert silver.where("Mfg_Year = 2024 AND Mileage IS NOT NULL").count() == 0
    assert silver.where("Model LIKE 'Modèle%'").count() == 600


def test_training_and_selection(spark, lake):
    base, _, _, training, (run_id, metrics) = lake
    assert set(metrics) == {"MAE", "MSE", "RMSE", "R2"} and metrics["R2"] > 0.5
    chosen = select_job(spark, SelectConfig(training.runs, "R2", 0.4, "greater", "cars_"))
    assert chosen[:2] == (run_id, metrics["R2"]) and chosen[2].startswith("cars_")
    assert select_job(spark, SelectConfig(training.runs, "R2", 0.4, "greater", "boats_")) is None


def test_scoring_uses_the_training_fences(spark, lake):
    base, config, fences, training, (run_id, _) = lake
    fresh = listings(spark, 40, with_price=False).withColumn("KM", F.when(F.col("Id") < 30, "5000000").otherwise(F.col("KM")))
    fresh.write.parquet(f"{base}/fresh")
    serving = TransformConfig(
        source=f"{base}/fresh", destination=f"{base}/inference-data", source_format="parquet",
        column_types_to_convert={"KM": "int"}, columns_to_remove=config.columns_to_remove,
        feature_engineering_transformations=config.feature_engineering_transformations,
        numerical_columns_list=["KM", "Mfg_Year"], fences=config.fences, as_of=config.as_of,
    )
    transform_job(spark, serving, apply_stored=True)
    ready = spark.read.parquet(serving.destination)
    high = next(f.high for f in fences if f.column == "KM")
    assert ready.where(F.col("KM") == int(high)).count() >= 30
    model = f"{training.models}/{run_id}"
    assert inference_job(spark, InferenceConfig(serving.destination, f"{base}/gold-data", model))
    gold = spark.read.csv(f"{base}/gold-data", header=True, inferSchema=True)
    assert gold.columns == [*ready.columns, "predictions"] and gold.count() == 40
    ready.limit(0).write.parquet(f"{base}/empty")
    assert not inference_job(spark, InferenceConfig(f"{base}/empty", f"{base}/gold-none", model))


@pytest.mark.parametrize("method", ["median", "cap", "neighbor"])
def test_other_treatments(spark, lake, tmp_path, method):
    base = lake[0]
    config = TransformConfig(
        source=f"{base}/bronze-data/cars.csv", destination=str(tmp_path / "silver"), column_types_to_convert={"KM": "int"},
        numerical_columns_list=["KM"], outlier_method=method, outlier_key=["Id"],
    )
    transform_job(spark, config)
    silver = spark.read.parquet(config.destination)
    assert silver.count() == 600 and silver.agg(F.max("KM")).first()[0] < 1_000_000


def test_stored_fences_need_a_path(spark, lake):
    config = TransformConfig(source=f"{lake[0]}/bronze-data/cars.csv", destination="x")
    with pytest.raises(ValueError):
        transform_job(spark, config, apply_stored=True)


def test_document_extract(spark, tmp_path):
    (tmp_path / "docs.json").write_text(json.dumps([FULL, NO_CONTACT]))
    extract_documents_job(spark, DocumentConfig(str(tmp_path / "docs.json"), str(tmp_path / "flat"), array_file=True))
    lines = [line for part in sorted((tmp_path / "flat").glob("*.csv")) for line in part.read_text().splitlines()]
    assert lines[0] == ",".join(f.output for f in PATIENT_SPEC)
    assert lines[1] == 'Ann Roe,51,female,1,2 Lane,"Gout, Flu",,"A, B","1mg, 2mg","daily, weekly",2024-02-02,Y,second'
    assert lines[2] == "Bob" + "," * 12


def test_relational_extract_skips_empty_results(spark, tmp_path):
    spark.range(3).createOrReplaceTempView("some_ids")
    empty = RelationalConfig("SELECT id FROM some_ids WHERE id > 5", str(tmp_path / "none"))
    assert not extract_relational_job(spark, empty) and not (tmp_path / "none").exists()
    assert extract_relational_job(spark, RelationalConfig("SELECT id FROM some_ids", str(tmp_path / "ids"), header=False))
    assert sorted(r._c0 for r in spark.read.csv(str(tmp_path / "ids")).collect()) == ["0", "1", "2"]


def test_publish_then_ingest(spark, tmp_path):
    (tmp_path / "docs.json").write_text(json.dumps([FULL, NO_CONTACT]))
    publish_job(spark, PublishConfig(str(tmp_path / "docs.json"), path=str(tmp_path / "topic")))
    sent = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "topic")).collect()]
    assert sorted(d["patient"]["personal_information"]["name"] for d in sent) == ["Ann Roe", "Bob"]
    assert FULL in sent
    config = IngestConfig(str(tmp_path / "docs"), str(tmp_path / "ckpt"), schema="patient STRING", path=str(tmp_path / "topic"))
    ingest_job(spark, config)
    assert spark.read.parquet(str(tmp_path / "docs")).count() == 2
    config.message_limit = 1
    with pytest.raises(ValueError):
        ingest_job(spark, config)


def test_configuration_is_checked(tmp_path, monkeypatch):
    with pytest.raises(ValueError, match="numerical_column"):
        from_map(TransformConfig, {"source": "a", "destination": "b", "numerical_column": []})
    monkeypatch.setenv("DB_USER", "someone")
    config = from_map(RelationalConfig, {"query": "q", "destination": "d", "jdbc": {"user": "${DB_USER}"}})
    assert config.jdbc == {"user": "someone"}
    (tmp_path / "c.yaml").write_text(textwrap.dedent("""
        metric_name: R2
        threshold: 0.8
        comparison_operator: greater
        runs: /lake/runs
    """))
    assert from_yaml(SelectConfig, str(tmp_path / "c.yaml")).threshold == 0.8


def test_inference_in_one_plan_needs_fences(spark, tmp_path):
    raw = TransformConfig(source=str(tmp_path / "in"), destination="unused", source_format="parquet", numerical_columns_list=["x"])
    with pytest.raises(ValueError, match="fences"):
        inference_pipeline_job(spark, raw, InferenceConfig(source="unused", destination="unused", model="unused"))
    spark.createDataFrame([], "x double").write.parquet(raw.source)
    empty = replace(raw, fences=str(tmp_path / "fences"))
    assert not inference_pipeline_job(spark, empty, InferenceConfig(source="unused", destination=str(tmp_path / "out"), model="unused"))
    assert not (tmp_path / "out").exists()


def test_a_query_is_evaluated_once(spark, tmp_path):
    """The extract stages the rows of its query, so that the test for rows and the write see the same."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    rows = spark.range(10).mapInPandas(count, "id long")
    assert write_if_any(rows, lambda df: df.write.parquet(str(tmp_path / "o")), once=True)
    assert seen.value == 10 and spark.read.parquet(str(tmp_path / "o")).count() == 10
