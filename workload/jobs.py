"""Whole jobs over files, run as a user of the configurations runs them."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from medallion.operators.documents import decode_json, valid_documents
from medallion.plans.config import InferenceConfig, IngestConfig, PublishConfig, SelectConfig, TrainConfig, TransformConfig
from medallion.plans.jobs import inference_job, inference_pipeline_job, ingest_job, publish_job, select_job, train_job, transform_job
from medallion.session import scratch_dir
from medallion.sources.sinks import publish_json, write_csv, write_table
from workload import SQL, query, table
from workload.cleaning import ETL
from workload.learning import LINE_TEST
from workload.runs import RUNS_SQL, monthly_runs
from workload.streams import EVENT, FILES_PER_BATCH

#: Records of one JSON array file.
ARRAY_RECORDS = 1000


@query(SQL["etl_job"])
def transform_files(spark, sf_dir):
    """The transformation job from CSV, staged, with its fences stored; then once more with the stored fences."""
    lines = table(spark, sf_dir, "lineitem")
    source, silver, again, fences = (scratch_dir(spark, n) for n in ("bronze", "silver", "again", "fences"))
    write_csv(lines, source)
    config = replace(
        ETL, source=source, destination=silver, source_format="csv", source_options={"schema": lines.schema, "encoding": "UTF-8"}, fences=fences
    )
    transform_job(spark, config)
    transform_job(spark, replace(config, destination=again), apply_stored=True)
    return spark.read.parquet(again)


@query(f"""
WITH e AS (SELECT min(l_quantity) AS low, max(l_quantity) AS high FROM lineitem WHERE l_orderkey % 2 = 0 AND l_quantity BETWEEN 7.5 AND 40.5),
s AS (SELECT l_orderkey, l_linenumber, l_quantity * l_extendedprice AS net, {LINE_TEST} AS test,
             CASE WHEN l_quantity < 7.5 THEN low WHEN l_quantity > 40.5 THEN high ELSE l_quantity END AS l_quantity FROM lineitem, e),
m AS (SELECT regr_slope(net, l_quantity) AS b, regr_intercept(net, l_quantity) AS a FROM s WHERE l_orderkey % 2 = 0 AND NOT test)
SELECT l_orderkey, l_linenumber, l_quantity, round(a + b * l_quantity, 1) AS predictions FROM s, m WHERE l_orderkey % 2 = 1
""")
def inference_fences(spark, sf_dir):
    """Training on the lines of even orders, then new lines (odd orders) treated with the stored fences and scored."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    old, new, silver, fresh, gold, fences, models, runs = (
        scratch_dir(spark, n) for n in ("old", "new", "silver", "fresh", "gold", "fences", "models", "runs")
    )
    lines.where("l_orderkey % 2 = 0").write.parquet(old)
    lines.where("l_orderkey % 2 = 1").write.parquet(new)
    config = TransformConfig(
        source=old, destination=silver, source_format="parquet", numerical_columns_list=["l_quantity"], outlier_bounds=[7.5, 40.5],
        feature_engineering_transformations={"net": "l_quantity * l_extendedprice"}, columns_to_remove=["l_extendedprice"], fences=fences,
    )
    transform_job(spark, config)
    run_id, _ = train_job(spark, TrainConfig(
        source=silver, target_feature="net", experiment_name="net_", models=models, runs=runs, estimator="linear_regression",
        params={"solver": "normal"}, split_key=["l_orderkey", "l_linenumber"],
    ))
    transform_job(spark, replace(config, source=new, destination=fresh), apply_stored=True)
    inference_job(spark, InferenceConfig(source=fresh, destination=gold, model=f"{models}/{run_id}", destination_format="parquet"))
    scored = spark.read.parquet(gold)
    return scored.select("l_orderkey", "l_linenumber", "l_quantity", F.round("predictions", 1).alias("predictions"))


@query(f"""
WITH s AS (SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_extendedprice, {LINE_TEST} AS test FROM lineitem),
e AS (SELECT min(l_quantity) AS low, max(l_quantity) AS high FROM s WHERE l_orderkey % 2 = 0 AND l_quantity BETWEEN 7.5 AND 40.5),
t AS (SELECT *, CASE WHEN l_quantity < 7.5 THEN low WHEN l_quantity > 40.5 THEN high ELSE l_quantity END AS q FROM s, e),
m AS (SELECT regr_slope(l_extendedprice, q) AS b, regr_intercept(l_extendedprice, q) AS a FROM t WHERE l_orderkey % 2 = 0 AND NOT test)
SELECT l_orderkey, l_linenumber, q AS l_quantity, round(a + b * q, 1) AS predictions FROM t, m WHERE l_orderkey % 2 = 1
""")
def inference_whole(spark, sf_dir):
    """Raw CSV of new lines (odd orders) to predictions in one job, with the fences and the model of the lines of even orders."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount")
    old, new, silver, gold, fences, models, runs = (scratch_dir(spark, n) for n in ("old", "new", "silver", "gold", "fences", "models", "runs"))
    lines.where("l_orderkey % 2 = 0").write.parquet(old)
    write_csv(lines.where("l_orderkey % 2 = 1").drop("l_extendedprice"), new)
    config = TransformConfig(
        source=old, destination=silver, source_format="parquet", numerical_columns_list=["l_quantity"], outlier_bounds=[7.5, 40.5],
        columns_to_remove=["l_discount"], fences=fences,
    )
    transform_job(spark, config)
    run_id, _ = train_job(spark, TrainConfig(
        source=silver, target_feature="l_extendedprice", experiment_name="whole_", models=models, runs=runs, estimator="linear_regression",
        params={"solver": "normal"}, split_key=["l_orderkey", "l_linenumber"],
    ))
    raw = replace(config, source=new, source_format="csv", source_options={"encoding": "UTF-8"}, column_types_to_convert={"l_quantity": "double", "l_orderkey": "bigint", "l_linenumber": "int"})
    inference_pipeline_job(spark, raw, InferenceConfig(source=new, destination=gold, model=f"{models}/{run_id}", destination_format="parquet"))
    scored = spark.read.parquet(gold)
    return scored.select("l_orderkey", "l_linenumber", "l_quantity", F.round("predictions", 1).alias("predictions"))


@query("SELECT event_id, user_id, event_type, value FROM events")
def ingest_runs(spark, sf_dir):
    """The ingest job after each of two deliveries, and once with nothing new: every message is stored once."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    source, docs, rejects, checkpoint = (scratch_dir(spark, n) for n in ("topic", "docs", "rejects", "checkpoint"))
    config = IngestConfig(destination=docs, checkpoint=checkpoint, rejects=rejects, schema=EVENT, path=source, batch_size=FILES_PER_BATCH)
    for part in (0, 1):
        publish_json(events.where(F.col("event_id") % 2 == part), path=source)
        ingest_job(spark, config)
    ingest_job(spark, config)
    return spark.read.parquet(docs).select("event_id", "user_id", "event_type", "value")


@query("SELECT * FROM customer")
def publish_arrays(spark, sf_dir):
    """The publish job on files of one JSON array each, read as a consumer would."""
    customers = table(spark, sf_dir, "customer")
    files, path = scratch_dir(spark, "arrays"), scratch_dir(spark, "published")
    number = F.floor(F.col("c_custkey") / ARRAY_RECORDS).alias("file")
    records = customers.select(number, F.to_json(F.struct(*customers.columns)).alias("record"))
    arrays = records.groupBy("file").agg(F.concat(F.lit("["), F.array_join(F.collect_list("record"), ","), F.lit("]")).alias("value"))
    arrays.write.partitionBy("file").text(files)
    publish_job(spark, PublishConfig(json_file=f"{files}/*", path=path))
    return valid_documents(decode_json(spark.read.text(path), customers.schema))


@query(RUNS_SQL + """
SELECT run_id, round(mean_price, 4) AS metric_value, run_name FROM r WHERE mean_price > 200000
ORDER BY mean_price DESC, start_time DESC, run_id LIMIT 1
""")
def select_run(spark, sf_dir):
    """The selection job on a stored table of runs."""
    path = scratch_dir(spark, "runs")
    write_table(monthly_runs(spark, sf_dir), path, mode="append")
    found = select_job(spark, SelectConfig(runs=path, metric_name="mean_price", threshold=200_000, experiment_name="orders"))
    rows = spark.createDataFrame([found] if found else [], "run_id string, metric_value double, run_name string")
    return rows.withColumn("metric_value", F.round("metric_value", 4))
