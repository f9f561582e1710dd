"""The table of training runs and the choice of the best one."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

RUN_SCHEMA = (
    "run_id string, run_name string, experiment string, start_time timestamp, "
    "params map<string,string>, metrics map<string,double>"
)


def run_row(
    experiment: str,
    metrics: dict[str, float],
    params: dict | None = None,
    *,
    run_id: str | None = None,
    start_time: datetime | None = None,
) -> tuple:
    """One run; its name is the experiment followed by the day as ``dd-mm-yy``."""
    start = start_time or datetime.now(timezone.utc)
    return (
        run_id or uuid.uuid4().hex,
        f"{experiment}{start:%d-%m-%y}",
        experiment,
        start,
        {k: str(v) for k, v in (params or {}).items()},
        {k: float(v) for k, v in metrics.items() if v is not None},
    )


def log_run(spark: SparkSession, path: str, experiment: str, metrics: dict[str, float], params: dict | None = None, **kwargs) -> str:
    """Append one run to the runs table and return its id."""
    row = run_row(experiment, metrics, params, **kwargs)
    spark.createDataFrame([row], RUN_SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return row[0]


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(path)


def _qualified(runs: DataFrame, metric: str, threshold: float, operator: str, experiment: str | None) -> tuple[DataFrame, Column]:
    """Runs strictly beyond the threshold, and a struct that is smallest for the best of them."""
    if operator not in ("greater", "less"):
        raise ValueError(f"unknown operator {operator!r}; use 'greater' or 'less'")
    if experiment is not None:
        runs = runs.where(F.col("experiment") == experiment)
    value = F.try_element_at(F.col("metrics"), F.lit(metric))
    runs = runs.withColumn("metric_value", value).where(~F.isnan("metric_value"))
    beyond = F.col("metric_value") > threshold if operator == "greater" else F.col("metric_value") < threshold
    merit = -F.col("metric_value") if operator == "greater" else F.col("metric_value")
    # Equal metrics: the newest run wins, then the smallest id.
    age = -F.unix_micros(F.col("start_time").cast("timestamp"))
    rank = F.struct(merit.alias("merit"), age.isNull().alias("undated"), age.alias("age"), "run_id", "metric_value", "run_name")
    return runs.where(beyond), rank


def leaderboard(runs: DataFrame, metric: str, threshold: float, operator: str = "greater", experiment: str | None = None) -> DataFrame:
    """The best run of every name among those strictly beyond the threshold."""
    found, rank = _qualified(runs, metric, threshold, operator, experiment)
    # A minimum of structs is combined before the shuffle, so a name with most of the runs is no hot spot.
    best = found.groupBy("run_name").agg(F.min(rank).alias("best"))
    return best.select("best.run_id", "best.metric_value", "run_name")


def best_run(runs: DataFrame, metric: str, threshold: float, operator: str = "greater", experiment: str | None = None) -> DataFrame:
    """The best run of all, or no row when none is beyond the threshold."""
    found, rank = _qualified(runs, metric, threshold, operator, experiment)
    best = found.agg(F.min(rank).alias("best")).where("best IS NOT NULL")
    return best.select("best.run_id", "best.metric_value", "best.run_name")
