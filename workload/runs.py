"""Runs, derived from the orders: a run per priority and month, measured by the mean price."""

from __future__ import annotations

from pyspark.sql import functions as F

from medallion.operators.runs import best_run, leaderboard, read_runs
from medallion.session import scratch_dir
from medallion.sources.sinks import write_table
from workload import query, table

RUNS_SQL = """
WITH r AS (SELECT o_orderpriority || '/' || strftime(o_orderdate, '%Y-%m') AS run_id, o_orderpriority AS run_name,
                  avg(o_totalprice) AS mean_price, min(o_orderdate) AS start_time
           FROM orders GROUP BY 1, 2)
"""


def monthly_runs(spark, sf_dir):
    month = F.date_format("o_orderdate", "yyyy-MM")
    grouped = (
        table(spark, sf_dir, "orders")
        .groupBy(F.concat_ws("/", "o_orderpriority", month).alias("run_id"), F.col("o_orderpriority").alias("run_name"))
        .agg(F.avg("o_totalprice").alias("mean_price"), F.min("o_orderdate").alias("start_time"), F.count("*").alias("n"))
    )
    return grouped.select(
        "run_id",
        "run_name",
        F.lit("orders").alias("experiment"),
        F.col("start_time").cast("timestamp").alias("start_time"),
        F.create_map(F.lit("orders"), F.col("n").cast("string")).alias("params"),
        F.create_map(F.lit("mean_price"), "mean_price").alias("metrics"),
    )


def _rounded(df):
    return df.select("run_id", F.round("metric_value", 4).alias("metric_value"), "run_name")


@query(RUNS_SQL + """
SELECT run_id, round(mean_price, 4) AS metric_value, run_name
FROM (SELECT *, row_number() OVER (PARTITION BY run_name ORDER BY mean_price DESC, start_time DESC, run_id) AS n FROM r WHERE mean_price > 200000)
WHERE n = 1
""")
def best_by_name(spark, sf_dir):
    """Runs appended to the runs table, then the best of every name."""
    path = scratch_dir(spark, "runs")
    write_table(monthly_runs(spark, sf_dir), path, mode="append")
    return _rounded(leaderboard(read_runs(spark, path), "mean_price", 200_000, "greater", "orders"))


@query(RUNS_SQL + """
SELECT run_id, round(mean_price, 4) AS metric_value, run_name FROM r WHERE mean_price > 200000
ORDER BY mean_price DESC, start_time DESC, run_id LIMIT 1
""")
def best_greater(spark, sf_dir):
    return _rounded(best_run(monthly_runs(spark, sf_dir), "mean_price", 200_000, "greater"))


@query(RUNS_SQL + """
SELECT run_id, round(mean_price, 4) AS metric_value, run_name FROM r WHERE mean_price < 300000
ORDER BY mean_price, start_time DESC, run_id LIMIT 1
""")
def best_less(spark, sf_dir):
    return _rounded(best_run(monthly_runs(spark, sf_dir), "mean_price", 300_000, "less"))
