"""Quantile sketches that are stored per delivery and merged, so that fences follow new data without reading the old rows again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from medallion.functions.columns import number_or_null, resolve
from medallion.operators.outliers import WHISKER, Fence

#: Size parameter of a sketch: the rank error of a quantile is about 2.3 / size ** 0.9, here a third of a percent.
SIZE = 1500
SKETCH_SCHEMA = "column string, n long, least double, greatest double, sketch binary, delivery string"


def sketch_columns(df: DataFrame, columns: list[str], size: int = SIZE) -> DataFrame:
    """``(column, n, least, greatest, sketch)`` of numeric columns, all in one pass; null and NaN are skipped."""
    names = [resolve(df, c) for c in columns]
    rows = []
    for c in names:
        x = number_or_null(df, c)
        rows.append(F.struct(F.lit(c).alias("column"), F.count(x).alias("n"), F.min(x).alias("least"), F.max(x).alias("greatest"), F.kll_sketch_agg_double(x, size).alias("sketch")))
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def store_sketches(df: DataFrame, columns: list[str], path: str, delivery: str, size: int = SIZE) -> None:
    """Write the sketches of a delivery. One that comes again replaces its own."""
    sketch_columns(df, columns, size).write.mode("overwrite").parquet(f"{path.rstrip('/')}/delivery={delivery}")


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SKETCH_SCHEMA).option("basePath", path).parquet(path)


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """One sketch per column over all deliveries; deliveries without a value of it add nothing."""
    merged = F.kll_merge_agg_double(F.when(F.col("n") > 0, F.col("sketch"))).alias("sketch")
    return sketches.groupBy("column").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("greatest").alias("greatest"), merged)


def sketched_quantiles(sketches: DataFrame, probabilities: list[float]) -> dict[str, list[float | None]]:
    """Quantiles per column out of stored sketches, each a value of the column; nothing else is read."""
    shares = F.array(*[F.lit(float(p)) for p in probabilities])
    found = merge_sketches(sketches).withColumn("q", F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", shares)))
    # One row per column.
    return {r["column"]: list(r.q) if r.q is not None else [None] * len(probabilities) for r in found.select("column", "q").collect()}


def sketched_fences(sketches: DataFrame, columns: list[str] | None = None) -> list[Fence]:
    """Quartile fences out of stored sketches. They have no replacements: ``cap`` and ``median`` need none."""
    fences = []
    for column, (q1, q2, q3) in sketched_quantiles(sketches, [0.25, 0.5, 0.75]).items():
        if q1 is not None and (columns is None or column in columns):
            spread = WHISKER * (q3 - q1)
            fences.append(Fence(column, q1 - spread, q3 + spread, median=q2))
    return sorted(fences, key=lambda f: f.column)
