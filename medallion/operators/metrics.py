"""Quality of predictions. Every function makes one aggregate and returns a small DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from medallion.functions.columns import quoted, resolve
from medallion.operators.ordering import ROWS_PER_RANGE, range_splits, running_total


def _pair(df: DataFrame, label: str, prediction: str) -> tuple[Column, Column]:
    return quoted(resolve(df, label)), quoted(resolve(df, prediction))


def _ratio(top: Column, bottom: Column) -> Column:
    """A share that is 0 when there is nothing to divide by."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def _errors(y: Column, p: Column) -> list[Column]:
    """MAE, MSE, RMSE and R2 as aggregates of one pass; R2 is null for a constant label."""
    e = y.cast("double") - p.cast("double")
    mse = F.avg(e * e)
    spread = F.var_pop(F.when(e.isNotNull(), y.cast("double")))
    return [
        F.avg(F.abs(e)).alias("MAE"),
        mse.alias("MSE"),
        F.sqrt(mse).alias("RMSE"),
        (1 - F.try_divide(mse, spread)).alias("R2"),
    ]


def regression_metrics(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """One row: MAE, MSE, RMSE, R2."""
    return df.agg(*_errors(*_pair(df, label, prediction)))


def classification_metrics(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """One row: Accuracy, and the errors of numeric class codes."""
    y, p = _pair(df, label, prediction)
    return df.agg(F.avg((y == p).cast("double")).alias("Accuracy"), *_errors(y, p))


def binary_metrics(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """One row for classes 0 and 1: Accuracy, Precision, Recall, F1."""
    y, p = _pair(df, label, prediction)
    counts = df.agg(
        F.avg((y == p).cast("double")).alias("Accuracy"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
    )
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select(
        "Accuracy",
        _ratio(tp, tp + fp).alias("Precision"),
        _ratio(tp, tp + fn).alias("Recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("F1"),
    )


def confusion(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Count of every (label, prediction) pair that occurs."""
    y, p = _pair(df, label, prediction)
    return df.groupBy(y.alias("label"), p.alias("prediction")).agg(F.count("*").alias("count"))


def class_report(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, from the confusion counts."""
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("count").alias("support"), F.lit(0).cast("bigint").alias("predicted")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("support"), F.col("count").alias("predicted")),
    )
    hit = F.when(F.col("label") == F.col("prediction"), F.col("side.support")).otherwise(0)
    totals = (
        confusion(df, label, prediction)
        .select("*", F.explode(sides).alias("side"))
        .groupBy("side.class")
        .agg(F.sum(hit).alias("hits"), F.sum("side.support").alias("support"), F.sum("side.predicted").alias("predicted"))
    )
    hits, support, predicted = F.col("hits"), F.col("support"), F.col("predicted")
    return totals.select(
        "class",
        _ratio(hits, predicted).alias("precision"),
        _ratio(hits, support).alias("recall"),
        _ratio(2 * hits, support + predicted).alias("f1"),
        "support",
    )


def auc_roc(df: DataFrame, label: str, score: Column | str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """One row: the exact area under the ROC curve, tied scores counted half.

    Scores are first reduced to one row per distinct value, so ties of any size cost nothing; the
    ranks then come from running totals over ranges of scores. A NaN score is left out like a null one.
    """
    y = quoted(resolve(df, label))
    s = quoted(resolve(df, score)) if isinstance(score, str) else score
    scored = df.select(s.cast("double").alias("s"), (y == 1).cast("bigint").alias("pos"), (y != 1).cast("bigint").alias("neg"))
    scored = scored.where("s IS NOT NULL AND NOT isnan(s) AND pos IS NOT NULL")
    splits = range_splits(scored, "s", scored.count(), rows_per_range)
    distinct = scored.groupBy("s").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    ranked = running_total(distinct, scored, "s", "neg", "below", splits)
    won = F.sum(F.col("pos").cast("double") * (F.col("below") + F.col("neg") / 2))
    return ranked.agg(F.try_divide(won, F.sum("pos").cast("double") * F.sum("neg")).alias("AUC"))
