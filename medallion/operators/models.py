"""Training, scoring and storing of fitted pipelines."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager, nullcontext

import pandas as pd
from pyspark import StorageLevel, cloudpickle
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from medallion.functions.columns import quoted, require_absent, resolve
from medallion.operators.features import build_preprocessor, feature_columns

ESTIMATORS = {
    "linear_regression": LinearRegression,
    "random_forest_regressor": RandomForestRegressor,
    "random_forest_classifier": RandomForestClassifier,
}
MAX_MODEL_BYTES = 256 << 20
#: Training rows of a piece. A forest depends on how rows are dealt out, so pieces follow the rows alone, not the cluster.
ROWS_PER_PIECE = 200_000
LEAST_PIECES = 8
#: Equal rows that stay together when they are dealt out.
EQUAL_ROWS = 1024


def make_estimator(name: str, **params):
    """An MLlib estimator by name; forests are seeded unless told otherwise."""
    if name not in ESTIMATORS:
        raise ValueError(f"unknown estimator {name!r}; use one of {sorted(ESTIMATORS)}")
    if name.startswith("random_forest"):
        params = {"seed": 42, **params}
    if name == "random_forest_classifier":
        params = {"numTrees": 100, **params}
    return ESTIMATORS[name](**params)


def build_model(train: DataFrame, estimator, target: str, features: str = "features") -> PipelineModel:
    """Fit any estimator on an assembled feature vector."""
    estimator = estimator.copy()
    estimator.setFeaturesCol(features)
    estimator.setLabelCol(resolve(train, target))
    return Pipeline(stages=[estimator]).fit(train)


def train_model(
    train: DataFrame,
    estimator,
    target: str,
    *,
    exclude: list[str] | None = None,
    encoding: str = "onehot",
    max_categories: int | None = None,
    rows_per_piece: int = ROWS_PER_PIECE,
    cache: bool = True,
    **preprocessing,
) -> PipelineModel:
    """Fit preprocessing and estimator as one pipeline on the training rows only.

    Rows without a target are left out. Only the columns the pipeline needs are kept, and cached while
    fitting (on disk where memory ends), since every stage and every iteration reads them again. They are dealt to pieces by
    their content, so the same rows give the same model however the input lies.
    """
    target = resolve(train, target)
    numeric, text = feature_columns(train, target, exclude)
    rows = train.select(*[quoted(c) for c in (*numeric, *text, target)]).where(quoted(target).isNotNull())
    estimator = estimator.copy()
    estimator.setFeaturesCol("features")
    estimator.setLabelCol(target)
    prepare = build_preprocessor(numeric, text, encoding=encoding, max_categories=max_categories, **preprocessing)
    rows = dealt(rows, rows_per_piece)
    with _cached(rows) if cache else nullcontext(rows) as rows:
        return Pipeline(stages=[*prepare.getStages(), estimator]).fit(rows)


def dealt(rows: DataFrame, rows_per_piece: int = ROWS_PER_PIECE) -> DataFrame:
    """The rows in pieces that their content and number decide, in an order that their content decides.

    Equal rows are counted before they move, and dealt to the pieces in lots, so that a row which occurs very often
    does not fill one piece.
    """
    require_absent(rows, "__n", "__lot", "__piece", "__row")
    names = [quoted(c) for c in rows.columns]
    total = rows.count()
    pieces = max(LEAST_PIECES, -(-total // rows_per_piece))
    counted = rows.groupBy(*names).agg(F.count("*").alias("__n"))
    lots = counted.withColumn("__lot", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(__n - 1) div {EQUAL_ROWS}"))))
    many = F.lit(pieces).cast("long")
    piece = F.pmod(F.pmod(F.xxhash64(*names), many) + F.pmod("__lot", many), many).cast("int")
    size = F.least(F.lit(EQUAL_ROWS).cast("long"), F.col("__n") - F.col("__lot") * EQUAL_ROWS)
    placed = lots.select(*names, piece.alias("__piece"), size.alias("__n")).repartitionById(pieces, "__piece").sortWithinPartitions("__piece", *names)
    return placed.select(*names, F.explode(F.sequence(F.lit(1).cast("long"), F.col("__n"))).alias("__row")).drop("__row")


@contextmanager
def _cached(df: DataFrame) -> Iterator[DataFrame]:
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def score(df: DataFrame, model: PipelineModel, output: str = "predictions", raw: str | None = None) -> DataFrame:
    """Append the prediction to the input columns; with ``raw``, a binary classifier's score of class 1 under that name."""
    require_absent(df, output, "prediction", *([raw] if raw else []))
    more = [vector_to_array("rawPrediction")[1].alias(raw)] if raw else []
    return model.transform(df).select(*[quoted(c) for c in df.columns], F.col("prediction").alias(output), *more)


def score_python_model(
    df: DataFrame,
    model=None,
    *,
    load: Callable[[], object] | None = None,
    output: str = "predictions",
    columns: list[str] | None = None,
    returns: str = "double",
    max_bytes: int = MAX_MODEL_BYTES,
) -> DataFrame:
    """Append the predictions of any object with ``predict(pandas_frame)``, batch by batch.

    A model object is broadcast, provided its pickled size is at most ``max_bytes``. For a larger
    one give ``load``, called once per task to fetch the model from shared storage.
    """
    if (model is None) == (load is None):
        raise ValueError("give exactly one of model and load")
    require_absent(df, output)
    if model is not None:
        payload = cloudpickle.dumps(model)
        if len(payload) > max_bytes:
            raise ValueError(f"the model has {len(payload)} bytes, more than {max_bytes}; give load= instead")
        shared = df.sparkSession.sparkContext.broadcast(payload)

        def load():
            return cloudpickle.loads(shared.value)

    fetch = load

    @pandas_udf(returns)
    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        fitted = fetch()
        for batch in batches:
            yield pd.Series(fitted.predict(batch))

    names = [resolve(df, c) for c in columns] if columns else df.columns
    return df.withColumn(output, predict(F.struct(*[quoted(c) for c in names])))


def save_model(model: PipelineModel, path: str, overwrite: bool = True) -> None:
    writer = model.write()
    (writer.overwrite() if overwrite else writer).save(path)


def load_model(path: str) -> PipelineModel:
    """A stored pipeline; fails when there is none."""
    return PipelineModel.load(path)
