"""The jobs: extracts, transformation, training, selection, inference and ingestion."""

from __future__ import annotations

import uuid
from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession, functions as F

from medallion.functions.columns import quoted, resolve
from medallion.operators.clean import cast_columns, derive_columns, drop_columns
from medallion.operators.documents import PATIENT_SCHEMA, PATIENT_SPEC, as_text, decode_json, flatten, quarantine, valid_documents
from medallion.operators.features import hash_split
from medallion.operators.metrics import auc_roc, binary_metrics, classification_metrics, regression_metrics
from medallion.operators.models import load_model, make_estimator, save_model, score, train_model
from medallion.operators.outliers import Fence, fences_from_frame, fences_to_frame, fit_fences, treat_outliers
from medallion.operators.runs import best_run, log_run, read_runs
from medallion.plans.config import (
    DocumentConfig,
    InferenceConfig,
    IngestConfig,
    PublishConfig,
    RelationalConfig,
    SelectConfig,
    TrainConfig,
    TransformConfig,
)
from medallion.session import staged
from medallion.sources.documents import BrokerTopic, FolderTopic, Topic, file_stream, read_documents
from medallion.sources.relational import read_jdbc, read_sql
from medallion.sources.sinks import publish_json, write_csv, write_if_any, write_table
from medallion.sources.tables import read_csv, read_table
from medallion.streaming.ingest import ingest_committed_stream, ingest_json_stream, store_sink
from medallion.streaming.ledger import ingest_next

COLUMNAR = ("parquet", "orc", "delta")


def _load(spark: SparkSession, path: str, fmt: str, options: dict) -> DataFrame:
    return read_csv(spark, path, **options) if fmt == "csv" else read_table(spark, path, fmt, **options)


def _store(df: DataFrame, path: str, fmt: str) -> None:
    write_csv(df, path) if fmt == "csv" else write_table(df, path, fmt, "overwrite")


def prepare(df: DataFrame, config: TransformConfig) -> DataFrame:
    """Cast, derive, drop."""
    df = cast_columns(df, config.column_types_to_convert, config.cast_mode)
    df = derive_columns(df, config.feature_engineering_transformations, config.as_of, config.on_error)
    return drop_columns(df, config.columns_to_remove)


def fit(prepared: DataFrame, config: TransformConfig) -> list[Fence]:
    """The fences of the columns to treat."""
    return fit_fences(
        prepared,
        config.numerical_columns_list,
        bounds=tuple(config.outlier_bounds) if config.outlier_bounds else None,
        quantiles=config.outlier_quantiles,
        method=config.outlier_method,
    )


def treat(prepared: DataFrame, config: TransformConfig, fences: list[Fence]) -> DataFrame:
    """Treat the outliers of the configured columns; fences of other columns are left aside."""
    wanted = {c.lower() for c in config.numerical_columns_list}
    fences = [f for f in fences if f.column.lower() in wanted]
    return treat_outliers(prepared, fences, config.outlier_method, config.outlier_key)


def transform(df: DataFrame, config: TransformConfig, fences: list[Fence] | None = None) -> tuple[DataFrame, list[Fence]]:
    """Cast, derive, drop, then treat outliers; with the fences given, or with fences fitted here."""
    prepared = prepare(df, config)
    fences = fit(prepared, config) if fences is None else fences
    return treat(prepared, config, fences), fences


def transform_job(spark: SparkSession, config: TransformConfig, apply_stored: bool = False) -> list[Fence]:
    """Bronze to silver. Fitted fences are stored where ``config.fences`` says.

    ``apply_stored=True`` treats new input with the stored fences of the training data, in one pass.
    Fitting reads the treated columns several times, so text input is first staged as Parquet.
    """
    prepared = prepare(_load(spark, config.source, config.source_format, config.source_options), config)
    if apply_stored:
        if not config.fences:
            raise ValueError("applying stored fences needs their path in config.fences")
        fences = fences_from_frame(spark.read.parquet(config.fences))
        _store(treat(prepared, config, fences), config.destination, config.destination_format)
        return fences
    columnar = config.source_format in COLUMNAR or not config.numerical_columns_list
    with nullcontext(prepared) if columnar else staged(prepared, "prepared") as rows:
        fences = fit(rows, config)
        _store(treat(rows, config, fences), config.destination, config.destination_format)
    if config.fences:
        fences_to_frame(spark, fences).write.mode("overwrite").parquet(config.fences)
    return fences


def extract_documents_job(spark: SparkSession, config: DocumentConfig) -> None:
    """Nested patient documents to flat CSV. Values keep their text, so an age of ``"51"`` or ``51.5`` stays as it is.

    Of JSON lines, those that are no documents are kept as they came, in ``rejects``.
    """
    schema = as_text(PATIENT_SCHEMA)
    if config.source_format == "json" and not config.array_file:
        lines = spark.read.options(**config.source_options).text(config.source).where(F.trim("value") != "")
        # Rejects and documents both come from the decoded lines, which are decoded once.
        with staged(decode_json(lines, schema), "decoded") as decoded:
            write_if_any(quarantine(decoded), lambda df: df.write.mode("overwrite").text(config.rejects or f"{config.destination.rstrip('/')}.rejects"))
            write_csv(flatten(valid_documents(decoded), PATIENT_SPEC, many=config.repeated), config.destination, blank_empty=True)
        return
    documents = read_documents(spark, config.source, schema, fmt=config.source_format, array_file=config.array_file, **config.source_options)
    write_csv(flatten(documents, PATIENT_SPEC, many=config.repeated), config.destination, blank_empty=True)


def extract_relational_job(spark: SparkSession, config: RelationalConfig) -> bool:
    """The result of a query to CSV; nothing is written for an empty result."""
    rows = read_jdbc(spark, config.url, config.query, **config.jdbc) if config.url else read_sql(spark, config.query)
    return write_if_any(rows, lambda df: write_csv(df, config.destination, header=config.header), once=True)


def evaluate(test: DataFrame, model, target: str, classifier: bool) -> dict[str, float]:
    """Metrics on the test rows: of a classifier of 0 and 1 also AUC (from its own score), precision, recall and F1."""
    if not classifier:
        return regression_metrics(score(test, model), target, "predictions").first().asDict()
    found = test.select(quoted(resolve(test, target)).alias("y")).where("y IS NOT NULL").agg(F.min("y"), F.max("y"), F.bool_and(F.col("y").isin(0, 1))).first()
    if tuple(found) != (0, 1, True):
        return classification_metrics(score(test, model), target, "predictions").first().asDict()
    scored = score(test, model, raw="__score").persist()
    try:
        errors = classification_metrics(scored, target, "predictions").first().asDict()
        return errors | binary_metrics(scored, target, "predictions").first().asDict() | auc_roc(scored, target, "__score").first().asDict()
    finally:
        scored.unpersist()


def train_job(spark: SparkSession, config: TrainConfig) -> tuple[str, dict[str, float]]:
    """Split, fit on the training rows, evaluate on the others, store the model, record the run."""
    df = _load(spark, config.source, config.source_format, config.source_options)
    train, test = hash_split(df, config.test_percent, config.seed, config.split_key)
    estimator = make_estimator(config.estimator, **config.params)
    exclude = [*config.exclude, *(config.split_key or [])]
    model = train_model(train, estimator, config.target_feature, exclude=exclude, **config.preprocessing)
    metrics = evaluate(test, model, config.target_feature, config.estimator.endswith("classifier"))
    run_id = uuid.uuid4().hex
    path = f"{config.models.rstrip('/')}/{run_id}"
    save_model(model, path)
    params = {"estimator": config.estimator, "model": path, **config.params}
    log_run(spark, config.runs, config.experiment_name, metrics, params, run_id=run_id)
    return run_id, metrics


def select_job(spark: SparkSession, config: SelectConfig) -> tuple[str, float, str] | None:
    """``(run_id, metric_value, run_name)`` of the best run, or None."""
    found = best_run(
        read_runs(spark, config.runs), config.metric_name, config.threshold, config.comparison_operator, config.experiment_name
    ).first()
    return tuple(found) if found else None


def inference_job(spark: SparkSession, config: InferenceConfig) -> bool:
    """Score processed input with a stored model; nothing is written for an empty input."""
    df = _load(spark, config.source, config.source_format, config.source_options)
    model = load_model(config.model)
    return write_if_any(df, lambda rows: _store(score(rows, model), config.destination, config.destination_format))


def inference_pipeline_job(spark: SparkSession, transformation: TransformConfig, inference: InferenceConfig) -> bool:
    """Raw input to predictions as one plan: cast, derive, drop, treat with the stored fences, score, write.

    Source and preparation come from ``transformation``, model and destination from ``inference``. Nothing is fitted here and
    nothing is written in between; an empty input writes nothing.
    """
    if not transformation.fences:
        raise ValueError("inference treats its input with the fences of the training data; give their path in fences")
    raw = _load(spark, transformation.source, transformation.source_format, transformation.source_options)
    if raw.isEmpty():
        return False
    fences = fences_from_frame(spark.read.parquet(transformation.fences))
    ready = treat(prepare(raw, transformation), transformation, fences)
    _store(score(ready, load_model(inference.model)), inference.destination, inference.destination_format)
    return True


def message_topic(config: IngestConfig) -> Topic:
    """Where the messages of an ingest come from."""
    if config.path:
        return FolderTopic(config.path)
    options = {"groupIdPrefix": config.group_id, **config.source_options} if config.group_id else config.source_options
    return BrokerTopic(config.bootstrap_servers, config.topic, options)


def ingest_job(spark: SparkSession, config: IngestConfig) -> None:
    """Messages to documents, until the input present now is consumed.

    With ``message_limit`` a run takes the next readable messages after those of the runs before it; without it a stream
    goes on where its checkpoint ended.
    """
    if config.delivery not in ("path", "commit", "store") or config.path_format not in ("text", "messages"):
        raise ValueError("delivery is 'path', 'commit' or 'store', path_format 'text' or 'messages'")
    lines = config.path is not None and config.path_format == "text"
    if lines and (config.message_limit is not None or config.delivery == "commit"):
        raise ValueError("lines of text have no offsets; committed runs need those of a topic")
    if config.message_limit is not None:
        ingest_next(spark, message_topic(config), config.schema, config.destination, config.message_limit, config.rejects)
        return
    if config.checkpoint is None:
        raise ValueError("a stream needs a checkpoint")
    if lines:
        stream = file_stream(spark, config.path, config.batch_size)
    else:
        stream = message_topic(config).stream(spark, config.batch_size)
    if config.delivery == "commit":
        query = ingest_committed_stream(stream, config.schema, config.destination, config.checkpoint, rejects=config.rejects, gaps_stay=config.path is None)
    elif config.delivery == "store":
        sink = store_sink(config.store_format, **config.store_options)
        query = ingest_json_stream(stream, config.schema, sink, config.checkpoint, rejects=config.rejects, keep_id=not lines)
    else:
        query = ingest_json_stream(stream, config.schema, config.destination, config.checkpoint, rejects=config.rejects)
    query.awaitTermination()


def publish_job(spark: SparkSession, config: PublishConfig) -> None:
    """Every record of a JSON array file as one message."""
    records = read_documents(spark, config.json_file, array_file=True)
    publish_json(records, servers=config.bootstrap_servers, topic=config.topic, path=config.path, keep_nulls=False)
