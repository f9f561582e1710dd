"""Configuration of the jobs, readable from YAML."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field, fields

VARIABLE = re.compile(r"\$\{(\w+)\}")


@dataclass
class TransformConfig:
    """Bronze to silver. Buckets and keys are joined to paths."""

    source: str
    destination: str
    column_types_to_convert: dict[str, str] = field(default_factory=dict)
    columns_to_remove: list[str] = field(default_factory=list)
    feature_engineering_transformations: dict[str, str] = field(default_factory=dict)
    numerical_columns_list: list[str] = field(default_factory=list)
    source_format: str = "csv"
    source_options: dict = field(default_factory=dict)
    destination_format: str = "parquet"
    cast_mode: str = "permissive"
    on_error: str = "raise"
    outlier_method: str = "clamp"
    outlier_bounds: list[float] | None = None
    outlier_quantiles: str = "exact"
    outlier_key: list[str] | None = None
    fences: str | None = None
    as_of: str | None = None


@dataclass
class DocumentConfig:
    """Nested documents to bronze."""

    source: str
    destination: str
    source_format: str = "json"
    source_options: dict = field(default_factory=dict)
    array_file: bool = False
    repeated: str = "last"
    #: Where lines that are no documents go; beside the destination unless given.
    rejects: str | None = None


@dataclass
class RelationalConfig:
    """A query's result to bronze. Connection settings come as JDBC options."""

    query: str
    destination: str
    url: str | None = None
    jdbc: dict = field(default_factory=dict)
    header: bool = True


@dataclass
class TrainConfig:
    """Silver to a stored model and a run record."""

    source: str
    target_feature: str
    experiment_name: str
    models: str
    runs: str
    estimator: str = "random_forest_regressor"
    params: dict = field(default_factory=dict)
    source_format: str = "parquet"
    source_options: dict = field(default_factory=dict)
    exclude: list[str] = field(default_factory=list)
    split_key: list[str] | None = None
    test_percent: int = 20
    seed: int = 42
    preprocessing: dict = field(default_factory=dict)


@dataclass
class SelectConfig:
    """Choice of the best run."""

    runs: str
    metric_name: str
    threshold: float
    comparison_operator: str = "greater"
    experiment_name: str | None = None


@dataclass
class InferenceConfig:
    """Processed input to predictions."""

    source: str
    destination: str
    model: str
    source_format: str = "parquet"
    source_options: dict = field(default_factory=dict)
    destination_format: str = "csv"


@dataclass
class IngestConfig:
    """Messages to documents. ``path`` names a folder, otherwise a topic is read.

    ``path_format`` tells what the folder holds: ``text`` (a message per line) or ``messages`` (Parquet with topic, partition,
    offset and value). ``delivery`` is ``path`` (a directory per micro-batch), ``commit`` (committed runs, each message once
    by its offset) or ``store`` (``store_format`` with ``store_options``). Runs with a ``message_limit`` are always committed runs.
    Committed runs take ``schema: evolve`` for documents that bring their own fields.
    """

    destination: str
    checkpoint: str | None = None
    rejects: str | None = None
    schema: str | None = None
    path: str | None = None
    path_format: str = "text"
    bootstrap_servers: str | None = None
    topic: str | None = None
    group_id: str | None = None
    batch_size: int | None = None
    message_limit: int | None = None
    delivery: str = "path"
    store_format: str | None = None
    store_options: dict = field(default_factory=dict)
    source_options: dict = field(default_factory=dict)


@dataclass
class PublishConfig:
    """Records of a JSON file to a topic, or to text files."""

    json_file: str
    bootstrap_servers: str | None = None
    topic: str | None = None
    path: str | None = None


def from_map(kind, values: dict, root: str = ""):
    """A configuration from a map.

    ``source_bucket`` and ``source_object_key`` together give ``source``, likewise for the destination.
    ``${NAME}`` is read from the environment. Keys the job does not use are refused, so that a
    misspelt one does not pass unnoticed.
    """
    values = _filled(dict(values))
    for end in ("source", "destination"):
        bucket, key = values.pop(f"{end}_bucket", None), values.pop(f"{end}_object_key", None)
        if bucket is not None and key is not None:
            values.setdefault(end, f"{root}{bucket}/{key}")
    unknown = set(values) - {f.name for f in fields(kind)}
    if unknown:
        raise ValueError(f"{kind.__name__} does not know {sorted(unknown)}")
    return kind(**values)


def from_yaml(kind, path: str, section: str | None = None, root: str = ""):
    """A configuration from a YAML file, or from one (dotted) section of it."""
    import yaml

    with open(path, encoding="utf-8") as stream:
        values = yaml.safe_load(stream)
    for name in section.split(".") if section else ():
        values = values[name]
    return from_map(kind, values, root)


def _filled(value):
    if isinstance(value, str):
        return VARIABLE.sub(lambda m: os.environ[m.group(1)], value)
    if isinstance(value, dict):
        return {k: _filled(v) for k, v in value.items()}
    if isinstance(value, list):
        return [_filled(v) for v in value]
    return value
