"""Casts, derived columns and dropped columns from declarative maps."""

from __future__ import annotations

import logging
from datetime import date

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, functions as F

from medallion.functions.columns import cast_column, date_literal, quoted, resolve

log = logging.getLogger(__name__)


def cast_columns(df: DataFrame, types: dict[str, str] | None, mode: str = "permissive") -> DataFrame:
    """Cast by ``{column: type}`` in one projection; a column that is not there is an error."""
    if not types:
        return df
    wanted = {resolve(df, name): target for name, target in types.items()}
    return df.select(
        *[cast_column(df, c, wanted[c], mode).alias(c) if c in wanted else quoted(c) for c in df.columns]
    )


def derive_columns(
    df: DataFrame,
    expressions: dict[str, str] | None,
    as_of: date | str | None = None,
    on_error: str = "raise",
) -> DataFrame:
    """Add ``{column: Spark SQL expression}`` in order, so later ones may use earlier ones.

    ``{as_of}`` inside an expression stands for the reference date of the run. With
    ``on_error='skip'`` an expression Spark cannot analyse is logged and left out.
    """
    if on_error not in ("raise", "skip"):
        raise ValueError(f"unknown on_error {on_error!r}")
    for name, text in (expressions or {}).items():
        try:
            df = df.withColumn(name, F.expr(text.replace("{as_of}", date_literal(as_of))))
        except (AnalysisException, ParseException) as error:
            if on_error == "raise":
                raise
            log.warning("skipped %s = %s: %s", name, text, error)
    return df


def drop_columns(df: DataFrame, columns: list[str] | None) -> DataFrame:
    """Drop columns; names that are not there are ignored."""
    return df.drop(*columns) if columns else df


def project(df: DataFrame, columns: list[str]) -> DataFrame:
    """Exactly these columns in this order."""
    return df.select(*[quoted(resolve(df, c)) for c in columns])


def split_target(df: DataFrame, target: str) -> tuple[list[str], str]:
    """Feature columns and the target column of a training table."""
    target = resolve(df, target)
    return [c for c in df.columns if c != target], target
