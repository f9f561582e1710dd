"""Outlier fences and the treatments of values outside them.

Fitting is separate from applying, so that scoring data is treated with the fences of the training
data. Null and NaN are never outliers.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from medallion.functions.columns import INTEGRAL, is_floating, not_nan, quoted, require_absent, resolve
from medallion.operators.ordering import ROWS_PER_RANGE, approx_quantiles, exact_quantiles, neighbours, range_splits

METHODS = ("clamp", "median", "cap", "neighbor")
WHISKER = 1.5
FENCE_SCHEMA = "column string, lower double, upper double, low string, high string, median double, outliers long"


@dataclass(frozen=True)
class Fence:
    """Limits of one column, with the replacements found when fitting.

    ``low`` and ``high`` are the least and greatest values inside the limits, as text so that every
    numeric type comes back unchanged. ``outliers`` counts the values outside them.
    """

    column: str
    lower: float
    upper: float
    low: str | None = None
    high: str | None = None
    median: float | None = None
    outliers: int | None = None


def fit_fences(
    df: DataFrame,
    columns: list[str],
    *,
    bounds: tuple[float, float] | dict[str, tuple[float, float]] | None = None,
    quantiles: str = "exact",
    error: float = 0.05,
    method: str = "clamp",
) -> list[Fence]:
    """Fences of several columns: given ``bounds``, or quartiles widened by 1.5 times their distance.

    ``quantiles='approx'`` takes one pass with a rank ``error``. A column without quartiles gets no
    fence.
    """
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}; use one of {METHODS}")
    if quantiles not in ("exact", "approx"):
        raise ValueError(f"unknown quantiles {quantiles!r}; use 'exact' or 'approx'")
    columns = [resolve(df, c) for c in columns]
    if isinstance(bounds, dict):
        bounds = {resolve(df, c): b for c, b in bounds.items()}
    elif bounds is not None:
        bounds = {c: bounds for c in columns}
    limits = {c: (float(lo), float(hi)) for c, (lo, hi) in (bounds or {}).items() if c in columns}
    open_columns = [c for c in columns if c not in limits]
    measured = columns if method == "median" else open_columns
    shares = [0.25, 0.75, 0.5] if method == "median" else [0.25, 0.75]
    medians: dict[str, float | None] = {}
    if measured:
        found = (
            exact_quantiles(df, measured, shares)
            if quantiles == "exact"
            else approx_quantiles(df, measured, shares, error)
        )
        for c, quartiles in found.items():
            if quartiles[0] is None:
                continue
            q1, q3, *median = map(float, quartiles)
            medians[c] = median[0] if median else None
            # Equal infinite quartiles leave no distance to widen by.
            if c in open_columns and not math.isnan(q3 - q1):
                spread = WHISKER * (q3 - q1)
                limits[c] = (q1 - spread, q3 + spread)
    if method == "median":
        limits = {c: v for c, v in limits.items() if medians.get(c) is not None}
    fences = [Fence(c, *limits[c], median=medians.get(c)) for c in columns if c in limits]
    return fit_edges(df, fences) if method == "clamp" else fences


def fit_edges(df: DataFrame, fences: list[Fence]) -> list[Fence]:
    """Add the outermost values inside each fence and the number of outliers, in one aggregate."""
    if not fences:
        return []
    aggregates = []
    for f in fences:
        c, out = quoted(resolve(df, f.column)), is_outlier(df, f)
        inside = F.when(~out & not_nan(df, f.column), c)
        aggregates += [F.min(inside).cast("string"), F.max(inside).cast("string"), F.count_if(out)]
    row = df.agg(*[a.alias(f"a{i}") for i, a in enumerate(aggregates)]).first()
    return [
        Fence(f.column, f.lower, f.upper, row[3 * i], row[3 * i + 1], f.median, row[3 * i + 2])
        for i, f in enumerate(fences)
    ]


def is_outlier(df: DataFrame, fence: Fence) -> Column:
    """Outside the fence. NULL for a null value, false for NaN."""
    c = quoted(resolve(df, fence.column))
    return not_nan(df, fence.column) & ((c < fence.lower) | (c > fence.upper))


def flag_outliers(df: DataFrame, fences: list[Fence], prefix: str = "outlier_") -> DataFrame:
    """One boolean column per fence, false for null and NaN."""
    require_absent(df, *[prefix + f.column for f in fences])
    return df.select(
        "*", *[F.coalesce(is_outlier(df, f), F.lit(False)).alias(prefix + f.column) for f in fences]
    )


def treat_outliers(
    df: DataFrame,
    fences: list[Fence],
    method: str = "clamp",
    key: list[str] | None = None,
) -> DataFrame:
    """Replace values outside their fence.

    ``clamp``    nearest value inside the fence
    ``median``   median of the column (integers become double)
    ``cap``      the fence limit itself (integers become double)
    ``neighbor`` the adjacent value in the order of (value, ``key``); ``key`` must identify a row
    """
    if method == "neighbor":
        if not key:
            raise ValueError("method 'neighbor' needs the key columns that identify a row")
        return replace_by_neighbour(df, fences, key)
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}; use one of {METHODS}")
    treated = {resolve(df, f.column): _replacement(df, f, method) for f in fences}
    return df.select(*[treated[c].alias(c) if c in treated else quoted(c) for c in df.columns])


def _replacement(df: DataFrame, fence: Fence, method: str) -> Column:
    name = resolve(df, fence.column)
    c, kind = quoted(name), df.schema[name].dataType
    if method == "clamp":
        low, high = (F.coalesce(F.lit(v).cast(kind), c) for v in (fence.low, fence.high))
    else:
        if isinstance(kind, INTEGRAL):
            c = c.cast("double")
        low, high = F.lit(fence.lower), F.lit(fence.upper)
        if method == "median":
            low = high = F.lit(fence.median)
    out = is_outlier(df, fence)
    return F.when(out & (quoted(name) < fence.lower), low).when(out, high).otherwise(c)


def replace_by_neighbour(
    df: DataFrame, fences: list[Fence], key: list[str], rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Outliers take the value before them in sorted order, the very first one the value after it.

    Of equal values only the one with the smallest key sees a different neighbour, so one changed row
    per distinct outlier value is enough. Rows inside every fence pass without a shuffle; the others
    are joined once, by key, to the changes found.
    """
    key = [resolve(df, k) for k in key]
    require_absent(df, "__changes")
    if set(key) & {resolve(df, f.column) for f in fences}:
        raise ValueError("key columns cannot be treated themselves")
    # Whole and decimal numbers keep all their digits; a double is enough for the others.
    floating = [f for f in fences if is_floating(df, resolve(df, f.column))]
    exact = [f for f in fences if f not in floating]
    if floating and exact:
        return replace_by_neighbour(replace_by_neighbour(df, exact, key, rows_per_range), floating, key, rows_per_range)
    scale = max((df.schema[resolve(df, f.column)].dataType.scale for f in exact if isinstance(df.schema[resolve(df, f.column)].dataType, T.DecimalType)), default=0)
    kind = "double" if floating else f"decimal(38,{scale})"
    # Neighbours are sought among these rows, so the edges are theirs, not those of the fitting data.
    fences = fit_edges(df, fences)
    flags = [F.coalesce(is_outlier(df, f), F.lit(False)) for f in fences]
    rows = sum(f.outliers for f in fences)
    if not rows:
        return df
    any_outlier = reduce(or_, [is_outlier(df, f) for f in fences])
    dirty = df.where(any_outlier)
    _require_keys(dirty, key)

    # A plain number as key is combined by hashing, a struct by sorting.
    identity = quoted(key[0]) if len(key) == 1 else F.struct(*[quoted(k) for k in key])
    hits = [
        F.when(flag, F.struct(F.lit(t).alias("t"), quoted(resolve(df, f.column)).cast(kind).alias("x")))
        for t, (f, flag) in enumerate(zip(fences, flags))
    ]
    outliers = dirty.select(identity.alias("key"), F.explode(F.array(*hits)).alias("h")).where("h IS NOT NULL")
    outliers = outliers.select("key", "h.t", "h.x")
    splits = range_splits(outliers, "x", rows, rows_per_range)
    distinct = outliers.groupBy("t", "x").agg(F.min("key").alias("key"), F.count("*").alias("n"))
    edges = {(t, float(v) if floating else Decimal(v)) for t, f in enumerate(fences) for v in (f.low, f.high) if v is not None}
    if edges:
        inner = df.sparkSession.createDataFrame(sorted(edges), f"t int, x {kind}")
        distinct, outliers = (d.unionByName(inner, allowMissingColumns=True) for d in (distinct, outliers))
    names = [F.col("key").alias(key[0])] if len(key) == 1 else ["key.*"]
    after = F.when(F.col("n") > 1, F.col("x")).otherwise(F.col("next"))
    # At most one entry per treated column in each group: a key names one row.
    changes = (
        neighbours(distinct, outliers, "x", "t", splits)
        .where("key IS NOT NULL")
        .select(*names, F.struct("t", F.coalesce("previous", after, "x").alias("x")).alias("__change"))
        .groupBy(*[quoted(k) for k in key])
        .agg(F.map_from_entries(F.collect_list("__change")).alias("__changes"))
    )
    fixed = dirty.join(changes, key, "left")
    treated = {resolve(df, f.column): t for t, f in enumerate(fences)}
    fixed = fixed.select(
        *[
            F.coalesce(F.when(flags[treated[c]], F.col("__changes")[treated[c]].cast(df.schema[c].dataType)), quoted(c)).alias(c)
            if c in treated
            else quoted(c)
            for c in df.columns
        ]
    )
    return df.where(~F.coalesce(any_outlier, F.lit(False))).unionByName(fixed)


def _require_keys(rows: DataFrame, key: list[str]) -> None:
    """The key must name each of the rows."""
    missing = reduce(or_, [quoted(k).isNull() for k in key])
    found = rows.groupBy(*[quoted(k) for k in key]).agg(F.count("*").alias("__n"), F.max(missing).alias("__null"))
    worst = found.agg(F.max("__n"), F.max("__null")).first()
    if worst[1]:
        raise ValueError(f"key columns {key} are null in rows with outliers")
    if (worst[0] or 0) > 1:
        raise ValueError(f"key columns {key} are not unique among rows with outliers")


def fences_to_frame(spark: SparkSession, fences: list[Fence]) -> DataFrame:
    """Fences as a small table, to be stored beside a model."""
    rows = [(f.column, f.lower, f.upper, f.low, f.high, f.median, f.outliers) for f in fences]
    return spark.createDataFrame(rows, FENCE_SCHEMA)


def fences_from_frame(df: DataFrame) -> list[Fence]:
    """Fences of a stored table; one row per treated column."""
    return [Fence(**row.asDict()) for row in df.select(*Fence.__dataclass_fields__).collect()]
