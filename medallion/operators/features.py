"""Feature preparation: column kinds, imputation, scaling, encoding and the train/test split."""

from __future__ import annotations

import math

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.feature import FeatureHasher, Imputer, OneHotEncoder, StandardScaler, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F, types as T

from medallion.functions.columns import hash_number, number_or_null, quoted, resolve, row_key
from medallion.operators.categories import CategoryIndexer
from medallion.operators.ordering import exact_quantiles, order_statistics

HASH_DIGITS = 13


def feature_columns(df: DataFrame, target: str | None = None, exclude: list[str] | None = None) -> tuple[list[str], list[str]]:
    """Numeric and text feature columns, sorted; the target is in neither."""
    out = {resolve(df, c) for c in [*([target] if target else []), *(exclude or [])]}
    fields = [f for f in df.schema.fields if f.name not in out]
    numeric = sorted(f.name for f in fields if isinstance(f.dataType, T.NumericType))
    text = sorted(f.name for f in fields if isinstance(f.dataType, T.StringType))
    return numeric, text


def hash_split(df: DataFrame, test_percent: int = 20, seed: int = 42, key: list[str] | None = None, exact: bool = False) -> tuple[DataFrame, DataFrame]:
    """Train and test rows, decided by the MD5 of the row's key and the seed.

    The split does not depend on partitioning or row order, and rows with equal keys stay together.
    ``exact=True`` takes ``ceil(n * percent / 100)`` rows for the test, to within the rows that share
    the hash at the edge, by looking up that hash instead of sorting.
    """
    if test_percent != int(test_percent):
        raise ValueError("test_percent must be a whole number")
    if not 0 < test_percent < 100:
        raise ValueError("test_percent must be between 0 and 100")
    identity = row_key(df, key)
    if not exact:
        is_test = hash_number(identity, seed) % 100 < test_percent
        return df.where(~is_test), df.where(is_test)
    number = hash_number(identity, seed, HASH_DIGITS)

    def last(n: int) -> set[int]:
        return {math.ceil(n * test_percent / 100) - 1}

    n, found = order_statistics(df.select(number.alias("h")), ["h"], last)["h"]
    if not n:
        return df, df.limit(0)
    (edge,) = found.values()
    is_test = number <= F.lit(edge)
    return df.where(~is_test), df.where(is_test)


class _Columns(Params):
    """Input columns of a stage that works on several columns at once."""

    inputCols = Param(Params._dummy(), "inputCols", "input columns", TypeConverters.toListString)
    outputCols = Param(Params._dummy(), "outputCols", "output columns", TypeConverters.toListString)

    def _pairs(self):
        return list(zip(self.getOrDefault(self.inputCols), self.getOrDefault(self.outputCols)))


class MedianImputer(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Replace null and NaN by the interpolated median; the result is double."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df):
        columns = self.getOrDefault(self.inputCols)
        found = exact_quantiles(df, columns, [0.5])
        empty = [c for c in columns if found[c][0] is None]
        if empty:
            raise ValueError(f"columns {empty} have no value to take a median of")
        return self._copyValues(MedianImputerModel(medians=[float(found[c][0]) for c in columns]))


class MedianImputerModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    medians = Param(Params._dummy(), "medians", "one median per input column", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, medians=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df):
        fills = self.getOrDefault(self.medians)
        return df.withColumns(
            {out: F.coalesce(number_or_null(df, c), F.lit(fill)) for (c, out), fill in zip(self._pairs(), fills)}
        )


class ModeImputer(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Replace null text by the most frequent value, the smallest one among equals."""

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df):
        columns = self.getOrDefault(self.inputCols)
        modes = most_frequent(df, columns)
        empty = [c for c in columns if modes[c] is None]
        if empty:
            raise ValueError(f"columns {empty} have no value to impute with")
        return self._copyValues(ModeImputerModel(modes=[modes[c] for c in columns]))


class ModeImputerModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    modes = Param(Params._dummy(), "modes", "one value per input column", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, modes=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df):
        fills = self.getOrDefault(self.modes)
        return df.withColumns(
            {out: F.coalesce(quoted(resolve(df, c)), F.lit(fill)) for (c, out), fill in zip(self._pairs(), fills)}
        )


def most_frequent(df: DataFrame, columns: list[str]) -> dict[str, str | None]:
    """The most frequent non-null value of each column, ties to the smallest, in one pass."""
    values = F.array(*[F.struct(F.lit(i).alias("i"), quoted(resolve(df, c)).alias("v")) for i, c in enumerate(columns)])
    counts = df.select(F.explode(values).alias("e")).where("e.v IS NOT NULL").groupBy("e.i", "e.v").agg(F.count("*").alias("n"))
    best = counts.groupBy("i").agg(F.min(F.struct((-F.col("n")).alias("n"), "v")).alias("best"))
    found = {row.i: row.v for row in best.select("i", "best.v").collect()}
    return {c: found.get(i) for i, c in enumerate(columns)}


class NumericScaler(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Subtract the mean and divide by the standard deviation, population (ddof 0) or sample (1)."""

    ddof = Param(Params._dummy(), "ddof", "0 population, 1 sample", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, ddof=0):
        super().__init__()
        self._setDefault(ddof=0)
        self._set(**self._input_kwargs)

    def _fit(self, df):
        columns = self.getOrDefault(self.inputCols)
        spread = F.stddev_pop if self.getOrDefault(self.ddof) == 0 else F.stddev_samp
        aggregates = [a for c in columns for a in (F.avg(number_or_null(df, c)), spread(number_or_null(df, c)))]
        row = df.agg(*[a.alias(f"a{i}") for i, a in enumerate(aggregates)]).first()
        means = [0.0 if v is None else v for v in row[0::2]]
        # A constant column is centred only.
        scales = [v if v and math.isfinite(v) else 1.0 for v in row[1::2]]
        return self._copyValues(NumericScalerModel(means=means, scales=scales))


class NumericScalerModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    ddof = NumericScaler.ddof
    means = Param(Params._dummy(), "means", "one mean per input column", TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "one divisor per input column", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, means=None, scales=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df):
        means, scales = self.getOrDefault(self.means), self.getOrDefault(self.scales)
        return df.withColumns(
            {
                out: (number_or_null(df, c) - F.lit(m)) / F.lit(s)
                for (c, out), m, s in zip(self._pairs(), means, scales)
            }
        )


def check_cardinality(df: DataFrame, columns: list[str], limit: int = 10_000) -> None:
    """Refuse columns with more distinct values than ``limit``."""
    if not columns:
        return
    counts = df.agg(*[F.count_distinct(quoted(resolve(df, c))).alias(f"a{i}") for i, c in enumerate(columns)]).first()
    large = {c: n for c, n in zip(columns, counts) if n > limit}
    if large:
        raise ValueError(f"too many categories to one-hot encode (limit {limit}): {large}; drop them or use encoding='hash'")


class LimitedIndexer(CategoryIndexer):
    """A CategoryIndexer that refuses columns above a limit."""

    limit: int | None = None

    def _fit(self, dataset):
        if self.limit is not None:
            check_cardinality(dataset, self.getInputCols(), self.limit)
        return super()._fit(dataset)


def build_preprocessor(
    numeric: list[str],
    categorical: list[str],
    *,
    median: str = "exact",
    scope: str = "numeric",
    ddof: int = 0,
    encoding: str = "onehot",
    hash_features: int = 1 << 12,
    max_categories: int | None = None,
    output: str = "features",
) -> Pipeline:
    """An unfitted pipeline from columns to a feature vector.

    Numbers are imputed by their median and standardised, text by its most frequent value and one-hot
    encoded, where an unseen value gives all zeros. ``scope='all'`` standardises the whole vector
    instead (sample deviation). ``median='approx'`` takes an element near the median. Categories are numbered in a table, so
    there may be any number of them; ``max_categories`` refuses columns with more.
    """
    if scope not in ("numeric", "all"):
        raise ValueError(f"unknown scope {scope!r}")
    if encoding not in ("onehot", "hash"):
        raise ValueError(f"unknown encoding {encoding!r}")
    if median not in ("exact", "approx"):
        raise ValueError(f"unknown median {median!r}; use 'exact' or 'approx'")
    stages, parts = [], []
    if numeric:
        filled, scaled = [f"{c}__filled" for c in numeric], [f"{c}__scaled" for c in numeric]
        imputer = MedianImputer if median == "exact" else _approximate_imputer
        stages.append(imputer(inputCols=numeric, outputCols=filled))
        if scope == "numeric":
            stages.append(NumericScaler(inputCols=filled, outputCols=scaled, ddof=ddof))
        parts += scaled if scope == "numeric" else filled
    if categorical:
        known = [f"{c}__known" for c in categorical]
        stages.append(ModeImputer(inputCols=categorical, outputCols=known))
        if encoding == "onehot":
            index, onehot = [f"{c}__index" for c in categorical], [f"{c}__onehot" for c in categorical]
            indexer = LimitedIndexer(inputCols=known, outputCols=index)
            indexer.limit = max_categories
            stages.append(indexer)
            # The last index is the one of unseen values; dropping it leaves zeros.
            stages.append(OneHotEncoder(inputCols=index, outputCols=onehot, dropLast=True))
            parts += onehot
        else:
            stages.append(FeatureHasher(inputCols=known, outputCol="__hashed", numFeatures=hash_features))
            parts.append("__hashed")
    if not parts:
        raise ValueError("no feature columns")
    assembled = output if scope == "numeric" else "__assembled"
    stages.append(VectorAssembler(inputCols=parts, outputCol=assembled))
    if scope == "all":
        stages.append(StandardScaler(inputCol=assembled, outputCol=output, withMean=True, withStd=True))
    return Pipeline(stages=stages)


def _approximate_imputer(inputCols, outputCols):
    return Imputer(inputCols=inputCols, outputCols=outputCols, strategy="median")
