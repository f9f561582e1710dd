"""Order statistics, neighbours and running totals over a whole column.

A global sort window puts the table into one task. The functions here reach the same results with
aggregates whose partial results are small, and with windows over value ranges of bounded size.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from contextlib import ExitStack
from dataclasses import dataclass
from decimal import Decimal, localcontext
from fractions import Fraction
from functools import reduce
from operator import or_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from medallion.functions.columns import INTEGRAL, number_or_null, quoted, resolve
from medallion.session import staged

Number = int | float | Decimal

BUCKETS = 8192
ROWS_PER_RANGE = 1_000_000
MIN_RANGES = 8
#: Cuts found in one pass over all rows; further ones are found inside these.
COARSE_RANGES = 1024
WIDE = 2.0**53
DECIMAL_DIGITS = 38
#: Sketches of the first pass: their size, the rank error allowed for (several times the expected one), and the number of
#: values from which they are worth it.
SKETCH_SIZE = 4000
SKETCH_MARGIN = 0.004
SKETCHED_ROWS = 10_000


@dataclass
class _Interval:
    """Values of one column that contain the wanted ranks; ``below`` counts smaller values.

    A ``guess`` comes from a sketch. Whether it contains the ranks, and how many values are below, shows in its pass.
    """

    column: int
    lo: Number
    hi: Number
    below: int
    ranks: frozenset[int]
    guess: bool = False


def exact_quantiles(df: DataFrame, columns: list[str], probabilities: list[float], buckets: int = BUCKETS) -> dict[str, list[Number | None]]:
    """Exact interpolated quantiles of several columns; null and NaN are skipped.

    A quantile that is a value of the column, or lies between equal ones, comes in the column's own type; between two
    different values it is computed from them exactly and is a decimal for decimal columns, else a float.
    """

    def ranks(n: int) -> set[int]:
        return {r for p in probabilities for r in _position(n, p)[:2]}

    found = order_statistics(df, columns, ranks, buckets)
    return {c: [_interpolate(n, values, p) for p in probabilities] for c, (n, values) in found.items()}


def order_statistics(
    df: DataFrame, columns: list[str], ranks: Callable[[int], set[int]], buckets: int = BUCKETS
) -> dict[str, tuple[int, dict[int, Number]]]:
    """Per column: how many values there are, and the values at the ranks (from 0) asked for.

    ``ranks`` is told the count. A first aggregate gives the count, the range and a quantile sketch of every column; the
    sketch's bounds on a rank are the first interval. A second pass counts the values inside and between the bounds, which proves
    them right; a wrong interval is replaced by the part of the range that holds the rank. The values inside, a few in a hundred
    for each rank, are written to the scratch folder. Over them, each further pass counts values in equal buckets of the remaining
    interval and keeps the bucket that holds the wanted rank, until that bucket holds a single value. State per task is at
    most ``buckets`` counters per interval however many rows or ties there are, and only the chosen bucket of each
    rank reaches the driver. Null and NaN are skipped.

    Whole numbers are compared and divided as 64-bit numbers, decimals as decimals, floating point as doubles,
    so every value comes back as it is in the table: an ``int``, a ``Decimal`` or a ``float``.
    """
    names = [resolve(df, c) for c in columns]
    values = df.select(*[_typed(df, c).alias(f"v{i}") for i, c in enumerate(names)])
    kinds = [f.dataType for f in values.schema.fields]
    stats = _ranges(values, kinds)

    found: list[dict[int, Number]] = [{} for _ in names]
    whole, sketches = [], []
    for i, (n, n_low, n_high, lo, hi, sketch) in enumerate(stats):
        wanted = ranks(n) if n else set()
        found[i].update({r: -math.inf for r in wanted if r < n_low})
        found[i].update({r: math.inf for r in wanted if r >= n - n_high})
        rest = wanted - found[i].keys()
        if rest:
            whole.append(_Interval(i, lo, hi, n_low, frozenset(rest)))
            sketches.append((n - n_low - n_high, sketch))
    intervals = _guesses(df.sparkSession, whole, kinds, sketches)

    with ExitStack() as stack:
        if any(iv.guess for iv in intervals):
            intervals = _proved(values, intervals, kinds)
            values = stack.enter_context(staged(_inside(values, intervals, kinds), "ranks"))
        while intervals:
            for iv in intervals:
                if iv.lo == iv.hi:
                    found[iv.column].update({r: iv.lo for r in iv.ranks})
            intervals = [iv for iv in intervals if iv.lo < iv.hi]
            if intervals:
                intervals = _narrow(values, intervals, kinds, buckets)
    return {c: (stats[i][0], found[i]) for i, c in enumerate(columns)}


def _guesses(spark, whole: list[_Interval], kinds: list[T.DataType], sketches: list[tuple[int, bytes]]) -> list[_Interval]:
    """The sketches' bounds on each rank, where columns are long enough for them to be narrower than the range."""
    asked = {}
    for t, (iv, (n, sketch)) in enumerate(zip(whole, sketches)):
        if n >= SKETCHED_ROWS:
            margin = SKETCH_MARGIN * n + 1
            shares = [min(max((r - iv.below + side * margin) / n, 0.0), 1.0) for r in sorted(iv.ranks) for side in (-1, 1)]
            kll = F.kll_sketch_get_quantile_bigint if isinstance(kinds[iv.column], T.LongType) else F.kll_sketch_get_quantile_double
            asked[t] = kll(F.lit(bytearray(sketch)), F.array(*[F.lit(s) for s in shares])).alias(f"q{t}")
    found = spark.range(1).select(*asked.values()).first() if asked else None
    out: list[_Interval] = []
    for t, iv in enumerate(whole):
        if t not in asked:
            out.append(iv)
            continue
        bounds = [min(max(_nearest(v, iv), iv.lo), iv.hi) for v in found[f"q{t}"]]
        own: list[_Interval] = []
        for r, lo, hi in zip(sorted(iv.ranks), bounds[::2], bounds[1::2]):
            if own and lo <= own[-1].hi:
                own[-1] = _Interval(iv.column, own[-1].lo, max(hi, own[-1].hi), iv.below, own[-1].ranks | {r}, True)
            else:
                own.append(_Interval(iv.column, lo, hi, iv.below, frozenset([r]), True))
        out += own
    return out


def _nearest(value: Number, like: _Interval) -> Number:
    """A sketched value in the column's own type: only a place to look at."""
    if not isinstance(like.lo, Decimal):
        return value
    with localcontext() as context:
        context.prec = DECIMAL_DIGITS
        return Decimal(value).quantize(Decimal(1).scaleb(min(like.lo.as_tuple().exponent, like.hi.as_tuple().exponent)))


def _typed(df: DataFrame, name: str) -> Column:
    """The column as a 64-bit number, as the decimal it is, or as double with NaN as NULL."""
    kind = df.schema[name].dataType
    if isinstance(kind, INTEGRAL):
        return quoted(name).cast("bigint")
    return quoted(name) if isinstance(kind, T.DecimalType) else number_or_null(df, name)


def _literal(value: Number, kind: T.DataType) -> Column:
    return F.lit(value) if isinstance(kind, T.DoubleType) else F.lit(f"{value:f}" if isinstance(value, Decimal) else str(value)).cast(kind)


def _position(n: int, p: float) -> tuple[int, int, float]:
    at = p * (n - 1)
    low = math.floor(at)
    return low, math.ceil(at), at - low


def _interpolate(n, values, p):
    if not n:
        return None
    low, high, part = _position(n, p)
    a, b = values[low], values[high]
    if a == b:
        return a
    if isinstance(a, Decimal):
        with localcontext() as context:
            context.prec = 2 * DECIMAL_DIGITS
            return a + (b - a) * Decimal(part)
    if isinstance(a, int) and max(abs(a), abs(b)) > WIDE:
        return float(a + (b - a) * Fraction(part))
    return a + (b - a) * part


def _ranges(values: DataFrame, kinds: list[T.DataType]) -> list[tuple]:
    """Per column: count, count of -inf, count of +inf, least and greatest finite value, and a sketch of the finite ones."""
    aggregates = []
    for i, kind in enumerate(kinds):
        c = F.col(f"v{i}")
        infinite = isinstance(kind, T.DoubleType)
        finite = F.when(F.abs(c) < math.inf, c) if infinite else c
        aggregates += [
            F.count(c),
            F.count(F.when(c == -math.inf, 1)) if infinite else F.lit(0),
            F.count(F.when(c == math.inf, 1)) if infinite else F.lit(0),
            F.min(finite),
            F.max(finite),
            F.kll_sketch_agg_bigint(c, SKETCH_SIZE) if isinstance(kind, T.LongType) else F.kll_sketch_agg_double(finite.cast("double"), SKETCH_SIZE),
        ]
    row = values.agg(*[a.alias(f"a{i}") for i, a in enumerate(aggregates)]).first()
    return [tuple(row[6 * i : 6 * i + 6]) for i in range(len(kinds))]


def _by_column(intervals: list[_Interval]) -> dict[int, list[int]]:
    """The intervals' numbers per column, by rising values: those of a column lie apart."""
    out: dict[int, list[int]] = {}
    for t in sorted(range(len(intervals)), key=lambda t: (intervals[t].column, intervals[t].lo)):
        out.setdefault(intervals[t].column, []).append(t)
    return out


def _step(intervals: list[_Interval], own: list[int], kind: T.DataType) -> Column:
    """Where a value lies among its column's intervals: an odd number inside of one, an even one beside them; null for infinite ones."""
    c = F.col(f"v{intervals[own[0]].column}")
    infinite = (F.abs(c) == math.inf) if isinstance(kind, T.DoubleType) else F.lit(False)
    found = F.when(c.isNull() | infinite, None)
    for k, t in enumerate(own):
        found = found.when(c < _literal(intervals[t].lo, kind), 2 * k).when(c <= _literal(intervals[t].hi, kind), 2 * k + 1)
    return found.otherwise(2 * len(own))


def _edges(kinds: list[T.DataType], column: int, present: list[T.DataType]) -> list[Column]:
    """A value under the field of its type."""
    return [(F.col(f"v{column}") if kinds[column] == k else F.lit(None).cast(k)).alias(f"x{j}") for j, k in enumerate(present)]


def _proved(values: DataFrame, intervals: list[_Interval], kinds: list[T.DataType]) -> list[_Interval]:
    """One pass: the ranks' true places inside or beside the guessed intervals, as intervals that are no guesses."""
    columns = _by_column(intervals)
    present = list(dict.fromkeys(kinds[c] for c in columns))
    steps = [F.struct(F.lit(c).alias("c"), _step(intervals, own, kinds[c]).alias("s"), *_edges(kinds, c, present)) for c, own in columns.items()]
    ends = [f(f"h.x{j}").alias(f"{name}{j}") for j in range(len(present)) for name, f in (("lo", F.min), ("hi", F.max))]
    counted = values.select(F.explode(F.array(*steps)).alias("h")).where("h.s IS NOT NULL").groupBy("h.c", "h.s").agg(F.count("*").alias("n"), *ends)
    out: list[_Interval] = []
    # two rows per interval, and one
    rows = sorted(counted.collect(), key=lambda row: (row.c, row.s))
    for c, own in columns.items():
        ranks, j, before = frozenset().union(*(intervals[t].ranks for t in own)), present.index(kinds[c]), intervals[own[0]].below
        for row in (row for row in rows if row.c == c):
            held = frozenset(r for r in ranks if before <= r < before + row.n)
            if held:
                out.append(_Interval(c, row[f"lo{j}"], row[f"hi{j}"], before, held))
            before += row.n
    return out


def _inside(values: DataFrame, intervals: list[_Interval], kinds: list[T.DataType]) -> DataFrame:
    """The values inside the intervals, null elsewhere; rows without any are left out."""
    columns = _by_column(intervals)
    kept = [F.when(_step(intervals, columns[c], k) % 2 == 1, F.col(f"v{c}")) if c in columns else F.lit(None).cast(k) for c, k in enumerate(kinds)]
    kept = values.select(*[e.alias(f"v{c}") for c, e in enumerate(kept)])
    return kept.where(reduce(or_, [F.col(f"v{c}").isNotNull() for c in columns]))


def _place(intervals: list[_Interval], own: list[int], kind: T.DataType, buckets: int) -> Column:
    """The interval that a value lies in and its bucket there; null outside of all."""
    c = F.col(f"v{intervals[own[0]].column}")
    found = F.when(c.isNull(), None)
    for t in own:
        iv = intervals[t]
        found = found.when(c < _literal(iv.lo, kind), None)
        found = found.when(c <= _literal(iv.hi, kind), F.struct(F.lit(t).alias("t"), _bucket(iv, kind, buckets).cast("int").alias("b")))
    return found


def _bucket(iv: _Interval, kind: T.DataType, buckets: int) -> Column:
    """Bucket number of a value inside the interval; it never decreases as the value grows."""
    c = F.col(f"v{iv.column}")
    share = {T.LongType: _whole_share, T.DecimalType: _decimal_share}.get(type(kind), _double_share)
    inner = F.greatest(F.lit(1), F.least(F.lit(buckets), share(iv, kind, buckets).cast("int") + 1))
    lo, hi = _literal(iv.lo, kind), _literal(iv.hi, kind)
    # The two ends always part, so that every pass shrinks the interval.
    return F.when(c == lo, 0).when(c == hi, buckets + 1).otherwise(inner)


def _double_share(iv: _Interval, kind: T.DataType, buckets: int) -> Column:
    x, lo, hi = F.col(f"v{iv.column}"), F.lit(iv.lo), F.lit(iv.hi)
    if max(abs(iv.lo), abs(iv.hi)) > WIDE:
        # A few huge values would leave all others in one bucket, so divide the magnitudes instead.
        x, lo, hi = (F.signum(e) * F.log1p(F.abs(e)) for e in (x, lo, hi))
    share = F.when(hi > lo, (x - lo) / F.nullif(hi - lo, F.lit(0.0))).otherwise(F.lit(0.0))
    return F.floor(share * buckets)


def _whole_share(iv: _Interval, kind: T.DataType, buckets: int) -> Column:
    """The quotient by a bucket's width: it cannot overflow, whatever the range, and is exact at width 1."""
    width = (iv.hi - iv.lo) // (buckets - 1) + 1
    base = abs(iv.lo) // width * (1 if iv.lo >= 0 else -1)
    return F.expr(f"v{iv.column} div {width}L") - F.lit(base).cast("bigint")


def _decimal_share(iv: _Interval, kind: T.DecimalType, buckets: int) -> Column:
    """Distances in units of the last digit. They are exact where a unit is a bucket; above that, quotients of decimals, whose
    rounding keeps the order."""
    c, unit = F.col(f"v{iv.column}"), Decimal(1).scaleb(-kind.scale)
    with localcontext() as context:
        context.prec = 2 * DECIMAL_DIGITS
        lo, span = int(iv.lo / unit), int((iv.hi - iv.lo) / unit)
        if span < buckets:
            # the last digits alone tell the values apart
            ring = 10 ** len(str(buckets))
            last = (c % _decimal(ring * unit, kind.scale)) / _decimal(unit, kind.scale)
            return F.pmod(last.cast("bigint") - F.lit(lo % ring).cast("bigint"), F.lit(ring).cast("bigint"))
        width = _decimal((span // (buckets - 1) + 1) * unit, kind.scale)
        if span < 10 ** (DECIMAL_DIGITS - 1):
            return F.floor((c - _literal(iv.lo, kind)) / width)
        return F.floor(c / width - _literal(iv.lo, kind) / width)


def _decimal(value: Decimal, scale: int) -> Column:
    digits = max(value.adjusted() + 1, 0) + scale
    return F.lit(f"{value:f}").cast(T.DecimalType(min(DECIMAL_DIGITS, max(digits, 1)), scale))


def _narrow(values: DataFrame, intervals: list[_Interval], kinds: list[T.DataType], buckets: int) -> list[_Interval]:
    """One pass: the buckets that hold the wanted ranks, as new intervals."""
    present = list(dict.fromkeys(kinds[iv.column] for iv in intervals))
    hits = [F.struct(_place(intervals, own, kinds[c], buckets).alias("at"), *_edges(kinds, c, present)) for c, own in _by_column(intervals).items()]
    edges = [f(f"h.x{j}").alias(f"{name}{j}") for j in range(len(present)) for name, f in (("lo", F.min), ("hi", F.max))]
    histogram = (
        values.select(F.explode(F.array(*hits)).alias("h"))
        .where("h.at IS NOT NULL")
        .groupBy("h.at.t", "h.at.b")
        .agg(F.count("*").alias("n"), *edges)
    )
    # At most buckets + 2 rows per interval: a small window.
    upto = F.sum("n").over(Window.partitionBy("t").orderBy("b"))
    wanted = F.create_map(
        *[e for t, iv in enumerate(intervals) for e in (F.lit(t), F.array(*[F.lit(r - iv.below) for r in sorted(iv.ranks)]))]
    )
    chosen = (
        histogram.withColumn("before", upto - F.col("n"))
        .withColumn("r", F.explode(wanted[F.col("t")]))
        .filter("r >= before AND r < before + n")
        .collect()
    )
    grouped: dict[tuple, set[int]] = {}
    for row in chosen:
        iv = intervals[row.t]
        j = present.index(kinds[iv.column])
        grouped.setdefault((iv.column, row[f"lo{j}"], row[f"hi{j}"], iv.below + row.before), set()).add(iv.below + row.r)
    return [_Interval(c, lo, hi, below, frozenset(r)) for (c, lo, hi, below), r in grouped.items()]


def approx_quantiles(df: DataFrame, columns: list[str], probabilities: list[float], error: float = 0.05) -> dict[str, list[float | None]]:
    """Quantiles within a rank error, all columns in one pass; null and NaN are skipped."""
    names = [resolve(df, c) for c in columns]
    values = df.select(*[number_or_null(df, c).alias(f"v{i}") for i, c in enumerate(names)])
    found = values.approxQuantile(values.columns, probabilities, error)
    return {c: list(q) if q else [None] * len(probabilities) for c, q in zip(columns, found)}


def range_splits(df: DataFrame, column: str, rows: int, rows_per_range: int = ROWS_PER_RANGE) -> list[float]:
    """Cut points that divide the values of a column into ranges, at least one.

    ``rows`` is the size of ``df``. The points are approximate quantiles, so a range holds about
    ``rows_per_range`` rows or a single value. Where that takes more ranges than one pass finds well,
    each coarse range is cut again, all in one aggregate.
    """
    wanted = max(MIN_RANGES, math.ceil(rows / rows_per_range))
    parts = min(COARSE_RANGES, wanted)
    values = df.select(F.col(column).cast("double").alias("x"))
    found = values.approxQuantile("x", [i / parts for i in range(1, parts)], 1 / (2 * parts))
    cuts = sorted({c for c in found if math.isfinite(c)}) or [0.0]
    inner = math.ceil(wanted / parts)
    if inner > 1:
        shares = [i / inner for i in range(1, inner)]
        fine = add_range(values.where("x IS NOT NULL AND NOT isnan(x)"), "x", cuts).groupBy("range")
        rows_ = fine.agg(F.percentile_approx("x", shares, 4 * inner).alias("cuts")).collect()
        cuts = sorted({*cuts, *(c for r in rows_ for c in r.cuts if math.isfinite(c))})
    return cuts


def add_range(df: DataFrame, column: str, splits: list[float], output: str = "range") -> DataFrame:
    """Number each row by the range its value falls into, numbers rising with the value."""
    bucketizer = Bucketizer(splits=[-math.inf, *splits, math.inf], inputCol="__x", outputCol="__r")
    numbered = bucketizer.transform(df.withColumn("__x", F.col(column).cast("double")))
    return numbered.withColumn(output, F.col("__r").cast("int")).drop("__x", "__r")


def neighbours(distinct: DataFrame, rows: DataFrame, value: str, partition: str, splits: list[float]) -> DataFrame:
    """Add ``previous`` and ``next``: the adjacent values in the order of ``value`` per ``partition``.

    ``distinct`` holds each value of ``rows`` once per partition. Each range looks inside itself; only
    the ends of the ranges, taken from ``rows``, are compared with the other ranges.
    """
    ranged = add_range(distinct, value, splits)
    inside = Window.partitionBy(partition, "range").orderBy(value)
    ends = add_range(rows, value, splits).groupBy(partition, "range").agg(F.min(value).alias("__first"), F.max(value).alias("__last"))
    # One row per range.
    across = Window.partitionBy(partition).orderBy("range")
    ends = ends.select(
        partition,
        "range",
        F.lag("__last").over(across).alias("__before"),
        F.lead("__first").over(across).alias("__after"),
    )
    return (
        ranged.withColumns({"previous": F.lag(value).over(inside), "next": F.lead(value).over(inside)})
        .join(ends, [partition, "range"])
        .withColumns({"previous": F.coalesce("previous", "__before"), "next": F.coalesce("next", "__after")})
        .drop("range", "__before", "__after")
    )


def running_total(distinct: DataFrame, rows: DataFrame, order: str, amount: str, output: str, splits: list[float]) -> DataFrame:
    """Add the total of ``amount`` over all rows with a smaller ``order`` value.

    ``distinct`` holds the amounts of ``rows`` summed per value. Each range adds up inside itself, on
    top of the totals of the ranges below, taken from ``rows``.
    """
    ranged = add_range(distinct, order, splits)
    before = Window.partitionBy("range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    # One row per range.
    across = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = add_range(rows, order, splits).groupBy("range").agg(F.sum(amount).alias("__total"))
    totals = totals.select("range", F.coalesce(F.sum("__total").over(across), F.lit(0)).alias("__base"))
    return (
        ranged.withColumn(output, F.coalesce(F.sum(amount).over(before), F.lit(0)))
        .join(totals, "range")
        .withColumn(output, F.col(output) + F.col("__base"))
        .drop("range", "__base")
    )
