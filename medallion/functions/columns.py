"""Column expressions: name resolution, casts, NaN handling and hashing."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F, types as T

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOATING = (T.FloatType, T.DoubleType)


def quoted(name: str) -> Column:
    """A top-level column, also when its name contains dots or spaces."""
    return F.col("`" + name.replace("`", "``") + "`")


def resolve(df: DataFrame, name: str) -> str:
    """The existing spelling of ``name``; Spark matches column names without regard to case."""
    if name in df.columns:
        return name
    matches = [c for c in df.columns if c.lower() == name.lower()]
    if not matches:
        raise ValueError(f"no column {name!r}; have {df.columns}")
    if len(matches) > 1:
        raise ValueError(f"column {name!r} is ambiguous: {matches}")
    return matches[0]


def require_absent(df: DataFrame, *names: str) -> None:
    """Fail early when a helper column would shadow one of the caller's."""
    taken = {c.lower() for c in df.columns} & {n.lower() for n in names}
    if taken:
        raise ValueError(f"columns {sorted(taken)} already exist in the input")


def is_floating(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[resolve(df, name)].dataType, FLOATING)


def number_or_null(df: DataFrame, name: str) -> Column:
    """The column as double with NaN as NULL, so that aggregates skip both."""
    c = quoted(resolve(df, name)).cast("double")
    return F.nanvl(c, F.lit(None).cast("double")) if is_floating(df, name) else c


def not_nan(df: DataFrame, name: str) -> Column:
    """True unless the value is NaN (Spark orders NaN above every number)."""
    c = quoted(resolve(df, name))
    return ~F.isnan(c) if is_floating(df, name) else F.lit(True)


def cast_column(df: DataFrame, name: str, target: str, mode: str) -> Column:
    """One cast. ``permissive`` turns an unreadable value into NULL, ``strict`` raises."""
    field = df.schema[resolve(df, name)]
    c = quoted(field.name)
    if mode == "strict":
        return c.cast(target)
    if mode != "permissive":
        raise ValueError(f"unknown cast mode {mode!r}")
    wanted = T._parse_datatype_string(target)
    if isinstance(field.dataType, T.StringType) and isinstance(wanted, INTEGRAL):
        # '2.7' reads as 2: keep the whole part of plain decimal text.
        text = F.trim(c)
        c = F.when(text.rlike(r"^[+-]?[0-9]+\.[0-9]*$"), F.substring_index(text, ".", 1)).otherwise(c)
    return c.try_cast(target)


def date_literal(as_of: date | str | None) -> str:
    """SQL text for the reference date of a run: a literal, or the clock when none is given."""
    if as_of is None:
        return "current_date()"
    day = as_of if isinstance(as_of, date) else date.fromisoformat(as_of)
    return f"DATE'{day:%Y-%m-%d}'"


def run_stamp(day: Column | None = None) -> Column:
    """``dd-MM-yy`` text used at the end of run names."""
    return F.date_format(F.current_date() if day is None else day, "dd-MM-yy")


def hash_number(key: Column, seed: int, digits: int = 8) -> Column:
    """A number in ``[0, 16**digits)`` from the MD5 of ``key:seed``."""
    text = F.concat(key.cast("string"), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")


def row_key(df: DataFrame, key: list[str] | None) -> Column:
    """Text that identifies a row: its key columns, or the whole row without a key.

    The values are joined by the unit separator, a null being the null character.
    """
    names = [resolve(df, k) for k in key] if key else df.columns
    return F.concat_ws("\x1f", *[F.coalesce(quoted(n).cast("string"), F.lit("\0")) for n in names])
