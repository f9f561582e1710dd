"""Extraction by SQL text, from a JDBC database or from tables Spark already knows."""

from __future__ import annotations

import datetime
from collections.abc import Iterable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from medallion.operators.ordering import order_statistics


def jdbc_options(
    url: str,
    query: str | None = None,
    *,
    dbtable: str | None = None,
    partition_column: str | None = None,
    bounds: tuple | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
    **options: str,
) -> dict[str, str]:
    """Options for the JDBC source.

    A query without a partition column is read through one connection. Give
    ``partition_column``, ``bounds`` and ``num_partitions`` to read slices in parallel; the query
    then becomes a derived table, because the source slices tables only. Rows outside the bounds
    are still read, by the first and the last slice.
    """
    if (query is None) == (dbtable is None):
        raise ValueError("give exactly one of query and dbtable")
    out = {"url": url, "fetchsize": str(fetch_size), **options}
    if partition_column is None:
        out["query" if query else "dbtable"] = query or dbtable
        return out
    if bounds is None or num_partitions is None:
        raise ValueError("parallel reads need bounds and num_partitions")
    out["dbtable"] = dbtable or f"({query}) extracted"
    out["partitionColumn"] = partition_column
    out["lowerBound"], out["upperBound"] = (str(b) for b in bounds)
    out["numPartitions"] = str(num_partitions)
    return out


def read_jdbc(spark: SparkSession, url: str, query: str | None = None, **kwargs) -> DataFrame:
    """Run SQL text in a database and read the result with its column names."""
    return spark.read.format("jdbc").options(**jdbc_options(url, query, **kwargs)).load()


def equal_slices(keys: DataFrame, column: str, slices: int) -> list:
    """Bounds that cut a numeric key into slices of about equally many rows, from the keys themselves.

    Keys that hold more rows than a slice stand alone, so there may be fewer slices. Null keys do not count.
    """
    if slices < 1:
        raise ValueError("slices must be positive")
    _, found = order_statistics(keys, [column], lambda n: {n * i // slices for i in range(1, slices)} if n else set())[column]
    least = order_statistics(keys, [column], lambda n: {0} if n else set())[column][1]
    return sorted(set(found.values()) - set(least.values()))


def slice_predicates(column: str, bounds: Iterable) -> list[str]:
    """Conditions, one per slice, that together hold for every row and for no row twice: below the first bound, from each bound
    up to the next, from the last on, and null keys in a slice of their own."""
    cuts = [_sql(b) for b in sorted(set(bounds))]
    if not cuts:
        return [f"{column} IS NOT NULL", f"{column} IS NULL"]
    between = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"{column} < {cuts[0]}", *between, f"{column} >= {cuts[-1]}", f"{column} IS NULL"]


def _sql(value) -> str:
    if isinstance(value, bool) or not isinstance(value, (int, float, Decimal, str, datetime.date)):
        raise ValueError(f"cannot slice by {value!r}")
    if isinstance(value, (int, Decimal)):
        return f"{value:f}" if isinstance(value, Decimal) else str(value)
    if isinstance(value, float):
        return repr(value)
    return "'" + str(value).replace("'", "''") + "'"


def read_jdbc_slices(spark: SparkSession, url: str, query: str, column: str, slices: int, properties: dict[str, str] | None = None) -> DataFrame:
    """Run SQL text in a database by parallel connections whose slices of a numeric key are about equally large.

    The keys are read first, by one connection, to find the bounds: equal widths of the key, which the source offers, leave
    most rows to one slice where keys are unevenly spread.
    """
    keys = read_jdbc(spark, url, f"SELECT {column} FROM ({query}) keyed", **(properties or {}))
    predicates = slice_predicates(column, equal_slices(keys, column, slices))
    return spark.read.jdbc(url, f"({query}) extracted", predicates=predicates, properties=properties or {})


def read_sql(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """Run SQL text on catalog tables, or on DataFrames named in the text as ``{name}``."""
    return spark.sql(query, **tables)
