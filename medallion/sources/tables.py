"""File and table readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

VERSIONED = ("parquet", "delta")


def read_table(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "csv",
    *,
    infer_schema: bool = True,
    header: bool = True,
    delimiter: str = ",",
    schema: T.StructType | str | None = None,
    **options,
) -> DataFrame:
    """Read any format Spark knows; the CSV settings apply to CSV only."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", header).option("sep", delimiter)
        if schema is None:
            reader = reader.option("inferSchema", infer_schema)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**options).load(path)


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    *,
    encoding: str = "ISO-8859-1",
    header: bool = True,
    delimiter: str = ",",
    schema: T.StructType | str | None = None,
    multiline: bool = False,
    mode: str = "FAILFAST",
    **options,
) -> DataFrame:
    """Read CSV objects as written by common CSV libraries (a quote is doubled inside quotes).

    Give ``schema`` for large inputs: inference reads the data one extra time. ``multiline=True``
    allows line breaks inside fields, at the price that one file is read by one task. Rows that do
    not fit raise instead of being silently shifted. Empty text reads as null, quoted or not.
    """
    return read_table(
        spark,
        path,
        "csv",
        header=header,
        delimiter=delimiter,
        schema=schema,
        encoding=encoding,
        multiLine=multiline,
        escape='"',
        mode=mode,
        **options,
    )


def read_delta(spark: SparkSession, path: str) -> DataFrame:
    """Read a Delta table (the Delta package must be on the cluster's classpath)."""
    return load_data(spark, path, "delta")


def load_data(spark: SparkSession, path: str, fmt: str, version: int | None = None) -> DataFrame:
    """Load Parquet or Delta; ``version`` selects an older snapshot of a Delta table."""
    if fmt not in VERSIONED:
        raise ValueError(f"unsupported format {fmt!r}; use one of {VERSIONED}")
    if version is not None and fmt != "delta":
        raise ValueError("only Delta tables keep versions")
    reader = spark.read.format(fmt)
    if version is not None:
        reader = reader.option("versionAsOf", version)
    return reader.load(path)


def from_pandas(spark: SparkSession, pdf, schema: T.StructType | str | None = None) -> DataFrame:
    """A local pandas frame as a DataFrame, for small hand-made inputs."""
    return spark.createDataFrame(pdf, schema=schema)
