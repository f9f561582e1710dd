"""Writers. Each writes a directory of part files, one per task; failures raise."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import nullcontext

from pyspark.sql import DataFrame

from medallion.session import staged
from medallion.sources.documents import encode_json

SAVE_MODES = ("append", "overwrite", "ignore", "error", "errorifexists")


def write_csv(
    df: DataFrame,
    path: str,
    *,
    header: bool = True,
    encoding: str = "UTF-8",
    mode: str = "overwrite",
    blank_empty: bool = False,
    **options,
) -> None:
    """CSV with doubled quotes and text kept as it is, blanks at its ends included.

    ``blank_empty`` writes empty text like null, as a bare blank.
    """
    writer = df.write.mode(mode).option("header", header).option("encoding", encoding).option("escape", '"')
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    if blank_empty:
        writer = writer.option("emptyValue", "")
    writer.options(**options).csv(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "error", partition_by: list[str] | None = None, **options) -> None:
    """Any format, any of Spark's save modes."""
    if mode not in SAVE_MODES:
        raise ValueError(f"unknown save mode {mode!r}; use one of {SAVE_MODES}")
    writer = df.write.format(fmt).mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_delta(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A Delta table whose schema grows with new columns (needs the Delta package)."""
    write_table(df, path, "delta", mode, mergeSchema="true")


def publish_json(df: DataFrame, *, servers: str | None = None, topic: str | None = None, path: str | None = None, mode: str = "append", keep_nulls: bool = True) -> None:
    """Send every row as a JSON message with a null key: to a topic, or to text files."""
    messages = encode_json(df, keep_nulls=keep_nulls)
    if path is not None:
        messages.select("value").write.mode(mode).text(path)
        return
    if not servers or not topic:
        raise ValueError("give servers and topic, or a path")
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def write_predictions(df: DataFrame, root: str, stamp: str) -> str:
    """Predictions in their own directory, named by the run's time stamp."""
    path = f"{root.rstrip('/')}/predictions_{stamp}"
    df.write.mode("error").parquet(path)
    return path


def write_if_any(df: DataFrame, write: Callable[[DataFrame], None], once: bool = False) -> bool:
    """Write unless there are no rows; tells whether it wrote.

    ``once`` evaluates the rows a single time, into a scratch table: for rows that are costly or change, such as a query's.
    """
    with staged(df, "rows") if once else nullcontext(df) as rows:
        if rows.isEmpty():
            return False
        write(rows)
        return True


def preview(df: DataFrame, n: int = 3) -> DataFrame:
    """The first few rows, for looking at."""
    return df.limit(n)
