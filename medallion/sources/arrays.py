"""Files of one JSON array each, cut into their elements by many tasks.

The text source reads a file in splits of the usual size and cuts it at closing braces, wherever they stand. What a brace, comma or
quote in a split means depends on what is open at its start. So a first pass finds, for both cases of a split (a string is open at its
start or not), whether it leaves one open and how much it changes the depth; with the sums of these over the splits before, a
second pass knows where elements begin and end. Elements that cross splits are put together by their number.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from medallion.session import remove, scratch_dir

BACKSLASH, QUOTE, COMMA = ord("\\"), ord('"'), ord(",")
OPEN, CLOSE = np.zeros(256, np.int8), np.zeros(256, np.int8)
OPEN[[ord("["), ord("{")]] = 1
CLOSE[[ord("]"), ord("}")]] = 1
PIECES = ["file", "start", "place", "kind", "value"]


def split_array(spark: SparkSession, path: str | list[str], piece_bytes: int | None = None) -> str:
    """Write the elements of the array files under ``path`` as JSON lines into the scratch folder; returns where.

    Splits have the size that Spark's settings give, or ``piece_bytes``; a task takes many small ones. An element may be longer than
    a split. A file that is not one array raises.
    """
    base, lines = scratch_dir(spark, "pieces"), scratch_dir(spark, "elements")
    with _split_size(spark, path, piece_bytes):
        # Splits start after a closing brace (or at the start of the file), so never inside an escape.
        parts = spark.read.option("lineSep", "}").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
        _balance(parts).write.parquet(f"{base}/balance")
        states = _states(spark.read.parquet(f"{base}/balance"))
        # One short row per split.
        parts.join(F.broadcast(states), ["file", "start"]).mapInPandas(_cut, "file string, start long, place long, kind string, value string").write.parquet(f"{base}/cut")
    cut = spark.read.parquet(f"{base}/cut")
    whole = cut.where("kind = 'whole'").select("value")
    whole.unionByName(_joined(cut.where("kind <> 'whole'"))).where(F.trim("value") != "").write.text(lines)
    remove(spark, base)
    return lines


@contextmanager
def _split_size(spark: SparkSession, path: str | list[str], size: int | None) -> Iterator[None]:
    """Splits of ``size`` bytes, dealt to no more tasks than there are cores, or than Spark's own settings give the files."""
    if size is None:
        yield
        return
    tasks = max(spark.sparkContext.defaultParallelism, spark.read.text(path).rdd.getNumPartitions())
    wanted = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": size, "spark.sql.files.maxPartitionNum": tasks}
    before = {n: spark.conf.get(n, None) for n in wanted}
    for n, v in wanted.items():
        spark.conf.set(n, str(v))
    try:
        yield
    finally:
        for n, v in before.items():
            spark.conf.set(n, v) if v is not None else spark.conf.unset(n)


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, int, pd.DataFrame]]:
    """Consecutive rows of one split; a split may come in several."""
    for batch in batches:
        change = (batch["start"] != batch["start"].shift()) | (batch["file"] != batch["file"].shift())
        for _, rows in batch.groupby(change.cumsum(), sort=False):
            yield rows["file"].iloc[0], int(rows["start"].iloc[0]), rows


def _text(values: pd.Series) -> np.ndarray:
    """The split's bytes. Its last piece gets a brace too much where the file ends, after everything is closed."""
    return np.frombuffer(("}".join(values) + "}").encode(), np.uint8)


def _marks(raw: np.ndarray, open_string: int) -> tuple[np.ndarray, int]:
    """Which bytes are outside of strings, and whether a string is open at the end."""
    at = np.arange(len(raw))
    last_other = np.maximum.accumulate(np.where(raw == BACKSLASH, -1, at))
    run = at - 1 - np.concatenate(([-1], last_other[:-1]))
    quotes = (raw == QUOTE) & (run % 2 == 0)
    inside = (np.cumsum(quotes) + open_string) % 2
    return (inside == 0) & ~quotes, int(inside[-1])


def _balance(parts: DataFrame) -> DataFrame:
    """Per split: whether its quotes leave a string open, and the change of depth for both cases at its start."""

    def scan(batches):
        now, state, done = None, None, []
        for file, start, rows in _blocks(batches):
            if (file, start) != now:
                if now is not None:
                    done.append(row(now, state))
                now, state = (file, start), [[0, 0], [1, 0], None]
            raw = _text(rows["value"])
            for case in state[:2]:
                outside, case[0] = _marks(raw, case[0])
                case[1] += int((OPEN[raw] * outside).sum()) - int((CLOSE[raw] * outside).sum())
            if state[2] is None:
                state[2] = rows["value"].iloc[0].lstrip("﻿ \t\r\n")[:1]
        if now is not None:
            done.append(row(now, state))
        # one short row per split of the task
        yield pd.DataFrame(done, columns=["file", "start", "odd", "closed_change", "open_change", "first"])

    def row(now, state):
        return (*now, state[0][0], state[0][1], state[1][1], state[2])

    return parts.mapInPandas(scan, "file string, start long, odd int, closed_change long, open_change long, first string")


def _states(balance: DataFrame) -> DataFrame:
    """``(file, start, open_string, depth)`` at the start of each split."""
    wrong = balance.where((F.col("start") == 0) & (F.col("first") != "[")).select("file").first()
    if wrong is not None:
        raise ValueError(f"not one JSON array: {wrong.file}")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    opened = balance.withColumn("open_string", F.pmod(F.coalesce(F.sum("odd").over(before), F.lit(0)), F.lit(2)).cast("int"))
    change = F.when(F.col("open_string") == 1, F.col("open_change")).otherwise(F.col("closed_change"))
    return opened.withColumn("depth", F.coalesce(F.sum(change).over(before), F.lit(0))).select("file", "start", "open_string", "depth")


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Elements that lie in one split as ``whole``; the text before the first border of a split as ``head``, after the last as ``tail``;
    ``through`` where there is no border. A split's texts are numbered."""
    now = None
    for batch in batches:
        out = []
        for file, start, rows in _blocks(iter([batch])):
            if (file, start) != now:
                if now is not None:
                    out.append(_rest(now, bordered, place, open_text))
                now, place, bordered, open_text = (file, start), 0, False, []
                open_string, depth = int(rows["open_string"].iloc[0]), int(rows["depth"].iloc[0])
            raw = _text(rows["value"])
            outside, open_string = _marks(raw, open_string)
            opens, closes = OPEN[raw] * outside, CLOSE[raw] * outside
            level = depth + np.cumsum(opens.astype(np.int64) - closes)
            depth = int(level[-1])
            # the array opens, a comma at its level, the array closes
            borders = np.flatnonzero(((opens == 1) & (level == 1)) | (outside & (raw == COMMA) & (level == 1)) | ((closes == 1) & (level == 0)))
            data, at = raw.tobytes(), 0
            for border in borders.tolist():
                text = "".join([*open_text, data[at:border].decode()])
                out.append((file, start, place, "whole" if bordered else "head", _line(text)))
                place, bordered, open_text, at = place + 1, True, [], border + 1
            open_text.append(data[at:].decode())
        if out:
            yield pd.DataFrame(out, columns=PIECES)
    if now is not None:
        yield pd.DataFrame([_rest(now, bordered, place, open_text)], columns=PIECES)


def _rest(now, bordered, place, open_text):
    return (*now, place, "tail" if bordered else "through", _line("".join(open_text)))


def _line(text: str) -> str:
    """JSON has line breaks between its parts only."""
    return text.replace("\r", " ").replace("\n", " ")


def _joined(ends: DataFrame) -> DataFrame:
    """Elements that cross splits: a tail, what goes through, and the next head. What stands before the array opens is the head of
    the first split, what stands after it closes the last tail."""
    order = Window.partitionBy("file").orderBy("start", "place")
    # Short rows, two per split; the texts meet their numbers by a join.
    numbers = ends.select("file", "start", "place", "kind")
    begun = F.sum(F.when(F.col("kind") == "tail", 1).otherwise(0)).over(order)
    last = F.max(F.when(F.col("kind") == "tail", F.struct("start", "place"))).over(Window.partitionBy("file"))
    numbers = numbers.withColumns({"element": begun, "last": last}).where("element > 0")
    numbers = numbers.where((F.col("kind") != "tail") | (F.struct("start", "place") != F.col("last"))).where(F.struct("start", "place") <= F.col("last"))
    texts = ends.join(numbers.select("file", "start", "place", "element"), ["file", "start", "place"])
    pieces = texts.groupBy("file", "element").agg(F.array_sort(F.collect_list(F.struct("start", "place", "value"))).alias("p"))
    return pieces.select(F.array_join("p.value", "").alias("value"))
