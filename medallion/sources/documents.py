"""Nested documents and message topics."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from medallion.functions.columns import quoted
from medallion.sources.arrays import split_array


def read_documents(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    *,
    fmt: str = "json",
    array_file: bool = False,
    piece_bytes: int | None = None,
    **options,
) -> DataFrame:
    """Read a whole collection of nested documents.

    JSON lines are split among tasks. ``array_file=True`` reads files that hold one JSON array each,
    every element a record; they are cut into their elements first, large ones by many tasks (of ``piece_bytes``). Other document stores are
    reached by ``fmt`` and ``options`` when their package is on the classpath.
    """
    reader = spark.read.format(fmt)
    if fmt == "json" and array_file:
        path = split_array(spark, path, piece_bytes)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**options).load(path) if path else reader.options(**options).load()


def read_messages(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """A topic from its earliest offset to now, as a batch with partition and offset."""
    return _topic(spark.read, servers, topic, options).load()


def message_stream(spark: SparkSession, servers: str, topic: str, batch_size: int | None = None, **options) -> DataFrame:
    """A topic from its earliest offset, in micro-batches of about ``batch_size`` messages."""
    if batch_size is not None:
        options["maxOffsetsPerTrigger"] = batch_size
    return _topic(spark.readStream, servers, topic, options).load()


MESSAGE_KEY = ("topic", "partition", "offset")
MESSAGE = "topic STRING, partition INT, offset BIGINT, value STRING"


@dataclass(frozen=True, order=True)
class Span:
    """Offsets of a partition from ``start`` up to and without ``end``."""

    topic: str
    partition: int
    start: int
    end: int


class Topic:
    """A topic read as batches between explicit offsets."""

    def ends(self, spark: SparkSession) -> list[Span]:
        """For each partition the offsets present now."""
        raise NotImplementedError

    def read(self, spark: SparkSession, spans: Iterable[Span]) -> DataFrame:
        """``topic, partition, offset, value`` of the messages in ``spans``."""
        raise NotImplementedError

    def stream(self, spark: SparkSession, batch_size: int | None = None) -> DataFrame:
        """All messages from the first on, as a stream."""
        raise NotImplementedError


def _present(messages: DataFrame) -> list[Span]:
    ends = messages.groupBy("topic", "partition").agg(F.min("offset").alias("start"), (F.max("offset") + 1).alias("end"))
    return [Span(*r) for r in ends.select("topic", "partition", "start", "end").collect()]  # one row per partition


def inside(spans: Iterable[Span]) -> Column:
    """Whether a message lies in one of the spans."""
    found = F.lit(False)
    for s in spans:
        found = found | ((F.col("topic") == s.topic) & (F.col("partition") == s.partition) & (F.col("offset") >= s.start) & (F.col("offset") < s.end))
    return F.coalesce(found, F.lit(False))


@dataclass(frozen=True)
class BrokerTopic(Topic):
    """A topic of a message broker; needs its package on the classpath."""

    servers: str
    topic: str
    options: dict = field(default_factory=dict)

    def ends(self, spark):
        # The offsets present now are resolved by this one query; later ones read up to them.
        return _present(read_messages(spark, self.servers, self.topic, **self.options))

    def read(self, spark, spans):
        return read_messages(spark, self.servers, self.topic, **{**self.options, **self.offsets(spans)}).select(*MESSAGE_KEY, "value")

    @staticmethod
    def offsets(spans: Iterable[Span]) -> dict[str, str]:
        """Options that read exactly these offsets, of no other partition."""
        bounds: dict[str, dict[str, dict[str, int]]] = {"start": {}, "end": {}}
        for s in spans:
            for side, known in bounds.items():
                known.setdefault(s.topic, {})[str(s.partition)] = getattr(s, side)
        return {"startingOffsets": json.dumps(bounds["start"]), "endingOffsets": json.dumps(bounds["end"]), "assign": json.dumps({t: sorted(map(int, p)) for t, p in bounds["end"].items()})}

    def stream(self, spark, batch_size=None):
        return message_stream(spark, self.servers, self.topic, batch_size, **self.options)


@dataclass(frozen=True)
class FolderTopic(Topic):
    """A folder of Parquet files with ``topic, partition, offset, value``, to which files with higher offsets may be added."""

    path: str

    def ends(self, spark):
        return _present(self._all(spark))

    def read(self, spark, spans):
        return self._all(spark).where(inside(spans))

    def _all(self, spark):
        return spark.read.schema(MESSAGE).parquet(self.path).where("topic IS NOT NULL AND partition IS NOT NULL AND offset IS NOT NULL")

    def stream(self, spark, batch_size=None):
        reader = spark.readStream.schema(MESSAGE)
        if batch_size is not None:
            reader = reader.option("maxFilesPerTrigger", batch_size)
        return reader.parquet(self.path)


def file_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """New text files in a folder, one message per line, as a stream with a ``value`` column."""
    reader = spark.readStream.format("text")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def encode_json(df: DataFrame, value: str = "value", keep_nulls: bool = True) -> DataFrame:
    """Each row as one JSON text; the message key is null.

    ``keep_nulls=False`` leaves null fields out, which suits records read from JSON: there a field
    that was absent has become null.
    """
    row = F.struct(*[quoted(c) for c in df.columns])
    text = F.to_json(row, {"ignoreNullFields": str(not keep_nulls).lower()})
    return df.select(F.lit(None).cast("string").alias("key"), text.alias(value))


def _topic(reader, servers, topic, options):
    reader = reader.format("kafka").option("kafka.bootstrap.servers", servers)
    if "assign" not in options:
        reader = reader.option("subscribe", topic)
    return reader.option("startingOffsets", "earliest").options(**options)
