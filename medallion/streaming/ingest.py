"""Ingest JSON messages as documents; malformed ones go to a quarantine."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from medallion.functions.columns import require_absent
from medallion.operators.documents import decode_json, quarantine, valid_documents
from medallion.operators.ordering import order_statistics
from medallion.session import staged
from medallion.sources.documents import MESSAGE_KEY
from medallion.streaming.ledger import ingest_batch

Sink = Callable[[DataFrame, int], None]


def path_sink(path: str, fmt: str = "parquet") -> Sink:
    """One directory per micro-batch. A batch that is run again replaces its own output only."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.format(fmt).mode("overwrite").save(f"{path}/batch_id={batch_id}")

    return write


def store_sink(fmt: str, **options: str) -> Sink:
    """Write to a document store. The batch number travels as a column; messages of a topic also bring ``_id``, their topic,
    partition and offset, by which a store that replaces equal ids takes a repeated batch once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        numbered = batch.withColumn("batch_id", F.lit(batch_id))
        numbered.write.format(fmt).mode("append").options(**options).save()

    return write


def message_id() -> Column:
    return F.concat_ws(":", *MESSAGE_KEY).alias("_id")


def ingest_json_stream(
    stream: DataFrame,
    schema: T.StructType | str | None,
    sink: Sink | str,
    checkpoint: str,
    *,
    rejects: Sink | str | None = None,
    value: str = "value",
    keep_id: bool = False,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the ingestion. The checkpoint keeps the position in the source between runs.

    The size of a micro-batch is a setting of the source. ``available_now=True`` stops once the
    input present at the start is consumed. ``keep_id`` adds the message's ``_id`` to its document.
    """
    write = path_sink(sink) if isinstance(sink, str) else sink
    write_reject = path_sink(rejects) if isinstance(rejects, str) else rejects

    def documents(decoded: DataFrame) -> DataFrame:
        found = valid_documents(decoded)
        if not keep_id:
            return found
        require_absent(found, "_id")
        return decoded.where("valid").select(message_id(), "document" if schema is None else "document.*")

    def handle(batch: DataFrame, batch_id: int) -> None:
        decoded = decode_json(batch, schema, value)
        if write_reject is None:
            write(documents(decoded), batch_id)
            return
        # Both outputs read the batch: decode it once.
        decoded = decoded.persist()
        try:
            write(documents(decoded), batch_id)
            write_reject(quarantine(decoded), batch_id)
        finally:
            decoded.unpersist()

    return _started(stream, handle, checkpoint, available_now)


def ingest_committed_stream(
    stream: DataFrame, schema: T.StructType | str | None, destination: str, checkpoint: str, *,
    rejects: str | None = None, gaps_stay: bool = False, available_now: bool = True,
) -> StreamingQuery:
    """Start the ingestion of a topic into committed runs (``medallion.streaming.ledger``).

    Messages are known by topic, partition and offset, so a batch that comes again, also after its checkpoint was lost, adds
    nothing, and one that was broken off is not seen.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        ingest_batch(batch.sparkSession, batch, schema, destination, rejects, gaps_stay=gaps_stay)

    return _started(stream, handle, checkpoint, available_now)


def _started(stream: DataFrame, handle: Sink, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def ingest_bounded(
    messages: DataFrame,
    schema: T.StructType | str | None,
    limit: int,
    order: list[str],
    value: str = "value",
) -> DataFrame:
    """The first ``limit`` readable messages in the given order, fewer when the input ends before.

    ``order`` is a position, or a partition and a position in it; both numbers. The position of the last
    message is looked up first, so that no task has to gather them: messages are decoded once into a table of the positions of
    the readable ones. Exactly ``limit`` rows come out: of messages that share the last position the smallest texts, and null
    positions and partitions come last.
    """
    if limit <= 0:
        raise ValueError("limit must be positive")
    readable = decode_json(messages, schema, value).where("valid")
    with staged(readable.select(*order), "positions") as places:
        taken = _first(places, limit, order)
    rows = readable.where(taken.whole)
    if taken.edge is not None:
        rows = rows.unionByName(readable.where(taken.edge).orderBy(value).limit(taken.rest))
    return rows.select(*order, *([F.col("document.*")] if schema is not None else ["document"]))


@dataclass(frozen=True)
class _Taken:
    """Which rows count: all of ``whole``, and ``rest`` of those at the ``edge``."""

    whole: Column
    edge: Column | None = None
    rest: int = 0


def _first(places: DataFrame, limit: int, order: list[str]) -> _Taken:
    *group, position = order
    if len(group) > 1:
        raise ValueError("order takes a position, or a partition and a position")
    if not group:
        return _upto(places, position, limit, F.lit(True))
    # One row per partition of the topic.
    (name,) = group
    parts = places.groupBy(name).agg(F.count("*").alias("n")).orderBy(F.col(name).asc_nulls_last()).collect()
    whole = F.lit(False)
    for part in parts:
        here = F.col(name).eqNullSafe(F.lit(part[name]))
        if limit <= part.n:
            found = _upto(places.where(here), position, limit, here)
            return _Taken(whole | found.whole, found.edge, found.rest)
        limit -= part.n
        whole = whole | here
    return _Taken(whole)


def _upto(places: DataFrame, position: str, limit: int, here: Column) -> _Taken:
    """Rows below the position of the last of ``limit``, and as many at that position as are left."""
    n, found = order_statistics(places, [position], lambda n: {limit - 1} if limit <= n else set())[position]
    c = F.col(position)
    if limit > n:
        return _Taken(here & c.isNotNull(), here & c.isNull(), limit - n)
    cut = F.lit(found[limit - 1])
    return _Taken(here & (c < cut), here & (c == cut), limit - places.where(c < cut).count())
