"""A ledger of what was taken from message topics, kept with the output.

A run or micro-batch first writes its rows into a directory of its own, and only then an entry that names the directory and the
offsets it covers, per topic and partition. An entry appears whole or not at all, and only once per number. Readers follow
the entries, so a batch that was broken off is invisible and one that is delivered again adds nothing.

    destination/_ledger/plan-7      the offsets of bounded run 7, fixed before it reads
    destination/_ledger/entry-7     run 7 is committed
    destination/data/7-<attempt>/   its documents; destination/rejects/7-<attempt>/ its malformed messages

Entries list all offsets taken so far as merged ranges, so the last one tells everything.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from medallion.functions.columns import require_absent
from medallion.operators.documents import decode_json, quarantine
from medallion.operators.drift import EVOLVE, conform, infer_schema, merge_schemas
from medallion.operators.ordering import order_statistics
from medallion.session import staged
from medallion.sources.documents import MESSAGE_KEY, Span, Topic, inside

#: Column of the output that tells which message a document came from.
KEY = "_message"


@dataclass(frozen=True)
class Entry:
    """A committed run: what it took, what was taken up to it, and where its rows are."""

    number: int
    taken: tuple[Span, ...]
    covered: tuple[Span, ...]
    data: str | None = None
    rejects: str | None = None
    rows: int = 0
    schema: str | None = None


def merged(spans: Iterable[Span]) -> tuple[Span, ...]:
    """The same offsets in as few spans as possible."""
    out: list[Span] = []
    for span in sorted(s for s in spans if s.start < s.end):
        if out and (out[-1].topic, out[-1].partition) == (span.topic, span.partition) and span.start <= out[-1].end:
            out[-1] = replace(out[-1], end=max(out[-1].end, span.end))
        else:
            out.append(span)
    return tuple(out)


class Ledger:
    """The entries under a destination, through Hadoop's file systems."""

    def __init__(self, spark: SparkSession, destination: str, rejects: str | None = None):
        self.spark, self.destination = spark, destination.rstrip("/")
        self.rejects = rejects.rstrip("/") if rejects else f"{self.destination}/rejects"
        self.root = f"{self.destination}/_ledger"
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def last(self) -> Entry | None:
        numbers = self._numbers("entry")
        return self.entry(numbers[-1]) if numbers else None

    def entries(self) -> list[Entry]:
        return [self.entry(n) for n in self._numbers("entry")]

    def entry(self, number: int) -> Entry:
        found = json.loads(self._read(f"entry-{number}"))
        spans = {k: tuple(Span(*s) for s in found.pop(k)) for k in ("taken", "covered")}
        return Entry(**found, **spans)

    def planned(self, number: int) -> tuple[Span, ...] | None:
        """The offsets fixed for a run that has not been committed yet."""
        if number not in self._numbers("plan"):
            return None
        return tuple(Span(*s) for s in json.loads(self._read(f"plan-{number}")))

    def plan(self, number: int, spans: Iterable[Span]) -> tuple[Span, ...]:
        """Fix the offsets of a run. Where another attempt was first, its offsets hold."""
        self._write_once(f"plan-{number}", json.dumps([_listed(s) for s in spans]))
        return self.planned(number)

    def commit(self, entry: Entry) -> bool:
        """Publish an entry; False where its number is taken."""
        fields = {**entry.__dict__, "taken": [_listed(s) for s in entry.taken], "covered": [_listed(s) for s in entry.covered]}
        return self._write_once(f"entry-{entry.number}", json.dumps(fields))

    def discard(self, *paths: str | None) -> None:
        """Remove output that no entry names."""
        for path in paths:
            if path is not None:
                place = self._path(path)
                place.getFileSystem(self._conf).delete(place, True)

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _numbers(self, kind: str) -> list[int]:
        root = self._path(self.root)
        fs = root.getFileSystem(self._conf)
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        return sorted(int(n.rpartition("-")[2]) for n in names if n.startswith(f"{kind}-"))

    def _read(self, name: str) -> str:
        place = self._path(f"{self.root}/{name}")
        stream = place.getFileSystem(self._conf).open(place)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _write_once(self, name: str, text: str) -> bool:
        """A file that appears with all of its text, or not at all where there is one of its name."""
        draft, place = self._path(f"{self.root}/.{name}-{uuid.uuid4().hex}"), self._path(f"{self.root}/{name}")
        fs = place.getFileSystem(self._conf)
        stream = fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(place).toUri(), self._conf)
        never = self.spark.sparkContext._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            files.rename(fs.makeQualified(draft), fs.makeQualified(place), never)
            return True
        except Exception as error:
            if "FileAlreadyExistsException" not in str(error):
                raise
            fs.delete(draft, False)
            return False


def _listed(span: Span) -> list:
    return [span.topic, span.partition, span.start, span.end]


# -- bounded runs -----------------------------------------------------------------------------------------------


def next_spans(source: Topic, spark: SparkSession, schema, limit: int, covered: Iterable[Span]) -> tuple[Span, ...]:
    """The offsets that hold the next ``limit`` readable messages, by topic, partition and offset; fewer at the end of the input.

    The ends of the topic are looked up once. Messages are decoded once, into a table of the offsets of the readable ones;
    the last offset is then found among those of one partition.
    """
    if limit <= 0:
        raise ValueError("limit must be positive")
    begun = {(s.topic, s.partition): s.end for s in covered}
    ends = {(s.topic, s.partition): s for s in source.ends(spark)}
    todo = [replace(s, start=max(s.start, begun.get(k, s.start))) for k, s in sorted(ends.items())]
    todo = [s for s in todo if s.start < s.end]
    if not todo:
        return ()
    readable = decode_json(source.read(spark, todo), None if schema == EVOLVE else schema).where("valid").select(*MESSAGE_KEY)
    with staged(readable, "readable") as places:
        counts = {(r.topic, r.partition): r.n for r in places.groupBy("topic", "partition").agg(F.count("*").alias("n")).collect()}
        taken = []
        for span in todo:
            n = counts.get((span.topic, span.partition), 0)
            if n >= limit:
                here = places.where((F.col("topic") == span.topic) & (F.col("partition") == span.partition))
                _, found = order_statistics(here, ["offset"], lambda _: {limit - 1})["offset"]
                return (*taken, replace(span, end=found[limit - 1] + 1))
            limit -= n
            taken.append(span)
    return tuple(taken)


def ingest_next(spark: SparkSession, source: Topic, schema, destination: str, limit: int, rejects: str | None = None) -> Entry | None:
    """Take the next ``limit`` readable messages, or what is left; None where nothing is.

    The offsets are fixed before anything is written. A run that was broken off is repeated with the same offsets,
    also when the topic has grown; one that is repeated after it was committed is the next run.
    """
    ledger = Ledger(spark, destination, rejects)
    last = ledger.last()
    covered, number = (last.covered, last.number + 1) if last else ((), 0)
    spans = ledger.planned(number)
    if spans is None:
        spans = next_spans(source, spark, schema, limit, covered)
        if not spans:
            return None
        spans = ledger.plan(number, spans)
    entry = stage(ledger, source.read(spark, spans), schema, number, spans, covered)
    if not ledger.commit(entry):
        # another attempt at the same offsets was first
        ledger.discard(entry.data, entry.rejects)
        return ledger.entry(number)
    return entry


# -- batches of a stream ----------------------------------------------------------------------------------------

#: Offsets looked at together, and ranges a batch may consist of.
BLOCK = 1 << 12
MOST_SPANS = 10_000


def batch_spans(batch: DataFrame, gaps_stay: bool) -> tuple[Span, ...]:
    """The offsets of a batch.

    A broker delivers ranges of a partition, and an offset it leaves out never comes: with ``gaps_stay`` a batch covers all from
    its first to its last. Otherwise only the offsets that are there count, in unbroken runs.
    """
    place = ["topic", "partition"]
    if gaps_stay:
        rows = batch.groupBy(*place).agg(F.min("offset").alias("start"), (F.max("offset") + 1).alias("end"))
    else:
        blocks = batch.groupBy(*place, F.expr(f"offset div {BLOCK}").alias("block")).agg(F.array_sort(F.collect_set("offset")).alias("o"))
        offsets = F.col("o")
        starts = F.filter(offsets, lambda x, i: F.coalesce(x - F.get(offsets, i - 1) > 1, F.lit(True)))
        ends = F.filter(offsets, lambda x, i: F.coalesce(F.get(offsets, i + 1) - x > 1, F.lit(True)))
        rows = blocks.select(*place, F.explode(F.arrays_zip(starts.alias("start"), ends.alias("end"))).alias("r")).select(*place, "r.start", (F.col("r.end") + 1).alias("end"))
    found = [Span(*r) for r in rows.select(*place, "start", "end").limit(MOST_SPANS * 10 + 1).collect()]
    if len(found) > MOST_SPANS * 10 or len(merged(found)) > MOST_SPANS:
        raise ValueError("the batch is scattered over too many ranges of offsets to keep a ledger of it")
    return merged(found)


def ingest_batch(
    spark: SparkSession, batch: DataFrame, schema, destination: str, rejects: str | None = None, value: str = "value", gaps_stay: bool = False
) -> Entry | None:
    """Take the messages of a batch that no entry covers; None where there are none.

    ``batch`` has a topic's columns ``topic``, ``partition``, ``offset``; see ``batch_spans`` for ``gaps_stay``.
    """
    ledger = Ledger(spark, destination, rejects)
    while True:
        last = ledger.last()
        covered, number = (last.covered, last.number + 1) if last else ((), 0)
        fresh = batch.where(~inside(covered))
        spans = batch_spans(fresh, gaps_stay)
        if not spans:
            return None
        entry = stage(ledger, fresh, schema, number, spans, covered, value)
        if ledger.commit(entry):
            return entry
        ledger.discard(entry.data, entry.rejects)


def stage(ledger: Ledger, messages: DataFrame, schema, number: int, spans: Iterable[Span], covered: Iterable[Span], value: str = "value") -> Entry:
    """Write the rows of a run where no reader sees them yet, and the entry that would publish them.

    With ``schema='evolve'`` documents bring their own fields: new ones are added to those of the runs before, and messages that
    contradict a known field go to the rejects, with its name in ``drift``.
    """
    decoded = decode_json(messages, None if schema == EVOLVE else schema, value)
    if schema == EVOLVE:
        # The newest fields win nothing over the stored ones: those keep their types.
        last = ledger.last()
        known = T.StructType.fromJson(json.loads(last.schema)).fields if last else []
        stored = T.StructType([f for f in known if f.name != KEY])
        decoded = conform(decoded, merge_schemas(stored, infer_schema(decoded)))
    attempt = f"{number}-{uuid.uuid4().hex}"
    key = F.struct(*MESSAGE_KEY).alias(KEY)
    good = decoded.where("valid")
    if isinstance(decoded.schema["document"].dataType, T.StructType):
        inner = good.select("document.*")
        require_absent(inner, KEY)
        documents = good.select("document.*", key)
    else:
        documents = good.select("document", key)
    data, bad = f"{ledger.destination}/data/{attempt}", f"{ledger.rejects}/{attempt}"
    # Both outputs read the messages: decode them once.
    decoded.persist()
    try:
        documents.write.parquet(data)
        rejected = quarantine(decoded)
        if rejected.isEmpty():
            bad = None
        else:
            rejected.write.parquet(bad)
    finally:
        decoded.unpersist()
    rows = ledger.spark.read.schema(documents.schema).parquet(data).count()
    return Entry(number, tuple(spans), merged([*covered, *spans]), data, bad, rows, documents.schema.json())


def read_committed(spark: SparkSession, destination: str, rejects: bool = False) -> DataFrame:
    """The documents of all committed runs, or their malformed messages, with the run in column ``_run``."""
    ledger = Ledger(spark, destination)
    entries = ledger.entries()
    paths = [p for p in (e.rejects if rejects else e.data for e in entries) if p is not None]
    if not paths:
        raise ValueError(f"nothing is committed under {destination}")
    reader = spark.read.option("mergeSchema", True) if rejects else spark.read.schema(_latest(entries))
    run = F.regexp_extract(F.col("_metadata.file_path"), r"/(\d+)-[0-9a-f]{32}/[^/]*$", 1).cast("long")
    return reader.parquet(*paths).select("*", run.alias("_run"))


def _latest(entries: list[Entry]) -> T.StructType:
    """Columns of all runs, the newest first; one that a run lacks is null there."""
    fields: dict[str, T.StructField] = {}
    for entry in reversed(entries):
        for f in T.StructType.fromJson(json.loads(entry.schema)).fields:
            fields.setdefault(f.name, f)
    return T.StructType(list(fields.values()))
