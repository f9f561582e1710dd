"""Message ingestion. Messages are the events as JSON lines, plus a cut-off copy of each."""

from __future__ import annotations

from pyspark.sql import functions as F

from medallion.operators.documents import decode_json, valid_documents
from medallion.plans.config import IngestConfig
from medallion.plans.jobs import ingest_job
from medallion.session import scratch_dir
from medallion.sources.documents import FolderTopic, Span, encode_json, file_stream
from medallion.sources.sinks import publish_json
from medallion.streaming.ingest import ingest_bounded, ingest_json_stream
from medallion.streaming.ledger import Ledger, ingest_batch, next_spans, read_committed, stage
from medallion.streaming.watch import StreamFailed, StreamWatch, run_watched
from workload import query, table

EVENT = "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE"
FILES_PER_BATCH = 256


def _messages(spark, sf_dir):
    good = encode_json(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value"))
    cut = good.select("key", F.expr("substring(value, 1, length(value) - 1)").alias("value"))
    return good.unionByName(cut)


def _ingested(spark, sf_dir):
    source, sink, rejects, checkpoint = (scratch_dir(spark, n) for n in ("topic", "sink", "rejects", "checkpoint"))
    _messages(spark, sf_dir).select("value").write.text(source)
    ingest_json_stream(file_stream(spark, source, FILES_PER_BATCH), EVENT, sink, checkpoint, rejects=rejects).awaitTermination()
    return sink, rejects


@query("SELECT event_id, user_id, event_type, value FROM events")
def stream_ingest(spark, sf_dir):
    sink, _ = _ingested(spark, sf_dir)
    return spark.read.parquet(sink).select("event_id", "user_id", "event_type", "value")


@query("SELECT event_id, 3::BIGINT AS batches FROM events")
def stream_batches(spark, sf_dir):
    """One delivery of six files, two to a micro-batch."""
    source, sink, checkpoint = (scratch_dir(spark, n) for n in ("topic", "sink", "checkpoint"))
    messages = _messages(spark, sf_dir).select("value")
    messages.repartition(6).write.text(source)
    ingest_json_stream(file_stream(spark, source, 2), EVENT, sink, checkpoint).awaitTermination()
    found = spark.read.parquet(sink)
    batches = found.agg(F.count_distinct("batch_id")).first()[0]
    return found.select("event_id", F.lit(batches).cast("long").alias("batches"))


@query("SELECT event_id FROM events")
def stream_rejects(spark, sf_dir):
    """The malformed messages are kept: their id is still readable as text."""
    _, rejects = _ingested(spark, sf_dir)
    kept = spark.read.parquet(rejects)
    return kept.select(F.regexp_extract("value", r'"event_id":(\d+)', 1).cast("bigint").alias("event_id"))


@query("""
SELECT event_id AS "offset", event_id, user_id, event_type, value FROM events WHERE event_id % 7 <> 0 ORDER BY event_id LIMIT 1000
""")
def stream_bounded(spark, sf_dir):
    """The first thousand readable messages; every seventh message is cut short and does not count."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    text = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    cut = F.substring(text, 1, 5)
    messages = events.select(F.col("event_id").alias("offset"), F.when(F.col("event_id") % 7 == 0, cut).otherwise(text).alias("value"))
    return ingest_bounded(messages, EVENT, 1000, ["offset"])


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def publish_replay(spark, sf_dir):
    """Orders published as JSON messages, then read as a consumer would."""
    orders, path = table(spark, sf_dir, "orders").drop("o_orderdate"), scratch_dir(spark, "published")
    publish_json(orders, path=path)
    return valid_documents(decode_json(spark.read.text(path), orders.schema))


PARTITIONS = 4


def _topic(spark, sf_dir):
    """Events as messages of four partitions, every seventh cut short."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    text = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    place = (F.col("event_id") % PARTITIONS).cast("int").alias("partition"), F.expr(f"event_id div {PARTITIONS}").alias("offset")
    return events.select(F.lit("events").alias("topic"), *place, F.when(F.col("event_id") % 7 == 0, F.substring(text, 1, 5)).otherwise(text).alias("value"))


@query(f"""
WITH messages AS (
  SELECT *, event_id % {PARTITIONS} AS p, event_id // {PARTITIONS} AS o, event_id < (SELECT count(*) // 2 FROM events) AS early, (SELECT count(*) // 8 FROM events) AS n
  FROM events WHERE event_id % 7 <> 0),
begun AS (SELECT *, row_number() OVER (ORDER BY p, o) AS place FROM messages WHERE early),
left_over AS (
  SELECT m.*, row_number() OVER (ORDER BY m.p, m.o) AS place FROM messages m LEFT JOIN begun b USING (event_id) WHERE b.place IS NULL OR b.place > 2 * m.n)
SELECT ((place - 1) // n)::BIGINT AS run, event_id, user_id, event_type, value FROM begun WHERE place <= 2 * n
UNION ALL SELECT 2 AS run, event_id, user_id, event_type, value FROM left_over WHERE place <= n
""")
def bounded_continues(spark, sf_dir):
    """Bounded runs that go on where the last one ended. Half of the events are there at first. The second run is broken off before
    it commits, the rest of the events arrives, and it is run again: its offsets stay those of its plan."""
    messages, source, sink = _topic(spark, sf_dir), scratch_dir(spark, "topic"), scratch_dir(spark, "runs")
    whole = table(spark, sf_dir, "events").count()
    early = F.col("offset") * PARTITIONS + F.col("partition") < whole // 2
    messages.where(early).write.parquet(source)
    topic, limit = FolderTopic(source), whole // 8
    config = IngestConfig(destination=sink, schema=EVENT, path=source, path_format="messages", message_limit=limit)
    ingest_job(spark, config)
    ledger = Ledger(spark, sink)
    covered = ledger.last().covered
    spans = ledger.plan(1, next_spans(topic, spark, EVENT, limit, covered))
    stage(ledger, topic.read(spark, spans), EVENT, 1, spans, covered)  # not committed
    messages.where(~early).write.mode("append").parquet(source)
    ingest_job(spark, config)
    ingest_job(spark, config)
    return read_committed(spark, sink).select(F.col("_run").alias("run"), "event_id", "user_id", "event_type", "value")


@query(f"""
SELECT event_id, user_id, event_type, value, event_id % {PARTITIONS} AS "partition", event_id // {PARTITIONS} AS "offset" FROM events WHERE event_id % 7 <> 0
""")
def keyed_batches(spark, sf_dir):
    """Batches broken off, delivered twice, and all delivered again from the first message on: every message counts once."""
    messages, sink = _topic(spark, sf_dir), scratch_dir(spark, "keyed")
    middle = messages.agg(F.expr("max(offset) div 2").alias("m")).first().m
    first, second = messages.where(F.col("offset") < middle), messages.where(F.col("offset") >= middle)
    ledger, spans = Ledger(spark, sink), [Span("events", p, 0, middle) for p in range(PARTITIONS)]
    stage(ledger, first, EVENT, 0, spans, ())  # broken off: written, not committed
    for batch in (first, first, second):
        ingest_batch(spark, batch, EVENT, sink)
    source = scratch_dir(spark, "topic")
    messages.repartitionByRange(4, "offset").write.parquet(source)
    for checkpoint in ("one", "lost"):
        config = IngestConfig(sink, scratch_dir(spark, checkpoint), schema=EVENT, path=source, path_format="messages", delivery="commit", batch_size=2)
        ingest_job(spark, config)
    found = read_committed(spark, sink)
    return found.select("event_id", "user_id", "event_type", "value", F.col("_message.partition").cast("bigint").alias("partition"), "_message.offset")


@query("""
SELECT event_id, 'taken' AS status, event_id < (SELECT count(*) // 2 FROM events) AS early, user_id::VARCHAR AS user_id, round(value, 6) AS value,
       CASE WHEN event_id >= (SELECT count(*) // 2 FROM events) THEN concat('c', event_id % 3) END AS channel
FROM events WHERE event_id < (SELECT count(*) // 2 FROM events) OR event_id % 5 <> 0
UNION ALL
SELECT event_id, '$[''user_id'']', false, NULL, NULL, NULL FROM events WHERE event_id >= (SELECT count(*) // 2 FROM events) AND event_id % 5 = 0
""")
def schema_drift(spark, sf_dir):
    """Messages without a schema. The later delivery brings a new field, and in every fifth message another type of a known one."""
    events, sink = table(spark, sf_dir, "events"), scratch_dir(spark, "drift")
    half = events.count() // 2
    late = F.col("event_id") >= half
    user = F.when(late & (F.col("event_id") % 5 == 0), F.concat(F.lit('"u'), "user_id", F.lit('"'))).otherwise(F.col("user_id").cast("string"))
    channel = F.when(late, F.concat(F.lit(',"nested":{"channel":"c'), F.col("event_id") % 3, F.lit('"}'))).otherwise("")
    text = F.concat(F.lit('{"event_id":'), "event_id", F.lit(',"user_id":'), user, F.lit(',"value":'), F.to_json(F.struct("value")).substr(F.lit(10), F.lit(40)))
    text = F.concat(F.regexp_replace(text, r"\}$", ""), channel, F.lit("}"))
    messages = events.select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"), text.alias("value"))
    for batch in (messages.where(~late), messages.where(late)):
        ingest_batch(spark, batch, "evolve", sink, gaps_stay=True)
    taken = read_committed(spark, sink).select(
        "event_id", F.lit("taken").alias("status"), (F.col("event_id") < half).alias("early"), F.col("user_id").cast("string").alias("user_id"),
        F.round("value", 6).alias("value"), F.col("nested.channel").alias("channel"),
    )
    kept = read_committed(spark, sink, rejects=True)
    none = [F.lit(False).alias("early"), F.lit(None).cast("string").alias("user_id"), F.lit(None).cast("double").alias("value"), F.lit(None).cast("string").alias("channel")]
    return taken.unionByName(kept.select(F.col("offset").alias("event_id"), F.col("drift").alias("status"), *none))


@query("""
WITH n AS (SELECT count(*) FILTER (event_id % 7 <> 0) AS whole, count(*) FILTER (event_id % 7 <> 0 AND event_id % 3 = 0) AS first FROM events)
SELECT 1::BIGINT AS run, 'none' AS kind, first AS documents FROM n UNION ALL SELECT 2, 'data loss', first FROM n UNION ALL SELECT 3, 'none', whole FROM n
""")
def watched_streams(spark, sf_dir):
    """A stream whose folder is damaged between two runs, and mended before the third: what the watch says, and the documents so far."""
    messages = _topic(spark, sf_dir)
    source, spare, sink, checkpoint = (scratch_dir(spark, n) for n in ("topic", "spare", "sink", "checkpoint"))
    third = (F.col("offset") * PARTITIONS + F.col("partition")) % 3 == 0
    messages.where(third).write.parquet(source)
    messages.where(~third).coalesce(1).write.parquet(spare)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    fs = place(source).getFileSystem(conf)
    (good,) = [s.getPath() for s in fs.listStatus(place(spare)) if s.getPath().getName().startswith("part-")]
    damaged = place(f"{source}/{good.getName()}")

    def start():
        return ingest_json_stream(FolderTopic(source).stream(spark), EVENT, sink, checkpoint)

    out = []
    for run in (1, 2, 3):
        if run == 2:
            stream = fs.create(damaged, True)
            stream.write(bytearray(b"torn" * 100))
            stream.close()
        if run == 3:
            fs.delete(damaged, False)
            fs.rename(good, damaged)
        watch = StreamWatch()
        try:
            run_watched(spark, start, watch, pause=0.1)
        except StreamFailed:
            pass
        ends = watch.record(spark).where("state = 'ended'").select("kind").collect()
        out.append((run, ",".join(r.kind for r in ends), spark.read.parquet(sink).count()))
    return spark.createDataFrame(out, "run long, kind string, documents long")
