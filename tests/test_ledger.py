import json

import pytest
from pyspark.sql import functions as F

from medallion.plans.config import IngestConfig
from medallion.plans.jobs import ingest_job
from medallion.sources.documents import BrokerTopic, FolderTopic, Span
from medallion.streaming import ledger as led

SCHEMA = "id INT"


def rows(keys):
    """Messages of three partitions; every fifth is malformed."""
    return [("t", k % 3, k // 3, "{no" if k % 5 == 0 else json.dumps({"id": k})) for k in keys]


def deliver(spark, path, keys):
    spark.createDataFrame(rows(keys), "topic string, partition int, offset long, value string").repartition(2).write.mode("append").parquet(path)


def ids(spark, sink, run=None):
    found = led.read_committed(spark, sink)
    return sorted(r.id for r in (found if run is None else found.where(F.col("_run") == run)).collect())


def good(keys):
    return [k for k in keys if k % 5]


def in_order(keys):
    return sorted(good(keys), key=lambda k: (k % 3, k // 3))


@pytest.fixture
def topic(spark, tmp_path):
    deliver(spark, str(tmp_path / "topic"), range(60))
    return FolderTopic(str(tmp_path / "topic"))


def test_runs_go_on_until_the_end(spark, topic, tmp_path):
    sink = str(tmp_path / "sink")
    entries = []
    while (entry := led.ingest_next(spark, topic, SCHEMA, sink, 20)) is not None:
        entries.append(entry)
    want = in_order(range(60))
    assert [e.rows for e in entries] == [20, 20, 8]
    for n in range(3):
        assert ids(spark, sink, n) == sorted(want[20 * n : 20 * n + 20])
    assert entries[-1].covered == (Span("t", 0, 0, 20), Span("t", 1, 0, 20), Span("t", 2, 0, 20))
    assert led.read_committed(spark, sink, rejects=True).count() == 12
    deliver(spark, topic.path, range(60, 70))
    assert led.ingest_next(spark, topic, SCHEMA, sink, 100).rows == 8
    assert ids(spark, sink) == good(range(70))


def test_a_run_broken_off_keeps_its_offsets(spark, topic, tmp_path, monkeypatch):
    sink = str(tmp_path / "sink")

    def break_off(self, entry):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(led.Ledger, "commit", break_off)
        with pytest.raises(RuntimeError):
            led.ingest_next(spark, topic, SCHEMA, sink, 10)
    with pytest.raises(ValueError, match="nothing is committed"):
        led.read_committed(spark, sink)
    # partition 0 grows before the run is repeated
    spark.createDataFrame([("t", 0, o, '{"id": 1000}') for o in range(20, 40)], "topic string, partition int, offset long, value string").write.mode("append").parquet(topic.path)
    led.ingest_next(spark, topic, SCHEMA, sink, 10)
    assert ids(spark, sink) == sorted(in_order(range(60))[:10])


def test_one_attempt_wins(spark, topic, tmp_path):
    """Two attempts at one run: the later one finds the entry, and its output goes."""
    ledger = led.Ledger(spark, str(tmp_path / "sink"))
    spans = ledger.plan(0, [Span("t", 0, 0, 5)])
    assert ledger.plan(0, [Span("t", 0, 0, 9)]) == spans
    one, two = (led.stage(ledger, topic.read(spark, spans), SCHEMA, 0, spans, ()) for _ in range(2))
    assert ledger.commit(two) and not ledger.commit(one)
    ledger.discard(one.data, one.rejects)
    assert ids(spark, ledger.destination) == good(range(0, 15, 3))
    assert ledger.entry(0).data == two.data and [e.number for e in ledger.entries()] == [0]
    assert len(list((tmp_path / "sink" / "data").iterdir())) == 1


def test_batches_count_messages_once(spark, topic, tmp_path):
    sink = str(tmp_path / "sink")
    whole = topic.read(spark, topic.ends(spark))
    first = whole.where("offset < 7")
    assert led.ingest_batch(spark, first, SCHEMA, sink).rows == len(good(range(21)))
    assert led.ingest_batch(spark, first, SCHEMA, sink) is None
    overlapping = whole.where("offset between 4 and 9")
    assert led.ingest_batch(spark, overlapping, SCHEMA, sink).taken == tuple(Span("t", p, 7, 10) for p in range(3))
    assert ids(spark, sink) == good(range(30))
    assert led.ingest_batch(spark, whole.limit(0), SCHEMA, sink) is None


def test_positions_above_double_precision(spark, tmp_path):
    base = 2**53 + 1
    path, sink = str(tmp_path / "topic"), str(tmp_path / "sink")
    spark.createDataFrame([("t", 0, base + i, json.dumps({"id": i})) for i in range(6)], "topic string, partition int, offset long, value string").write.parquet(path)
    for limit, want in ((1, [0]), (3, [0, 1, 2, 3]), (5, list(range(6)))):
        led.ingest_next(spark, FolderTopic(path), SCHEMA, sink, limit)
        assert ids(spark, sink) == want
    assert led.ingest_next(spark, FolderTopic(path), SCHEMA, sink, 5) is None


def test_columns_may_be_added_between_runs(spark, topic, tmp_path):
    sink = str(tmp_path / "sink")
    led.ingest_next(spark, topic, SCHEMA, sink, 5)
    led.ingest_next(spark, topic, "id INT, more STRING", sink, 5)
    found = led.read_committed(spark, sink)
    assert found.columns[:2] == ["id", "more"] or set(found.columns) >= {"id", "more", "_message", "_run"}
    assert found.count() == 10
    with pytest.raises(ValueError, match="_message"):
        led.ingest_next(spark, topic, "id INT, _message STRING", sink, 5)


def test_job_of_bounded_and_unbounded_runs(spark, topic, tmp_path):
    sink, bad = str(tmp_path / "sink"), str(tmp_path / "bad")
    bounded = IngestConfig(sink, schema=SCHEMA, path=topic.path, path_format="messages", message_limit=10, rejects=bad)
    ingest_job(spark, bounded)
    for checkpoint in ("a", "a", "b"):
        ingest_job(spark, IngestConfig(sink, str(tmp_path / checkpoint), schema=SCHEMA, path=topic.path, path_format="messages", delivery="commit", batch_size=1, rejects=bad))
    assert ids(spark, sink) == good(range(60))
    assert spark.read.option("recursiveFileLookup", True).parquet(bad).count() == 12


def test_store_delivery_brings_message_ids(spark, topic, tmp_path):
    out = str(tmp_path / "store")
    config = IngestConfig("unused", str(tmp_path / "c"), schema=SCHEMA, path=topic.path, path_format="messages", delivery="store", store_format="parquet", store_options={"path": out})
    ingest_job(spark, config)
    found = {r._id: r.id for r in spark.read.parquet(out).collect()}
    assert found == {f"t:{k % 3}:{k // 3}": k for k in good(range(60))}


@pytest.mark.parametrize("change", [{"message_limit": 3}, {"delivery": "commit"}, {"delivery": "both"}, {"checkpoint": None}])
def test_jobs_that_cannot_run(spark, tmp_path, change):
    config = IngestConfig(**{"destination": str(tmp_path / "s"), "checkpoint": str(tmp_path / "c"), "path": str(tmp_path), **change})
    with pytest.raises(ValueError):
        ingest_job(spark, config)


def test_offsets_for_a_broker():
    options = BrokerTopic.offsets([Span("t", 0, 3, 9), Span("t", 2, 0, 4)])
    assert json.loads(options["startingOffsets"]) == {"t": {"0": 3, "2": 0}}
    assert json.loads(options["endingOffsets"]) == {"t": {"0": 9, "2": 4}}
    assert json.loads(options["assign"]) == {"t": [0, 2]}


def test_merged_spans():
    spans = [Span("t", 0, 5, 9), Span("t", 0, 0, 3), Span("t", 0, 3, 5), Span("t", 1, 4, 4), Span("u", 0, 9, 12), Span("t", 0, 7, 8)]
    assert led.merged(spans) == (Span("t", 0, 0, 9), Span("u", 0, 9, 12))
