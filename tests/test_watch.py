import pytest

from medallion.sources.documents import file_stream
from medallion.streaming.ingest import ingest_json_stream
from medallion.streaming.watch import StreamFailed, StreamWatch, classify, run_watched


@pytest.mark.parametrize("text, kind", [
    (None, "none"), ("", "none"), ("java.io.FileNotFoundException: gone", "data loss"), ("[FAILED_READ_FILE.CANNOT_READ_FILE_FOOTER] x", "data loss"),
    ("Some data may have been lost because they are not available", "data loss"), ("org.apache.kafka.common.errors.TimeoutException: 60000 ms", "retryable"),
    ("Connection refused: host", "retryable"), ("ExecutorLostFailure (executor 3 exited)", "retryable"), ("[DIVIDE_BY_ZERO]", "other"),
    ("Connection reset while FileNotFoundException", "data loss"),
])
def test_errors_by_kind(text, kind):
    assert classify(text) == kind


def source(tmp_path):
    (tmp_path / "in").mkdir(exist_ok=True)
    (tmp_path / "in" / "a.txt").write_text('{"id": 1}\n{"id": 2}\n')
    return str(tmp_path / "in")


def test_a_good_run_is_recorded(spark, tmp_path):
    watch, path = StreamWatch(), source(tmp_path)
    run_watched(spark, lambda: ingest_json_stream(file_stream(spark, path), "id INT", str(tmp_path / "o"), str(tmp_path / "c")), watch)
    events = watch.record(spark).orderBy("number").collect()
    assert events[0].state == "started" and events[-1].state == "ended" and events[-1].kind == "none"
    assert len({e.run for e in events}) == 1
    watch.store(spark, str(tmp_path / "events"))
    assert spark.read.parquet(str(tmp_path / "events")).count() == len(events)


@pytest.mark.parametrize("message, attempts", [("Connection refused", 3), ("no such rule", 1)])
def test_only_passing_errors_are_tried_again(spark, tmp_path, message, attempts):
    path, calls = source(tmp_path), []

    def sink(batch, number):
        calls.append(number)
        raise RuntimeError(message)

    with pytest.raises(StreamFailed) as failed:
        run_watched(spark, lambda: ingest_json_stream(file_stream(spark, path), "id INT", sink, str(tmp_path / "c")), StreamWatch(), pause=0.01)
    assert failed.value.attempts == attempts == len(calls)


def test_an_error_that_passes(spark, tmp_path):
    path, calls, watch = source(tmp_path), [], StreamWatch()

    def sink(batch, number):
        calls.append(batch.count())
        if len(calls) == 1:
            raise RuntimeError("request timed out")

    run_watched(spark, lambda: ingest_json_stream(file_stream(spark, path), "id INT", sink, str(tmp_path / "c")), watch, pause=0.01)
    assert calls == [2, 2]
    assert [e.kind for e in watch.record(spark).where("state = 'ended'").orderBy("number").collect()] == ["retryable", "none"]
