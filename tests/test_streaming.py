import json

import pytest
from pyspark.sql import functions as F

from medallion.operators.documents import decode_json, valid_documents
from medallion.sources.documents import file_stream
from medallion.streaming.ingest import ingest_bounded, ingest_json_stream, path_sink

SCHEMA = "id INT, name STRING"


def fill(folder, files):
    folder.mkdir(exist_ok=True)
    for name, lines in files.items():
        (folder / name).write_text("\n".join(lines) + "\n")


def message(i):
    return json.dumps({"id": i, "name": f"n{i}"})


@pytest.fixture
def topic(tmp_path):
    fill(tmp_path / "topic", {f"{k}.txt": [message(10 * k + j) for j in range(3)] + ["{broken", "plain"] for k in range(4)})
    return tmp_path


def run(spark, base, **kwargs):
    stream = file_stream(spark, str(base / "topic"), 1)
    query = ingest_json_stream(stream, SCHEMA, str(base / "docs"), str(base / "ckpt"), rejects=str(base / "bad"), **kwargs)
    query.awaitTermination()


def test_micro_batches_equal_the_batch_result(spark, topic):
    run(spark, topic)
    docs = spark.read.parquet(str(topic / "docs"))
    assert docs.select("batch_id").distinct().count() == 4
    batch = valid_documents(decode_json(spark.read.text(str(topic / "topic")), SCHEMA))
    assert sorted(docs.select("id", "name").collect()) == sorted(batch.collect())
    assert spark.read.parquet(str(topic / "bad")).groupBy("value").count().count() == 2


def test_a_second_run_continues(spark, topic):
    run(spark, topic)
    run(spark, topic)
    assert spark.read.parquet(str(topic / "docs")).count() == 12
    fill(topic / "topic", {"9.txt": [message(90)]})
    run(spark, topic)
    assert spark.read.parquet(str(topic / "docs")).count() == 13


def test_a_repeated_batch_replaces_its_output(spark, tmp_path):
    write = path_sink(str(tmp_path / "o"))
    for _ in range(2):
        write(spark.range(5), 0)
    write(spark.range(2), 1)
    assert spark.read.parquet(str(tmp_path / "o")).count() == 7


def test_custom_sink_and_variant_documents(spark, topic):
    seen = []
    query = ingest_json_stream(
        file_stream(spark, str(topic / "topic")),
        None,
        lambda batch, number: seen.extend(r.j for r in batch.select(F.to_json("document").alias("j")).collect()),
        str(topic / "ckpt2"),
    )
    query.awaitTermination()
    assert len(seen) == 12 and json.loads(seen[0]).keys() == {"id", "name"}


@pytest.mark.parametrize("limit, expected", [(1, [0]), (2, [0, 2]), (3, [0, 2, 3]), (4, [0, 2, 3, 5]), (15, [0, 2, 3, 5, 6])])
def test_bounded_run_counts_readable_messages_only(spark, limit, expected):
    rows = [(i // 4, i % 4, "{oops" if i in (1, 4) else message(i)) for i in range(7)]
    messages = spark.createDataFrame(rows, "partition int, offset long, value string").repartition(3)
    out = ingest_bounded(messages, SCHEMA, limit, ["partition", "offset"])
    assert sorted(r.id for r in out.collect()) == expected
    single = messages.select((F.col("partition") * 4 + F.col("offset")).alias("offset"), "value")
    out = ingest_bounded(single, SCHEMA, limit, ["offset"])
    assert sorted(r.id for r in out.collect()) == expected


def test_bounded_run_needs_a_limit(spark):
    with pytest.raises(ValueError):
        ingest_bounded(spark.createDataFrame([(0, "{}")], "offset long, value string"), SCHEMA, 0, ["offset"])
