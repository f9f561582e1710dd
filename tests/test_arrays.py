import json
import random

import pytest

from medallion.sources.arrays import _split_size, split_array
from medallion.sources.documents import read_documents

ODD = ['plain', '', '}', '{"', '\\', '\\"', '"}]', '[{,}]', 'é😀\u2028', 'tab\tand\nline', ',,,', '\\\\"}', "a" * 300]


def record(rng, depth=0):
    kind = rng.randrange(6 if depth < 3 else 4)
    if kind < 2:
        return rng.choice(ODD)
    if kind == 2:
        return rng.choice([None, True, 1, -2.5, 10**12])
    if kind == 3:
        return []
    if kind == 4:
        return [record(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {rng.choice(ODD): record(rng, depth + 1) for _ in range(rng.randrange(4))}


def elements(spark, path, piece):
    found = spark.read.text(split_array(spark, str(path), piece))
    return sorted(json.dumps(json.loads(r.value)) for r in found.collect())


@pytest.mark.parametrize("layout", [{}, {"indent": 2}, {"indent": 0, "ensure_ascii": False}], ids=["one line", "indented", "unicode"])
@pytest.mark.parametrize("piece", [900])
def test_elements_of_any_shape(spark, tmp_path, layout, piece):
    rng = random.Random(8)
    want = []
    for k in range(2):
        rows = [{"id": i, "v": record(rng)} for i in range(40)]
        (tmp_path / f"{k}.json").write_text(" \n" + json.dumps(rows, **layout) + "\n\n", encoding="utf-8")
        want += rows
    assert elements(spark, tmp_path, piece) == sorted(map(json.dumps, want))


def test_plain_elements_empty_arrays_and_long_elements(spark, tmp_path):
    (tmp_path / "a.json").write_text("[]")
    (tmp_path / "b.json").write_text(' [ 1 , "x}y" , null, [2, {"k": "}"}], {} ] ')
    long = {"text": "}{\\\"," * 700}
    (tmp_path / "c.json").write_text(json.dumps([long, {"id": 1}, long]))
    want = [1, "x}y", None, [2, {"k": "}"}], {}, long, {"id": 1}, long]
    assert elements(spark, tmp_path, 256) == sorted(map(json.dumps, want))


def test_files_without_an_array_raise(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 1}')
    with pytest.raises(ValueError, match="not one JSON array"):
        split_array(spark, str(tmp_path / "a.json"))


def test_documents_with_and_without_a_schema(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"id": i, "name": f"n{i}"} for i in range(500)], indent=1))
    found = read_documents(spark, str(tmp_path / "a.json"), array_file=True, piece_bytes=4000)
    assert found.columns == ["id", "name"] and found.count() == 500
    assert len(found.inputFiles()) > 1
    typed = read_documents(spark, str(tmp_path / "a.json"), "name STRING, more INT", array_file=True)
    assert typed.where("more IS NULL AND name LIKE 'n%'").count() == 500


def test_many_small_splits_take_few_tasks(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"id": i, "name": f"n{i}"} for i in range(6000)]))
    with _split_size(spark, str(tmp_path), 512):
        parts = spark.read.option("lineSep", "}").text(str(tmp_path))
        assert parts.rdd.getNumPartitions() <= 2 * spark.sparkContext.defaultParallelism
        assert parts.select("_metadata.file_block_start").distinct().count() > 100
    assert spark.conf.get("spark.sql.files.maxPartitionNum", None) is None
    assert len(elements(spark, tmp_path, 512)) == 6000
