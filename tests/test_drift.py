import json

import pytest
from pyspark.sql import functions as F, types as T

from medallion.operators.documents import decode_json, quarantine
from medallion.operators.drift import conform, infer_schema, merge_schemas
from medallion.streaming import ledger as led


def decoded(spark, documents):
    rows = [(d if isinstance(d, str) else json.dumps(d),) for d in documents]
    return decode_json(spark.createDataFrame(rows, "value string"), None)


FIRST = [
    {"id": 1, "x": 1.5, "tags": ["a"], "deep": {"a": 1, "b": None}, "none": None, "flag": True, "odd name": "q"},
    {"id": 2, "x": 2, "tags": [], "mixed": 1, "big": 10**25}, {"id": None, "mixed": "one", "deep": {"c": {"d": "e"}}}, {}, "broken{", "[1]",
]


def test_schema_of_documents(spark):
    found = infer_schema(decoded(spark, FIRST).where("valid"))
    want = "big decimal(38,0), deep struct<a:bigint,c:struct<d:string>>, flag boolean, id bigint, mixed variant, `odd name` string, tags array<string>, x double"
    assert {f.name: f.dataType for f in found.fields} == {f.name: f.dataType for f in T._parse_datatype_string(want).fields}
    assert infer_schema(decoded(spark, ["{}", "1"])) == T.StructType([])
    assert infer_schema(decoded(spark, [])) == T.StructType([])


def test_stored_types_stay_and_new_fields_come(spark):
    stored = T._parse_datatype_string("id bigint, deep struct<a:bigint>")
    found = T._parse_datatype_string("deep struct<a:string,b:string>, id string, new boolean")
    merged = merge_schemas(stored, found)
    assert merged == T._parse_datatype_string("id bigint, deep struct<a:bigint,b:string>, new boolean")


CASES = [
    ({"id": 5}, None), ({"id": None, "x": 3, "deep": {"a": None}}, None), ({"id": "5"}, "$['id']"), ({"id": 1.5}, "$['id']"), ({"id": 10**25}, "$['id']"),
    ({"x": 10**25}, None), ({"x": "a"}, "$['x']"), ({"deep": 3}, "$['deep']"), ({"deep": {"a": "z", "c": 1}}, "$['deep']['a'], $['deep']['c']"), ({"tags": "a"}, "$['tags']"),
    ({"tags": None}, None), ({"mixed": [1]}, None), ({"flag": 1}, "$['flag']"), ({"odd name": "w"}, None), ({"big": 7}, None), ({"big": 7.5}, "$['big']"), ({}, None),
]


def test_messages_that_contradict_are_named(spark):
    schema = infer_schema(decoded(spark, FIRST).where("valid"))
    rows = conform(decoded(spark, [c for c, _ in CASES] + ["broken{"]), schema)
    found = {r.value: r for r in rows.withColumn("document", F.to_json("document")).collect()}
    for document, drift in CASES:
        r = found[json.dumps(document)]
        assert (r.valid, r.drift) == (drift is None, drift), document
        assert (r.document is None) == (drift is not None)
    assert not found["broken{"].valid and found["broken{"].drift is None
    kept = json.loads(found[json.dumps({"id": None, "x": 3, "deep": {"a": None}})].document)
    assert kept["x"] == 3.0 and "id" not in kept
    assert quarantine(rows).columns == ["value", "drift"]


def test_runs_with_a_schema_that_grows(spark, tmp_path):
    sink = str(tmp_path / "sink")

    def batch(documents, start):
        rows = [("t", 0, start + i, json.dumps(d)) for i, d in enumerate(documents)]
        return spark.createDataFrame(rows, "topic string, partition int, offset long, value string")

    led.ingest_batch(spark, batch([{"id": 1}, {"id": 2}], 0), "evolve", sink)
    led.ingest_batch(spark, batch([{"id": "x"}, {"id": 3, "more": [1.5]}], 2), "evolve", sink)
    led.ingest_batch(spark, batch([{"id": "y", "last": 1}], 4), "evolve", sink)
    found = led.read_committed(spark, sink)
    assert sorted((r.id, r.more) for r in found.collect()) == [(1, None), (2, None), (3, [1.5])]
    assert found.schema["last"].dataType == T.LongType()
    assert sorted((r.offset, r.drift) for r in led.read_committed(spark, sink, rejects=True).collect()) == [(2, "$['id']"), (4, "$['id']")]


def test_names_with_quotes(spark):
    rows = [{"it's": 1, 'a"b': 2}]
    schema = infer_schema(decoded(spark, rows))
    (r,) = conform(decoded(spark, rows), schema).collect()
    assert r.document["it's"] == 1 and r.document['a"b'] == 2
    with pytest.raises(ValueError, match="quotes"):
        conform(decoded(spark, rows), T.StructType([T.StructField("a'\"", T.LongType())]))
