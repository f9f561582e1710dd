import json

import pytest
from pyspark.sql import functions as F

from medallion.operators.documents import (
    PATIENT_SCHEMA,
    PATIENT_SPEC,
    Field,
    decode_json,
    flatten,
    quarantine,
    valid_documents,
)
from medallion.sources.documents import encode_json, read_documents

FULL = {
    "patient": {
        "personal_information": {"name": "Ann Roe", "age": 51, "gender": "female", "contact_details": {"phone": "1", "address": "2 Lane"}},
        "medical_history": {
            "conditions": ["Gout", "Flu"],
            "allergies": [],
            "medications": [{"name": "A", "dosage": "1mg", "frequency": "daily"}, {"name": "B", "dosage": "2mg", "frequency": "weekly"}],
        },
        "appointments": [
            {"date": "2024-01-01", "doctor": "X", "reason": "first"},
            {"date": "2024-02-02", "doctor": "Y", "reason": "second"},
        ],
    }
}
NO_CONTACT = {"patient": {"personal_information": {"name": "Bob"}, "medical_history": {"conditions": None}, "appointments": []}}
EMPTY = {"other": 1}


@pytest.fixture(scope="module")
def patients(spark):
    df = spark.createDataFrame([(json.dumps(d),) for d in (FULL, NO_CONTACT, EMPTY)], "value string")
    return df.select(F.from_json("value", PATIENT_SCHEMA).alias("d")).select("d.*")


def test_flat_text_row(patients):
    rows = [r.asDict() for r in flatten(patients).collect()]
    assert list(rows[0]) == [f.output for f in PATIENT_SPEC] and len(PATIENT_SPEC) == 13
    assert list(rows[0].values()) == [
        "Ann Roe", "51", "female", "1", "2 Lane", "Gout, Flu", "", "A, B", "1mg, 2mg", "daily, weekly", "2024-02-02", "Y", "second",
    ]
    assert list(rows[1].values()) == ["Bob"] + [""] * 12
    assert list(rows[2].values()) == [""] * 13


def test_typed_rows_keep_nulls(patients):
    out = flatten(patients, text=False)
    assert dict(out.dtypes)["patient_age"] == "bigint"
    assert [r.patient_age for r in out.collect()] == [51, None, None]


def test_explode_keeps_every_appointment(patients):
    rows = flatten(patients, many="explode").select("patient_name", "appointments_doctor").collect()
    assert [tuple(r) for r in rows] == [("Ann Roe", "X"), ("Ann Roe", "Y"), ("Bob", ""), ("", "")]


def test_null_array_elements_are_skipped(spark):
    df = spark.createDataFrame([(["a", None, "b"],), (None,)], "xs array<string>")
    assert [r.x for r in flatten(df, (Field("x", "xs", "join"),)).collect()] == ["a, b", ""]


def test_spec_errors(patients):
    with pytest.raises(ValueError):
        flatten(patients, (Field("x", "patient", "other"),))
    with pytest.raises(ValueError):
        flatten(patients, many="first")


MESSAGES = ['{"a": 1}', "x", "[1]", "null", '{"a": "q"}', '{"a": 1', None, "", '{"a": null}', ' {"b": 2}']


def test_decode_with_a_schema(spark):
    df = spark.createDataFrame([(m,) for m in MESSAGES], "value string")
    out = decode_json(df, "a INT")
    assert [r.valid for r in out.collect()] == [True] + [False] * 7 + [True, True]
    assert [r.a for r in valid_documents(out).collect()] == [1, None, None]
    assert [r.value for r in quarantine(out).collect()] == MESSAGES[1:8]


def test_decode_without_a_schema(spark):
    df = spark.createDataFrame([(m,) for m in MESSAGES], "value string")
    out = valid_documents(decode_json(df, None))
    assert [r.j for r in out.select(F.to_json("document").alias("j")).collect()] == ['{"a":1}', '{"a":"q"}', '{"a":null}', '{"b":2}']


def test_decode_bytes(spark):
    df = spark.createDataFrame([(bytearray('{"a":"é"}'.encode()),), (bytearray(b'{"a":"\xe9"}'),)], "value binary")
    assert [(r.valid, r.document and r.document.a) for r in decode_json(df, "a STRING").collect()] == [(True, "é"), (False, None)]


def test_reserved_names_are_refused(spark):
    df = spark.createDataFrame([("{}", 1)], "value string, valid int")
    with pytest.raises(ValueError):
        decode_json(df, "a INT")


def test_encode_keeps_or_drops_nulls(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    assert tuple(encode_json(df).first()) == (None, '{"a":1,"b":null}')
    assert encode_json(df, keep_nulls=False).first().value == '{"a":1}'


def test_array_file_and_lines_give_the_same_rows(spark, tmp_path):
    docs = [FULL, NO_CONTACT]
    (tmp_path / "array.json").write_text(json.dumps(docs, indent=2))
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(d) for d in docs))
    array = read_documents(spark, str(tmp_path / "array.json"), PATIENT_SCHEMA, array_file=True)
    lines = read_documents(spark, str(tmp_path / "lines.json"), PATIENT_SCHEMA)
    assert array.collect() == lines.collect()
    assert read_documents(spark, str(tmp_path / "array.json"), array_file=True).count() == 2
