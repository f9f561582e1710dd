"""Flattening of nested documents and decoding of JSON messages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from medallion.functions.columns import require_absent

LIST_SEPARATOR = ", "


@dataclass(frozen=True)
class Field:
    """One output column of a flattened document.

    ``rule`` is ``value`` for a scalar, ``join`` for an array (of text, or of structs when the path
    goes through an array) joined to text, ``last`` for the named field of an array's last struct.
    """

    output: str
    path: str
    rule: str = "value"


# Columns and paths of the flattened patient document, in output order.
PATIENT_SPEC = (
    Field("patient_name", "patient.personal_information.name"),
    Field("patient_age", "patient.personal_information.age"),
    Field("patient_gender", "patient.personal_information.gender"),
    Field("patient_phone", "patient.personal_information.contact_details.phone"),
    Field("patient_address", "patient.personal_information.contact_details.address"),
    Field("conditions", "patient.medical_history.conditions", "join"),
    Field("allergies", "patient.medical_history.allergies", "join"),
    Field("medications_name", "patient.medical_history.medications.name", "join"),
    Field("medications_dosage", "patient.medical_history.medications.dosage", "join"),
    Field("medications_frequency", "patient.medical_history.medications.frequency", "join"),
    Field("appointments_date", "patient.appointments.date", "last"),
    Field("appointments_doctor", "patient.appointments.doctor", "last"),
    Field("appointments_reason", "patient.appointments.reason", "last"),
)

# Fixed value: the nested type those paths walk through.
PATIENT_SCHEMA = """
patient STRUCT<
  personal_information: STRUCT<
    name: STRING, age: BIGINT, gender: STRING,
    contact_details: STRUCT<phone: STRING, address: STRING>>,
  medical_history: STRUCT<
    conditions: ARRAY<STRING>, allergies: ARRAY<STRING>,
    medications: ARRAY<STRUCT<name: STRING, dosage: STRING, frequency: STRING>>>,
  appointments: ARRAY<STRUCT<date: STRING, doctor: STRING, reason: STRING>>>
"""


def flatten(df: DataFrame, spec: tuple[Field, ...] = PATIENT_SPEC, text: bool = True, keep: tuple[str, ...] = (), many: str = "last") -> DataFrame:
    """One flat row per document, in the order of ``spec``.

    ``text=True`` is the form for CSV: every column is text and a missing value is ''. ``text=False``
    keeps types and nulls. ``many='explode'`` gives one row per element of the arrays behind ``last``
    fields instead of their last element; a document without elements keeps one row.
    """
    if many not in ("last", "explode"):
        raise ValueError(f"unknown choice {many!r} for repeated elements")
    arrays = sorted({f.path.rpartition(".")[0] for f in spec if f.rule == "last"})
    if many == "explode":
        if len(arrays) > 1:
            raise ValueError(f"cannot explode several arrays at once: {arrays}")
        require_absent(df, "__element")
        df = df.select("*", F.explode_outer(arrays[0]).alias("__element")) if arrays else df
    return df.select(*keep, *[_extract(df, f, text, many).alias(f.output) for f in spec])


def _extract(df: DataFrame, field: Field, text: bool, many: str) -> Column:
    if field.rule == "join":
        return F.concat_ws(LIST_SEPARATOR, F.col(field.path))
    if field.rule == "last":
        array, _, name = field.path.rpartition(".")
        c = F.col("__element")[name] if many == "explode" else F.try_element_at(F.col(array), F.lit(-1))[name]
    elif field.rule == "value":
        c = F.col(field.path)
    else:
        raise ValueError(f"unknown rule {field.rule!r}")
    return F.coalesce(c.cast("string"), F.lit("")) if text else c


def as_text(kind: T.DataType | str) -> T.DataType:
    """The same nested type with text in place of every plain value."""
    if isinstance(kind, str):
        kind = T._parse_datatype_string(kind)
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, as_text(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(as_text(kind.elementType))
    return T.StringType()


def decode_json(df: DataFrame, schema: T.StructType | str | None, value: str = "value", output: str = "document", valid: str = "valid") -> DataFrame:
    """Decode a JSON message, text or UTF-8 bytes, and tell whether it is a readable object.

    With a schema the result is a struct, without one a ``VARIANT``. Invalid rows keep their message
    and have a null document.
    """
    require_absent(df, output, valid, "__text", "__parsed", "__ok")
    binary = isinstance(df.schema[value].dataType, T.BinaryType)
    body = F.when(F.is_valid_utf8(F.col(value)), F.col(value).cast("string")) if binary else F.col(value)
    df = df.withColumn("__text", body)
    is_object = F.col("__text").rlike(r"^\s*\{")
    if schema is None:
        parsed = F.try_parse_json("__text")
        ok = is_object & F.col("__parsed").isNotNull()
        document = F.col("__parsed")
    else:
        kind = schema if isinstance(schema, T.StructType) else T._parse_datatype_string(schema)
        if "__corrupt" in kind.names:
            raise ValueError("the schema uses the reserved name __corrupt")
        whole = T.StructType([*kind.fields, T.StructField("__corrupt", T.StringType())])
        parsed = F.from_json("__text", whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__corrupt"})
        # Garbage gives a struct of nulls, not a null struct: only the corrupt field tells.
        ok = is_object & F.col("__parsed").isNotNull() & F.col("__parsed.__corrupt").isNull()
        document = F.col("__parsed").dropFields("__corrupt")
    return (
        df.withColumn("__parsed", parsed)
        .withColumn(valid, F.coalesce(ok, F.lit(False)))
        .withColumn(output, F.when(F.col(valid), document))
        .drop("__text", "__parsed")
    )


def valid_documents(decoded: DataFrame, output: str = "document", valid: str = "valid") -> DataFrame:
    """The decoded documents as columns, undecodable messages left out."""
    rows = decoded.where(F.col(valid))
    if isinstance(decoded.schema[output].dataType, T.StructType):
        return rows.select(f"{output}.*")
    return rows.select(output)


def quarantine(decoded: DataFrame, output: str = "document", valid: str = "valid") -> DataFrame:
    """The messages that could not be decoded, as they came."""
    return decoded.where(~F.col(valid)).drop(output, valid)
