"""Nested documents, built row by row from the texts, and JSON messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from medallion.operators.documents import decode_json, flatten, valid_documents
from medallion.plans.config import DocumentConfig
from medallion.plans.jobs import extract_documents_job
from medallion.session import scratch_dir
from medallion.sources.documents import encode_json
from medallion.sources.tables import read_csv
from workload import query, table


def nested(spark, sf_dir):
    """Every text as a patient-shaped document: its lines are the conditions, medications and appointments.

    Some parts are missing, empty or null, depending on the document.
    """
    lines = F.split("text", "\n")
    doc = F.col("doc_id")
    contact = F.struct(F.concat(F.lit("+"), doc).alias("phone"), F.concat_ws("/", "source", "lang").alias("address"))
    info = F.struct(
        F.col("source").alias("name"),
        F.when(doc % 7 != 0, F.col("n_chars")).alias("age"),
        F.col("lang").alias("gender"),
        F.when(doc % 5 != 0, contact).alias("contact_details"),
    )
    medication = lambda x: F.struct(
        F.substring_index(x, " ", 1).alias("name"), F.length(x).cast("string").alias("dosage"), F.col("lang").alias("frequency")
    )
    history = F.struct(
        lines.alias("conditions"),
        F.when(doc % 2 == 0, F.array().cast("array<string>")).otherwise(F.array("lang", "source")).alias("allergies"),
        F.transform(lines, medication).alias("medications"),
    )
    visits = F.transform(
        lines, lambda x, i: F.struct(i.cast("string").alias("date"), F.col("lang").alias("doctor"), x.alias("reason"))
    )
    appointments = F.when(doc % 13 == 0, F.slice(visits, 1, 0)).when(doc % 11 != 0, visits)
    patient = F.struct(info.alias("personal_information"), history.alias("medical_history"), appointments.alias("appointments"))
    return table(spark, sf_dir, "documents").select("doc_id", patient.alias("patient"))


FLAT_SQL = """
WITH d AS (
  SELECT *, string_split(text, chr(10)) AS lines,
         CASE WHEN doc_id % 13 = 0 THEN [] WHEN doc_id % 11 = 0 THEN NULL ELSE string_split(text, chr(10)) END AS visits
  FROM documents),
p AS (
  SELECT doc_id, visits, lang, source AS patient_name,
         CASE WHEN doc_id % 7 = 0 THEN '' ELSE CAST(n_chars AS VARCHAR) END AS patient_age, lang AS patient_gender,
         CASE WHEN doc_id % 5 = 0 THEN '' ELSE '+' || doc_id END AS patient_phone,
         CASE WHEN doc_id % 5 = 0 THEN '' ELSE source || '/' || lang END AS patient_address,
         array_to_string(lines, ', ') AS conditions,
         CASE WHEN doc_id % 2 = 0 THEN '' ELSE lang || ', ' || source END AS allergies,
         array_to_string([split_part(x, ' ', 1) FOR x IN lines], ', ') AS medications_name,
         array_to_string([CAST(length(x) AS VARCHAR) FOR x IN lines], ', ') AS medications_dosage,
         array_to_string([CASE WHEN x IS NULL THEN '' ELSE lang END FOR x IN lines], ', ') AS medications_frequency
  FROM d)
"""
FLAT_COLUMNS = (
    "patient_name, patient_age, patient_gender, patient_phone, patient_address, conditions, allergies, "
    "medications_name, medications_dosage, medications_frequency"
)
LAST_SQL = (
    f"""SELECT {FLAT_COLUMNS},
  CASE WHEN coalesce(len(visits), 0) = 0 THEN '' ELSE CAST(len(visits) - 1 AS VARCHAR) END AS appointments_date,
  CASE WHEN coalesce(len(visits), 0) = 0 THEN '' ELSE lang END AS appointments_doctor,
  CASE WHEN coalesce(len(visits), 0) = 0 THEN '' ELSE visits[-1] END AS appointments_reason
FROM p"""
)


@query(FLAT_SQL + LAST_SQL.replace("SELECT", "SELECT doc_id,", 1))
def flatten_documents(spark, sf_dir):
    return flatten(nested(spark, sf_dir), keep=("doc_id",))


@query(
    FLAT_SQL
    + """, v AS (
  SELECT doc_id, patient_name, patient_age, lang, unnest(CASE WHEN coalesce(len(visits), 0) = 0 THEN [NULL] ELSE visits END) AS reason,
         unnest(range(greatest(coalesce(len(visits), 0), 1))) AS i, coalesce(len(visits), 0) AS n FROM p)
SELECT doc_id, patient_name, patient_age, CASE WHEN n = 0 THEN '' ELSE CAST(i AS VARCHAR) END AS appointments_date,
       CASE WHEN n = 0 THEN '' ELSE lang END AS appointments_doctor, coalesce(reason, '') AS appointments_reason
FROM v"""
)
def explode_documents(spark, sf_dir):
    rows = flatten(nested(spark, sf_dir), keep=("doc_id",), many="explode")
    return rows.select("doc_id", "patient_name", "patient_age", "appointments_date", "appointments_doctor", "appointments_reason")


@query(FLAT_SQL + LAST_SQL)
def extract_documents(spark, sf_dir):
    """The document extract job: nested JSON files to flat CSV, read back."""
    source, flat = scratch_dir(spark, "documents"), scratch_dir(spark, "flat")
    nested(spark, sf_dir).select("patient").write.json(source)
    extract_documents_job(spark, DocumentConfig(source=source, destination=flat))
    rows = read_csv(spark, flat, encoding="UTF-8", multiline=True, infer_schema=False)
    return rows.na.fill("")


@query("""
SELECT 'document' AS kind, doc_id FROM documents WHERE doc_id % 9 <> 0
UNION ALL SELECT 'reject', doc_id FROM documents WHERE doc_id % 9 = 0
""")
def extract_rejects(spark, sf_dir):
    """The document extract job on lines of which every ninth is cut short: documents by their phone, rejects as they came."""
    source, flat, bad = (scratch_dir(spark, n) for n in ("documents", "flat", "bad"))
    doc = F.col("doc_id")
    text = F.concat(F.lit('{"patient":{"personal_information":{"contact_details":{"phone":"+'), doc, F.lit('"}}}}'))
    table(spark, sf_dir, "documents").select(F.when(doc % 9 == 0, F.substring(text, 1, F.char_length(text) - 3)).otherwise(text).alias("value")).write.text(source)
    extract_documents_job(spark, DocumentConfig(source=source, destination=flat, rejects=bad))
    good = read_csv(spark, flat, encoding="UTF-8", multiline=True, infer_schema=False).select(F.lit("document").alias("kind"), F.col("patient_phone").alias("t"))
    kept = good.unionByName(spark.read.text(bad).select(F.lit("reject").alias("kind"), F.col("value").alias("t")))
    return kept.select("kind", F.regexp_extract("t", r"\+(\d+)", 1).cast("bigint").alias("doc_id"))


@query("""
SELECT event_id, event_id % 50 <> 0 AS valid,
       CASE WHEN event_id % 50 <> 0 THEN CAST(regexp_extract(props, '"k": (-?[0-9]+)', 1) AS INTEGER) END AS k
FROM events
""")
def json_decode(spark, sf_dir):
    """Event properties from bytes; every fiftieth message is cut short and so not readable."""
    events = table(spark, sf_dir, "events")
    cut = F.expr("substring(props, 1, length(props) - 1)")
    body = F.when(F.col("event_id") % 50 == 0, cut).otherwise(F.col("props"))
    decoded = decode_json(events.select("event_id", body.cast("binary").alias("value")), "k INT")
    return decoded.select("event_id", "valid", "document.k")


@query("SELECT * FROM customer")
def json_encode(spark, sf_dir):
    """Rows to JSON messages and back."""
    customers = table(spark, sf_dir, "customer")
    return valid_documents(decode_json(encode_json(customers), customers.schema))
