"""Readers and writers: what is written and read back must be the table again."""

from __future__ import annotations

from pyspark.sql import functions as F

from medallion.plans.config import RelationalConfig
from medallion.plans.jobs import extract_relational_job
from medallion.session import scratch_dir
from medallion.sources.documents import read_documents
from medallion.sources.relational import read_sql
from medallion.sources.sinks import preview, write_csv, write_if_any, write_predictions, write_table
from medallion.sources.tables import from_pandas, load_data, read_csv, read_table
from workload import query, table


@query("SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal > 0")
def extract_sql(spark, sf_dir):
    """The relational extract: a query's result to CSV without a header, read back."""
    table(spark, sf_dir, "customer").createOrReplaceTempView("extract_customer")
    path = scratch_dir(spark, "extract")
    text = "SELECT c_custkey, c_name, c_acctbal FROM extract_customer WHERE c_acctbal > 0"
    extract_relational_job(spark, RelationalConfig(query=text, destination=path, header=False))
    return read_csv(spark, path, header=False, encoding="UTF-8", schema="c_custkey BIGINT, c_name STRING, c_acctbal DOUBLE")


@query("SELECT o_orderpriority, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def sql_text(spark, sf_dir):
    found = read_sql(
        spark,
        "SELECT o_orderpriority, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM {orders} GROUP BY 1",
        orders=table(spark, sf_dir, "orders"),
    )
    return found


@query("SELECT * FROM documents")
def csv_roundtrip(spark, sf_dir):
    """Whole texts, with accents and line breaks, through Latin-1 CSV with inferred types."""
    documents, path = table(spark, sf_dir, "documents"), scratch_dir(spark, "latin1")
    write_csv(documents, path, encoding="ISO-8859-1")
    back = read_csv(spark, path, multiline=True)
    return back.select(*[F.col(f.name).cast(f.dataType) for f in documents.schema.fields])


@query("SELECT * FROM supplier")
def csv_inferred(spark, sf_dir):
    """Generic read of delimited text in UTF-8, types inferred."""
    suppliers, path = table(spark, sf_dir, "supplier"), scratch_dir(spark, "delimited")
    write_csv(suppliers, path, sep="|")
    back = read_table(spark, path, "csv", delimiter="|")
    return back.select(*[F.col(f.name).cast(f.dataType) for f in suppliers.schema.fields])


@query("SELECT * FROM part")
def csv_headerless(spark, sf_dir):
    parts, path = table(spark, sf_dir, "part"), scratch_dir(spark, "headerless")
    write_csv(parts, path, header=False)
    return read_csv(spark, path, header=False, encoding="UTF-8", schema=parts.schema)


@query("SELECT * FROM customer UNION ALL SELECT * FROM customer")
def parquet_modes(spark, sf_dir):
    """Overwrite, append and ignore: the rows are there twice."""
    customers, path = table(spark, sf_dir, "customer"), scratch_dir(spark, "modes")
    for mode in ("overwrite", "append", "ignore"):
        write_if_any(customers, lambda df, mode=mode: write_table(df, path, mode=mode))
    return load_data(spark, path, "parquet")


@query("SELECT * FROM orders")
def orc_roundtrip(spark, sf_dir):
    orders, path = table(spark, sf_dir, "orders"), scratch_dir(spark, "orc")
    write_table(orders, path, "orc", partition_by=["o_orderstatus"])
    return read_table(spark, path, "orc").select(*orders.columns)


@query("""
SELECT p_partkey, p_name, p_size, CAST(NULL AS VARCHAR) AS p_brand, CAST(NULL AS DOUBLE) AS p_retailprice FROM part
UNION ALL SELECT p_partkey, NULL, NULL, p_brand, p_retailprice FROM part
""")
def schema_merge(spark, sf_dir):
    """A table that grows columns: earlier rows read them as null."""
    parts, path = table(spark, sf_dir, "part"), scratch_dir(spark, "merge")
    write_table(parts.select("p_partkey", "p_name", "p_size"), path, mode="append")
    write_table(parts.select("p_partkey", "p_brand", "p_retailprice"), path, mode="append")
    return read_table(spark, path, "parquet", mergeSchema="true").select("p_partkey", "p_name", "p_size", "p_brand", "p_retailprice")


#: Size of a split, small enough for several of them in the smallest table.
SPLIT_BYTES = 1 << 14


@query("""
SELECT c_custkey, concat('{"', c_name, '\\"},]', chr(10)) AS c_name, c_nationkey AS k, c_mktsegment AS tag, c_acctbal, true AS several FROM customer
""")
def split_arrays(spark, sf_dir):
    """One file with one array of all customers, their names full of braces and quotes, read by several tasks."""
    path = scratch_dir(spark, "array")
    name = F.concat(F.lit('{"'), "c_name", F.lit('\\"},]\n')).alias("c_name")
    nested = F.struct(F.col("c_nationkey").alias("k"), F.array(F.lit("a}"), "c_mktsegment").alias("tags")).alias("nested")
    records = table(spark, sf_dir, "customer").select(F.to_json(F.struct("c_custkey", name, nested, "c_acctbal")).alias("value")).coalesce(1)
    begun = F.when(F.monotonically_increasing_id() == 0, "[").otherwise(",")
    lines = records.select(F.concat(begun, "value").alias("value")).unionByName(spark.range(1).select(F.lit("]").alias("value")))
    lines.coalesce(1).write.text(path)
    schema = "c_custkey BIGINT, c_name STRING, nested STRUCT<k: INT, tags: ARRAY<STRING>>, c_acctbal DOUBLE"
    found = read_documents(spark, path, schema, array_file=True, piece_bytes=SPLIT_BYTES)
    several = len(found.inputFiles()) > 1
    return found.select("c_custkey", "c_name", "nested.k", F.col("nested.tags")[1].alias("tag"), "c_acctbal", F.lit(several).alias("several"))


@query("""
SELECT n_nationkey, n_name, round(n_nationkey * 1.5::DOUBLE, 4) AS predictions FROM nation ORDER BY n_nationkey LIMIT 7
""")
def predictions_preview(spark, sf_dir):
    """A pandas frame of the nations, scored, its predictions written under a stamp and the first rows looked at."""
    nations = from_pandas(spark, table(spark, sf_dir, "nation").select("n_nationkey", "n_name").toPandas())
    path = write_predictions(nations.withColumn("predictions", F.round(F.col("n_nationkey") * 1.5, 4)), scratch_dir(spark, "gold"), "2024-06-30")
    return preview(spark.read.parquet(path).orderBy("n_nationkey"), 7)
