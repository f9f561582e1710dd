"""Numbers for categories, kept as a table instead of in a stage on the driver."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from medallion.functions.columns import quoted, require_absent, resolve
from medallion.session import remove, scratch_dir

#: A table, or the frequent part of one, that goes to every task: rows and bytes of text at most.
BROADCAST_ROWS = 1 << 16
BROADCAST_BYTES = 8 << 20
#: The most frequent categories, that are looked up apart where the table is larger.
FREQUENT_ROWS = 1 << 12
SCHEMA = "column int, value string, index long, n long"


def category_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(column, value, n)``: how often each category occurs; null is none."""
    values = F.array(*[F.struct(F.lit(i).alias("column"), quoted(resolve(df, c)).cast("string").alias("value")) for i, c in enumerate(columns)])
    found = df.select(F.explode(values).alias("e")).where("e.value IS NOT NULL")
    return found.groupBy(F.col("e.column").alias("column"), F.col("e.value").alias("value")).agg(F.count("*").alias("n"))


def number_categories(counts: DataFrame, path: str) -> None:
    """Write ``(column, value, index, n)``: per column numbered from 0, the most frequent first, equals by their text.

    Ranges of that order are numbered by themselves, on top of the sizes of the ranges before.
    """
    spark = counts.sparkSession
    order = ["column", F.col("n").desc(), "value"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    scratch = scratch_dir(spark, "ranged")
    counts.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()).write.parquet(scratch)
    ranged = spark.read.parquet(scratch)
    # One row per range and column.
    before = Window.partitionBy("column").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = ranged.groupBy("column", "part").agg(F.count("*").alias("size")).withColumn("base", F.coalesce(F.sum("size").over(before), F.lit(0)))
    here = F.row_number().over(Window.partitionBy("column", "part").orderBy(F.col("n").desc(), "value")) - 1
    placed = ranged.withColumn("here", here).join(F.broadcast(bases.drop("size")), ["column", "part"])
    placed.select("column", "value", (F.col("base") + F.col("here")).alias("index"), "n").write.parquet(path)
    remove(spark, scratch)


class CategoryIndexer(Estimator, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Number the categories of text columns, the most frequent first; unseen and null values get the next number after the last.

    The numbers are a table in shared storage. Applying them is a join: of the whole table by broadcast where its measured size
    allows, else of the most frequent categories by broadcast and of the others by their value, so that neither the driver nor
    one task ever holds all categories, and a category with a third of the rows is never shuffled.
    """

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset):
        columns = self.getInputCols()
        path = scratch_dir(dataset.sparkSession, "categories")
        number_categories(category_counts(dataset, columns), path)
        return self._copyValues(_model(dataset.sparkSession, path, len(columns)))


class CategoryIndexerModel(Model, HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    path = Param(Params._dummy(), "path", "folder of the table of categories", TypeConverters.toString)
    sizes = Param(Params._dummy(), "sizes", "categories of each column", TypeConverters.toListInt)
    known = Param(Params._dummy(), "known", "categories of each column that are looked up by broadcast", TypeConverters.toListInt)

    @keyword_only
    def __init__(self, *, path=None, sizes=None, known=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def categories(self, spark: SparkSession) -> DataFrame:
        """``(column, value, index, n)``, columns by their place among the inputs."""
        return spark.read.schema(SCHEMA).parquet(self.getOrDefault(self.path))

    def _transform(self, dataset):
        table = self.categories(dataset.sparkSession)
        sizes, known = self.getOrDefault(self.sizes), self.getOrDefault(self.known)
        for i, (column, output) in enumerate(zip(self.getInputCols(), self.getOutputCols())):
            dataset = _looked_up(dataset, column, output, table.where(F.col("column") == i).select("value", "index"), sizes[i], known[i])
        return dataset

    def write(self):
        return _TableWriter(self)

    @classmethod
    def read(cls):
        return _TableReader(cls)


def _looked_up(df: DataFrame, column: str, output: str, table: DataFrame, size: int, known: int) -> DataFrame:
    require_absent(df, output, "__text", "__value", "__known", "__rare", "__salt", "__zero")
    names = [quoted(c) for c in df.columns]
    near = table.where(F.col("index") < known).select(F.col("value").alias("__value"), F.col("index").alias("__known"))
    found = df.withColumn("__text", quoted(resolve(df, column)).cast("string"))
    found = found.join(F.broadcast(near), F.col("__text") == F.col("__value"), "left").drop("__value")
    number = F.col("__known")
    if known < size:
        # Rows already found bring no value to the second join; a random second key spreads them.
        rare = F.col("__known").isNull() & F.col("__text").isNotNull()
        salt = F.when(rare, 0).otherwise(F.floor(F.rand(7) * 4096) + 1).cast("int")
        found = found.withColumns({"__salt": salt, "__text": F.when(rare, F.col("__text"))})
        far = table.where(F.col("index") >= known).select(F.col("value").alias("__value"), F.col("index").alias("__rare"), F.lit(0).alias("__zero"))
        found = found.join(far, (F.col("__text") == F.col("__value")) & (F.col("__salt") == F.col("__zero")), "left")
        number = F.coalesce("__known", "__rare")
    attribute = {"ml_attr": {"type": "nominal", "num_vals": size + 1, "name": output}}
    return found.select(*names, F.coalesce(number, F.lit(size)).cast("double").alias(output, metadata=attribute))


def _model(spark: SparkSession, path: str, width: int) -> CategoryIndexerModel:
    """Measure a table of categories."""
    table = spark.read.schema(SCHEMA).parquet(path)
    frequent = F.col("index") < FREQUENT_ROWS
    size = F.octet_length("value")
    found = table.groupBy("column").agg(F.count("*").alias("rows"), F.sum(size).alias("bytes"), F.sum(F.when(frequent, size)).alias("frequent")).collect()
    rows = {r["column"]: r for r in found}
    sizes = [rows[i].rows if i in rows else 0 for i in range(width)]
    known = []
    for i, n in enumerate(sizes):
        if n <= BROADCAST_ROWS and (not n or rows[i].bytes <= BROADCAST_BYTES):
            known.append(n)
        else:
            known.append(min(n, FREQUENT_ROWS) if rows[i].frequent <= BROADCAST_BYTES else 0)
    return CategoryIndexerModel(path=path, sizes=sizes, known=known)


class _TableWriter(DefaultParamsWriter):
    """The parameters, and beside them the table."""

    def saveImpl(self, path):
        super().saveImpl(path)
        self.instance.categories(SparkSession.active()).write.parquet(f"{path}/categories")


class _TableReader(DefaultParamsReader):
    def load(self, path):
        model = super().load(path)
        return model._set(path=f"{path}/categories")
