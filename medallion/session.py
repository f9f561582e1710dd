"""Session defaults and the shared scratch location."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "medallion", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC, ANSI and AQE on. Extra settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the cluster's shared folder (``spark.checkpoint.dir``).

    Executors write there and other executors read it back; see ``local_scratch`` for trials on one machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def local_scratch(spark: SparkSession) -> None:
    """Give a session that runs on this machine alone, and has no shared folder, one that is removed when Python ends.

    Its Python workers also get the place of this package, where the driver found it.
    """
    if spark.sparkContext.master.split("[")[0] == "local":
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        env = spark.sparkContext.environment
        if root not in env.get("PYTHONPATH", "").split(os.pathsep):
            env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)
    if spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        return
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="medallion-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(f"file://{root}")


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """The rows as a columnar table in the scratch folder, removed at the end.

    For inputs that are read several times but are costly to read, such as text files.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever Spark can write."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
