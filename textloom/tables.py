"""Reading the input tables and staging intermediate ones."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Bytes of a batch of rows on its way to Python; documents are large rows, and the usual 10,000 of them would fill a task's memory.
BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, once for each application, and bound their batches if the session doesn't."""
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, BATCH_BYTES)
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent
        to = Path(tempfile.mkdtemp()) / package.name
        context.addPyFile(shutil.make_archive(str(to), "zip", package.parent, package.name))
        _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table ``name`` under ``sf_dir``; only Spark's reader touches the path."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of this application's staged tables, below ``spark.checkpoint.dir``, which driver and executors share.

    Only where all tasks run on this machine may it be unset; then it is set to a new local folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='textloom-')}"
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/textloom/{spark.sparkContext.applicationId}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage at a point that outlives any executor, and the
    written row groups are what later jobs read instead of recomputing.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, rows: int, *keys: str, each: int = 1_000_000) -> DataFrame:
    """``df`` of about ``rows`` rows by its keys, in so many partitions that a task's part doesn't grow with the table."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, -(-rows // each)), *keys)


def clear_stage(spark: SparkSession) -> None:
    """Delete what this application has staged; results that haven't been written yet can't be read afterwards."""
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
