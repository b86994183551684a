"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..sources.shared import shared_dir

BATCH = 8 << 20


def materialize(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back, which cuts its lineage."""
    spark = df.sparkSession
    lean(spark)
    path = f"{shared_dir(spark)}/siltstone-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._siltstone_path = path
    return out


def discard(df: DataFrame) -> None:
    """Remove a table of ``materialize`` that no later plan reads."""
    path = getattr(df, "_siltstone_path", None)
    if path:
        spark = df.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def tidy(spark: SparkSession) -> None:
    """Let go of shuffle files that no live plan refers to; Spark's cleaner acts when its driver collects garbage."""
    gc.collect()
    spark._jvm.System.gc()


def lean(spark: SparkSession) -> None:
    """Send Arrow batches of at most ``BATCH`` bytes to Python workers, which bounds what a task holds outside the heap."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name)) > BATCH:
        spark.conf.set(name, str(BATCH))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    lean(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
