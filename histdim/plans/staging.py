"""Materialise an intermediate once in the shared checkpoint folder.

A DataFrame read more than once (the change staging) is written once to the
folder the cluster names in ``spark.checkpoint.dir``: the lineage is cut and
the copy survives the loss of an executor, unlike a machine-local cache. Spark
deletes the files once nothing refers to them any more where
``spark.cleaner.referenceTracking.cleanCheckpoints`` is on (``session``).

What is as long as a table is staged by ``staged`` instead, for as long as it
is needed: a checkpoint holds whole rows, uncompressed, several times the bytes
that their columns take in Parquet.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir


def stage(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def tidy(spark: SparkSession) -> None:
    """Collect the driver's garbage: Spark's cleaner removes the shuffles of a
    finished job only once the driver's references to them are collected."""
    spark.sparkContext._jvm.System.gc()


def delete(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def staged(df: DataFrame, *partition_by: str) -> Iterator[DataFrame]:
    """``df`` written once to the same folder, as compressed columns, and
    deleted when the block ends. The shuffles of ``df`` go after the write."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/staged-{uuid.uuid4().hex}"
    try:
        df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
        tidy(spark)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete(spark, path)
