"""Paths on whatever file system the cluster uses."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

# How Parquet files of the layers are compressed: a third smaller than with Spark's own default.
CODEC = "zstd"


def hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def sized(spark: SparkSession, base: str, pattern: str) -> list[tuple[list[str], int]]:
    """Paths below ``base`` that match a glob of one or more levels, each as
    its names below ``base``, with their bytes; empty if there are none."""
    literal = re.sub(r"([\\*?\[\]{}])", r"\\\1", base.rstrip("/"))
    target = hadoop_path(spark, f"{literal}/{pattern}")
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    depth = pattern.count("/") + 1
    found = fs.globStatus(target) or []
    return sorted((str(status.getPath().toString()).split("/")[-depth:], status.getLen()) for status in found)


def matching(spark: SparkSession, base: str, pattern: str) -> list[list[str]]:
    """As ``sized``, without the bytes."""
    return [names for names, _ in sized(spark, base, pattern)]


def remove(spark: SparkSession, path: str) -> None:
    target = hadoop_path(spark, path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def compressed(df: DataFrame) -> DataFrameWriter:
    """A writer of files that are kept."""
    return df.write.option("compression", CODEC)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new directory below the shared folder of the session.

    The cluster names that folder in ``spark.checkpoint.dir``; where it is
    unset, the warehouse directory serves, which executors share as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
