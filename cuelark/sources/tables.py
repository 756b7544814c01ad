"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

#: Paths of the intermediate tables that are still there.
_left: set[str] = set()


@lru_cache(maxsize=1)
def _own_folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="spark-")


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where none is set, a temporary one in local mode only, which has one machine."""
    folder = spark.conf.get("spark.checkpoint.dir", "")
    if not folder and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return (folder or _own_folder()).rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """The path of a new intermediate table."""
    path = f"{shared_folder(spark)}/work/{name}-{uuid.uuid4().hex}"
    _left.add(path)
    return path


def kept(df: DataFrame, name: str) -> DataFrame:
    """df as a written table: it cuts the lineage, outlives executors, and is the same at every read."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    _left.discard(path)


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern of Hadoop's file systems."""
    at = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    return [x.getPath().toString() for x in found or []]


def release(spark: SparkSession) -> None:
    """Deletes the intermediate tables, once no lazy result reads it any more."""
    for path in list(_left):
        delete(spark, path)
