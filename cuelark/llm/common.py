"""What the corpus operators share: reading, word rules, row keys and written intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import lru_cache

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Runs of anything but the six ASCII space characters. bytes.split() splits at the same six.
WORD = r"[^\x20\x09-\x0D]+"


#: Spark's own limit for Arrow batches is 64 MB, of which a task holds several forms at once.
BATCH_BYTES, BATCH_KEY, SPARKS_OWN = 2**22, "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def bounded(spark: SparkSession) -> None:
    """Limits Arrow batches to BATCH_BYTES in this session, where the limit is still Spark's own."""
    if spark.conf.get(BATCH_KEY, SPARKS_OWN) == SPARKS_OWN:
        spark.conf.set(BATCH_KEY, str(BATCH_BYTES))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Texts that are all ASCII take the faster built-in."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def small(batches, rows: int = 256, size: int = 2**20, column: str = "text"):
    """Arrow batches cut into pieces of at most `rows` rows that end once the column has `size` bytes, so that
    what a task holds follows `size` or the longest row, and not the batch."""
    for batch in batches:
        lens = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, start = np.cumsum(lens), 0
        while start < len(lens):
            full = int(np.searchsorted(ends, (ends[start - 1] if start else 0) + size)) + 1
            stop = min(start + rows, full, len(lens))
            yield batch.slice(start, stop - start)
            start = stop


@lru_cache(maxsize=1)
def _own_folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="spark-")


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where none is set, a temporary one in local mode only, which has one machine."""
    folder = spark.conf.get("spark.checkpoint.dir", "")
    if not folder and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return (folder or _own_folder()).rstrip("/")


#: Shuffle files of a statement go when it ends, and not when the driver happens to collect its garbage.
CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Paths of the intermediate tables that are still there.
_left: set[str] = set()


def written(df: DataFrame, name: str, by: str | None = None, drop: tuple[DataFrame, ...] = ()) -> DataFrame:
    """df as a table in the shared folder: it cuts the lineage and outlives executors. Tables in `drop`, which no
    later step reads, are deleted behind it."""
    spark = df.sparkSession
    bounded(spark)
    path = f"{shared_folder(spark)}/tables/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANED)
    spark.conf.set(CLEANED, "true")
    try:
        df.write.option("compression", "zstd").parquet(path, partitionBy=by)
    finally:
        spark.conf.set(CLEANED, before)
    _left.add(path)
    dropped(*drop)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Deletes tables that written() returned; others are left alone."""
    for table in tables:
        if path := getattr(table, "__dict__", {}).get("written_to"):
            _deleted(table.sparkSession, path)


def _deleted(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    _left.discard(path)


def intermediates() -> set[str]:
    """Paths of the intermediate tables that are still there: those that a lazy result reads."""
    return set(_left)


def released(spark: SparkSession, paths: set[str]) -> None:
    """Deletes intermediate tables once the results that read them have been used."""
    for path in paths & _left:
        _deleted(spark, path)


def keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """doc_id, the columns, and `uid`, a number no other row has.

    uid is doc_id itself where doc_ids are integers, unique and none is null. Otherwise (strings too) the rows are
    numbered in the order of doc_id and written, so that every later read sees the same numbers.
    """
    bounded(docs.sparkSession)
    rows = docs.select("doc_id", *columns)
    if not isinstance(docs.schema["doc_id"].dataType, IntegralType):
        return written(rows.orderBy("doc_id").withColumn("uid", F.monotonically_increasing_id()), "keyed")
    ids = docs.agg(F.count(F.lit(1)).alias("n"), F.count("doc_id").alias("known"))
    repeated = docs.groupBy("doc_id").count().where("count > 1").limit(1)
    n = ids.first()
    if n["n"] == n["known"] and repeated.isEmpty():
        return rows.withColumn("uid", F.col("doc_id"))
    return written(rows.orderBy("doc_id").withColumn("uid", F.monotonically_increasing_id()), "keyed")
