"""Artefacts that are rewritten as their sessions grow, from committed words that are kept by bucket.

A session's words lie in one of `buckets` folders. A micro-batch reads and rewrites only the buckets that its sessions lie in:
the newest version from before its epoch, with the new words, becomes the epoch's own version, so that an epoch that runs again
starts from the same words and replaces itself. Each bucket keeps two versions.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import delete, folders
from .transcripts import routed

BUCKETS = 256


def rolling_rewrite(path: str, render: Callable[[DataFrame], DataFrame], buckets: int = BUCKETS, read: list | None = None):
    """For foreachBatch over rows of the accumulator: keeps the committed words under path/words, and rewrites the artefacts
    (render's rows, by session_id) of the touched sessions under path/artefacts. `read` gets the folders that each batch reads."""

    def run(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        new = routed(batch)["committed"].withColumn("bucket", F.pmod(F.xxhash64("session_id"), F.lit(buckets)).cast("int")).persist()
        try:
            touched = sorted(r["bucket"] for r in new.select("bucket").distinct().collect())  # `buckets` numbers at most
            if not touched:
                return
            versions = {b: _versions(spark, path, b) for b in touched}
            before = [f"{path}/words/bucket={b}/version={max(old)}" for b, v in versions.items() if (old := [x for x in v if x < epoch])]
            if read is not None:
                read.append(before)
            words = new.drop("bucket")
            if before:
                words = spark.read.schema(words.schema).parquet(*before).unionByName(words)
            words = words.withColumn("bucket", F.pmod(F.xxhash64("session_id"), F.lit(buckets)).cast("int"))
            for b in touched:  # an epoch that runs again replaces its own version
                delete(spark, f"{path}/words/bucket={b}/version={epoch}")
            words.withColumn("version", F.lit(epoch)).repartition(len(touched), "bucket").write.mode("append").partitionBy("bucket", "version").parquet(f"{path}/words")
            now = spark.read.schema(new.drop("bucket").schema).parquet(*[f"{path}/words/bucket={b}/version={epoch}" for b in touched])
            sessions = new.select("session_id").distinct()
            out = render(now.join(sessions, "session_id", "left_semi"))
            out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("session_id").parquet(f"{path}/artefacts")
            for b, v in versions.items():
                for old in sorted(x for x in v if x < epoch)[:-1]:
                    delete(spark, f"{path}/words/bucket={b}/version={old}")
        finally:
            new.unpersist()

    return run


def _versions(spark, path: str, bucket: int) -> list[int]:
    return [int(m[1]) for f in folders(spark, f"{path}/words/bucket={bucket}/version=*") if (m := re.search(r"version=(\d+)$", f))]
