"""Exact dedup by deterministic block naming (Karp-Miller-Rosenberg), in DataFrame operations only.

Each normalised text is cut into blocks of fixed size. Equal blocks get the same integer name: the smallest
position (row number, block number) at which the block occurs. Adjacent pairs of names are named in the same
way, level by level, until one name is left. Texts are equal exactly when they end at the same level
with the same name, as names stand for contents and not for hashes.

Skew: names come from an aggregation with map-side combining and return through a sort-merge join, whose hot
keys adaptive execution splits. No list of a group's members is ever made.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, documents, keyed, written

BLOCK_BYTES = 1024
POSITIONS = 2**31
#: Stands for the second of a pair that has none; positions, from 64-bit row numbers, are over -2**94.
NO_NAME = Decimal(-(2**100))


def _position(uid: Column, i: Column) -> Column:
    return (uid.cast("decimal(19,0)") * F.lit(POSITIONS).cast("decimal(10,0)") + i.cast("decimal(10,0)")).cast("decimal(38,0)")


def _named(rows: DataFrame, *content: str) -> DataFrame:
    """rows (uid, i, n, content...) as (uid, i, n, name)."""
    names = rows.groupBy(*content).agg(F.min(_position(F.col("uid"), F.col("i"))).alias("name"))
    return rows.join(names, [*content]).select("uid", "i", "n", "name")


def identities(texts: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(uid, text) to (uid, level, name); two rows share level and name exactly when their texts are equal.

    A null text counts as empty; an empty text is one empty block.
    """
    raw = texts.select("uid", F.coalesce("text", F.lit("")).cast("binary").alias("raw"))
    n = F.greatest(F.lit(1), F.ceil(F.octet_length("raw") / block_bytes)).cast("int")
    blocks = raw.select("uid", "raw", n.alias("n")).select("uid", "n", "raw", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i"))
    blocks = blocks.select("uid", "i", "n", F.expr(f"substring(raw, i * {block_bytes} + 1, {block_bytes})").alias("block"))
    level, done, k = written(_named(blocks, "block"), "blocks"), [], 0
    while True:
        done.append(level.where("n = 1").select("uid", F.lit(k).alias("level"), "name"))
        longer = level.where("n > 1")
        if longer.isEmpty():
            return reduce(DataFrame.unionByName, done)
        pairs = longer.groupBy("uid", F.expr("i div 2").cast("int").alias("i")).agg(
            F.max(F.when(F.col("i") % 2 == 0, F.col("name"))).alias("a"),
            F.coalesce(F.max(F.when(F.col("i") % 2 == 1, F.col("name"))), F.lit(NO_NAME)).alias("b"),
            F.expr("cast((max(n) + 1) div 2 as int)").alias("n"),
        )
        level, k = written(_named(pairs, "a", "b"), "pairs"), k + 1


def _groups(rows: DataFrame, block_bytes: int) -> DataFrame:
    """(doc_id, uid, text) to one row each: doc_id, uid, keep_id, group_size, kept, text_sha256, n_bytes."""
    base = rows.select("doc_id", "uid", F.coalesce(ascii_lower(F.col("text")), F.lit("")).alias("text"))
    facts = base.select("doc_id", "uid", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"), F.octet_length("text").cast("long").alias("n_bytes"))
    members = written(facts.join(identities(base, block_bytes), "uid"), "members")
    groups = members.groupBy("level", "name").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "uid"))["uid"].alias("keep_uid")
    )
    # a written side leaves the join's hot keys free to be split
    return members.join(written(groups, "groups"), ["level", "name"]).select(
        "doc_id", "uid", "keep_id", "group_size", (F.col("uid") == F.col("keep_uid")).alias("kept"), "text_sha256", "n_bytes"
    )


def exact_groups(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, n_bytes.

    Texts are equal when identical after lower-casing A-Z. Of equal texts the row with the largest doc_id
    stays; if that doc_id occurs more than once in the group, one of these rows does. Null texts count as
    empty and so form one group with empty ones. Rows with a null doc_id are kept only where a group has no
    other. Other columns are ignored; an empty table gives an empty result.
    """
    return _groups(keyed(docs, "text"), block_bytes).drop("uid")


def without_copies(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs without the rows that exact_groups drops; columns unchanged."""
    rows = keyed(docs, *[c for c in docs.columns if c != "doc_id"])
    kept = _groups(rows.select("doc_id", "uid", "text"), block_bytes).where("kept").select("uid")
    return rows.join(kept, "uid", "left_semi").select(*docs.columns)


def op8_exact_dedup(spark, sf_dir):
    return exact_groups(documents(spark, sf_dir))


SQL = """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept,
       sha256(x) AS text_sha256, CAST(strlen(x) AS BIGINT) AS n_bytes
FROM t WINDOW w AS (PARTITION BY x)
"""
