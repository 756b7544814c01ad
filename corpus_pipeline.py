"""The corpus pipeline: rules, exact and near dedup, mixing, encoding. Each stage works on all that its predecessor kept.

Every stage takes (spark, docs, sf_dir); docs has the columns of documents, and may have others, which the first four stages keep. Any
column may be null, rows may repeat, and an empty table stays empty in each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cuelark.llm import common, exact_dedup, mixing, near_dedup, pieces, quality_rules


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go: those of under 50 words, null and empty texts among them, those that repeat
    themselves, and those below the score's threshold; one at the threshold stays. Repeated rows are judged alike."""
    return quality_rules.good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, A-Z lower-cased, the row with the largest doc_id stays; null counts as empty. Of rows that
    are equal in text and doc_id one stays."""
    return exact_dedup.without_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (shingles of five words, similarity 0.8) the row with the smallest doc_id stays, a null one last.
    Texts without words are no copies of anything and stay."""
    return near_dedup.without_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them, up to three times; documents without words are never taken. A null source is one of its
    own. Reruns take the same rows."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every row: doc_id, source, n_pieces, ids. A null or empty text has none; rows that repeat are encoded alike."""
    return pieces.encoded(docs, keep=("doc_id", "source"))


STAGES = [
    ("quality rules", quality),
    ("exact dedup", exact),
    ("near dedup", near),
    ("source mixing", mix),
    ("sentencepiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL cannot express the quality scores and the encoding; tests compare with brute force instead.
ORACLE_SQL = None
