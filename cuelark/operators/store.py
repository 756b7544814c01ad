"""The words / chunks / chunk_words tables of recordings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.words import is_filler
from .segments import build_segments

SLACK = 0.01
SPAN = 16.0  # seconds of a slice in which chunks meet words


def words_table(words: DataFrame) -> DataFrame:
    """Fillers stay, flagged. word_id is the place in the recording, from 1."""
    return words.select(
        "recording_id", (F.col("i") + 1).cast("long").alias("word_id"), "word", "start_time", "end_time", (F.col("end_time") - F.col("start_time")).alias("duration"),
        is_filler(F.col("word")).alias("is_filler"), F.lit(False).alias("is_removed"), F.lit(None).cast("double").alias("confidence"),
    )


def chunks_table(words: DataFrame, compat: bool = False) -> DataFrame:
    """One chunk per segment; word_count is the number of words in its text, or 0 with compat."""
    count = F.lit(0) if compat else F.size(F.filter(F.split("text", r"\s+"), lambda w: w != ""))
    return build_segments(words).select(
        "recording_id", F.col("segment").cast("long").alias("chunk_id"), "start_time", "end_time", (F.col("end_time") - F.col("start_time")).alias("duration"),
        "text", count.alias("word_count"), F.lit("auto").alias("source_type"), F.lit(None).cast("string").alias("metadata"),
    )


def chunk_words(words: DataFrame, chunks: DataFrame) -> DataFrame:
    """(recording_id, chunk_id, word_id, position): words that lie in a chunk, with SLACK seconds on both sides.

    The join's key is the recording and a slice of SPAN seconds, so that a long recording is many keys.
    """
    low, high = F.col("start_time") - SLACK, F.col("end_time") + SLACK
    slices = F.sequence(F.floor(low / SPAN), F.floor(high / SPAN))
    c = chunks.where(low <= high).select("recording_id", "chunk_id", low.alias("low"), high.alias("high"), F.explode(slices).alias("slice"))
    w = words.select("recording_id", "word_id", "start_time", "end_time", F.floor(F.col("start_time") / SPAN).alias("slice"))
    pairs = w.join(c, ["recording_id", "slice"]).where((F.col("start_time") >= F.col("low")) & (F.col("end_time") <= F.col("high")))
    order = Window.partitionBy("recording_id", "chunk_id").orderBy("start_time", "word_id")
    pairs = pairs.dropDuplicates(["recording_id", "chunk_id", "word_id"])
    return pairs.select("recording_id", "chunk_id", "word_id", (F.row_number().over(order) - 1).alias("position"))


def backfilled(words: DataFrame, links: DataFrame) -> DataFrame:
    """words with chunk_id: the last chunk that took the word, null where none did."""
    last = links.groupBy("recording_id", "word_id").agg(F.max("chunk_id").alias("chunk_id"))
    return words.join(last, ["recording_id", "word_id"], "left")
