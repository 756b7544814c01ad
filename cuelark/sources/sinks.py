"""Writers of subtitles, transcripts, store tables and run summaries, partitioned by recording."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.words import is_filler
from .tables import kept
from ..operators import segments as S
from ..operators import store

FORMATS = ("srt", "vtt", "txt", "db")


def _lines(rows: DataFrame, order: str, text: str, path: str) -> None:
    # a recording's lines in one file, in order; large corpora spread over recordings
    rows = rows.select("recording_id", F.col(order).alias("_order"), F.col(text).alias("value"))
    rows.repartition("recording_id").sortWithinPartitions("recording_id", "_order").drop("_order").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("recording_id").text(path)


def write_srt(segments: DataFrame, path: str) -> None:
    _lines(S.srt_cues(segments), "segment", "cue", path)


def write_vtt(segments: DataFrame, path: str) -> None:
    """The header is the row before a recording's first cue."""
    cues = S.vtt_cues(segments).select("recording_id", "segment", "cue")
    heads = cues.select("recording_id").distinct().select("recording_id", F.lit(0).alias("segment"), F.lit("WEBVTT\n").alias("cue"))
    _lines(heads.unionByName(cues), "segment", "cue", path)


def write_txt(segments: DataFrame, path: str) -> None:
    _lines(segments, "segment", "text", path)


def write_store(words: DataFrame, path: str) -> None:
    """words, chunks and chunk_words; a recording that is written again replaces itself."""
    w = store.words_table(words).withColumn("created_at", F.current_timestamp())
    c = store.chunks_table(words)
    links = store.chunk_words(w, c)
    for name, table in (("words", store.backfilled(w, links)), ("chunks", c), ("chunk_words", links)):
        table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("recording_id").parquet(f"{path}/{name}")


def write_summary(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("overwrite").json(path)


def write_all(words: DataFrame, path: str, formats: list[str], no_fillers: bool = False, strict: bool = False) -> list[str]:
    """The chosen formats; fillers leave the texts but never the store. Unknown formats are skipped, or an error if strict."""
    unknown = [f for f in formats if f not in FORMATS]
    if unknown and strict:
        raise ValueError(f"unknown formats: {unknown}")
    spoken = S.renumbered(words.where(~is_filler(F.col("word")))) if no_fillers else words
    segments = None
    if {"srt", "vtt", "txt"} & set(formats):
        segments = kept(S.build_segments(spoken), "segments")  # all formats are written from these
    for name, write in (("srt", write_srt), ("vtt", write_vtt), ("txt", write_txt)):
        if name in formats:
            write(segments, f"{path}/{name}")
    if "db" in formats:
        write_store(words, f"{path}/db")
    return [f for f in formats if f in FORMATS]
