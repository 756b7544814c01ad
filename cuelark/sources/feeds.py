"""Readers of recordings, recogniser results, session events and transcript stores."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORDS = "array<struct<word:string,start:double,end:double>>"
FULL_RESULT = f"recording_id string, words {WORDS}, total_duration double, chunk_count int, word_count int"
CHUNK_RESULT = f"session_id string, chunk_index int, chunk_start double, chunk_duration double, words {WORDS}, partial boolean, processing_ms int"
EVENT = f"type string, session_id string, sequence long, pts double, duration double, sample_rate int, channels int, format string, source string, pcm16_base64 string, up_to_time double, words {WORDS}, text string, word_count int, code string, message string, processing_ms int"
EVENT_TYPES = ["start", "audio", "flush", "stop", "started", "partial", "final_words", "stopped", "error"]
CHUNKS = 32
RUN_SUMMARY = "session_id string, chunks_processed int, committed_words int, effective_audio_seconds double, elapsed_seconds double, audio_seconds_per_wall_second double, average_server_processing_ms double, max_server_processing_ms int, average_end_to_end_ms double, max_end_to_end_ms int"


def recordings(spark: SparkSession, path: str) -> DataFrame:
    """(recording_id, size) of files; their content is not read."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("recording_id"), F.col("length").alias("size"))


def payloads(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("recording_id"), "content")


def format_facts(files: DataFrame) -> DataFrame:
    """(recording_id, content) to the facts in each WAV header; ok is false for what is no WAV or has a fact of 0.

    The format chunk is looked for behind up to CHUNKS other chunks, each of which names its own size."""
    number = lambda at, n: " + ".join(f"cast(conv(hex(substring(content, {at} + {i}, 1)), 16, 10) as bigint) * {256**i}" for i in range(n))
    size = number("(at + 5)", 4)
    step = f"if(substring(content, at + 1, 4) = X'666D7420' or octet_length(content) < at + 8, at, at + 8 + ({size}) + ({size}) % 2)"
    at = F.expr(f"aggregate(sequence(1, {CHUNKS}), 12L, (at, k) -> {step})")  # behind RIFF, the size and WAVE
    text = lambda at, n=4: F.decode(F.substring("content", at, n), "US-ASCII")
    f = files.withColumn("_at", at).withColumn("size", F.octet_length("content").cast("long"))
    fact = lambda name, off, n: F.expr(number(f"cast(_at + {off} as int)", n)).cast("int").alias(name)
    here = F.expr("substring(content, cast(_at + 1 as int), 4) = X'666D7420' and octet_length(content) >= _at + 24")
    f = f.select("recording_id", fact("sample_rate", 13, 4), fact("channels", 11, 2), fact("bits", 23, 2), "size", (text(1) == "RIFF").alias("riff"), (text(9) == "WAVE").alias("wave"), here.alias("here"))
    ok = F.col("riff") & F.col("wave") & F.col("here") & (F.col("sample_rate") > 0) & (F.col("channels") > 0) & (F.col("bits") > 0)
    f = f.withColumn("ok", F.coalesce(ok, F.lit(False)))
    return f.select("recording_id", *[F.when(F.col("here"), F.col(c)).alias(c) for c in ("sample_rate", "channels", "bits")], "size", "ok")


def accepted_files(facts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Files with sound facts, and the table of rejects."""
    return facts.where("ok").drop("ok"), facts.where("NOT ok").drop("ok")


def full_results(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object per recording to its timed words, i being their place."""
    r = spark.read.schema(FULL_RESULT).json(path)
    return r.select("recording_id", F.posexplode("words").alias("i", "w")).select("recording_id", "i", "w.word", F.col("w.start").alias("start_time"), F.col("w.end").alias("end_time"))


def chunk_results(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    return (spark.readStream if stream else spark.read).schema(CHUNK_RESULT).json(path)


def session_events(spark: SparkSession, path: str, stream: bool = False, files_a_trigger: int | None = None) -> DataFrame:
    """JSON lines of events; files_a_trigger paces a replay."""
    reader = spark.readStream if stream else spark.read
    if stream and files_a_trigger:
        reader = reader.option("maxFilesPerTrigger", files_a_trigger)
    return reader.schema(EVENT).json(path)


def routed(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events of known types, and the others."""
    known = F.coalesce(F.col("type").isin(EVENT_TYPES), F.lit(False))
    return events.where(known), events.where(~known)


def decoded_payload(events: DataFrame) -> DataFrame:
    """Audio events with their bytes; a payload that is left out is empty, one that is no base64 has a null n_bytes."""
    raw = F.try_to_binary(F.coalesce("pcm16_base64", F.lit("")), F.lit("base64"))
    return events.withColumn("pcm16", raw).withColumn("n_bytes", F.octet_length("pcm16").cast("long")).drop("pcm16_base64")


def encoded_payload(events: DataFrame) -> DataFrame:
    """Audio events with their bytes as text, the inverse of decoded_payload."""
    return events.withColumn("pcm16_base64", F.base64("pcm16")).drop("pcm16", "n_bytes")


def store_words(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/words").orderBy("recording_id", "start_time", "word_id")


def with_summaries(report: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """A report by session with the runs' summaries, where there are any."""
    return report.join(spark.read.schema(RUN_SUMMARY).option("multiLine", True).json(path), "session_id", "left")


def recognised(windows: DataFrame, recognise: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """A user's recogniser over window payloads, batch by batch; what it loads once it keeps in its module."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield recognise(batch)

    return windows.mapInPandas(run, schema)
