"""Statistics of transcripts and runs, and the comparison of two runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.words import is_filler, rounded, up_to
from .alignment import aligned, compared

__all__ = ["aligned", "alignment_summary", "chunk_event_pairs", "compared", "edge_words", "run_delta", "session_metrics", "session_totals", "transcript_stats"]
EDGE = 10


def transcript_stats(words: DataFrame, chunks: DataFrame) -> DataFrame:
    """Per recording: n_words, n_fillers, n_chunks, first_start, last_end."""
    w = words.groupBy("recording_id").agg(
        F.count(F.lit(1)).alias("n_words"), F.count_if(is_filler(F.col("word"))).alias("n_fillers"), F.min("start_time").alias("first_start"), F.max("end_time").alias("last_end")
    )
    c = chunks.groupBy("recording_id").agg(F.count(F.lit(1)).alias("n_chunks"))
    return w.join(c, "recording_id", "full").select("recording_id", *[F.coalesce(x, F.lit(0)).alias(x) for x in ("n_words", "n_fillers", "n_chunks")], "first_start", "last_end")


def edge_words(words: DataFrame, n: int = EDGE) -> DataFrame:
    """Per recording the first n words by start and the last n by end, both in the order of time."""
    first = F.row_number().over(Window.partitionBy("recording_id").orderBy("start_time", "i"))
    last = F.row_number().over(Window.partitionBy("recording_id").orderBy(F.desc("end_time"), F.desc("i")))
    w = words.withColumn("a", first).withColumn("b", last).where(f"a <= {n} OR b <= {n}")
    text = lambda rank, order: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col(rank) <= n, F.struct(order, "word")))), lambda x: x["word"]), " ")
    return w.groupBy("recording_id").agg(text("a", "a").alias("first_words"), text("b", (-F.col("b")).alias("b")).alias("last_words"))


def run_delta(run: DataFrame, baseline: DataFrame) -> DataFrame:
    """Statistics of two runs side by side; a recording that one lacks counts 0 there."""
    cover = F.col("last_end") - F.col("first_start")
    side = lambda s, t: s.select("recording_id", *[F.col(c).alias(f"{t}_{c[2:]}") for c in ("n_words", "n_chunks")], cover.alias(f"{t}_coverage"))
    both = side(run, "run").join(side(baseline, "base"), "recording_id", "full")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return both.select("recording_id", *[(zero(f"run_{c}") - zero(f"base_{c}")).alias(f"delta_{c}") for c in ("words", "chunks", "coverage")])


def session_metrics(chunks: DataFrame, elapsed: DataFrame | None = None) -> DataFrame:
    """(session_id, sequence, start, duration, committed, server_ms, end_to_end_ms) to one row per session."""
    m = chunks.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("chunks"), F.max_by("committed", "sequence").alias("committed_words"), rounded(F.greatest(F.max(F.col("start") + F.col("duration")), F.lit(0.0))).alias("audio_seconds"),
        F.sum("server_ms").alias("sum_server_ms"), rounded(F.avg("server_ms")).alias("avg_server_ms"), F.max("server_ms").alias("max_server_ms"),
        rounded(F.avg("end_to_end_ms")).alias("avg_end_to_end_ms"), F.max("end_to_end_ms").alias("max_end_to_end_ms"),
    )
    if elapsed is None:
        return m
    rate = F.when(F.col("elapsed_seconds") > 0, F.col("audio_seconds") / F.col("elapsed_seconds")).otherwise(0.0)
    return m.join(elapsed, "session_id", "left").withColumn("audio_per_wall_second", rounded(F.coalesce(rate, F.lit(0.0))))


def session_totals(events: DataFrame) -> DataFrame:
    """Final events (session_id, type, up_to, words) to word_count and duration per session."""
    final = events.where("type = 'final_words'")
    return final.groupBy("session_id").agg(F.sum(F.size("words")).alias("word_count"), rounded(F.max("up_to")).alias("duration"), F.max(up_to(F.col("words"))).alias("last_word_end"))


def chunk_event_pairs(chunks: DataFrame, events: DataFrame) -> DataFrame:
    """The k-th finalised chunk with the k-th final event of a session; latency in ms. Events without a chunk get sequence -1."""
    rank = lambda *order: F.row_number().over(Window.partitionBy("session_id").orderBy(*order))
    c = chunks.select("session_id", "sequence", "emitted_ms", rank("sequence").alias("k"))
    e = events.select("session_id", "event_id", "received_ms", rank("received_ms", "event_id").alias("k"))
    return e.join(c, ["session_id", "k"], "left").select(
        "session_id", "event_id", F.coalesce("sequence", F.lit(-1)).alias("sequence"), (F.col("received_ms") - F.col("emitted_ms")).alias("latency_ms")
    )


def alignment_summary(regions: DataFrame) -> DataFrame:
    """Per recording and tag: regions, and the words on both sides that differ."""
    return regions.where("tag <> 'equal'").groupBy("recording_id", "tag").agg(
        F.count(F.lit(1)).alias("regions"), F.sum(F.col("i2") - F.col("i1")).alias("base_words"), F.sum(F.col("j2") - F.col("j1")).alias("run_words")
    )
