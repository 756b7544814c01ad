"""The library's queries over the given tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import words as W
from ..operators import accumulate, analysis, long_sessions, segments, sessions, store, windows
from . import fixtures as X


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = X.words(spark, sf_dir)
    return segments.build_segments(segments.renumbered(w.where(~W.is_filler(F.col("word")))))


def _store(spark, sf_dir):
    w = X.words(spark, sf_dir)
    words, chunks = store.words_table(w), store.chunks_table(w)
    return words, chunks, store.chunk_words(words, chunks)


def filler_flags(spark, sf_dir):
    return X.words(spark, sf_dir).select("recording_id", "i", "word", W.is_filler(F.col("word")).alias("is_filler"))


def filler_filter(spark, sf_dir):
    return X.words(spark, sf_dir).where(~W.is_filler(F.col("word")))


def word_normal_forms(spark, sf_dir):
    return X.words(spark, sf_dir).select("recording_id", "i", W.same_word_form(F.col("word")).alias("same_form"), W.diff_form(F.col("word")).alias("diff_form"), F.octet_length("word").alias("n_bytes"))


def srt_cues(spark, sf_dir):
    return segments.srt_cues(_segments(spark, sf_dir)).select("recording_id", "segment", "cue")


def vtt_cues(spark, sf_dir):
    return segments.vtt_cues(_segments(spark, sf_dir)).select("recording_id", "segment", "cue")


def txt_lines(spark, sf_dir):
    return _segments(spark, sf_dir).select("recording_id", "segment", "text")


def chunk_words(spark, sf_dir):
    return _store(spark, sf_dir)[2]


def words_backfilled(spark, sf_dir):
    words, _, links = _store(spark, sf_dir)
    return store.backfilled(words, links).drop("confidence")


def chunk_stats(spark, sf_dir):
    return store.chunks_table(X.words(spark, sf_dir)).select("recording_id", "chunk_id", "start_time", "end_time", "duration", "word_count", "source_type")


def transcript_stats(spark, sf_dir):
    w = X.words(spark, sf_dir)
    return analysis.transcript_stats(w, segments.build_segments(w))


def edge_words(spark, sf_dir):
    return analysis.edge_words(X.words(spark, sf_dir))


def run_delta(spark, sf_dir):
    w = X.words(spark, sf_dir)
    b = X.baseline(w)
    return analysis.run_delta(analysis.transcript_stats(w, segments.build_segments(w)), analysis.transcript_stats(b, segments.build_segments(b)))


def recording_inventory(spark, sf_dir):
    return windows.inventory(X.recordings(spark, sf_dir)).select("recording_id", "size", "duration", "n_chunks")


def batch_windows(spark, sf_dir):
    return windows.batch_windows(windows.inventory(X.recordings(spark, sf_dir))).drop("duration")


def overlap_windows(spark, sf_dir):
    return windows.overlap_windows(X.recordings(spark, sf_dir))


def _word_windows(spark, sf_dir):
    w = X.words(spark, sf_dir)
    d = w.groupBy("recording_id").agg(F.max("end_time").alias("duration"))
    return windows.concatenated(windows.batch_windows(d), w)


def window_words_concat(spark, sf_dir):
    return _word_windows(spark, sf_dir)


def batch_totals(spark, sf_dir):
    w = X.words(spark, sf_dir)
    d = w.groupBy("recording_id").agg(F.max("end_time").alias("total_duration"))
    n = _word_windows(spark, sf_dir).groupBy("recording_id").agg(F.count(F.lit(1)).alias("word_count"), F.countDistinct("chunk_index").alias("chunk_count"))
    return d.join(n, "recording_id", "left").select("recording_id", "total_duration", F.coalesce("chunk_count", F.lit(0)).alias("chunk_count"), F.coalesce("word_count", F.lit(0)).alias("word_count"))


def char_words(spark, sf_dir):
    t = X.table(spark, sf_dir, "conversations")
    c = t.select(F.col("conv_id").alias("recording_id"), F.col("turn").alias("chunk_index"), (F.col("turn") * 60.0).alias("chunk_start"), F.posexplode(F.split("text", "")).alias("position", "char"))
    c = c.where("char <> ''").withColumn("start_offset", F.col("position")).withColumn("end_offset", F.col("position") + 1)
    return windows.words_from_char_stamps(c)


def stamp_words(spark, sf_dir):
    w = X.words(spark, sf_dir)
    s = F.struct(F.when(F.col("i") % 5 == 0, "").otherwise(F.col("word")).alias("word"), F.col("word").alias("char"), (F.col("i") % 750 * 5).alias("start_offset"), (F.col("i") % 750 * 5 + 4).alias("end_offset"))
    c = w.groupBy("recording_id", F.floor(F.col("i") / 750).alias("chunk_index")).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", s.alias("s")))), lambda x: x["s"]).alias("stamps"))
    return windows.words_from_word_stamps(c.withColumn("chunk_start", F.col("chunk_index") * 300.0))


def accumulated_final(spark, sf_dir):
    a = accumulate.accumulated(X.final_events(X.words(spark, sf_dir)))
    return a.where("word IS NOT NULL").select("session_id", "sequence", "word", "start_time", "end_time")


def accumulated_in_parts(spark, sf_dir):
    """accumulated_final without one task per session."""
    a = long_sessions.accumulated_in_parts(X.final_events(X.words(spark, sf_dir)))
    return a.where("word IS NOT NULL").select("session_id", "sequence", "word", "start_time", "end_time")


def accumulated_by_join(spark, sf_dir):
    """accumulated_final as an anti-join."""
    return long_sessions.committed_by_join(X.final_events(X.words(spark, sf_dir))).drop("arrival")


def final_times(spark, sf_dir):
    return long_sessions.final_times(X.final_events(X.words(spark, sf_dir))).select("session_id", "sequence", "last_final")


def sequence_checks(spark, sf_dir):
    """sequence_errors by a scan, without the fold."""
    return long_sessions.checked(X.disordered_events(X.words(spark, sf_dir))).where("error IS NOT NULL").select("session_id", "arrival", "sequence", "error")


def long_segments(spark, sf_dir):
    """Segments by blocks of words, as those of recordings of any length are made."""
    return segments.block_segments(X.words(spark, sf_dir), block_words=256)


def server_sessions(spark, sf_dir):
    from ..streaming import servers  # it reads operators of this package

    return servers.served(X.server_events(spark, sf_dir))


def event_deltas(spark, sf_dir):
    e = X.final_events(X.words(spark, sf_dir))
    return sessions.event_deltas(accumulate.accumulated(e), e)


def preview_changes(spark, sf_dir):
    a = accumulate.accumulated(X.revised_events(X.words(spark, sf_dir))).where("word IS NULL AND error IS NULL")
    return sessions.preview_changes(a.select("session_id", "arrival", "sequence", F.col("pending").alias("preview")))


def sequence_errors(spark, sf_dir):
    """Events that come too late, again, or behind their final form."""
    a = accumulate.accumulated(X.disordered_events(X.words(spark, sf_dir)))
    return a.where("error IS NOT NULL").select("session_id", "arrival", "sequence", "error")


def session_totals(spark, sf_dir):
    return analysis.session_totals(X.final_events(X.words(spark, sf_dir)))


def chunk_event_pairs(spark, sf_dir):
    e = X.session_events(spark, sf_dir)
    ms = F.unix_micros(F.col("ts").cast("timestamp")) / 1000.0
    chunks = e.where("type = 'audio'").select("session_id", "sequence", ms.alias("emitted_ms"))
    return analysis.chunk_event_pairs(chunks, e.where("type IN ('flush', 'stop')").select("session_id", "event_id", ms.alias("received_ms")))


def session_metrics(spark, sf_dir):
    e = X.session_events(spark, sf_dir).where("type = 'audio'")
    server = F.round("value").cast("long")
    chunks = e.select("session_id", "sequence", F.col("pts").alias("start"), F.lit(0.5).alias("duration"), (F.col("sequence") * 2).alias("committed"), server.alias("server_ms"), (server * 2).alias("end_to_end_ms"))
    elapsed = X.session_events(spark, sf_dir).groupBy("session_id").agg(((F.max(F.unix_micros(F.col("ts").cast("timestamp"))) - F.min(F.unix_micros(F.col("ts").cast("timestamp")))) / 1e6).alias("elapsed_seconds"))
    return analysis.session_metrics(chunks, elapsed).drop("elapsed_seconds")


def flush_spans(spark, sf_dir):
    return sessions.flush_spans(X.session_events(spark, sf_dir))


def partial_triggers(spark, sf_dir):
    return sessions.partial_triggers(X.session_events(spark, sf_dir))


def idle_sessions(spark, sf_dir):
    return sessions.idle_sessions(X.session_events(spark, sf_dir), 36000)


def event_validation(spark, sf_dir):
    e = X.session_events(spark, sf_dir).withColumn("pts", F.when(F.col("event_id") % 7 == 0, -1.0).otherwise(F.col("pts"))).withColumn("duration", F.when(F.col("event_id") % 11 == 0, -1.0).otherwise(F.col("duration")))
    # the sender counts the audio events that will be taken, and is one ahead now and then
    fine = F.when((F.col("type") == "audio") & (F.col("event_id") % 7 != 0) & (F.col("event_id") % 11 != 0) & (F.col("event_id") % 17 != 0) & (F.col("value") >= 0), 1).otherwise(0)
    before = Window.partitionBy("session_id").orderBy("arrival").rowsBetween(Window.unboundedPreceding, -1)
    e = e.withColumn("sequence", F.coalesce(F.sum(fine).over(before), F.lit(0)) + F.when(F.col("event_id") % 17 == 0, 1).otherwise(0))
    e = e.withColumn("format", F.when(F.col("event_id") % 13 == 0, "mp3").otherwise(F.col("format")))
    return sessions.validated(e).select("session_id", "event_id", "type", "code")


def downmix(spark, sf_dir):
    e = X.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("recording_id"), F.posexplode("embedding").alias("k", "x"))
    value = F.floor(F.col("x").cast("double") * 200000).cast("long")
    return windows.downmixed(e.select("recording_id", F.floor(F.col("k") / 2).alias("frame"), (F.col("k") % 2).alias("channel"), value.alias("value")))


def word_alignment(spark, sf_dir):
    w = X.words(spark, sf_dir)
    return analysis.aligned(X.baseline(w), w)


def alignment_summary(spark, sf_dir):
    w = X.words(spark, sf_dir)
    return analysis.alignment_summary(analysis.compared(X.baseline(w), w))


QUERIES = [
    filler_flags, filler_filter, word_normal_forms, srt_cues, vtt_cues, txt_lines, chunk_words, words_backfilled, chunk_stats, transcript_stats, edge_words,
    run_delta, recording_inventory, batch_windows, overlap_windows, window_words_concat, batch_totals, char_words, stamp_words, accumulated_final, accumulated_in_parts, accumulated_by_join, final_times, sequence_checks, long_segments, server_sessions, event_deltas,
    preview_changes, sequence_errors, session_totals, chunk_event_pairs, session_metrics, flush_spans, partial_triggers, idle_sessions, event_validation, downmix, word_alignment, alignment_summary,
]


def queries() -> dict:
    from ..streaming import queries as streaming  # it reads fixtures of this package

    return {q.__name__: q for q in QUERIES} | streaming.queries()


def oracle_sql() -> dict[str, str]:
    from .oracles import SQL

    return dict(SQL)
