"""Window plans over recordings, stamps to words, and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.words import not_blank, rebased

HEADER, BYTES_A_SECOND = 44, 32000
TRAILING = 2  # seconds a batch window reaches into the next


def inventory(recordings: DataFrame, chunk_seconds: float = 60) -> DataFrame:
    """(recording_id, size) with duration and n_chunks; both 0 without a payload."""
    duration = F.greatest(F.col("size") - HEADER, F.lit(0)) / BYTES_A_SECOND
    return recordings.withColumn("duration", F.coalesce(duration, F.lit(0.0))).withColumn("n_chunks", F.ceil(F.col("duration") / chunk_seconds))


def batch_windows(recordings: DataFrame, chunk_seconds: int = 60) -> DataFrame:
    """Windows that start every chunk_seconds below the whole seconds of the duration, each with a trailing overlap."""
    whole = F.floor("duration").cast("int")
    starts = F.when(whole > 0, F.sequence(F.lit(0), whole - 1, F.lit(chunk_seconds))).otherwise(F.array().cast("array<int>"))
    out = recordings.select("recording_id", "duration", F.posexplode(starts).alias("chunk_index", "start"))
    return out.withColumn("end", F.least(F.col("start") + chunk_seconds + TRAILING, F.col("duration").cast("double")))


def overlap_windows(recordings: DataFrame, chunk_seconds: float = 5.0, overlap_seconds: float = 0.5) -> DataFrame:
    """(recording_id, n_frames, rate) to windows of chunk_seconds that overlap; the last is short, none if there are no frames."""
    if overlap_seconds >= chunk_seconds:
        raise ValueError("the overlap must be shorter than the chunk")
    chunk, over = F.round(F.col("rate") * chunk_seconds).cast("long"), F.round(F.col("rate") * overlap_seconds).cast("long")
    r = recordings.withColumn("chunk", chunk).withColumn("step", chunk - over)
    n = F.when(F.col("n_frames") <= 0, 0).when(F.col("n_frames") <= F.col("chunk"), 1).otherwise(1 + F.ceil((F.col("n_frames") - F.col("chunk")) / F.col("step")))
    some = F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(F.array().cast("array<long>"))
    r = r.select("recording_id", "n_frames", "rate", "chunk", "step", F.explode(some).alias("sequence"))
    first = F.col("sequence") * F.col("step")
    size = F.least(F.col("chunk"), F.col("n_frames") - first)
    return r.select("recording_id", "sequence", first.alias("first_frame"), size.alias("frames"), (first / F.col("rate")).alias("start"), (size / F.col("rate")).alias("duration"))


def sliced(windows: DataFrame, payloads: DataFrame, bytes_a_frame: int = 2, header: int = HEADER) -> DataFrame:
    """windows with the bytes of their frames, from payloads (recording_id, content)."""
    at, n = F.col("first_frame") * bytes_a_frame + header + 1, F.col("frames") * bytes_a_frame
    return windows.join(payloads, "recording_id").withColumn("pcm16", F.substring("content", at.cast("int"), n.cast("int"))).drop("content")


def extracted(requests: DataFrame, payloads: DataFrame, header: int = HEADER) -> DataFrame:
    """Time ranges (recording_id, start >= 0, duration > 0, rate, channels) with their bytes of 16-bit samples."""
    frame = F.col("channels") * 2
    ok = requests.where("start >= 0 AND duration > 0")
    at = (F.col("start") * F.col("rate")).cast("int") * frame + header + 1
    n = (F.col("duration") * F.col("rate")).cast("int") * frame
    return ok.join(payloads, "recording_id").withColumn("pcm16", F.substring("content", at, n)).drop("content")


def downmixed(samples: DataFrame, bits: int = 16) -> DataFrame:
    """(recording_id, frame, channel, value) to one truncated mean per frame within the range of `bits`."""
    top = 2 ** (bits - 1)
    mean = F.avg("value")
    return samples.groupBy("recording_id", "frame").agg(F.greatest(F.lit(-top), F.least(F.lit(top - 1), mean)).cast("int").alias("value"))


def words_from_word_stamps(chunks: DataFrame, stride: Column | float = 0.08) -> DataFrame:
    """(recording_id, chunk_index, chunk_start, stamps array<struct<word, char, start_offset, end_offset>>) to words; blank ones go."""
    s = chunks.select("recording_id", "chunk_index", "chunk_start", F.posexplode("stamps").alias("position", "s"))
    word = F.btrim(F.coalesce(F.nullif(F.col("s.word"), F.lit("")), F.col("s.char"), F.lit("")))
    made = s.select("recording_id", "chunk_index", "position", word.alias("word"), *[rebased(F.col(f"s.{x}_offset"), stride, F.col("chunk_start")).alias(f"{x}_time") for x in ("start", "end")])
    return made.where(F.col("word") != "")


def words_from_char_stamps(chars: DataFrame, stride: float = 0.08) -> DataFrame:
    """(recording_id, chunk_index, chunk_start, position, char, start_offset, end_offset): a space closes a word."""
    key = ["recording_id", "chunk_index"]
    before = Window.partitionBy(*key).orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    c = chars.withColumn("island", F.sum(F.when(F.col("char") == " ", 1).otherwise(0)).over(before)).where(F.col("char") != " ")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", "char"))), lambda x: x["char"]), "")
    w = c.groupBy(*key, "island", "chunk_start").agg(text.alias("word"), F.min_by("start_offset", "position").alias("first"), F.max_by("end_offset", "position").alias("last"))
    start = F.col("chunk_start")
    return w.select(*key, "island", "word", rebased(F.col("first"), stride, start).alias("start_time"), rebased(F.col("last"), stride, start).alias("end_time")).where(not_blank(F.col("word")))


def concatenated(windows: DataFrame, words: DataFrame, span: int = 60) -> DataFrame:
    """The words of each window, in window order and without removing what the overlap repeats."""
    slices = F.sequence(F.floor(F.col("start") / span), F.floor(F.col("end") / span))
    w = windows.select("recording_id", "chunk_index", "start", "end", F.explode(slices).alias("slice"))
    x = words.withColumn("slice", F.floor(F.col("start_time") / span))
    return x.join(w, ["recording_id", "slice"]).where("start_time >= start AND start_time < end").select("recording_id", "chunk_index", "i", "word", "start_time", "end_time")
