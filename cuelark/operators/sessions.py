"""Session events in batch form: validation, flush spans, partial triggers, idle expiry. The streaming form is in streaming."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.words import payload_seconds, rounded

IDLE_SECONDS, PARTIAL_SECONDS = 300, 1.0
FORMAT = "pcm_s16le"
TYPES = ("start", "audio", "flush", "stop")


def error_code(expected: Column) -> Column:
    """The code of the first rule that an event breaks, else null."""
    kind, audio = F.col("type"), F.col("type") == "audio"
    return (
        F.when(~kind.isin(*TYPES) | kind.isNull(), "invalid-event-type")
        .when((kind == "start") & (F.coalesce(F.btrim("session_id"), F.lit("")) == ""), "invalid-session-id")
        .when((kind == "start") & ((F.col("sample_rate") <= 0) | (F.col("channels") <= 0) | (F.col("format") != FORMAT)), "decoder-error")
        .when(audio & (F.col("sequence") != expected), "invalid-sequence")
        .when(audio & (F.col("pts") < 0), "invalid-pts")
        .when(audio & (F.col("duration") < 0), "invalid-duration")
    )


def validated(events: DataFrame) -> DataFrame:
    """Session events with `code`. The expected sequence is the number of audio events accepted before; a rejected one
    does not advance it, so that a session's audio is one fold over (arrival, sequence, well-formed)."""
    kind = F.col("type") == "audio"
    fine = kind & (F.col("pts") >= 0) & (F.col("duration") >= 0)
    numbered = events.withColumn("_fine", F.coalesce(fine, F.lit(False)))
    audio = numbered.where(kind).select("session_id", F.col("arrival").cast("long").alias("arrival"), "sequence", "_fine")
    audio = audio.groupBy("session_id").applyInPandas(_expected, f"session_id {events.schema['session_id'].dataType.simpleString()}, arrival long, expected long")
    return events.join(audio, ["session_id", "arrival"], "left").withColumn("code", error_code(F.col("expected"))).drop("expected")


def _expected(rows: pd.DataFrame) -> pd.DataFrame:
    """The sequence that each audio event of a session should have had."""
    rows, n, out = rows.sort_values("arrival", kind="stable"), 0, []
    for sequence, fine in zip(rows.sequence, rows._fine, strict=True):
        out.append(n)
        n += bool(fine and sequence == n)
    return pd.DataFrame({"session_id": rows.session_id, "arrival": rows.arrival, "expected": out})


def _spanned(events: DataFrame) -> DataFrame:
    before = Window.partitionBy("session_id").orderBy("arrival").rowsBetween(Window.unboundedPreceding, -1)
    closed = F.when(F.col("type").isin("flush", "stop"), 1).otherwise(0)
    return events.withColumn("span", F.coalesce(F.sum(closed).over(before), F.lit(0)))


def flush_spans(events: DataFrame, rate: int = 16000, channels: int = 1) -> DataFrame:
    """What each flush or stop decodes: (session_id, span, start, duration, up_to, type).

    The start is the pts of the first non-empty frame since the last one, or what was final before if there is none.
    """
    filled = F.when((F.col("type") == "audio") & (F.col("n_bytes") > 0), F.struct("arrival", "pts"))
    s = _spanned(events).groupBy("session_id", "span").agg(
        F.min(filled)["pts"].alias("first"), F.coalesce(F.sum(F.when(F.col("type") == "audio", F.col("n_bytes"))), F.lit(0)).alias("n_bytes"),
        F.max(F.when(F.col("type").isin("flush", "stop"), F.col("type"))).alias("closed_by"),
    )
    s = s.where("closed_by IS NOT NULL").withColumn("duration", F.round(payload_seconds(F.col("n_bytes"), rate, channels), 3))
    own = F.when(F.col("first").isNotNull(), F.round(F.col("first") + F.col("duration"), 3))
    before = Window.partitionBy("session_id").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce("first", F.greatest(F.max(own).over(before), F.lit(0.0)), F.lit(0.0))
    return s.withColumn("start", start).select("session_id", "span", "start", "duration", F.round(F.col("start") + F.col("duration"), 3).alias("up_to"), "closed_by")


def partial_triggers(events: DataFrame, rate: int = 16000, channels: int = 1, seconds: float = PARTIAL_SECONDS) -> DataFrame:
    """Audio events after which the whole buffer is previewed: (session_id, sequence, buffered)."""
    upto = Window.partitionBy("session_id", "span").orderBy("arrival").rowsBetween(Window.unboundedPreceding, 0)
    e = _spanned(events).where("type = 'audio'").withColumn("buffered", payload_seconds(F.sum("n_bytes").over(upto), rate, channels))
    return e.where(F.col("buffered") >= seconds).select("session_id", "sequence", rounded(F.col("buffered")).alias("buffered"))


def idle_sessions(events: DataFrame, seconds: float = IDLE_SECONDS) -> DataFrame:
    """Stretches of a session without a gap of over `seconds`; with seconds <= 0 there is one."""
    order = Window.partitionBy("session_id").orderBy("ts", "arrival")
    micros = lambda t: F.unix_micros(t.cast("timestamp"))
    gap = micros(F.col("ts")) - micros(F.lag("ts").over(order))
    new = F.when(gap > int(seconds * 1_000_000), 1).otherwise(0) if seconds > 0 else F.lit(0)
    e = events.withColumn("new", new).withColumn("stretch", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return e.groupBy("session_id", "stretch").agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count(F.lit(1)).alias("n_events"))


def preview_changes(previews: DataFrame) -> DataFrame:
    """(session_id, arrival, sequence, preview): rows whose preview is not empty and differs from the one before."""
    order = Window.partitionBy("session_id").orderBy("arrival")
    p = previews.withColumn("was", F.coalesce(F.lag("preview").over(order), F.lit("")))
    return p.where("preview <> '' AND preview <> was").drop("was")


def event_deltas(committed: DataFrame, events: DataFrame) -> DataFrame:
    """Per event (session_id, arrival, sequence): how many words it committed, and the session's count after it. Events are told
    apart by their arrival, as several may have one sequence, or none that is checked."""
    n = committed.where("word IS NOT NULL").groupBy("session_id", "arrival").agg(F.count(F.lit(1)).alias("delta"))
    order = Window.partitionBy("session_id").orderBy("arrival").rowsBetween(Window.unboundedPreceding, 0)
    e = events.select("session_id", "arrival", "sequence").join(n, ["session_id", "arrival"], "left").withColumn("delta", F.coalesce("delta", F.lit(0)))
    return e.withColumn("committed", F.sum("delta").over(order))
