"""Structured Streaming forms of the accumulator and of session handling, and the sinks that follow them.

The processors keep one state row per session in the state store. Rows of a micro-batch are applied in the order of their
arrival, as those of all batches are, so that the result does not depend on where batches are cut; the sequence
rules and the session's last final time decide about what comes late. There is no watermark: time is seconds of a recording, per
session.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.words import joined
from ..operators import accumulate
from ..operators.accumulate import COMMITTED, State, applied

WORD = "struct<word:string,start_time:double,end_time:double>"
EVENT = f"session_id string, arrival long, type string, sequence long, up_to double, words array<{WORD}>"
OUT = f"session_id string, {COMMITTED}"
SESSION_EVENT = "session_id string, connection string, arrival long, type string, sequence long, pts double, duration double, sample_rate int, channels int, format string, n_bytes long"
SESSION_OUT = "session_id string, arrival long, type string, sequence long, start double, up_to double, seconds double, code string"
IDLE_MS = 300_000


def in_arrival(rows: Iterator[pd.DataFrame], columns: tuple[str, ...], by: str = "arrival") -> Iterator[tuple]:
    """A key's rows in order, as tuples. Null numbers may be NaN there."""
    t = list(rows)
    t = (t[0] if len(t) == 1 else pd.concat(t)).sort_values(by, kind="stable")
    return zip(*[t[c].tolist() for c in columns], strict=True)


class Accumulate(StatefulProcessor):
    """Session events in, committed words, previews and errors out."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("kept", "state string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        s = State(**json.loads(self.kept.get()[0])) if self.kept.exists() else State()
        s.committed, s.pending = [tuple(w) for w in s.committed], [tuple(w) for w in s.pending]
        made = [(key[0], *x) for x in applied(s, in_arrival(rows, accumulate.EVENT))]
        self.kept.update((json.dumps(s.__dict__),))
        yield pd.DataFrame(made, columns=[c.split()[0] for c in OUT.split(", ")]).astype({"position": "Int32"})

    def close(self) -> None:
        pass


def accumulated_stream(events: DataFrame) -> DataFrame:
    """A stream of EVENT rows to a stream of OUT rows."""
    return accumulate.flat(events, "session_id").groupBy("session_id").transformWithStateInPandas(Accumulate(), outputStructType=OUT, outputMode="Append", timeMode="None")


class Sessions(StatefulProcessor):
    """start, audio, flush and stop events in; started, partial, final_words, stopped and error rows out.

    A rejected event does not advance the expected sequence. A session without events for idle_ms is closed; events on its
    connection then find no session, until another connection starts one.
    """

    def __init__(self, idle_ms: int = IDLE_MS, partial_seconds: float = 1.0):
        self.idle_ms, self.partial_seconds = idle_ms, partial_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("session", "state string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        s = json.loads(self.kept.get()[0]) if self.kept.exists() else None
        out = []
        for r in pd.concat(list(rows)).sort_values("arrival", kind="stable").itertuples(index=False):
            s, made = step(s, r, self.partial_seconds)
            out += [(key[0], r.arrival, *m) for m in made]
        for t in list(self.handle.listTimers()) if self.idle_ms > 0 else []:
            self.handle.deleteTimer(t)
        if s is None:
            self.kept.clear()
        else:
            self.kept.update((json.dumps(s),))
            if self.idle_ms > 0 and not s.get("expired"):
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms + 1)
        yield pd.DataFrame(out, columns=[c.split()[0] for c in SESSION_OUT.split(", ")]).astype({"sequence": "Int64"})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        s = json.loads(self.kept.get()[0]) if self.kept.exists() else {}
        self.kept.update((json.dumps({"expired": True, "connection": s.get("connection")}),))
        yield pd.DataFrame([], columns=[c.split()[0] for c in SESSION_OUT.split(", ")])

    def close(self) -> None:
        pass


def given(x, default):
    """A field of an event, or what the protocol takes where it is left out."""
    return default if x is None or pd.isna(x) else x


def step(s: dict | None, r, partial_seconds: float) -> tuple[dict | None, list[tuple]]:
    """One session event: the state behind it, None being no session, and the rows (type, sequence, start, up_to, seconds, code).
    Fields that are left out count as sample_rate 16000, channels 1, pcm_s16le, and 0 for sequence, pts and duration."""
    kind = given(r.type, "").strip()
    sequence, pts, duration = int(given(r.sequence, 0)), float(given(r.pts, 0.0)), float(given(r.duration, 0.0))
    sample_rate, channels = int(given(r.sample_rate, 16000)), int(given(r.channels, 1))
    row = lambda type_, sequence=None, start=None, up_to=None, seconds=None, code=None: (type_, sequence, start, up_to, seconds, code)
    fail = lambda code: (s, [row("error", code=code)])
    if kind == "start":
        if s is not None and s.get("connection") is not None and s["connection"] == r.connection:
            return fail("protocol-error")
        if s is not None and not s.get("expired"):
            return fail("session-already-exists")
        if not given(r.session_id, "").strip():
            return fail("invalid-session-id")
        if sample_rate <= 0 or channels <= 0 or given(r.format, "pcm_s16le") != "pcm_s16le":
            return fail("decoder-error")
        return {"connection": r.connection, "expected": 0, "size": 0, "pts": None, "final": 0.0, "frame": sample_rate * channels * 2}, [row("started")]
    if s is None:
        return fail("session-not-started")
    if s.get("expired"):
        return fail("session-not-found")
    if kind == "audio" and pd.isna(r.n_bytes):  # its payload could not be decoded
        return fail("server-error")
    seconds = lambda: s["size"] / s["frame"]
    span = lambda: (s["final"] if s["pts"] is None else s["pts"], round(seconds(), 3))
    if kind == "audio":
        code = "invalid-sequence" if sequence != s["expected"] else "invalid-pts" if pts < 0 else "invalid-duration" if duration < 0 else None
        if code:
            return fail(code)
        s = s | {"expected": s["expected"] + 1}
        if r.n_bytes > 0:
            s |= {"pts": pts if s["pts"] is None else s["pts"], "size": s["size"] + int(r.n_bytes)}
        start, length = span()
        return s, [row("partial", sequence, start, round(start + length, 3), length)] if seconds() >= partial_seconds else []
    if kind in ("flush", "stop"):
        start, length = span()
        up_to = round(start + length, 3)
        made = [row("final_words", None, start, up_to, length)] if kind == "flush" or s["size"] else []
        s = s | {"final": max(s["final"], up_to) if s["size"] else s["final"], "size": 0, "pts": None}
        return (None, [*made, row("stopped", seconds=round(s["final"], 3))]) if kind == "stop" else (s, made)
    return fail("invalid-event-type")


def session_stream(events: DataFrame, idle_ms: int = IDLE_MS) -> DataFrame:
    """A stream of SESSION_EVENT rows to a stream of SESSION_OUT rows; without timers where idle_ms is 0."""
    mode = "ProcessingTime" if idle_ms > 0 else "None"
    return events.groupBy("session_id").transformWithStateInPandas(Sessions(idle_ms), outputStructType=SESSION_OUT, outputMode="Append", timeMode=mode)


def chunk_results_as_events(chunks: DataFrame) -> DataFrame:
    """Chunk results (session_id, chunk_index, chunk_start, chunk_duration, words) as final events."""
    return chunks.select(
        "session_id", F.col("chunk_index").cast("long").alias("arrival"), F.lit("final_words").alias("type"), F.col("chunk_index").cast("long").alias("sequence"),
        (F.col("chunk_start") + F.col("chunk_duration")).alias("up_to"), "words",
    )


def routed(batch: DataFrame) -> dict[str, DataFrame]:
    """A micro-batch of OUT rows by sink: words that were committed, changed previews, errors."""
    return {"committed": batch.where("word IS NOT NULL"), "preview": batch.where("word IS NULL AND error IS NULL AND pending <> ''"), "errors": batch.where("error IS NOT NULL")}


def committed_lines(batch: DataFrame) -> DataFrame:
    """What each final event committed: count and text."""
    words = F.array_sort(F.collect_list(F.struct("position", "word")))
    return batch.where("word IS NOT NULL").groupBy("session_id", "sequence").agg(F.count(F.lit(1)).alias("n"), joined(words).alias("text"))


def summary_overwrite(path: str):
    """For foreachBatch over updated metrics: one JSON file for each session of the batch, written anew."""

    def run(batch: DataFrame, epoch: int) -> None:
        batch.repartition("session_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("session_id").json(path)

    return run


def paced(writer, seconds: float, speed: float = 1.0):
    """A stream writer that takes a source's next files (of `seconds` of recording each trigger) at `speed` times their own
    pace; with speed 0 it takes all there is, without pauses."""
    return writer.trigger(processingTime=f"{round(1000 * seconds / speed)} milliseconds") if speed > 0 else writer.trigger(availableNow=True)


def event_source(spark: SparkSession, path: str, schema: str = EVENT, files_a_trigger: int = 1) -> DataFrame:
    """JSON files of events as a stream; files_a_trigger paces a replay."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_trigger).json(path)
