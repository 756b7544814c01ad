"""A live run as one stream: chunk results are accumulated, measured and summed up, and files follow.

Two stateful operators stand one behind the other: the first folds a session's chunk results and tells what each has
committed, the second keeps the running totals and puts out a summary behind every chunk.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.accumulate import FINAL, State, apply_event, full_words
from .transcripts import WORD, given, in_arrival

CHUNK = f"session_id string, sequence long, start double, duration double, words array<{WORD}>, processing_ms long, emitted_ms double, received_ms double"
FLAT = ("sequence", "start", "duration", "texts", "starts", "ends", "processing_ms", "emitted_ms", "received_ms")
MEASURED = "session_id string, sequence long, start double, duration double, added int, committed long, server_ms long, emitted_ms double, received_ms double, error string"
SUMMARY = (
    "session_id string, sequence long, chunks long, committed_words long, audio_seconds double, elapsed_seconds double, audio_per_wall_second double, "
    "sum_server_ms long, avg_server_ms double, max_server_ms long, avg_end_to_end_ms double, max_end_to_end_ms double"
)
_columns = lambda schema: [c.split()[0] for c in schema.split(", ")]


class Measured(StatefulProcessor):
    """Chunk results in; behind each one the words that it added and the session's count."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("transcript", "state string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        s, out = State(**json.loads(self.kept.get()[0])) if self.kept.exists() else State(), []
        s.committed = [tuple(w) for w in s.committed]
        for sequence, start, duration, texts, starts, ends, processing_ms, emitted_ms, received_ms in in_arrival(rows, FLAT, "sequence"):
            new, error = apply_event(s, FINAL, int(sequence), float(start) + float(duration), full_words(texts, starts, ends))
            out.append((key[0], sequence, start, duration, len(new), s.n_committed, int(given(processing_ms, 0)), emitted_ms, received_ms, error))
        self.kept.update((json.dumps(s.__dict__),))
        yield pd.DataFrame(out, columns=_columns(MEASURED)).astype({"added": "int32"})

    def close(self) -> None:
        pass


def _rounded(x: float) -> float:
    return (int(abs(x) * 1000 + 0.5) / 1000) * (1 if x >= 0 else -1)


class Summaries(StatefulProcessor):
    """Measured chunks in, a summary behind each one out. Chunks that the accumulator refused do not count."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("totals", "state string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        t = json.loads(self.kept.get()[0]) if self.kept.exists() else {"n": 0, "end": 0.0, "began": None, "server": 0, "most": 0, "latency": 0.0, "longest": 0.0}
        out = []
        for r in pd.concat(list(rows)).sort_values("sequence", kind="stable").itertuples(index=False):
            if not pd.isna(r.error):
                continue
            late = r.received_ms - r.emitted_ms
            t["n"] += 1
            t["end"], t["server"], t["most"] = max(t["end"], r.start + r.duration), t["server"] + int(r.server_ms), max(t["most"], int(r.server_ms))
            t["latency"], t["longest"] = t["latency"] + late, max(t["longest"], late)
            t["began"] = r.emitted_ms if t["began"] is None else min(t["began"], r.emitted_ms)
            audio, elapsed = _rounded(t["end"]), (r.received_ms - t["began"]) / 1000
            rate = _rounded(audio / elapsed) if elapsed > 0 else 0.0
            out.append((key[0], r.sequence, t["n"], r.committed, audio, _rounded(elapsed), rate, t["server"], _rounded(t["server"] / t["n"]), t["most"], _rounded(t["latency"] / t["n"]), t["longest"]))
        self.kept.update((json.dumps(t),))
        yield pd.DataFrame(out, columns=_columns(SUMMARY))

    def close(self) -> None:
        pass


def measured_stream(chunks: DataFrame) -> DataFrame:
    words = [F.col(f"words.{x}").alias(y) for x, y in (("word", "texts"), ("start_time", "starts"), ("end_time", "ends"))]
    chunks = chunks.select("*", *words).select("session_id", *FLAT)
    return chunks.groupBy("session_id").transformWithStateInPandas(Measured(), outputStructType=MEASURED, outputMode="Append", timeMode="None")


def summary_stream(chunks: DataFrame) -> DataFrame:
    """A stream of CHUNK rows to a stream of SUMMARY rows, one behind each chunk. A session's chunks come in the order of their
    sequence; one that comes late is refused by the accumulator's rules."""
    return measured_stream(chunks).groupBy("session_id").transformWithStateInPandas(Summaries(), outputStructType=SUMMARY, outputMode="Append", timeMode="None")


def latest(batch: DataFrame) -> DataFrame:
    """The last summary of each session of a micro-batch, which is the one its file shows."""
    return batch.groupBy("session_id").agg(F.max_by(F.struct(*[c for c in batch.columns if c != "session_id"]), "chunks").alias("s")).select("session_id", "s.*")
