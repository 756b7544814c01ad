"""Finalised chunks and final events, paired first in, first out, in a stream."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PAIR_INPUT = "session_id string, arrival long, kind string, id long, at_ms double"
PAIR_OUTPUT = "session_id string, event_id long, sequence long, latency_ms double"
COLUMNS = [c.split()[0] for c in PAIR_OUTPUT.split(", ")]
CHUNK, EVENT, END = "chunk", "event", "end"


class Pairs(StatefulProcessor):
    """Keeps a session's chunks in a queue until their final events come. An event that meets an empty queue gets the
    sequence -1 at once, or, if events may come before their chunks (wait), it waits in a queue of its own until the session's end."""

    def __init__(self, wait: bool):
        self.wait = wait

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.chunks = handle.getListState("chunks", "id long, at_ms double")
        self.events = handle.getListState("events", "id long, at_ms double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        queues = {k: deque(s.get()) if s.exists() else deque() for k, s in ((CHUNK, self.chunks), (EVENT, self.events))}
        before = {k: list(q) for k, q in queues.items()}
        out = []
        for r in pd.concat(list(rows)).sort_values("arrival", kind="stable").itertuples(index=False):
            if r.kind in queues:
                queues[r.kind].append((int(r.id), float(r.at_ms)))
            while queues[CHUNK] and queues[EVENT]:
                (sequence, emitted), (event, received) = queues[CHUNK].popleft(), queues[EVENT].popleft()
                out.append((key[0], event, sequence, received - emitted))
            if r.kind == END or not self.wait:
                out += [(key[0], event, -1, None) for event, _ in queues[EVENT]]
                queues[EVENT].clear()
        for k, state in ((CHUNK, self.chunks), (EVENT, self.events)):
            _saved(state, before[k], list(queues[k]))
        yield pd.DataFrame(out, columns=COLUMNS).astype({"event_id": "int64", "sequence": "int64", "latency_ms": "float64"})

    def close(self) -> None:
        pass


def _saved(state, before: list, now: list) -> None:
    """A queue that only grew is appended to; one that lost its head is written anew."""
    if not now:
        state.clear()
    elif now[: len(before)] == before:
        if now[len(before) :]:
            state.appendList(now[len(before) :])
    else:
        state.put(now)


def paired_stream(rows: DataFrame, wait: bool = False) -> DataFrame:
    """A stream of PAIR_INPUT rows (chunks by sequence, final events by event_id, and with wait the session's end) to a stream of
    PAIR_OUTPUT rows: the k-th event with the k-th chunk; an event without one has sequence -1 and no latency."""
    return rows.groupBy("session_id").transformWithStateInPandas(Pairs(wait), outputStructType=PAIR_OUTPUT, outputMode="Append", timeMode="None")
