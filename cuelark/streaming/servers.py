"""The rules of session servers: connections that bind sessions, and sessions that connections share.

A server's registry is one key. Its state is two maps: which session a connection is bound to, and each session's own
state; a micro-batch reads and writes only the entries that its events touch. The batch form runs the same rule over a
server's events in the order of their arrival.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, MutableMapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from .transcripts import SESSION_OUT, given, step

SERVER_EVENT = "server string, connection string, session_id string, arrival long, at double, type string, sequence long, pts double, duration double, sample_rate int, channels int, format string, n_bytes long"
SERVER_OUT = f"server string, connection string, {SESSION_OUT}"
COLUMNS = [c.split()[0] for c in SERVER_OUT.split(", ")]
IDLE_SECONDS, PARTIAL_SECONDS = 300.0, 1.0


def handled(bound: MutableMapping, sessions: MutableMapping, r, idle_seconds: float = IDLE_SECONDS, partial_seconds: float = PARTIAL_SECONDS) -> tuple[str, list[tuple]]:
    """One event: the session that answers, and its rows (type, sequence, start, up_to, seconds, code).

    A connection is bound by the first start that creates a session, and any later start on it is a protocol error. Events of a
    bound connection go to the session of that name, whoever has started it since. A session that no event has
    touched for over idle_seconds is gone when one looks for it (with idle_seconds 0, or times that are not known, it stays).
    A stop and a `disconnect` close the session and free the connection. Fields that are left out have the protocol's defaults.
    """
    kind, connection = given(r.type, "").strip(), given(r.connection, "")
    error = lambda code: [("error", None, None, None, None, code)]
    now = None if pd.isna(r.at) else float(r.at)

    def found(name: str) -> dict | None:
        s = sessions.get(name)
        if s is not None and idle_seconds > 0 and now is not None and s.get("at") is not None and now - s["at"] > idle_seconds:
            del sessions[name]
            return None
        return s

    own = bound.get(connection)
    if kind == "disconnect":
        if own is not None:
            sessions.pop(own, None)
            del bound[connection]
        return own or "", []
    if kind == "start":
        if own is not None:
            return own, error("protocol-error")
        name = given(r.session_id, "").strip()
        if name and found(name) is not None:
            return name, error("session-already-exists")
        s, rows = step(None, r, partial_seconds)
        if s is not None:
            sessions[name], bound[connection] = s | {"at": now}, name
        return name, rows
    if own is None:
        return "", error("session-not-started")
    s = found(own)
    if s is None:
        return own, error("session-not-found")
    s, rows = step(s | {"at": s.get("at") if now is None else now}, r, partial_seconds)
    if s is None:
        del sessions[own], bound[connection]
    else:
        sessions[own] = s
    return own, rows


class _Entries(dict):
    """Entries of a MapState as far as they were touched; the others are read when they are asked for."""

    def __init__(self, state, load, dump):
        super().__init__()
        self.state, self.load, self.dump, self.read = state, load, dump, set()

    def get(self, name, default=None):
        if name not in self.read:
            self.read.add(name)
            if self.state.containsKey((name,)):
                self[name] = self.load(self.state.getValue((name,))[0])
        return super().get(name, default)

    def pop(self, name, default=None):
        self.read.add(name)
        return super().pop(name, default)

    def save(self) -> None:
        for name in self.read | set(self):
            if name in self:
                self.state.updateValue((name,), (self.dump(self[name]),))
            elif self.state.containsKey((name,)):
                self.state.removeKey((name,))


class Servers(StatefulProcessor):
    """SERVER_EVENT rows in, SERVER_OUT rows out. Entries that no event has touched for keep_ms are dropped from the state."""

    def __init__(self, idle_seconds: float, partial_seconds: float, keep_ms: int | None):
        self.idle_seconds, self.partial_seconds, self.keep_ms = idle_seconds, partial_seconds, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.bound = handle.getMapState("bound", "connection string", "session_id string", self.keep_ms)
        self.sessions = handle.getMapState("sessions", "session_id string", "state string", self.keep_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        bound, sessions = _Entries(self.bound, str, str), _Entries(self.sessions, json.loads, json.dumps)
        yield _answered(key[0], pd.concat(list(rows)), bound, sessions, self.idle_seconds, self.partial_seconds)
        bound.save()
        sessions.save()

    def close(self) -> None:
        pass


def _answered(server, rows: pd.DataFrame, bound, sessions, idle_seconds: float, partial_seconds: float) -> pd.DataFrame:
    out = []
    for r in rows.sort_values("arrival", kind="stable").itertuples(index=False):
        name, made = handled(bound, sessions, r, idle_seconds, partial_seconds)
        out += [(server, given(r.connection, ""), name, r.arrival, *m) for m in made]
    return pd.DataFrame(out, columns=COLUMNS).astype({"sequence": "Int64", "arrival": "int64"})


def server_stream(events: DataFrame, idle_seconds: float = IDLE_SECONDS, partial_seconds: float = PARTIAL_SECONDS, keep_ms: int | None = None) -> DataFrame:
    """A stream of SERVER_EVENT rows to a stream of SERVER_OUT rows. With keep_ms the state store forgets by processing time, and
    the query must run with a trigger of its own."""
    mode = "None" if keep_ms is None else "ProcessingTime"
    return events.groupBy("server").transformWithStateInPandas(Servers(idle_seconds, partial_seconds, keep_ms), outputStructType=SERVER_OUT, outputMode="Append", timeMode=mode)


def served(events: DataFrame, idle_seconds: float = IDLE_SECONDS, partial_seconds: float = PARTIAL_SECONDS) -> DataFrame:
    """The batch form: a server's events are one task, as they share its registry."""
    return events.groupBy("server").applyInPandas(lambda rows: _answered(rows.server.iloc[0], rows, {}, {}, idle_seconds, partial_seconds), SERVER_OUT)
