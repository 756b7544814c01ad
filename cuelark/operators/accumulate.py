"""Merging partial, final, overlapping and late word events of a session into one monotonic transcript.

`apply_event` is the rule for one event; batch and streaming runs share it. State is the tail of the committed words
that can still match a new one, the pending words, the last final time and the sequence seen last.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.words import CUTSET
from .sorted_runs import in_order

END_TOLERANCE, TIMING_TOLERANCE, LOOK_BACK = 0.05, 0.35, 1.0
PARTIAL, FINAL = "partial", "final_words"


@dataclass
class State:
    committed: list[tuple[str, float, float]] = field(default_factory=list)  # the tail only
    pending: list[tuple[str, float, float]] = field(default_factory=list)
    n_committed: int = 0
    last_final: float = 0.0
    sequence: int | None = None
    finalised: bool = False


@lru_cache(maxsize=2**16)
def form(word: str) -> str:
    return word.strip(CUTSET).strip().lower()


def sequence_error(state: State, kind: str, sequence: int) -> str | None:
    """Negative sequences are not checked; a lower one, and one that was finalised, is an error."""
    if sequence < 0:
        return None
    if state.sequence is not None and sequence < state.sequence:
        return f"out of order: {sequence} after {state.sequence}"
    if state.sequence == sequence and state.finalised:
        return f"already finalised: {sequence}"
    state.finalised = kind == FINAL or (state.sequence == sequence and state.finalised)
    state.sequence = sequence
    return None


def accepted(state: State, words) -> list[tuple[str, float, float]]:
    """The words that are not blank, end late enough and repeat neither a committed one nor one before them here."""
    out = []
    for word, start, end in words:
        if not word.strip() or end <= state.last_final + END_TOLERANCE:
            continue
        for seen in (*reversed(out), *reversed(state.committed)):
            if seen[2] < start - LOOK_BACK:
                out.append((word, start, end))
                break
            if abs(seen[1] - start) <= TIMING_TOLERANCE and abs(seen[2] - end) <= TIMING_TOLERANCE and form(seen[0]) == form(word):
                break
        else:
            out.append((word, start, end))
    return out


def apply_event(state: State, kind: str, sequence: int, up_to: float, words) -> tuple[list[tuple[str, float, float]], str | None]:
    """The words that the event commits, and its error."""
    if error := sequence_error(state, kind, sequence):
        return [], error
    if kind not in (PARTIAL, FINAL):
        return [], f"unknown type: {kind}"
    new = accepted(state, words)
    if kind == PARTIAL:
        state.pending = new
        return [], None
    state.committed += new
    state.n_committed += len(new)
    state.last_final = max([state.last_final, up_to, *(w[2] for w in new)])
    state.pending = accepted(state, state.pending)
    # a later word ends behind last_final, so what ends this much earlier can match none
    state.committed = [w for w in state.committed if w[2] > state.last_final + END_TOLERANCE - TIMING_TOLERANCE]
    return new, None


def full_words(texts, starts, ends) -> list[tuple[str, float, float]]:
    """An event's words as tuples, without those that lack a text, a start or an end."""
    if texts is None:
        return []
    return [w for w in zip(texts, starts, ends, strict=True) if not any(x is None or x != x for x in w)]


COMMITTED = "arrival long, sequence long, position int, word string, start_time double, end_time double, last_final double, error string, pending string"
EVENT = ("arrival", "type", "sequence", "up_to", "error", "texts", "starts", "ends")


def flat(events: DataFrame, *more: str) -> DataFrame:
    """Events with the columns of EVENT behind `more`: the words as three arrays, and `error` null where it is not known."""
    error = F.col("error") if "error" in events.columns else F.lit(None).cast("string").alias("error")
    words = [F.col(f"words.{x}").alias(y) for x, y in (("word", "texts"), ("start_time", "starts"), ("end_time", "ends"))]
    number = [F.col("arrival").cast("long").alias("arrival"), "type", F.col("sequence").cast("long").alias("sequence"), F.col("up_to").cast("double").alias("up_to")]
    return events.select(*more, *number, error, *words)


def applied(state: State, rows: Iterable[tuple], known: bool = False) -> Iterator[tuple]:
    """EVENT rows of one session in the order of arrival, which alone counts, to COMMITTED rows: sequences are checked against
    what came before, unless rows say in `error` what that check has found (known). A null sequence is not checked. Words without a
    text, a start or an end do not count. One row for each committed word, for each error, and for each partial event with what is then pending."""
    for arrival, kind, sequence, up_to, error, texts, starts, ends in rows:
        at, sequence, new = state.n_committed, -1 if sequence is None or sequence != sequence else int(sequence), []
        if not (known and error is not None):
            new, error = apply_event(state, kind, -1 if known else sequence, 0.0 if up_to is None or up_to != up_to else float(up_to), full_words(texts, starts, ends))
        for k, (word, start, end) in enumerate(new):
            yield arrival, sequence, at + k, word, start, end, state.last_final, None, None
        if error or kind == PARTIAL:
            yield arrival, sequence, None, None, None, None, state.last_final, error, " ".join([w[0] for w in state.pending])


def event_rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    """The columns of EVENT of a batch as rows."""
    def lists(name: str) -> Iterator[list | None]:
        column = batch.column(name)
        sizes, values, at = pc.list_value_length(column).to_pylist(), column.flatten().to_pylist(), 0
        for n in sizes:
            yield None if n is None else values[at : at + n]
            at += n or 0

    return zip(*[batch.column(c).to_pylist() for c in EVENT[:5]], *[lists(c) for c in EVENT[5:]], strict=True)


_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64()}
ROWS = 2**15  # rows that a fold puts out together


def folded(keys: list[str], begin: Callable[..., State], known: bool = False, end: Callable[[State], tuple] | None = None, more: tuple[str, ...] = ()):
    """Batches of sorted events, to (keys, COMMITTED): a fold over each key from the state that `begin` makes of the key's first
    values of `more`. What is held is a state and a batch, however long a session is. With `end`, a row of it behind each key."""
    names = [*keys, *[c.split()[0] for c in COMMITTED.split(", ")]]
    n = len(keys)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, key, state, kinds = [], None, None, None

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            kinds = [*[batch.schema.field(k).type for k in keys], *[_TYPES[c.split()[1]] for c in COMMITTED.split(", ")]]
            first = zip(*[batch.column(c).to_pylist() for c in (*keys, *more)], strict=True)
            for values, row in zip(first, event_rows(batch), strict=True):
                if state is None or values[:n] != key:
                    if state is not None and end:
                        out.append((*key, *end(state)))
                    key, state = values[:n], begin(*values[n:])
                for made in applied(state, (row,), known):
                    out.append((*key, *made))
                if len(out) >= ROWS:
                    yield batch_of(out)
                    out = []
        if state is not None and end:
            out.append((*key, *end(state)))
        if out:
            yield batch_of(out)

    return run


def accumulated(events: DataFrame, key: str = "session_id") -> DataFrame:
    """(key, arrival, type, sequence, up_to, words array<struct<word, start_time, end_time>>) to committed words, previews and errors."""
    kind = events.schema[key].dataType.simpleString()
    return in_order(flat(events.drop("error"), key), [key], ["arrival"], folded([key], State), f"{key} {kind}, {COMMITTED}")
