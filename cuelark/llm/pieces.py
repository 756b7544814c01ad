"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a single-pass Viterbi.

Texts are taken byte by byte, with a space as the mark that starts a piece. At each byte the automaton moves
once; the output links of its state name every piece that ends there, and each of them relaxes the best score
at that position from the best score at its start. A byte that no piece covers has its byte piece. Decoding
joins the pieces' bytes, which gives back every text exactly.

The vocabulary file is a merge-rank model: its scores are ranks, not probabilities. They are read as
log-probabilities by Zipf's law, -log(1 + rank); byte pieces lie BYTE_PENALTY below the last. Equal scores
go to the longest last piece. No piece reaches over the start of a run of spaces or over a byte that stands
in no longer piece, so texts are cut there and each distinct unit of a batch is encoded once, all units in step.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import bounded, documents, small

MARK = "▁"
SPACE = 0xFF  # stands for a space; never in UTF-8
BYTE_PENALTY = 10.0
LONGEST = 48  # bytes of a unit that is encoded in step with others
AT_ONCE = 8192  # units that are encoded in step
UNIT = re.compile(rb"\xff*[^\xff\n]+|\xff+|\n")


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Automaton:
    """The pieces (id, bytes, score) with goto and output links over bytes.

    first[s] is the nearest state on the fail chain of s, itself included, at which a piece ends; link[s] is the
    next such state behind s. 0, the root, ends both.
    """

    def __init__(self, pieces: list[bytes], scores: np.ndarray, byte_ids: np.ndarray, byte_score: float):
        self.bytes_of, self.byte_ids, self.byte_score = pieces, byte_ids, byte_score
        children, depth, ends = [{}], [0], {}
        for i, piece in enumerate(pieces):
            if not piece or np.isnan(scores[i]):
                continue
            s = 0
            for b in piece:
                if b not in children[s]:
                    children[s][b] = len(children)
                    children.append({})
                    depth.append(depth[s] + 1)
                s = children[s][b]
            ends[s] = i
        n = len(children)
        self.goto = np.zeros((n, 256), np.int32)
        self.piece = np.full(n, -1, np.int32)
        self.length = np.array(depth, np.int32)
        for s, i in ends.items():
            self.piece[s] = i
        self.score = np.where(self.piece >= 0, scores[self.piece], 0.0)
        self.first, self.link = np.zeros(n, np.int32), np.zeros(n, np.int32)
        fail, queue = [0] * n, [0]
        for s in queue:
            f = fail[s]
            if s:
                self.goto[s] = self.goto[f]
                self.link[s] = self.first[f]
                self.first[s] = s if self.piece[s] >= 0 else self.first[f]
            for b, c in children[s].items():
                fail[c] = int(self.goto[f, b]) if s else 0
                self.goto[s, b] = c
                queue.append(c)
        sizes = [len(x) for x in pieces]
        self.piece_at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.piece_bytes = np.frombuffer(b"".join(pieces), np.uint8)

    def encode_one(self, unit: bytes) -> list[int]:
        """The same steps for one long unit."""
        n, state = len(unit), 0
        best, last, size = [0.0] * (n + 1), [0] * (n + 1), [1] * (n + 1)
        goto, first, link, length, score, piece = self.goto, self.first, self.link, self.length, self.score, self.piece
        for p, b in enumerate(unit):
            state = int(goto[state, b])
            most, which, long = -np.inf, 0, 1
            s = int(first[state])
            while s:
                k = int(length[s])
                if (x := best[p + 1 - k] + float(score[s])) > most:
                    most, which, long = x, int(piece[s]), k
                s = int(link[s])
            if (x := best[p] + self.byte_score) > most:
                most, which, long = x, int(self.byte_ids[b]), 1
            best[p + 1], last[p + 1], size[p + 1] = most, which, long
        out = []
        while n:
            out.append(last[n])
            n -= size[n]
        return out[::-1]

    def encode_units(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all units, one after another, and the offsets of each."""
        lens = np.array([len(u) for u in units], np.int64)
        return self.encode_flat(np.frombuffer(b"".join(units), np.uint8), np.concatenate([[0], np.cumsum(lens)]))

    def encode_flat(self, raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """encode_units() of units that lie one after another; AT_ONCE of them, of like lengths, go in step."""
        lens, counts = np.diff(ends), np.zeros(len(ends) - 1, np.int64)
        short = np.flatnonzero(lens <= LONGEST)
        short = short[np.argsort(-lens[short], kind="stable")]
        steps = []
        for k in range(0, len(short), AT_ONCE):
            part = short[k : k + AT_ONCE]
            for cols, ids in self._in_step(raw, ends[part], lens[part]):
                steps.append((part[cols], counts[part[cols]], ids))
                counts[part[cols]] += 1
        long_ones = {int(u): self.encode_one(raw[ends[u] : ends[u + 1]].tobytes()) for u in np.flatnonzero(lens > LONGEST)}
        for u, ids in long_ones.items():
            counts[u] = len(ids)
        offsets = np.concatenate([[0], np.cumsum(counts)])
        out = np.zeros(offsets[-1], np.int32)
        for units, k, ids in steps:  # from the last piece back
            out[offsets[units + 1] - 1 - k] = ids
        for u, ids in long_ones.items():
            out[offsets[u] : offsets[u + 1]] = ids
        return out, offsets

    def _in_step(self, raw: np.ndarray, begin: np.ndarray, lens: np.ndarray):
        """Units, the longest first, to (which of them, their next id from the end)."""
        m, width = len(lens), int(lens.max(initial=0))
        best = np.zeros((width + 1, m))
        last, size = np.zeros((width + 1, m), np.int32), np.ones((width + 1, m), np.int32)
        state, own = np.zeros(m, np.int32), -lens
        for p in range(width):
            live = int(np.searchsorted(own, -p, "left"))  # units longer than p come first
            b = raw[begin[:live] + p]
            state[:live] = self.goto[state[:live], b]
            most = np.full(live, -np.inf)
            which, long = np.zeros(live, np.int32), np.ones(live, np.int32)
            s = self.first[state[:live]]
            at = np.flatnonzero(s)
            s = s[at]
            while len(at):
                k = self.length[s]
                x = best[p + 1 - k, at] + self.score[s]
                better = x > most[at]
                to = at[better]
                most[to], which[to], long[to] = x[better], self.piece[s[better]], k[better]
                s = self.link[s]
                more = s > 0
                at, s = at[more], s[more]
            x = best[p, :live] + self.byte_score
            byte = x > most
            most[byte], which[byte], long[byte] = x[byte], self.byte_ids[b[byte]], 1
            best[p + 1, :live], last[p + 1, :live], size[p + 1, :live] = most, which, long
        at, cols = lens.copy(), np.flatnonzero(lens)
        while len(cols):
            rows = at[cols]
            yield cols, last[rows, cols]
            at[cols] = rows - size[rows, cols]
            cols = cols[at[cols] > 0]

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (UTF-8), one after another, and the offsets of each."""
        units = [UNIT.findall(t.replace(b" ", b"\xff")) for t in texts]
        lens = np.array([len(x) for x in units], np.int64)
        flat = np.empty(lens.sum(), object)
        flat[:] = [u for x in units for u in x]
        code, known = pd.factorize(flat)
        ids, offsets = self.encode_units(list(known))
        out, ends = gathered(ids, offsets, code)
        return out, ends[np.concatenate([[0], np.cumsum(lens)])]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of a run of ids."""
        out = gathered(self.piece_bytes, self.piece_at, ids)[0]
        return np.where(out == SPACE, np.uint8(32), out)


def gathered(values: np.ndarray, offsets: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of the given rows of a ragged array, one after another, and the new offsets."""
    sizes = offsets[rows + 1] - offsets[rows]
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return values[np.arange(ends[-1]) - np.repeat(ends[:-1] - offsets[rows], sizes)], ends


@lru_cache(maxsize=1)
def automaton(model: str) -> Automaton:
    """The automaton of a model file; built once in each Python worker."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=model)
    n = sp.get_piece_size()
    pieces, ranks, byte_ids = [], np.full(n, np.nan), np.zeros(256, np.int32)
    for i in range(n):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            b = int(piece[3:5], 16)
            byte_ids[b] = i
            pieces.append(bytes([b]))
        elif sp.is_control(i) or sp.is_unknown(i):
            pieces.append(b"")
        else:
            pieces.append(piece.replace(MARK, "￾").encode().replace("￾".encode(), bytes([SPACE])))
            ranks[i] = -sp.get_score(i)
    scores = -np.log1p(np.maximum(ranks, 0))
    byte_ids[SPACE] = byte_ids[32]
    for i, p in enumerate(pieces):  # cuts are safe only if no piece reaches over one
        if not np.isnan(ranks[i]) and (re.search(rb"[^\xff]\xff", p) or (b"\n" in p and len(p) > 1)):
            raise ValueError(f"piece {sp.id_to_piece(i)!r} reaches over the start of a word")
    return Automaton(pieces, scores, byte_ids, float(np.nanmin(scores)) - BYTE_PENALTY)


def _encoded(model: str):
    def run(batches):
        a = automaton(model)
        for batch in small(batches, 1024, 2**22):
            texts = [x or b"" for x in batch.column("text").cast(pa.binary()).to_pylist()]
            ids, ends = a.encode(texts)
            lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))
            own = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), pa.array(np.diff(ends)), lists], [*own, "n_pieces", "ids"])

    return run


def encoded(docs: DataFrame, model: str | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document: the columns in `keep`, n_pieces and ids (array of int).

    A null text counts as empty and has no pieces; repeated rows are encoded alike; other columns are ignored.
    """
    bounded(docs.sparkSession)
    kept = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*keep, "text").mapInArrow(_encoded(model or default_model()), f"{kept}, n_pieces long, ids array<int>")


def _decoded(model: str):
    def run(batches):
        a = automaton(model)
        for batch in batches:
            ids = batch.column("ids")
            made = [None if x is None else a.decode(np.array(x, np.int32)).tobytes().decode() for x in ids.to_pylist()]
            own = [c for c in batch.schema.names if c != "ids"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), pa.array(made, pa.string())], [*own, "text"])

    return run


def decoded(rows: DataFrame, model: str | None = None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """rows with ids to the columns in `keep` and text. Null ids give null, no ids the empty text."""
    bounded(rows.sparkSession)
    kept = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.select(*keep, "ids").mapInArrow(_decoded(model or default_model()), f"{kept}, text string")


def _round_trip(model: str):
    def run(batches):
        a = automaton(model)
        for batch in small(batches, 1024, 2**22):
            texts = [x or b"" for x in batch.column("text").cast(pa.binary()).to_pylist()]
            ids, ends = a.encode(texts)
            back, at = a.decode(ids).tobytes(), np.concatenate([[0], np.cumsum(np.diff(a.piece_at)[ids])])[ends]
            parts = [back[at[i] : at[i + 1]] for i in range(len(texts))]
            made = [
                pa.array(np.array([len(t) for t in texts], np.int64)), pa.array(np.diff(ends)),
                pa.array([hashlib.sha256(p).hexdigest() for p in parts], pa.string()), pa.array([p == t for p, t in zip(parts, texts, strict=True)], pa.bool_()),
                pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids)),
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made], ["doc_id", "n_bytes", "n_pieces", "decoded_sha256", "exact", "ids"])

    return run


def round_trip(docs: DataFrame, model: str | None = None) -> DataFrame:
    """encoded() and decoded() in one pass: doc_id, n_bytes, n_pieces, decoded_sha256, exact (same as the text), ids."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = f"doc_id {kind}, n_bytes long, n_pieces long, decoded_sha256 string, exact boolean, ids array<int>"
    return docs.select("doc_id", "text").mapInArrow(_round_trip(model or default_model()), columns)


def op9_sentencepiece(spark, sf_dir):
    return round_trip(documents(spark, sf_dir))
