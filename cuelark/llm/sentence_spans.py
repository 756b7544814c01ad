"""Substring dedup by sliding sentence spans.

A text is cut into sentences, which end behind [.!?] and a space, or with a line. Sentences of over SPAN words are
cut further, behind the word with the smallest CRC (the last such) of every SPAN consecutive words, so that no piece
has more than SPAN words and a passage is cut alike wherever it stands, but for its first SPAN - 1 and last SPAN words.
A span is a run of consecutive pieces that begins at any piece and ends with the first by which it has RUN_WORDS words, so that no
phrase shorter than that is ever removed. The words between the first and the last cut that a passage of over 50 words has
everywhere are at least 22, so that it holds a whole span wherever it stands.
Every span, lower-cased and with single spaces, is hashed to 128 bits and
looked up in the whole corpus. Its first occurrence, by (doc_id, place), stays; of every other occurrence all
pieces are removed. Pieces are judged on the input, not on what is left.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, keyed, small, written
from .near_dedup import mixed_bits
from .packed import HIT, Entries, resolved

RUN_WORDS = 20
SPAN = 8
#: Odd numbers: place k of a text weighs its k-th power, which has an inverse modulo 2**64.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_END = re.compile(rb"[.!?]+(?=[\x20\x09-\x0d])[\x20\x09-\x0d]*|\n\s*")
_SPACE = b" \t\n\v\f\r"
_WORD = re.compile(rb"[^\x20\x09-\x0d]+[\x20\x09-\x0d]*")


def sentence_ends(text: bytes) -> list[int]:
    """Where each sentence ends, with the space behind it; the last ends with the text. Together they cover it."""
    if not text:
        return []
    ends = np.unique([m.end() for m in _END.finditer(text)] + [len(text)])
    words = _WORD.findall(text)
    if len(words) <= SPAN:
        return ends.tolist()
    start = len(text) - len(text.lstrip(_SPACE))
    behind = start + np.cumsum([len(w) for w in words])
    of = np.searchsorted(ends, behind)  # each word's sentence
    crc = np.array([zlib.crc32(w.rstrip(_SPACE).lower()) for w in words], np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(crc, SPAN)
    least = np.arange(len(windows)) + SPAN - 1 - windows[:, ::-1].argmin(1)
    within = (of[: len(windows)] == of[SPAN - 1 :]) & (np.bincount(of)[of[: len(windows)]] > SPAN)
    return np.union1d(ends, behind[least[within]]).tolist()


def span_ends(n_words: np.ndarray) -> np.ndarray:
    """For each piece of a text the number behind the last piece of the span that begins with it; 0 where too few words follow."""
    upto = np.concatenate([[0], np.cumsum(n_words)])
    end = np.searchsorted(upto, upto[:-1] + RUN_WORDS)
    return np.where(end < len(upto), end, 0)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _hashes(texts: list[bytes]):
    """(hash, second hash, document, place) of every span, place being the number of its first piece in the document."""
    flat, sizes, begin, end = [], [], [], []
    for t in texts:
        start, n_words, at = 0, [], len(flat)
        for e in sentence_ends(t):
            words = t[start:e].lower().split()
            flat.append(b" ".join(words).decode("utf-8", "surrogateescape"))
            n_words.append(len(words))
            start = e
        sizes.append(len(n_words))
        behind = span_ends(np.array(n_words, np.int64))
        own = np.flatnonzero(behind)
        begin.append(at + own)
        end.append(at + behind[own])
    sizes = np.array(sizes, np.int64)
    begin, end = (np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in (begin, end))
    code, known = pd.factorize(np.array(flat, object)) if flat else (np.zeros(0, np.int64), [])
    doc = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    hashes = []
    for base, key in zip(_BASES, ("0123456789123456", "fedcba9876543210"), strict=True):
        h = pd.util.hash_array(np.asarray(known, object), hash_key=key, categorize=False)[code] if flat else np.zeros(0, np.uint64)
        upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * _powers(base, len(h)), dtype=np.uint64)])
        back = _powers(pow(base, -1, 2**64), len(h))
        # the sum over a span of hash times power, as if the span stood at the start, and how many pieces it has
        hashes.append(mixed_bits((upto[end] - upto[begin]) * back[begin] + (end - begin).astype(np.uint64)))
    return *hashes, doc[begin], place[begin]


def _first_of_each(a: np.ndarray, b: np.ndarray, doc: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Whether an entry is the first of its (a, b) by (doc, place)."""
    order = np.lexsort((place, doc, b, a))
    first = np.ones(len(a), bool)
    first[order[1:]] = (a[order[1:]] != a[order[:-1]]) | (b[order[1:]] != b[order[:-1]])
    return first


def _runs(texts: list[bytes], uid: np.ndarray) -> Entries:
    a, b, doc, place = _hashes(texts)
    return Entries(a, b, doc, place, np.where(_first_of_each(a, b, uid[doc], place), 0, HIT))


def _repeats(a, b, doc, place) -> np.ndarray:
    return np.where(_first_of_each(a, b, doc, place), 0, HIT)


def cut_out(text: bytes, starts: np.ndarray) -> tuple[bytes, int]:
    """text without the pieces of the spans that begin at `starts`, and how many these are."""
    ends = np.array([0, *sentence_ends(text)])
    behind = span_ends(np.array([len(text[a:b].split()) for a, b in zip(ends[:-1], ends[1:], strict=True)], np.int64))
    edge = np.zeros(len(ends), np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, behind[starts], -1)
    gone = np.cumsum(edge)[:-1] > 0
    parts = [text[ends[i] : ends[i + 1]] for i in np.flatnonzero(~gone)]
    return b"".join(parts), int(gone.sum())


def _without(batches):
    for batch in small(batches):
        made = []
        for text, hits in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("hits").to_pylist(), strict=True):
            text = text or b""
            rest, n = cut_out(text, np.frombuffer(hits, np.int32)) if hits else (text, 0)
            made.append((len(text), n, len(text) - len(rest), rest.decode()))
        n_bytes, gone, removed, rest = zip(*made, strict=True)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *[pa.array(x, k) for x, k in zip((n_bytes, gone, removed, rest), kinds, strict=True)]],
            ["doc_id", "n_bytes", "n_sentences_removed", "n_removed", "kept_text"],
        )


def without_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_sentences_removed, n_removed (bytes), kept_text.

    A null text counts as empty; texts of under RUN_WORDS words keep everything. Of rows with one doc_id and a
    common span, or of one text that repeats itself, the first in (doc_id or row number, place) keeps it.
    Other columns are ignored; an empty table gives an empty result.
    """
    rows = keyed(docs, "text")
    texts = rows.select("doc_id", F.col("uid").cast("long").alias("uid"), "text")
    found = written(resolved(texts, _runs, _repeats, rows.count()).select("uid", "hits"), "repeats")
    joined = texts.join(found.hint("merge"), "uid", "left").select("doc_id", "text", "hits")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(_without, f"doc_id {kind}, n_bytes long, n_sentences_removed long, n_removed long, kept_text string")


def op5_substring_dedup(spark, sf_dir):
    return without_repeats(documents(spark, sf_dir))
