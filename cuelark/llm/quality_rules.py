"""Quality rules: a hashed n-gram log-likelihood ratio between a trusted and the raw corpus, over base counts.

Two multinomials over BUCKETS hashed byte 4-grams are counted, one over every labelled good document and
one over every document. A document's score is the mean of log(trusted / raw) over its 4-grams, and it is kept
when that is THRESHOLD or more and the base rules don't reject it. Threshold and rules are fixed numbers, the
same for every size. What leaves the tasks is BUCKETS counts each, whatever the corpus holds.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, documents, small

BUCKETS = 2**16
THRESHOLD = -0.25
FLOOR = 0.01
MIN_WORDS = 50
AT_ONCE = 256  # documents whose words are numbered together
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RULES = ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, score double, kept boolean"

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_IN_WORD = ~_SPACE & ~((np.arange(256) >= 0x80) & (np.arange(256) < 0xC0))
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """All bytes of a text column, the offsets of its rows, and the rows; null is empty."""
    rows = [x or b"" for x in column.cast(pa.binary()).to_pylist()]
    buffer = np.frombuffer(b"".join(rows), np.uint8)
    return buffer, np.concatenate([[0], np.cumsum([len(x) for x in rows], dtype=np.int64)]), rows


def per_row(flags: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.float64 if flags.dtype.kind == "f" else np.int64)])
    return sums[ends[1:]] - sums[ends[:-1]]


def buckets(buffer: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of the 4-gram at each byte but the last three, and whether it lies within one row."""
    if len(buffer) < 4:
        return np.zeros(0, np.uint32), np.zeros(0, bool)
    b = buffer.astype(np.uint32)
    grams = b[:-3] | (b[1:-2] << 8) | (b[2:-1] << 16) | (b[3:] << 24)
    grams *= np.uint32(0x9E3779B1)
    inside = np.ones(len(grams), bool)
    for k in (1, 2, 3):
        at = ends[1:-1] - k
        inside[at[(at >= 0) & (at < len(grams))]] = False
    return grams >> np.uint32(32 - BUCKETS.bit_length() + 1), inside


def _counted(batches):
    total = np.zeros(BUCKETS, np.int64)
    for batch in small(batches):
        buffer, ends, _ = raw_bytes(batch.column("text"))
        gram, inside = buckets(buffer, ends)
        total += np.bincount(gram[inside], minlength=BUCKETS)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])


def counts(docs: DataFrame) -> np.ndarray:
    """How often each bucket occurs in every text; BUCKETS rows come to the driver."""
    bounded(docs.sparkSession)
    rows = docs.select("text").mapInArrow(_counted, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BUCKETS)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def repeated_words(rows: list[list[bytes]]) -> np.ndarray:
    """For each list of words, how many lie in a window of three words that the list holds twice or more."""
    out = np.zeros(len(rows), np.int64)
    for a in range(0, len(rows), AT_ONCE):
        part = rows[a : a + AT_ONCE]
        lens = np.array([len(x) for x in part], np.int64)
        words = np.empty(lens.sum(), object)
        words[:] = [w for x in part for w in x]
        code, known = pd.factorize(words)
        doc = np.repeat(np.arange(len(part)), lens)
        n = max(len(known), 1)
        if len(code) < 3:
            continue
        at = np.flatnonzero(doc[2:] == doc[:-2])
        key = code[at] * n + code[at + 1]
        if n**3 * len(part) >= 2**63:
            key = np.unique(key, return_inverse=True)[1]
            key = np.unique(key * n + code[at + 2], return_inverse=True)[1] * len(part) + doc[at]
        else:
            key = (key * n + code[at + 2]) * len(part) + doc[at]
        order = np.argsort(key, kind="stable")
        twin = key[order][1:] == key[order][:-1]
        again = np.zeros(len(at), bool)
        again[order[1:][twin]] = True
        again[order[:-1][twin]] = True
        covered = np.zeros(len(code), bool)
        for k in range(3):
            covered[at[again] + k] = True
        out[a : a + AT_ONCE] = np.bincount(doc[covered], minlength=len(part))
    return out


def _ruled(ratio: np.ndarray, threshold: float):
    def run(batches):
        for batch in small(batches):
            buffer, ends, rows = raw_bytes(batch.column("text"))
            words = [x.split() for x in rows]
            n_words = np.array([len(x) for x in words], np.int64)
            dup = np.zeros(len(rows), np.int64)
            for i, x in enumerate(rows):
                lines = [y for y in x.split(b"\n") if y and not y.isspace()]
                dup[i] = len(lines) - len(set(lines))
            repeat = repeated_words(words)
            failed = (n_words < MIN_WORDS) | (100 * repeat > 50 * n_words)
            gram, inside = buckets(buffer, ends)
            llr = np.zeros(len(buffer), np.float32)
            n = np.zeros(len(buffer), bool)
            llr[: len(gram)] = np.where(inside, ratio[gram], 0)
            n[: len(gram)] = inside
            score = per_row(llr, ends) / np.maximum(per_row(n, ends), 1)
            made = [n_words, per_row(_IN_WORD[buffer], ends), per_row(_SYMBOL[buffer], ends), dup, repeat, failed, score, ~failed & (score >= threshold)]
            names = [*COUNTS, "base_failed", "score", "kept"]
            own = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), *map(pa.array, made)], [*own, *names])

    return run


def log_ratio(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """log(trusted / raw) for each bucket, trusted being mixed with FLOOR parts of raw, so that corpora of any size
    are smoothed alike; zeros where no document is labelled good."""
    good = labels.where("quality = 1").select("doc_id")
    trusted = counts(docs.join(good.hint("merge"), "doc_id", "left_semi"))  # neither side has a bound
    raw = counts(docs)
    out = np.zeros(BUCKETS, np.float32)
    seen = raw > 0
    if trusted.any():
        share = (trusted[seen] / trusted.sum()) / (raw[seen] / raw.sum())
        out[seen] = np.log((share + FLOOR) / (1 + FLOOR))
    return out


def judged(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, the five counts, base_failed, score and kept.

    A null or empty text has no words and fails the base rules, as any text under 50 words does. A text
    under four bytes scores 0. Repeated rows are judged alike; other columns are ignored; without good
    labels every score is 0, so that the base rules alone decide. An empty table gives an empty result.
    """
    ratio = log_ratio(docs, labels)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_ruled(ratio, threshold), f"doc_id {kind}, {RULES}")


def _only_kept(ratio: np.ndarray, threshold: float, columns: list[str]):
    rule = _ruled(ratio, threshold)

    def run(batches):
        for batch in small(batches):
            texts = pa.RecordBatch.from_arrays([batch.column(columns.index("text"))], ["text"])
            kept = pa.concat_arrays([x.column("kept") for x in rule([texts])])
            yield batch.filter(kept)

    return run


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs without those that are not kept; columns unchanged."""
    return docs.mapInArrow(_only_kept(log_ratio(docs, labels), threshold, docs.columns), docs.schema)


def op7_quality_rules(spark, sf_dir):
    return judged(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
