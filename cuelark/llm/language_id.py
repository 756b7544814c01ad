"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

A text is lower-cased, runs of what are no letters become one space, and its n-grams of 1 to ORDERS code points are counted in
BUCKETS hash buckets. A feature is (1 + log count) * (1 + log((1 + N) / (1 + df))), and a text's features have length 1; N and df
are counted over every document that may be learned from.

The weights are fitted by follow-the-regularised-leader with an elastic net: each coordinate has its own rate, is exactly
zero until its gradients outweigh L1, and is shrunk by L2. The fit runs on the driver over a bounded sample of whole texts: at most
TRAIN_TOTAL documents of together at most TRAIN_BYTES, both shared equally by the languages, the first in the order of a hash of
doc_id and text. The model knows at most LANGUAGES of them, the most frequent ones. One in VALIDATION documents of the sample is left
out of the fit; these set one temperature, which divides all logits, so that scores are calibrated probabilities.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded, documents, small

ORDERS, BUCKETS, PIECE = 4, 2**16, 2**20
TRAIN_TOTAL, TRAIN_BYTES, LANGUAGES, EPOCHS, VALIDATION = 2400, 2**26, 128, 3, 5
PARTS, SURPLUS = 2**20, 8
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.02
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
_NO_LETTER = re.compile(r"[\W\d_]+")


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def has_letter() -> Column:
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))


def counted(text: str) -> np.ndarray:
    """How often each bucket's n-grams occur in a text, which is taken PIECE places at a time."""
    c = np.frombuffer(f" {_NO_LETTER.sub(' ', text.lower()).strip()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.zeros(BUCKETS, np.int64)
    for a in range(0, len(c), PIECE):
        part, h = c[a : a + PIECE + ORDERS - 1], np.zeros(PIECE, np.uint32)
        for n in range(1, ORDERS + 1):
            here = min(PIECE, len(part) - n + 1)  # n-grams that begin in the piece
            if here <= 0:
                break
            h = (h[:here] * np.uint32(0x01000193)) ^ (part[n - 1 : n - 1 + here] * np.uint32(0x9E3779B1))
            mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)
            out += np.bincount(mixed >> np.uint32(32 - BUCKETS.bit_length() + 1), minlength=BUCKETS)
    return out


def features(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, values) of a text's TF-IDF vector, of length 1."""
    n = counted(text)
    at = np.flatnonzero(n)
    x = (1 + np.log(n[at])) * idf[at]
    return at, (x / np.sqrt(x @ x)).astype(np.float32)


def _seen(batches):
    df, n = np.zeros(BUCKETS, np.int64), 0
    for batch in small(batches):
        for text in batch.column("text").to_pylist():
            df += counted(text) > 0
            n += 1
    at = np.flatnonzero(df)
    yield pa.RecordBatch.from_pydict({"bucket": pa.array(np.append(at, -1).astype(np.int32)), "n": pa.array(np.append(df[at], n))})


def inverse_frequencies(texts: DataFrame) -> np.ndarray:
    """log((1 + N) / (1 + df)) + 1 of each bucket, over every text; at most BUCKETS + 1 rows come to the driver."""
    df, n = np.zeros(BUCKETS), 0
    for r in texts.select("text").mapInArrow(_seen, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        if r["bucket"] < 0:
            n = r["n"]
        else:
            df[r["bucket"]] = r["n"]
    return np.log((1 + n) / (1 + df)) + 1


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


class Leader:
    """Follow-the-regularised-leader for multinomial logistic regression. z holds the gradients less what the weights have moved,
    n the squared gradients; row BUCKETS is the intercept."""

    def __init__(self, n_classes: int):
        self.z, self.n = np.zeros((BUCKETS + 1, n_classes), np.float32), np.zeros((BUCKETS + 1, n_classes), np.float32)

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z = self.z[at]
        return np.where(np.abs(z) <= L1, 0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2))

    def step(self, at: np.ndarray, x: np.ndarray, label: int) -> float:
        """Learns one text; the loss before it did."""
        at, x = np.append(at, BUCKETS), np.append(x, np.float32(1))
        w = self.weights(at)
        p = softmax(x @ w)
        loss = -np.log(max(p[label], 1e-30))
        p[label] -= 1
        g = x[:, None] * p
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g
        return float(loss)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The T that makes softmax(logits / T) likeliest, by golden section over log T; 1 without rows."""
    if not len(labels):
        return 1.0
    rows = np.arange(len(labels))

    def loss(log_t: float) -> float:
        return -float(np.log(np.maximum(softmax(logits / np.exp(log_t))[rows, labels], 1e-30)).mean())

    low, high, ratio = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


@dataclass
class Model:
    """languages: in order; at: the buckets whose weights are not all zero, sorted, and their weights; bias, idf, temperature."""

    languages: list[str]
    at: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    idf: np.ndarray
    temperature: float

    def dense(self) -> np.ndarray:
        w = np.zeros((BUCKETS, len(self.languages)), np.float32)
        w[self.at] = self.weights
        return w

    def logits(self, text: str, dense: np.ndarray) -> np.ndarray:
        at, x = features(text, self.idf)
        return x @ dense[at] + self.bias


def fitted(rows: list[tuple[str, str]], idf: np.ndarray, epochs: int = EPOCHS, seed: int = 5) -> Model:
    """A model of (text, language) rows, of which every VALIDATION-th sets the temperature alone."""
    languages = sorted({r[1] for r in rows})
    number = {x: k for k, x in enumerate(languages)}
    made = [(*features(text, idf), number[lang]) for text, lang in rows]
    kept = made[::VALIDATION] if len(made) >= 10 * VALIDATION else []
    learned = [x for k, x in enumerate(made) if k % VALIDATION] if kept else made
    leader, r = Leader(len(languages)), np.random.default_rng(seed)
    for _ in range(epochs):
        for k in r.permutation(len(learned)):
            leader.step(*learned[k])
    w = leader.weights()
    at = np.flatnonzero(w[:BUCKETS].any(1))
    model = Model(languages, at, w[at].astype(np.float32), w[BUCKETS].astype(np.float32), idf.astype(np.float32), 1.0)
    dense = model.dense()
    logits = np.array([x @ dense[a] + model.bias for a, x, _ in kept]).reshape(len(kept), len(languages))
    model.temperature = temperature(logits, np.array([x[2] for x in kept], int))
    return model


def sampled(known: DataFrame) -> list[tuple[str, str]]:
    """The bounded sample as (text, lang); equal rows count once.

    Rows are ordered by a hash. Of a language with many rows those with a small share of the hash's values are looked at, about SURPLUS
    times as many as are needed, so that no task orders a frequent language.
    """
    counts = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    if not counts:
        return []
    each, most = max(1, TRAIN_TOTAL // len(counts)), TRAIN_BYTES // len(counts)
    spark = known.sparkSession
    shares = spark.createDataFrame([(c["lang"], math.ceil(PARTS * min(1.0, SURPLUS * each / c["count"]))) for c in counts], "lang string, share long")
    h = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text")
    rows = known.where(F.octet_length("text") <= most).select("lang", "text", h.alias("h"))
    rows = rows.join(F.broadcast(shares), "lang").where(F.pmod("h", F.lit(PARTS)) < F.col("share")).drop("share")  # LANGUAGES rows
    order = Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(PARTS)), "h")  # a smaller share cuts off the end of this order
    sizes = rows.select("lang", "h", F.octet_length("text").cast("long").alias("size")).groupBy("lang", "h").agg(F.min("size").alias("size"))
    first = sizes.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= each)
    first = first.withColumn("upto", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))).where(F.col("upto") <= most)
    got = rows.join(F.broadcast(first.select("lang", "h")), ["lang", "h"]).dropDuplicates(["lang", "h"])  # TRAIN_TOTAL rows at most
    return [(r["text"], r["lang"]) for r in got.orderBy("h", "lang").collect()]


def trained(docs: DataFrame) -> Model:
    """A model of the documents that are not held out and have a text with a letter and a language; without any, it knows none."""
    bounded(docs.sparkSession)
    known = docs.select("doc_id", "text", "lang").where(has_letter() & F.col("lang").isNotNull() & ~held_out())
    sample = sampled(known)
    return fitted(sample, inverse_frequencies(known) if sample else np.ones(BUCKETS))


def _predicted(model: Model):
    def run(batches):
        dense = model.dense()
        for batch in small(batches):
            lang, score = [], []
            for text, fine in zip(batch.column("text").to_pylist(), batch.column("fine").to_pylist(), strict=True):
                if not fine or not model.languages:
                    lang.append(UNKNOWN)
                    score.append(0.0)
                    continue
                p = softmax(model.logits(text, dense).astype(np.float64) / model.temperature)
                k = int(p.argmax())
                lang.append(model.languages[k])
                score.append(float(p[k]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held"), pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return run


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred and score, the calibrated probability of lang_pred.

    A null text and one without a letter get `und` with score 0, as every text does where the model knows no language. Of
    equally likely languages the first by name counts. Repeated rows are predicted alike; other columns are ignored; an empty table
    gives an empty result.
    """
    bounded(docs.sparkSession)
    rows = docs.select("doc_id", "text", has_letter().alias("fine"), held_out().alias("held"))
    return rows.mapInArrow(_predicted(model), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, lang_pred string, score double")


def op12_language_id(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return predicted(docs, trained(docs))
