"""Quality classifier: a byte-level convolutional network in numpy.

A document is cut into overlapping chunks of CHUNK bytes that cover it from the first byte to the last (the
last chunk ends with the text; a short text is padded with zero bytes). FILTERS learned filters of WIDTH bytes run
over each chunk and are max-pooled; a small dense layer makes one logit of them, and a soft minimum over
the chunks makes one probability of these, so that one bad part spoils a document.

It is fitted on the driver on a bounded sample of labelled rows: at most TRAIN_PER_LABEL documents of each
label, the first in hash order of doc_id, and of these, in an order of hashes, as many whole texts as TRAIN_BYTES hold. Rows whose
crc32(doc_id as text) mod 5 is 0 are held out. Every document is scored over its whole text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, documents, small

CHUNK, STEP = 512, 448
FILTERS, WIDTH, HIDDEN = 16, 6, 16
TRAIN_PER_LABEL, TRAIN_BYTES, EPOCHS, BATCH = 2000, 2**25, 8, 32
CUT = 0.3
FOLDS = 5


def held_out(folds: int):
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % folds == 0


def chunk_starts(n: int) -> np.ndarray:
    if n <= CHUNK:
        return np.zeros(1, np.int64)
    return np.append(np.arange(0, n - CHUNK, STEP), n - CHUNK)


def chunks_of(text: bytes) -> np.ndarray:
    """The chunks of a text."""
    raw = np.frombuffer(text.ljust(CHUNK, b"\0"), np.uint8)
    return np.lib.stride_tricks.sliding_window_view(raw, CHUNK)[chunk_starts(len(text))]


class Network:
    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.p = {
            "filters": r.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32), "bias": np.zeros(FILTERS, np.float32),
            "w1": r.normal(0, 0.4, (FILTERS, HIDDEN)).astype(np.float32), "b1": np.zeros(HIDDEN, np.float32),
            "w2": r.normal(0, 0.4, HIDDEN).astype(np.float32), "b2": np.zeros(1, np.float32),
        }

    def tables(self) -> list[np.ndarray]:
        """The filters' answers to every pair of bytes, for each pair of a window."""
        f = self.p["filters"]
        return [(f[k][:, None, :] + f[k + 1][None, :, :]).reshape(65536, FILTERS) for k in range(0, WIDTH, 2)]

    @staticmethod
    def convolved(chunks: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        pair = chunks[:, :-1].astype(np.int32) * 256 + chunks[:, 1:]
        n = CHUNK - WIDTH + 1
        out = tables[0].take(pair[:, :n], axis=0)
        for k, t in enumerate(tables[1:], 1):
            out += t.take(pair[:, 2 * k : 2 * k + n], axis=0)
        return out

    def pooled(self, chunks: np.ndarray, tables: list[np.ndarray]) -> np.ndarray:
        return np.concatenate([self.convolved(chunks[a : a + 32], tables).max(1) for a in range(0, len(chunks), 32)])

    def logits(self, pool: np.ndarray) -> np.ndarray:
        h = np.tanh(pool + self.p["bias"])
        return np.maximum(h @ self.p["w1"] + self.p["b1"], 0) @ self.p["w2"] + self.p["b2"]

    @staticmethod
    def combined(z: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """-log(mean(exp(-z))) over the chunks of each document."""
        z = z.astype(np.float64)
        low = np.minimum.reduceat(z, ends[:-1])
        n = np.diff(ends)
        return low - np.log(np.add.reduceat(np.exp(np.repeat(low, n) - z), ends[:-1]) / n)

    def score(self, texts: list[bytes], tables: list[np.ndarray]) -> np.ndarray:
        """Probabilities; texts are taken a few at a time, so that memory follows the longest text."""
        out, group, size = [], [], 0
        for k, text in enumerate(texts):
            group.append(chunks_of(text))
            size += len(group[-1])
            if size > 4096 or k == len(texts) - 1:
                ends = np.concatenate([[0], np.cumsum([len(g) for g in group])])
                z = self.logits(np.concatenate([self.pooled(g, tables) for g in group] if size > 20000 else [self.pooled(np.concatenate(group), tables)]))
                out.append(self.combined(z, ends))
                group, size = [], 0
        x = np.concatenate(out) if out else np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(x, -500, 500)))

    def fit(self, docs: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 11, rate: float = 0.01) -> None:
        r, step = np.random.default_rng(seed), 0
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        for epoch in range(epochs):
            order = r.permutation(len(docs))
            for a in range(0, len(order), BATCH):
                part = order[a : a + BATCH]
                grad = self._gradient([docs[i] for i in part], labels[part])
                step += 1
                lr = rate * (1 - epoch / epochs) * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                for k, g in grad.items():
                    m[k] += 0.1 * (g - m[k])
                    s[k] += 0.001 * (g * g - s[k])
                    self.p[k] -= lr * m[k] / (np.sqrt(s[k]) + 1e-8)

    def _gradient(self, docs: list[np.ndarray], labels: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        ends = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
        x = np.concatenate(docs)
        tables, at, pool = self.tables(), [], []
        for a in range(0, len(x), 32):
            y = self.convolved(x[a : a + 32], tables)
            at.append(y.argmax(1))
            pool.append(y.max(1))
        at, pool = np.concatenate(at), np.concatenate(pool)
        h = np.tanh(pool + p["bias"])
        u = h @ p["w1"] + p["b1"]
        v = np.maximum(u, 0)
        z = v @ p["w2"] + p["b2"]
        total = self.combined(z, ends)
        n = np.diff(ends)
        wrong = (1 / (1 + np.exp(-total)) - labels) / len(docs)
        dz = (np.repeat(wrong, n) * np.exp(np.clip(np.repeat(total, n) - z, -50, 50)) / np.repeat(n, n)).astype(np.float32)
        du = dz[:, None] * p["w2"] * (u > 0)
        dpool = (du @ p["w1"].T) * (1 - h * h)
        filters = np.zeros_like(p["filters"])
        rows, col = np.arange(len(x))[:, None], np.arange(FILTERS)[None, :]
        for k in range(WIDTH):
            cell = x[rows, at + k].astype(np.int64) * FILTERS + col
            filters[k] = np.bincount(cell.ravel(), dpool.ravel(), 256 * FILTERS).reshape(256, FILTERS)
        return {
            "filters": filters + 1e-5 * p["filters"], "bias": dpool.sum(0), "w1": h.T @ du + 1e-4 * p["w1"], "b1": du.sum(0),
            "w2": v.T @ dz + 1e-4 * p["w2"], "b2": dz.sum(keepdims=True),
        }


def trained(docs: DataFrame, labels: DataFrame, folds: int = FOLDS) -> Network:
    """A network fitted on the bounded sample; unfitted where no usable row is labelled. Of several labels of one doc_id the
    lowest counts."""
    usable = labels.where(~held_out(folds) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(F.col("quality").cast("int")).alias("quality"))
    sample = None
    for q in (0, 1):
        one = usable.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRAIN_PER_LABEL)
        sample = one if sample is None else sample.unionByName(one)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").withColumn("h", F.xxhash64("doc_id", "text"))  # 2 * TRAIN_PER_LABEL ids
    sizes = rows.select("h", F.coalesce(F.octet_length("text"), F.lit(0)).alias("size")).distinct().orderBy("h", "size").limit(2 * TRAIN_PER_LABEL).collect()
    chosen, size = [], 0
    for r in sizes:
        if size + r["size"] <= TRAIN_BYTES:
            chosen.append((r["h"],))
            size += r["size"]
    net = Network()
    if chosen:
        few = F.broadcast(docs.sparkSession.createDataFrame(chosen, "h long"))  # 2 * TRAIN_PER_LABEL numbers at most
        got = rows.join(few, "h").dropDuplicates(["h"]).select("doc_id", "quality", F.coalesce("text", F.lit("")).alias("text")).orderBy("doc_id", "text").collect()
        net.fit([chunks_of(r["text"].encode()) for r in got], np.array([r["quality"] for r in got], np.float32))
    return net


def scored(docs: DataFrame, net: Network) -> DataFrame:
    """One row per document: doc_id and score, the probability that its label is 1.

    A null text counts as empty; an empty text is one chunk of zero bytes. Repeated rows score alike;
    other columns are ignored; an empty table gives an empty result.
    """
    bounded(docs.sparkSession)

    def run(batches):
        tables = net.tables()
        for batch in small(batches, 1024, 2**21):
            texts = [x or b"" for x in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(net.score(texts, tables))], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def classified(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted (1 where score >= CUT)."""
    out = scored(docs, trained(docs, labels))
    return out.select("doc_id", held_out(FOLDS).alias("held_out"), "score", F.when(F.col("score") >= CUT, 1).otherwise(0).alias("predicted"))


def op3_quality_classifier(spark, sf_dir):
    return classified(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
