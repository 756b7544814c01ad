"""Scores of the quality operators against plain loops over bytes."""

import math
import random

import numpy as np
from helpers import DOCS, corpus, prose

from cuelark.llm import quality_classifier as C
from cuelark.llm import quality_rules as Q


def bucket(gram: bytes) -> int:
    return int.from_bytes(gram, "little") * 0x9E3779B1 % 2**32 >> 16


def grams(text):
    b = (text or "").encode()
    return [bucket(b[i : i + 4]) for i in range(len(b) - 3)]


def test_rule_scores_and_verdicts(spark):
    """Every document's mean log-likelihood ratio, with counts over all good and over all documents; rows may repeat."""
    r = random.Random(6)
    rows = [(x[0], x[1]) for x in corpus(6, 40)] + [(1000 + i, " ".join(f"{w.upper()}$%" for w in prose(r, 70).split())) for i in range(30)]
    rows += [rows[0], rows[-1], (2000, "abc"), (2001, "abcd"), (2002, "é€"), (2003, prose(r, 400_000))]
    good = {i for i, _ in rows if i < 1000 and i % 3 == 0}
    labels = spark.createDataFrame([(i, int(i in good), 0) for i in {i for i, _ in rows}] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    raw, trusted = np.zeros(2**16), np.zeros(2**16)
    for i, t in rows:
        for g in grams(t):
            raw[g] += 1
            trusted[g] += i in good
    ratio = {}
    for g in np.flatnonzero(raw):
        share = (trusted[g] / trusted.sum()) / (raw[g] / raw.sum())
        ratio[g] = math.log((share + 0.01) / 1.01)
    clash = spark.createDataFrame([(*x, 1, 2.0, True, "g") for x in rows], "doc_id long, text string, n_words int, score double, kept boolean, bucket string")
    got = sorted((x.doc_id, x.score, x.base_failed, x.kept) for x in Q.judged(clash, labels).collect())
    want = sorted((i, float(np.mean([ratio[g] for g in grams(t)])) if grams(t) else 0.0) for i, t in rows)
    assert len(got) == len(want)
    for (i, score, failed, kept), (j, plain) in zip(got, want, strict=True):
        assert i == j and abs(score - plain) < 1e-4 and (abs(plain + 0.25) < 1e-4 or kept == (not failed and plain >= -0.25))
    assert {k for *_, k in got} == {True, False}


def test_a_score_at_the_threshold_is_kept(spark):
    docs = spark.createDataFrame([(1, "word " * 20 + " ".join(f"w{k}" for k in range(60)))], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert Q.judged(docs, labels, 0.0).first().kept  # without good labels every score is exactly 0
    assert not Q.judged(docs, labels, 1e-9).first().kept


def test_classifier_scores_equal_plain_loops(spark):
    r = np.random.default_rng(2)
    net = C.Network()
    for k, v in net.p.items():
        net.p[k] = (v + r.normal(0, 0.2, v.shape)).astype(np.float32)
    p = {k: v.astype(np.float64) for k, v in net.p.items()}
    texts = [None, "", "x", "a b" * 100, "é" * 256, "q" * 512, "w" * 513, prose(random.Random(1), 300)]

    def plain(text):
        b = (text or "").encode()
        b = b.ljust(512, b"\0")
        starts = [0] if len(b) == 512 else [*range(0, len(b) - 512, 448), len(b) - 512]
        z = []
        for s in starts:
            chunk = b[s : s + 512]
            pool = [max(sum(p["filters"][k, chunk[i + k], f] for k in range(6)) for i in range(507)) for f in range(16)]
            h = np.tanh(np.array(pool) + p["bias"])
            z.append(float(np.maximum(h @ p["w1"] + p["b1"], 0) @ p["w2"] + p["b2"][0]))
        return 1 / (1 + math.exp(math.log(sum(math.exp(-x) for x in z) / len(z))))

    rows = [(i, t, 1, 0.5) for i, t in enumerate(texts)]
    got = {x.doc_id: x.score for x in C.scored(spark.createDataFrame([*rows, rows[3]], "doc_id long, text string, held_out int, score double"), net).collect()}
    assert all(abs(got[i] - plain(t)) < 1e-4 for i, t in enumerate(texts))


def test_classifier_gradient_of_the_filters():
    """Against differences of the loss, for the bytes and filters that decide most."""
    r = np.random.default_rng(4)
    net = C.Network()
    docs = [C.chunks_of(bytes(r.integers(97, 105, n).astype(np.uint8))) for n in (40, 700, 1500)]
    labels = np.array([1, 0, 1], np.float32)
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)

    def loss():
        tables = net.tables()
        x = np.concatenate(docs)
        z = net.logits(net.pooled(x, tables))
        total = net.combined(z, np.concatenate([[0], np.cumsum([len(d) for d in docs])]))
        return float(np.mean(np.log1p(np.exp(-total)) * labels + np.log1p(np.exp(total)) * (1 - labels))) + 5e-6 * float((net.p["filters"] ** 2).sum())

    grad = net._gradient(docs, labels)["filters"]
    for at in np.argsort(-np.abs(grad).ravel())[:6]:
        cell = np.unravel_index(at, grad.shape)
        was, step = net.p["filters"][cell], 1e-5
        net.p["filters"][cell] = was + step
        up = loss()
        net.p["filters"][cell] = was - step
        down = loss()
        net.p["filters"][cell] = was
        assert abs((up - down) / (2 * step) - grad[cell]) < 0.02 * abs(grad[cell]) + 1e-7
    assert DOCS
