import collections
import math
import random
import zlib

import numpy as np
import pytest
from helpers import corpus

from cuelark.llm import language_id as L

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = {"xa": ["ba", "ke", "li", "mo"], "yb": ["str", "och", "ung", "ei"], "zc": ["ção", "nh", "ré", "ou"]}


def speech(r, lang, n):
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randrange(1, 4))) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def docs(spark):
    r = random.Random(8)
    rows = [(i, speech(r, lang, r.randrange(5, 60)), lang, "s", 0) for i, lang in enumerate(r.choices(list(SYLLABLES), [8, 3, 1], k=600))]
    return spark.createDataFrame(rows, DOCS)


def test_held_out_rows(docs):
    got = {r.doc_id: r for r in L.predicted(docs, L.trained(docs)).collect()}
    rows = docs.collect()
    assert len(got) == len(rows) and all(got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if got[r.doc_id].held_out]
    assert len(held) > 100 and np.mean([got[r.doc_id].lang_pred == r.lang for r in held]) > 0.99
    assert all(0.3 < r.score <= 1 for r in got.values())


def test_lang_source_and_id_are_no_inputs(spark, docs):
    model = L.trained(docs)
    other = docs.selectExpr("doc_id + 1000000 AS doc_id", "text", "'xx' AS lang", "'t' AS source", "n_chars")
    a, b = ([(r.lang_pred, r.score) for r in L.predicted(d, model).orderBy("doc_id").collect()] for d in (docs, other))
    assert a == b


def test_features_equal_plain_counts():
    text = "Ça va?  Ça VA: bien_42 été"
    plain = " ça va ça va bien été "

    def bucket(gram):
        h = 0
        for c in gram:
            h = (h * 0x01000193 & 0xFFFFFFFF) ^ (ord(c) * 0x9E3779B1 & 0xFFFFFFFF)
        return (h ^ h >> 15) * 0x85EBCA6B % 2**32 >> 16

    want = collections.Counter(bucket(plain[i : i + n]) for n in range(1, 5) for i in range(len(plain) - n + 1))
    n = L.counted(text)
    assert {k: int(n[k]) for k in np.flatnonzero(n)} == want
    idf = np.linspace(1, 5, L.BUCKETS)
    at, x = L.features(text, idf)
    raw = np.array([(1 + math.log(want[k])) * idf[k] for k in at])
    assert np.allclose(x, raw / np.sqrt((raw**2).sum()), atol=1e-6)


def test_pieces_of_long_texts_count_the_same(monkeypatch):
    text = "abc déf ghi " * 50
    whole = L.counted(text)
    for piece in (1, 2, 7, 64):
        monkeypatch.setattr(L, "PIECE", piece)
        assert (L.counted(text) == whole).all()


def test_leader_follows_the_definition():
    """Each coordinate minimises g.w + sum of sigma * (w - w_s)**2 / 2 + L1 |w| + L2 w**2 / 2, by search."""
    r, leader = np.random.default_rng(3), L.Leader(3)
    at, g_sum, pull, sig = np.array([5, 9]), np.zeros((3, 3)), np.zeros((3, 3)), np.zeros((3, 3))
    n, ix = np.zeros((3, 3)), np.array([5, 9, L.BUCKETS])
    for k in range(12):
        x, label = r.uniform(0.1, 1, 2).astype(np.float32), k % 3
        w = leader.weights(ix).astype(np.float64)
        p = L.softmax(np.append(x, 1.0) @ w)
        g = np.append(x, 1.0)[:, None] * (p - np.eye(3)[label])
        s = (np.sqrt(n + g * g) - np.sqrt(n)) / L.ALPHA
        n, g_sum, pull, sig = n + g * g, g_sum + g, pull + s * w, sig + s
        leader.step(at, x, label)
    got = leader.weights(ix)
    grid = np.linspace(-1.5, 1.5, 60001)
    for i in range(3):
        for j in range(3):
            cost = g_sum[i, j] * grid + sig[i, j] * grid**2 / 2 - pull[i, j] * grid + L.BETA / L.ALPHA * grid**2 / 2 + L.L1 * np.abs(grid) + L.L2 * grid**2 / 2
            assert abs(grid[cost.argmin()] - got[i, j]) < 1e-3
    leader = L.Leader(2)
    leader.z[:] = 0.9 * L.L1
    assert not leader.weights().any()


def test_temperature_calibrates():
    r = np.random.default_rng(1)
    z = r.normal(0, 2, (4000, 3))
    labels = np.array([r.choice(3, p=L.softmax(x)) for x in z])
    assert abs(L.temperature(3 * z, labels) - 3) < 0.25 and L.temperature(z[:0], labels[:0]) == 1


def test_odd_texts_and_empty_tables(spark, docs):
    model = L.trained(docs)
    rows = [(1, None, "xa"), (2, "", "xa"), (3, "42 -- !? ²", None), (4, "baké", None), (None, "ungei", None), (6, "ba ke " * 300_000, "xa"), (4, "baké", None), (7, "漢字", None)]
    got = [(r.doc_id, r.lang_pred, r.score) for r in L.predicted(spark.createDataFrame(rows, "doc_id long, text string, lang string"), model).collect()]
    by = {r[0]: r for r in got}
    assert len(got) == 8 and all(by[k][1:] == ("und", 0.0) for k in (1, 2, 3)) and by[4][1] == "xa" and by[None][1] == "yb" and by[6][1] == "xa" and by[7][1] in SYLLABLES
    empty = spark.createDataFrame([], DOCS)
    assert L.predicted(empty, L.trained(empty)).count() == 0
    unlabelled = spark.createDataFrame([(r[0], r[1], None, r[3], r[4], 1, 2.0, "z") for r in corpus(1, 5)], DOCS + ", held int, fine double, h string")
    assert {r.lang_pred for r in L.predicted(unlabelled, L.trained(unlabelled)).collect()} == {"und"}
    one = spark.createDataFrame([(0, "abc", "q", "s", 0)], DOCS)
    assert L.predicted(one, L.trained(one)).first().lang_pred == "q"


def test_the_sample_is_bounded_and_shared(spark, docs, monkeypatch):
    monkeypatch.setattr(L, "TRAIN_TOTAL", 30)
    known = docs.where("lang IS NOT NULL")
    rows = L.sampled(known)
    assert collections.Counter(x for _, x in rows) == dict.fromkeys(SYLLABLES, 10) and rows == L.sampled(known.repartition(7).unionByName(known))
    monkeypatch.setattr(L, "TRAIN_BYTES", 900)
    by = collections.Counter()
    for text, lang in L.sampled(known):
        by[lang] += len(text.encode())
    assert by and max(by.values()) <= 300
