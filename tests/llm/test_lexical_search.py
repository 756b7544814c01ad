import collections
import math
import random
import re

import numpy as np
import pytest
from helpers import DOCS, corpus, prose

from cuelark.llm import common
from cuelark.llm import lexical_search as S
from cuelark.llm.hard_negatives import NONE, Heaps

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=20):
    own = [(d, terms(t)) for d, t in docs]
    own = [(d, collections.Counter(x), len(x)) for d, x in own if x]
    n_docs, total = len(own), sum(x[2] for x in own)
    df = collections.Counter(t for x in own for t in x[1])
    out = []
    for item, text in items:
        asked = collections.Counter(terms(text))
        found = []
        for d, tf, n in own:
            m = 100 - 25 + 25 * n * n_docs // total
            score = sum(k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * tf[t] // (1000 * tf[t] + 12 * m)) for t, k in asked.items() if t in tf)
            if score > 0:
                found.append((-score, d is None, d or 0))
        out += [(item, k + 1, None if none else d, -s) for k, (s, none, d) in enumerate(sorted(found)[:top])]
    return sorted(out, key=str)


def got(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    return sorted((tuple(r) for r in S.ranked(d, spark.createDataFrame(items, "item_id long, text string")).collect()), key=str)


def test_equals_brute_force_on_the_corpus(spark):
    docs = [(r[0], r[1]) for r in corpus(5, 150)]
    r = random.Random(2)
    items = [(k, prose(r, 12)) for k in range(15)] + [(20, docs[3][1]), (21, "ou ou OU éβλ"), (22, None), (23, ""), (24, "§ no-such-term"), (0, "the on")]
    assert got(spark, docs, items) == brute(docs, items)


def test_ties_nulls_repeats_long_texts_and_empty_tables(spark):
    docs = [(k % 40, f"alpha {'beta ' * (k % 3)}gamma{k % 5}") for k in range(120)] + [(None, "alpha beta"), (None, None), (500, "alpha " * 400_000), (501, "é" * 70_000), (502, "A1\x00b2{c3}~é٣")]
    items = [(1, "alpha beta gamma1 gamma1"), (1, "alpha beta gamma1 gamma1"), (2, "é" * 70_000), (3, "a1 B2 c3 É٣ é٣"), (None, "gamma4")]
    assert got(spark, docs, items) == brute(docs, items)
    assert got(spark, [], items) == [] and got(spark, docs, []) == [] and got(spark, [(1, "."), (2, None)], items) == []


def test_clashing_columns_are_ignored(spark):
    d = spark.createDataFrame([(1, "a b", 7, "x", 3), (2, "a", 7, "y", 4)], "doc_id long, text string, uid int, q string, score int")
    i = spark.createDataFrame([(5, "a b", 1, 2.0)], "item_id long, text string, rank int, doc_id double")
    assert [tuple(r)[:3] for r in S.ranked(d, i).orderBy("rank").collect()] == [(5, 1, 1), (5, 2, 2)]


def shards(docs, size):
    own = [len(terms(t)) for _, t in docs]
    of = S.Totals(sum(n > 0 for n in own), sum(own))
    made = [S.shard(np.array([d for d, _ in docs[a : a + size]]), [t.encode() for _, t in docs[a : a + size]], of) for a in range(0, len(docs), size)]
    return of, [S.Shard({c: x.tobytes() for c, x in m.items()}) for m in made]


def zipf_docs(n, seed=1):
    r = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    weights = [1 / (k + 1) for k in range(400)]
    return [(d, " ".join(r.choices(words, weights, k=r.randrange(1, 80)) + (["w3"] * r.randrange(300) if d % 97 == 0 else []))) for d in range(n)]


def test_every_posting_comes_back():
    docs = zipf_docs(3000) + [(9000, "x " * 70_000)]
    of, (s,) = shards(docs, 4000)
    where, doc, hit = s.unpacked(np.arange(len(s.last)))
    term = np.searchsorted(s.first, where, "right") - 1
    have = {(int(s.terms[t]), int(d)): int(h) for t, d, h in zip(term, doc, hit, strict=True)}
    want = {}
    for d, (_, text) in enumerate(docs):
        x = terms(text)
        m = 75 + 25 * len(x) * of.n_docs // of.n_terms
        want |= {(S.term_hash(t.encode()), d): 1000000000 * tf // (1000 * tf + 12 * m) for t, tf in collections.Counter(x).items()}
    assert have == want and (s.size.max() == S.BLOCK) and {1, 2} == set(s.gw.tolist()) and {0, 1, 2, 4} == set(s.tw.tolist())


@pytest.mark.parametrize("size", [700, 5000])
def test_pruning_loses_nothing_and_unpacks_less(size):
    docs = zipf_docs(5000)
    of, made = shards(docs, size)
    df = collections.Counter(t for _, text in docs for t in set(terms(text)))
    r, unpacked, whole = random.Random(4), 0, 0
    for _ in range(40):
        asked = collections.Counter(r.choices([f"w{k}" for k in range(400)], [1 / (k + 1) for k in range(400)], k=8))
        q = np.array([S.term_hash(t.encode()) for t in asked], np.uint64)
        w = np.array([of.weight(df[t]) * k for t, k in asked.items()], np.int64)
        heaps = Heaps(1, 10)
        for s in made:
            unpacked += S.search(s, q, w, heaps, 0)
        whole += sum(df[t] for t in asked)
        want = [(x[2], x[3]) for x in sorted(brute(docs, [(0, " ".join(asked.elements()))], 10), key=lambda x: x[1])]
        assert [*zip(heaps.id[0].tolist(), heaps.score[0].tolist(), strict=True)][: len(want)] == want and (heaps.score[0] != NONE).sum() == len(want)
    assert unpacked < 0.8 * whole


def test_intermediate_tables_go(spark):
    before = common.intermediates()
    out = S.ranked(spark.createDataFrame([(1, "a")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string"))
    assert out.count() == 1
    assert not any("postings" in p or "queries" in p for p in common.intermediates() - before)
    assert DOCS.startswith("doc_id long")
