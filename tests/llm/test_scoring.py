import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from helpers import DOCS, corpus, prose

from pyspark.sql import functions as F

from cuelark.llm import licenses, lm_scoring, mixing, pieces, quality_classifier, quality_rules

WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS)


@pytest.fixture(scope="module")
def labelled(spark):
    r = random.Random(4)
    good = [prose(r, r.randrange(60, 150)) for _ in range(150)]
    bad = [" ".join(f"{w.upper()}!!" for w in prose(r, 80).split()) for _ in range(150)]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate([x for pair in zip(good, bad, strict=True) for x in pair])]
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(300)], "doc_id long, quality int, toxic int")


def test_license_matches(spark):
    rows = [(1, "x y Licensed under the Apache License,\n Version 2.0. z"), (2, "released UNDER the mit license"), (3, "the license"), (4, None), (5, ""), (6, "word"), (7, "a " * 3000 + "This work is licensed under the GNU General Public License, version 3."), (8, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and then something else")]
    got = {(r.doc_id, r.template) for r in licenses.license_matches(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, "Apache-2.0"), (2, "MIT"), (7, "GPL-3.0"), (8, "MIT-grant")}
    assert licenses.license_matches(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_every_template_is_found_at_every_offset(spark):
    rows = [(k * 100 + o, "filler " * o + t + " and more words") for k, t in enumerate(licenses.TEMPLATES.values()) for o in range(7)]
    found = {r.doc_id for r in licenses.license_matches(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {r[0] for r in rows}


def test_rule_counts(docs, labelled, spark):
    got = {r.doc_id: r for r in quality_rules.judged(docs, labelled[1]).collect()}
    for r in docs.collect():
        t = r.text or ""
        w = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        windows = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        again = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
        g = got[r.doc_id]
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(again))
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == want
        assert g.base_failed == (len(w) < 50 or 100 * len(again) > 50 * len(w)) and (not g.base_failed or not g.kept)


def test_rules_keep_the_good(labelled):
    kept = {r.doc_id for r in quality_rules.good_documents(*labelled).collect()}
    assert kept == set(range(0, 300, 2))
    assert quality_rules.good_documents(*labelled).columns == labelled[0].columns


def test_repeated_words_with_many_words():
    words = [b"w%d" % (k % 5000) for k in range(20000)]
    assert quality_rules.repeated_words([words, words[:5000], [], [b"a"] * 4]).tolist() == [20000, 0, 0, 4]


def test_classifier_on_held_out_rows(labelled):
    got = quality_classifier.classified(*labelled).collect()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1
    held = [r for r in got if r.held_out]
    assert np.mean([r.predicted == 1 - r.doc_id % 2 for r in held]) > 0.9


def test_the_lowest_of_several_labels_counts(spark, labelled):
    docs, labels = labelled
    doubled = labels.unionByName(labels.selectExpr("doc_id", "1 AS quality", "0 AS toxic"))
    one, other = (quality_classifier.trained(docs, x).p for x in (labels, doubled))
    assert all(np.array_equal(one[k], other[k]) for k in one)


def test_chunks_cover_a_text():
    for n in (0, 1, 511, 512, 513, 960, 961, 5000):
        text = bytes(random.Random(n).randrange(1, 256) for _ in range(n))
        c, at = quality_classifier.chunks_of(text), quality_classifier.chunk_starts(n)
        covered = set()
        for row, a in zip(c, at, strict=True):
            assert bytes(row).rstrip(b"\0") == text[a : a + 512].rstrip(b"\0")
            covered |= set(range(a, a + 512))
        assert set(range(n)) <= covered


def test_network_gradient():
    net = quality_classifier.Network()
    r = np.random.default_rng(3)
    docs, y = [r.integers(0, 256, (n, quality_classifier.CHUNK)).astype(np.uint8) for n in (1, 3)], np.array([1.0, 0.0], np.float32)
    ends = np.array([0, 1, 4])

    def loss():
        z = net.combined(net.logits(net.pooled(np.concatenate(docs), net.tables())), ends)
        p = 1 / (1 + np.exp(-z))
        return float(-np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)))

    grad = net._gradient(docs, y)
    for name in ("w1", "b1", "w2", "b2", "bias"):
        p, g = net.p[name].reshape(-1), grad[name].reshape(-1)
        k = int(np.abs(g).argmax())
        old = p[k]
        p[k] = old + 1e-2
        up = loss()
        p[k] = old - 1e-2
        down = loss()
        p[k] = old
        assert abs((up - down) / 2e-2 - g[k]) < 0.05 * abs(g[k]) + 2e-3


def test_mixing(docs):
    got = mixing.mixed(docs).collect()
    assert {(r.doc_id, r.taken) for r in got} == {(r.doc_id, r.taken) for r in mixing.mixed(docs.repartition(3)).collect()}
    by = collections.defaultdict(list)
    for r in got:
        by[r.source].append(r)
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    for source, rows in by.items():
        size = sum(len(WORD.findall(text[r.doc_id])) for r in rows)
        assert {r.source_size for r in rows} == {size}
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= max(r.size for r in rows) / 2 + 1e-6
        assert all(r.taken <= 3 * r.size for r in rows) and rows[0].target <= 3 * size + 1e-6
    assert abs(sum(rows[0].target for rows in by.values()) - sum(r.size for r in got)) < 1e-3
    mix = mixing.mix(docs)
    assert mix.columns == docs.columns and mix.count() == sum(r.copies for r in got)


def test_inclusion_frequencies(spark):
    """Over many seeds a document's copies come near what its size and its source's rate let expect, and so differ within a source."""
    r = random.Random(3)
    rows = [(i, "w " * r.choice([1, 3, 12, 50, 200, 600]), ["a", "b", "c"][min(i % 5, 2)], "") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, other string").repartition(1).cache()
    seeds, copies, rate = 200, collections.Counter(), {}
    parts = [mixing.mixed(docs, f"{k}-", bins=64).select("doc_id", "rate", "copies") for k in range(3)]
    for part in parts:
        for x in part.collect():
            rate[x.doc_id] = x.rate
            assert x.copies in (math.floor(x.rate), math.floor(x.rate) + 1)
    size = {i: len(t.split()) for i, t, _, _ in rows}
    of = {i: s for i, _, s, _ in rows}
    for k in range(seeds):  # the same draw in plain Python
        for source in "abc":
            mine = [i for i in rate if of[i] == source and rate[i] % 1 > 0]
            u = {i: int(hashlib.md5(f"{k}-{i}".encode()).hexdigest()[:13], 16) / 2**52 for i in mine}
            q = {i: (u[i] / (1 - u[i])) / (rate[i] % 1 / (1 - rate[i] % 1)) for i in mine}
            need, run = sum(rate[i] % 1 * size[i] for i in mine), 0
            for i in sorted(mine, key=lambda i: (q[i], i)):
                run += size[i]
                copies[i] += run - size[i] / 2 <= need + 1e-6
        if k < len(parts):
            drawn = {x.doc_id: x.copies - math.floor(x.rate) for x in parts[k].collect()}
            seen = collections.Counter(copies)
            if k == 0:
                assert all(drawn[i] == seen[i] for i in drawn)
    for source in "abc":
        fractions = {rate[i] % 1 for i in rate if of[i] == source}
        assert len(fractions) > 3 or source == "a"  # which is full
        for p in fractions - {0.0}:
            same = [i for i in rate if of[i] == source and rate[i] % 1 == p]
            assert abs(sum(copies[i] for i in same) / seeds / len(same) - p) < 0.08, (source, p)


def test_targets_stop_at_three_times_a_source(spark):
    s = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 90), (None, 100)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(s).collect()}
    # weights 5, 2, 1, 5: a, then None, then c stop at three times their size; b takes the rest
    assert got == {"a": 30.0, None: 300.0, "c": 270.0, "b": 600.0}


def test_pieces_round_trip(docs):
    got = pieces.round_trip(docs)
    assert got.where("NOT exact").count() == 0
    back = {r.doc_id: r.text for r in pieces.decoded(pieces.encoded(docs)).collect()}
    assert back == {r.doc_id: r.text or "" for r in docs.collect()}


def test_pieces_are_the_best(monkeypatch):
    a = pieces.automaton(pieces.default_model())
    at = {i: s for s, i in enumerate(a.piece) if i >= 0}
    known = {a.bytes_of[i]: (a.score[s], i) for i, s in at.items()}

    def best(unit):
        top = [0.0] + [-math.inf] * len(unit)
        for j in range(1, len(unit) + 1):
            top[j] = top[j - 1] + a.byte_score
            for i in range(max(0, j - 40), j):
                if unit[i:j] in known:
                    top[j] = max(top[j], top[i] + known[unit[i:j]][0])
        return top[-1]

    texts = [(r[1] or "")[:400].encode() for r in corpus(3, 10)] + [b"supercalifragilistic" * 9]
    ids, ends = a.encode(texts)
    for k, t in enumerate(texts):
        own = ids[ends[k] : ends[k + 1]]
        assert abs(sum(a.score[at[i]] if i in at else a.byte_score for i in own.tolist()) - best(t.replace(b" ", b"\xff"))) < 1e-6
    unit = b"\xff" + "wordsé".encode() * 3
    assert a.encode_one(unit) == a.encode_units([unit])[0].tolist()


def test_lm_scores(docs):
    got = {r.doc_id: r for r in lm_scoring.lm_scores(docs).collect()}
    tokens = {r.doc_id: [w.lower() if w.isascii() else re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(r.text or "")] + [None] for r in docs.collect()}
    train = collections.Counter(t for i, x in tokens.items() if zlib.crc32(str(i).encode()) % 10 for t in x)
    n, v = sum(train.values()), len(train)
    for i, x in tokens.items():
        base = sum(math.log10((train[t] + 0.1) / (n + 0.1 * (v + 1))) for t in x)
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (zlib.crc32(str(i).encode()) % 10 == 0, len(x), sum(train[t] > 0 for t in x), n)
        assert abs(r.base_score - base) < 1e-6 * max(1, abs(base)) and r.score < 0


def behind(sentences, begins):
    """What comes behind each id and each word so far, counted plainly."""
    n = len(begins)
    got = collections.Counter()
    for ids in sentences:
        last, word = n, (n,)
        for z in ids:
            got[(last,), z] += 1
            got[("word", *word), "B" if begins[z] else z] += 1
            word = (z,) if begins[z] else (*word, z)
            last = z
    return got


def some_ids(seed=2, n=60, lens=(50, 0, 1, 30, 200)):
    r = np.random.default_rng(seed)
    ids = [r.integers(0, n, k).astype(np.int32) for k in lens]
    return np.concatenate(ids), np.concatenate([[0], np.cumsum(lens)]), (r.random(n) < 0.4) | (np.arange(n) == lm_scoring.END)


def neighbours(ids, ends, begins, least=1):
    n = len(begins)
    last = lm_scoring.before(ids, ends, n)
    found = collections.Counter()
    for context, z in ((last, ids), (lm_scoring.words_so_far(last, begins), np.where(begins[ids], lm_scoring.BEGIN, ids))):
        found.update(zip(context.tolist(), z.tolist(), strict=True))
    total = collections.Counter()
    for (c, _), k in found.items():
        total[c] += k
    often = sorted((c, z, k) for (c, z), k in found.items() if k >= least)
    contexts = sorted({c for c, _, _ in often})
    counts = np.bincount(ids, minlength=n)
    as_array = lambda x: np.array(x, np.int64)
    return lm_scoring.Neighbours(begins, counts, *map(as_array, zip(*often, strict=True)), as_array(contexts), as_array([total[c] for c in contexts]))


def test_words_so_far_tell_words_apart():
    ids, ends, begins = some_ids(lens=(300, 0, 1, 300))
    last = lm_scoring.before(ids, ends, len(begins))
    h = lm_scoring.words_so_far(last, begins)
    assert h.min() >= 2**32
    seen, words = {}, []
    for a, b in zip(ends, ends[1:], strict=False):
        word = (len(begins),)
        for k in range(a, b):
            words.append(word)
            assert seen.setdefault(word, h[k]) == h[k]
            word = (ids[k],) if begins[ids[k]] else (*word, ids[k])
    assert len(set(seen.values())) == len(seen) == len(set(words))


@pytest.mark.parametrize("least", [1, 3])
def test_probabilities_against_plain_counts(least):
    ids, ends, begins = some_ids(n=12)
    near, n, d = neighbours(ids, ends, begins, least), len(begins), lm_scoring.DISCOUNT
    net = lm_scoring.Attention(*lm_scoring.classes(near.counts, *near.pairs()), begins, near.counts)
    found = behind([ids[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)], begins)
    got = lm_scoring.log10_probs(net, near, ids, ends)
    q, of_begins = net.probs(ids, ends)

    def part(context, z):
        total = sum(k for (c, _), k in found.items() if c == context)
        known = {y: k for (c, y), k in found.items() if c == context and k >= least}
        return max(known.get(z, 0) - d, 0) / max(total, 1), 1 - sum(k - d for k in known.values()) / max(total, 1)

    for a, b in zip(ends, ends[1:], strict=False):
        last, word = n, (n,)
        for k in range(a, b):
            z = int(ids[k])
            (one, left), (whole, over) = part((last,), z), part(("word", *word), "B" if begins[z] else z)
            base = one + left * q[k]
            if begins[z]:
                whole *= base / (sum(part((last,), y)[0] for y in range(n) if begins[y]) + left * of_begins[k])
            assert abs(10 ** got[k] - (whole + over * base)) < 1e-6
            word, last = (z,) if begins[z] else (*word, z), z


def test_model_is_causal_and_adds_up_to_one():
    ids, ends, begins = some_ids(lens=(50, 40), n=60)
    near = neighbours(ids, ends, begins, 1)
    net = lm_scoring.Attention(*lm_scoring.classes(near.counts, *near.pairs()), begins, near.counts)
    score = lambda x: lm_scoring.log10_probs(net, near, x.astype(np.int32), np.array([0, len(x)]))
    one, other = score(ids[:50]), ids[:50].copy()
    other[30:] = (other[30:] + 7) % 60
    assert np.allclose(one[:30], score(other)[:30])
    assert np.allclose(one, np.concatenate([score(ids[:20]), one[20:]]), atol=1e-5)
    assert abs(sum(10 ** score(np.append(ids[:20], k))[-1] for k in range(60)) - 1) < 1e-4


def test_attention_against_a_plain_loop():
    """Masked windows give what each id's own CONTEXT ids give."""
    ids, ends, begins = some_ids(5, lens=(70, 3))
    counts = np.bincount(ids, minlength=60)
    net = lm_scoring.Attention(*lm_scoring.classes(counts), begins, counts)
    (got, of_begins), p, start = net.probs(ids, ends), net.p, 60
    for a, b in zip(ends, ends[1:], strict=False):
        for k in range(a, b):
            context = [ids[j] if j >= a else start for j in range(k - lm_scoring.CONTEXT, k)]
            kinds = net.kind_of[np.array(context)]
            s = p["key"][kinds] @ p["query"][kinds[-1]] + p["distance"][np.arange(lm_scoring.CONTEXT)[::-1]]
            w = np.exp(s - s.max())
            h = np.tanh((w / w.sum()) @ p["value"][kinds] + p["own"][kinds[-1]])
            z = np.exp(h @ p["out"] + p["bias"])
            of = net.class_of[ids[k]]
            share = (counts[ids[k]] + 0.1) / sum(counts[j] + 0.1 for j in range(60) if net.class_of[j] == of)
            assert abs(got[k] - z[of] / z.sum() * share) < 1e-5
            assert abs(of_begins[k] - sum(z[net.class_of[j]] / z.sum() * net.share[j] for j in range(60) if begins[j])) < 1e-5


def test_attention_gradient():
    ids, ends, begins = some_ids(4, 200, (25, 40))
    near = neighbours(ids, ends, begins, 1)
    net = lm_scoring.Attention(*lm_scoring.classes(near.counts), begins, near.counts)
    w, place = net.windows_of(ids, ends, 200)
    ok = place >= 0
    terms = [x[place] for x in near.terms(ids, ends, 1)]
    given, left = lm_scoring.combined(*terms, net.probs(ids, ends)[1][place])

    def loss():
        q = net.probs(ids, ends)[0][place]
        return -float((np.log(given + left * q) * ok).sum() / ok.sum())

    grad = net._gradient(w, ok, *terms)
    for name in ("own", "query", "key", "value", "distance", "out", "bias"):
        p, g = net.p[name].reshape(-1), grad[name].reshape(-1)
        k = int(np.abs(g).argmax())
        old = p[k]
        p[k] = old + 1e-2
        up = loss()
        p[k] = old - 1e-2
        down = loss()
        p[k] = old
        assert abs((up - down) / 2e-2 - g[k]) < 0.05 * abs(g[k]) + 2e-4, name


def test_held_out_texts_are_likelier_than_under_the_unigram(spark):
    r = random.Random(12)
    sentences = [prose(r, 12) for _ in range(30)]
    rows = [(i, "\n".join(r.choice(sentences) for _ in range(12))) for i in range(300)]
    got = [x for x in lm_scoring.lm_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect() if x.held_out]
    assert len(got) > 10 and sum(x.score for x in got) > sum(x.base_score for x in got)


@pytest.mark.parametrize("run", [mixing.mixed, pieces.encoded, lm_scoring.lm_scores, licenses.license_matches])
def test_empty_and_clashing(spark, docs, run):
    assert run(spark.createDataFrame([], DOCS)).count() == 0
    clash = docs.selectExpr("doc_id", "text", "source", "'x' AS uid", "1 AS held", "'y' AS words", "0 AS n", "'z' AS size")
    assert run(clash).count() == run(docs).count()


def test_empty_tables_of_labels(spark, docs, labelled):
    none = labelled[1].limit(0)
    assert quality_classifier.classified(docs, none).count() == docs.count()
    assert quality_rules.judged(docs, none).where("score <> 0").count() == 0
    empty = spark.createDataFrame([], DOCS)
    assert quality_classifier.classified(empty, labelled[1]).count() == 0 and quality_rules.judged(empty, labelled[1]).count() == 0


def test_mix_takes_rows_of_one_id_by_row(spark):
    rows = [(None, "a b c" * (i % 5 + 1), None, f"s{i % 3}", 0) for i in range(60)] + [(7, "x " * i, None, f"s{i % 3}", 0) for i in range(1, 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    want = mixing.mixed(df).groupBy("source").agg(F.sum("copies").alias("n"), F.sum("taken").alias("taken")).collect()
    got = mixing.mix(df).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum(mixing.words(F.col("text"))).alias("taken")).collect()
    assert sorted((r.source, r.n, r.taken) for r in got) == sorted((r.source, r.n, r.taken) for r in want if r.n)
