import collections
import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from helpers import DOCS, corpus, edited, prose

from cuelark.llm import exact_dedup, near_dedup, sentence_spans, suffixes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS)


def texts_of(df):
    return {r.doc_id: r.text or "" for r in df.collect()}


def test_exact_groups(docs):
    groups = collections.defaultdict(list)
    for i, t in texts_of(docs).items():
        groups[t.translate(LOWER)].append(i)
    for block in (1024, 7):
        got = exact_dedup.exact_groups(docs, block).collect()
        assert len(got) == docs.count()
        for r in got:
            t = next(k for k, v in groups.items() if r.doc_id in v)
            assert (r.keep_id, r.group_size, r.kept, r.text_sha256) == (max(groups[t]), len(groups[t]), r.doc_id == max(groups[t]), hashlib.sha256(t.encode()).hexdigest())
    kept = exact_dedup.without_copies(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(max(v) for v in groups.values())


def test_exact_groups_of_repeated_and_null_ids(spark):
    rows = [(1, "a", None, None, 0), (1, "a", None, None, 0), (1, "b", None, None, 0), (None, "b", None, None, 0), (2, None, None, None, 0), (3, "", None, None, 0)]
    df = spark.createDataFrame(rows, DOCS)
    got = sorted((r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(df).collect())
    assert got == [(1, 2, False), (1, 2, False), (1, 2, True), (1, 2, True), (3, 2, False), (3, 2, True)]
    assert exact_dedup.without_copies(df).count() == 3


def test_the_smallest_ids_are_no_padding(spark):
    """Texts of three and of four blocks, the last of which is a block that the smallest doc_id has first."""
    low = -(2**31)
    rows = [(low, "z" * 7), (1, "a" * 7 + "b" * 7 + "c" * 7), (2, "a" * 7 + "b" * 7 + "c" * 7 + "z" * 7)]
    got = exact_dedup.exact_groups(spark.createDataFrame(rows, "doc_id long, text string"), 7).collect()
    assert sorted((r.doc_id, r.group_size) for r in got) == [(low, 1), (1, 1), (2, 1)]


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + k]) for i in range(max(len(w) - k + 1, 1))} if w else set()


def brute_components(texts, k, per_cent):
    sets = {i: shingles(t, k) for i, t in texts.items()}
    label = {i: i for i in sets}
    again = True
    while again:
        again = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if sets[a] and sets[b] and 100 * both >= per_cent * len(sets[a] | sets[b]) and label[a] > label[b]:
                    label[a], again = label[b], True
    return sets, label


@pytest.mark.parametrize(("k", "per_cent"), [(3, 85), (5, 80)])
def test_near_copies(docs, k, per_cent):
    sets, label = brute_components(texts_of(docs), k, per_cent)
    got = near_dedup.near_copies(docs, k, per_cent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {i: (len(sets[i]), label[i], i == label[i]) for i in sets}
    assert sorted(r.doc_id for r in near_dedup.without_near_copies(docs, k, per_cent).collect()) == sorted(set(label.values()))


def test_a_large_group_of_near_copies(spark):
    r = random.Random(5)
    base = prose(r, 150)
    texts = {i: edited(r, base, 1 + i % 9) for i in range(1, 150)} | {150: base}
    sets, label = brute_components(texts, 3, 85)
    got = near_dedup.near_copies(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), 3, 85).collect()
    assert {x.doc_id: x.component_id for x in got} == label


def test_registers_merge_and_estimate():
    r = np.random.default_rng(1)
    x, y = r.integers(0, 2**63, 3000, dtype=np.uint64), r.integers(0, 2**63, 2000, dtype=np.uint64)
    both = np.concatenate([x[:2000], y])
    k = near_dedup.registers([x, both, np.concatenate([x, y])])
    assert (np.maximum(k[0], k[1]) == k[2]).all()
    j = near_dedup.estimate(k[:1], k[1:2], np.array([3000.0]), np.array([4000.0]))[0]
    assert abs(j - 2000 / 5000) < 0.2


def brute_suffixes(texts, n=50):
    seen, out = set(), {}
    for i in sorted(texts):
        b = texts[i].encode()
        own = {b[p : p + n] for p in range(len(b) - n + 1)}
        gone = np.zeros(len(b) + 2, np.int8)
        for p in range(len(b) - n + 1):
            if b[p : p + n] in seen:
                gone[p + 1 : p + n + 1] = 1
        seen |= own
        rest = bytes(x for x, g in zip(b, gone[1:-1], strict=True) if not g)
        out[i] = (len(b), int(gone.sum()), int((np.diff(gone) == 1).sum()), hashlib.sha256(rest).hexdigest())
    return out


def test_suffixes(docs):
    got = suffixes.without_repeats(docs).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == brute_suffixes(texts_of(docs))


@pytest.mark.parametrize("buckets", [1, 3, 40])
def test_buckets_agree_with_brute_force(buckets):
    """The order of suffixes is cut anywhere, within grams and within equal suffixes; windows are compared across the cuts."""
    r = random.Random(8)
    passage = prose(r, 30)
    texts = {i: f"{prose(r, 12)}{passage}{prose(r, 12)}" for i in range(30)} | {i: "x" * 70 + prose(r, 3) + "x" * (90 + i) for i in range(30, 40)} | {40: passage, 41: passage}
    raw = [t.encode() for t in texts.values()]
    gram, doc, place = suffixes.anchors(raw)
    suffix = suffixes.records(raw, doc, place)
    order = sorted(range(len(doc)), key=lambda k: (suffix[k].tobytes(), doc[k]))
    rows = []
    for part in np.array_split(np.array(order), buckets):
        b = pa.RecordBatch.from_arrays([pa.array([suffix[k].tobytes() for k in part], pa.binary()), pa.array(doc[part]), pa.array(place[part].astype(np.int32))], ["suffix", "uid", "place"])
        rows += pa.Table.from_batches(list(suffixes._compared(iter([b.slice(0, 7), b.slice(7)]))) or [pa.RecordBatch.from_pylist([])]).to_pylist()
    least = {}
    for x in rows:
        if x["window"] is not None:
            least[x["window"]] = min(x["uid"], least.get(x["window"], x["uid"]))
    gone = collections.defaultdict(set)
    for x in rows:
        if x["window"] is None or x["uid"] > least[x["window"]]:
            gone[x["uid"]] |= set(range(x["start"], x["end"]))
    seen = set()
    for i, t in enumerate(raw):
        windows = [t[k : k + 50] for k in range(len(t) - 49)]
        assert gone[i] == {k + j for k, w in enumerate(windows) if w in seen for j in range(50)}
        seen |= set(windows)


def test_suffixes_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "A_BUCKET", 40)
    r = random.Random(9)
    passage = prose(r, 40)
    rows = [(i, f"{prose(r, 20)}{passage}{prose(r, 5)}" if i % 3 else "ab" * (40 + i)) for i in range(60)]
    got = suffixes.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in got} == brute_suffixes(dict(rows))


def test_multikey_order():
    r = np.random.default_rng(0)
    w = r.integers(0, 3, (5000, 6)).astype(np.uint64)
    order, new = suffixes.multikey_order(w)
    rows = [tuple(x) for x in w[order].tolist()]
    assert rows == sorted(rows) and new.tolist() == [k == 0 or rows[k] != rows[k - 1] for k in range(len(rows))]


def test_sentence_spans(docs):
    texts = texts_of(docs)
    pieces = {}
    for i, t in texts.items():
        b = t.encode()
        ends = [0, *sentence_spans.sentence_ends(b)]
        assert b"".join(b[x:y] for x, y in zip(ends, ends[1:], strict=False)) == b
        pieces[i] = [b[x:y] for x, y in zip(ends, ends[1:], strict=False)]
    seen, want = set(), {}
    for i in sorted(pieces):
        norm = [p.lower().split() for p in pieces[i]]
        gone = set()
        for k in range(len(norm)):
            e = next((e for e in range(k + 1, len(norm) + 1) if sum(map(len, norm[k:e])) >= 20), None)
            if e:
                run = tuple(b" ".join(x) for x in norm[k:e])
                if run in seen:
                    gone |= set(range(k, e))
                seen.add(run)
        want[i] = b"".join(p for k, p in enumerate(pieces[i]) if k not in gone).decode()
    got = sentence_spans.without_repeats(docs).collect()
    assert {r.doc_id: r.kept_text for r in got} == want
    assert sum(r.n_removed > 0 for r in got) >= 5


@pytest.mark.parametrize("run", [exact_dedup.exact_groups, near_dedup.near_copies, sentence_spans.without_repeats, suffixes.without_repeats])
def test_string_ids(spark, docs, run):
    """They are compared as strings."""
    few = docs.where("text IS NOT NULL").selectExpr("lpad(doc_id, 9, '0') AS doc_id", "text")
    back = lambda rows: sorted(tuple(int(v) if k.endswith("_id") else v for k, v in r.asDict().items()) for r in rows.collect())
    assert back(run(few)) == back(run(docs.where("text IS NOT NULL")))


@pytest.mark.parametrize("run", [exact_dedup.exact_groups, near_dedup.near_copies, sentence_spans.without_repeats, suffixes.without_repeats])
def test_empty_and_clashing(spark, docs, run):
    assert run(spark.createDataFrame([], DOCS)).count() == 0
    clash = docs.selectExpr("doc_id", "text", "'x' AS uid", "1 AS label", "'y' AS key", "0 AS n", "'z' AS hits")
    assert run(clash).count() == docs.count()
    again = docs.unionByName(docs.where("doc_id < 3"))
    assert run(again).count() == docs.count() + 3


def boilerplate_crowd(n=500, pairs=80):
    """Texts of 990 different words, 900 of them in all: 0.83 alike, and 0.854 in each of the planted pairs."""
    shared = " ".join(f"b{k}" for k in range(900))
    own = [[f"w{i}x{k}" for k in range(90)] for i in range(n)]
    for p in range(pairs):
        own[n - 1 - p][:12] = own[p][:12]
    return [(i, shared + " " + " ".join(w), None, None, 0) for i, w in enumerate(own)], {i: min(i, n - 1 - i) if min(i, n - 1 - i) < pairs else i for i in range(n)}


def test_near_copies_inside_a_large_crowd(spark):
    """A family below the limit in whose crowds every planted pair is found."""
    rows, expected = boilerplate_crowd(2500, 150)
    got = near_dedup.near_copies(spark.createDataFrame(rows, DOCS).repartition(8), words=1, similarity=85).collect()
    assert {r.doc_id: r.component_id for r in got} == expected


def test_near_copies_inside_a_crowd(spark):
    rows, expected = boilerplate_crowd()
    sets = [set(r[1].split()) for r in rows]
    links = {(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])}
    assert links == {(i, k) for i, k in expected.items() if i != k}
    got = near_dedup.near_copies(spark.createDataFrame(rows, DOCS), words=1, similarity=85).collect()
    assert {r.doc_id: r.component_id for r in got} == expected


def test_shingle_join_of_blocks(spark, monkeypatch):
    """With every shingle hot, the pairs of all blocks are met."""
    monkeypatch.setattr(near_dedup, "least_likely", lambda similarity: 0.0)
    r = random.Random(8)
    sets = [np.unique(np.array(r.sample(range(60), 40), np.uint64)) for _ in range(90)]
    reg = near_dedup.registers(sets)
    brute = {(i, j) for i in range(90) for j in range(i + 1, 90) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 60 * len(np.union1d(sets[i], sets[j]))}
    assert brute
    for block, hosts in ((256, 0), (8, 0), (8, 40), (256, 40)):
        monkeypatch.setattr(near_dedup, "BLOCK", block)
        rows = [(i, i, i >= hosts, len(s), reg[i].tobytes(), s.tobytes()) for i, s in enumerate(sets)]
        df = spark.createDataFrame(rows, "uid long, label long, guest boolean, n_shingles long, reg binary, shingles binary")
        got = {(x.a, x.b) for x in near_dedup.joined_by_shingles(df, 60).collect()}
        assert {(a, b) for a, b in brute if b >= hosts} <= got and not any(a < hosts and b < hosts for a, b in got)


@pytest.mark.parametrize("per_cent", [80, 85])
def test_parities_keep_pairs_at_the_limit_and_tell_those_below_it(per_cent):
    r = np.random.default_rng(per_cent)
    kept = {0: 0, 8: 0}
    for n in (3, 20, 200, 1000, 4000):
        for below in kept:
            passed, rounds = 0, 300
            for _ in range(rounds):
                both = -((-(per_cent - below) * 2 * n) // (100 + per_cent - below))  # shared of two sets of n shingles
                x = r.integers(0, 2**63, 2 * n - both, dtype=np.uint64)
                a, b = x[:n], np.concatenate([x[:both], x[n:]])
                differ = int(np.bitwise_count(np.frombuffer(near_dedup.parities(a), np.uint8) ^ np.frombuffer(near_dedup.parities(b), np.uint8)).sum())
                passed += differ <= near_dedup.most_different(np.array([2 * n]), per_cent)[0]
            assert below or passed == rounds
            if n in (200, 1000):
                kept[below] += passed
    assert kept[8] < 0.02 * kept[0]


def test_a_crowd_below_the_limit_makes_next_to_no_pairs(spark):
    """Edits of one template that is not in the table itself, 0.76 alike: the join puts out nearly nothing."""
    r, words = random.Random(3), [f"t{k}" for k in range(1000)]
    texts = []
    for _ in range(300):
        own = list(words)
        for k in r.sample(range(1000), 70):
            own[k] = f"e{r.randrange(3000)}"
        texts.append(" ".join(own))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "uid long, text string")
    sets = df.mapInArrow(near_dedup._set_of(3), "uid long, shingles binary")
    rows = [(x.uid, x.uid, True, len(x.shingles) // 8, near_dedup.registers([np.frombuffer(x.shingles, np.uint64)])[0].tobytes(), bytes(x.shingles)) for x in sets.collect()]
    join = spark.createDataFrame(rows, "uid long, label long, guest boolean, n_shingles long, reg binary, shingles binary")
    assert near_dedup.joined_by_shingles(join, 85).count() < 10 * len(texts)


@pytest.mark.parametrize("per_cent", [80, 85])
def test_estimate_loses_next_to_no_pair_at_the_limit(per_cent):
    n, s = near_dedup.BANDS * near_dedup.ROWS, per_cent / 100
    tail = 0.0
    for equal in range(n + 1):
        greater = (n - equal) // 2
        a = np.zeros((1, n), np.uint16)
        b = np.zeros((1, n), np.uint16)
        a[0, :greater], b[0, greater : n - equal] = 1, 1
        if near_dedup.estimate(a, b, np.array([1000.0]), np.array([1000.0]))[0] < near_dedup.least_likely(per_cent):
            tail += math.comb(n, equal) * s**equal * (1 - s) ** (n - equal)
    assert 0 < tail <= 1e-6


def test_passages_of_51_words_in_running_text(spark):
    """Each passage stands in two foreign contexts without punctuation, or with long sentences; all are found."""
    r = random.Random(51)
    some = lambda n, stop: " ".join(r.choice("abcdefgh") * 2 + str(r.randrange(5000)) + (stop if k % 23 == 22 else "") for k in range(n))
    rows = []
    for i in range(400):
        stop = ["", "."][i % 2]
        passage = some(51, stop)
        rows += [(2 * i, f"{some(r.randrange(40), stop)} {passage} {some(r.randrange(40), stop)}".strip(), None, None, 0)]
        rows += [(2 * i + 1, f"{some(r.randrange(40), stop)} {passage} {some(r.randrange(40), stop)}".strip(), None, None, 0)]
    got = {x.doc_id: x for x in sentence_spans.without_repeats(spark.createDataFrame(rows, DOCS)).collect()}
    assert [i for i in got if i % 2 and got[i].n_removed == 0] == []
    assert sum(got[i].n_removed for i in got if i % 2 == 0) == 0
    for _, text, *_ in rows:
        at = [0, *sentence_spans.sentence_ends(text.encode())]
        assert max(len(text.encode()[a:b].split()) for a, b in zip(at, at[1:])) <= 8


def test_no_run_of_under_20_words_is_removed(spark, docs):
    """Common phrases stay, however often they stand; what goes is 20 words long at least."""
    r = random.Random(20)
    phrase = " of of of. and and and. eaon of in."
    rows = [(1000 + i, " ".join(f"{prose(r, 25)}{phrase}" for _ in range(4)), None, None, 0) for i in range(30)] + [(1100 + i, f"One. Two. Three. {prose(r, 30)}", None, None, 0) for i in range(20)]
    rows += [(1200 + i, "Same here. " * (3 + i), None, None, 0) for i in range(12)]
    removed = 0
    for x in sentence_spans.without_repeats(spark.createDataFrame(rows, DOCS).unionByName(docs)).join(spark.createDataFrame(rows, DOCS).unionByName(docs).select("doc_id", "text"), "doc_id").collect():
        text = (x.text or "").encode()
        ends = [0, *sentence_spans.sentence_ends(text)]
        pieces, kept = [text[a:b] for a, b in zip(ends, ends[1:], strict=False)], x.kept_text.encode()
        if not x.n_removed:
            assert kept == text
            continue
        # the longest runs that can be left out so that the rest is what was kept, from the front
        run, at = [], 0
        for p in pieces:
            if kept[at : at + len(p)] == p:
                at += len(p)
                assert not run or sum(map(len, run)) >= 20
                run = []
            else:
                run.append(p.split())
        removed += 1
    assert removed > 5
    got = {x.doc_id: x.n_removed for x in sentence_spans.without_repeats(spark.createDataFrame(rows, DOCS)).collect()}
    assert all(got[i] == 0 for i in got if i < 1200) and got[1211] > 0
