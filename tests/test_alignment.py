import random
import re
from difflib import SequenceMatcher

import numpy as np
import pytest

from cuelark.operators import alignment, analysis

WORDS = "recording_id string, i int, word string, start_time double, end_time double"


def form(word):
    return re.sub(r"^[\W_]+|[\W_]+$", "", (word or "").lower())


def plain(base, run):
    out = []
    for rec in {r[0] for r in base} | {r[0] for r in run}:
        a, b = (sorted((r for r in rows if r[0] == rec), key=lambda r: (r[3], r[1])) for rows in (base, run))
        for tag, i1, i2, j1, j2 in SequenceMatcher(a=[form(r[2]) for r in a], b=[form(r[2]) for r in b], autojunk=False).get_opcodes():
            at = a[i1][3] if i1 < len(a) else a[-1][4] if a else 0.0
            near = [" ".join(r[2] or "" for r in x[max(0, s - 8) : e + 8]) if tag != "equal" else "" for x, s, e in ((a, i1, i2), (b, j1, j2))]
            out.append((rec, tag, i1, i2, j1, j2, at, *near))
    return sorted(out)


def spoken(rec, words):
    return [(rec, i, w, round(0.4 * i, 3), round(0.4 * i + 0.3, 3)) for i, w in enumerate(words)]


def edited(r, words, vocabulary):
    out = []
    for w in words:
        x = r.random()
        out += [] if x < 0.04 else [w, r.choice(vocabulary)] if x < 0.08 else [r.choice(vocabulary)] if x < 0.12 else [w]
    return out


def corpus():
    r, base, run = random.Random(11), [], []
    few, many = ["the", "a", "of", "um,", "It"], [f"w{k}" for k in range(300)]
    for rec, vocabulary, n in (("few", few, 140), ("many", many, 260), ("mixed", few + many, 400)):
        words = [r.choice(vocabulary) for _ in range(n)]
        base += spoken(rec, words)
        run += spoken(rec, edited(r, words, vocabulary))
    words = [f"p{k % 50}" for k in range(400)]
    base += spoken("periodic", [w for k, w in enumerate(words) if k % 23])
    run += spoken("periodic", words)
    base += spoken("same", words[:90]) + spoken("gone", ["only", "here"]) + spoken("other", ["x"] * 60 + ["One,", "two"])
    run += spoken("same", words[:90]) + spoken("new", ["only", "there", None]) + spoken("other", ["y"] * 70 + ["one", "Two!"])
    return base, run


@pytest.mark.parametrize("most", [4000, 40])
def test_regions_equal_the_plain_rule(spark, most):
    base, run = corpus()
    got = sorted(tuple(r) for r in alignment.aligned(spark.createDataFrame(base, WORDS), spark.createDataFrame(run, WORDS), most).collect())
    assert got == plain(base, run) and len(got) > 150


def test_a_long_recording_is_split(spark):
    """Stretches of over 2,000 words, with runs across the borders of the places that are looked at together."""
    r = random.Random(3)
    vocabulary = [f"v{k}" for k in range(5000)]
    words = [r.choice(vocabulary) for _ in range(13_000)]
    base, run = spoken("r", words), spoken("r", words[:6000] + edited(r, words[6000:7500], vocabulary) + words[7500:])
    got = sorted(tuple(x) for x in analysis.aligned(spark.createDataFrame(base, WORDS), spark.createDataFrame(run, WORDS)).collect())
    assert got == plain(base, run)


def test_empty_tables(spark):
    none = spark.createDataFrame([], WORDS)
    some = spark.createDataFrame(spoken("r", ["a", "b"]), WORDS)
    assert analysis.aligned(none, none).count() == 0
    assert [tuple(r)[:7] for r in analysis.aligned(none, some).collect()] == [("r", "insert", 0, 0, 0, 2, 0.0)]
    assert [tuple(r)[:7] for r in analysis.aligned(some, none).collect()] == [("r", "delete", 0, 2, 0, 0, 0.0)]
    assert analysis.alignment_summary(analysis.aligned(some, none)).first().base_words == 2


def test_nothing_that_grows_with_the_words_goes_through_the_driver(spark):
    base, run = corpus()
    plan = alignment.aligned(spark.createDataFrame(base, WORDS), spark.createDataFrame(run, WORDS))._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "BroadcastHashJoin" not in plan


def test_common_runs_are_those_of_difflib():
    r = random.Random(5)
    for k in range(300):
        a, b = ([r.randrange(1 + k % 30) for _ in range(r.randrange(90))] for _ in range(2))
        want = SequenceMatcher(a=a, b=b, autojunk=False).get_matching_blocks()
        got = {(i + x, j + x) for i, j, n in alignment.common_runs(np.array(a, int), np.array(b, int)) for x in range(n)}
        assert got == {(m.a + x, m.b + x) for m in want for x in range(m.size)}


def test_compared_regions_equal_the_plain_rule(spark):
    base, run = corpus()
    got = alignment.compared(spark.createDataFrame(base, WORDS), spark.createDataFrame(run, WORDS)).collect()
    assert sorted(tuple(r) for r in got) == [r[:6] for r in plain(base, run)]


def test_alignment_summary_looks_up_no_words_around(spark):
    registry = pytest.importorskip("cuelark.plans.registry")
    plan = registry.alignment_summary(spark, "/root/testdata/sf0.001")._jdf.queryExecution().analyzed().toString()
    assert "base_words" in plan and "context" not in plan
