import random

import pytest
from pyspark.sql import functions as F

from cuelark.operators import accumulate, long_sessions, scan, segments
from cuelark.sources import tables

WORD = "struct<word:string,start_time:double,end_time:double>"
EVENTS = f"session_id string, arrival long, type string, sequence long, up_to double, words array<{WORD}>"


def shuffled_events(seed: int, sessions: str, n: int, calm: bool = False) -> list[tuple]:
    """Overlapping windows that come out of order, twice, revised, unchecked, late or of an unknown type; words repeat a few forms.
    In calm ones unchecked events come at their time, up_to covers an event's words, and there are more forms."""
    r, rows = random.Random(seed), []
    for session in sessions:
        order = [(k, kind) for k in range(n) for kind in ("partial", "final_words")] + [(r.randrange(n), "final_words") for _ in range(n // 6)] + [(-1, "final_words")] * (0 if calm else n // 9) + [(r.randrange(n), "other") for _ in range(3)]
        order.sort(key=lambda x: (x[0] if x[0] >= 0 else r.randrange(n)) + r.uniform(0, 2.5))
        for arrival, (k, kind) in enumerate(order):
            at = (k if k >= 0 else r.randrange(n)) * 0.9
            words = [(f"w{r.randrange(40)}" if calm else r.choice(["a", "A.", "b", "c.", " "]), round(at + 0.3 * j + r.uniform(0, 0.1), 3), round(at + 0.3 * j + 0.25, 3)) for j in range(4)]
            if r.random() < 0.05:
                words.reverse()
            if calm and r.random() < 0.1:
                k = -1
            rows.append((session, arrival, kind, k, at + (1.3 if calm else r.choice([1.0, 0.4])), words))
    return rows


def sorted_rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_parts_equal_the_fold_on_shuffled_events(spark, seed):
    e = spark.createDataFrame(shuffled_events(seed, "ab", 90), EVENTS).unionByName(spark.createDataFrame(shuffled_events(seed, "c", 5), EVENTS))
    want = sorted_rows(accumulate.accumulated(e))
    assert sorted_rows(long_sessions.accumulated_in_parts(e, tasks=16)) == want
    assert sum("out of order" in x for x in want) > 5 and sum("already" in x for x in want) > 3 and sum("unknown" in x for x in want) > 0


def test_one_session_over_many_tasks(spark):
    e = spark.createDataFrame(shuffled_events(7, "x", 400, calm=True), EVENTS)
    checked = long_sessions.checked(e, tasks=24)
    parts = long_sessions.parts(checked)
    assert parts.select("part").distinct().count() >= 8
    assert sorted_rows(long_sessions.accumulated_in_parts(e, tasks=24)) == sorted_rows(accumulate.accumulated(e))


@pytest.mark.parametrize("seed", [4, 5])
def test_join_equals_the_fold_on_shuffled_events(spark, seed):
    e = spark.createDataFrame(shuffled_events(seed, "ab", 40), EVENTS)
    columns = ["session_id", "arrival", "sequence", "word", "start_time", "end_time"]
    want = accumulate.accumulated(e).where("word IS NOT NULL").select(*columns)
    assert sorted_rows(long_sessions.committed_by_join(e, tasks=6).select(*columns)) == sorted_rows(want)


def test_chains_outlasting_and_unsorted_words_go_to_the_fold(spark):
    chain = [("chain", 0, "final_words", 0, 0.9, [("a", 0.5, 0.9)]), ("chain", 1, "final_words", 1, 1.0, [("a", 0.8, 1.2)]), ("chain", 2, "final_words", 2, 1.0, [("a", 1.1, 1.5)])]
    lasting = [("lasting", 0, "final_words", 0, 0.9, [("a", 0.5, 0.9)]), ("lasting", 1, "final_words", 1, 0.9, [("a", 0.7, 1.2)]), ("lasting", 2, "final_words", 2, 0.9, [("b", 0.8, 1.0)])]
    broken = [("unsorted", 0, "final_words", 0, 0.0, [("a", 4.0, 4.2), ("b", 1.0, 1.2), ("a", 4.1, 4.3)])]
    plain = [("plain", 0, "final_words", 0, 1.0, [("a", 0.5, 0.9), ("a", 0.6, 1.0), (" ", 0.0, 5.0), (None, 0.0, 9.0)]), ("plain", 1, "final_words", None, None, None)]
    e = spark.createDataFrame(chain + lasting + broken + plain, EVENTS)
    columns = ["session_id", "arrival", "word", "start_time"]
    got = sorted(tuple(r) for r in long_sessions.committed_by_join(e).select(*columns).collect())
    assert got == sorted(tuple(r) for r in accumulate.accumulated(e).where("word IS NOT NULL").select(*columns).collect())
    assert [r[:2] for r in got] == [("chain", 0), ("chain", 2), ("lasting", 0), ("lasting", 2), ("plain", 0), ("unsorted", 0), ("unsorted", 0), ("unsorted", 0)]


def test_empty_events(spark):
    e = spark.createDataFrame([], EVENTS)
    assert long_sessions.accumulated_in_parts(e).count() == 0 and long_sessions.committed_by_join(e).count() == 0 and long_sessions.final_times(e).count() == 0


def test_scan_with_several_levels(spark):
    rows = [(k, p, r) for k in "ab" for p, r in ((p, random.Random(p).randrange(100)) for p in range(0, 90, 2 if k == "a" else 3))]
    parts = spark.createDataFrame(rows, "k string, place long, value long")
    add = lambda a, x: a + x
    got = {(r.k, r.place): r.before for r in scan.exclusive(parts, "k", F.lit(0).cast("long"), add, add, fan=4).collect()}
    assert got == {(k, p): sum(v for kk, q, v in rows if kk == k and q < p) for k, p, _ in rows}


def test_running_maximum_spreads_a_hot_key(spark):
    rows = [("hot", i, float((i * 37) % 101 + i / 10)) for i in range(3000)] + [("cold", i, 1.0 * i) for i in range(5)] + [("none", 0, None)]
    b = scan.blocks(spark.createDataFrame(rows, "k string, i long, x double"), "k", "i", tasks=12)
    assert b.where("k = 'hot'").select("place").distinct().count() > 6
    got = {(r.k, r.i): r.before for r in scan.running(b, "k", "i", F.col("x"), F.lit(0.0)).collect()}
    for k in ("hot", "cold", "none"):
        most = 0.0
        for kk, i, x in rows:
            if kk == k:
                assert got[k, i] == most
                most = max(most, x or 0.0)


def talk(seed: int, recordings: int, n: int):
    r = random.Random(seed)
    for rec in range(recordings):
        t = 0.0
        for i in range(r.randrange(1, n)):
            word = r.choice(["", "a", "été", "long-word-" * r.randrange(1, 4), "end.", "really?", None, "x" * r.randrange(1, 150)] + ["word"] * 10)
            t += r.choice([0.1, 0.2, 0.3, 20.0 if r.random() < 0.02 else 0.1])
            yield rec, i, word, round(t, 3), round(t + r.uniform(-0.3, 0.5), 3)


WORDS = "recording_id long, i int, word string, start_time double, end_time double"


@pytest.mark.parametrize("options", [{}, {"max_bytes": 7, "max_seconds": 2.0}, {"close_tail": True}])
def test_block_segments_equal_the_fold(spark, options):
    w = spark.createDataFrame(list(talk(3, 12, 900)) + [(99, i, "", 0.1 * i, 0.1 * i) for i in range(700)], WORDS)
    got = segments.block_segments(w, block_words=150, **options)
    assert sorted_rows(got) == sorted_rows(segments.folded_segments(w, **options)) and got.count() > 100


def test_long_recordings_are_cut_into_blocks(spark, monkeypatch):
    w = spark.createDataFrame([(1, i, f"word{i}", 0.3 * i, 0.3 * i + 0.2) for i in range(40_000)] + [(2, 0, "short.", 0.0, 1.0)], WORDS)
    got = segments.build_segments(w)
    assert "applyInPandas" in str(got._jdf.queryExecution().analyzed()) or "FlatMapGroupsInPandas" in str(got._jdf.queryExecution().analyzed())
    assert sorted_rows(got) == sorted_rows(segments.folded_segments(w))
    with pytest.raises(ValueError):
        segments.block_segments(w, block_words=100)


def test_intermediate_tables_are_released(spark):
    scan.blocks(spark.createDataFrame([(1, 2)], "k int, i int"), "k", "i")
    assert tables.folders(spark, f"{tables.shared_folder(spark)}/work/*")
    tables.release(spark)
    assert not tables.folders(spark, f"{tables.shared_folder(spark)}/work/*")
