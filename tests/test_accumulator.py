import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from cuelark.operators.accumulate import END_TOLERANCE, FINAL, PARTIAL, State, accumulated, apply_event


def committed(*events):
    s, out = State(), []
    for kind, seq, up_to, words in events:
        new, error = apply_event(s, kind, seq, up_to, words)
        assert error is None
        out += new
    return s, [w[0] for w in out]


def test_overlap_and_near_duplicates():
    assert committed((FINAL, -1, 0, [("hello", 0, 0.3), ("world", 0.31, 0.65)]), (FINAL, -1, 0, [("world", 0.31, 0.65), ("again", 0.66, 1.0)]))[1] == ["hello", "world", "again"]
    assert committed((FINAL, -1, 0, [("streaming", 1.0, 1.4)]), (FINAL, -1, 0, [("streaming.", 1.08, 1.43)]))[1] == ["streaming"]
    assert committed((FINAL, 0, 0, [("a", 0.5, 1.0), ("a", 0.6, 1.2)]))[1] == ["a"]


def test_partials_are_revised_and_promoted():
    s, out = committed((PARTIAL, 0, 0, [("hello", 0, 0.3), ("wor", 0.31, 0.5)]), (PARTIAL, 0, 0, [("hello", 0, 0.3), ("world", 0.31, 0.65)]))
    assert [w[0] for w in s.pending] == ["hello", "world"] and out == []
    new, _ = apply_event(s, FINAL, 0, 0.65, [("hello", 0, 0.3), ("world", 0.31, 0.65)])
    assert len(new) == 2 and s.pending == [] and s.last_final >= 0.65
    apply_event(s, PARTIAL, 1, 0, [("world", 0.31, 0.65), ("again", 0.66, 1.0)])
    assert [w[0] for w in s.pending] == ["again"]


def test_sequences():
    s = State()
    assert apply_event(s, FINAL, 1, 0, [])[1] is None
    assert "out of order" in apply_event(s, FINAL, 0, 0, [])[1]
    assert "finalised" in apply_event(s, PARTIAL, 1, 0, [])[1]
    assert "unknown" in apply_event(s, "other", 2, 0, [])[1]


word = st.tuples(st.sampled_from(["a", "b", " ", "um,"]), st.floats(0, 5), st.floats(0, 1)).map(lambda w: (w[0], w[1], w[1] + w[2]))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.floats(0, 6), st.lists(word, max_size=6)), max_size=6))
def test_committed_words_end_late_enough_and_reapplying_adds_nothing(events):
    s = State()
    for up_to, words in events:
        before = s.last_final
        new, _ = apply_event(s, FINAL, -1, up_to, words)
        assert all(w[2] > before + END_TOLERANCE for w in new)
    if events and events[-1][1]:
        assert apply_event(s, FINAL, -1, *events[-1])[0] == []


def test_batch_form(spark):
    w = lambda *x: [{"word": a, "start_time": b, "end_time": c} for a, b, c in x]
    rows = [("s", 0, FINAL, 0, 0.65, w(("hello", 0.0, 0.3))), ("s", 1, FINAL, 1, 1.0, w(("hello", 0.0, 0.3), ("again", 0.66, 1.0))), ("s", 2, FINAL, 1, 2.0, w(("late", 1.5, 1.9))), ("t", 0, PARTIAL, 0, 0.0, None)]
    e = spark.createDataFrame(rows, "session_id string, arrival long, type string, sequence long, up_to double, words array<struct<word:string,start_time:double,end_time:double>>")
    got = accumulated(e).toPandas()
    assert got[got.word.notna()].word.tolist() == ["hello", "again"] and got.error.notna().sum() == 1 and got[got.pending.notna() & got.error.isna()].session_id.tolist() == ["t"]
    assert isinstance(got, pd.DataFrame)
