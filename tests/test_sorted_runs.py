import pyarrow as pa
import pytest

from cuelark.operators import accumulate, sorted_runs


def batches(rows, size):
    whole = pa.RecordBatch.from_pylist(rows)
    return [whole.slice(k, size) for k in range(0, len(rows), size)]


@pytest.mark.parametrize("size", [1, 3, 7, 100])
def test_keys_are_whole_wherever_batches_end(size):
    rows = [{"k": k, "s": s, "i": i} for k in (1, 2, None) for s in ("a", None) for i in range(1 if s else 9)]
    got = list(sorted_runs.whole_keys(batches(rows, size), ["k", "s"]))
    assert [r for t in got for r in t.to_pylist()] == rows
    ends = [(t.to_pylist()[0], t.to_pylist()[-1]) for t in got]
    for (_, a), (b, _) in zip(ends, ends[1:], strict=False):
        assert (a["k"], a["s"]) != (b["k"], b["s"])
    assert sum(len(sorted_runs.starts(t, ["k", "s"])) for t in got) == 6


def event(key, n, words, kind="final_words"):
    texts, starts, ends = zip(*words, strict=True) if words else ((), (), ())
    return {"session_id": key, "arrival": n, "type": kind, "sequence": n, "up_to": 0.0, "error": None, "texts": list(texts), "starts": list(starts), "ends": list(ends)}


@pytest.mark.parametrize("size", [1, 2, 50])
def test_a_fold_goes_through_sessions_and_batches(size):
    """The state of a session outlives its batch, and none reaches the next session."""
    one = [event("a", 0, [("Hi,", 0.0, 0.3), (None, 0.4, 0.5)]), event("a", 1, [("hi", 0.1, 0.4), ("there", 0.5, 0.9)]), event("a", 2, [("x", 1.0, 1.2)], "partial"), event("a", 1, [])]
    rows = one + [event("b", 0, [("hi", 0.0, 0.3)])]
    schema = pa.schema([("session_id", pa.string()), ("arrival", pa.int64()), ("type", pa.string()), ("sequence", pa.int64()), ("up_to", pa.float64()), ("error", pa.string()), *[(c, pa.list_(t)) for c, t in (("texts", pa.string()), ("starts", pa.float64()), ("ends", pa.float64()))]])
    whole = pa.RecordBatch.from_pylist(rows, schema)
    made = accumulate.folded(["session_id"], accumulate.State)(iter(whole.slice(k, size) for k in range(0, len(rows), size)))
    got = [(r["session_id"], r["arrival"], r["position"], r["word"], r["error"], r["pending"]) for b in made for r in b.to_pylist()]
    assert got == [
        ("a", 0, 0, "Hi,", None, None), ("a", 1, 1, "there", None, None), ("a", 2, None, None, None, "x"),
        ("a", 1, None, None, "out of order: 1 after 2", "x"), ("b", 0, 0, "hi", None, None),
    ]
