from types import SimpleNamespace as Event

from cuelark.streaming.progress import Progress


def test_progress_rows():
    p = Progress(keep=2, estimated_chunks=7)
    p.onQueryStarted(Event(runId="a", timestamp="2024-01-01T00:00:00.000Z"))
    for k in range(3):
        p.onQueryProgress(Event(progress=Event(runId="a", batchId=k, numInputRows=k, processedRowsPerSecond=1.0, timestamp=f"2024-01-01T00:00:0{k}.500Z")))
    assert [(r["batch"], r["elapsed"], r["estimated_chunks"]) for r in p.rows] == [(1, 1.5, 7), (2, 2.5, 7)]
    p.onQueryTerminated(Event(runId="a"))
    p.onQueryProgress(Event(progress=Event(runId="b", batchId=0, numInputRows=0, processedRowsPerSecond=0.0, timestamp="2024-01-01T00:00:09.000Z")))
    assert p.rows[-1]["elapsed"] is None
