import json
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from cuelark.operators import accumulate, analysis, segments
from cuelark.streaming import transcripts as T
from cuelark.streaming.rolling import rolling_rewrite

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def event(session, arrival, seq, kind, up_to, *words):
    return {"session_id": session, "arrival": arrival, "type": kind, "sequence": seq, "up_to": up_to, "words": [{"word": w, "start_time": a, "end_time": b} for w, a, b in words]}


def test_accumulator_stream_and_rolling_artefacts(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    (tmp_path / "in").mkdir()
    files = [
        [event("s", 0, 0, "final_words", 0.65, ("hello", 0.0, 0.3), ("world.", 0.31, 0.65)), event("t", 0, 0, "partial", 0.0, ("hi", 0.0, 0.4))],
        [event("s", 1, 1, "final_words", 1.0, ("world.", 0.31, 0.65), ("again", 0.66, 1.0)), event("s", 2, 0, "final_words", 2.0, ("late", 1.5, 2.0))],
    ]
    for k, f in enumerate(files):
        path = tmp_path / "in" / f"{k}.json"
        path.write_text("\n".join(map(json.dumps, f)))
        os.utime(path, (1.7e9 + 60 * k,) * 2)  # files are read in the order of their times
    seen = []

    def render(words):
        w = words.select(F.col("session_id").alias("recording_id"), F.col("position").alias("i"), "word", "start_time", "end_time")
        return segments.srt_cues(segments.build_segments(w)).select(F.col("recording_id").alias("session_id"), "segment", "cue")

    roll = rolling_rewrite(str(tmp_path / "out"), render, buckets=4)

    def each(batch, epoch):
        batch.persist()
        parts = T.routed(batch)
        seen.append((T.committed_lines(batch).collect(), parts["preview"].collect(), parts["errors"].collect()))
        roll(batch, epoch)
        batch.unpersist()

    stream = T.accumulated_stream(T.event_source(spark, str(tmp_path / "in")))
    stream.writeStream.foreachBatch(each).option("checkpointLocation", str(tmp_path / "state")).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    assert [[(r.sequence, r.n, r.text) for r in b[0]] for b in seen if any(b)] == [[(0, 2, "hello world.")], [(1, 1, "again")]]
    assert [(r.session_id, r.pending) for b in seen for r in b[1]] == [("t", "hi")]
    assert [(r.session_id, r.sequence, r.error) for b in seen for r in b[2]] == [("s", 0, "out of order: 0 after 1")]
    cues = spark.read.parquet(f"{tmp_path}/out/artefacts").where("session_id = 's'").orderBy("segment").collect()
    assert [r.cue.split("\n")[2] for r in cues] == ["hello world.", "again"]


@pytest.mark.parametrize("files_a_trigger", [1, 5])
def test_stream_and_batch_agree_on_shuffled_events(spark, tmp_path, files_a_trigger):
    """Out-of-order, repeated, revised and unchecked events; the stream's batches are cut anywhere between arrivals."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    r, rows = random.Random(files_a_trigger), []
    for session in "abc":
        order = [(k, kind) for k in range(12) for kind in ("partial", "final_words")] + [(-1, "final_words"), (3, "final_words"), (20, "other")]
        order.sort(key=lambda x: max(x[0], 0) + r.uniform(0, 2.5))
        for arrival, (k, kind) in enumerate(order):
            at = max(k, 0) * 0.9
            rows.append(event(session, arrival, k, kind, at + 1.0, *[(r.choice(["a", "b", "c."]), round(at + 0.3 * j, 3), round(at + 0.3 * j + 0.25, 3)) for j in range(4)]))
    rows.sort(key=lambda x: x["arrival"])
    (tmp_path / "in").mkdir()
    for k in range(0, len(rows), 20):
        path = tmp_path / "in" / f"{k:03}.json"
        path.write_text("\n".join(map(json.dumps, rows[k : k + 20])))
        os.utime(path, (1.7e9 + k,) * 2)
    stream = T.accumulated_stream(T.event_source(spark, str(tmp_path / "in"), files_a_trigger=files_a_trigger))
    q = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    q.awaitTermination()
    batch = accumulate.accumulated(spark.read.schema(T.EVENT).json(str(tmp_path / "in")))
    columns = sorted(batch.columns)
    got, want = (sorted(map(str, df.select(*columns).collect())) for df in (spark.read.schema(stream.schema).parquet(str(tmp_path / "out")), batch))
    assert got == want and sum("out of order" in x for x in got) > 3 and sum("already" in x for x in got) > 0 and sum("unknown" in x for x in got) > 0


def test_idle_sessions_expire_in_a_stream(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    (tmp_path / "in").mkdir()
    base = {"session_id": "s", "connection": "c1", "sequence": 0, "pts": 0.0, "duration": 0.5, "sample_rate": 16000, "channels": 1, "format": "pcm_s16le", "n_bytes": 10}
    seen = []

    def put(k, *events):
        (tmp_path / f"{k}").write_text("\n".join(json.dumps(base | {"arrival": 10 * k + i} | e) for i, e in enumerate(events)))
        (tmp_path / f"{k}").rename(tmp_path / "in" / f"{k}.json")

    def until(n):
        began = time.time()
        while len(seen) < n and time.time() - began < 90:
            time.sleep(0.2)
        return seen[:n]

    source = spark.readStream.schema(T.SESSION_EVENT).json(str(tmp_path / "in"))
    q = T.session_stream(source, 2000).writeStream.foreachBatch(lambda b, _: seen.extend((r.type, r.code) for r in b.orderBy("arrival").collect()))
    q = q.option("checkpointLocation", str(tmp_path / "state")).trigger(processingTime="500 milliseconds").start()
    try:
        put(0, {"type": "start"}, {"type": "start"}, {"type": "start", "connection": "c2"})
        assert until(3) == [("started", None), ("error", "protocol-error"), ("error", "session-already-exists")]
        time.sleep(8)  # idle for longer than the timer
        put(1, {"type": "audio"}, {"type": "start"}, {"type": "start", "connection": "c2"}, {"type": "audio", "n_bytes": None})
        assert until(7)[3:] == [("error", "session-not-found"), ("error", "protocol-error"), ("started", None), ("error", "server-error")]
    finally:
        q.stop()


def test_summary_files_and_pace(spark, tmp_path):
    m = spark.createDataFrame([("a", 1), ("b", 2)], "session_id string, chunks int")
    write = T.summary_overwrite(str(tmp_path / "m"))
    write(m, 0)
    write(m.where("session_id = 'a'").withColumn("chunks", F.lit(9)), 1)
    assert sorted((r.session_id, r.chunks) for r in spark.read.json(str(tmp_path / "m")).collect()) == [("a", 9), ("b", 2)]

    class Writer:
        def trigger(self, **how):
            return how

    assert T.paced(Writer(), 5.0, 2.0) == {"processingTime": "2500 milliseconds"} and T.paced(Writer(), 5.0, 0) == {"availableNow": True}


def test_metrics_in_a_stream(spark, tmp_path):
    (tmp_path / "m").mkdir()
    rows = [{"session_id": "s", "sequence": k, "start": 4.5 * k, "duration": 5.0, "committed": 10 * k, "server_ms": 100 + k, "end_to_end_ms": 200} for k in range(3)]
    (tmp_path / "m" / "a.json").write_text("\n".join(map(json.dumps, rows)))
    chunks = spark.readStream.schema("session_id string, sequence long, start double, duration double, committed int, server_ms int, end_to_end_ms int").json(str(tmp_path / "m"))
    q = analysis.session_metrics(chunks).writeStream.format("memory").queryName("metrics").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    m = spark.table("metrics").first()
    assert (m.chunks, m.committed_words, m.audio_seconds) == (3, 20, 14.0)
