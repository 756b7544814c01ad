import json
import os
import random

import pytest
from pyspark.sql import functions as F

from cuelark.operators import accumulate, analysis
from cuelark.streaming import live, pairing, rolling, servers
from cuelark.streaming import transcripts as T

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@pytest.fixture(autouse=True)
def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)


def batches(folder, *rows):
    """Each list of rows as one file, read in this order."""
    folder.mkdir(exist_ok=True)
    start = len(list(folder.iterdir()))
    for k, part in enumerate(rows, start):
        path = folder / f"{k:04}.json"
        path.write_text("\n".join(map(json.dumps, part)))
        os.utime(path, (1.7e9 + k,) * 2)


def run(spark, tmp_path, schema, made, each=None):
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    w = made(source).writeStream.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True)
    if each:
        w.foreachBatch(each).start().awaitTermination()
        return None
    w.format("parquet").option("path", str(tmp_path / "out")).start().awaitTermination()
    return spark.read.schema(made(source).schema).parquet(str(tmp_path / "out"))


class PlainServer:
    """The rules, one event after another, with objects of their own."""

    def __init__(self, idle, least):
        self.sessions, self.bound, self.idle, self.least = {}, {}, idle, least

    def event(self, e):
        g = lambda k, d: d if e.get(k) is None else e[k]
        for name in [n for n, s in self.sessions.items() if e["at"] - s["active"] > self.idle]:
            del self.sessions[name]
        kind, conn = g("type", "").strip(), e["connection"]
        mine = self.bound.get(conn)
        if kind == "disconnect":
            if mine is not None:
                self.sessions.pop(mine, None)
                del self.bound[conn]
            return []
        if kind == "start":
            name = g("session_id", "").strip()
            if mine is not None:
                return [("error", mine, "protocol-error")]
            if name in self.sessions:
                return [("error", name, "session-already-exists")]
            if not name:
                return [("error", name, "invalid-session-id")]
            rate, channels = g("sample_rate", 16000), g("channels", 1)
            if rate <= 0 or channels <= 0 or g("format", "pcm_s16le") != "pcm_s16le":
                return [("error", name, "decoder-error")]
            self.sessions[name] = {"active": e["at"], "next": 0, "rate": rate * channels * 2, "bytes": 0, "pts": None, "done": 0.0}
            self.bound[conn] = name
            return [("started", name, None)]
        if mine is None:
            return [("error", "", "session-not-started")]
        s = self.sessions.get(mine)
        if s is None:
            return [("error", mine, "session-not-found")]
        s["active"] = e["at"]
        length = lambda: round(s["bytes"] / s["rate"], 3)
        begin = lambda: s["done"] if s["pts"] is None else s["pts"]
        if kind == "audio":
            if e.get("n_bytes") is None:
                return [("error", mine, "server-error")]
            if g("sequence", 0) != s["next"]:
                return [("error", mine, "invalid-sequence")]
            if g("pts", 0.0) < 0:
                return [("error", mine, "invalid-pts")]
            if g("duration", 0.0) < 0:
                return [("error", mine, "invalid-duration")]
            s["next"] += 1
            if e["n_bytes"] and s["pts"] is None:
                s["pts"] = g("pts", 0.0)
            s["bytes"] += e["n_bytes"]
            return [("partial", mine, round(begin() + length(), 3))] if s["bytes"] / s["rate"] >= self.least else []
        if kind not in ("flush", "stop"):
            return [("error", mine, "invalid-event-type")]
        had, upto = s["bytes"] > 0, round(begin() + length(), 3)
        if had:
            s["done"] = max(s["done"], upto)
        s["bytes"], s["pts"] = 0, None
        if kind == "flush":
            return [("final_words", mine, upto)]
        del self.sessions[mine], self.bound[conn]
        return [("final_words", mine, upto)] * had + [("stopped", mine, None)]


def server_rows(seed, n=700):
    r, rows, at = random.Random(seed), [], 0.0
    for k in range(n):
        at += r.choice([0.1, 0.5, 1.0]) if r.random() < 0.97 else 40.0
        e = {"server": r.choice("AB"), "connection": r.choice(["c1", "c2", "c3", "c4"]), "arrival": k, "at": at, "type": r.choices(["start", "audio", "flush", "stop", "disconnect", "huh", None, " start "], [4, 12, 3, 1, 1, 1, 1, 1])[0]}
        optional = {"session_id": r.choice(["x", "y", " x ", "", "z"]), "sequence": r.choice([0, 0, 1, 1, 2, 3]), "pts": r.choice([0.0, 1.5, 2.25, -1.0]), "duration": r.choice([0.5, 0.5, -0.1]), "sample_rate": r.choice([16000, 8000, 0]), "channels": r.choice([1, 1, 2, 0]), "format": r.choice(["pcm_s16le"] * 4 + ["mp3"]), "n_bytes": r.choice([0, 8000, 16000, 32000])}
        rows.append(e | {k: v for k, v in optional.items() if r.random() < 0.8})
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_servers_equal_plain_rules_in_batch_and_stream(spark, tmp_path, seed):
    rows = server_rows(seed)
    batches(tmp_path / "in", *[rows[a : a + 180] for a in range(0, len(rows), 180)])
    plain = {s: PlainServer(30.0, 1.0) for s in "AB"}
    want = sorted((e["server"], e["arrival"], *x) for e in rows for x in plain[e["server"]].event(e))
    view = lambda df: sorted((r.server, r.arrival, r.type, r.session_id, r.code if r.type == "error" else r.up_to if r.type in ("partial", "final_words") else None) for r in df.collect())
    batch = servers.served(spark.createDataFrame([json.dumps(r) for r in rows], "string").select(F.from_json("value", servers.SERVER_EVENT).alias("e")).select("e.*"), 30.0)
    stream = run(spark, tmp_path, servers.SERVER_EVENT, lambda e: servers.server_stream(e, 30.0))
    assert view(batch) == view(stream) == [tuple(x) for x in want]
    codes = {x[4] for x in want if x[2] == "error"}
    assert codes == {"protocol-error", "session-already-exists", "invalid-session-id", "decoder-error", "session-not-started", "session-not-found", "server-error", "invalid-sequence", "invalid-pts", "invalid-duration", "invalid-event-type"}


def test_left_out_fields_and_nulls_do_not_stop_a_session(spark):
    class Row:
        session_id, connection, sequence, pts, duration, sample_rate, channels, format, n_bytes, at = "s", None, None, None, None, None, None, None, 32000, None

    def row(**k):
        x = Row()
        x.__dict__.update(k)
        return x

    s, out = T.step(None, row(type="start"), 1.0)
    assert out[0][0] == "started" and s["frame"] == 32000
    assert T.step(None, row(type="start", sample_rate=float("nan"), channels=float("nan")), 1.0)[1][0][0] == "started"
    assert T.step(None, row(type="start", session_id=None), 1.0)[1][0][5] == "invalid-session-id"
    s, out = T.step(s, row(type="audio", sequence=float("nan")), 1.0)
    assert out[0][:4] == ("partial", 0, 0.0, 1.0)
    assert T.step(s, row(type=None), 1.0)[1][0][5] == "invalid-event-type"


def test_pairs_wait_or_not(spark, tmp_path):
    rows = [[("s", 0, "event", 100, 1.0), ("s", 1, "chunk", 0, 2.0), ("t", 0, "chunk", 7, 1.0)], [("s", 2, "chunk", 1, 3.0), ("s", 3, "event", 101, 9.0), ("t", 1, "chunk", 8, 2.0)], [("s", 4, "event", 102, 10.0), ("t", 2, "event", 200, 5.0), ("t", 3, "event", 201, 6.5), ("t", 4, "event", 202, 7.0)], [("s", 5, "end", None, None), ("t", 5, "end", None, None)]]
    named = [[dict(zip(("session_id", "arrival", "kind", "id", "at_ms"), r, strict=True)) for r in part] for part in rows]
    for wait, s in ((True, [(100, 0, -1.0), (101, 1, 6.0), (102, -1, None)]), (False, [(100, -1, None), (101, 0, 7.0), (102, 1, 7.0)])):
        at = tmp_path / str(wait)
        at.mkdir()
        batches(at / "in", *named)
        got = run(spark, at, pairing.PAIR_INPUT, lambda r, w=wait: pairing.paired_stream(r, w)).collect()
        assert sorted((r.event_id, r.sequence, r.latency_ms) for r in got if r.session_id == "s") == s
        assert sorted((r.event_id, r.sequence, r.latency_ms) for r in got if r.session_id == "t") == [(200, 7, 4.0), (201, 8, 4.5), (202, -1, None)]


def test_a_summary_behind_every_chunk_equals_the_batch_row(spark, tmp_path):
    r = random.Random(6)
    chunk = lambda s, k: {"session_id": s, "sequence": k, "start": 0.9 * k, "duration": 1.0, "processing_ms": r.randrange(50, 400), "emitted_ms": 1000.0 * k, "received_ms": 1000.0 * k + r.randrange(100, 900), "words": [{"word": r.choice("abc"), "start_time": 0.9 * k + 0.2 * j, "end_time": 0.9 * k + 0.2 * j + 0.15} for j in range(5)]}
    rows = [chunk(s, k) for k in range(12) for s in "xy"]
    late = chunk("x", 3) | {"sequence": 2}
    parts = [rows[a : a + 5] for a in range(0, len(rows), 5)]
    batches(tmp_path / "in", *parts, [late])
    seen, write = [], T.summary_overwrite(str(tmp_path / "files"))

    def each(batch, epoch):
        batch = batch.persist()
        seen.extend(batch.collect())
        write(live.latest(batch), epoch)
        batch.unpersist()

    run(spark, tmp_path, live.CHUNK, live.summary_stream, each)
    by = {(x.session_id, x.chunks): x for x in seen}
    assert len(seen) == len(by) == 24
    frame = spark.createDataFrame([(d["session_id"], d["sequence"], d["sequence"], "final_words", d["start"] + d["duration"], [tuple(w.values()) for w in d["words"]], d["start"], d["duration"], d["processing_ms"], d["emitted_ms"], d["received_ms"]) for d in rows], f"session_id string, arrival long, sequence long, type string, up_to double, words array<{T.WORD}>, start double, duration double, processing_ms long, emitted_ms double, received_ms double")
    committed = accumulate.accumulated(frame).where("word IS NOT NULL").groupBy("session_id", "sequence").count()
    for k in (1, 4, 12):
        some = frame.where(F.col("sequence") < k)
        n = committed.where(F.col("sequence") < k).groupBy("session_id").agg(F.sum("count").alias("committed"))
        c = some.join(n, "session_id").select("session_id", "sequence", "start", "duration", "committed", F.col("processing_ms").alias("server_ms"), (F.col("received_ms") - F.col("emitted_ms")).alias("end_to_end_ms"))
        elapsed = some.groupBy("session_id").agg(((F.max_by("received_ms", "sequence") - F.min("emitted_ms")) / 1000).alias("elapsed_seconds"))
        for m in analysis.session_metrics(c, elapsed).collect():
            s = by[m.session_id, k]
            assert (s.committed_words, s.audio_seconds, s.sum_server_ms, s.avg_server_ms, s.max_server_ms, s.avg_end_to_end_ms, s.max_end_to_end_ms, s.audio_per_wall_second) == (m.committed_words, m.audio_seconds, m.sum_server_ms, m.avg_server_ms, m.max_server_ms, m.avg_end_to_end_ms, m.max_end_to_end_ms, m.audio_per_wall_second)
    files = {x.session_id: x.chunks for x in spark.read.json(str(tmp_path / "files")).collect()}
    assert files == {"x": 12, "y": 12}


def words(session, first, n):
    return [(session, 0, 0, first + k, f"{session}{first + k}", 1.0 * k, k + 0.5, 0.0, None, None) for k in range(n)]


def test_rolling_reads_touched_buckets_only_and_can_run_again(spark, tmp_path):
    read, out = [], str(tmp_path / "out")
    roll = rolling.rolling_rewrite(out, lambda w: w.groupBy("session_id").agg(F.concat_ws(" ", F.transform(F.array_sort(F.collect_list(F.struct("position", "word"))), lambda x: x["word"])).alias("text")), buckets=16, read=read)
    frame = lambda rows: spark.createDataFrame(rows, T.OUT)
    text = lambda: {r.session_id: r.text for r in spark.read.parquet(f"{out}/artefacts").collect()}
    for epoch in range(24):
        roll(frame(words(f"s{epoch % 8}", 2 * (epoch // 8), 2)), epoch)
    want = {f"s{k}": " ".join(f"s{k}{j}" for j in range(6)) for k in range(8)}
    assert text() == want
    assert max(map(len, read)) == 1 and len(read) == 24  # one session a batch: one bucket's folder at most
    files = sum(len(f) for _, _, f in os.walk(f"{out}/words"))
    roll(frame(words("s7", 4, 2)), 23)  # the last batch again
    roll(frame([]), 24)
    assert text() == want and sum(len(f) for _, _, f in os.walk(f"{out}/words")) <= files
    for epoch in range(25, 31):
        roll(frame(words(f"new{epoch}", 0, 2)), epoch)
    assert max(map(len, read)) == 1 and text()["new30"] == "new300 new301" and len(read) == 31
    versions = [len([v for v in d if v.startswith("version=")]) for _, d, _ in os.walk(f"{out}/words")]
    assert max(versions) == 2
