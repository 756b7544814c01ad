import json
import struct

from cuelark.operators import analysis, sessions, windows
from cuelark.sources import feeds
from cuelark.streaming import transcripts as T


def test_overlap_windows(spark):
    r = spark.createDataFrame([("a", 13, 4), ("b", 0, 4), ("c", 5, 4)], "recording_id string, n_frames long, rate int")
    got = windows.overlap_windows(r, 1.5, 0.5).orderBy("recording_id", "sequence").collect()
    assert [(x.recording_id, x.start, x.duration) for x in got] == [("a", 0.0, 1.5), ("a", 1.0, 1.5), ("a", 2.0, 1.25), ("c", 0.0, 1.25)]


def test_batch_windows_and_inventory(spark):
    r = spark.createDataFrame([("a", 44 + 32000 * 130), ("b", 44 + 16000), ("c", 10)], "recording_id string, size long")
    i = windows.inventory(r)
    assert {x.recording_id: (x.duration, x.n_chunks) for x in i.collect()} == {"a": (130.0, 3), "b": (0.5, 1), "c": (0.0, 0)}
    assert [(x.start, x.end) for x in windows.batch_windows(i).orderBy("start").collect()] == [(0, 62.0), (60, 122.0), (120, 130.0)]


def test_char_stamps(spark):
    rows = [("r", 0, 1.0, k, c, k, k + 1) for k, c in enumerate(" hi you ")]
    c = spark.createDataFrame(rows, "recording_id string, chunk_index int, chunk_start double, position int, char string, start_offset int, end_offset int")
    got = windows.words_from_char_stamps(c, 0.5).orderBy("start_time").collect()
    assert [(x.word, x.start_time, x.end_time) for x in got] == [("hi", 1.5, 2.5), ("you", 3.0, 4.5)]


def test_word_stamps(spark):
    s = spark.createDataFrame([("r", 0, 2.0, [("a", None, 0, 1), ("", "b", 2, 3), (" ", None, 4, 5)])], "recording_id string, chunk_index int, chunk_start double, stamps array<struct<word:string,char:string,start_offset:int,end_offset:int>>")
    assert [(x.word, x.start_time) for x in windows.words_from_word_stamps(s, 0.5).orderBy("position").collect()] == [("a", 2.0), ("b", 3.0)]


def test_downmix_truncates_and_clamps(spark):
    s = spark.createDataFrame([("r", 0, 0, 3), ("r", 0, 1, 4), ("r", 1, 0, 70000), ("r", 1, 1, 70000), ("r", 2, 0, -3), ("r", 2, 1, -4)], "recording_id string, frame long, channel int, value long")
    assert [x.value for x in windows.downmixed(s).orderBy("frame").collect()] == [3, 32767, -3]


def wav(rate, channels, n):
    data = bytes(range(256)) * (n // 256 + 1)
    return b"RIFF" + struct.pack("<I", 36 + n) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, channels, rate, rate * channels * 2, channels * 2, 16) + b"data" + struct.pack("<I", n) + data[:n]


def test_recordings_slices_and_facts(spark, tmp_path):
    (tmp_path / "a.wav").write_bytes(wav(16000, 1, 3200))
    (tmp_path / "b.wav").write_bytes(wav(48000, 2, 400))
    (tmp_path / "c.wav").write_text("no audio")
    d = wav(8000, 1, 100)
    (tmp_path / "d.wav").write_bytes(d[:12] + b"LIST" + struct.pack("<I", 5) + b"fmt x\0" + d[12:])  # another chunk, padded, before the facts
    (tmp_path / "e.wav").write_bytes(d[:20])
    facts = {x.recording_id[-5]: (x.sample_rate, x.channels, x.bits, x.ok) for x in feeds.format_facts(feeds.payloads(spark, str(tmp_path))).collect()}
    assert facts["a"] == (16000, 1, 16, True) and facts["b"] == (48000, 2, 16, True) and not facts["c"][3]
    assert facts["d"] == (8000, 1, 16, True) and not facts["e"][3]
    good, bad = feeds.accepted_files(feeds.format_facts(feeds.payloads(spark, str(tmp_path))))
    assert (good.count(), bad.count()) == (3, 2)
    r = feeds.recordings(spark, f"{tmp_path}/a.wav")
    assert r.first().size == 3244
    w = windows.overlap_windows(r.selectExpr("recording_id", "1600L AS n_frames", "16000 AS rate"), 0.06, 0.01)
    got = windows.sliced(w, feeds.payloads(spark, f"{tmp_path}/a.wav")).orderBy("sequence").collect()
    raw = wav(16000, 1, 3200)[44:]
    assert [bytes(x.pcm16) for x in got] == [raw[:1920], raw[1600:3200]]
    q = r.selectExpr("recording_id", "0.01D AS start", "0.02D AS duration", "16000 AS rate", "1 AS channels")
    assert bytes(windows.extracted(q, feeds.payloads(spark, f"{tmp_path}/a.wav")).first().pcm16) == raw[320:960]
    text = feeds.recognised(w, lambda b: b[["sequence"]].assign(word="w"), "sequence long, word string")
    assert text.count() == 2


def test_feeds(spark, tmp_path):
    (tmp_path / "e.json").write_text("\n".join(json.dumps(x) for x in [{"type": "audio", "session_id": "s", "sequence": 0, "pcm16_base64": "AAEC"}, {"type": "nope"}, {"session_id": "x"}]))
    known, other = feeds.routed(feeds.session_events(spark, f"{tmp_path}/e.json"))
    assert known.count() == 1 and other.count() == 2 and feeds.decoded_payload(known).first().n_bytes == 3
    (tmp_path / "f.json").write_text(json.dumps({"recording_id": "r", "words": [{"word": "a", "start": 0.0, "end": 0.5}, {"word": "b", "start": 1.0, "end": 1.5}]}))
    assert [x.word for x in feeds.full_results(spark, f"{tmp_path}/f.json").orderBy("i").collect()] == ["a", "b"]


def test_metrics(spark):
    c = spark.createDataFrame([("s", 0, 0.0, 5.0, 10, 1200, 1500), ("s", 1, 4.5, 5.0, 20, 1800, 2500)], "session_id string, sequence int, start double, duration double, committed int, server_ms int, end_to_end_ms int")
    e = spark.createDataFrame([("s", 4.75)], "session_id string, elapsed_seconds double")
    m = analysis.session_metrics(c, e).first()
    assert (m.chunks, m.committed_words, m.audio_seconds, m.max_server_ms, m.max_end_to_end_ms, m.avg_server_ms, m.audio_per_wall_second) == (2, 20, 9.5, 1800, 2500, 1500.0, 2.0)


SESSION = "session_id string, arrival int, type string, sequence long, pts double, duration double, n_bytes long"


def test_spans_and_triggers(spark):
    rows = [("s", 0, "audio", 0, 0.0, 1.0, 32000), ("s", 1, "flush", None, None, None, 0), ("s", 2, "audio", 1, 0.5, 1.0, 16000), ("s", 3, "audio", 2, 1.0, 1.0, 16000), ("s", 4, "flush", None, None, None, 0), ("s", 5, "stop", None, None, None, 0)]
    e = spark.createDataFrame(rows, SESSION)
    assert [(x.start, x.up_to) for x in sessions.flush_spans(e).orderBy("span").collect()] == [(0.0, 1.0), (0.5, 1.5), (1.5, 1.5)]
    assert [(x.sequence, x.buffered) for x in sessions.partial_triggers(e).orderBy("sequence").collect()] == [(0, 1.0), (2, 1.0)]


class Row:
    def __init__(self, **k):
        self.__dict__.update({"session_id": "s", "connection": None, "sequence": 0, "pts": 0.0, "duration": 0.0, "sample_rate": 16000, "channels": 1, "format": "pcm_s16le", "n_bytes": 0} | k)


def test_session_steps():
    s, out = T.step(None, Row(type="audio"), 1.0)
    assert out[0][5] == "session-not-started"
    s, out = T.step(s, Row(type="start"), 1.0)
    assert out[0][0] == "started" and T.step(s, Row(type="start"), 1.0)[1][0][5] == "session-already-exists"
    assert T.step(s, Row(type="audio", sequence=2), 1.0)[1][0][5] == "invalid-sequence"
    s, out = T.step(s, Row(type="audio", sequence=0, pts=0.0, n_bytes=32000), 1.0)
    assert out[0][:4] == ("partial", 0, 0.0, 1.0)
    s, out = T.step(s, Row(type="flush"), 1.0)
    assert out[0][2:5] == (0.0, 1.0, 1.0) and s["expected"] == 1
    s, out = T.step(s, Row(type="audio", sequence=1, pts=0.5, n_bytes=32000), 1.0)
    s, out = T.step(s, Row(type="stop"), 1.0)
    assert s is None and [x[0] for x in out] == ["final_words", "stopped"] and out[1][4] == 1.5


def test_rejected_audio_does_not_advance_the_sequence(spark):
    rows = [("s", i, "audio", q, p, d, 1, 1, "pcm_s16le") for i, (q, p, d) in enumerate([(0, 0.0, 1.0), (2, 0.0, 1.0), (1, -1.0, 1.0), (1, 0.0, -1.0), (1, 0.0, 1.0), (2, 0.0, 1.0)])]
    e = spark.createDataFrame(rows, "session_id string, arrival int, type string, sequence long, pts double, duration double, sample_rate int, channels int, format string")
    got = [r.code for r in sessions.validated(e).orderBy("arrival").collect()]
    assert got == [None, "invalid-sequence", "invalid-pts", "invalid-duration", None, None]


def test_idle_gap_is_strict(spark):
    e = spark.sql("SELECT * FROM VALUES ('s', 0, timestamp'2024-01-01 00:00:00'), ('s', 1, timestamp'2024-01-01 00:05:00'), ('s', 2, timestamp'2024-01-01 00:10:00.000001') t(session_id, arrival, ts)")
    assert [x.n_events for x in sessions.idle_sessions(e).orderBy("stretch").collect()] == [2, 1]


def test_payloads_come_back(spark):
    e = spark.createDataFrame([("s", bytearray(b"abc"))], "session_id string, pcm16 binary").selectExpr("*", "octet_length(pcm16) AS n_bytes")
    back = feeds.decoded_payload(feeds.encoded_payload(e)).first()
    assert bytes(back.pcm16) == b"abc" and back.n_bytes == 3


def test_alignment(spark):
    w = lambda words: spark.createDataFrame([("r", i, x, i * 1.0, i + 0.5) for i, x in enumerate(words.split())], "recording_id string, i int, word string, start_time double, end_time double")
    a = analysis.aligned(w("one two three four"), w("One two, 3 four five"))
    assert [(x.tag, x.i1, x.i2, x.j1, x.j2) for x in a.orderBy("i1", "j1").collect()] == [("equal", 0, 2, 0, 2), ("replace", 2, 3, 2, 3), ("equal", 3, 4, 3, 4), ("insert", 4, 4, 4, 5)]
    assert {x.tag: (x.regions, x.base_words, x.run_words) for x in analysis.alignment_summary(a).collect()} == {"replace": (1, 1, 1), "insert": (1, 0, 1)}
