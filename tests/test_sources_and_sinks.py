import json
import os

from pyspark.sql import functions as F

from cuelark.operators import accumulate, analysis, sessions
from cuelark.sources import feeds, sinks, tables
from cuelark.streaming import transcripts as T

WORDS = "recording_id string, i int, word string, start_time double, end_time double"


def test_chunk_results_become_events(spark, tmp_path):
    rows = [{"session_id": "s", "chunk_index": k, "chunk_start": 4.5 * k, "chunk_duration": 5.0, "words": [{"word": f"w{k}", "start": 4.5 * k + 1, "end": 4.5 * k + 1.5}], "partial": False, "processing_ms": 9} for k in range(3)]
    (tmp_path / "c.json").write_text("\n".join(map(json.dumps, rows)))
    chunks = feeds.chunk_results(spark, str(tmp_path))
    assert chunks.count() == 3 and chunks.schema["processing_ms"].dataType.simpleString() == "int"
    words = F.transform("words", lambda w: F.struct(w["word"].alias("word"), w["start"].alias("start_time"), w["end"].alias("end_time")))
    events = T.chunk_results_as_events(chunks.withColumn("words", words))
    assert [(r.type, r.sequence, r.up_to) for r in events.orderBy("sequence").collect()] == [("final_words", 0, 5.0), ("final_words", 1, 9.5), ("final_words", 2, 14.0)]
    assert [r.word for r in accumulate.accumulated(events).orderBy("position").collect()] == ["w0", "w1", "w2"]
    assert feeds.chunk_results(spark, str(tmp_path), stream=True).isStreaming


def test_store_tables(spark, tmp_path):
    said = [("a", "Hello"), ("a", "um,"), ("a", "world."), ("b", "Bye.")]
    w = spark.createDataFrame([(r, i if r == "a" else 0, x, 1.0 * i, i + 0.9) for i, (r, x) in enumerate(said)], WORDS)
    at = str(tmp_path / "db")
    sinks.write_store(w, at)
    sinks.write_store(w.where("recording_id = 'b'").withColumn("word", F.lit("Again.")), at)  # replaces b alone
    words = feeds.store_words(spark, at).collect()
    assert [(r.recording_id, r.word_id, r.word, r.is_filler, r.is_removed, r.confidence, r.chunk_id) for r in words] == [("a", 1, "Hello", False, False, None, 1), ("a", 2, "um,", True, False, None, 1), ("a", 3, "world.", False, False, None, 1), ("b", 1, "Again.", False, False, None, 1)]
    assert all(r.created_at is not None and abs(r.duration - 0.9) < 1e-9 for r in words)
    chunks = spark.read.parquet(f"{at}/chunks").orderBy("recording_id").collect()
    assert [(c.recording_id, c.chunk_id, c.text, c.word_count, c.source_type, c.metadata) for c in chunks] == [("a", 1, "Hello um, world.", 3, "auto", None), ("b", 1, "Again.", 1, "auto", None)]
    assert spark.read.parquet(f"{at}/chunk_words").count() == 4


def test_words_are_loaded_in_the_order_of_time(spark, tmp_path):
    w = spark.createDataFrame([("r", 0, "late", 5.0, 5.5), ("r", 1, "early", 1.0, 1.5), ("r", 2, "tie", 1.0, 1.2)], WORDS)
    sinks.write_store(w, str(tmp_path))
    assert [r.word for r in feeds.store_words(spark, str(tmp_path)).collect()] == ["early", "tie", "late"]


def test_reports_take_summaries(spark, tmp_path):
    os.mkdir(tmp_path / "runs")
    (tmp_path / "runs" / "live-summary.json").write_text(json.dumps({"session_id": "s", "chunks_processed": 4, "elapsed_seconds": 2.5}, indent=2))
    report = spark.createDataFrame([("s", 10), ("t", 20)], "session_id string, n_words int")
    got = {r.session_id: (r.n_words, r.chunks_processed, r.elapsed_seconds) for r in feeds.with_summaries(report, spark, str(tmp_path / "runs")).collect()}
    assert got == {"s": (10, 4, 2.5), "t": (20, None, None)}


def test_formats_are_written_from_one_table(spark, tmp_path):
    w = spark.createDataFrame([("r", 0, "Um,", 0.0, 0.4), ("r", 1, "yes.", 0.5, 1.2)], WORDS)
    tables.release(spark)
    assert sinks.write_all(w, str(tmp_path), ["srt", "txt", "vtt", "db", "mp4"], no_fillers=True) == ["srt", "txt", "vtt", "db"]
    assert len([f for f in tables.folders(spark, f"{tables.shared_folder(spark)}/work/*") if "segments-" in f]) == 1
    assert [r.value for r in spark.read.text(f"{tmp_path}/txt").collect()] == ["yes."] and spark.read.parquet(f"{tmp_path}/db/words").count() == 2


def test_unchecked_events_keep_their_own_deltas(spark):
    rows = [("s", 0, "final_words", -1, 1.0, [("a", 0.1, 0.5)]), ("s", 1, "final_words", -1, 2.0, [("b", 1.1, 1.5), ("c", 1.6, 1.9)]), ("s", 2, "final_words", -1, 3.0, [])]
    e = spark.createDataFrame(rows, T.EVENT)
    got = sessions.event_deltas(accumulate.accumulated(e), e).orderBy("arrival").collect()
    assert [(r.arrival, r.delta, r.committed) for r in got] == [(0, 1, 1), (1, 2, 3), (2, 0, 3)]


def test_payloads_left_out_and_broken(spark):
    e = spark.createDataFrame([(0, None), (1, "AAEC"), (2, "not base64!")], "arrival int, pcm16_base64 string")
    assert [r.n_bytes for r in feeds.decoded_payload(e).orderBy("arrival").collect()] == [0, 3, None]


def test_server_ms_are_summed(spark):
    c = spark.createDataFrame([("s", k, 1.0 * k, 1.0, k, 100 + k, 200) for k in range(4)], "session_id string, sequence int, start double, duration double, committed int, server_ms int, end_to_end_ms int")
    assert analysis.session_metrics(c).first().sum_server_ms == 406
