from pyspark.sql import functions as F

from cuelark.functions import words as W
from cuelark.operators import segments as S
from cuelark.operators import store
from cuelark.sources import sinks

WORDS = "recording_id string, i int, word string, start_time double, end_time double"


def frame(spark, *rows, recording="r"):
    return spark.createDataFrame([(recording, i, *r) for i, r in enumerate(rows)], WORDS)


def test_fillers(spark):
    rows = [("um", True), ("Um", True), ("um.", True), ("UH?", True), ("like", True), ("'er,'", True), ("hello", False), ("world", False)]
    got = spark.createDataFrame(rows, "word string, want boolean").withColumn("got", W.is_filler(F.col("word"))).collect()
    assert all(r.want == r.got for r in got)


def test_forms(spark):
    row = spark.sql("SELECT ' \"Été!\" ' AS w").select(W.same_word_form(F.col("w")), W.diff_form(F.col("w"))).first()
    assert row[1] == "été"
    assert spark.sql("SELECT '\"Hi!\"' AS w").select(W.same_word_form(F.col("w"))).first()[0] == "hi"


def test_clock_truncates(spark):
    got = spark.createDataFrame([(2.3,), (3661.5,), (0.0,)], "s double").select(W.clock(F.col("s"))).collect()
    assert [r[0] for r in got] == ["00:00:02,299", "01:01:01,500", "00:00:00,000"]


def test_rounding_goes_away_from_zero(spark):
    assert spark.sql("SELECT 0.0625D AS x").select(W.rounded(F.col("x"))).first()[0] == 0.063


def test_segments_and_open_tail(spark):
    w = frame(spark, ("Hello", 0.0, 0.5), ("world.", 0.5, 1.0), ("This", 1.5, 2.0), ("is", 2.0, 2.5), ("a", 2.5, 2.7), ("test.", 2.7, 3.2), ("and", 3.3, 3.5))
    got = [tuple(r)[1:5] for r in S.build_segments(w).orderBy("segment").collect()]
    assert got == [(1, 0.0, 1.0, "Hello world."), (2, 1.5, 3.2, "This is a test."), (3, 3.3, 0.0, "and")]
    assert S.build_segments(w, close_tail=True).where("segment = 3").first().end_time == 3.5


def test_segments_split_behind_the_word_that_overflows(spark):
    w = frame(spark, *[("é" * 20, k * 1.0, k + 0.9) for k in range(8)])  # 40 bytes and a space each
    assert [r.n_words for r in S.build_segments(w).orderBy("segment").collect()] == [3, 3, 2]


def test_cues(spark):
    s = spark.createDataFrame([("r", 1, 0.0, 1.5, "Hello world."), ("r", 2, 2.0, 3.5, "This is a test.")], "recording_id string, segment int, start_time double, end_time double, text string")
    assert S.srt_cues(s).orderBy("segment").first().cue == "1\n00:00:00,000 --> 00:00:01,500\nHello world.\n"
    assert S.vtt_cues(s).orderBy("segment").first().cue == "00:00:00.000 --> 00:00:01.500\nHello world.\n"


def test_store(spark):
    w = frame(spark, ("Hello", 0.0, 0.5), ("um", 0.5, 1.0), ("world", 1.0, 1.5), ("test.", 1.5, 2.0))
    words, chunks = store.words_table(w), store.chunks_table(w)
    links = store.chunk_words(words, chunks)
    assert words.count() == 4 and words.where("is_filler").count() == 1 and chunks.count() == 1
    assert [r.position for r in links.orderBy("word_id").collect()] == [0, 1, 2, 3]
    assert store.backfilled(words, links).where("chunk_id = 1").count() == 4
    assert store.chunks_table(w, compat=True).first().word_count == 0 and chunks.first().word_count == 4


def test_empty_words(spark):
    w = spark.createDataFrame([], WORDS)
    assert S.build_segments(w).count() == 0 and store.chunk_words(store.words_table(w), store.chunks_table(w)).count() == 0


def test_written_formats(spark, tmp_path):
    w = frame(spark, ("Hello", 0.0, 0.5), ("um", 0.5, 1.0), ("world.", 1.0, 1.5))
    assert sinks.write_all(w, str(tmp_path), ["srt", "vtt", "txt", "db", "doc"], no_fillers=True) == ["srt", "vtt", "txt", "db"]
    text = lambda f: next((tmp_path / f / "recording_id=r").glob("*.txt")).read_text()
    assert text("srt") == "1\n00:00:00,000 --> 00:00:01,500\nHello world.\n\n"
    assert text("vtt").startswith("WEBVTT\n\n00:00:00.000 --> 00:00:01.500\n") and text("txt") == "Hello world.\n"
    assert spark.read.parquet(f"{tmp_path}/db/words").count() == 3
    try:
        sinks.write_all(w, str(tmp_path), ["doc"], strict=True)
    except ValueError as e:
        assert "doc" in str(e)
    else:
        raise AssertionError
