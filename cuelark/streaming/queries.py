"""Streaming runs over events that Spark derives from the given tables; each runs until its input is used up."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans import fixtures as X
from ..sources import replay
from ..sources.tables import delete, kept, scratch
from . import live, pairing, servers
from . import transcripts as T

STORE, ROCKS = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def _state_store(spark: SparkSession) -> Iterator[None]:
    """The state store that the processors need; the session's own setting comes back."""
    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(STORE) if before is None else spark.conf.set(STORE, before)


def _run(spark: SparkSession, rows: DataFrame, schema: str, made: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What a stream makes of rows. Its input and state are deleted when it has ended; its output is an intermediate table."""
    at, out = scratch(spark, "stream"), scratch(spark, "streamed")
    try:
        rows.write.parquet(f"{at}/in")
        with _state_store(spark):
            stream = made(spark.readStream.schema(schema).parquet(f"{at}/in"))
            stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{at}/state").outputMode("append").trigger(availableNow=True).start().awaitTermination()
        return spark.read.schema(stream.schema).parquet(out)
    finally:
        delete(spark, at)


def stream_accumulated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streaming accumulator over the same events as accumulated_final; it commits the same words."""
    words = F.expr("transform(words, w -> named_struct('word', w.word, 'start_time', w.start_time, 'end_time', w.end_time))")
    e = X.final_events(X.words(spark, sf_dir)).select(F.col("session_id").cast("string").alias("session_id"), F.col("arrival").cast("long").alias("arrival"), "type", F.col("sequence").cast("long").alias("sequence"), "up_to", words.alias("words"))
    out = _run(spark, e, T.EVENT, T.accumulated_stream)
    return out.where("word IS NOT NULL").select(F.col("session_id").cast("long").alias("session_id"), "sequence", "word", "start_time", "end_time")


def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The session processor over the click events. No timers: they would keep a run that ends with its input going."""
    e = X.session_events(spark, sf_dir).withColumn("connection", F.lit(None).cast("string")).select(*[c.split()[0] for c in T.SESSION_EVENT.split(", ")])
    return _run(spark, e.withColumn("arrival", F.col("arrival").cast("long")), T.SESSION_EVENT, lambda events: T.session_stream(events, 0))


def stream_servers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The server processor over server_sessions' events; it answers the same."""
    return _run(spark, X.server_events(spark, sf_dir), servers.SERVER_EVENT, servers.server_stream)


def stream_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """chunk_event_pairs in a stream: audio events are chunks, flushes and stops the final events, and each session ends."""
    e = X.session_events(spark, sf_dir)
    kind = F.when(F.col("type") == "audio", pairing.CHUNK).when(F.col("type").isin("flush", "stop"), pairing.EVENT)
    ms = F.unix_micros(F.col("ts").cast("timestamp")) / 1000.0
    rows = e.select("session_id", F.col("arrival").cast("long").alias("arrival"), kind.alias("kind"), F.when(kind == pairing.CHUNK, F.col("sequence")).otherwise(F.col("event_id")).cast("long").alias("id"), ms.alias("at_ms")).where("kind IS NOT NULL")
    end = e.groupBy("session_id").agg((F.max("arrival") + 1).cast("long").alias("arrival")).select("session_id", "arrival", F.lit(pairing.END).alias("kind"), F.lit(None).cast("long").alias("id"), F.lit(None).cast("double").alias("at_ms"))
    return _run(spark, rows.unionByName(end), pairing.PAIR_INPUT, lambda r: pairing.paired_stream(r, wait=True))


def _chunk_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("sequence")
    words = F.expr("transform(words, w -> named_struct('word', w.word, 'start_time', w.start_time, 'end_time', w.end_time))")
    return X.final_events(X.words(spark, sf_dir)).select(
        F.col("session_id").cast("string").alias("session_id"), s.cast("long").alias("sequence"), (s * 4.5).cast("double").alias("start"), F.lit(5.0).alias("duration"), words.alias("words"),
        (100 + s % 7 * 10).cast("long").alias("processing_ms"), (s * 1000.0).cast("double").alias("emitted_ms"), (s * 1000.0 + 200 + s % 5 * 100).cast("double").alias("received_ms"),
    )


def stream_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A live run over all sessions: a summary behind each chunk."""
    out = _run(spark, _chunk_results(spark, sf_dir), live.CHUNK, live.summary_stream)
    return out.withColumn("session_id", F.col("session_id").cast("long"))


def stream_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chunks of all sessions, replayed without pauses."""
    chunks = kept(_chunk_results(spark, sf_dir).select(F.col("session_id").cast("long").alias("session_id"), "sequence", F.size("words").alias("n_words")), "replayed")
    end = (chunks.agg(F.max("sequence")).first()[0] or 0) + 1
    at, out = scratch(spark, "stream"), scratch(spark, "streamed")
    try:
        stream = replay.replayed(spark, chunks, 4.5, end, speed=0).drop("emitted_at")
        q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{at}/state").start()
        if not replay.stop_at_end(q, end):
            raise RuntimeError(f"the replay did not end: {q.exception()}")
        return spark.read.schema(stream.schema).parquet(out)
    finally:
        delete(spark, at)


def queries() -> dict:
    return {q.__name__: q for q in (stream_accumulated, stream_sessions, stream_servers, stream_pairs, stream_summaries, stream_replay)}
