"""Timed words, events, recordings and samples derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One word every 400 ms; fillers at fixed places."""
    t = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.posexplode(F.split("text", r"\s+")).alias("pos", "w")).where("w <> ''")
    i = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "pos")) - 1
    t = t.select(F.col("conv_id").alias("recording_id"), "w", i.alias("i"))
    word = F.when(F.col("i") % 17 == 5, "um,").when(F.col("i") % 29 == 7, "Like").otherwise(F.col("w"))
    start = (400 * F.col("i")) / F.lit(1000.0)
    end = (400 * F.col("i") + F.least(F.lit(380), 80 + 20 * F.length("w"))) / F.lit(1000.0)
    return t.select("recording_id", "i", word.alias("word"), start.alias("start_time"), end.alias("end_time"))


def baseline(words: DataFrame) -> DataFrame:
    """A second run: every 23rd word missing, every 31st doubled."""
    twice = F.when(F.col("i") % 31 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    w = words.where("i % 23 <> 0").withColumn("copy", F.explode(twice))
    order = Window.partitionBy("recording_id").orderBy("i", "copy")
    return w.withColumn("n", F.row_number().over(order) - 1).drop("i", "copy").withColumnRenamed("n", "i").select(*words.columns)


def event_words(words: DataFrame) -> DataFrame:
    """Windows of 5 s every 4.5 s; odd ones read their words 0.08 s late. Word k of the first pass lies in window
    floor(start / 4.5) or the one before."""
    last = words.groupBy("recording_id").agg(F.max("end_time").alias("mx"))
    k = last.select("recording_id", F.ceil(F.greatest(F.col("mx") - 5, F.lit(0.0)) / 4.5).alias("n"))
    at = F.floor(F.col("start_time") / 4.5)
    w = words.join(k, "recording_id").withColumn("sequence", F.explode(F.array(at - 1, at))).where("sequence >= 0 AND sequence <= n")
    low = 4.5 * F.col("sequence")
    late = F.when(F.col("sequence") % 2 == 1, 0.08).otherwise(0.0)
    w = w.where((F.col("start_time") >= low) & (F.col("end_time") <= low + 5.0))
    return w.select(
        F.col("recording_id").alias("session_id"), "sequence", (low + 5.0).alias("up_to"), "i", "word", (F.col("start_time") + late).alias("start_time"), (F.col("end_time") + late).alias("end_time")
    )


def final_events(words: DataFrame) -> DataFrame:
    e = event_words(words).groupBy("session_id", "sequence", "up_to").agg(F.array_sort(F.collect_list(F.struct("i", "word", "start_time", "end_time"))).alias("words"))
    return e.select("session_id", F.col("sequence").alias("arrival"), F.lit("final_words").alias("type"), "sequence", "up_to", "words")


def revised_events(words: DataFrame) -> DataFrame:
    """Each final event with a partial one of its first two words before it."""
    f = final_events(words)
    p = f.withColumn("type", F.lit("partial")).withColumn("words", F.slice("words", 1, 2)).withColumn("up_to", F.lit(0.0)).withColumn("arrival", 2 * F.col("arrival"))
    return p.unionByName(f.withColumn("arrival", 2 * F.col("arrival") + 1))


def disordered_events(words: DataFrame) -> DataFrame:
    """Final events, of which every third comes behind its successor and every fifth comes twice; every fourth is preceded by
    a partial one and every seventh followed by one."""
    s = F.col("sequence")
    at = 10 * s + F.when(s % 3 == 1, 12).otherwise(0)
    f = final_events(words).withColumn("arrival", at)
    more = [f.where(s % 5 == 0).withColumn("arrival", at + 3)]
    more += [f.where(x).withColumn("arrival", at + k).withColumn("type", F.lit("partial")) for x, k in ((s % 4 == 0, -1), (s % 7 == 0, 4))]
    return f.unionByName(more[0]).unionByName(more[1]).unionByName(more[2])


def server_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click events as those of 64 servers. A user is a session that two connections contend for; some starts name another
    session, and fields are left out or wrong now and then."""
    e = session_events(spark, sf_dir)
    n, user = F.col("event_id"), F.col("session_id").cast("long")
    server = (user % 64).cast("string")
    order = Window.partitionBy("server").orderBy("ts", "event_id")
    e = e.withColumn("server", server).withColumn("arrival", (F.row_number().over(order) - 1).cast("long"))
    null = F.lit(None)
    return e.select(
        "server", F.concat("session_id", F.lit("-"), (n % 2).cast("string")).alias("connection"), F.when(n % 9 == 0, (user + 64).cast("string")).when(n % 31 == 0, " ").otherwise(F.col("session_id")).alias("session_id"),
        "arrival", (F.unix_micros(F.col("ts").cast("timestamp")) / 4e9).alias("at"), F.when(n % 37 == 0, "disconnect").otherwise(F.col("type")).alias("type"),
        F.when(n % 3 == 0, null).otherwise(F.col("sequence") % 2).cast("long").alias("sequence"), F.when(n % 5 == 0, null).when(n % 7 == 0, -1.0).otherwise(F.col("pts")).alias("pts"),
        F.when(n % 11 == 0, null).otherwise(0.5).alias("duration"), F.when(n % 13 == 0, null).otherwise(16000).cast("int").alias("sample_rate"), F.when(n % 17 == 0, 0).otherwise(1).cast("int").alias("channels"),
        F.when(n % 19 == 0, null).when(n % 23 == 0, "mp3").otherwise("pcm_s16le").alias("format"), F.when(n % 29 == 0, null).otherwise(F.col("n_bytes")).cast("long").alias("n_bytes"),
    )


def recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of files of a tenth of a second per character."""
    n = F.coalesce(F.col("n_chars"), F.lit(0))
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("recording_id"), (44 + n * 3200).alias("size"), (n * 1600).alias("n_frames"), F.lit(16000).alias("rate")
    )


def session_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click events as session events: users are sessions, in the order of time."""
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, sf_dir, "events").withColumn("arrival", F.row_number().over(order) - 1)
    kind = F.when(F.col("event_type") == "signup", "start").when(F.col("event_type").isin("view", "click"), "audio").when(F.col("event_type") == "error", "flush").when(F.col("event_type") == "purchase", "stop").otherwise(F.col("event_type"))
    return e.select(
        F.col("user_id").cast("string").alias("session_id"), "event_id", "ts", "arrival", kind.alias("type"), F.col("arrival").cast("long").alias("sequence"),
        (F.col("arrival") * 0.5).alias("pts"), F.col("value").alias("duration"), F.lit(16000).alias("sample_rate"), F.lit(1).alias("channels"), F.lit("pcm_s16le").alias("format"),
        (F.col("arrival") % 3 * 16000).cast("long").alias("n_bytes"), "value",
    )
