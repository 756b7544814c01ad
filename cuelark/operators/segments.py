"""Subtitle segments and cues from words.

Words are rows (recording_id, i, word, start_time, end_time), i being the place in the recording, from 0. A segment takes
words until one ends a sentence and the segment has lasted over 0.5 s, or it has lasted over `max_seconds`, or its
text has over `max_bytes` bytes; the word that does so is its last. The words behind the last split form an open
segment, whose end is 0, or the end of its last word with close_tail. A null word counts as an empty one.

Recordings of up to FOLD_WORDS words are folds in the JVM. Longer ones are cut into blocks of words. A segment has at most
`reach` words, so a block can only begin in the middle of one at its first `reach` places; for each of these the block tells where its
chain of segments leaves it and how many segments it passed: a table of jumps. Jumps of neighbouring blocks compose, and a
scan over the blocks finds each one's true entry, so that no task ever holds more than a block.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

from ..functions.words import clock
from ..sources.tables import kept
from .scan import exclusive
from .sorted_runs import in_order, starts, whole_keys

SEGMENTS = "array<struct<start_time:double,end_time:double,text:string,n_words:int>>"
SEGMENT = "segment int, start_time double, end_time double, text string, n_words int"
FOLD_WORDS, BLOCK_WORDS = 4096, 8192
WORDS_AT_ONCE = 65536  # words of blocks, of whichever recordings, that are made into segments together
SHORTEST = 0.5  # seconds a segment must have lasted for a sentence to end it


def build_segments(words: DataFrame, max_seconds: float = 15.0, max_bytes: int = 120, close_tail: bool = False) -> DataFrame:
    """(recording_id, segment, start_time, end_time, text, n_words), segments counted from 1. Which recordings are long is asked
    of Spark first, by their words' places alone."""
    long = words.where(F.col("i") == FOLD_WORDS).select("recording_id").distinct()
    if long.isEmpty():
        return folded_segments(words, max_seconds, max_bytes, close_tail)
    short = folded_segments(words.join(long, "recording_id", "left_anti"), max_seconds, max_bytes, close_tail)
    return short.unionByName(block_segments(words.join(long, "recording_id", "left_semi"), max_seconds, max_bytes, close_tail))


def folded_segments(words: DataFrame, max_seconds: float = 15.0, max_bytes: int = 120, close_tail: bool = False) -> DataFrame:
    """build_segments as one fold over each recording."""
    word = F.coalesce("word", F.lit("")).alias("word")
    rows = words.groupBy("recording_id").agg(F.array_sort(F.collect_list(F.struct("i", word, "start_time", "end_time"))).alias("words"))
    start = "coalesce(s.start, w.start_time)"
    text = "if(s.text is null, w.word, concat(s.text, ' ', w.word))"
    split = f"(substring(w.word, -1, 1) in ('.', '?', '!') and w.end_time - {start} > {SHORTEST}D) or w.end_time - {start} > {max_seconds}D or octet_length({text}) > {max_bytes}"
    step = (
        f"if({split}, named_struct('done', concat(s.done, array(named_struct('start_time', {start}, 'end_time', w.end_time, 'text', {text}, 'n_words', s.n + 1))), "
        "'start', cast(null as double), 'text', cast(null as string), 'n', 0, 'last', w.end_time), "
        f"named_struct('done', s.done, 'start', {start}, 'text', {text}, 'n', s.n + 1, 'last', w.end_time))"
    )
    zero = f"named_struct('done', cast(array() as {SEGMENTS}), 'start', cast(null as double), 'text', cast(null as string), 'n', 0, 'last', cast(null as double))"
    tail = "s.last" if close_tail else "0.0D"
    end = f"if(s.text is null, s.done, concat(s.done, array(named_struct('start_time', s.start, 'end_time', {tail}, 'text', s.text, 'n_words', s.n))))"
    out = rows.select("recording_id", F.posexplode(F.expr(f"aggregate(words, {zero}, (s, w) -> {step}, s -> {end})")).alias("segment", "c"))
    return out.select("recording_id", (F.col("segment") + 1).alias("segment"), "c.*")


def _next_splits(start: np.ndarray, end: np.ndarray, stops: np.ndarray, size: np.ndarray, until: np.ndarray, max_seconds: float, max_bytes: int) -> np.ndarray:
    """For a segment that begins at each word the place of its last word, -1 where the words end before; they end at `until`."""
    n, total = len(start), np.concatenate([[0], np.cumsum(size)])
    out, open_ = np.full(n, -1, np.int64), np.arange(n)
    for ahead in range(n):
        open_ = open_[open_ + ahead < until[open_]]
        if not len(open_):
            break
        j = open_ + ahead
        lasted = end[j] - start[open_]
        split = (stops[j] & (lasted > SHORTEST)) | (lasted > max_seconds) | (total[j + 1] - total[open_] + ahead > max_bytes)
        out[open_[split]] = j[split]
        open_ = open_[~split]
    return out


BLOCK = ["recording_id", "block"]


class _Block:
    """The words of a block and the `reach` words behind it, in order."""

    def __init__(self, recording_id, block: int, own: int, entry: tuple, words: list[str], start: np.ndarray, end: np.ndarray, next_: np.ndarray):
        self.recording_id, self.block, self.own, self.entry = recording_id, block, own, entry
        self.words, self.start, self.end, self.next = words, start, end, next_

    @staticmethod
    def read(batches: Iterable[pa.RecordBatch], block_words: int, max_seconds: float, max_bytes: int) -> Iterator[list[_Block]]:
        """Blocks of sorted words, as many together as a batch holds. Rows with an entry are led by those, as word -1."""
        for t in whole_keys(batches, BLOCK):
            i = t.column("i").to_numpy()
            first = starts(t, BLOCK)
            last = np.append(first[1:], len(t))
            word = pc.fill_null(t.column("word"), "").combine_chunks()
            stops = np.logical_or.reduce([pc.ends_with(word, x).to_numpy(zero_copy_only=False) for x in ".?!"])
            start, end = t.column("start_time").to_numpy(), t.column("end_time").to_numpy()
            next_ = _next_splits(start, end, stops, pc.binary_length(word).to_numpy(), np.repeat(last, last - first), max_seconds, max_bytes)
            words, at = word.to_pylist(), pa.array(first)
            entered = [t.column(c).take(at).to_pylist() for c in ("recording_id", "block", "entry", "begun")]
            out = []
            for lo, hi, (rec, block, entry, begun) in zip(first.tolist(), last.tolist(), zip(*entered, strict=True), strict=True):
                lo += int(i[lo] < 0)
                own = min(int((i[lo:hi] < (block + 1) * block_words).sum()), block_words)
                out.append(_Block(rec, block, own, (entry, begun), words[lo:hi], start[lo:hi], end[lo:hi], np.maximum(next_[lo:hi] - lo, -1)))
            yield out

    def jumps(self, reach: int) -> tuple[list[int], list[int]]:
        """For each entry the entry into the next block (-1: the recording has ended) and the segments begun on the way."""
        to, n, after = [0] * self.own, [0] * self.own, self.next.tolist()
        for i in range(self.own - 1, -1, -1):
            j = after[i] + 1
            to[i], n[i] = (-1, 1) if j == 0 or j == len(after) else (j - self.own, 1) if j >= self.own else (to[j], n[j] + 1)
        return (to[:reach] + [-1] * reach)[:reach], (n[:reach] + [0] * reach)[:reach]

    def segments(self, close_tail: bool) -> list[tuple]:
        out, (i, begun) = [], self.entry
        while 0 <= i < self.own:
            j = int(self.next[i])
            last = len(self.words) - 1 if j < 0 else j
            begun += 1
            out.append((self.recording_id, begun, self.start[i], self.end[j] if j >= 0 else self.end[last] if close_tail else 0.0, " ".join(self.words[i : last + 1]), last + 1 - i))
            i = last + 1 if j >= 0 else self.own
        return out


def block_segments(words: DataFrame, max_seconds: float = 15.0, max_bytes: int = 120, close_tail: bool = False, block_words: int = BLOCK_WORDS) -> DataFrame:
    """build_segments by blocks of words, for recordings of any length."""
    reach = max_bytes + 2  # so many words have over max_bytes bytes, as each but the first has a space before it
    if block_words <= reach:
        raise ValueError("a block must be longer than a segment can be")
    kind, id_type = words.schema["recording_id"].dataType.simpleString(), to_arrow_type(words.schema["recording_id"].dataType)
    block = F.floor(F.col("i") / block_words)
    w = words.select("recording_id", F.col("i").cast("long").alias("i"), "word", F.col("start_time").cast("double").alias("start_time"), F.col("end_time").cast("double").alias("end_time"))
    w = w.withColumn("block", F.explode(F.when((F.col("i") % block_words < reach) & (block > 0), F.array(block - 1, block)).otherwise(F.array(block))))
    w = w.withColumns({"entry": F.lit(None).cast("int"), "begun": F.lit(None).cast("long")})

    def jumps(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in _Block.read(batches, block_words, max_seconds, max_bytes):
            to, n = zip(*[b.jumps(reach) for b in found], strict=True)
            columns = ([b.recording_id for b in found], id_type), ([b.block for b in found], pa.int64()), (to, pa.list_(pa.int32())), (n, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in columns], ["recording_id", "place", "to", "n"])

    tables = in_order(w, BLOCK, ["i"], jumps, f"recording_id {kind}, place long, to array<int>, n array<long>").select("recording_id", "place", F.struct("to", "n").alias("value"))
    at = lambda s, x: F.when(s["entry"] >= 0, F.get(x["to"], s["entry"])).otherwise(F.lit(-1))
    enter = lambda s, x: F.struct(at(s, x).alias("entry"), (s["begun"] + F.when(s["entry"] >= 0, F.get(x["n"], s["entry"])).otherwise(F.lit(0))).cast("long").alias("begun"))
    leap = lambda a, x: F.struct(
        F.transform(a["to"], lambda e: F.when(e >= 0, F.get(x["to"], e)).otherwise(F.lit(-1))).alias("to"),
        F.zip_with(a["to"], a["n"], lambda e, n: n + F.when(e >= 0, F.get(x["n"], e)).otherwise(F.lit(0))).alias("n"),
    )
    tables = kept(tables, "jumps")
    entries = exclusive(tables, "recording_id", F.struct(F.lit(0).alias("entry"), F.lit(0).cast("long").alias("begun")), enter, leap)
    none = [F.lit(None).cast(w.schema[c].dataType).alias(c) for c in ("word", "start_time", "end_time")]
    entries = entries.select("recording_id", F.lit(-1).cast("long").alias("i"), *none, F.col("place").alias("block"), F.col("before.entry").alias("entry"), F.col("before.begun").alias("begun")).where("entry >= 0")
    rows = w.unionByName(entries)
    names, columns = ["recording_id", *[c.split()[0] for c in SEGMENT.split(", ")]], to_arrow_schema(rows.schema)
    groups = max(1, tables.count() * block_words // WORDS_AT_ONCE)

    def segments(rows: pd.DataFrame) -> pd.DataFrame:
        batch = pa.RecordBatch.from_pandas(rows[columns.names].sort_values([*BLOCK, "i"], kind="stable"), columns, preserve_index=False)
        found = [b for some in _Block.read([batch], block_words, max_seconds, max_bytes) for b in some]
        # a block that lies within one segment of its recording has no entry
        return pd.DataFrame([x for b in found if b.entry[0] is not None for x in b.segments(close_tail)], columns=names)

    return rows.groupBy(F.pmod(F.xxhash64(*BLOCK), F.lit(groups)).alias("group")).applyInPandas(segments, f"recording_id {kind}, {SEGMENT}")


def renumbered(words: DataFrame) -> DataFrame:
    """words with i counted anew from 0, for words that were filtered."""
    order = Window.partitionBy("recording_id").orderBy("i")
    return words.withColumn("i", F.row_number().over(order) - 1)


def srt_cues(segments: DataFrame) -> DataFrame:
    """segments with the text of their SRT cue, without the empty line behind it."""
    lines = F.concat_ws("\n", F.col("segment").cast("string"), F.concat(clock(F.col("start_time")), F.lit(" --> "), clock(F.col("end_time"))), F.col("text"))
    return segments.withColumn("cue", F.concat(lines, F.lit("\n")))


def vtt_cues(segments: DataFrame) -> DataFrame:
    lines = F.concat_ws("\n", F.concat(clock(F.col("start_time"), "."), F.lit(" --> "), clock(F.col("end_time"), ".")), F.col("text"))
    return segments.withColumn("cue", F.concat(lines, F.lit("\n")))
