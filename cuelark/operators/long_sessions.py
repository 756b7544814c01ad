"""The accumulator's result without one task per session: by parts that cannot influence each other, and by an anti-join.

Both forms check sequences by a running maximum: what a session has seen is its greatest checked sequence and whether a final
event had it, whatever the events hold.

`accumulated_in_parts` cuts a session between two blocks of its events where nothing earlier can decide about a later word. The last
final time lies between `low`, the greatest up_to so far, and `high`, the latest word end so far if that is more. A later
word that ends by low + END_TOLERANCE is late either way, one that ends behind high + END_TOLERANCE is not; a cut is given up where one ends in
between, or where a word that is not late for sure has its form and its times, within the tolerance, in common with an earlier one. What
is pending must be late too, or be replaced before it is shown. Parts are folded on their own, and a scan over them hands on
the number of committed words and the last final time.

`committed_by_join` has no fold at all where a session's rules are plain: a word goes if an earlier candidate of its form lies
within the tolerance. That is exact unless a word that went took another one with it, a rejected word would have outlasted
the accepted ones, or an event's words are not in the order of their ends; sessions with any of these are folded in parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.words import not_blank, same_word_form
from ..sources.tables import kept
from .accumulate import COMMITTED, END_TOLERANCE, FINAL, PARTIAL, TIMING_TOLERANCE, State, flat, folded
from .scan import blocks, exclusive, running
from .sorted_runs import in_order

SLICE = 16.0  # seconds of a slice in which cuts meet words
WIDEST = 64.0  # seconds between low and high beyond which no cut is tried
CLOSE = 1e-6  # what is closer to a limit than this counts as within it
SLOT = 8 * TIMING_TOLERANCE  # seconds of the slots that words of a form are joined by
SUMMARY = "summary"


def checked(events: DataFrame, key: str = "session_id", tasks: int | None = None) -> DataFrame:
    """Events in blocks, with `error`: what the sequence rules or an unknown type say against an event, else null.
    A null sequence is not checked, as a negative one; words without a text, a start or an end go."""
    full = F.filter("words", lambda w: w["word"].isNotNull() & ~F.isnan(w["start_time"]) & ~F.isnan(w["end_time"]) & w["start_time"].isNotNull() & w["end_time"].isNotNull())
    up_to = F.nanvl(F.col("up_to").cast("double"), F.lit(None).cast("double"))
    e = events.select(key, "arrival", "type", F.coalesce(F.col("sequence").cast("long"), F.lit(-1).cast("long")).alias("sequence"), up_to.alias("up_to"), full.alias("words"))
    e = e.withColumn("last_end", F.array_max(F.transform("words", lambda w: w["end_time"])))  # so that what asks for it alone reads no words
    seen = F.when(F.col("sequence") >= 0, F.struct("sequence", F.coalesce(F.col("type") == FINAL, F.lit(False)).alias("final")))
    e = running(blocks(e, key, "arrival", tasks=tasks), key, "arrival", seen, F.struct(F.lit(-1).cast("long").alias("sequence"), F.lit(False).alias("final")))
    said = F.col("sequence").cast("string")
    most = F.col("before.sequence")
    error = F.when((F.col("sequence") >= 0) & (F.col("sequence") < most), F.concat(F.lit("out of order: "), said, F.lit(" after "), most.cast("string")))
    error = error.when((F.col("sequence") >= 0) & (F.col("sequence") == most) & F.col("before.final"), F.concat(F.lit("already finalised: "), said))
    known = F.coalesce(F.col("type").isin(PARTIAL, FINAL), F.lit(False))
    return e.withColumn("error", error.when(~known, F.concat(F.lit("unknown type: "), F.coalesce("type", F.lit("None"))))).drop("before")


def _last_end(kind: str, up_to: bool) -> Column:
    """The latest word end of accepted events of a kind; with up_to, or their own time."""
    end = F.col("last_end")
    return F.when(F.col("error").isNull() & (F.col("type") == kind), F.greatest(end, F.col("up_to")) if up_to else end)


def bounds(events: DataFrame, key: str) -> DataFrame:
    """(key, place, before struct<low, high, open>): between what the last final time lies before a block, and the latest
    end that a word may have that is pending there."""
    low = F.when(F.col("error").isNull() & (F.col("type") == FINAL), F.col("up_to"))
    top = events.groupBy(key, "place").agg(F.struct(F.max(low).alias("low"), F.max(_last_end(FINAL, True)).alias("high"), F.max(_last_end(PARTIAL, False)).alias("open")).alias("value"))
    most = lambda a, x: F.struct(*[F.greatest(a[c], x[c]).alias(c) for c in ("low", "high", "open")])
    return exclusive(top, key, F.struct(F.lit(0.0).alias("low"), F.lit(0.0).alias("high"), F.lit(0.0).alias("open")), most, most)


def parts(events: DataFrame, key: str = "session_id") -> DataFrame:
    """(key, place, part, low) of the blocks of checked(): the part that each belongs to, and where its last final time begins."""
    at = kept(bounds(events, key).select(key, "place", "before.*"), "bounds")
    shows = F.when(F.col("error").isNotNull() | (F.col("type") == PARTIAL), F.struct("arrival", F.col("error").isNull().alias("replaces")))
    first = events.groupBy(key, "place").agg(F.coalesce(F.min(shows)["replaces"], F.lit(False)).alias("replaces"))
    c = at.join(first, [key, "place"]).join(at.groupBy(key).agg(F.min("place").alias("first")), key)
    c = c.where((F.col("place") > F.col("first")) & (F.col("replaces") | (F.col("open") <= F.col("low") + END_TOLERANCE)) & (F.col("high") - F.col("low") <= WIDEST))
    c = kept(c.select(key, "place", (F.col("low") + END_TOLERANCE).alias("late"), (F.col("high") + END_TOLERANCE + CLOSE).alias("timely")), "cuts")
    reach = TIMING_TOLERANCE + CLOSE
    around = c.withColumn("slice", F.explode(F.sequence(F.floor((F.col("late") - reach) / SLICE), F.floor((F.col("timely") + reach) / SLICE))))
    w = events.where("error IS NULL").select(key, F.col("place").alias("at"), "type", F.explode("words").alias("w")).where(not_blank(F.col("w.word")))
    w = w.select(key, "at", "type", "w.start_time", "w.end_time", same_word_form(F.col("w.word")).alias("form"), F.floor(F.col("w.end_time") / SLICE).alias("slice"))
    met = kept(w.join(around, [key, "slice"]).where((F.col("end_time") > F.col("late") - reach) & (F.col("end_time") <= F.col("timely") + reach)), "words-at-cuts")
    later = met.where("at >= place AND end_time > late")
    earlier = met.where((F.col("at") < F.col("place")) & (F.col("type") == FINAL)).select(key, "place", "form", *[F.col(x).alias(f"b_{x}") for x in ("start_time", "end_time")])
    near = [F.abs(F.col(x) - F.col(f"b_{x}")) <= reach for x in ("start_time", "end_time")]
    bad = later.where("end_time <= timely").select(key, "place").unionByName(later.join(earlier, [key, "place", "form"]).where(near[0] & near[1]).select(key, "place")).distinct()
    fine = c.select(key, "place").join(bad, [key, "place"], "left_anti").withColumn("cut", F.lit(1))
    numbered = at.select(key, "place", "low").join(fine, [key, "place"], "left").select(key, "place", F.struct(F.coalesce("cut", F.lit(0)).cast("long").alias("cuts"), F.when(F.col("cut") == 1, F.col("low")).alias("low")).alias("value"))
    add = lambda a, x: F.struct((a["cuts"] + x["cuts"]).alias("cuts"), F.coalesce(x["low"], a["low"]).alias("low"))
    before = exclusive(numbered, key, F.struct(F.lit(0).cast("long").alias("cuts"), F.lit(0.0).alias("low")), add, add)
    both = numbered.join(before, [key, "place"])
    return both.select(key, "place", (F.col("before.cuts") + F.col("value.cuts")).alias("part"), F.coalesce("value.low", "before.low").alias("low"))


def _total(state: State) -> tuple:
    """The row behind a part: its count of words and last final time."""
    return None, None, state.n_committed, None, None, None, state.last_final, SUMMARY, None


def accumulated_in_parts(events: DataFrame, key: str = "session_id", tasks: int | None = None) -> DataFrame:
    """The rows of accumulate.accumulated, from parts of sessions that are folded in tasks of their own."""
    e = checked(events, key, tasks)
    kind = events.schema[key].dataType.simpleString()
    rows = flat(e.join(parts(e, key).hint("merge"), [key, "place"]), key, "part", "low")
    fold = folded([key, "part"], lambda low: State(last_final=float(low)), known=True, end=_total, more=("low",))
    out = kept(in_order(rows, [key, "part"], ["arrival"], fold, f"{key} {kind}, part long, {COMMITTED}").withColumn("total", F.col("arrival").isNull()), "parts")
    sums = out.where("total").select(key, F.col("part").alias("place"), F.struct(F.col("position").cast("long").alias("n"), "last_final").alias("value"))
    add = lambda a, x: F.struct((a["n"] + x["n"]).alias("n"), F.greatest(a["last_final"], x["last_final"]).alias("last_final"))
    before = exclusive(sums, key, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("last_final")), add, add)
    rows = out.where("NOT total").join(before.withColumnRenamed("place", "part"), [key, "part"])
    return rows.withColumn("position", (F.col("position") + F.col("before.n")).cast("int")).withColumn("last_final", F.greatest("last_final", "before.last_final")).select(key, *[c.split()[0] for c in COMMITTED.split(", ")])


def final_times(events: DataFrame, key: str = "session_id", tasks: int | None = None) -> DataFrame:
    """Final events that the sequence rules take, with last_final: the greatest up_to and word end before each of them."""
    e = checked(events, key, tasks).where((F.col("type") == FINAL) & F.col("error").isNull())
    return running(e, key, "arrival", _last_end(FINAL, True), F.lit(0.0)).withColumnRenamed("before", "last_final")


def committed_by_join(events: DataFrame, key: str = "session_id", tasks: int | None = None) -> DataFrame:
    """(key, arrival, sequence, word, start_time, end_time) of the words that final events commit. A hot session is many keys of
    the join: its forms, by the slot of SLOT seconds that a word ends in; an earlier word is in two where it ends near a border."""
    e = kept(final_times(events, key, tasks).select(key, "arrival", "sequence", F.coalesce("up_to", F.lit(0.0)).alias("up_to"), "words", "last_final"), "finals")
    timely = lambda word, end: not_blank(word) & (end > F.col("last_final") + END_TOLERANCE)
    w = e.select(key, "arrival", "last_final", F.posexplode("words").alias("at", "w")).where(timely(F.col("w.word"), F.col("w.end_time")))
    slot, reach = lambda x: F.floor(x / SLOT), TIMING_TOLERANCE + CLOSE
    c = w.select(key, same_word_form(F.col("w.word")).alias("form"), "arrival", "at", "w.start_time", "w.end_time")
    a = c.withColumn("slot", slot(F.col("end_time")))
    b = c.select(key, "form", *[F.col(x).alias(f"b_{x}") for x in ("arrival", "at", "start_time", "end_time")])
    b = b.withColumn("slot", F.explode(F.array_distinct(F.array(slot(F.col("b_end_time") - reach), slot(F.col("b_end_time") + reach)))))
    near = [F.abs(F.col(x) - F.col(f"b_{x}")) <= TIMING_TOLERANCE for x in ("start_time", "end_time")]
    pairs = a.join(b.hint("merge"), [key, "form", "slot"]).where("b_arrival < arrival OR b_arrival = arrival AND b_at < at").where(near[0] & near[1])
    pairs = kept(pairs.select(key, "arrival", "at", "b_arrival", "b_at"), "pairs")
    gone = pairs.select(key, "arrival", "at").distinct()
    chained = pairs.select(key, F.col("b_arrival").alias("arrival"), F.col("b_at").alias("at")).join(gone.hint("merge"), [key, "arrival", "at"], "left_semi").select(key)

    # each event with the places of its words that went: what stays, and whether the plain rule holds, are told within the row
    e = e.join(gone.groupBy(key, "arrival").agg(F.collect_list("at").alias("gone")).hint("shuffle_hash"), [key, "arrival"], "left")
    stays = lambda x, k: timely(x["word"], x["end_time"]) & ~F.coalesce(F.array_contains("gone", k), F.lit(False))
    last = lambda words: F.array_max(F.transform(words, lambda x: x["end_time"]))
    taken = F.filter("words", stays)
    lost = last(F.filter("words", lambda x, k: not_blank(x["word"]) & ~stays(x, k)))
    ends, pairs_ = F.transform("words", lambda x: x["end_time"]), F.greatest(F.size("words") - 1, F.lit(0))
    falling = F.exists(F.zip_with(F.slice(ends, F.lit(1), pairs_), F.slice(ends, F.lit(2), pairs_), lambda p, q: q < p), lambda x: x)
    hard = F.coalesce(lost > F.greatest("up_to", "last_final", last(taken)), F.lit(False)) | F.coalesce(falling, F.lit(False))
    marked = kept(e.select(key, "arrival", "sequence", taken.alias("words"), hard.alias("hard")), "marked")
    hard = kept(chained.unionByName(marked.where("hard").select(key)).distinct(), "hard-sessions")
    stay = marked.select(key, "arrival", "sequence", F.explode("words").alias("w")).select(key, "arrival", "sequence", "w.word", "w.start_time", "w.end_time")
    if hard.isEmpty():
        return stay
    folded_ = accumulated_in_parts(events.join(hard, key, "left_semi"), key, tasks).where("word IS NOT NULL")
    return stay.join(hard, key, "left_anti").unionByName(folded_.select(*stay.columns))
