"""The comparison of two runs' words: longest common stretches first, then what lies between them.

The rule is recursive: of a stretch of both sides the longest common run counts, the first such in the base and there the first in
the other run, and what lies before and behind it is compared in the same way. Stretches of up to MOST words on both sides
are compared in one task. Longer ones are split in rounds over all of them: words in a row are joined as grams, equal grams on a
diagonal make the maximal runs, and all runs of a stretch's greatest length that follow one another split it at once. A
round so leaves no run of that length, and what remains falls under MOST after a few.

What differs, its place in time and the words around it are joins and windows over the blocks that were found. Joins with
what grows with the recordings are shuffled by hint: Spark takes a table's size from its compressed file and does not
count what an explode makes of it, so that it would send such tables through the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.words import diff_form
from ..sources.tables import kept
from .scan import blocks, exclusive
from .sorted_runs import in_order, starts, whole_keys

AROUND = 8
MOST = 4000  # words of a stretch that one task compares
GRAMS = (16, 4, 1)  # words in a row that long stretches are joined by, one after another where none is common
NEAR = 4096  # places that are looked at together
PAIRS = 2**20  # pairs of equal words that are held for a stretch
PIECE = "alo long, ahi long, blo long, bhi long"
KEYS = ["recording_id", "piece"]


def placed(words: DataFrame, *columns: str) -> DataFrame:
    """Words (recording_id, i, word, start_time, end_time) as `at`, their place by (start_time, i), their form, and the columns named.
    Long recordings are numbered in many tasks."""
    b = blocks(words.select("recording_id", "i", *dict.fromkeys(("word", "start_time", *columns))), "recording_id", "start_time", "i")
    n = b.groupBy("recording_id", "place").agg(F.count(F.lit(1)).alias("value"))
    add = lambda a, x: a + x
    before = exclusive(n, "recording_id", F.lit(0).cast("long"), add, add)
    own = F.row_number().over(Window.partitionBy("recording_id", "place").orderBy("start_time", "i")) - 1
    rows = b.withColumn("own", own).join(before.hint("merge"), ["recording_id", "place"])
    return kept(rows.select("recording_id", (F.col("before") + F.col("own")).alias("at"), *columns, diff_form(F.col("word")).alias("form")), "placed")


def _grams(words: DataFrame, k: int, side: str) -> DataFrame:
    """(recording_id, at, gram) of the k forms in a row that begin at each place."""
    block = F.floor(F.col("at") / NEAR)
    w = words.select("recording_id", "at", "form", F.explode(F.when((F.col("at") % NEAR < k - 1) & (block > 0), F.array(block - 1, block)).otherwise(F.array(block))).alias("block"))
    row = F.collect_list("form").over(Window.partitionBy("recording_id", "block").orderBy("at").rowsBetween(0, k - 1))
    w = w.withColumn("row", row).where((F.size("row") == k) & (block == F.col("block")))
    return w.select("recording_id", "block", F.col("at").alias(side), F.xxhash64("row").alias("gram"), F.hash("row").alias("gram2"))


def _inside(grams: DataFrame, pieces: DataFrame, side: str, k: int) -> DataFrame:
    """The grams that lie in a piece, with its number; pieces are disjoint on each side."""
    low, high = F.col(f"{side}lo"), F.col(f"{side}hi") - k
    p = pieces.where(low <= high).select(*KEYS, low.alias("low"), high.alias("high"), F.explode(F.sequence(F.floor(low / NEAR), F.floor(high / NEAR))).alias("block"))
    return grams.join(p.hint("shuffle_hash"), ["recording_id", "block"]).where((F.col(side) >= F.col("low")) & (F.col(side) <= F.col("high"))).drop("block", "low", "high")


def _runs(a: DataFrame, b: DataFrame, pieces: DataFrame, k: int) -> DataFrame:
    """(recording_id, piece, i, j, n): the maximal common runs of k words and more within the pieces."""
    pairs = _inside(_grams(a, k, "a"), pieces, "a", k).join(_inside(_grams(b, k, "b"), pieces, "b", k), [*KEYS, "gram", "gram2"])
    pairs = pairs.select(*KEYS, F.col("a").alias("i"), (F.col("a") - F.col("b")).alias("diagonal"), F.lit(1).cast("long").alias("n"))
    for near in (NEAR, None):  # first within stretches of a diagonal, then the few that are left along all of it
        key = [*KEYS, "diagonal"] + ([F.floor(F.col("i") / near)] if near else [])
        order = Window.partitionBy(*key).orderBy("i")
        opens = F.when(F.col("i") == F.lag(F.col("i") + F.col("n")).over(order), 0).otherwise(1)
        pairs = pairs.withColumn("opens", opens).withColumn("run", F.sum("opens").over(order))
        pairs = pairs.groupBy(*key, "run").agg(F.min("i").alias("first"), F.sum("n").alias("n")).select(*KEYS, "diagonal", F.col("first").alias("i"), "n")
    return pairs.select(*KEYS, "i", (F.col("i") - F.col("diagonal")).alias("j"), (F.col("n") + k - 1).alias("n"))


def _chained(rows: pd.DataFrame) -> pd.DataFrame:
    """Of a piece's longest runs those that the rule takes one after another, and the pieces that they leave."""
    rows = rows.sort_values(["i", "j"])
    p = rows.iloc[0]
    taken, i, j = [], int(p.alo), int(p.blo)
    for r in rows.itertuples(index=False):
        if r.i >= i and r.j >= j:
            taken.append((r.i, r.j, r.n, i, r.i, j, r.j))
            i, j = r.i + r.n, r.j + r.n
    taken.append((0, 0, 0, i, int(p.ahi), j, int(p.bhi)))
    return pd.DataFrame([(p.recording_id, *t) for t in taken], columns=["recording_id", "i", "j", "n", "alo", "ahi", "blo", "bhi"])


def matching_blocks(a: DataFrame, b: DataFrame, most: int = MOST) -> DataFrame:
    """(recording_id, i, j, n) of two placed() sides: the common runs that the rule finds."""
    kind = a.schema["recording_id"].dataType.simpleString()
    size = lambda w, x: w.groupBy("recording_id").agg((F.max("at") + 1).alias(x))
    zero = F.lit(0).cast("long")
    open_ = size(a, "ahi").join(size(b, "bhi"), "recording_id").select("recording_id", zero.alias("alo"), "ahi", zero.alias("blo"), "bhi", F.lit(0).alias("k"))
    found, small = [], []
    long = F.greatest(F.col("ahi") - F.col("alo"), F.col("bhi") - F.col("blo")) > most
    while True:
        open_ = kept(open_.where("ahi > alo AND bhi > blo").withColumn("long", long).withColumn("piece", F.monotonically_increasing_id()), "pieces")
        small.append(open_.where("NOT long"))
        rest = open_.where(F.col("long") & (F.col("k") < len(GRAMS)))  # those that not even have a word in common are done
        sizes = [r["k"] for r in rest.select("k").distinct().collect()]
        if not sizes:
            break
        next_ = None
        for step in sizes:  # len(GRAMS) at most
            p = rest.where(F.col("k") == step)
            runs = kept(_runs(a, b, p, GRAMS[step]), "runs")
            longest = runs.groupBy(*KEYS).agg(F.max("n").alias("n"))
            top = runs.join(longest, [*KEYS, "n"]).join(p, KEYS)
            split = kept(top.groupBy(*KEYS).applyInPandas(_chained, f"recording_id {kind}, i long, j long, n long, {PIECE}"), "splits")
            found.append(split.where("n > 0").select("recording_id", "i", "j", "n"))
            without = p.join(longest, KEYS, "left_anti").select("recording_id", "alo", "ahi", "blo", "bhi", (F.col("k") + 1).alias("k"))
            more = split.select("recording_id", "alo", "ahi", "blo", "bhi", F.lit(step).alias("k")).unionByName(without)
            next_ = more if next_ is None else next_.unionByName(more)
        open_ = next_
    pieces = small[0]
    for x in small[1:]:
        pieces = pieces.unionByName(x)

    def side(w: DataFrame, x: str) -> DataFrame:
        low, high = F.col(f"{x}lo"), F.col(f"{x}hi")
        p = pieces.withColumn("piece", F.concat_ws("-", "alo", "blo")).select(*KEYS, low.alias("low"), high.alias("high"), F.explode(F.sequence(F.floor(low / NEAR), F.floor((high - 1) / NEAR))).alias("near"))
        return w.select("recording_id", "at", "form", F.floor(F.col("at") / NEAR).alias("near")).join(p.hint("shuffle_hash"), ["recording_id", "near"]).where("at >= low AND at < high").select(*KEYS, "at", "form", F.lit(x).alias("side"))

    out = in_order(side(a, "a").unionByName(side(b, "b")), KEYS, ["side", "at"], _compared, f"recording_id {kind}, i long, j long, n long")
    for x in found:
        out = out.unionByName(x)
    return out


def common_runs(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int, int]]:
    """(i, j, n) of the common runs of two sides' codes that the rule takes: those of difflib's SequenceMatcher without junk.

    Equal words in a row on a diagonal are one maximal run, found once; each stretch looks at the runs that reach into it."""
    order = np.argsort(b, kind="stable")
    low, high = (np.searchsorted(b[order], a, side) for side in ("left", "right"))
    n = high - low
    if n.sum() > PAIRS:
        return [(m.a, m.b, m.size) for m in SequenceMatcher(a=a.tolist(), b=b.tolist(), autojunk=False).get_matching_blocks()[:-1]]
    i = np.repeat(np.arange(len(a)), n)
    j = order[np.arange(len(i)) + np.repeat(low - (np.cumsum(n) - n), n)]
    place = np.sort((i - j + len(b)) * (len(a) + 1) + i)
    first = np.flatnonzero(np.diff(place, prepend=-2) != 1)
    i = place[first] % (len(a) + 1)
    j = i - (place[first] // (len(a) + 1) - len(b))
    open_, out = [(0, len(a), 0, len(b), i, j, np.diff(first, append=len(place)))], []
    while open_:
        alo, ahi, blo, bhi, i, j, n = open_.pop()
        cut = np.maximum(np.maximum(alo - i, blo - j), 0)
        n = np.minimum(np.minimum(n, ahi - i), bhi - j) - cut
        inside = n > 0
        i, j, n = (i + cut)[inside], (j + cut)[inside], n[inside]
        if not len(n):
            continue
        most = int(n.max())
        at = np.flatnonzero(n == most)
        best = at[np.lexsort((j[at], i[at]))[0]] if len(at) > 1 else at[0]
        x, y = int(i[best]), int(j[best])
        out.append((x, y, most))
        if x > alo and y > blo:
            on = (i < x) & (j < y)
            open_.append((alo, x, blo, y, i[on], j[on], n[on]))
        if x + most < ahi and y + most < bhi:
            on = (i + n > x + most) & (j + n > y + most)
            open_.append((x + most, ahi, y + most, bhi, i[on], j[on], n[on]))
    return out


def _compared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of up to MOST words on both sides, each side in order, to the common runs of each."""
    for t in whole_keys(batches, KEYS):
        code = pc.dictionary_encode(t.column("form"), null_encoding="encode").combine_chunks().indices.to_numpy()
        at, base = t.column("at").to_numpy(), pc.equal(t.column("side"), "a").to_numpy()
        first = starts(t, KEYS)
        out, found = [], []
        for lo, hi in zip(first, [*first[1:], len(t)], strict=True):
            mid = lo + int(base[lo:hi].sum())
            if lo < mid < hi:
                made = common_runs(code[lo:mid], code[mid:hi])
                found += [lo] * len(made)
                out += [(m[0] + at[lo], m[1] + at[mid], m[2]) for m in made]
        i, j, n = np.array(out, np.int64).reshape(-1, 3).T
        yield pa.RecordBatch.from_arrays([t.column("recording_id").combine_chunks().take(pa.array(found, pa.int64())), pa.array(i), pa.array(j), pa.array(n)], ["recording_id", "i", "j", "n"])


def regions(found: DataFrame, sizes: DataFrame) -> DataFrame:
    """(recording_id, tag, i1, i2, j1, j2): the blocks, those that touch being one, and what lies between them. sizes has the
    words of both sides (n_a, n_b) of every recording."""
    end = sizes.select("recording_id", F.col("n_a").alias("i"), F.col("n_b").alias("j"), F.lit(0).cast("long").alias("n"))
    order = Window.partitionBy("recording_id").orderBy("i", "j", "n")
    b = found.unionByName(end).withColumn("pi", F.lag(F.col("i") + F.col("n")).over(order)).withColumn("pj", F.lag(F.col("j") + F.col("n")).over(order))
    touches = (F.col("i") == F.col("pi")) & (F.col("j") == F.col("pj")) & (F.col("n") > 0)
    b = b.withColumn("block", F.sum(F.when(touches, 0).otherwise(1)).over(order))
    zero = F.lit(0).cast("long")
    b = b.groupBy("recording_id", "block").agg(F.min("i").alias("i"), F.min("j").alias("j"), F.sum("n").alias("n"), F.min_by(F.struct(F.coalesce("pi", zero).alias("i"), F.coalesce("pj", zero).alias("j")), "i").alias("p"))
    row = lambda tag, i1, i2, j1, j2: F.struct(tag.alias("tag"), *[x.cast("int").alias(c) for c, x in zip(("i1", "i2", "j1", "j2"), (i1, i2, j1, j2), strict=True)])
    i, j, n = F.col("i"), F.col("j"), F.col("n")
    missing, extra = F.col("p.i") < i, F.col("p.j") < j
    gap = F.when(missing & extra, F.lit("replace")).when(missing, F.lit("delete")).when(extra, F.lit("insert"))
    both = F.array(row(gap, F.col("p.i"), i, F.col("p.j"), j), row(F.when(n > 0, F.lit("equal")), i, i + n, j, j + n))
    return b.select("recording_id", F.inline(both)).where("tag IS NOT NULL")


def _around(regions: DataFrame, words: DataFrame, low: Column, high: Column, name: str) -> DataFrame:
    """(recording_id, i1, j1, name, start): the words of a region that differs and AROUND on both sides, and the start of the word at `low`.
    Regions meet the stretches of NEAR words that they reach into, each of which is one row."""
    differs = F.col("tag") != "equal"
    near = lambda x: F.floor(x / NEAR)
    begin, end = F.greatest(low.cast("long") - AROUND, F.lit(0).cast("long")), high.cast("long") + AROUND
    r = regions.select("recording_id", "i1", "j1", differs.alias("differs"), low.cast("long").alias("low"), begin.alias("begin"), end.alias("end"))
    r = r.withColumn("near", F.explode(F.when(F.col("differs"), F.sequence(near(F.col("begin")), near(F.col("end") - 1))).otherwise(F.array(near(F.col("low"))))))
    packed = words.groupBy("recording_id", near(F.col("at")).alias("near")).agg(F.array_sort(F.collect_list(F.struct("at", "word", "start_time"))).alias("w"))
    packed = packed.select("recording_id", "near", F.col("w.word").alias("words"), F.col("w.start_time").alias("starts"))
    place = F.col("near") * NEAR
    first, last = F.greatest(F.col("begin") - place, F.lit(0).cast("long")).cast("int"), F.least(F.col("end") - place, F.lit(NEAR).cast("long")).cast("int")
    text = F.when(F.col("differs"), F.slice("words", first + 1, last - first))
    start = F.when(near(F.col("low")) == F.col("near"), F.get("starts", (F.col("low") - place).cast("int")))
    met = r.join(packed.hint("shuffle_hash"), ["recording_id", "near"]).select("recording_id", "i1", "j1", "near", text.alias("text"), start.alias("start"))
    texts = F.flatten(F.transform(F.array_sort(F.collect_list(F.when(F.col("text").isNotNull(), F.struct("near", "text")))), lambda x: x["text"]))
    return met.groupBy("recording_id", "i1", "j1").agg(F.array_join(texts, " ").alias(name), F.max("start").alias("start"))


def _found(base: DataFrame, run: DataFrame, most: int, *columns: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Both sides' placed() words with the columns named, and their regions()."""
    fill = lambda w: w.withColumn("word", F.coalesce("word", F.lit("")))
    a, b = placed(fill(base), *columns), placed(fill(run), *columns)
    count = lambda w, x: w.groupBy("recording_id").agg(F.count(F.lit(1)).alias(x))
    zero = F.lit(0).cast("long")
    sizes = count(a, "n_a").join(count(b, "n_b"), "recording_id", "full").select("recording_id", F.coalesce("n_a", zero).alias("n_a"), F.coalesce("n_b", zero).alias("n_b"))
    return a, b, regions(matching_blocks(a, b, most), sizes)


def compared(base: DataFrame, run: DataFrame, most: int = MOST) -> DataFrame:
    """The regions of aligned() as (recording_id, tag, i1, i2, j1, j2) alone, without looking up times and the words around them."""
    return _found(base, run, most)[2]


def aligned(base: DataFrame, run: DataFrame, most: int = MOST) -> DataFrame:
    """Regions of two runs' words (recording_id, i, word, start_time, end_time): equal, replace, delete or insert, as places
    i1 to i2 of the base and j1 to j2 of the run; `at` is the base's time there (behind its words their last end, 0 without words).
    Regions that differ have the words around them on both sides, the others empty texts. Words count as equal by their
    form; null ones are like no other text than a null one. A recording that one side lacks is one region."""
    a, b, found = _found(base, run, most, "word", "start_time", "end_time")
    found = kept(found, "regions")
    i1, i2, j1, j2 = map(F.col, ("i1", "i2", "j1", "j2"))
    side_a = _around(found, a, i1, i2, "base_context").withColumnRenamed("start", "start_time")
    side_b = _around(found.where("tag <> 'equal'"), b, j1, j2, "run_context").drop("start")
    out = found
    for side in (side_a, side_b):
        out = out.join(side.hint("shuffle_hash"), ["recording_id", "i1", "j1"], "left")
    out = out.join(a.groupBy("recording_id").agg(F.max_by("end_time", "at").alias("last")).hint("shuffle_hash"), "recording_id", "left")
    text = lambda c: F.when(F.col("tag") == "equal", "").otherwise(F.coalesce(c, F.lit(""))).alias(c)
    return out.select("recording_id", "tag", "i1", "i2", "j1", "j2", F.coalesce("start_time", "last", F.lit(0.0)).alias("at"), text("base_context"), text("run_context"))
