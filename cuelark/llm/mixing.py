"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only.

A document's weight is its grade, the number of binary digits of its size up to GRADES: of a source's target, long
documents get more copies than short ones, but none over `most`. The expected copies of a document are the rate of
its source times its grade; the rate is such that the expected words make up the target.

Every document is first given the whole copies that are certain (the integer part). What is then missing from a source's
target is drawn without replacement in Pareto order, each document's inclusion probability p being the fraction that is
left of its expected copies: documents are ranked by their random odds u/(1-u) divided by their inclusion
odds p/(1-p), and the sample is the prefix of this order whose words come nearest to what is missing.

Skew: the running sum of words in that order is taken in BINS slices of the ratio per source, whose totals are summed up first,
in blocks and then in the blocks' slices, so that a source with a third of all rows is spread over all tasks. Only tables with
one row per source and grade are ordered as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, documents, keyed, written

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
GRADES = 10
BINS, BLOCK = 65536, 256


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """(source, source_size) to (source, source_size, target): shares of all words by weight, none over
    `most` times its source. A source that would be is given that much, and what is left is shared by weight
    among the others: in the order of most * size / weight, the full ones are a prefix."""
    whole = Window.partitionBy()
    n = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (n % len(weights) + 1).cast("int")).cast("long")
    s = sizes.withColumn("w", weight).withColumn("n", n).withColumn("cap", F.col("source_size") * most)
    order = Window.orderBy(F.col("cap") / F.col("w"), "n").rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("left", F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(order), F.lit(0)))
    s = s.withColumn("w_left", F.sum("w").over(whole) - F.coalesce(F.sum("w").over(order), F.lit(0)))
    s = s.withColumn("full", F.col("cap") * F.col("w_left") <= F.col("w") * F.col("left"))
    first = F.min(F.when(~F.col("full"), F.struct(F.col("cap") / F.col("w"), "n", "left", "w_left"))).over(whole)
    s = s.withColumn("first", first)
    share = (F.col("w") * F.col("first.left")).cast("double") / F.col("first.w_left")
    return s.select("source", "source_size", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(share).alias("target"))


def grade(size: Column) -> Column:
    """The weight of a document: 0 without words, GRADES from 2 ** (GRADES - 1) words on."""
    return sum(((size >= 2**k).cast("long") for k in range(GRADES)), F.lit(0).cast("long"))


def rates(sizes: DataFrame, weights=WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """(source, grade, words) to (source, grade, source_size, target, rate): the expected copies of a document of the source
    and grade. In each source the highest grades are full at `most`, as many as the target asks for; the others share the rest."""
    share = targets(sizes.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most).withColumnRenamed("source", "of")
    s = sizes.join(share, sizes["source"].eqNullSafe(share["of"])).drop("of")
    above = Window.partitionBy("source").orderBy(F.desc("grade")).rowsBetween(Window.unboundedPreceding, -1)
    below = Window.partitionBy("source").orderBy(F.desc("grade")).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    s = s.withColumn("rest", F.col("target") - most * F.coalesce(F.sum("words").over(above), F.lit(0)))
    s = s.withColumn("weighed", F.sum(F.col("words") * F.col("grade")).over(below))
    s = s.withColumn("full", (F.col("weighed") > 0) & (F.col("rest") * F.col("grade") >= most * F.col("weighed")))
    # the first grade that is not full, from above, sets the rate of all below it
    first = F.max(F.when(~F.col("full"), F.struct("grade", "rest", "weighed"))).over(Window.partitionBy("source"))
    s = s.withColumn("first", first)
    rate = F.when(F.col("first.weighed") > 0, F.greatest(F.col("first.rest"), F.lit(0.0)) * F.col("grade") / F.col("first.weighed")).otherwise(0.0)
    full = F.col("full") & (F.col("first").isNull() | (F.col("grade") > F.col("first.grade")))
    return s.select("source", "grade", "source_size", "target", F.when(full, F.lit(float(most))).otherwise(F.least(rate, F.lit(float(most)))).alias("rate"))


def mixed(docs: DataFrame, seed: str = "", weights=WEIGHTS, most: int = MOST_COPIES, bins: int = BINS, also: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, rate (expected copies), copies, taken (= copies * size).

    Null texts and texts without words have size 0 and are never taken; null sources form one source, the last. Reruns
    agree, as u comes from doc_id alone (rows with one doc_id share it; ties are broken by doc_id, then size, then
    `also`, columns that come along). Other columns are ignored; an empty table gives an empty result.
    """
    sized = docs.select(*also, "doc_id", "source", words(F.col("text")).alias("size"))
    sized = written(sized.withColumn("grade", grade(F.col("size"))), "sizes")
    share = rates(sized.groupBy("source", "grade").agg(F.sum("size").alias("words")), weights, most)
    share = written(share.select(F.col("source").alias("of"), F.col("grade").alias("at"), "source_size", "target", "rate"), "rates")
    u = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 13), 16, 10).cast("long") / F.lit(float(2**52))
    d = sized.join(share, sized["source"].eqNullSafe(share["of"]) & (sized["grade"] == share["at"])).withColumn("u", u)
    d = d.withColumn("sure", F.floor("rate")).withColumn("p", F.col("rate") - F.floor("rate"))
    odds = F.when(F.col("p") > 0, (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p"))))
    d = d.withColumn("q", odds).withColumn("bin", F.floor(F.col("q") / (1 + F.col("q")) * bins))
    bin_sums = written(d.groupBy("of", "bin").agg(F.sum("size").alias("words"), F.sum(F.col("size") * F.col("sure")).alias("certain")), "bins")
    certain = bin_sums.groupBy("of").agg(F.sum("certain").alias("certain"))
    blocks = bin_sums.where("bin IS NOT NULL").groupBy("of", F.expr(f"bin div {BLOCK}").alias("block")).agg(F.sum("words").alias("words"))
    running = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    so_far = lambda w: F.coalesce(F.sum("words").over(w), F.lit(0))
    blocks = blocks.select(F.col("of").alias("of_"), F.col("block").alias("block_"), so_far(running("of", "block")).alias("ahead"))
    need = share.select(F.col("of").alias("need_of"), "target").distinct().join(certain, F.col("need_of").eqNullSafe(certain["of"])).select("need_of", (F.col("target") - F.col("certain")).alias("need"))
    sums = bin_sums.where("bin IS NOT NULL").withColumn("block", F.expr(f"bin div {BLOCK}"))
    sums = sums.withColumn("within", so_far(running("of", "block", "bin")))
    sums = sums.join(blocks, sums["of"].eqNullSafe(blocks["of_"]) & (sums["block"] == blocks["block_"])).join(need, sums["of"].eqNullSafe(need["need_of"]))
    sums = written(sums.select(F.col("of").alias("of_"), F.col("bin").alias("bin_"), (F.col("ahead") + F.col("within")).alias("before"), "need"), "sums")
    d = d.join(sums, d["of"].eqNullSafe(sums["of_"]) & (d["bin"] == sums["bin_"]), "left")
    run = F.sum("size").over(Window.partitionBy("of", "bin").orderBy("q", "doc_id", "size", *also).rowsBetween(Window.unboundedPreceding, 0))
    drawn = (F.col("p") > 0) & (F.col("before") + run - F.col("size") / F.lit(2.0) <= F.col("need"))
    return d.select(*also, "doc_id", "source", "size", "source_size", "target", "rate", "sure", drawn.alias("drawn")).select(
        *also, "doc_id", "source", "size", "source_size", "target", "rate", (F.col("sure") + F.when(F.col("drawn"), 1).otherwise(0)).alias("copies")
    ).withColumn("taken", F.col("copies") * F.col("size"))


def mix(docs: DataFrame) -> DataFrame:
    """docs with each row repeated as often as the mix takes it; columns unchanged. A row that is not taken goes."""
    rows = keyed(docs, *[c for c in docs.columns if c != "doc_id"])
    took = mixed(rows, also=("uid",)).where("copies > 0").select("uid", F.col("copies").cast("int").alias("_n"))
    out = rows.join(took, "uid")
    return out.withColumn("_k", F.explode(F.sequence(F.lit(1), F.col("_n")))).select(*docs.columns)


def op4_source_mixing(spark, sf_dir):
    return mixed(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
tot AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
num AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS n FROM tot),
wt AS (SELECT *, (CASE n % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END)::BIGINT AS w, source_size * 3 AS cap FROM num),
run AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER o, 0))::BIGINT AS rest, (sum(w) OVER () - coalesce(sum(w) OVER o, 0))::BIGINT AS w_left
  FROM wt WINDOW o AS (ORDER BY cap::DOUBLE / w, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
mark AS (SELECT *, cap * w_left <= w * rest AS is_full FROM run),
fst AS (SELECT rest AS rest1, w_left AS w_left1 FROM mark WHERE NOT is_full ORDER BY cap::DOUBLE / w, n LIMIT 1),
share AS (
  SELECT source, source_size, CASE WHEN is_full THEN cap::DOUBLE ELSE (w * rest1)::DOUBLE / w_left1 END AS target
  FROM mark LEFT JOIN fst ON true),
graded AS (SELECT *, CASE WHEN size = 0 THEN 0 ELSE least(10, length(bin(size))) END AS grade FROM sized),
gr AS (SELECT source, grade, sum(size)::BIGINT AS words FROM graded GROUP BY ALL),
gs AS (
  SELECT g.*, h.source_size, h.target, h.target - 3 * coalesce(sum(g.words) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         (sum(g.words * g.grade) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS weighed
  FROM gr g JOIN share h ON g.source IS NOT DISTINCT FROM h.source WINDOW w AS (PARTITION BY g.source ORDER BY g.grade DESC)),
gf AS (SELECT *, weighed > 0 AND rest * grade >= 3 * weighed AS is_full FROM gs),
g1 AS (SELECT source AS of, max(grade) AS grade1, arg_max(rest, grade) AS rest1, arg_max(weighed, grade) AS weighed1 FROM gf WHERE NOT is_full GROUP BY 1),
rate AS (
  SELECT gf.source, gf.grade, gf.source_size, gf.target, CASE WHEN is_full AND (grade1 IS NULL OR gf.grade > grade1) THEN 3.0::DOUBLE
    WHEN weighed1 > 0 THEN least(greatest(rest1, 0) * gf.grade / weighed1, 3.0::DOUBLE) ELSE 0 END AS rate
  FROM gf LEFT JOIN g1 ON gf.source IS NOT DISTINCT FROM g1.of),
d AS (
  SELECT s.doc_id, s.source, s.size, r.source_size, r.target, r.rate,
         ('0x' || substr(md5(coalesce(s.doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496::DOUBLE AS u
  FROM graded s JOIN rate r ON s.source IS NOT DISTINCT FROM r.source AND s.grade = r.grade),
e AS (SELECT *, floor(rate)::BIGINT AS sure, rate - floor(rate) AS p FROM d),
f AS (SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS q, target - sum(sure * size) OVER (PARTITION BY source) AS need FROM e),
g AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY q NULLS LAST, doc_id, size ROWS UNBOUNDED PRECEDING) AS run FROM f),
h AS (SELECT *, sure + CASE WHEN p > 0 AND run - size / 2.0::DOUBLE <= need THEN 1 ELSE 0 END AS copies FROM g)
SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken, source, copies::BIGINT AS copies FROM h
"""
