"""Ranked lexical search: Block-Max MaxScore over sharded, block-compressed postings.

`indexed` deals every document into a shard of one task's texts. A shard is one row: its documents, its terms (64-bit
hashes, sorted) and, for each term, postings in blocks of BLOCK documents, packed as byte-wide gaps and counts with
the last document and the greatest impact of each block beside them. Impacts need two numbers of the whole corpus, which
a first pass counts; weights need each term's document frequency, which the shards are asked for by block of queries.

`searched` pairs every block of queries with every shard, as rows of an equality join. In a shard, a query's terms are put in the
order of their global bounds. The greatest are essential and unpacked whole, until the bounds of the rest together stay below the
score that a document must reach; documents are only looked for in the essential lists. Candidates are then led through the non-essential
lists from the largest bound down, and the maxima of their blocks reject most of them before a block is unpacked. A task's
heap goes from shard to shard, so that later ones start with a threshold; a window function merges the tasks' heaps.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded, documents, dropped, small, written
from .hard_negatives import NONE, Heaps
from .quality_rules import per_row, raw_bytes

SHARD_BYTES, SHARD_DOCS = 2**23, 2**14
BLOCK = 64
ITEMS_A_BLOCK = 256
SHARDS_A_GROUP = 16  # shards of a group, which a block of queries is sent to once
TOP = 20
AT_ONCE = 64  # blocks of queries whose heaps a task holds together
LAST_ID = np.iinfo(np.int64).max  # stands for a null doc_id, which comes behind all others

#: Digits, A-Z, a-z and all bytes of what is not ASCII; A-Z become a-z, the rest spaces.
_IN_TERM = np.zeros(256, bool)
_IN_TERM[0x30:0x3A] = _IN_TERM[0x41:0x5B] = _IN_TERM[0x61:0x7B] = _IN_TERM[0x80:] = True
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if _IN_TERM[b] else 0x20 for b in range(256))

SHARD = {"ids": "<i8", "m": "<i8", "terms": "<u8", "df": "<i4", "last": "<u2", "most": "<u4", "widths": "u1", "gaps": "u1", "counts": "u1"}
INDEX = "task int, k int, " + ", ".join(f"{c} binary" for c in SHARD)
QUERIES = "q int, uids binary, ends binary, terms binary, times binary"


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def term_hash(term: bytes) -> int:
    return xxhash.xxh3_64_intdigest(term)


class Totals(NamedTuple):
    """n_docs: documents with a term; n_terms: all their terms, with repeats."""

    n_docs: int
    n_terms: int

    def m(self, n: np.ndarray) -> np.ndarray:
        """The length part of documents of n terms."""
        if 25 * int(n.max(initial=0)) * self.n_docs >= 2**63:
            return np.array([75 + 25 * x * self.n_docs // self.n_terms for x in n.tolist()], np.int64)
        return 75 + 25 * n.astype(np.int64) * self.n_docs // max(self.n_terms, 1)

    def weight(self, df: int) -> int:
        return math.floor(1000 * math.log((2 * self.n_docs + 2) / (2 * df + 1)))


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


def _counted(batches):
    for batch in small(batches):
        buffer, ends, _ = raw_bytes(batch.column("text"))
        inside = _IN_TERM[buffer]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        at = ends[:-1][np.diff(ends) > 0]
        first[at] = inside[at]  # a row's first byte follows no other
        n = per_row(first, ends)
        yield pa.RecordBatch.from_pydict({"n_docs": pa.array([int((n > 0).sum())]), "n_terms": pa.array([int(n.sum())])})


def totals(docs: DataFrame) -> Totals:
    """Two sums over all texts."""
    got = docs.select("text").mapInArrow(_counted, "n_docs long, n_terms long").agg(F.sum("n_docs").alias("d"), F.sum("n_terms").alias("t")).first()
    return Totals(got["d"] or 0, got["t"] or 0)


def _bytes_of(values: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """Values as little-endian numbers of 0, 1, 2 or 4 bytes each, one behind another."""
    at = np.cumsum(widths) - widths
    out = np.zeros(int(widths.sum()), np.uint8)
    for byte in range(4):
        here = widths > byte
        out[at[here] + byte] = values[here] >> (8 * byte) & 255
    return out


def shard(ids: np.ndarray, texts: list[bytes], of: Totals) -> dict[str, np.ndarray]:
    """The columns of SHARD for at most SHARD_DOCS documents."""
    words, n = [], np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        own = terms_of(text)
        n[i] = len(own)
        words += own
    tokens = np.empty(len(words), object)
    tokens[:] = words
    code, known = pd.factorize(tokens)
    hashes = np.fromiter(map(term_hash, known), np.uint64, len(known))
    order = np.argsort(hashes)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    m = of.m(n)
    key = np.sort(place[code] * len(texts) + np.repeat(np.arange(len(texts)), n)) if len(code) else np.zeros(0, np.int64)
    first = np.flatnonzero(np.diff(key, prepend=-1))
    tf = np.diff(np.append(first, len(key)))
    term, doc = np.divmod(key[first], max(len(texts), 1))
    df = np.bincount(term, minlength=len(known))
    begin = np.cumsum(df) - df
    opens = (np.arange(len(doc)) - begin[term]) % BLOCK == 0
    starts, block = np.flatnonzero(opens), np.cumsum(opens) - 1
    gap = np.where(opens, doc, doc - np.concatenate([[0], doc[:-1]]))
    ends = np.append(starts[1:], len(doc))[: len(starts)]
    top = (lambda x: np.maximum.reduceat(x, starts)) if len(starts) else lambda x: x
    wide, tall = top(gap), top(tf)
    gw, tw = 1 + (wide > 255), np.select([tall == 1, tall < 2**8, tall < 2**16], [0, 1, 2], 4)
    made = {
        "ids": ids, "m": m, "terms": hashes[order], "df": df, "last": doc[ends - 1], "most": top(impact(tf, m[doc])), "widths": gw | tw << 4,
        "gaps": _bytes_of(gap, gw[block]), "counts": _bytes_of(tf, tw[block]),
    }
    return {c: made[c].astype(kind) for c, kind in SHARD.items()}


def _sharded(of: Totals, shard_bytes: int, shard_docs: int):
    def run(batches):
        task, k, ids, texts, size = TaskContext.get().partitionId(), 0, [], [], 0

        def made():
            s = shard(np.array(ids, np.int64), texts, of)
            return pa.RecordBatch.from_pydict({"task": pa.array([task], pa.int32()), "k": pa.array([k], pa.int32()), **{c: pa.array([x.tobytes()], pa.binary()) for c, x in s.items()}})

        for batch in small(batches):
            for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                ids.append(LAST_ID if i is None else i)
                texts.append(text or b"")
                size += len(texts[-1])
                if size >= shard_bytes or len(ids) == shard_docs:
                    yield made()
                    k, ids, texts, size = k + 1, [], [], 0
        if ids:
            yield made()

    return run


def indexed(docs: DataFrame, of: Totals, shard_bytes: int = SHARD_BYTES, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """(doc_id integer, text) to the index, a written table of INDEX rows. It holds every document and every term."""
    bounded(docs.sparkSession)
    return written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_sharded(of, shard_bytes, min(shard_docs, 2**16)), INDEX), "postings")


class Shard:
    """A row of the index, ready to be searched."""

    def __init__(self, row: dict):
        for c, kind in SHARD.items():
            setattr(self, c, np.frombuffer(row[c], kind))
        self.m = self.m.astype(np.int64)
        df = self.df.astype(np.int64)
        n_blocks = -(-df // BLOCK)
        self.first = np.concatenate([[0], np.cumsum(n_blocks)])  # a term's blocks are first[t] to first[t + 1]
        self.size = np.full(len(self.last), BLOCK, np.int64)
        if len(df):
            self.size[self.first[1:] - 1] = df - (n_blocks - 1) * BLOCK
        self.gw, self.tw = (self.widths & 15).astype(np.int64), (self.widths >> 4).astype(np.int64)
        self.gap_at, self.count_at = np.cumsum(self.size * self.gw) - self.size * self.gw, np.cumsum(self.size * self.tw) - self.size * self.tw
        self.greatest = np.maximum.reduceat(self.most, self.first[:-1]).astype(np.int64) if len(df) else np.zeros(0, np.int64)

    def unpacked(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index into blocks, document, impact) of the postings of some blocks."""
        n = self.size[blocks]
        of = np.repeat(np.arange(len(blocks)), n)
        starts = np.cumsum(n) - n
        place = np.arange(len(of)) - starts[of]
        gap = self._numbers(self.gaps, self.gap_at[blocks], self.gw[blocks], of, place)
        tf = self._numbers(self.counts, self.count_at[blocks], self.tw[blocks], of, place)
        tf[self.tw[blocks][of] == 0] = 1
        sums = np.cumsum(gap)
        doc = sums - (sums[starts] - gap[starts])[of]
        return of, doc, impact(tf, self.m[doc])

    @staticmethod
    def _numbers(data: np.ndarray, at: np.ndarray, width: np.ndarray, of: np.ndarray, place: np.ndarray) -> np.ndarray:
        w = width[of]
        at, out = at[of] + place * w, np.zeros(len(of), np.int64)
        for byte in range(int(w.max(initial=0))):
            here = w > byte
            out[here] |= data[at[here] + byte].astype(np.int64) << (8 * byte)
        return out


def search(s: Shard, terms: np.ndarray, weights: np.ndarray, heaps: Heaps, slot: int) -> int:
    """Leads one query (different terms, and their weights times their repeats) through a shard; the postings it unpacked."""
    at = np.searchsorted(s.terms, terms)
    here = (at < len(s.terms)) & (weights > 0)
    here[here] = s.terms[at[here]] == terms[here]
    t, w = at[here], weights[here]
    bound = w * s.greatest[t]
    order = np.argsort(bound, kind="stable")
    t, w, upto = t[order], w[order], np.cumsum(bound[order])
    size, unpacked, k = heaps.score.shape[1], 0, len(t) - 1
    held = heaps.score[slot][heaps.score[slot] != NONE]
    need = max(1, int(heaps.score[slot, -1]))  # an equal score may still win by its doc_id
    score, c = np.zeros(len(s.ids), np.int64), np.zeros(0, np.int64)

    def asked() -> int:
        """The score that a document must reach, by what the heap holds and the candidates have so far."""
        have = np.concatenate([held, score[c]])
        return max(need, int(np.partition(have, -size)[-size])) if len(have) >= size else need

    while k >= 0 and upto[k] >= need:  # this list and those before it could reach `need` together: it is essential
        _, doc, hit = s.unpacked(np.arange(s.first[t[k]], s.first[t[k] + 1]))
        unpacked += len(doc)
        score[doc] += w[k] * hit  # a document comes once in a list
        c = np.flatnonzero(score)
        need, k = asked(), k - 1
    for k in range(k, -1, -1):
        c = c[score[c] + upto[k] >= need]
        if not len(c):
            return unpacked
        a, b = s.first[t[k]], s.first[t[k] + 1]
        block = a + np.searchsorted(s.last[a:b], c)
        inside = block < b
        most = np.where(inside, s.most[np.minimum(block, b - 1)], 0) * w[k]
        alive = score[c] + most + (upto[k - 1] if k else 0) >= need
        c, block = c[alive], block[alive & inside]
        if len(block):
            _, doc, hit = s.unpacked(np.unique(block))
            unpacked += len(doc)
            score[doc] += w[k] * hit  # those that are no candidates any more are not read again
            need = asked()
    c = c[score[c] >= need]
    heaps.merge(score[None, c], s.ids[None, c], np.array([slot]))
    return unpacked


def _query_blocks(table: pa.Table) -> pa.Table:
    table = table.sort_by("uid")
    terms, times, ends = [], [], [0]
    for text in table.column("text").cast(pa.binary()).to_pylist():
        own = pd.Series([term_hash(x) for x in terms_of(text or b"")], dtype=np.uint64).value_counts(sort=False)
        terms.append(own.index.to_numpy(np.uint64))
        times.append(own.to_numpy(np.int64))
        ends.append(ends[-1] + len(own))
    made = [table.column("uid").to_numpy().astype(np.int64), np.array(ends, np.int64), np.concatenate(terms), np.concatenate(times)]
    return pa.table({"q": table.column("q").slice(0, 1), **{c: pa.array([x.tobytes()], pa.binary()) for c, x in zip(("uids", "ends", "terms", "times"), made, strict=True)}})


def _cells(blocks: DataFrame, index: DataFrame, n_blocks: int, n_groups: int) -> DataFrame:
    """Every block of queries with every shard as one row, by an equality join on (q, g)."""
    g = F.pmod(F.xxhash64("task", "k"), F.lit(n_groups)).cast("int")
    shards = index.select(g.alias("g"), F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("q"), *[F.col(c).alias(f"s_{c}") for c in SHARD])
    return blocks.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1)))).join(shards, ["q", "g"])


def _frequencies(batches):
    """(q, term, df) of the queries' terms in each shard."""
    for batch in batches:
        for i in range(len(batch)):
            row = {c: batch.column(c)[i].as_py() for c in ("q", "terms", "s_terms", "s_df")}
            wanted = np.unique(np.frombuffer(row["terms"], np.uint64))
            known, df = np.frombuffer(row["s_terms"], np.uint64), np.frombuffer(row["s_df"], SHARD["df"])
            at = np.searchsorted(known, wanted)
            here = at < len(known)
            here[here] = known[at[here]] == wanted[here]
            yield pa.RecordBatch.from_pydict({"q": pa.array(np.full(here.sum(), row["q"], np.int32)), "term": pa.array(wanted[here].view(np.int64)), "df": pa.array(df[at[here]].astype(np.int64))})


def _searched(of: Totals, top: int):
    def begun(row: dict) -> tuple:
        """A block's uids, its queries as (terms, weights), and their heaps."""
        uids, ends, terms, times = (np.frombuffer(row[c], kind) for c, kind in (("uids", np.int64), ("ends", np.int64), ("terms", np.uint64), ("times", np.int64)))
        df = dict(zip(np.array(row["df_terms"] or [], np.int64).view(np.uint64).tolist(), row["df"] or [], strict=True))
        weights = np.array([of.weight(df[t]) if t in df else 0 for t in terms.tolist()], np.int64) * times
        return uids, [(terms[a:b], weights[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)], Heaps(len(uids), top)

    def flushed(uids, _, heaps) -> pa.RecordBatch:
        slot, score, ids = heaps.entries()
        return pa.RecordBatch.from_pydict({"uid": pa.array(uids[slot]), "doc_id": pa.array(ids), "score": pa.array(score)})

    def run(batches):
        held: dict[int, tuple] = {}
        for batch in batches:
            for i in range(len(batch)):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                if row["q"] not in held:
                    if len(held) == AT_ONCE:
                        yield flushed(*held.pop(next(iter(held))))
                    held[row["q"]] = begun(row)
                _, queries, heaps = held[row["q"]]
                s = Shard({c: row[f"s_{c}"] for c in SHARD})
                for slot, (terms, weights) in enumerate(queries):
                    search(s, terms, weights, heaps, slot)
        for made in held.values():
            yield flushed(*made)

    return run


def searched(index: DataFrame, of: Totals, queries: DataFrame, top: int = TOP) -> DataFrame:
    """The best `top` documents of every query: queries' columns but text, rank, doc_id and score.

    queries is a written table with a `uid` that no other row has. Queries without a term, and those that no
    document answers with a score above 0, have no rows. Of equal scores the smallest doc_id comes first, a null one last.
    """
    spark = queries.sparkSession
    n_queries, n_shards = queries.count(), index.count()
    n_blocks = max(1, -(-n_queries // ITEMS_A_BLOCK))
    n_groups = max(1, -(-n_shards // SHARDS_A_GROUP), min(n_shards, spark.sparkContext.defaultParallelism))
    dealt = queries.select("uid", "text", F.pmod(F.xxhash64("uid"), F.lit(n_blocks)).cast("int").alias("q"))
    blocks = written(dealt.groupBy("q").applyInArrow(_query_blocks, QUERIES), "queries")
    asked = _cells(blocks, index, n_blocks, n_groups).select("q", "terms", "s_terms", "s_df").mapInArrow(_frequencies, "q int, term long, df long")
    df = F.array_sort(F.collect_list(F.struct("term", "df")))
    known = asked.groupBy("q", "term").agg(F.sum("df").alias("df")).groupBy("q").agg(df.alias("known"))
    known = known.select("q", F.col("known.term").alias("df_terms"), F.col("known.df").alias("df"))
    cells = _cells(blocks.join(known, "q"), index, n_blocks, n_groups)
    best = cells.mapInArrow(_searched(of, top), "uid long, doc_id long, score long")
    order = Window.partitionBy("uid").orderBy(F.desc("score"), "doc_id")
    best = written(best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top), "ranked", drop=(blocks,))
    doc_id = F.when(F.col("doc_id") != LAST_ID, F.col("doc_id")).alias("doc_id")
    return queries.drop("text").join(best.select("uid", "rank", doc_id, "score"), "uid")


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the `top` documents of (doc_id integer, text) for each row of (item_id, text).

    A null or empty text has no terms, and neither answers nor asks anything. Rows that repeat a doc_id are documents of their
    own, and rows that repeat an item_id are queries of their own. Other columns are ignored. Where either table is empty, the
    result is.
    """
    bounded(docs.sparkSession)
    of = totals(docs)
    queries = written(items.select("item_id", "text").withColumn("uid", F.monotonically_increasing_id()), "items")
    index = indexed(docs, of)
    out = searched(index, of, queries, top).select("item_id", "rank", "doc_id", "score")
    dropped(index)
    return out


def op13_lexical_search(spark, sf_dir):
    return ranked(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


SQL = """WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents),
o AS (SELECT count(*)::BIGINT AS n, sum(len(terms))::BIGINT AS l FROM d WHERE len(terms) > 0),
p AS (SELECT doc_id, 75 + (25 * any_value(len(terms)) * (SELECT n FROM o)) // (SELECT l FROM o) AS m, term, count(*) AS tf FROM (SELECT doc_id, terms, unnest(terms) AS term FROM d) GROUP BY doc_id, term),
f AS (SELECT term, floor(1000 * ln((2 * (SELECT n FROM o) + 2) / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p GROUP BY term),
q AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score FROM q JOIN f USING (term) JOIN p USING (term) GROUP BY 1, 2)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM s WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 20"""
