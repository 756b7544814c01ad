"""Suffix-array dedup: each byte that lies in a string of LENGTH bytes which also starts in a document with a smaller
doc_id is removed.

A suffix array of every position would move every byte LENGTH times, so suffixes are thinned out first:

1. Anchors: of the GRAM-byte strings in any LENGTH-byte window, those with the smallest hash. Windows with equal
   bytes have equal anchors, so a repeated window repeats an anchor. `packed` looks all anchors up by their gram's
   hash; those whose gram stands in one document alone are out.
2. What decides is the order of the others' suffixes: LENGTH bytes from the anchor on and, to tell windows apart that begin
   before it, the REACH bytes before it, read backwards. They are range-partitioned at sampled splitters by all of
   these bytes and the document, so that a bucket has about A_BUCKET of them however often a string occurs. Each bucket sorts its suffixes
   locally by multikey quicksort on eight-byte symbols. Of equal neighbours all but those of the smallest document are
   covered as a whole. Of what is left, windows around one gram are sorted again at each distance from it, and a
   window is covered if it is equal to one of a smaller document.
3. A gram at either end of a bucket may go on in the next one. Those of its windows that the bucket leaves, each of
   the smallest document there, are compared across the buckets: an aggregation finds each window's smallest document.

The text is dealt once, into a bucketed table, and joined there with the places of its anchors and with its spans.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import CLEANED, documents, dropped, keyed, shared_folder, small, written
from .near_dedup import mixed_bits
from .packed import OPEN, Entries, resolved

LENGTH, GRAM = 50, 24
REACH = LENGTH - GRAM  # bytes before an anchor that a window can hold
A_BUCKET, FEW = 100_000, 512
WIDTH = LENGTH + 1 + REACH + 1  # of a suffix's record: bytes from the anchor on, how many, bytes before it backwards, how many
BUCKET_BYTES, BUCKETS = 2**25, 100_000

_r = np.random.default_rng(71)
_BYTE = _r.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def sliding(x: np.ndarray, n: int, op) -> np.ndarray:
    """op over every n neighbours, by doubling."""
    size, out = 1, x
    while size * 2 <= n:
        out = op(out[:-size], out[size:])
        size *= 2
    rest = n - size
    return op(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gram hash, document, place) of every anchor."""
    sizes = np.array([len(t) for t in texts], np.int64)
    b = np.frombuffer(b"".join(texts), np.uint8)
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(b) < LENGTH:
        return none
    power = np.full(len(b) + 1, _P, np.uint64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_BYTE[b] * power[:-1], out=total[1:])
    back = np.full(len(b) + 1, _BACK, np.uint64)
    back[0] = 1
    back = np.multiply.accumulate(back)
    h = mixed_bits((total[GRAM:] - total[:-GRAM]) * back[: len(b) - GRAM + 1])
    low = sliding(h, REACH + 1, np.minimum)  # low[p]: of the window that starts at p
    ends = np.cumsum(sizes)
    crossing = np.zeros(len(low), bool)
    for k in range(1, LENGTH):
        at = ends[:-1] - k
        crossing[at[(at >= 0) & (at < len(crossing))]] = True
    low[crossing] = 0
    padded = np.concatenate([np.zeros(REACH, np.uint64), low, np.zeros(REACH, np.uint64)])
    place = np.flatnonzero(sliding(padded, REACH + 1, np.maximum) == h)
    doc = np.searchsorted(ends, place, "right")
    inside = place + GRAM <= ends[doc]
    place, doc = place[inside], doc[inside]
    return h[place], doc, place - (ends - sizes)[doc]


def _spread(keys: np.ndarray, uid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order of the keys; for each entry whether its key stands in several documents, and whether it is the first or last
    entry of its key in the order of documents."""
    order = np.lexsort((uid, keys))
    new = np.ones(len(order), bool)
    new[1:] = keys[order[1:]] != keys[order[:-1]]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(order)) - 1
    several, edge = np.zeros(len(order), bool), np.zeros(len(order), bool)
    if len(order):
        several[order] = np.repeat(uid[order[first]] != uid[order[last]], last - first + 1)
        edge[order[first]] = edge[order[last]] = True
    return order, several, edge


def _entries(texts: list[bytes], uid: np.ndarray) -> Entries:
    """Of a gram that stands in several documents of the sub-batch two entries are sent, and the others are settled."""
    gram, doc, place = anchors(texts)
    _, several, edge = _spread(gram, uid[doc])
    return Entries(gram, np.zeros(0, np.uint64), doc, place, np.where(several & ~edge, OPEN, 0))


def _decide(key, more, uid, place) -> np.ndarray:
    return np.where(_spread(key, uid)[1], OPEN, 0)


def multikey_order(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows of symbols, and for each row in it whether it differs from the one before.

    Multikey quicksort: a range is parted by one symbol into less, equal and greater; the equal ones go on
    with the next symbol. Ranges of FEW rows are sorted at once."""
    n, width = words.shape
    order, new = np.arange(n), np.zeros(n + 1, bool)
    new[0] = True
    todo = [(0, n, 0)] if n > 1 else []
    while todo:
        a, z, depth = todo.pop()
        rows = order[a:z]
        if z - a <= FEW:
            part = words[rows, depth:]
            own = np.lexsort(part.T[::-1])
            order[a:z] = rows[own]
            new[a + 1 : z] = (part[own[1:]] != part[own[:-1]]).any(1)
            continue
        x = words[rows, depth]
        pivot = np.sort(x[:: max(1, len(x) // 9)])[min(len(x), 9) // 2]
        less, more = x < pivot, x > pivot
        order[a:z] = np.concatenate([rows[less], rows[~(less | more)], rows[more]])
        b, c = a + int(less.sum()), z - int(more.sum())
        new[b] = new[c] = True
        todo += [(i, j, d) for i, j, d in ((a, b, depth), (c, z, depth), (b, c, depth + 1)) if j - i > 1 and d < width]
    return order, new[:n]


def _symbols(raw: np.ndarray) -> np.ndarray:
    """Rows of bytes as rows of eight-byte symbols."""
    out = np.zeros((len(raw), -(-raw.shape[1] // 8) * 8), np.uint8)
    out[:, : raw.shape[1]] = raw
    return out.view(">u8").astype(np.uint64)


def records(texts: list[bytes], doc: np.ndarray, place: np.ndarray) -> np.ndarray:
    """(len(doc), WIDTH): the suffix of each anchor with what stands before it."""
    sizes = np.array([len(t) for t in texts], np.int64)
    raw = np.frombuffer(b"".join([bytes(REACH), *texts, bytes(LENGTH)]), np.uint8)
    at = (REACH + np.cumsum(sizes) - sizes)[doc] + place
    n_right, n_left = np.minimum(sizes[doc] - place, LENGTH), np.minimum(place, REACH)
    out = np.zeros((len(doc), WIDTH), np.uint8)
    j, i = np.arange(LENGTH), np.arange(REACH)
    out[:, :LENGTH] = raw[at[:, None] + j] * (j < n_right[:, None])
    out[:, LENGTH] = n_right
    out[:, LENGTH + 1 : -1] = raw[at[:, None] - 1 - i] * (i < n_left[:, None])
    out[:, -1] = n_left
    return out


def _open_suffixes(batches):
    """(uid, text, opens) to (suffix, uid, place) of every open anchor."""
    for batch in small(batches):
        texts = [x or b"" for x in batch.column("text").to_pylist()]
        places = [np.frombuffer(x, np.int32) for x in batch.column("opens").to_pylist()]
        doc = np.repeat(np.arange(len(texts)), [len(x) for x in places])
        place, uid = np.concatenate([*places, np.zeros(0, np.int32)]).astype(np.int64), batch.column("uid").to_numpy(zero_copy_only=False)
        for k in range(0, len(doc), 16384):
            d, p = doc[k : k + 16384], place[k : k + 16384]
            offsets = np.arange(len(d) + 1, dtype=np.int32) * WIDTH
            suffix = pa.Array.from_buffers(pa.binary(), len(d), [None, pa.py_buffer(offsets), pa.py_buffer(records(texts, d, p))])
            yield pa.RecordBatch.from_arrays([suffix, pa.array(uid[d]), pa.array(p.astype(np.int32))], ["suffix", "uid", "place"])


_SPANS = "uid long, start int, end int, window binary"


def _spans(uid, start, end, window=None):
    for k in range(0, len(uid), 16384):
        s = slice(k, k + 16384)
        w = pa.nulls(len(uid[s]), pa.binary()) if window is None else pa.array(window[s], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(uid[s], pa.int64()), pa.array(start[s].astype(np.int32)), pa.array(end[s].astype(np.int32)), w], ["uid", "start", "end", "window"])


def _window(suffix: np.ndarray, k: int) -> np.ndarray:
    """The LENGTH bytes that begin k bytes before the anchor."""
    return np.concatenate([suffix[:, LENGTH + 1 : LENGTH + 1 + k][:, ::-1], suffix[:, : LENGTH - k]], 1)


def _windows_of(suffix: np.ndarray, k: int) -> np.ndarray:
    """Which rows have such a window."""
    return np.flatnonzero((suffix[:, -1] >= k) & (suffix[:, LENGTH] >= LENGTH - k))


def covered_windows(suffix: np.ndarray, uid: np.ndarray) -> np.ndarray:
    """(row, k): whether the window that starts k bytes before the row's gram is equal to one of a smaller uid, k being as far from theirs."""
    out = np.zeros((len(uid), REACH + 1), bool)
    for k in range(REACH + 1):
        rows = _windows_of(suffix, k)
        if len(rows):
            order, new = multikey_order(_symbols(_window(suffix[rows], k)))
            first = np.flatnonzero(new)
            least = np.minimum.reduceat(uid[rows][order], first)
            out[rows[order], k] = uid[rows][order] > np.repeat(least, np.diff(np.append(first, len(rows))))
    return out


def _compared(batches):
    """The suffixes of a bucket to the spans that they cover, and to the windows that are compared across buckets."""
    got = [(np.frombuffer(b"".join(b.column("suffix").to_pylist()), np.uint8).reshape(-1, WIDTH), b.column("uid").to_numpy(), b.column("place").to_numpy()) for b in batches if len(b)]
    if not got:
        return
    suffix, uid, place = (np.concatenate(x) for x in zip(*got, strict=True))
    order, new = multikey_order(_symbols(suffix))
    suffix, uid, place = suffix[order], uid[order], place[order].astype(np.int64)
    first = np.flatnonzero(new)  # of each context
    of = np.cumsum(new) - 1
    least = np.minimum.reduceat(uid, first)
    whole = uid > least[of]
    yield from _spans(uid[whole], place[whole] - suffix[whole, -1], place[whole] + suffix[whole, LENGTH])
    context = suffix[first]
    lead = np.cumsum(np.append(True, (context[1:, :GRAM] != context[:-1, :GRAM]).any(1))) - 1
    edge = (lead == 0) | (lead == lead[-1])
    inner = np.flatnonzero(np.bincount(lead)[lead] > 1)
    hit = np.zeros((len(first), REACH + 3), np.int8)
    hit[inner, 1:-1] = covered_windows(context[inner], least[inner])
    turn = np.diff(hit, axis=1)
    of_context, start = np.nonzero(turn == 1)  # runs of k from start to stop - 1
    _, stop = np.nonzero(turn == -1)
    mine = np.flatnonzero(~whole)  # every place of a context's smallest document
    runs = np.bincount(of_context, minlength=len(first))
    row = np.repeat(mine, runs[of[mine]])
    run = np.arange(len(row)) - np.repeat(np.cumsum(runs[of[mine]]) - runs[of[mine]], runs[of[mine]]) + (np.cumsum(runs) - runs)[of[row]]
    yield from _spans(uid[row], place[row] - stop[run] + 1, place[row] - start[run] + LENGTH)
    mine = mine[edge[of[mine]]]
    for a in range(0, len(mine), 4096):
        rows = mine[a : a + 4096]
        for k in range(REACH + 1):
            some = rows[_windows_of(suffix[rows], k)]
            some = some[hit[of[some], k + 1] == 0]
            yield from _spans(uid[some], place[some] - k, place[some] - k + LENGTH, [x.tobytes() for x in _window(suffix[some], k)])


def removed_spans(spans: list) -> list[tuple[int, int]]:
    """Maximal runs of spans."""
    out: list[list[int]] = []
    for a, z in sorted((s["start"], s["end"]) for s in spans or []):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], z)
        else:
            out.append([a, z])
    return [tuple(x) for x in out]


_CUT = "uid long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:int,end:int>>"


def _cut(batches):
    for batch in small(batches):
        out = []
        for uid, text, spans in zip(*(batch.column(c).to_pylist() for c in ("uid", "text", "spans")), strict=True):
            runs, at, rest = removed_spans(spans), 0, hashlib.sha256()
            for a, z in runs:
                rest.update(text[at:a])
                at = z
            rest.update(text[at:])
            out.append((uid, len(text), sum(z - a for a, z in runs), len(runs), rest.hexdigest(), [{"start": a, "end": z} for a, z in runs]))
        cols = list(zip(*out, strict=True)) or [[]] * 6
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], [c.split()[0] for c in _CUT.split(", ")])


def _dealt_texts(texts: DataFrame, n_bytes: int) -> tuple[DataFrame, str]:
    """(uid, text) in a table bucketed by uid, so that joins on uid don't move texts again, and the table's name."""
    n = int(min(BUCKETS, max(8, n_bytes // BUCKET_BYTES)))
    spark, name = texts.sparkSession, f"suffix_texts_{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANED)
    spark.conf.set(CLEANED, "true")
    try:
        texts.repartition(n, "uid").write.option("compression", "zstd").bucketBy(n, "uid").option("path", f"{shared_folder(spark)}/tables/{name}").saveAsTable(name)
    finally:
        spark.conf.set(CLEANED, before)
    table = spark.table(name)
    table.written_to = f"{shared_folder(spark)}/tables/{name}"
    return table, name


def without_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (start and end of each removed run).

    Texts are UTF-8 bytes, null is empty; texts of under LENGTH bytes keep all. Of rows with one doc_id, one counts
    as smaller than the other; null doc_ids are the smallest. Other columns are ignored; an empty table
    gives an empty result.
    """
    rows = keyed(docs, "text").select("doc_id", F.col("uid").cast("long").alias("uid"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("docs")).first()
    texts, name = _dealt_texts(rows.select("uid", "text"), size["n"])
    long = texts.where(F.octet_length("text") >= LENGTH)
    found = written(resolved(long, _entries, _decide, size["docs"], size=2**21, narrow=np.uint32).select("uid", "opens"), "anchors")
    opened = found.agg(F.coalesce(F.sum(F.octet_length("opens")), F.lit(0)).alias("n")).first()["n"] // 4
    suffixes = texts.join(found.hint("merge"), "uid").select("uid", "text", "opens").mapInArrow(_open_suffixes, "suffix binary, uid long, place int")
    buckets = suffixes.repartitionByRange(opened // A_BUCKET + 1, "suffix", "uid")
    spans = written(buckets.mapInArrow(_compared, _SPANS), "spans", drop=(found,))
    across = spans.where("window IS NOT NULL")
    least = F.min("uid").over(Window.partitionBy("window"))  # a bucket sends a window for one document at most
    more = across.withColumn("least", least).where("uid > least").select("uid", "start", "end")
    own = spans.where("window IS NULL").select("uid", "start", "end").unionByName(more)
    own = own.groupBy("uid").agg(F.collect_list(F.struct("start", "end")).alias("spans"))  # a few for each anchor of a text at most
    cut = written(texts.join(own.hint("merge"), "uid", "left").select("uid", "text", "spans").mapInArrow(_cut, _CUT), "cut", drop=(spans,))
    texts.sparkSession.sql(f"DROP TABLE {name}")
    dropped(texts)
    return rows.select("doc_id", "uid").join(cut, "uid").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")


def op6_suffix_array_dedup(spark, sf_dir):
    return without_repeats(documents(spark, sf_dir)).drop("spans")
