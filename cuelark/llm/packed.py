"""Keys that occur in many documents, resolved over the whole corpus in packed form.

A sub-batch of documents sends each bucket of keys one row with arrays of its entries (key, values, document,
place). A bucket decides about all entries of its keys; what it decides goes back by sub-batch and becomes one row
per document. Per entry this moves its values and about ten bytes, and no row per entry is ever made.

A key costs a bucket what the sub-batches send of it, so extractors first settle within the sub-batch what
they can: of many equal entries one is sent.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import small

BUCKETS, DOCS_A_BUCKET = 64, 4000
NOTHING, HIT, OPEN = 0, 1, 2
SENT = "bucket int, sub long, key binary, more binary, doc binary, place binary, state binary"
_SCHEMA = pa.schema([("bucket", pa.int32()), ("sub", pa.int64()), *[(c, pa.binary()) for c in ("key", "more", "doc", "place", "state")]])


class Entries(NamedTuple):
    """Entries of a sub-batch: doc is the row in it; state HIT for those that are settled already and not sent."""

    key: np.ndarray  # uint64
    more: np.ndarray  # uint64, or nothing at all
    doc: np.ndarray
    place: np.ndarray
    state: np.ndarray


def planes(x: np.ndarray) -> bytes:
    """uint32 as low halves, then high halves, which are mostly equal and compress well."""
    return np.ascontiguousarray(x.astype("<u4").view("<u2").reshape(-1, 2).T).tobytes()


def unplaned(x: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(x, "<u2").reshape(2, -1).T).view("<u4").ravel()


def buckets_for(n_docs: int) -> int:
    return max(BUCKETS, n_docs // DOCS_A_BUCKET)


def _sent(extract: Callable[[list[bytes], np.ndarray], Entries], buckets: int, rows: int, size: int, narrow: type):
    def run(batches):
        for batch in small(batches, rows, size):
            uid = batch.column("uid").to_numpy(zero_copy_only=False).astype(np.int64)
            e = extract([x or b"" for x in batch.column("text").cast(pa.binary()).to_pylist()], uid)
            sub, out = int(uid[0]), []
            settled = e.state != NOTHING
            if settled.any():
                out.append((-1 - sub % buckets, b"", b"", uid[e.doc[settled]].tobytes(), e.place[settled].astype(np.int32).tobytes(), e.state[settled].astype(np.int8).tobytes()))
            key, doc, place = (x[~settled] for x in (e.key, e.doc, e.place))
            more = e.more[~settled] if len(e.more) else e.more
            bucket = (key % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            low = uid.min()
            off = (uid[doc] - low)[order]
            # the first eight bytes of doc are the smallest uid; the others are offsets from it
            kind = np.uint32 if len(uid) and uid.max() - low < 2**32 else np.int64
            head = np.array([low], np.int64).tobytes()
            edge = np.searchsorted(bucket[order], np.arange(buckets + 1))
            k, m, p = (key[order] // np.uint64(buckets)).astype(narrow), more[order] if len(more) else more, place[order].astype(np.int32)
            for b in np.flatnonzero(np.diff(edge)):
                s = slice(edge[b], edge[b + 1])
                out.append((int(b), k[s].tobytes(), m[s].tobytes(), head + (planes(off[s]) if kind is np.uint32 else off[s].tobytes()), planes(p[s]), b""))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.int32()), pa.array([sub] * len(out), pa.int64()), *[pa.array([x[i] for x in out], pa.binary()) for i in range(1, 6)]],
                schema=_SCHEMA,
            )

    return run


def _decided(decide: Callable[..., np.ndarray], narrow: type):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        if rows.bucket.iloc[0] < 0:
            return rows[["sub", "doc", "place", "state"]]
        key = np.concatenate([np.frombuffer(x, narrow) for x in rows.key])
        more = np.concatenate([np.frombuffer(x, np.uint64) for x in rows.more])
        place = np.concatenate([unplaned(x) for x in rows.place]).astype(np.int32)
        sizes = np.array([len(x) // 4 for x in rows.place])
        doc = []
        for x, n in zip(rows.doc, sizes, strict=True):
            off = unplaned(x[8:]) if len(x) == 8 + 4 * n else np.frombuffer(x[8:], np.int64)
            doc.append(np.frombuffer(x[:8], np.int64)[0] + off.astype(np.int64))
        doc = np.concatenate(doc)
        state = decide(key, more, doc, place).astype(np.int8)
        out, ends = [], np.concatenate([[0], np.cumsum(sizes)])
        for sub, a, b in zip(rows["sub"], ends[:-1], ends[1:], strict=True):
            s = np.flatnonzero(state[a:b]) + a
            if len(s):
                out.append((sub, doc[s].tobytes(), place[s].tobytes(), state[s].tobytes()))
        return pd.DataFrame(out, columns=["sub", "doc", "place", "state"])

    return run


def _by_document(rows: pd.DataFrame) -> pd.DataFrame:
    doc = np.concatenate([np.frombuffer(x, np.int64) for x in rows.doc])
    place = np.concatenate([np.frombuffer(x, np.int32) for x in rows.place])
    state = np.concatenate([np.frombuffer(x, np.int8) for x in rows.state])
    order = np.lexsort((place, doc))
    doc, place, state = doc[order], place[order], state[order]
    edge = np.concatenate([[0], np.flatnonzero(np.diff(doc)) + 1, [len(doc)]])
    out = []
    for a, b in zip(edge[:-1], edge[1:], strict=True):
        p, s = place[a:b], state[a:b]
        out.append((doc[a], p[s == HIT].tobytes(), p[s == OPEN].tobytes()))
    return pd.DataFrame(out, columns=["uid", "hits", "opens"])


def resolved(texts: DataFrame, extract, decide, n_docs: int, rows: int = 2048, size: int = 2**22, narrow: type = np.uint64) -> DataFrame:
    """(uid, text) to (uid, hits, opens): the places that are HIT or OPEN, as sorted int32; documents without any are left out.

    decide(key, more, uid, place) gets all unsettled entries of some keys. Keys are sent as `narrow`, so that with
    32 bits a few different ones meet (a bucket holds the keys of DOCS_A_BUCKET documents at every size).
    """
    sent = texts.select("uid", "text").mapInArrow(_sent(extract, buckets_for(n_docs), rows, size, narrow), SENT)
    back = sent.groupBy("bucket").applyInPandas(_decided(decide, narrow), "sub long, doc binary, place binary, state binary")
    return back.groupBy("sub").applyInPandas(_by_document, "uid long, hits binary, opens binary")
