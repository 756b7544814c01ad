"""Near-dedup with SetSketch registers.

Each document is the set of its word shingles, as 64-bit hashes. A register is the smallest of the set's values
under one hash function, read as an exponential variable of rate A and truncated to a power of B: registers of a
union are maxima of registers, and two sets agree in one with a chance close to their Jaccard similarity.

1. Documents with equal sets form one class, told by a 128-bit fingerprint and the size; classes go on as their
   smallest member.
2. BANDS bands of ROWS registers put classes into buckets. At the stated similarity a pair shares none
   with a chance of (1 - similarity**ROWS)**BANDS, 8e-11 at 0.85 and 3e-8 at 0.8.
3. A bucket's members are not paired with each other; links are sought in the order of their likely use, and only
   between components that are still apart. Each document is paired with one hub, the most central member of its
   buckets (the text that copies were made from); then with its NEAR neighbours in the order of the registers
   behind the band, in two orders, of which likely ones are emitted: all in buckets of up to NEAR + 1 members, which stay in
   one task and are so compared in full, and one for each member of a larger bucket. Larger buckets that
   then still hold several components go through a set-similarity join, so that no link is left to these orders: two
   sets that reach the similarity share one of the first shingles of both, taken in one order for all (rare ones
   first), so only documents that meet there are paired, as far as sizes, places, registers and parities allow: a
   set has ODD bits, each the parity of how many of its shingles fall there, so that two sets' bits differ as the shingles
   that only one of them has do. That tells sets a few hundredths below the limit from sets at it. Members of the largest
   component of each of their buckets (hosts) are compared with the others (guests) alone.
4. A pair's similarity is estimated by maximum likelihood from all registers jointly (greater, less, equal) and
   the sizes; pairs go that lie so far below the limit that one at the limit does with a chance of 1e-6 at most. The others are verified on
   their full sets.
5. Components of the verified links come from label propagation with pointer jumping.

Before the join, a bucket of k members makes k pairs at most in each order. A shingle that is among the first ones of
many is dealt over pairs of blocks of about BLOCK documents. Hot buckets are counted with map-side combining, joined
from written tables, whose hot keys adaptive execution splits, and ordered by range partitioning.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, dropped, keyed, small, written

BANDS, ROWS = 32, 4
A, B, Q = 20.0, 1.001, 2**16 - 2
NEAR = 16
SLOTS, BLOCK = 2**20, 1024  # the join: counters of shingles, documents of a block
ODD = 1024  # bits of parity
AFTER = 8  # registers behind a band that order its buckets
AT_ONCE, BYTES_AT_ONCE = 1024, 2**22
WORDS, SIMILARITY = 5, 80  # words of a shingle, per cent

_M = np.uint64(0x9E3779B97F4A7C15)
_r = np.random.default_rng(20240229)
_TIMES = _r.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _r.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2)
_PLACE = _r.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed_bits(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """For each text its sorted distinct shingle hashes: runs of `words` lower-cased words, or the whole sequence if shorter."""
    rows = [t.lower().split() for t in texts]
    lens = np.array([len(x) for x in rows], np.int64)
    flat = np.empty(lens.sum(), object)
    flat[:] = [w.decode("utf-8", "surrogateescape") for x in rows for w in x]
    code, known = pd.factorize(flat)
    h = pd.util.hash_array(np.asarray(known, object), categorize=False)[code] if len(flat) else np.zeros(0, np.uint64)
    n = max(len(h) - words + 1, 0)
    run = np.zeros(n, np.uint64)
    for k in range(words):
        run += h[k : k + n] * _PLACE[k % 64]
    run = mixed_bits(run + np.uint64(words))
    out, at = [], 0
    for size in lens:
        if size >= words:
            out.append(np.unique(run[at : at + size - words + 1]))
        elif size:
            out.append(mixed_bits((h[at : at + size] * _PLACE[:size]).sum(keepdims=True) + np.uint64(size)))
        else:
            out.append(np.zeros(0, np.uint64))
        at += size
    return out


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """(len(sets), BANDS * ROWS) registers of non-empty sets; mergeable: those of a union are the maxima."""
    out = np.zeros((len(sets), len(_TIMES)), np.uint16)
    sizes = np.array([len(s) for s in sets])
    done = 0
    while done < len(sets):
        upto = done + max(1, int(np.searchsorted(np.cumsum(sizes[done:]), 32768)))
        h = np.concatenate(sets[done:upto])
        at = np.concatenate([[0], np.cumsum(sizes[done:upto])[:-1]])
        low = np.empty((upto - done, len(_TIMES)), np.uint64)
        buffer = np.empty_like(h)
        for i in range(len(_TIMES)):
            np.multiply(h, _TIMES[i], out=buffer)
            buffer += _PLUS[i]
            low[:, i] = np.minimum.reduceat(buffer, at)
        x = -np.log1p(-np.minimum((low.astype(np.float64) + 0.5) / 2.0**64, 1 - 2.0**-53)) / A
        out[done:upto] = np.clip(np.floor(1 - np.log(x) / np.log(B)), 0, Q + 1).astype(np.uint16)
        done = upto
    return out


def estimate(ka: np.ndarray, kb: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """The Jaccard similarity of each pair that makes the registers' joint order most likely."""
    greater, less = (ka > kb).sum(1), (ka < kb).sum(1)
    equal = ka.shape[1] - greater - less
    u, v = na / (na + nb), nb / (na + nb)
    p = lambda x: -np.log1p(-np.clip(x, 1e-12, 1) * (B - 1) / B) / np.log(B)
    j = np.linspace(0, 1, 101)[None, :] * np.minimum(u / v, v / u)[:, None]
    above, below = p(u[:, None] - v[:, None] * j), p(v[:, None] - u[:, None] * j)
    fit = greater[:, None] * np.log(above) + less[:, None] * np.log(below) + equal[:, None] * np.log(np.maximum(1 - above - below, 1e-12))
    return j[np.arange(len(j)), fit.argmax(1)]


def _sketched(words: int):
    def run(batches):
        for batch in small(batches, AT_ONCE, BYTES_AT_ONCE):
            sets = shingle_sets([x or b"" for x in batch.column("text").cast(pa.binary()).to_pylist()], words)
            full = [i for i, s in enumerate(sets) if len(s)]
            reg = np.zeros((len(sets), BANDS * ROWS), np.uint16)
            if full:
                reg[full] = registers([sets[i] for i in full])
            f1 = np.array([mixed_bits(s).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
            f2 = np.array([np.bitwise_xor.reduce(mixed_bits(s ^ _M)) if len(s) else 0 for s in sets], np.uint64).view(np.int64)
            n = np.array([len(s) for s in sets], np.int64)
            made = [pa.array(n), pa.array(f1), pa.array(f2), pa.array([r.tobytes() for r in reg], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("uid"), *made], ["uid", "n_shingles", "f1", "f2", "reg"])

    return run


def _banded(batches):
    """(uid, reg) to an entry in each band: its bucket, and the registers that order it there."""
    for batch in small(batches, 4096, BYTES_AT_ONCE, "reg"):
        uid = batch.column("uid").to_numpy(zero_copy_only=False)
        reg = np.frombuffer(b"".join(batch.column("reg").to_pylist()), np.uint16).reshape(-1, BANDS * ROWS)
        for b in range(BANDS):
            own = np.roll(reg, -b * ROWS, axis=1)
            key = np.ascontiguousarray(own[:, :ROWS]).view(np.uint64).ravel().view(np.int64)
            after = np.ascontiguousarray(own[:, ROWS : ROWS + AFTER]).astype(">u2").view(f"S{2 * AFTER}").ravel()
            yield pa.RecordBatch.from_arrays(
                [pa.array(uid), pa.array(np.full(len(uid), b, np.int32)), pa.array(key), pa.array([bytes(x).ljust(2 * AFTER, b"\0") for x in after], pa.binary())],
                ["uid", "band", "key", "after"],
            )


def _neighbours(similarity: int):
    """Entries in the order of band, bucket and registers to likely pairs of entries of one bucket, at most NEAR apart
    and of different components: all such pairs of a small bucket, of a crowd the nearest one before each entry."""
    columns = ("band", "key", "uid", "label", "n_shingles", "n")

    def run(batches):
        tail = None
        for batch in small(batches, 4096, BYTES_AT_ONCE, "reg"):
            now = [batch.column(c).to_numpy(zero_copy_only=False) for c in columns]
            now.append(np.frombuffer(b"".join(batch.column("reg").to_pylist()), np.uint16).reshape(-1, BANDS * ROWS))
            band, key, uid, label, n, members, reg = now if tail is None else [np.concatenate(x) for x in zip(tail, now, strict=True)]
            fresh, pairs = len(band) - len(batch), [np.zeros((2, 0), np.int64)]
            open_ = np.ones(len(band), bool)
            for d in range(1, min(NEAR, len(band) - 1) + 1):
                y = np.arange(max(fresh, d), len(band))
                x = y - d
                at = np.flatnonzero(open_[y] & (band[x] == band[y]) & (key[x] == key[y]) & (label[x] != label[y]))
                for k in range(0, len(at), 1024):
                    i, j = x[at[k : k + 1024]], y[at[k : k + 1024]]
                    good = estimate(reg[i], reg[j], n[i].astype(float), n[j].astype(float)) >= least_likely(similarity)
                    pairs.append(np.stack([uid[i[good]], uid[j[good]]]))
                    open_[j[good]] = members[j[good]] <= NEAR + 1
            tail = [c[-NEAR:] for c in (band, key, uid, label, n, members, reg)]
            both = np.unique(np.sort(np.concatenate(pairs, axis=1), axis=0), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(both[0], pa.int64()), pa.array(both[1], pa.int64())], ["a", "b"])

    return run


def least_likely(similarity: int) -> float:
    """The estimate below which a pair is dropped: so low that of pairs of one size at the limit, by the binomial tail of
    equal registers, a share of 1e-6 at most lies below; the estimate's grid is allowed for."""
    s, n, tail, equal = similarity / 100, BANDS * ROWS, 0.0, -1
    while equal < n and tail + math.comb(n, equal + 1) * s ** (equal + 1) * (1 - s) ** (n - equal - 1) <= 1e-6:
        equal += 1
        tail += math.comb(n, equal) * s**equal * (1 - s) ** (n - equal)
    return (equal + 1) / n - 0.01


def _set_of(words: int):
    def run(batches):
        for batch in small(batches, AT_ONCE, BYTES_AT_ONCE):
            texts = [x or b"" for x in batch.column("text").cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("uid"), pa.array([s.tobytes() for s in shingle_sets(texts, words)], pa.binary())], ["uid", "shingles"])

    return run


def _slots(shingles: np.ndarray) -> np.ndarray:
    return (shingles % np.uint64(SLOTS)).astype(np.int64)


def _counters(totals: np.ndarray):
    at = np.flatnonzero(totals)
    for k in range(0, len(at), 65536):
        yield pa.RecordBatch.from_arrays([pa.array(at[k : k + 65536]), pa.array(totals[at[k : k + 65536]])], ["slot", "n"])


def _shingle_counters(batches):
    totals = np.zeros(SLOTS, np.int64)
    for batch in small(batches, AT_ONCE, BYTES_AT_ONCE, "shingles"):
        totals += np.bincount(_slots(np.frombuffer(b"".join(batch.column("shingles").to_pylist()), np.uint64)), minlength=SLOTS)
    yield from _counters(totals)


def _table(counters: DataFrame) -> np.ndarray:
    """(slot, n) summed up: SLOTS numbers, whatever the input."""
    got = counters.groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(SLOTS, np.uint32)
    out[got.column("slot").to_numpy()] = got.column("n").to_numpy()
    return out


def _first_shingles(shingles: np.ndarray, often: np.ndarray, similarity: int) -> tuple[np.ndarray, np.ndarray]:
    """Of a set the first shingles, rare ones first, one of which each set that reaches the similarity has among its own
    first ones, and their places; those that no other document has are left out."""
    f = often[_slots(shingles)]
    order = np.lexsort((shingles, f))[: len(shingles) - (similarity * len(shingles) + 99) // 100 + 1]
    place = np.flatnonzero(f[order] > 1)
    return shingles[order[place]], place


def _first_counters(often: np.ndarray, similarity: int):
    def run(batches):
        totals = np.zeros(SLOTS, np.int64)
        for batch in small(batches, AT_ONCE, BYTES_AT_ONCE, "shingles"):
            first = [_first_shingles(np.frombuffer(x, np.uint64), often, similarity)[0] for x in batch.column("shingles").to_pylist()]
            totals += np.bincount(_slots(np.concatenate(first)) if first else [], minlength=SLOTS)
        yield from _counters(totals)

    return run


def parities(shingles: np.ndarray) -> bytes:
    at = (mixed_bits(shingles * _M) % np.uint64(ODD)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=ODD) & 1).astype(bool)).tobytes()


def most_different(both: np.ndarray, similarity: int) -> np.ndarray:
    """How many parities of two sets of together `both` shingles can differ if they reach the similarity: as many as shingles that
    one set alone has, or five deviations over the mean number of odd bits that so many make (a chance below 1e-6)."""
    alone = (both - 2 * -((-similarity * both) // (100 + similarity))).astype(np.float64)
    once, twice = (1 - 2 / ODD) ** alone, (1 - 4 / ODD) ** alone
    mean = ODD / 2 * (1 - once)
    deviation = np.sqrt(np.maximum(ODD / 4 * (1 - twice) + ODD**2 / 4 * (twice - once**2), 0))
    return np.minimum(alone, np.floor(mean + 5 * deviation + 1)).astype(np.int64)


_DEALT = "shingle long, one int, other int, block int, uid long, label long, n long, place int, low binary, odd binary"


def _dealt(often: np.ndarray, guests: np.ndarray, hosts: np.ndarray, similarity: int):
    """A document to an entry for each of its first shingles, or for each pair of blocks where a shingle is hot.

    Blocks of guests come first and meet all blocks; those of hosts, which need not be compared with each other, meet those of guests."""

    def run(batches):
        for batch in small(batches, AT_ONCE, BYTES_AT_ONCE, "shingles"):
            uid, label, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("uid", "label", "n_shingles"))
            guest = batch.column("guest").to_numpy(zero_copy_only=False).astype(bool)
            first = [_first_shingles(np.frombuffer(x, np.uint64), often, similarity) for x in batch.column("shingles").to_pylist()]
            low = [np.frombuffer(x, np.uint8)[::2].tobytes() for x in batch.column("reg").to_pylist()]
            odd = [parities(np.frombuffer(x, np.uint64)) for x in batch.column("shingles").to_pylist()]
            if not first:
                continue
            doc = np.repeat(np.arange(len(first)), [len(s) for s, _ in first])
            shingle, place = (np.concatenate(x) for x in zip(*first, strict=True))
            slot = _slots(shingle)
            g, h = (-(-x[slot].astype(np.int64) // BLOCK) for x in (guests, hosts))
            own = guest[doc]
            blocks = np.maximum(np.where(own, g, h), 1)
            block = (mixed_bits(uid[doc].astype(np.uint64)) % blocks.astype(np.uint64)).astype(np.int64) + np.where(own, 0, g)
            met = np.where(own, g + h, g)  # blocks that it meets, its own among them if it is a guest
            ends = np.cumsum(met)
            for a in range(0, int(ends[-1]) if len(ends) else 0, 16384):
                k = np.arange(a, min(a + 16384, ends[-1]))
                i = np.searchsorted(ends, k, side="right")
                with_, d = k - (ends[i] - met[i]), doc[i]
                made = [np.minimum(block[i], with_), np.maximum(block[i], with_), block[i]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shingle[i].view(np.int64)), *[pa.array(x.astype(np.int32)) for x in made], pa.array(uid[d]), pa.array(label[d]),
                        pa.array(n[d]), pa.array(place[i].astype(np.int32)), *[pa.array([y[x] for x in d], pa.binary()) for y in (low, odd)],
                    ],
                    [x.split()[0] for x in _DEALT.split(", ")],
                )

    return run


def _met(similarity: int):
    """Entries in the order of shingle and blocks to the pairs of different components that may reach the similarity."""
    columns = ("shingle", "one", "other", "block", "uid", "label", "n", "place")

    def run(batches):
        tail = None
        for batch in small(batches, 4096, BYTES_AT_ONCE, "low"):
            now = [batch.column(c).to_numpy(zero_copy_only=False) for c in columns]
            now.append(np.frombuffer(b"".join(batch.column("low").to_pylist()), np.uint8).reshape(-1, BANDS * ROWS))
            now.append(np.frombuffer(b"".join(batch.column("odd").to_pylist()), np.uint64).reshape(-1, ODD // 64))
            rows = now if tail is None else [np.concatenate(x) for x in zip(tail, now, strict=True)]
            shingle, one, other, block, uid, label, n, place, low, odd = rows
            fresh, pairs = len(uid) - len(batch), [np.zeros((2, 0), np.int64)]
            new = np.ones(len(uid), bool)
            new[1:] = (shingle[1:] != shingle[:-1]) | (one[1:] != one[:-1]) | (other[1:] != other[:-1])
            start = np.maximum.accumulate(np.where(new, np.arange(len(uid)), 0))  # where a row's group begins
            y = np.arange(fresh, len(uid))
            d = 0
            while len(y):
                d += 1
                y = y[y - d >= start[y]]
                x = y - d
                shared = -((-similarity * (n[x] + n[y])) // (100 + similarity))
                ok = (label[x] != label[y]) & ((one[y] == other[y]) | (block[x] != block[y]))
                ok &= (100 * np.minimum(n[x], n[y]) >= similarity * np.maximum(n[x], n[y])) & (np.minimum(n[x] - place[x], n[y] - place[y]) >= shared)
                i, j = x[ok], y[ok]
                same = np.bitwise_count(odd[i] ^ odd[j]).sum(1, dtype=np.int64) <= most_different(n[i] + n[j], similarity)
                i, j = i[same], j[same]
                good = (low[i] == low[j]).mean(1) >= least_likely(similarity)
                pairs.append(np.stack([uid[i[good]], uid[j[good]]]))
            tail = [c[start[-1] :] for c in rows] if len(uid) else None
            both = np.unique(np.sort(np.concatenate(pairs, axis=1), axis=0), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(both[0], pa.int64()), pa.array(both[1], pa.int64())], ["a", "b"])

    return run


def joined_by_shingles(rows: DataFrame, similarity: int) -> DataFrame:
    """(uid, label, guest, n_shingles, reg, shingles) to the pairs (a, b) of different labels that may reach the
    similarity and of which one is a guest at least."""
    often = _table(rows.mapInArrow(_shingle_counters, "slot long, n long"))
    guests, hosts = (_table(rows.where(x).mapInArrow(_first_counters(often, similarity), "slot long, n long")) for x in ("guest", "NOT guest"))
    groups = ["shingle", "one", "other"]
    dealt = rows.mapInArrow(_dealt(often, guests, hosts, similarity), _DEALT).repartition(*groups).sortWithinPartitions(*groups)
    return dealt.mapInArrow(_met(similarity), "a long, b long").distinct()


def _likely(similarity: int):
    low = least_likely(similarity)

    def run(batches):
        for batch in batches:
            reg = [np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, BANDS * ROWS) for c in ("reg_a", "reg_b")]
            n = [batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("n_a", "n_b")]
            good = np.zeros(len(batch), bool)
            for i in range(0, len(batch), 1024):
                s = slice(i, i + 1024)
                good[s] = estimate(reg[0][s], reg[1][s], n[0][s], n[1][s]) >= low
            yield batch.select(["a", "b"]).filter(pa.array(good))

    return run


def _linked(similarity: int):
    def run(batches):
        for batch in small(batches, AT_ONCE, BYTES_AT_ONCE, "shingles_a"):
            good = []
            for x, y in zip(batch.column("shingles_a").to_pylist(), batch.column("shingles_b").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= similarity * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def components(links: DataFrame, name: str = "labels") -> DataFrame:
    """(a, b) links to (uid, label): for each end of a link the smallest number its component holds."""
    both = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    label = written(both.groupBy(F.col("a").alias("uid")).agg(F.least(F.min("b"), F.col("uid")).alias("label")), name)
    while True:
        near = both.join(label.select(F.col("uid").alias("b"), "label"), "b").groupBy(F.col("a").alias("uid")).agg(F.min("label").alias("near"))
        step = label.join(near, "uid").select("uid", F.least("label", "near").alias("to"), F.col("label").alias("was"))
        up = label.select(F.col("uid").alias("to"), F.col("label").alias("up"))
        label = written(step.join(up, "to").select("uid", F.least("to", "up").alias("label"), "was"), name, drop=(label,))
        if label.where("label <> was").isEmpty():
            dropped(both)
            return label


def _labelled(rows: DataFrame, label: DataFrame) -> DataFrame:
    """rows (uid, ...) with the label of their component; without links it is uid itself."""
    return rows.join(label, "uid", "left").withColumn("label", F.coalesce("label", "uid"))


def classes(rows: DataFrame, words: int, similarity: int) -> DataFrame:
    """(doc_id, uid, text) to (doc_id, uid, n_shingles, label): equal labels are one component."""
    kinds = "uid long, n_shingles long, f1 long, f2 long, reg binary"
    made = written(rows.select(F.col("uid").cast("long").alias("uid"), "text").mapInArrow(_sketched(words), kinds), "sketches")
    same = ["n_shingles", "f1", "f2"]
    reps = written(made.where("n_shingles > 0").groupBy(*same).agg(F.min("uid").alias("rep")), "classes")
    sketch = made.join(reps.select(F.col("rep").alias("uid")), "uid", "left_semi").select("uid", "n_shingles", "reg")
    entries = sketch.mapInArrow(_banded, "uid long, band int, key long, after binary")
    counted = entries.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    entries = written(entries.join(counted, ["band", "key"]), "entries")
    central = written(entries.groupBy("uid").agg(F.sum("n").alias("central")), "central")
    hubs = entries.join(central, "uid").groupBy("band", "key").agg(F.max(F.struct("central", (-F.col("uid")).alias("least"))).alias("hub"))
    hubs = written(hubs, "hubs")
    best = entries.join(hubs, ["band", "key"]).where("uid <> -hub.least").groupBy("uid").agg(F.max("hub")["least"].alias("least"))
    near = written(best.select(F.least("uid", -F.col("least")).alias("a"), F.greatest("uid", -F.col("least")).alias("b")).distinct(), "near", drop=(hubs,))
    sets = rows.select(F.col("uid").cast("long").alias("uid"), "text").join(central.select("uid"), "uid", "left_semi")
    sets = written(sets.mapInArrow(_set_of(words), "uid long, shingles binary"), "sets")
    sketch = written(sketch.join(central.select("uid"), "uid", "left_semi"), "members", drop=(central,))

    def confirmed(pairs: DataFrame) -> DataFrame:
        side = lambda t, s, *c: t.select(F.col("uid").alias(s), *[F.col(x).alias(f"{y}_{s}") for x, y in c])
        regs, full = (("reg", "reg"), ("n_shingles", "n")), (("shingles", "shingles"),)
        likely = pairs.join(side(sketch, "a", *regs), "a").join(side(sketch, "b", *regs), "b").mapInArrow(_likely(similarity), "a long, b long")
        rest = written(likely, "likely")
        linked = rest.join(side(sets, "a", *full), "a").join(side(sets, "b", *full), "b").mapInArrow(_linked(similarity), "a long, b long")
        return written(linked, "links", drop=(rest,))

    links = [confirmed(near)]
    dropped(near)
    every = lambda: reduce(DataFrame.unionByName, links)
    label = components(every())
    after = F.reverse(F.split(F.hex("after"), "(?<=\\G.{4})"))  # the last register first
    for order in (["band", "key", "after", "uid"], ["band", "key", "reverse", "uid"]):
        members = _labelled(entries.select("uid", "band", "key", "n", "after", F.array_join(after, "").alias("reverse")), label)
        members = members.join(sketch, "uid")
        crowd = F.col("n") > NEAR + 1  # others stay whole
        members = members.repartitionByRange(*order[:2], *[F.when(crowd, F.col(c)) for c in order[2:]]).sortWithinPartitions(*order)
        more = members.select("band", "key", "uid", "label", "n_shingles", "n", "reg").mapInArrow(_neighbours(similarity), "a long, b long").distinct()
        links.append(confirmed(more))
        dropped(label)
        label = components(every())
    crowds = written(_labelled(entries.where(F.col("n") > NEAR + 1).select("uid", "band", "key"), label), "crowds", drop=(entries,))
    of = crowds.groupBy("band", "key", "label").agg(F.count(F.lit(1)).alias("n"))
    open_ = of.groupBy("band", "key").agg(F.max_by("label", F.struct("n", "label")).alias("most"), F.count(F.lit(1)).alias("labels")).where("labels > 1")
    rest = crowds.join(written(open_, "open"), ["band", "key"]).groupBy("uid", "label").agg(F.bool_or(F.col("label") != F.col("most")).alias("guest"))
    rest = written(rest.join(sketch, "uid").join(sets, "uid"), "rest", drop=(crowds,))
    if not rest.isEmpty():
        links.append(confirmed(joined_by_shingles(rest, similarity)))
        dropped(label)
        label = components(every())
    dropped(rest, sets, sketch, *links)
    found = made.select("uid", *same).join(reps, same, "left").withColumn("rep", F.coalesce("rep", "uid"))
    found = found.join(label.select(F.col("uid").alias("rep"), "label"), "rep", "left").select("uid", "n_shingles", F.coalesce("label", "rep").alias("label"))
    found = rows.select("doc_id", "uid").join(found, "uid").select("doc_id", "uid", "n_shingles", "label")
    return written(found, "found", drop=(made, reps, label))


def near_copies(docs: DataFrame, words: int = WORDS, similarity: int = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Texts are sets of shingles of `words` words (A-Z lower-cased; fewer words make one shingle); documents are
    linked where 100 * shared >= similarity * united, and component_id is the smallest doc_id reachable. Null
    texts and texts without words are empty sets, linked with nothing. Rows with one doc_id count as separate
    documents and are all kept where that doc_id is the component's. A null doc_id is the smallest only
    where there is no other. Other columns are ignored; an empty table gives an empty result.
    """
    found = classes(keyed(docs, "text"), words, similarity)
    first = written(found.groupBy("label").agg(F.min("doc_id").alias("component_id")), "first")
    return found.join(first, "label").select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def without_near_copies(docs: DataFrame, words: int = WORDS, similarity: int = SIMILARITY) -> DataFrame:
    """docs with one row of each component, the one with the smallest doc_id; columns unchanged."""
    rows = keyed(docs, *[c for c in docs.columns if c != "doc_id"])
    found = classes(rows.select("doc_id", "uid", "text"), words, similarity)
    one = found.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "uid"))["uid"].alias("uid"))
    return rows.join(one, "uid", "left_semi").select(*docs.columns)


def op1_minhash_near_dedup(spark, sf_dir):
    return near_copies(documents(spark, sf_dir), words=3, similarity=85)
