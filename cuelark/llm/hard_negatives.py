"""Hard-negative mining: Strassen products of anchor and candidate tiles, and heaps that merge.

Rows become integer vectors in tiles: a task packs the rows it reads into candidate tiles, anchors are dealt into
anchor tiles. Every pair of tiles is one cell of a grid, dealt out by (anchor tile, group of candidate tiles), so that no
task holds more than one tile of each. A cell's scores are one Strassen product in int64; all its steps are ring operations, so
results are exact wherever the scores themselves fit in 64 bits. A first walk over the grid keeps each anchor's best
positives, a second one the negatives in the window below each positive. Tasks merge the heaps of the cells they
meet one after another, and a window function merges those of all tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded, written

ANCHOR_TILE, CANDIDATE_TILE = 512, 4096  # rows
TILES_A_GROUP = 16  # candidate tiles of a group, which an anchor tile is sent to once
LEAF = 16  # Strassen stops at sides of this size
POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90
LARGEST = 2**17  # components of this size and more count as non-finite, so that scores of 8,000 of them fit in 64 bits
AT_ONCE = 64  # anchor tiles whose heaps a task holds together
NONE = np.iinfo(np.int64).min
TILE = "ids binary, labels binary, vectors binary, side int"


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The int64 product of a (m, k) and b (k, n). Odd sides are padded with a zero row or column at each level; a side
    of LEAF or less ends the recursion."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= LEAF:
        return _product(a, b)
    a, b = np.pad(a, ((0, m % 2), (0, k % 2))), np.pad(b, ((0, k % 2), (0, n % 2)))
    i, j, h = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :j], a[:i, j:], a[i:, :j], a[i:, j:]
    b11, b12, b21, b22 = b[:j, :h], b[:j, h:], b[j:, :h], b[j:, h:]
    p1 = strassen(a11 + a22, b11 + b22)
    p2 = strassen(a21 + a22, b11)
    p3 = strassen(a11, b12 - b22)
    p4 = strassen(a22, b21 - b11)
    p5 = strassen(a11 + a12, b22)
    out = np.empty((2 * i, 2 * h), np.int64)
    out[:i, :h] = p1 + p4 - p5 + strassen(a12 - a22, b21 + b22)
    out[:i, h:] = p3 + p5
    out[i:, :h] = p2 + p4
    out[i:, h:] = p1 - p2 + p3 + strassen(a21 - a11, b11 + b12)
    return out[:m, :n]


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A leaf: in doubles where no sum can pass 2**53, which is exact and faster, else in int64."""
    if not a.size or not b.size:
        return np.zeros((a.shape[0], b.shape[1]), np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def usable(vectors: DataFrame, relabel: Column | None = None) -> DataFrame:
    """(vec_id, label, vector array<int>) of the rows that take part: floor(256 * x) of each component.

    Rows with a null vec_id, label, vector or component go, and those with a component that is NaN, infinite or LARGEST and
    more in size. relabel takes the place of the label.
    """
    label = F.col("label").cast("long") if relabel is None else relabel.cast("long")
    fine = F.forall("embedding", lambda x: F.coalesce(F.abs(x) < F.lit(float(LARGEST)), F.lit(False)))  # NaN is above all numbers
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(fine)
    ints = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("int"))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"), ints.alias("vector"))


def _packed(ids: np.ndarray, labels: np.ndarray, vectors: list[np.ndarray]) -> tuple[bytes, bytes, bytes, int]:
    """One tile, its rows in the order of their ids; shorter vectors are padded with zeros."""
    side = max(map(len, vectors), default=0)
    if all(len(v) == side for v in vectors):
        m = np.array(vectors, np.int32).reshape(len(ids), side)
    else:
        m = np.zeros((len(ids), side), np.int32)
        for row, v in zip(m, vectors, strict=True):
            row[: len(v)] = v
    order = np.argsort(ids, kind="stable")
    return ids[order].tobytes(), labels[order].tobytes(), m[order].tobytes(), side


def _vectors(column: pa.ListArray) -> list[np.ndarray]:
    flat, at = column.flatten().to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [flat[a:b] for a, b in zip(at[:-1] - at[0], at[1:] - at[0], strict=True)]


def _tiled(batches):
    """Rows to candidate tiles, numbered within the task; batches are cut and joined to fill tiles."""
    task, k, held, n = TaskContext.get().partitionId(), 0, [], 0

    def tile():
        ids, labels = (np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in held]).astype(np.int64) for c in ("vec_id", "label"))
        made = _packed(ids, labels, [v for b in held for v in _vectors(b.column("vector"))])
        return pa.RecordBatch.from_pydict({"task": pa.array([task], pa.int32()), "k": pa.array([k], pa.int32()), **_columns(made)})

    for batch in batches:
        while len(batch):
            part, batch = batch.slice(0, CANDIDATE_TILE - n), batch.slice(min(len(batch), CANDIDATE_TILE - n))
            held.append(part)
            n += len(part)
            if n == CANDIDATE_TILE:
                yield tile()
                k, held, n = k + 1, [], 0
    if n:
        yield tile()


def _columns(tile: tuple[bytes, bytes, bytes, int]) -> dict[str, pa.Array]:
    return {c: pa.array([x], pa.binary()) for c, x in zip(("ids", "labels", "vectors"), tile[:3], strict=True)} | {"side": pa.array([tile[3]], pa.int32())}


def _anchor_tiles(extra: tuple[str, ...] = ()):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("vec_id", "ascending"), ("uid", "ascending")]).combine_chunks()
        ids, labels = (table.column(c).to_numpy().astype(np.int64) for c in ("vec_id", "label"))
        tile = _packed(ids, labels, _vectors(table.column("vector").combine_chunks()))
        made = {"a": table.column("a").slice(0, 1), "uids": pa.array([table.column("uid").to_numpy().astype(np.int64).tobytes()], pa.binary()), **_columns(tile)}
        for c in extra:  # arrays of up to POSITIVES scores become POSITIVES columns; NONE where there are fewer
            rows = np.full((len(ids), POSITIVES), NONE, np.int64)
            for row, v in zip(rows, _vectors(table.column(c).combine_chunks()), strict=True):
                row[: len(v)] = v
            made[c] = pa.array([rows.tobytes()], pa.binary())
        return pa.table(made)

    return run


def _cells(anchors: DataFrame, tiles: DataFrame, n_anchor_tiles: int, n_groups: int) -> DataFrame:
    """Every pair of an anchor tile and a candidate tile as one row, by an equality join on (a, g): the stated query set
    against all rows, in blocks."""
    g = F.pmod(F.xxhash64("task", "k"), F.lit(n_groups)).cast("int")
    c = tiles.select(g.alias("g"), F.explode(F.sequence(F.lit(0), F.lit(n_anchor_tiles - 1))).alias("a"), *[F.col(x).alias(f"c_{x}") for x in ("ids", "labels", "vectors", "side")])
    return anchors.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1)))).join(c, ["a", "g"])


def _ints(row: dict, name: str, side: int | None = None) -> np.ndarray:
    if side is None:
        return np.frombuffer(row[name], np.int64)
    return np.frombuffer(row[name], np.int32).reshape(-1, side) if side else np.zeros((0, 0), np.int32)


def scores(row: dict) -> np.ndarray:
    """All scores of a cell, by the anchors' and the candidates' order in their tiles."""
    m, n, k = len(_ints(row, "ids")), len(_ints(row, "c_ids")), max(row["side"], row["c_side"])
    a, b = np.zeros((m, k), np.int64), np.zeros((k, n), np.int64)
    if row["side"]:
        a[:, : row["side"]] = _ints(row, "vectors", row["side"])
    if row["c_side"]:
        b[: row["c_side"]] = _ints(row, "c_vectors", row["c_side"]).T
    return strassen(a, b)


class Heaps:
    """The best `size` (score, id) of each of some slots: higher scores first, then smaller ids. Empty places hold NONE."""

    def __init__(self, slots: int, size: int):
        self.score, self.id = np.full((slots, size), NONE, np.int64), np.full((slots, size), np.iinfo(np.int64).max, np.int64)

    def merge(self, score: np.ndarray, ids: np.ndarray, slots: np.ndarray | slice = slice(None)) -> None:
        """Takes more entries for the slots, one row for each."""
        size = self.score.shape[1]
        score, ids = np.concatenate([self.score[slots], score], 1), np.concatenate([self.id[slots], ids], 1)
        order = np.lexsort((ids, ~score), axis=1)[:, :size]  # ~x falls as x rises, and never overflows
        self.score[slots], self.id[slots] = np.take_along_axis(score, order, 1), np.take_along_axis(ids, order, 1)

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        slot, place = np.nonzero(self.score != NONE)
        return slot, self.score[slot, place], self.id[slot, place]


def _best(score: np.ndarray, ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The first `size` entries of each row, in no order; columns are in the order of their ids, so that of equal scores the
    first columns count."""
    if score.shape[1] <= size:
        return score, np.broadcast_to(ids, score.shape)
    low = ~score
    kth = np.partition(low, size - 1, axis=1)[:, size - 1 : size]
    sure, tie = low < kth, low == kth
    take = sure | (tie & (np.cumsum(tie, 1) <= size - sure.sum(1, keepdims=True)))
    column = np.nonzero(take)[1].reshape(len(score), size)
    return np.take_along_axis(score, column, 1), ids[column]


def positives(row: dict, heaps: Heaps, size: int = POSITIVES) -> None:
    """A cell's rows of the anchors' labels; a row of the anchor's own vec_id is no other row."""
    ids, own = _ints(row, "c_ids"), _ints(row, "ids")
    masked = np.where((_ints(row, "labels")[:, None] == _ints(row, "c_labels")) & (own[:, None] != ids), scores(row), NONE)
    heaps.merge(*_best(masked, ids, size))


def negatives(row: dict, heaps: Heaps, size: int = NEGATIVES) -> None:
    """A cell's rows of other labels within the window of each of an anchor's positives; one slot for each positive."""
    ids, labels, score = _ints(row, "c_ids"), _ints(row, "c_labels"), scores(row)
    wanted = _ints(row, "p_scores").reshape(-1, POSITIVES)
    slots, found_s, found_i = [], [], []
    for r, (own, label) in enumerate(zip(wanted.tolist(), _ints(row, "labels"), strict=True)):
        windows = {j: (-(-LOW * p // 100), HIGH * p // 100) for j, p in enumerate(own) if p != NONE and p >= 0}
        if not windows:
            continue
        s = score[r]
        at = np.flatnonzero((labels != label) & (s >= min(x[0] for x in windows.values())) & (s <= max(x[1] for x in windows.values())))
        at = at[np.argsort(~s[at], kind="stable")]  # columns are in the order of their ids
        falling = ~s[at]
        for j, (low, high) in windows.items():
            first, last = np.searchsorted(falling, ~high, "left"), np.searchsorted(falling, ~low, "right")
            got = at[first : min(last, first + size)]
            if len(got):
                slots.append(r * POSITIVES + j)
                found_s.append(np.pad(s[got], (0, size - len(got)), constant_values=NONE))
                found_i.append(np.pad(ids[got], (0, size - len(got)), constant_values=np.iinfo(np.int64).max))
    if slots:
        heaps.merge(np.array(found_s), np.array(found_i), np.array(slots))


def _walked(meet, slots_a_row: int, size: int):
    """Cells to (uid, slot, score, id): what is left in the heaps of the anchor tiles that a task has met."""

    def flushed(uids: np.ndarray, heaps: Heaps) -> pa.RecordBatch:
        slot, score, ids = heaps.entries()
        return pa.RecordBatch.from_arrays([pa.array(uids[slot // slots_a_row]), pa.array((slot % slots_a_row).astype(np.int32)), pa.array(score), pa.array(ids)], ["uid", "slot", "score", "id"])

    def run(batches):
        held: dict[int, tuple[np.ndarray, Heaps]] = {}
        for batch in batches:
            for i in range(len(batch)):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                if row["a"] not in held:
                    if len(held) == AT_ONCE:
                        yield flushed(*held.pop(next(iter(held))))
                    uids = _ints(row, "uids")
                    held[row["a"]] = uids, Heaps(len(uids) * slots_a_row, size)
                meet(row, held[row["a"]][1])
        for uids, heaps in held.values():
            yield flushed(uids, heaps)

    return run


def _merged(heaps: DataFrame, size: int) -> DataFrame:
    """The tasks' heaps as one for each (uid, slot); Spark limits the groups before the shuffle too."""
    order = Window.partitionBy("uid", "slot").orderBy(F.desc("score"), "id")
    return heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mined(vectors: DataFrame, relabel: Column | None = None, every: int = 100) -> DataFrame:
    """Hard negatives of the anchors, the rows whose vec_id is divisible by `every`, among all rows of (vec_id, label, embedding).

    An anchor's positives are the first POSITIVES other rows of its label, by falling score, then by vec_id. For each
    positive there are the first NEGATIVES rows of other labels whose score is between LOW and HIGH percent of the positive's.
    usable() says which rows take no part. Rows that repeat a vec_id are rows of their own: each counts as a candidate, and
    each anchor among them gets its rows; none is an "other row" to one of the same vec_id. Vectors of different lengths
    meet as if zeros followed the shorter. Anchors without a positive, and positives with an empty window, have no
    rows; an empty table gives none. Other columns are ignored.
    """
    spark = vectors.sparkSession
    bounded(spark)
    rows = usable(vectors, relabel)
    tiles = written(rows.mapInArrow(_tiled, f"task int, k int, {TILE}"), "candidate-tiles")
    anchors = written(rows.where(F.col("vec_id") % every == 0).withColumn("uid", F.monotonically_increasing_id()), "anchors")
    n_tiles, n_anchors = tiles.count(), anchors.count()
    n_a = max(1, -(-n_anchors // ANCHOR_TILE))
    n_g = max(1, -(-n_tiles // TILES_A_GROUP), min(n_tiles, spark.sparkContext.defaultParallelism))
    dealt = anchors.withColumn("a", F.pmod(F.xxhash64("uid"), F.lit(n_a)).cast("int"))
    found = "uid long, slot int, score long, id long"
    packed = dealt.groupBy("a").applyInArrow(_anchor_tiles(), f"a int, uids binary, {TILE}")
    best = written(_merged(_cells(packed, tiles, n_a, n_g).mapInArrow(_walked(positives, 1, POSITIVES), found), POSITIVES), "positives")
    lists = best.groupBy("uid").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda x: x["score"]).alias("p_scores"))
    packed = dealt.join(lists, "uid").groupBy("a").applyInArrow(_anchor_tiles(("p_scores",)), f"a int, uids binary, {TILE}, p_scores binary")
    hard = written(_cells(packed, tiles, n_a, n_g).mapInArrow(_walked(negatives, POSITIVES, NEGATIVES), found), "negatives", drop=(tiles,))
    hard = _merged(hard, NEGATIVES).select("uid", "slot", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    known = best.select("uid", (F.col("rank") - 1).alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = hard.join(known, ["uid", "slot"]).join(anchors.select("uid", F.col("vec_id").alias("anchor_id")), "uid")
    return out.select(*[c.split()[0] for c in MINED.split(", ")])


def op11_hard_negatives(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return mined(vectors, F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))


SQL = """WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER w::INT AS rank, id AS negative_id, positive_score, score AS negative_score FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) QUALIFY row_number() OVER w <= 10"""
