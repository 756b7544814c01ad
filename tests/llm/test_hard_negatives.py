import math
import random

import numpy as np
import pytest

from cuelark.llm import hard_negatives as H

VECTORS = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("shape", [(1, 1, 1), (17, 33, 18), (64, 64, 64), (100, 65, 37), (0, 5, 3), (40, 0, 40), (33, 129, 70)])
def test_strassen_equals_the_product(shape):
    r = np.random.default_rng(sum(shape))
    m, k, n = shape
    a, b = r.integers(-(2**24), 2**24, (m, k)), r.integers(-(2**24), 2**24, (k, n))
    assert (H.strassen(a, b) == (a.astype(object) @ b.astype(object) if k else np.zeros((m, n), np.int64))).all()


def test_strassen_leaves_beyond_exact_doubles():
    r = np.random.default_rng(5)
    a, b = r.integers(-(2**27), 2**27, (40, 48)), r.integers(-(2**27), 2**27, (48, 40))
    assert (H.strassen(a, b) == a.astype(object) @ b.astype(object)).all()


def brute(rows: list[tuple]) -> list[tuple]:
    v = [(i, (x + 1) % 10 if i % 7 == 0 else x, [math.floor(256 * float(np.float32(c))) for c in e]) for i, e, x in rows if i is not None and x is not None and e is not None and all(c is not None and math.isfinite(c) for c in e)]
    out = []
    for i, label, e in v:
        if i % 100:
            continue
        scored = [(-sum(a * b for a, b in zip(e, f, strict=False)), j, x) for j, x, f in v if j != i]
        scored.sort()
        other = [s for s in scored if s[2] != label]
        for p, j, _ in [s for s in scored if s[2] == label][:5]:
            fine = [s for s in other if 30 * -p <= 100 * -s[0] <= 90 * -p][:10]
            out += [(i, j, k + 1, s[1], -p, -s[0]) for k, s in enumerate(fine)]
    return sorted(out)


def mined(spark, rows: list[tuple], schema: str = VECTORS) -> list[tuple]:
    from pyspark.sql import functions as F

    relabel = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted(map(tuple, H.mined(spark.createDataFrame(rows, schema), relabel).collect()))


def vectors(seed: int, n: int, values: int = 0) -> list[tuple]:
    """With few values there are many ties."""
    r = random.Random(seed)
    return [(i, [r.randrange(values) / 8 if values else r.gauss(0.1, 0.3) for _ in range(24)], r.randrange(4)) for i in range(n)]


@pytest.mark.parametrize("values", [0, 2])
def test_equals_brute_force(spark, monkeypatch, values):
    """Anchors of several tiles meet the candidate tiles of several tasks."""
    monkeypatch.setattr(H, "ANCHOR_TILE", 2)
    rows = vectors(3, 640, values)
    assert len(want := brute(rows)) > 150 and mined(spark, rows) == want


def test_nulls_odd_components_repeats_and_short_vectors(spark):
    rows = vectors(7, 330, 3)
    rows += [(400, None, 1), (500, [0.5, None], 2), (600, [math.nan] * 24, 1), (700, [math.inf] * 24, 1), (None, [0.5] * 24, 2), (800, [1.0] * 24, None)]
    rows += [(900, [], 1), (1000, [0.5] * 10, 3), (1001, [0.25] * 30, 3), rows[5], rows[200], (-100, [0.5] * 24, 2)]
    random.Random(1).shuffle(rows)
    assert mined(spark, rows) == brute(rows)


def test_empty_tables_and_clashing_columns(spark):
    assert mined(spark, []) == [] and mined(spark, [(1, [0.5], 1), (2, [0.5], 2)]) == [] and mined(spark, [(100, [0.5], 1)]) == []
    schema = "vec_id long, embedding array<float>, label int, uid long, a int, g int, slot int, rank int, score long, id long, task int, k int, vector string"
    rows = vectors(2, 230)
    assert mined(spark, [(*r, 1, 2, 3, 4, 5, 6, 7, 8, 9, "x") for r in rows], schema) == brute(rows)


def test_heaps_merge_in_any_order():
    r = random.Random(9)
    entries = [(r.randrange(20), r.randrange(1000)) for _ in range(300)]
    a, b = H.Heaps(1, 7), H.Heaps(1, 7)
    for heap, order in ((a, entries), (b, r.sample(entries, len(entries)))):
        for i in range(0, 300, 13):
            s, ids = zip(*order[i : i + 13], strict=True)
            heap.merge(np.array([s]), np.array([ids]))
    want = sorted(entries, key=lambda x: (-x[0], x[1]))[:7]
    assert [*zip(a.score[0].tolist(), a.id[0].tolist(), strict=True)] == want == [*zip(b.score[0].tolist(), b.id[0].tolist(), strict=True)]
