"""Python steps over sorted rows: a task reads Arrow batches, so that many small keys cost no call, frame or batch each."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame


def in_order(rows: DataFrame, keys: list[str], order: list[str], made: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    """What `made` makes of a task's batches. All rows of a key lie in one task, side by side and sorted by `order`."""
    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(made, schema)


def _last_key(batch: pa.RecordBatch, keys: list[str]) -> tuple:
    return tuple(batch.column(k)[len(batch) - 1].as_py() for k in keys)


def starts(table: pa.Table | pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """The places where a key begins."""
    new = np.zeros(len(table), bool)
    new[:1] = True
    for k in keys:
        column = table.column(k)
        code = pc.dictionary_encode(column, null_encoding="encode")
        code = (code.combine_chunks() if isinstance(code, pa.ChunkedArray) else code).indices.to_numpy()
        new[1:] |= code[1:] != code[:-1]
    return np.flatnonzero(new)


def whole_keys(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Sorted batches as tables of whole keys: what a task holds is a batch and one key."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        first = int(starts(batch, keys)[-1])
        if first == 0 and held and _last_key(held[-1], keys) == _last_key(batch, keys):
            held.append(batch)
            continue
        if whole := [*held, batch.slice(0, first)] if first else held:
            yield pa.Table.from_batches(whole).combine_chunks()
        held = [batch.slice(first)]
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
