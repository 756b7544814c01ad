"""Running values over very long keys: blocks in range order, and a scan over what each block comes to.

A hot session or a giant recording is many blocks, each one task's work. What a block does to a running state is its
value; values of neighbouring blocks compose, so that a tree of groups of FAN blocks carries the state from
the first block to the last, and no task holds more than FAN values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import kept

FAN = 256


def blocks(rows: DataFrame, key: str, *order: str, tasks: int | None = None) -> DataFrame:
    """rows as a written table with `place`: the number of the range of (key, order) that a row lies in. A key's places rise
    in its order, and a key with many rows has many places."""
    tasks = tasks or 2 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return kept(rows.repartitionByRange(tasks, key, *order).withColumn("place", F.spark_partition_id().cast("long")), "blocks")


def exclusive(
    parts: DataFrame, key: str, zero: Column, apply: Callable[[Column, Column], Column], compose: Callable[[Column, Column], Column], fan: int = FAN
) -> DataFrame:
    """(key, place long, value), one row for each place, to (key, place, before): what the values of the key's earlier
    places make of zero, in their order. apply(state, value) is a state, compose(value, later) a value; states have the type of zero."""
    parts = kept(parts.select(key, "place", "value"), "values")
    top = parts.agg(F.max("place").alias("top")).first()["top"] or 0
    levels = [parts]
    while top >= fan:
        top //= fan
        items = _items(levels[-1], key, fan)
        levels.append(kept(items.select(key, "place", F.aggregate(F.slice("items", 2, fan), F.col("items")[0]["value"], lambda a, x: compose(a, x["value"])).alias("value")), "values"))
    kind = parts.sparkSession.range(1).select(zero.alias("s")).schema["s"].dataType.simpleString()
    above = None
    for level in reversed(levels):
        items = _items(level, key, fan)
        items = items.withColumn("before", zero) if above is None else items.join(above, [key, "place"])
        begin = F.struct(F.array().cast(f"array<{kind}>").alias("done"), F.col("before").alias("now"))
        step = lambda a, x: F.struct(F.concat(a["done"], F.array(a["now"])).alias("done"), apply(a["now"], x["value"]).alias("now"))
        states = F.aggregate("items", begin, step, lambda a: a["done"])
        pairs = items.select(key, F.explode(F.arrays_zip(F.col("items.place").alias("place"), states.alias("before"))).alias("x"))
        above = pairs.select(key, "x.place", "x.before")
    return above


def _items(level: DataFrame, key: str, fan: int) -> DataFrame:
    """Groups of `fan` neighbouring places, in order."""
    return level.groupBy(key, F.floor(F.col("place") / fan).alias("parent")).agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("items")).withColumnRenamed("parent", "place")


def running(rows: DataFrame, key: str, order: str, what: Column, zero: Column) -> DataFrame:
    """rows of blocks() with `before`: the greatest of `what` over the key's earlier rows, and of zero. Nulls do not count."""
    most = rows.groupBy(key, "place").agg(F.max(what).alias("value"))
    greater = lambda a, x: F.greatest(a, x)
    states = exclusive(most, key, zero, greater, greater)
    earlier = Window.partitionBy(key, "place").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("_own", F.max(what).over(earlier)).join(states.hint("merge"), [key, "place"]).withColumn("before", F.greatest("before", "_own")).drop("_own")
