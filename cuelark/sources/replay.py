"""Recorded chunks replayed at their own pace: a clock as a streaming source, and the chunks that it calls up.

The source puts out the numbers of the chunks whose time has come, nothing else; the chunks themselves are read by Spark, as a static
table that the clock is joined to. Its offset is the next number, so that a query that starts again from its checkpoint goes
on where it was, and the clock with it.
"""

from __future__ import annotations

import time
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.streaming import StreamingQuery

NAME = "replay_clock"


class ReplayClock(DataSource):
    """Options: step (seconds between two chunks), speed (times the recordings' own pace; 0: all at once), first and end
    (the numbers of the first chunk and of the one behind the last)."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "sequence long"

    def simpleStreamReader(self, schema) -> Clock:
        o = self.options
        return Clock(float(o["step"]), float(o.get("speed", 1)), int(o.get("first", 0)), int(o["end"]))


class Clock(SimpleDataSourceStreamReader):
    def __init__(self, step: float, speed: float, first: int, end: int):
        self.step, self.speed, self.first, self.end = step, speed, first, end
        self.began: tuple[float, int] | None = None  # when this run began, and with which chunk

    def initialOffset(self) -> dict:
        return {"next": self.first}

    def due(self, position: int, now: float) -> int:
        """The number behind the last chunk whose time has come; a run's first chunk comes at once."""
        if self.speed <= 0:
            return self.end
        if self.began is None:
            self.began = now, position
        since, at = self.began
        return max(position, min(self.end, at + 1 + int((now - since) * self.speed / self.step)))

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        upto = self.due(start["next"], time.time())
        return zip(range(start["next"], upto)), {"next": upto}  # Spark copies the iterator

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return zip(range(start["next"], end["next"]))

    def commit(self, end: dict) -> None:
        pass


def replayed(spark: SparkSession, chunks: DataFrame, step: float, end: int, speed: float = 1.0, first: int = 0) -> DataFrame:
    """A stream of the rows of chunks (session_id, sequence, ...), those of each sequence when its time has come, with emitted_at.
    All sessions are replayed side by side; a step is the time from one chunk's start to the next's."""
    spark.dataSource.register(ReplayClock)
    clock = spark.readStream.format(NAME).options(step=str(step), speed=str(speed), first=str(first), end=str(end)).load()
    return chunks.join(F.broadcast(clock), "sequence").withColumn("emitted_at", F.current_timestamp())


def stop_at_end(query: StreamingQuery, end: int, seconds: float = 3600) -> bool:
    """Waits until a replay has put out its last chunk, and stops the query; False where that takes longer than `seconds`."""
    until = time.time() + seconds
    while time.time() < until and query.isActive:
        p = query.lastProgress
        if p and any(f'"next": {end}' in str(s.endOffset).replace("'", '"') for s in p.sources if s.endOffset):
            query.processAllAvailable()
            query.stop()
            return True
        time.sleep(0.1)
    return False
