"""Recordings read by byte ranges: headers by a few bytes each, payloads by the slices that are asked for.

Files are opened where the task runs, through Arrow's file systems (local, hdfs, s3, gs), so that what is read follows the
slices and not the files' sizes. Where only Spark can open a path, feeds.payloads reads whole files.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

FACTS = "recording_id string, sample_rate int, channels int, bits int, data_at long, data_bytes long, size long, ok boolean, bytes_read long"
LEFT_OPEN = 0xFFFFFFFF  # the size that a recorder writes who does not know it yet


class Files:
    """Open files, the last one used being kept; `read` counts the bytes."""

    def __init__(self):
        self.uri, self.file, self.bytes_read = None, None, 0

    def _opened(self, uri: str):
        if uri != self.uri:
            self.close()
            at = "file://" + uri[5:] if uri.startswith("file:/") and not uri.startswith("file://") else uri
            system, path = pyarrow.fs.FileSystem.from_uri(at)
            self.uri, self.file = uri, system.open_input_file(path)
        return self.file

    def size(self, uri: str) -> int:
        return self._opened(uri).size()

    def read(self, uri: str, at: int, n: int) -> bytes:
        """Up to n bytes from a place on; fewer at the file's end."""
        file = self._opened(uri)
        n = max(0, min(n, file.size() - at))
        got = file.read_at(n, at) if n and at >= 0 else b""
        self.bytes_read += len(got)
        return got

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
        self.uri = self.file = None


def facts(files: Files, uri: str) -> dict:
    """The format of a WAV file and where its samples lie, however many other chunks stand before them."""
    began, size = files.bytes_read, files.size(uri)
    out = {"recording_id": uri, "sample_rate": None, "channels": None, "bits": None, "data_at": None, "data_bytes": None, "size": size}
    head, at = files.read(uri, 0, 12), 12
    sound = head[:4] == b"RIFF" and head[8:12] == b"WAVE"
    while sound and at + 8 <= size:
        name, n = struct.unpack("<4sI", files.read(uri, at, 8))
        if name == b"fmt " and n >= 16 and at + 24 <= size:
            _, out["channels"], out["sample_rate"], _, _, out["bits"] = struct.unpack("<HHIIHH", files.read(uri, at + 8, 16))
        if name == b"data":
            out["data_at"], out["data_bytes"] = at + 8, min(n, size - at - 8)
            break
        at += 8 + n + n % 2
    ok = sound and all(out[c] for c in ("sample_rate", "channels", "bits")) and out["data_at"] is not None
    return out | {"ok": ok, "bytes_read": files.bytes_read - began}


def header_facts(recordings: DataFrame) -> DataFrame:
    """(recording_id, ...) to FACTS. ok is false for what is no WAV file, has a fact of 0, or has no samples' chunk. A sample rate
    over 2**31 counts as 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = Files()
        for batch in batches:
            rows = [facts(files, uri) for uri in batch.column("recording_id").to_pylist() if uri is not None]
            for r in rows:
                if (r["sample_rate"] or 0) >= 2**31:
                    r |= {"sample_rate": 0, "ok": False}
            kinds = {"sample_rate": pa.int32(), "channels": pa.int32(), "bits": pa.int32(), "recording_id": pa.string(), "ok": pa.bool_()}
            names = [c.split()[0] for c in FACTS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kinds.get(c, pa.int64())) for c in names], names)
        files.close()

    return recordings.select("recording_id").mapInArrow(run, FACTS)


def read_ranges(requests: DataFrame, into: str = "pcm16") -> DataFrame:
    """Requests (recording_id, offset, length, and any other columns) with the bytes of their ranges, which end with the file. A
    request with a null has null bytes, one of no length empty ones. Requests of one file that stand together share its handle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = Files()
        for batch in batches:
            uri, at, n = (batch.column(c).to_pylist() for c in ("recording_id", "offset", "length"))
            got = [None if None in r else files.read(*r) for r in zip(uri, at, n, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got, pa.binary())], [*batch.schema.names, into])
        files.close()

    return requests.mapInArrow(run, StructType([*requests.schema.fields, StructField(into, BinaryType())]))


def window_slices(windows: DataFrame, formats: DataFrame) -> DataFrame:
    """Window plans (recording_id, first_frame, frames) with their samples, by the formats of header_facts."""
    f = formats.where("ok").select("recording_id", "data_at", "data_bytes", (F.col("channels") * F.ceil(F.col("bits") / 8)).cast("long").alias("frame"))
    at = F.col("first_frame") * F.col("frame")
    r = windows.join(f, "recording_id").withColumn("offset", F.col("data_at") + at).withColumn("length", F.greatest(F.least(F.col("frames") * F.col("frame"), F.col("data_bytes") - at), F.lit(0)))
    return read_ranges(r.drop("data_at", "data_bytes", "frame")).drop("offset", "length")


def time_slices(requests: DataFrame, formats: DataFrame) -> DataFrame:
    """Time ranges (recording_id, start >= 0, duration > 0, in seconds) with their samples; others go. Frames are truncated."""
    ok = requests.where("start >= 0 AND duration > 0").join(formats.where("ok").select("recording_id", "sample_rate"), "recording_id")
    frames = lambda c: (F.col(c) * F.col("sample_rate")).cast("long")
    return window_slices(ok.withColumn("first_frame", frames("start")).withColumn("frames", frames("duration")), formats).drop("first_frame", "frames", "sample_rate")
