import os
import struct
import time

import pytest
from pyspark.sql import functions as F

from cuelark.operators import windows
from cuelark.sources import ranges, replay


def wav(path, rate=16000, channels=1, bits=16, frames=1000, before=(), declared=None):
    """A WAV file with other chunks before its format and its samples."""
    other = b"".join(name + struct.pack("<I", len(x)) + x + b"\0" * (len(x) % 2) for name, x in before)
    frame = channels * bits // 8
    data = b"".join(struct.pack("<h", (k * 7) % 30000) for k in range(frames * frame // 2))
    fmt = b"fmt " + struct.pack("<IHHIIHH", 16, 1, channels, rate, rate * frame, frame, bits)
    body = b"WAVE" + other + fmt + other + b"data" + struct.pack("<I", len(data) if declared is None else declared) + data
    path.write_bytes(b"RIFF" + struct.pack("<I", len(body)) + body)
    return data


def test_facts_slices_and_what_is_read(spark, tmp_path):
    plain = wav(tmp_path / "a.wav", frames=16000)
    many = wav(tmp_path / "b.wav", channels=2, frames=8000, before=[(b"JUNK", b"x" * 11)] * 50, declared=ranges.LEFT_OPEN)
    wav(tmp_path / "c.wav", rate=0)
    (tmp_path / "d.wav").write_bytes(b"RIFFxx")
    (tmp_path / "e.wav").write_bytes(b"")
    with open(tmp_path / "big.wav", "wb") as f:  # 2 GB, of which next to nothing is on disk
        wav(tmp_path / "head.wav", frames=0, declared=2**31 - 100)
        f.write((tmp_path / "head.wav").read_bytes())
        f.truncate(2**31)
    os.remove(tmp_path / "head.wav")
    files = spark.createDataFrame([(f"file:{p}",) for p in sorted(tmp_path.iterdir())], "recording_id string").repartition(2)
    facts = ranges.header_facts(files)
    got = {os.path.basename(r.recording_id): r for r in facts.collect()}
    assert [(k, v.ok) for k, v in sorted(got.items())] == [("a.wav", True), ("b.wav", True), ("big.wav", True), ("c.wav", False), ("d.wav", False), ("e.wav", False)]
    assert (got["b.wav"].channels, got["b.wav"].sample_rate, got["b.wav"].bits, got["b.wav"].data_bytes) == (2, 16000, 16, len(many)) and got["a.wav"].data_at == 44
    assert got["big.wav"].bytes_read < 100 and max(r.bytes_read for r in got.values()) < 2000
    plan = facts.where("ok").select("recording_id", F.lit(16000).alias("rate"), (F.col("data_bytes") / (F.col("channels") * 2)).cast("long").alias("n_frames")).where("recording_id NOT LIKE '%big%'")
    cut = {(os.path.basename(r.recording_id), r.sequence): bytes(r.pcm16) for r in ranges.window_slices(windows.overlap_windows(plan, 0.4, 0.1), facts).collect()}
    step, size = 4800 * 2, 6400 * 2
    assert cut["a.wav", 0] == plain[:size] and cut["a.wav", 1] == plain[step : step + size] and cut["a.wav", 2] == plain[2 * step :] and len(cut) == 3 + 2
    assert cut["b.wav", 1] == many[2 * step :]
    r = facts.where("recording_id LIKE '%big%'").selectExpr("recording_id", "60000D AS start", "0.01D AS duration").unionByName(files.where("recording_id LIKE '%a.wav'").selectExpr("recording_id", "explode(array(0.5D, -1D)) AS start", "0.25D AS duration"))
    began = time.time()
    got = {os.path.basename(x.recording_id): bytes(x.pcm16) for x in ranges.time_slices(r, facts).collect()}
    assert got == {"big.wav": b"\0" * 320, "a.wav": plain[16000:24000]} and time.time() - began < 30


def test_ranges_of_nulls_ends_and_other_columns(spark, tmp_path):
    (tmp_path / "x").write_bytes(b"0123456789")
    u = f"file://{tmp_path}/x"
    rows = [(u, 2, 3, "k"), (u, 8, 100, None), (u, 20, 5, "z"), (u, 0, 0, "e"), (u, None, 1, "n"), (None, 0, 1, "m"), (u, 0, -4, "neg")]
    got = {r.note: r.pcm16 if r.pcm16 is None else bytes(r.pcm16) for r in ranges.read_ranges(spark.createDataFrame(rows, "recording_id string, offset long, length long, note string")).collect()}
    assert got == {"k": b"234", None: b"89", "z": b"", "e": b"", "n": None, "m": None, "neg": b""}
    files = ranges.Files()
    files.read(u, 1, 4)
    files.read(u, 9, 4)
    assert files.bytes_read == 5
    files.close()
    with pytest.raises(FileNotFoundError):
        ranges.Files().size(f"file://{tmp_path}/nowhere")


def test_the_clock():
    c = replay.Clock(4.5, 2.0, 3, 10)
    assert c.initialOffset() == {"next": 3} and c.due(3, 100.0) == 4 and c.due(4, 102.2) == 4 and c.due(4, 102.3) == 5 and c.due(5, 1000.0) == 10 and c.due(10, 1001.0) == 10
    again = replay.Clock(4.5, 2.0, 3, 10)
    assert again.due(7, 500.0) == 8 and again.due(8, 502.25) == 9  # goes on from its offset at its own pace
    assert replay.Clock(1, 0, 0, 7).due(2, 0.0) == 7 and [x[0] for x in c.readBetweenOffsets({"next": 4}, {"next": 6})] == [4, 5]


def test_a_replay_goes_on_from_its_checkpoint(spark, tmp_path):
    chunks = spark.createDataFrame([(s, k, k * 0.9) for s in "ab" for k in range(9)], "session_id string, sequence long, start double")

    def run(speed):
        out = replay.replayed(spark, chunks, 0.9, 9, speed).select("session_id", "sequence")
        return out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).start()

    q = run(0.4)
    until = time.time() + 60
    while time.time() < until and not (q.lastProgress and q.lastProgress.batchId >= 1):
        time.sleep(0.1)
    q.stop()
    read = lambda: sorted((r.session_id, r.sequence) for r in spark.read.schema("session_id string, sequence long").parquet(str(tmp_path / "out")).collect())
    some = read()
    assert 0 < len(some) < 18
    assert replay.stop_at_end(run(0), 9, 60)
    assert read() == [(s, k) for s in "ab" for k in range(9)]
