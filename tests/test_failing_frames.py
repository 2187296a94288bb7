"""Frames that can't be read or give nothing: runs go on, tries are recorded, and frames rest before they are tried again."""

import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from firnline import schema
from firnline.operators import frames as frame_ops
from firnline.plans import run
from firnline.sources import radargrams
from firnline.sources.snapshots import SnapshotStore
from test_traces import SETTINGS, TWTT, frame, picks

IDS = ["Data_20120101_01_001", "Data_20120101_01_002", "Data_20120101_01_003"]


def save(folder, frame_id, rows):
    os.makedirs(folder, exist_ok=True)
    micros = np.array([int(r[3].timestamp() * 1e6) for r in rows], np.int64)
    np.savez(f"{folder}/{frame_id}.npz", data=np.array([r[8] for r in rows]).reshape(len(rows), len(TWTT)), twtt=TWTT, slow_time=micros, latitude=np.array([r[4] for r in rows]), longitude=np.array([r[5] for r in rows]), elevation=np.array([r[6] for r in rows]))


@pytest.fixture
def folder(tmp_path):
    path = tmp_path / "frames"
    save(path / "2012_A", IDS[0], frame())
    save(path / "2012_A", IDS[2], [])
    (path / "2012_A" / f"{IDS[1]}.npz").write_bytes(b"not an archive")
    return path


def test_a_run_with_a_damaged_file(spark, tmp_path, folder):
    frames = spark.createDataFrame([(i, "20120101_01", "2012_A") for i in IDS], "frame_id string, segment_id string, collection string")
    layers = spark.createDataFrame(picks(), schema.PICKS)
    store = SnapshotStore(spark, f"{tmp_path}/store")
    at = lambda hours: F.lit(dt.datetime(2024, 1, 1) + dt.timedelta(hours=hours)).cast("timestamp")
    settings = SETTINGS | {"processing": SETTINGS["processing"] | {"checkpoint_every": 2, "retry_after": "1h", "retry_most": "3h"}}
    asked = []
    source = run.frame_files(spark, str(folder), retries="1", wait="0")

    def raw(ids):
        asked.append(sorted(ids))
        return source(ids)

    assert run.run(store, frames, raw, layers, settings, now=at(0))
    assert store.read().count() == 10
    tries = {r.frame_id: (r.outcome, r.error) for r in store.attempts().collect()}
    assert tries[IDS[0]] == ("rows", None) and tries[IDS[1]][0] == "failed" and tries[IDS[2]] == ("failed", "no traces")
    assert tries[IDS[1]][1]
    asked.clear()
    assert run.run(store, frames, raw, layers, settings, now=at(0.5)) is None and asked == []  # both rest
    assert run.run(store, frames, raw, layers, settings, now=at(1.5)) is None and asked  # tried again, in vain
    asked.clear()
    assert run.run(store, frames, raw, layers, settings, now=at(3)) is None and asked == []  # two hours after two failures
    save(folder / "2012_A", IDS[1], frame(IDS[1], seed=3))
    assert run.run(store, frames, raw, layers, settings, now=at(4)) and store.read().count() == 20
    assert store.processed().count() == 2


def test_frames_that_are_due(spark):
    t = lambda h: dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    rows = [("ok then bad", t(0), "failed", "x"), ("ok then bad", t(1), "rows", None), ("ok then bad", t(2), "failed", "x"), *[("often", t(k), "failed", "x") for k in range(9)], ("fine", t(1), "rows", None), ("none", t(7), "none", None)]
    attempts = spark.createDataFrame(rows, schema.ATTEMPTS)
    frames = spark.createDataFrame([(n,) for n in ("ok then bad", "often", "fine", "none", "new")], "frame_id string")
    due = lambda hours: sorted(r.frame_id for r in frame_ops.due(frames, attempts, F.lit(t(hours)).cast("timestamp"), 3600, 6 * 3600).collect())
    assert due(2.5) == ["fine", "new"] and due(7.5) == ["fine", "new", "ok then bad"]
    assert due(8.5) == ["fine", "new", "none", "ok then bad"] and due(14.5) == sorted(["fine", "new", "none", "ok then bad", "often"])


def test_the_source_reports_or_fails(spark, folder):
    radargrams.register(spark)
    reader = spark.read.format("frames").option("path", f"file://{folder}").option("retries", "0")
    out = reader.option("report", "true").load()
    assert out.columns[-1] == "error" and {(r.frame_id, r.error is None) for r in out.select("frame_id", "error").distinct().collect()} == {(IDS[0], True), (IDS[1], False), (IDS[2], False)}
    assert reader.option("report", "false").option("frames", IDS[0]).load().count() == 10
    with pytest.raises(Exception, match="(?i)pickle|zip|magic|load"):
        reader.option("report", "false").option("frames", IDS[1]).load().count()


def test_a_stream_of_frame_files(spark, tmp_path, folder):
    """Files that come between two runs of the stream are read once, in the second."""
    radargrams.register(spark)
    counts = []

    def once():
        stream = spark.readStream.format("frames").option("path", str(folder)).option("report", "true").option("settle", "0").load()
        query = stream.writeStream.foreachBatch(lambda rows, n: counts.append({(r.frame_id, r.error is None, r["count"]) for r in rows.groupBy("frame_id", "error").count().collect()})).option("checkpointLocation", f"{tmp_path}/mark").trigger(availableNow=True).start()
        query.awaitTermination()

    once()
    assert {x for c in counts for x in c} == {(IDS[0], True, 10), (IDS[1], False, 1), (IDS[2], False, 1)}
    counts.clear()
    save(folder / "2013_B", "Data_20130101_01_001", frame("Data_20130101_01_001", n=4))
    once()
    assert {x for c in counts for x in c} == {("Data_20130101_01_001", True, 4)}
