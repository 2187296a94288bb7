"""Keyed state over streams against the batch operators."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from firnline import schema
from firnline.operators import time_axis
from firnline.plans.extract import extract_metrics
from firnline.sources.snapshots import SnapshotStore
from firnline.streaming import stateful
from test_traces import SETTINGS, START, frame, picks

SECOND = 1_000_000


@pytest.fixture
def state_store(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    stateful.use_state_store(spark)
    yield
    spark.conf.set(name, before)


def in_files(spark, rows, schema, folder):
    """A stream whose micro-batches are the given lists of rows, one after another."""
    import os
    import time

    for n, part in enumerate(rows):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(folder))
        for f in os.listdir(folder):
            if f.endswith(".parquet") and not f.startswith("batch-"):
                os.rename(f"{folder}/{f}", f"{folder}/batch-{n:03d}.parquet")
                os.utime(f"{folder}/batch-{n:03d}.parquet", (time.time() - 1000 + n, time.time() - 1000 + n))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/batch-*.parquet")


def finished(frame, folder, name):
    query = frame.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(folder)).trigger(availableNow=True).start()
    query.awaitTermination()
    return frame.sparkSession.table(name)


TRACES, PICKS = "track string, t long, n long", "track string, t long, twtt double"


def streams(seed):
    """Traces in batches, out of order within 20 seconds; picks of the same times, a third of them without a value."""
    rng = random.Random(seed)
    traces = [(f"T{n % 3}", (100 + n) * SECOND + rng.randrange(SECOND), n) for n in range(240)]  # a watermark starts at 1970
    picks = [(f"T{rng.randrange(3)}", t, None if rng.random() < 0.3 else round(rng.random(), 6)) for t in rng.sample(range(100 * SECOND, 340 * SECOND, SECOND // 4), 260)]
    picks += [(f"T{n % 3}", t - 2 * SECOND, float(n)) for n, (_, t, _) in enumerate(traces[::40])] + [("T1", traces[10][1] + 3 * SECOND, 9.0), ("T1", traces[10][1] - 3 * SECOND, 8.0)]
    picks = list({(k, t): (k, t, v) for k, t, v in picks}.values())
    return traces, picks


def batches(rows, width, seed, ends):
    rng = random.Random(seed)
    late = sorted(rows, key=lambda r: r[1] + rng.randrange(20) * SECOND)
    return [late[k : k + width] for k in range(0, len(late), width)] + [[e] for e in ends]


@pytest.mark.parametrize("picks_width", [60, 300])
def test_nearest_picks_of_a_stream(spark, tmp_path, state_store, picks_width):
    """Late picks, early picks (all of them first) and late traces give the batch operator's rows."""
    traces, picks = streams(picks_width)
    left = in_files(spark, batches(traces, 60, 1, [("end", 2000 * SECOND, -1), ("end", 2001 * SECOND, -2)]), TRACES, tmp_path / "traces")
    right = in_files(spark, batches(picks, picks_width, 2, [("end", 2000 * SECOND, None), ("end", 2001 * SECOND, None)]), PICKS, tmp_path / "picks")
    out = stateful.nearest_in_stream(left, right, "track", "t", ["twtt"], 3 * SECOND, late="30 seconds")
    got = sorted(tuple(r) for r in finished(out, tmp_path / "mark", f"near{picks_width}").where("track <> 'end'").collect())
    want = time_axis.nearest(spark.createDataFrame(traces, TRACES), spark.createDataFrame(picks, PICKS), ["track"], "t", ["twtt"], 3 * SECOND)
    assert got == sorted(tuple(r) for r in want.collect())
    assert any(r[-1] is not None for r in got) and any(r[-1] is None for r in got)


KEPT = ["frame_id", "slow_time", "surface_power_dB", "bed_power_dB"]


def test_frames_close_reopen_and_ignore_replays(spark, tmp_path, state_store):
    """Split, late and replayed files give the rows of whole frames; nothing that landed before is read again."""
    first, second = frame(n=12), frame("Data_20120101_01_002", n=8, seed=1)
    far = [("end", "x", "c", START + dt.timedelta(hours=h), 0.0, 0.0, 0.0, None, [1.0], [1e-6]) for h in (3, 4)]
    clock = [("clock", "x", "c", START + dt.timedelta(seconds=s), 0.0, 0.0, 0.0, None, [1.0], [1e-6]) for s in (400, 420, 500)]
    batches = [first[:3] + second[:4], first[5:12] + second[4:], [clock[0]], [clock[1]], first[:6] + [clock[2]], first[3:9], [far[0]], [far[1]]]
    raw = in_files(spark, batches, schema.RAW_TRACES, tmp_path / "raw")
    layers = spark.createDataFrame(picks(n=12), schema.PICKS)
    settings = SETTINGS | {"processing": SETTINGS["processing"] | {"decimate_interval": "25s"}, "qc": {"min_traces_after_qc": 3}}
    closed = finished(stateful.closed_frames(raw, 100 * SECOND, 600 * SECOND), tmp_path / "mark", "closed")
    versions = {(r.frame_id, r.version): r.n for r in closed.groupBy("frame_id", "version").agg(F.count("*").alias("n")).collect()}
    # 10 of its 12 traces when it closed first; a late file brought the other two, replays brought nothing
    assert versions[first[0][0], 1] == 10 and versions[first[0][0], 2] == 12 and versions[second[0][0], 1] == 8
    assert (first[0][0], 3) not in versions and (second[0][0], 2) not in versions

    store = SnapshotStore(spark, f"{tmp_path}/store")
    stateful.ingest_frames(raw, layers, store, f"{tmp_path}/mark2", settings, quiet="100s", late="600s").awaitTermination()
    whole = extract_metrics(spark.createDataFrame(first + second, schema.RAW_TRACES), layers, settings)
    assert sorted(map(tuple, store.read().select(*KEPT).collect())) == sorted(map(tuple, whole.select(*KEPT).collect()))
    assert not store.files.list("raw")


def test_a_replayed_batch_is_committed_once(spark, tmp_path):
    rows = spark.createDataFrame([(*r, 1) for r in frame()], schema.StructType([*schema.RAW_TRACES, schema.StructField("version", schema.IntegerType())]))
    layers = spark.createDataFrame(picks(), schema.PICKS)
    store = SnapshotStore(spark, f"{tmp_path}/store")
    assert stateful.store_closed(store, rows, layers, SETTINGS, 4, "a")
    assert stateful.store_closed(store, rows, layers, SETTINGS, 4, "a") is None
    assert store.read().count() == 10 and len(store.log()) == 1
    again = rows.withColumn("version", F.lit(2))
    assert stateful.store_closed(store, again, layers, SETTINGS, 5, "a")
    assert store.read().count() == 10 and len(store.log()) == 2
