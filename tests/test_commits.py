"""Writers beside each other, and changes between snapshots."""

import pytest
from pyspark.sql import functions as F

from firnline import schema
from firnline.plans.extract import extract_metrics
from firnline.sources.snapshots import Conflict, SnapshotStore, compact
from test_traces import SETTINGS, frame, picks

NAMES = ["Data_20120101_01_001", "Data_20120101_01_002", "Data_20120101_01_003"]


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    raw = spark.createDataFrame(sum((frame(n, seed=k) for k, n in enumerate(NAMES)), []), schema.RAW_TRACES)
    path = str(tmp_path_factory.mktemp("parts"))
    extract_metrics(raw, spark.createDataFrame(picks(), schema.PICKS), SETTINGS).write.mode("overwrite").parquet(path)
    rows = spark.read.schema(schema.TRACES).parquet(path)
    return [rows.where(F.col("frame_id") == n) for n in NAMES]


def frames_of(store):
    return {r["frame_id"]: r["count"] for r in store.read().groupBy("frame_id").count().collect()}


def test_writers_of_other_frames_both_land(spark, tmp_path, parts):
    store = SnapshotStore(spark, f"{tmp_path}/store")
    first = store.session()
    first.append(parts[0])
    first.update_frames()
    first.commit("one")
    a, b, c = store.session(), store.session(), store.session()
    a.append(parts[1])
    a.update_frames()
    b.append(parts[2])
    b.update_frames()
    c.remove(parts[0].select("frame_id").distinct())
    a.commit("two")
    b.commit("three")  # on top of two
    c.commit("less")  # removes from a folder that both left alone
    assert frames_of(store) == {NAMES[1]: 10, NAMES[2]: 10}
    assert [s.message for s in store.log()] == ["less", "three", "two", "one"] and store.log()[1].parent == store.log()[2].id
    assert sorted(r["frame_id"] for r in store.frame_dim(store.log()[1].id).collect()) == NAMES


def test_writers_of_the_same_frames_conflict(spark, tmp_path, parts):
    store = SnapshotStore(spark, f"{tmp_path}/store")
    a, b = store.session(), store.session()
    a.append(parts[0])
    b.append(parts[0])
    a.commit("one")
    with pytest.raises(Conflict):
        b.commit("same frame")
    a, b = store.session(), store.session()
    a.remove(parts[0].select("frame_id").distinct())
    a.append(parts[1])
    b.remove(parts[0].select("frame_id").distinct())
    a.commit("two")
    with pytest.raises(Conflict):
        b.commit("same folder")
    assert frames_of(store) == {NAMES[1]: 10}


def test_changes_between_snapshots(spark, tmp_path, parts):
    store = SnapshotStore(spark, f"{tmp_path}/store")
    ids = []
    session = store.session()
    session.append(parts[0].union(parts[1]))
    ids.append(session.commit("two frames"))
    session = store.session()
    session.remove(parts[1].select("frame_id").distinct())
    session.append(parts[2].union(parts[2].limit(1)))
    ids.append(session.commit("one goes, one comes"))
    count = lambda *a: {(r["change"], r["frame_id"]): r["count"] for r in store.changes(*a).groupBy("change", "frame_id").count().collect()}
    assert count(ids[0]) == {("insert", NAMES[2]): 11, ("delete", NAMES[1]): 10}
    assert count(ids[1], ids[0]) == {("delete", NAMES[2]): 11, ("insert", NAMES[1]): 10}
    assert count(None, ids[0]) == {("insert", NAMES[0]): 10, ("insert", NAMES[1]): 10} and count(ids[1]) == {}
    assert "would become" in compact(store, 1, dry_run=True) and compact(store, 1) and compact(store, 1) is None
    assert count(ids[1]) == {}  # compacted rows are the same rows
