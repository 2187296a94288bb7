"""The store as a sink: two-phase commits of batches and streams."""

import os

import pytest
from pyspark.sql import functions as F

from firnline import schema
from firnline.plans.extract import extract_metrics
from firnline.sources import sink
from firnline.sources.snapshots import Conflict, SnapshotStore
from test_traces import SETTINGS, frame, picks


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    sink.register(spark)
    raw = spark.createDataFrame(frame() + frame("Data_20120101_01_002", seed=2), schema.RAW_TRACES)
    path = str(tmp_path_factory.mktemp("rows"))
    extract_metrics(raw, spark.createDataFrame(picks(), schema.PICKS), SETTINGS).write.mode("overwrite").parquet(path)
    return spark.read.schema(schema.TRACES).parquet(path)


def staged(store):
    return [f for _, _, names in os.walk(f"{store.root}/staging") for f in names]


def visible(store):
    return sorted(tuple(r) for r in store.read().select("frame_id", "slow_time", "bed_power_dB", "qc_pass", "collection").collect())


def test_writes_are_commits(spark, tmp_path, rows):
    store = SnapshotStore(spark, f"{tmp_path}/store")
    write = rows.repartition(3).write.format("firnline").option("path", store.root)
    write.mode("append").option("message", "first").save()
    assert visible(store) == sorted(tuple(r) for r in rows.select("frame_id", "slow_time", "bed_power_dB", "qc_pass", "collection").collect())
    assert [s.message for s in store.log()] == ["first"] and not staged(store)
    rows.select("frame_id", "slow_time").limit(4).write.format("firnline").option("path", store.root).mode("append").save()
    assert store.read().count() == 24 and store.read().where("bed_twtt is null").count() == 4
    session = store.session()  # what the sink wrote can be worked on
    session.remove(rows.select("frame_id").limit(1))
    session.commit("removed")
    rows.write.format("firnline").option("path", store.root).mode("overwrite").save()
    assert store.read().count() == 20 and len(store.log()) == 4 and store.read(store.log()[-1].id).count() == 20
    with pytest.raises(Exception, match="columns that the table"):
        rows.withColumn("other", F.lit(1)).write.format("firnline").option("path", store.root).mode("append").save()


def test_a_failed_job_leaves_nothing(spark, tmp_path, rows):
    store = SnapshotStore(spark, f"{tmp_path}/store")
    rows.write.format("firnline").option("path", store.root).mode("append").save()
    bad = rows.repartition(4, "slow_time").withColumn("bed_twtt", F.when(F.col("slow_time") == F.lit(rows.first()["slow_time"]), F.raise_error("broken")).otherwise(F.col("bed_twtt")).cast("double"))
    with pytest.raises(Exception, match="broken"):
        bad.write.format("firnline").option("path", store.root).mode("append").save()
    assert store.read().count() == 20 and len(store.log()) == 1


def test_attempts_that_nobody_reports_are_not_seen(spark, tmp_path, rows):
    """A task that runs twice, or ends after the commit, adds nothing."""
    store = SnapshotStore(spark, f"{tmp_path}/store")
    writer = sink._Writer({"path": store.root}, rows.schema, False)
    batches = rows.toArrow().to_batches()
    writer.write(iter(batches))  # its executor is lost before it reports
    done = writer.write(iter(batches))
    writer.commit([done, None])
    late = writer.write(iter(batches))
    assert store.read().count() == 20 and done.rows == late.rows == 20 and len(staged(store)) == 2
    with pytest.raises(Conflict):  # the branch has moved since the writer was made
        writer.commit([late])
    assert store.read().count() == 20 and len(staged(store)) == 1


def test_streams_commit_each_batch_once(spark, tmp_path, rows):
    store = SnapshotStore(spark, f"{tmp_path}/store")
    rows.coalesce(1).write.parquet(f"{tmp_path}/in")

    def once():
        stream = spark.readStream.schema(schema.TRACES).parquet(f"{tmp_path}/in")
        stream.writeStream.format("firnline").option("path", store.root).option("name", "s").option("checkpointLocation", f"{tmp_path}/mark").trigger(availableNow=True).start().awaitTermination()

    once()
    once()
    assert store.read().count() == 20 and store.log()[0].message == "[stream s] batch 0"
    rows.limit(3).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    once()
    assert store.read().count() == 23 and len(store.log()) == 2
    again = sink._StreamWriter({"path": store.root, "name": "s"}, rows.schema)
    again.commit([again.write(iter(rows.toArrow().to_batches()))], 1)  # the driver stopped before it noted the commit
    assert store.read().count() == 23 and len(store.log()) == 2 and not staged(store)
