"""Continuous ingestion: raw traces arrive as files, each micro-batch becomes one snapshot.

The batch functions are the same as for a run. Raw traces land in a folder per batch beside the snapshots. A frame whose
files fall into several batches is extracted again from all of its traces, so decimation and gates see it whole, and a
batch that is replayed after a failure gives the same rows again: every frame is in the table once.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from firnline.operators import frames as frame_ops
from firnline.plans.extract import extract_metrics
from firnline.schema import RAW_TRACES
from firnline.sources.snapshots import SnapshotStore


def landed(store: SnapshotStore, but: int | None = None) -> DataFrame:
    """All raw traces that came in, a folder per micro-batch, without those of one batch."""
    if not store.files.list("raw"):
        return store.spark.createDataFrame([], RAW_TRACES)
    rows = store.spark.read.schema(StructType([*RAW_TRACES, StructField("batch", IntegerType())])).parquet(f"{store.root}/raw")
    return (rows if but is None else rows.where(F.col("batch") != but)).select(*RAW_TRACES.names)


def ingest_batch(store: SnapshotStore, raw: DataFrame, picks: DataFrame, config: dict[str, Any] | None, batch: int) -> str | None:
    """Frames that the batch brings traces of are extracted from all their traces so far, and replace what was there."""
    key = ["frame_id", "slow_time"]
    before = landed(store, batch)
    raw.dropDuplicates(key).join(before.select(*key), key, "left_anti").select(*RAW_TRACES.names).write.mode("overwrite").parquet(f"{store.root}/raw/batch={batch}")
    fresh = store.spark.read.schema(RAW_TRACES).parquet(f"{store.root}/raw/batch={batch}")
    touched = fresh.select("frame_id").distinct()
    if touched.isEmpty():
        return None
    whole = fresh.union(frame_ops.also_in(before, touched))
    session = store.session()
    session.remove(touched)
    session.append(extract_metrics(whole, picks, config))
    folder = session.data[-1]
    if store.spark.read.schema(session.rows().schema).parquet(f"{store.root}/{folder}").isEmpty() and len(session.data) == 1:
        return None
    session.update_frames()
    return session.commit(f"[checkpoint] batch {batch}")


def ingest(spark: SparkSession, path: str, picks: DataFrame, store: SnapshotStore, checkpoint: str, config: dict[str, Any] | None = None, files_per_batch: int = 64, once: bool = True) -> StreamingQuery:
    """Start the stream over Parquet files of raw traces; with ``once`` it ends when what is there is done."""
    source = spark.readStream.schema(RAW_TRACES).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    writer = source.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda rows, n: ingest_batch(store, rows, picks, config, n))
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="30 seconds")).start()


def windowed_counts(events: DataFrame, time: str = "slow_time", width: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """Traces per frame and time window of a stream or a table; events later than ``late`` are left out of a stream."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), "frame_id").agg(F.count("*").alias("n_traces"))
