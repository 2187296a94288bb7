"""Incremental runs: catalogue in, metrics out, one snapshot per batch of frames."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firnline.config import resolve
from firnline.functions import geo
from firnline.functions.values import duration_micros
from firnline.operators import frames as frame_ops
from firnline.operators import spatial
from firnline.plans.extract import extract_metrics, frame_fractions
from firnline.sources import radargrams
from firnline.sources.snapshots import NothingWritten, SnapshotStore


def select_frames(
    frames: DataFrame, query: dict[str, Any], box: tuple[float, float, float, float] | None = None, shape: list | None = None, without: list | None = None,
    tracks: DataFrame | None = None, shapes: DataFrame | None = None, side: float = 5_000.0,
) -> DataFrame:
    """Catalogue query: collections, segments, bounding box, polygons to meet and not to meet, and a limit; filters on
    columns reach the scan. ``shape`` and ``without`` are polygons that a frame's box is held against; with ``shapes``,
    a table of them (shape_id, parts), and ``tracks`` (frame_id, slow_time, x, y), the frames stay whose line meets one."""
    if query.get("collections"):
        frames = frames.where(F.col("collection").isin(list(query["collections"])))
    if query.get("segment_paths"):
        frames = frames.where(F.col("segment_id").isin(list(query["segment_paths"])))
    if box is not None:
        x0, y0, x1, y1 = box
        frames = frames.where((F.col("x_max") >= x0) & (F.col("x_min") <= x1) & (F.col("y_max") >= y0) & (F.col("y_min") <= y1))
    corners = [F.col(c) for c in ("x_min", "y_min", "x_max", "y_max")] if shape or without else []
    if shape:
        frames = frames.where(geo.box_meets(*corners, shape))
    if without:
        frames = frames.where(~geo.box_meets(*corners, without))
    if shapes is not None:
        lines = tracks.join(frames.select("frame_id").distinct(), "frame_id", "left_semi")
        frames = frame_ops.also_in(frames, spatial.lines_meeting(lines, shapes, side))
    if query.get("max_items"):
        frames = frames.orderBy("collection", "frame_id").limit(int(query["max_items"]))
    return frames


#: Frames that a batch names to its source; larger batches are joined.
NAMED = 20_000
#: Raw traces, with ``error`` or without, or a function that reads those of the frames it is given (all, if None).
Raw = DataFrame | Callable[[list[str] | None], DataFrame]


def frame_files(spark: SparkSession, path: str, **options: str) -> Callable[[list[str] | None], DataFrame]:
    """Reads frames from files, of a batch those of its frames; files that can't be read give a row that says so."""
    radargrams.register(spark)

    def read(ids: list[str] | None) -> DataFrame:
        reader = spark.read.format("frames").option("path", path).option("report", "true").options(**options)
        return (reader if ids is None else reader.option("frames", ",".join(ids))).load()

    return read


def _of_frames(raw: Raw, chosen: DataFrame, ids: list[str] | None) -> DataFrame:
    """Named frames reach the scan, as a filter or as a choice of files; so no batch copies or reads all of raw."""
    if not isinstance(raw, DataFrame):
        rows = raw(ids)
    else:
        rows = raw if ids is None else raw.where(F.col("frame_id").isin(ids))
    return rows.join(chosen, "frame_id", "left_semi") if ids is None else rows


def _outcomes(chosen: DataFrame, fresh: DataFrame, raw: Raw, named: bool, now: Column) -> DataFrame:
    """What became of each frame. Only frames without rows are looked at again, for what went wrong."""
    done = fresh.select("frame_id").distinct()
    lost = frame_ops.not_in(chosen, done)
    ids = [r["frame_id"] for r in lost.collect()] if named else None
    reason = F.lit(None).cast("string")
    if ids != [] and (own := _of_frames(raw, lost, ids)) is not None and "error" in own.columns:
        said = own.where("error is not null").groupBy("frame_id").agg(F.min("error").alias("error"))
        lost, reason = lost.join(said, "frame_id", "left"), F.col("error")
    at = now.alias("attempted_at")
    return done.select("frame_id", at, F.lit("rows").alias("outcome"), F.lit(None).cast("string").alias("error")).union(lost.select("frame_id", at, F.when(reason.isNotNull(), "failed").otherwise("none"), reason))


def run(store: SnapshotStore, frames: DataFrame, raw: Raw, picks: DataFrame, config: dict[str, Any] | None = None, reprocess: bool = False, message: str | None = None, whole_store: bool = False, now: Column | None = None) -> str | None:
    """Process the frames that the store lacks; returns the last snapshot's id, or None if there was nothing to do.

    With ``reprocess`` the selected frames are done again; rows of other collections stay unless ``whole_store``.
    Frames of the store that the selected collections no longer list are removed if ``remove_out_of_scope``. Frames are
    committed in batches of ``checkpoint_every``, each after the frames before it, so a run that stops can go on.
    A frame that can't be read, or gives no rows, is recorded and rests for ``retry_after``, longer each time (up to
    ``retry_most``); reprocessing doesn't wait. ``now`` stands in for the current time.
    """
    config = resolve(config)
    now = F.current_timestamp() if now is None else now
    wanted = select_frames(frames, config["query"]).select("frame_id", "segment_id", "collection")
    session = store.session()
    if reprocess:
        if whole_store:
            session.clear()
        todo = wanted
    else:
        rest = [duration_micros(config["processing"][k]) // 1_000_000 for k in ("retry_after", "retry_most")]
        todo = frame_ops.due(frame_ops.not_in(wanted, store.processed()), store.attempts(), now, *rest)
    orphans = store.read(columns=["frame_id", "collection"]).distinct()
    if not whole_store:
        orphans = orphans.join(wanted.select("collection").distinct(), "collection", "left_semi")
    orphans = frame_ops.not_in(orphans, wanted).select("frame_id")
    if config["store"]["remove_out_of_scope"]:
        session.remove(orphans)

    size = int(config["processing"]["checkpoint_every"] or 0)
    total = todo.count()
    if not total and not session.dirty:
        return None
    batches = max(1, -(-total // size)) if size else 1
    placed = frame_ops.frame_index(todo, order=("collection",)).withColumn("_batch", (F.col("frame_index") % batches).cast("int")).select("frame_id", "_batch").cache()
    named = -(-total // batches) <= NAMED
    written, rows_written, last = 0, 0, None
    try:
        for batch in range(batches if total else 0):
            chosen = placed.where(F.col("_batch") == batch).select("frame_id")
            own = _of_frames(raw, chosen, [r["frame_id"] for r in chosen.collect()] if named else None)
            if "error" in own.columns:
                own = own.where("error is null").drop("error")
            if reprocess and not whole_store:
                session.remove(chosen)
            before = session.dirty
            session.append(extract_metrics(own, picks, config))
            fresh = store.spark.read.schema(session.rows().schema).parquet(f"{store.root}/{session.data[-1]}")
            n_frames, n_rows = fresh.agg(F.count_distinct("frame_id"), F.count("*")).first()
            store.record_attempts(_outcomes(chosen, fresh, raw, named, now))
            written, rows_written = written + n_frames, rows_written + n_rows
            if reprocess and batch == batches - 1 and not written:
                raise NothingWritten("no frame gave rows; the store is as it was")
            if not n_rows:
                session.data.pop()
                session.dirty = before
                continue
            session.update_frames(frame_fractions(fresh, picks, frames))
            if batch < batches - 1:
                last = session.commit(f"[checkpoint] {written}/{total} frames ({rows_written} traces)")
    finally:
        placed.unpersist()
    if not written and not session.dirty:
        return last
    if not written:
        session.update_frames()
    summary = f"{written} frames ({rows_written} traces)"
    chosen = config["query"].get("collections")
    text = f"[run] {message}\n\n{summary}" if message else f"[run] {', '.join(chosen)}: {summary}" if chosen else f"[run] {summary}"
    return session.commit(text)
