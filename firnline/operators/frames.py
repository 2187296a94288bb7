"""Frames as a dimension: incremental sets, indexes and attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def not_in(left: DataFrame, right: DataFrame, key: str = "frame_id") -> DataFrame:
    """Rows whose key the other table lacks: new frames, orphans, rows left after a removal."""
    return left.join(right.select(key).distinct(), key, "left_anti")


def also_in(left: DataFrame, right: DataFrame, key: str = "frame_id") -> DataFrame:
    return left.join(right.select(key).distinct(), key, "left_semi")


def frame_index(traces: DataFrame, frame: str = "frame_id", order: Sequence[str] = ("collection", "frame_id")) -> DataFrame:
    """(frame, frame_index): dense numbers from 0 in a fixed order, whatever order rows arrived in.

    The window covers frames, a table thousands of times shorter than its traces.
    """
    firsts = traces.groupBy(frame).agg(*[F.min(c).alias(f"_o{i}") for i, c in enumerate(order)])
    number = F.row_number().over(Window.orderBy(*[f"_o{i}" for i in range(len(order))], frame)) - 1
    return firsts.select(frame, number.cast("int").alias("frame_index"))


def merge_attributes(current: DataFrame, old: DataFrame, new: DataFrame, attributes: dict[str, object], frame: str = "frame_id") -> DataFrame:
    """The current frames with each attribute from ``new``, else ``old``, else the given default."""
    before = old.select(F.col(frame).alias("_old"), *[F.col(a).alias(f"_old_{a}") for a in attributes])
    after = new.select(F.col(frame).alias("_new"), *[F.col(a).alias(f"_new_{a}") for a in attributes])
    joined = current.select(frame).distinct().join(before, F.col(frame) == F.col("_old"), "left").join(after, F.col(frame) == F.col("_new"), "left")
    return joined.select(frame, *[F.coalesce(F.col(f"_new_{a}"), F.col(f"_old_{a}"), F.lit(default)).alias(a) for a, default in attributes.items()])


def layer_by_priority(picks: DataFrame, by: Sequence[str], names: Sequence[str], layer: str = "layer_key") -> DataFrame:
    """Picks of the first of ``names`` that a segment has."""
    rank = F.lit(None).cast("int")
    for i, name in reversed(list(enumerate(names))):
        rank = F.when(F.col(layer) == name, i).otherwise(rank)
    ranked = picks.withColumn("_rank", rank).where(F.col("_rank").isNotNull())
    best = F.min("_rank").over(Window.partitionBy(*by))
    return ranked.withColumn("_best", best).where("_rank = _best").drop("_rank", "_best")


def rows_of_frame(traces: DataFrame, name: str, frame: str = "frame_id", order: str = "slow_time") -> DataFrame:
    """One frame's rows in time order; an error if it has none."""
    rows = traces.where(F.col(frame) == name)
    if rows.isEmpty():
        raise LookupError(f"no rows of frame {name!r}")
    return rows.orderBy(order)


def of_collections(traces: DataFrame, frames: DataFrame, names: Sequence[str], frame: str = "frame_id", collection: str = "collection") -> DataFrame:
    """Traces whose frame belongs to one of the collections."""
    return also_in(traces, frames.where(F.col(collection).isin(list(names))), frame)


def listed(frames: DataFrame, *columns: str) -> DataFrame:
    """Distinct names in order, for showing."""
    return frames.select(*columns).distinct().orderBy(*columns)


def catalogued(stored: DataFrame, catalogue: DataFrame, frame: str = "frame_id") -> tuple[DataFrame, DataFrame]:
    """(stored frames with the catalogue's columns, stored frames that it lacks)."""
    own = stored.select(frame).distinct()
    return own.join(catalogue.dropDuplicates([frame]), frame), not_in(own, catalogue, frame)


def find_regions(regions: DataFrame, **wanted: str | Sequence[str] | None) -> DataFrame:
    """Regions by area, name, type, region or subregion: each a value or several; None asks for nothing."""
    for column, values in wanted.items():
        if values is not None:
            regions = regions.where(F.col(column).isin([values] if isinstance(values, str) else list(values)))
    return regions


def with_any_pick(traces: DataFrame, picks: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Traces of segments with at least one known pick; decided before any sample is read."""
    return traces.join(picks.where(F.col(value).isNotNull()).select(*by).distinct(), list(by), "left_semi")


def with_shelves(regions: DataFrame, chosen: Column) -> DataFrame:
    """The chosen regions and the floating shelves they name, separated by slashes, in ``asso_shelf``."""
    own = regions.where(chosen)
    named = own.select(F.explode(F.split("asso_shelf", "/")).alias("n")).select(F.trim("n").alias("_name")).where("_name <> ''").distinct()
    shelves = regions.where("type = 'FL'").join(named, F.col("name") == F.col("_name"), "left_semi")
    return own.unionByName(shelves).distinct()


def first_seen(history: DataFrame, frame: str = "frame_id", sequence: str = "sequence", written: str = "written_at") -> DataFrame:
    """When each frame was first in a snapshot."""
    return history.groupBy(frame).agg(F.min_by(written, sequence).alias("first_written_at"), F.min(sequence).alias("first_sequence"))


def collection_status(frames: DataFrame, processed: DataFrame, seen: DataFrame, frame: str = "frame_id", collection: str = "collection") -> DataFrame:
    """Per collection: frames, processed ones, and when the last of them was written."""
    done = processed.select(frame).distinct().withColumn("_done", F.lit(True))
    joined = frames.select(frame, collection).distinct().join(done, frame, "left").join(seen.select(frame, "first_written_at"), frame, "left")
    return joined.groupBy(collection).agg(F.count("*").alias("n_frames"), F.count_if(F.col("_done")).alias("n_processed"), F.max(F.when(F.col("_done"), F.col("first_written_at"))).alias("last_processed"))


def due(frames: DataFrame, attempts: DataFrame, now: Column, wait: int, most: int, frame: str = "frame_id") -> DataFrame:
    """Frames to try: those without a failure since their last rows, and those whose last try is ``wait`` seconds back,
    twice that after each further failure, ``most`` at most."""
    at, ok = F.col("attempted_at"), F.col("outcome") == "rows"
    tried = attempts.groupBy(frame).agg(F.max(at).alias("_last"), F.max(F.when(ok, at)).alias("_ok"), F.collect_list(F.when(~ok, at)).alias("_bad"))
    failures = F.size(F.filter("_bad", lambda t: F.col("_ok").isNull() | (t > F.col("_ok"))))
    pause = F.least(F.lit(float(most)), wait * F.pow(F.lit(2.0), F.least(failures, F.lit(60)) - 1))
    resting = tried.where((failures > 0) & (F.unix_micros(now) < F.unix_micros("_last") + pause * 1e6))
    return not_in(frames, resting, frame)
