"""From raw traces and layer picks to the trace table: one row of metrics per decimated trace."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firnline.config import TIGHT_TOLERANCE, WIDE_TOLERANCE, check_limits, resolve
from firnline.functions import arrays, physics
from firnline.functions.values import duration_micros, micros
from firnline.operators import frames as frame_ops
from firnline.operators import quality, time_axis
from firnline.schema import conform

SURFACE_LAYERS = ("standard:surface", ":surface")
BED_LAYERS = ("standard:bottom", ":bottom")


def extract_metrics(raw: DataFrame, picks: DataFrame, config: dict[str, Any] | None = None) -> DataFrame:
    """Rows of the trace table for ``raw`` (schema RAW_TRACES) and ``picks`` (schema PICKS).

    Segments without a surface layer, or without any known bed pick, give no rows, and are dropped before samples are
    read. Everything is a column expression but the windows over a segment's time axis, so the samples pass one shuffle
    at most: they join the narrow table of windows' results by frame and time.
    """
    config = resolve(config)
    settings, noise, limits = config["processing"], config["processing"]["noise"], check_limits(config)
    permittivity, margin = settings["ice_permittivity"], physics.margin_seconds(settings["layer_margin_m"], settings["ice_permittivity"])
    near, tight = duration_micros(WIDE_TOLERANCE), duration_micros(TIGHT_TOLERANCE)

    clean = picks.withColumns({"t": micros(F.col("slow_time")), "twtt": F.when(~F.isnan("twtt"), F.col("twtt"))}).dropDuplicates(["segment_id", "layer_key", "t"])
    surface = frame_ops.layer_by_priority(clean, ["segment_id"], SURFACE_LAYERS).select("segment_id", "t", F.col("twtt").alias("surface"))
    bed = frame_ops.layer_by_priority(clean, ["segment_id"], BED_LAYERS).select("segment_id", "t", F.col("twtt").alias("bed"), "quality")
    spans = time_axis.picked_span(bed, ["segment_id"], "t", "bed").where("pick_fraction > 0").withColumnRenamed("pick_fraction", "segment_bed_pick_fraction")

    keys = ["segment_id", "frame_id", "t"]
    times = raw.select("segment_id", "frame_id", micros(F.col("slow_time")).alias("t"))
    times = times.join(spans.select("segment_id"), "segment_id", "left_semi").join(surface.select("segment_id").distinct(), "segment_id", "left_semi")
    interval = settings["decimate_interval"]
    times = time_axis.decimate(times, ["segment_id", "frame_id"], "t", duration_micros(interval) if interval else None)
    reach = {"wide_": near, "tight_": tight}
    times = time_axis.nearest(times, surface, ["segment_id"], "t", ["surface"], reach)
    times = time_axis.nearest(times, bed, ["segment_id"], "t", ["bed", "quality"], reach).drop("wide_quality")
    times = time_axis.interpolate(times, bed, ["segment_id"], "t", "bed", "between")
    times = times.join(spans, "segment_id")

    samples = raw.withColumn("t", micros(F.col("slow_time"))).dropDuplicates(keys)
    rows = samples.join(times, keys).withColumn("power", F.transform("data", lambda v: F.abs(v)))
    track = Window.partitionBy("frame_id").orderBy("t")
    rows = rows.withColumns({"heading_step": F.col("heading") - F.lag("heading").over(track), "step_km": _ground_km(track)})

    power, axis = F.col("power"), F.col("twtt")
    first, last = F.element_at(axis, 1), F.element_at(axis, -1)
    us = lambda window, key: noise[window][key] * 1e-6
    rows = rows.withColumns({"surface_pick": F.col("wide_surface"), "bed_pick": F.col("wide_bed")})
    below = lambda pick: (pick + us("post_bed", "start_offset_us"), last - us("post_bed", "end_offset_us"))
    anchor = F.coalesce("wide_bed", "between")
    rows = rows.withColumns({
        "bed_pick_available": F.col("tight_bed").isNotNull(),
        "bed_pick_quality": F.when(F.col("tight_bed").isNotNull() & F.col("tight_quality").isNotNull() & ~F.isnan("tight_quality"), F.col("tight_quality").cast("tinyint")).otherwise(F.lit(-1).cast("tinyint")),
        "_surface": arrays.window_peak(power, axis, F.col("tight_surface"), margin),
        "_bed": arrays.window_peak(power, axis, F.col("tight_bed"), margin),
        "pre_surface_noise_dB": arrays.window_median_db(power, axis, first + us("pre_surface", "start_offset_us"), F.col("wide_surface") - us("pre_surface", "end_offset_us")),
        "post_bed_noise_dB": arrays.window_median_db(power, axis, *below(F.col("wide_bed"))),
        "_interp": arrays.window_metrics(power, axis, *below(anchor)),
        "record_tail_noise_dB": arrays.tail_median_db(power, axis, us("record_tail", "start_offset_us"), us("record_tail", "end_offset_us")),
        "record_end_twtt": last,
    })
    rows = rows.withColumn("bed_pick_attempted", F.col("t").between(F.col("first_pick"), F.col("last_pick")) | F.col("bed_pick_available"))
    rows = rows.withColumns({"bed_pick_power_dB": F.col("_bed.power_dB"), "bed_pick_noise_dB": F.col("post_bed_noise_dB")})
    checks = quality.enabled(limits)
    rows = rows.withColumns(quality.flags(checks))
    if checks:
        rows = quality.enough_traces(rows, ["frame_id"], config["qc"]["min_traces_after_qc"])

    surface_twtt, bed_twtt = F.col("_surface.twtt"), F.when(F.col("bed_pick_available"), F.col("_bed.twtt"))
    bed_db = F.when(F.col("bed_pick_available"), F.col("_bed.power_dB"))
    top = physics.surface_elevation(F.col("elevation"), surface_twtt)
    rows = rows.withColumns({
        "surface_twtt": surface_twtt, "surface_power_dB": F.col("_surface.power_dB"), "bed_twtt": bed_twtt, "bed_power_dB": bed_db,
        "surface_elevation": top, "bed_elevation": physics.bed_elevation(top, surface_twtt, bed_twtt, permittivity),
        "required_surface_snr_dB": physics.required_surface_snr_db(F.col("_surface.power_dB"), bed_db, surface_twtt, bed_twtt, permittivity),
        "post_bed_noise_interp_dB": F.col("_interp.median_dB"), "post_bed_peak_interp_dB": F.col("_interp.peak_dB"), "post_bed_std_interp_dB": F.col("_interp.std_dB"),
    })
    if checks:
        rows = quality.mask(rows)
    from firnline.schema import TRACES

    return conform(rows.select(*[c for c in TRACES.names if c in rows.columns]))


def _ground_km(track):
    """Great-circle kilometres since the previous trace."""
    lat, lon = F.radians("latitude"), F.radians("longitude")
    lat0, lon0 = F.lag(lat).over(track), F.lag(lon).over(track)
    h = F.pow(F.sin((lat - lat0) / 2), F.lit(2)) + F.cos(lat) * F.cos(lat0) * F.pow(F.sin((lon - lon0) / 2), F.lit(2))
    return F.lit(2 * 6371.0) * F.asin(F.sqrt(h))


def frame_fractions(traces: DataFrame, picks: DataFrame, frames: DataFrame) -> DataFrame:
    """(frame_id, collection, frame_bed_pick_fraction, segment_bed_pick_fraction)."""
    own = traces.groupBy("frame_id").agg(F.avg(F.col("bed_pick_available").cast("double")).alias("frame_bed_pick_fraction"))
    bed = frame_ops.layer_by_priority(picks.withColumn("twtt", F.when(~F.isnan("twtt"), F.col("twtt"))), ["segment_id"], BED_LAYERS)
    whole = bed.groupBy("segment_id").agg(F.avg(F.col("twtt").isNotNull().cast("double")).alias("segment_bed_pick_fraction"))
    return own.join(frames.select("frame_id", "segment_id", "collection"), "frame_id").join(whole, "segment_id", "left").select("frame_id", "collection", "frame_bed_pick_fraction", "segment_bed_pick_fraction")
