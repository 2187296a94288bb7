"""Reports over the trace table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firnline.functions import arrays, geo, physics
from firnline.functions.values import instrument_of
from firnline.operators import crossovers as cross
from firnline.operators import distributions as dist
from firnline.operators import matching, quality, spatial
from firnline.operators.parts import parts_of


#: Differences over this count as large.
LARGE_DB = 8.0


def projected(rows: DataFrame, to: geo.Polar, latitude: str = "latitude", longitude: str = "longitude") -> DataFrame:
    x, y = geo.project(F.col(latitude), F.col(longitude), to)
    return rows.withColumns({"x": x, "y": y})


def crossover_report(traces: DataFrame, threshold: float, variables: Sequence[str], to: geo.Polar = geo.ANTARCTIC) -> tuple[DataFrame, DataFrame]:
    """(crossovers, their summary) of passing traces."""
    found = cross.find_crossovers(projected(quality.passing(traces), to), threshold, variables)
    return found, dist.difference_summary(found, variables)


def season_crossover_report(traces: DataFrame, frames: DataFrame, threshold: float, variables: Sequence[str], target: str, to: geo.Polar = geo.ANTARCTIC) -> tuple[DataFrame, DataFrame]:
    found, _ = crossover_report(traces, threshold, variables, to)
    mixed = cross.across_seasons(cross.with_collections(found, frames), target)
    return mixed, dist.difference_summary(mixed, variables)


def dataset_comparison(own: DataFrame, other: DataFrame, threshold: float, own_id: str, other_id: str, own_value: str, other_value: str, one_to_one: bool = True) -> DataFrame:
    """Matched pairs with ``diff`` = own value - other value; both tables have plane coordinates x, y."""
    right = other.select(F.col(other_id).alias("_other"), F.col("x").alias("_ox"), F.col("y").alias("_oy"), F.col(other_value).alias("_value"))
    match = matching.one_to_one if one_to_one else matching.nearest_within
    pairs = match(own, right, threshold, own_id, "_other", ("x", "y"), ("_ox", "_oy"))
    return pairs.withColumn("diff", F.col(own_value) - F.col("_value"))


def comparison_tables(own: DataFrame, other: DataFrame, pairs: DataFrame, own_id: str, other_id: str, own_value: str, frame: str = "frame_id") -> dict[str, DataFrame]:
    """Reports on matched pairs: ``summary`` of the differences, ``frames`` with one of each frame, ``large`` shares of
    large differences by value, and ``coverage``: how many rows of either side found a partner."""
    sides = (("own", own, own_id, own_id), ("other", other, other_id, "_other"))
    counts = [rows.agg(F.lit(name).alias("side"), F.count("*").alias("n")).join(F.broadcast(pairs.agg(F.count_distinct(key).alias("n_matched"))), F.lit(True)) for name, rows, _, key in sides]  # one row each
    coverage = counts[0].union(counts[1]).withColumn("share", F.try_divide("n_matched", "n"))
    return {"summary": dist.spread_statistics(pairs, "diff"), "frames": dist.spread_statistics(pairs, "diff", [frame]), "large": dist.binned_share(pairs, own_value, [0.0, 10.0, 20.0, 30.0], F.abs("diff") > LARGE_DB), "coverage": coverage}


def sounder_comparison(sounder: DataFrame, own: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Sounder values (flight, point_id, instrument, x, y, ice_thickness, rssnr) against the store's traces (frame_id,
    collection, x, y, thickness, required_surface_snr_dB): (pairs, summary). Each point has the nearest trace within
    ``threshold``, each trace its closest point only; the summary gives both differences per instrument and over all."""
    left = own.select(F.monotonically_increasing_id().alias("_own"), F.col("frame_id").alias("own_frame"), F.col("collection").alias("own_collection"), F.col("x").alias("own_x"), F.col("y").alias("own_y"), F.col("thickness").alias("thickness_own"), F.col("required_surface_snr_dB").alias("rssnr_own"))
    right = sounder.withColumn("_point", F.concat_ws(":", "flight", F.col("point_id").cast("string")))
    pairs = matching.one_to_one(right, left, threshold, "_point", "_own", ("x", "y"), ("own_x", "own_y"))
    pairs = pairs.select("flight", "point_id", "instrument", "own_frame", "own_collection", "distance_m", "x", "y", F.col("ice_thickness").alias("thickness_sounder"), "thickness_own", F.col("rssnr").alias("rssnr_sounder"), "rssnr_own").withColumns({"thickness_diff": F.col("thickness_own") - F.col("thickness_sounder"), "rssnr_diff": F.col("rssnr_own") - F.col("rssnr_sounder")})
    summary = None
    for v in ("rssnr", "thickness"):
        one = dist.summary_with_total(pairs, "instrument", f"{v}_diff").select(F.lit(v).alias("variable"), "*")
        summary = one if summary is None else summary.unionByName(one)
    return pairs, summary


def margin_sweep(traces: DataFrame, margins_m: Sequence[float], permittivity: float = physics.ICE_PERMITTIVITY) -> DataFrame:
    """Peak around ``pick`` for each trace and margin; traces have ``data`` and ``twtt``. The margins are an array column,
    so samples are read once."""
    tried = F.array(*[F.struct(F.lit(float(m)).alias("margin_m"), arrays.window_peak(F.col("data"), F.col("twtt"), F.col("pick"), physics.margin_seconds(m, permittivity)).alias("peak")) for m in margins_m])
    rest = [c for c in traces.columns if c not in ("data", "twtt")]
    return traces.select(*rest, F.explode(tried).alias("_m")).select(*rest, "_m.margin_m", F.col("_m.peak.twtt").alias("peak_twtt"), F.col("_m.peak.power_dB").alias("peak_dB"))


def noise_populations(traces: DataFrame, by: Sequence[str], pre: tuple[float, float], post: tuple[float, float]) -> DataFrame:
    """What the samples of both noise windows look like, per group and ``window`` (pre, post): how many, how many
    differ or are zero, the linear least, median and most, and in decibels p1, p99, their spread and the deviation.

    ``traces`` have data, twtt and the picks ``surface`` and ``bed``; those that lack one are left out. Windows end the
    offsets (from the record's and the pick's ends, in the unit of twtt) before and behind the picks.
    """
    t, first, last = F.col("s.t"), F.element_at("twtt", 1), F.element_at("twtt", -1)
    window = F.when((t >= F.col("first") + pre[0]) & (t <= F.col("surface") - pre[1]), "pre").when((t >= F.col("bed") + post[0]) & (t <= F.col("last") - post[1]), "post")
    known = traces.where(quality.finite("surface", "bed"))
    samples = known.select(*by, "surface", "bed", first.alias("first"), last.alias("last"), F.explode(F.arrays_zip(F.col("data").alias("p"), F.col("twtt").alias("t"))).alias("s"))
    rows = samples.select(*by, window.alias("window"), F.col("s.p").cast("double").alias("power")).where("window is not null")
    rows = rows.withColumn("power_dB", 10 * F.log10(F.greatest(F.col("power"), F.lit(1e-40))))
    keys = [*by, "window"]
    linear = dist.population_diagnostics(rows, "power", keys).select(*keys, "n", "n_unique", "n_zero", "min", "median", "max")
    levels = dist.population_diagnostics(rows, "power_dB", keys).select(*[F.col(k).alias(f"_{k}") for k in keys], "p1", "p99", "spread", "std")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return linear.join(levels, same).drop(*[f"_{k}" for k in keys])


def region_distribution(traces: DataFrame, ring: list[tuple[float, float]], variable: str, seasons: Sequence[str] | None = None, per_season: bool = False, points: int = 256) -> DataFrame:
    """(season, x, density) of a variable over passing traces inside a polygon; traces have x, y and collection."""
    flag = quality.mask_of(variable)
    rows = traces.where(geo.in_polygon(F.col("x"), F.col("y"), ring))
    rows = rows.where(F.col(flag)) if flag in rows.columns else rows
    if seasons is not None:
        rows = rows.where(F.col("collection").isin(list(seasons)))
    return dist.density(rows, variable, "collection", points, per_season)


def status_counts(traces: DataFrame, variable: str) -> DataFrame:
    """total, valid and censored traces."""
    censored = quality.censored(F.col("qc_surface_pass"), F.col("bed_pick_attempted"), F.col("bed_pick_available")) if quality.has_censoring(traces) else F.lit(False)
    return traces.agg(F.count("*").alias("total"), F.count_if(F.col(variable).isNotNull()).alias("valid"), F.count_if(censored).alias("censored"))


def extent(rows: DataFrame, x: str = "longitude", y: str = "latitude", padding: float = 0.05) -> DataFrame:
    box = rows.agg(*[f(c).alias(f"{n}_{c}") for c in (x, y) for n, f in (("min", F.min), ("max", F.max))])
    pads = {c: (F.col(f"max_{c}") - F.col(f"min_{c}")) * padding for c in (x, y)}
    return box.select(*[e for c in (x, y) for e in ((F.col(f"min_{c}") - pads[c]).alias(f"min_{c}"), (F.col(f"max_{c}") + pads[c]).alias(f"max_{c}"))])


def grounding_distance(points: DataFrame, boundary: DataFrame, inside: str, reach: float, point_id: str = "point_id") -> DataFrame:
    """Each point's signed distance to the nearest boundary segment (x0, y0, x1, y1) within ``reach``, else NULL.

    Segments meet points through cells as wide as ``reach``: those that a segment runs through, walked along it, and
    their neighbours. So long boundaries need no broadcast.
    """
    along = spatial.cells_along(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"), reach)
    around = F.flatten(F.transform(along, lambda c: F.array(*[c + i * spatial.COLUMN + j for i in (-1, 0, 1) for j in (-1, 0, 1)])))
    segments = boundary.withColumn("_of", F.explode(F.array_distinct(around)))
    placed = points.withColumn("_cell", spatial.cell_of(F.col("x"), F.col("y"), reach))
    d = geo.segment_distance(F.col("x"), F.col("y"), F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"))
    near = placed.join(segments, F.col("_cell") == F.col("_of")).groupBy(F.col(point_id).alias("_id")).agg(F.min(d).alias("_d"))
    out = points.join(near, F.col(point_id) == F.col("_id"), "left")
    metres = F.when(F.col("_d") <= reach, F.col("_d"))
    return out.withColumn("signed_distance_m", physics.signed_distance(F.col(inside), metres)).drop("_id", "_d")


def beyond_grounding(rows: DataFrame, metres: float, distance_km: str = "gl_dist_km") -> DataFrame:
    """Points at least so far on the grounded side of the grounding line."""
    return rows.where(F.col(distance_km) >= metres / 1000)


def display_clip(traces: DataFrame, by: Sequence[str], surface: str = "surface", bed: str = "bed", pad: float = 3.0) -> DataFrame:
    """Traces whose ``data`` and ``twtt`` end ``pad`` before the frame's first surface and after its last bed."""
    ends = traces.groupBy(*[F.col(c).alias(f"_{c}") for c in by]).agg((F.min(surface) - pad).alias("_low"), (F.coalesce(F.max(bed), F.max(surface)) + pad).alias("_high"))
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    placed = traces.join(ends, same)  # picks are gathered per frame, samples are not
    cut = lambda c: arrays.samples_between(F.col(c), F.col("twtt"), F.col("_low"), F.col("_high"))
    return placed.select(*[c for c in traces.columns if c not in ("data", "twtt")], cut("data").alias("data"), cut("twtt").alias("twtt"))


def tail_sensitivity(traces: DataFrame, by: Sequence[str], grid: Sequence[float], plateau: tuple[float, float], windows: dict[str, tuple[float, float]], drop_db: float = -1.0) -> DataFrame:
    """Per group: the median profile by time before the record's end, interpolated onto a grid and relative to its
    plateau's median; how far the levels under ``drop_db`` reach from the end, NULL
    if none rises to it; and each window's median, its bias.

    The profile is as long as a record has samples, whatever the number of traces.
    """
    last = F.element_at("twtt", -1)
    samples = traces.select(*by, F.posexplode("data").alias("i", "p"), "twtt", last.alias("last")).where("p > 0")
    samples = samples.withColumn("before_end", F.round(F.col("last") - F.element_at("twtt", F.col("i") + 1), 9))
    medians = dist.interpolated_ranks(samples, "p", {"median": 0.5}, [*by, "before_end"])
    levels = medians.select(*by, "before_end", (F.lit(10.0) * F.log10("median")).alias("level"))
    profile = levels.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("before_end", "level"))).alias("_profile"))
    places = F.array(*[F.lit(float(g)) for g in grid])
    profile = profile.withColumn("_levels", arrays.interpolated(F.col("_profile.before_end"), F.col("_profile.level"), places))
    profile = profile.withColumn("_grid", F.arrays_zip(places.alias("at"), F.col("_levels").alias("level")))
    inside = lambda ends: arrays.median(F.filter(F.transform(F.filter("_grid", lambda g: (g["at"] >= ends[0]) & (g["at"] <= ends[1])), lambda g: g["level"]), lambda v: v.isNotNull()))
    profile = profile.withColumn("plateau_dB", inside(plateau))
    low = F.filter("_grid", lambda g: (g["level"] - F.col("plateau_dB") >= drop_db) | g["level"].isNull())
    reach = F.array_min(F.transform(F.filter(low, lambda g: g["level"].isNotNull()), lambda g: g["at"]))
    return profile.select(*by, "plateau_dB", reach.alias("rolloff_until"), *[(inside(ends) - F.col("plateau_dB")).alias(f"bias_{name}") for name, ends in windows.items()])


def rolloff_profile(traces: DataFrame, by: Sequence[str], step: float, plateau: tuple[float, float], drop_db: float = -1.0) -> DataFrame:
    """Per group: median level by time before the record's end, relative to a plateau's median, and how far the first
    run of levels under ``drop_db`` reaches from the end. Traces have ``data`` (linear) and ``twtt``."""
    last = F.element_at("twtt", -1)
    samples = traces.select(*by, F.posexplode("data").alias("i", "p"), "twtt", last.alias("last"))
    samples = samples.withColumn("before_end", F.col("last") - F.element_at("twtt", F.col("i") + 1)).where("p > 0")
    placed = samples.withColumn("bin", F.round(F.col("before_end") / step).cast("int"))
    medians = dist.interpolated_ranks(placed, "p", {"median": 0.5}, [*by, "bin"])
    profile = medians.select(*by, "bin", (F.lit(10.0) * F.log10("median")).alias("level_dB"))
    low, high = (int(round(p / step)) for p in plateau)
    base = profile.where(F.col("bin").between(low, high)).groupBy(*by).agg(F.expr("percentile(level_dB, 0.5D)").alias("base_dB"))
    relative = profile.join(base, list(by)).withColumn("relative_dB", F.col("level_dB") - F.col("base_dB"))
    w = Window.partitionBy(*by).orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    below = F.min((F.col("relative_dB") < drop_db).cast("int")).over(w)
    return relative.withColumn("in_rolloff", below == 1).withColumn("before_end", F.col("bin") * step).drop("bin")


def eligibility(frames: DataFrame, rows: DataFrame, sample: int = 2) -> DataFrame:
    """Per collection: frames probed (the first few), frames that gave rows, and the share of traces with a bed."""
    n = F.row_number().over(Window.partitionBy("collection").orderBy("frame_id"))
    probed = frames.withColumn("_n", n).where(F.col("_n") <= sample).select("frame_id", "collection")
    per_frame = rows.groupBy("frame_id").agg(F.avg(F.col("bed_power_dB").isNotNull().cast("double")).alias("bed_share"))
    return probed.join(per_frame, "frame_id", "left").groupBy("collection").agg(F.count("*").alias("n_probed"), F.count("bed_share").alias("n_eligible"), F.avg("bed_share").alias("bed_share"))


def product_comparison(a: DataFrame, b: DataFrame, keys: Sequence[str], variables: Sequence[str]) -> DataFrame:
    """Two data products of the same traces: medians, standard deviations and the median's difference."""
    sides = a.select(*keys, *[F.col(v).alias(f"{v}_a") for v in variables]).join(b.select(*keys, *[F.col(v).alias(f"{v}_b") for v in variables]), list(keys))
    long = sides.select(F.explode(F.array(*[F.struct(F.lit(v).alias("variable"), F.col(f"{v}_a").alias("a"), F.col(f"{v}_b").alias("b")) for v in variables])).alias("v")).select("v.*")
    long = long.where("a is not null and b is not null")
    out = long.groupBy("variable").agg(F.count("*").alias("n"), *[F.stddev_pop(s).alias(f"std_{s}") for s in "ab"])
    for s in "ab":
        out = out.join(dist.interpolated_ranks(long, s, {f"median_{s}": 0.5}, ["variable"]).drop("n"), "variable")
    return out.withColumn("median_difference", F.col("median_a") - F.col("median_b"))


def differing_rows(a: DataFrame, b: DataFrame, keys: Sequence[str], variable: str, tolerance: float) -> DataFrame:
    """Shared rows whose values differ by more than a relative tolerance, or of which one is missing."""
    n = parts_of(a, b)
    left, right = (t.select(*keys, F.col(variable).alias(c)).repartition(n, *keys) for t, c in ((a, "a"), (b, "b")))
    both = left.join(right.hint("merge"), list(keys))
    apart = F.abs(F.col("a") - F.col("b")) > F.abs(F.col("b")) * tolerance
    return both.where((F.col("a").isNull() != F.col("b").isNull()) | F.coalesce(apart, F.lit(False)))


def sounder_status(results: DataFrame, radargrams: DataFrame, reach: float = 500.0, margin_m: float = 50.0) -> DataFrame:
    """Every sounder pick with what became of it: ``ok`` and its RSSNR, ``no value``, ``no radargram``, ``too far`` or
    ``outside record``."""
    done = sounder_rssnr(results, radargrams, reach, margin_m).select("flight", "point_id", "rssnr", F.lit(True).alias("_done"))
    known = radargrams.select("flight").distinct().withColumn("_known", F.lit(True))
    traces = radargrams.select(F.col("flight").alias("_flight"), "trace_id", F.col("x").alias("_tx"), F.col("y").alias("_ty"))
    near = matching.nearest_within(results.select("flight", "point_id", "x", "y"), traces, reach, "point_id", "trace_id", ("x", "y"), ("_tx", "_ty"), ("flight", "_flight"))
    near = near.select("flight", "point_id").distinct().withColumn("_near", F.lit(True))
    rows = results.join(known, "flight", "left").join(near, ["flight", "point_id"], "left").join(done, ["flight", "point_id"], "left")
    good = quality.finite("radar_height", "ice_thickness") & (F.col("radar_height") > 0) & (F.col("ice_thickness") > 0)
    status = F.when(F.col("_done"), "ok").when(~good, "no value").when(F.col("_known").isNull(), "no radargram").when(F.col("_near").isNull(), "too far").otherwise("outside record")
    return rows.select("flight", "point_id", status.alias("status"), "rssnr")


def sounder_rssnr(results: DataFrame, radargrams: DataFrame, reach: float = 500.0, margin_m: float = 50.0) -> DataFrame:
    """RSSNR at sounder picks: results (flight, point_id, x, y, radar_height, ice_thickness) matched to the nearest trace
    (flight, trace_id, x, y, twtt, low_gain, high_gain) of their flight within ``reach``."""
    good = results.where(quality.finite("radar_height", "ice_thickness") & (F.col("radar_height") > 0) & (F.col("ice_thickness") > 0))
    traces = radargrams.select(F.col("flight").alias("_flight"), "trace_id", F.col("x").alias("_tx"), F.col("y").alias("_ty"))
    placed = matching.nearest_within(good, traces, reach, "point_id", "trace_id", ("x", "y"), ("_tx", "_ty"), ("flight", "_flight")).drop("_flight", "_tx", "_ty")
    rows = placed.join(radargrams.select("flight", "trace_id", "twtt", "low_gain", "high_gain"), ["flight", "trace_id"])
    t_s, t_b = physics.sounder_times(F.col("radar_height"), F.col("ice_thickness"))
    rows = rows.withColumns({"surface_time": t_s, "bed_time": t_b, "instrument": instrument_of(F.col("flight"))})
    rows = rows.where((F.col("surface_time") >= F.element_at("twtt", 1)) & (F.col("bed_time") <= F.element_at("twtt", -1)) & (F.col("bed_time") > F.col("surface_time")))
    eps = physics.SOUNDER_ICE_INDEX**2
    margin = physics.margin_seconds(margin_m, eps)
    two = F.col("instrument") == "HiCARS"
    low = arrays.window_max_db(F.col("low_gain"), F.col("twtt"), F.col("surface_time"), margin)
    deep = arrays.window_max_db(F.when(two, F.col("high_gain")).otherwise(F.col("low_gain")), F.col("twtt"), F.col("bed_time"), margin)
    deep = F.when(two, deep - physics.HIGH_GAIN_DB).otherwise(deep)
    rssnr = physics.required_surface_snr_db(low, deep, F.col("surface_time"), F.col("bed_time"), eps)
    return rows.select("flight", "point_id", "trace_id", "instrument", "ice_thickness", "distance_m", low.alias("surface_power_dB"), deep.alias("bed_power_dB"), rssnr.alias("rssnr"))
