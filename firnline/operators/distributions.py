"""Summaries of values: differences, percentiles, histograms, densities, correlations.

Percentiles of whole collections are bracketed by sketches; ``percentile``, which keeps a count per distinct value of its
group, is for reports over selected groups. Ranks are found by ranges of values, and everything else is an aggregation
with partial results.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: The sketches that bracket a rank hold it within n / ACCURACY; ranges into which a column is dealt to be ranked.
ACCURACY, RANGES = 10_000, 64
#: Parts that a group's values are dealt into where they meet the group's bounds.
PARTS = 16


def known(value: str) -> Column:
    return F.col(value).isNotNull() & ~F.isnan(value)


def _with_percentiles(stats: DataFrame, rows: DataFrame, value: str, shares: dict[str, float], by: Sequence[str]) -> DataFrame:
    """``stats`` (one row per group) with interpolated percentiles of the group's values."""
    found = interpolated_ranks(rows, value, shares, by).drop("n")
    if not by:
        return stats.join(F.broadcast(found), F.lit(True), "left")  # one row each
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return stats.join(found.select(*[F.col(c).alias(f"_{c}") for c in by], *shares), same, "left").drop(*[f"_{c}" for c in by])


def difference_summary(pairs: DataFrame, variables: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Per variable: N, mean, population std, RMS and median absolute difference, over rows with both sides known."""
    named = F.explode(F.array(*[F.struct(F.lit(v).alias("variable"), F.col(f"{v}_a").cast("double").alias("a"), F.col(f"{v}_b").cast("double").alias("b"), F.col(f"{v}_diff").cast("double").alias("d")) for v in variables]))
    long = pairs.select(*by, named.alias("v")).select(*by, "v.*").where(known("a") & known("b") & known("d"))
    keys = [*by, "variable"]
    out = long.groupBy(*keys).agg(*_difference_statistics("d"))
    return _with_percentiles(out, long.select(*keys, F.abs("d").alias("_m")), "_m", {"median_abs_diff": 0.5}, keys)


def _difference_statistics(d: str) -> list[Column]:
    return [F.count("*").alias("n"), F.avg(d).alias("mean_diff"), F.stddev_pop(d).alias("std_diff"), F.sqrt(F.avg(F.col(d) * F.col(d))).alias("rms_diff")]


def summary_with_total(pairs: DataFrame, group: str, difference: str, total: str = "all") -> DataFrame:
    """The same per group and over all of them; rows without a group count in the total only."""
    rows = pairs.where(known(difference)).select(F.col(group).alias("group"), F.col(difference).cast("double").alias("d"))
    rows = rows.select(F.explode(F.array(F.struct(F.lit(0).alias("_all"), "group"), F.struct(F.lit(1).alias("_all"), F.lit(None).cast("string").alias("group")))).alias("_g"), "d").select("_g.*", "d")
    rows = rows.where("_all = 1 or group is not null")
    rolled = _with_percentiles(rows.groupBy("_all", "group").agg(*_difference_statistics("d")), rows.select("_all", "group", F.abs("d").alias("_m")), "_m", {"median_abs_diff": 0.5}, ["_all", "group"])
    return rolled.withColumn("group", F.when(F.col("_all") == 1, total).otherwise(F.col("group"))).drop("_all")


def spread_statistics(rows: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """mean, std (population and sample), rms, median, p5, p95, min and max of the known values."""
    good = rows.where(known(value))
    out = good.groupBy(*by).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("std_pop"), F.stddev_samp(value).alias("std_samp"), F.sqrt(F.avg(F.col(value) * F.col(value))).alias("rms"), F.min(value).alias("min"), F.max(value).alias("max"))
    return _with_percentiles(out, good, value, {"p5": 0.05, "median": 0.5, "p95": 0.95}, by)


def population_diagnostics(rows: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """How many values, how many differ or are zero, and where they lie."""
    percentiles = F.expr(f"percentile(cast({value} as double), array(0.01D, 0.5D, 0.99D))")
    out = rows.where(known(value)).groupBy(*by).agg(F.count("*").alias("n"), F.count_distinct(F.col(value)).alias("n_unique"), F.count_if(F.col(value) == 0).alias("n_zero"), F.min(value).alias("min"), F.max(value).alias("max"), percentiles.alias("_p"), F.stddev_pop(value).alias("std"))
    return out.withColumns({"p1": F.col("_p")[0], "median": F.col("_p")[1], "p99": F.col("_p")[2]}).withColumn("spread", F.col("p99") - F.col("p1")).drop("_p")


def missing_rates(rows: DataFrame, variables: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Per variable: the share of missing values, and min, median and max of the others."""
    named = F.explode(F.array(*[F.struct(F.lit(v).alias("variable"), F.when(~F.isnan(v), F.col(v).cast("double")).alias("x")) for v in variables]))
    long = rows.select(*by, named.alias("v")).select(*by, "v.*")
    return long.groupBy(*by, "variable").agg(F.count("*").alias("n"), F.avg(F.col("x").isNull().cast("double")).alias("missing_rate"), F.min("x").alias("min"), F.expr("percentile(x, 0.5D)").alias("median"), F.max("x").alias("max"))


def percentile_limits(value: str, low: float = 0.02, high: float = 0.98, include: Column | None = None) -> list[Column]:
    """Aggregates: interpolated percentiles, of the rows that ``include`` holds for."""
    chosen = F.col(value).cast("double") if include is None else F.when(include, F.col(value).cast("double"))
    p = F.percentile(chosen, F.array(F.lit(low), F.lit(high)))
    return [p[0].alias("low"), p[1].alias("high")]


def interpolated_ranks(rows: DataFrame, value: str, shares: dict[str, float], by: Sequence[str] = ()) -> DataFrame:
    """Per group, interpolated percentiles, as Spark's ``percentile`` gives them, but in memory that doesn't grow with
    a group's distinct values."""
    ends = {f"{k}{side}": (p, side) for k, p in shares.items() for side in ("_low", "_up")}
    at = {k: (lambda n, p=p, up=side == "_up": F.floor(F.lit(p) * (n - 1)) + (F.lit(1) if up else F.lit(0))) for k, (p, side) in ends.items()}
    found = values_at_ranks(rows, value, {k: p for k, (p, _) in ends.items()}, by, at)
    part = lambda p: F.lit(p) * (F.col("n") - 1) - F.floor(F.lit(p) * (F.col("n") - 1))
    line = lambda k, p: F.when(part(p) == 0, F.col(f"{k}_low")).otherwise(F.col(f"{k}_low") + (F.col(f"{k}_up") - F.col(f"{k}_low")) * part(p))
    return found.select(*by, "n", *[line(k, p).alias(k) for k, p in shares.items()])


def values_at_ranks(rows: DataFrame, value: str, shares: dict[str, float], by: Sequence[str] = (), ranks: dict | None = None) -> DataFrame:
    """Per group, the values at rank floor(n p), without interpolation, for each named share p; or at a rank that
    ``ranks`` tells from n, within a few of that. With ``n``.

    A sketch brackets each rank of groups of more than ACCURACY values, and only the distinct values inside a bracket,
    about n * 4 / ACCURACY of them, are ordered; the others are counted where they lie.
    """
    good = rows.where(known(value)).select(*by, F.col(value).cast("double").alias("v"))
    slack = 2 / ACCURACY
    ends = F.array(*[F.lit(min(1.0, max(0.0, p + d))) for p in shares.values() for d in (-slack, slack)])
    bounds = good.groupBy(*by).agg(F.count("*").alias("n"), F.percentile_approx("v", ends, ACCURACY).alias("ends"))
    bounds = bounds.select(*[F.col(c).alias(f"_{c}") for c in by], "n", *[F.when(F.col("n") > ACCURACY, F.col("ends")[2 * i + up]).otherwise(F.lit(math.inf if up else -math.inf)).alias(f"{'to' if up else 'from'}_{k}") for i, k in enumerate(shares) for up in (0, 1)])
    same = F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    if by:  # equal values stay together; few groups would else be few tasks
        good = good.withColumn("_part", F.pmod(F.hash("v"), F.lit(PARTS)))
        bounds = bounds.withColumn("_of", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
        placed = good.join(bounds, same & (F.col("_part") == F.col("_of")))
    else:
        placed = good.join(F.broadcast(bounds), same)  # one row
    out = None
    for k, p in shares.items():
        near = placed.where(F.col("v") <= F.col(f"to_{k}")).select(*by, "n", F.when(F.col("v") >= F.col(f"from_{k}"), F.col("v")).alias("v"))
        counted = near.groupBy(*by, "n", "v").agg(F.count("*").alias("c"))  # values before the bracket are one row
        before = F.sum("c").over(Window.partitionBy(*by, "n").orderBy(F.asc_nulls_first("v")))
        at = F.least(F.col("n") - 1, ranks[k](F.col("n")) if ranks else F.floor(F.col("n") * F.lit(p)))
        found = counted.withColumn("_until", before).where(F.col("v").isNotNull() & (F.col("_until") > at)).groupBy(*by, *(["n"] if out is None else [])).agg(F.min("v").alias(k))
        out = found if out is None else out.join(found.select(*[F.col(c).alias(f"_{c}") for c in by], k), same, "left").drop(*[f"_{c}" for c in by])
    return out


def floor_limits(rows: DataFrame, value: str, by: Sequence[str] = (), low: float = 0.02, high: float = 0.98) -> DataFrame:
    """The values at rank floor(n p), without interpolation; equal limits are widened by 1, no values give 0 to 1."""
    found = values_at_ranks(rows, value, {"low": low, "high": high}, by)
    if by:
        groups = rows.select(*by).distinct()
        same = F.lit(True)
        for c in by:
            same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
        found = groups.join(found.select(*[F.col(c).alias(f"_{c}") for c in by], "low", "high"), same, "left").drop(*[f"_{c}" for c in by])
    else:
        found = found.agg(F.min("low").alias("low"), F.min("high").alias("high"))
    limits = found.withColumns({"low": F.coalesce("low", F.lit(0.0)), "high": F.coalesce("high", F.lit(1.0))})
    return limits.withColumn("high", F.when(F.col("high") == F.col("low"), F.col("low") + 1).otherwise(F.col("high")))


def auto_bins(values: DataFrame, value: str) -> DataFrame:
    """One row: low, high and n_bins by the larger of Sturges' and Freedman and Diaconis' counts."""
    quartiles = F.expr(f"percentile(cast({value} as double), array(0.25D, 0.75D))")
    row = values.where(known(value)).agg(F.count("*").alias("n"), F.min(value).cast("double").alias("low"), F.max(value).cast("double").alias("high"), quartiles.alias("q"))
    width = F.col("high") - F.col("low")
    sturges = width / (F.log2(F.col("n")) + 1)
    diaconis = F.lit(2.0) * (F.col("q")[1] - F.col("q")[0]) / F.pow(F.col("n").cast("double"), F.lit(1 / 3))
    step = F.when(diaconis > 0, F.least(sturges, diaconis)).otherwise(sturges)
    bins = F.when((F.col("n") > 0) & (width > 0), F.ceil(width / step)).otherwise(F.lit(1)).cast("int")
    flat = width == 0
    return row.select(F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"), F.when(flat, F.col("high") + 0.5).otherwise(F.col("high")).alias("high"), bins.alias("n_bins"))


def histogram(values: DataFrame, value: str, low: float, high: float, n_bins: int, by: Sequence[str] = (), density: bool = False) -> DataFrame:
    """Counts of equal bins, empty ones included; the last bin holds its upper edge, values outside are left out."""
    width = (high - low) / n_bins
    x = F.col(value).cast("double")
    inside = values.where(known(value) & (x >= low) & (x <= high))
    place = F.least(F.floor((x - low) / width), F.lit(n_bins - 1)).cast("int")
    counted = inside.groupBy(*by, place.alias("bin")).agg(F.count("*").alias("count"))
    groups = values.select(*by).distinct() if by else values.sparkSession.range(1).select()
    every = groups.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(n_bins - 1))))
    out = every.join(counted, [*by, "bin"], "left").withColumn("count", F.coalesce("count", F.lit(0).cast("long")))
    out = out.withColumns({"bin_low": F.lit(low) + F.col("bin") * width, "bin_high": F.lit(low) + (F.col("bin") + 1) * width})
    if density:
        total = F.sum("count").over(Window.partitionBy(*by))
        out = out.withColumn("density", F.try_divide(F.col("count").cast("double"), total * width))
    return out


def auto_histogram(values: DataFrame, value: str) -> DataFrame:
    bins = auto_bins(values, value).first()  # one row
    if bins["low"] is None:
        return histogram(values, value, 0.0, 1.0, 1)
    return histogram(values, value, bins["low"], bins["high"], bins["n_bins"])


def _kernel_sums(low: float, step: float, points: int):
    """(season, i, raw): sums of a task's kernels at each grid point, from columns season, v and bw."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        x, sums = low + np.arange(points) * step, {}
        for batch in batches:
            seasons = batch.column(0).dictionary_encode()
            code, value, width = seasons.indices.to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for k, season in enumerate(seasons.dictionary.to_pylist()):
                own = np.flatnonzero(code == k)
                total = sums.setdefault(season, np.zeros(points))
                for at in np.split(own, range(2048, len(own), 2048)):
                    z = (x[None, :] - value[at, None]) / width[at, None]
                    total += np.exp(z * z * -0.5).sum(0)
        for season, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([season] * points), pa.array(np.arange(points, dtype=np.int32)), pa.array(total)], names=["season", "i", "raw"])

    return run


def density(values: DataFrame, value: str, group: str | None = None, points: int = 256, per_group: bool = False, pooled: str = "All") -> DataFrame:
    """Gaussian kernel density on ``points`` from the 2nd to the 98th percentile (by rank) of all values.

    (season, x, density): each group's curve, scaled by its share of the values unless ``per_group``, and the pooled
    one. The bandwidth is 1.06 sigma n**-0.2; fewer than two values or no spread give zeros; curves have unit area on
    the grid. Each task sums the kernels of its values, and passes on one number per group and grid point.
    """
    good = values.where(known(value)).select((F.col(group).cast("string") if group else F.lit(pooled)).alias("season"), F.col(value).cast("double").alias("v"))
    limits = floor_limits(good, "v").first()  # one row
    if limits is None:
        return good.sparkSession.createDataFrame([], "season string, x double, density double")
    low, high = limits["low"], limits["high"]
    rows = good.union(good.select(F.lit(pooled), "v")) if group else good
    stats = rows.groupBy("season").agg(F.count("*").alias("n"), F.stddev_samp("v").alias("sigma"))
    stats = stats.withColumn("bw", F.lit(1.06) * F.col("sigma") * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
    step = (high - low) / (points - 1)
    grid = F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: F.struct(i.alias("i"), (F.lit(low) + i * step).alias("x")))
    widths = stats.where("n > 1 and sigma > 0").select(F.col("season").alias("_s"), "bw")
    kernels = rows.join(widths, F.col("season") == F.col("_s")).select("season", "v", "bw")
    sums = kernels.mapInArrow(_kernel_sums(low, step, points), "season string, i int, raw double").groupBy("season", "i").agg(F.sum("raw").alias("raw"))
    every = stats.select("season", "n", "bw", F.explode(grid).alias("g")).select("season", "n", "bw", "g.i", "g.x").join(sums, ["season", "i"], "left")
    every = every.withColumn("raw", F.coalesce(F.try_divide("raw", F.col("n") * F.col("bw") * math.sqrt(2 * math.pi)), F.lit(0.0)))
    w = Window.partitionBy("season").orderBy("i")
    strip = (F.col("raw") + F.lag("raw").over(w)) / 2 * (F.col("x") - F.lag("x").over(w))
    every = every.withColumn("_strip", strip).withColumn("_area", F.sum("_strip").over(Window.partitionBy("season")))
    weight = F.lit(1.0) if per_group or not group else F.when(F.col("season") == pooled, 1.0).otherwise(F.col("n") / F.col("_total"))
    if group and not per_group:
        every = every.join(F.broadcast(stats.where(F.col("season") == pooled).select(F.col("n").alias("_total"))), F.lit(True))  # one row
    return every.select("season", "x", (F.coalesce(F.try_divide("raw", "_area"), F.lit(0.0)) * weight).alias("density"))


def running_counts(counted: DataFrame, value: str, n: str, name: str, by: Sequence[str] = (), tie: str | None = None) -> DataFrame:
    """``counted`` with the sum of ``n`` over all rows of the group that come before, by rising value (then ``tie``).

    Rows are dealt into RANGES of values by a sketch, ranges are ordered apart from each other, and each one begins
    with the sum of those before it, so no task orders a whole group.
    """
    v = F.col(value).cast("double")
    edges = counted.agg(F.percentile_approx(v, F.array(*[F.lit(i / RANGES) for i in range(1, RANGES)])).alias("_edges"))
    place = F.size(F.filter(F.coalesce("_edges", F.array().cast("array<double>")), lambda e: e <= v))
    dealt = counted.join(F.broadcast(edges), F.lit(True)).withColumn("_range", place).drop("_edges")  # one row of RANGES - 1 numbers
    sizes = dealt.groupBy(*by, "_range").agg(F.sum(n).alias("_size"))
    first = F.sum("_size").over(Window.partitionBy(*by).orderBy("_range")) - F.col("_size")  # a row per group and range
    firsts = sizes.select(*[F.col(c).alias(f"_of_{c}") for c in by], F.col("_range").alias("_of"), first.alias("_first"))
    same = F.col("_range") == F.col("_of")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    own = Window.partitionBy(*by, "_range").orderBy(*[value, *([tie] if tie else [])]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = F.sum(n).over(own) - F.col(n)
    return dealt.withColumn("_within", within).join(firsts, same).withColumn(name, F.col("_first") + F.col("_within")).drop("_range", "_of", "_first", "_within", *[f"_of_{c}" for c in by])


def ranks_of_values(rows: DataFrame, value: str, name: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, value, name): each distinct value's rank from 1, the mean of the ranks of its rows. A value is one row,
    however many rows have it."""
    counted = rows.groupBy(*by, value).agg(F.count("*").alias("_c"))
    return running_counts(counted, value, "_c", "_before", by).select(*by, value, (F.col("_before") + (F.col("_c") + 1) / 2).alias(name))


def correlations(rows: DataFrame, x: str, y: str, by: Sequence[str] = (), least: int = 10) -> DataFrame:
    """n, Pearson's and Spearman's coefficient over rows where both are finite; groups under ``least`` have none."""
    finite = lambda c: known(c) & (F.abs(F.col(c)) != float("inf"))
    ranked = rows.where(finite(x) & finite(y)).select(*by, F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    good = ranked
    for c in ("x", "y"):
        ranks = ranks_of_values(good, c, f"r{c}", by).select(*[F.col(k).alias(f"_{k}") for k in by], F.col(c).alias("_v"), f"r{c}")
        same = F.col(c) == F.col("_v")
        for k in by:
            same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
        ranked = ranked.join(ranks, same).drop("_v", *[f"_{k}" for k in by])
    out = ranked.groupBy(*by).agg(F.count("*").alias("n"), F.corr("x", "y").alias("pearson"), F.corr("rx", "ry").alias("spearman"))
    return out.withColumns({c: F.when(F.col("n") >= least, F.col(c)) for c in ("pearson", "spearman")})


def top_counts(rows: DataFrame, key: str, k: int = 20) -> DataFrame:
    return rows.groupBy(key).agg(F.count("*").alias("count")).orderBy(F.desc("count"), key).limit(k)


def label_above(value: str, threshold: float = 8.0) -> Column:
    """1 where a difference exceeds the threshold, else 0."""
    return (F.col(value) > threshold).cast("int")


def separation(rows: DataFrame, score: str, label: str) -> DataFrame:
    """AUC of a score for a 0/1 label, and the class sizes: of all pairs of one of either class, the share in which the
    1 has the higher score, ties half. Told from the classes' counts per distinct score."""
    counted = rows.where(known(score) & F.col(label).isNotNull()).groupBy(score).agg(F.count_if(F.col(label) == 1).alias("_p"), F.count_if(F.col(label) == 0).alias("_q"))
    below = running_counts(counted, score, "_q", "_below")
    won = F.sum(F.col("_p") * (F.col("_below") + F.col("_q") / 2))
    out = below.agg(F.coalesce(F.sum("_p"), F.lit(0)).alias("n_positive"), F.coalesce(F.sum("_q"), F.lit(0)).alias("n_negative"), won.alias("_won"))
    return out.select("n_positive", "n_negative", F.try_divide("_won", F.col("n_positive") * F.col("n_negative")).alias("auc"))


def binned(rows: DataFrame, by: str, edges: Sequence[float], value: str) -> DataFrame:
    """n and median of a value per bin of another; bins are below the first edge, between edges, and from the last on."""
    place = F.lit(0)
    for edge in edges:
        place = place + (F.col(by) >= edge).cast("int")
    placed = rows.where(known(by) & known(value)).select(place.alias("bin"), F.col(value).cast("double").alias("_v"))
    return interpolated_ranks(placed, "_v", {"median": 0.5}, ["bin"])


def cell_modes(rows: DataFrame, x: str, y: str, flag: Column, size: float = 5000.0, share: float = 0.8) -> DataFrame:
    """Grid cells with the share of flagged rows, and whether one mode holds more than ``share`` of them."""
    cells = rows.groupBy(F.floor(F.col(x) / size).alias("cell_x"), F.floor(F.col(y) / size).alias("cell_y")).agg(F.count("*").alias("n"), F.avg(flag.cast("double")).alias("flagged"))
    return cells.withColumn("one_mode", (F.col("flagged") > share) | (F.col("flagged") < 1 - share))


def top_share(rows: DataFrame, group: str, flag: Column, part: float = 0.1) -> DataFrame:
    """Per group: rate of flagged rows, and whether the group is among the ``part`` with most of them."""
    counted = rows.groupBy(group).agg(F.count("*").alias("n"), F.count_if(flag).alias("n_flagged"))
    counted = running_counts(counted.withColumns({"_fewer": -F.col("n_flagged"), "_one": F.lit(1)}), "_fewer", "_one", "_place", tie=group)
    place = F.when(F.col("_groups") > 1, F.col("_place") / (F.col("_groups") - 1)).otherwise(0.0)
    total = counted.agg(F.count("*").alias("_groups"))
    counted = counted.join(F.broadcast(total), F.lit(True)).withColumns({"rate": F.col("n_flagged") / F.col("n"), "in_top": place < part})  # one row
    return counted.drop("_fewer", "_one", "_place", "_groups")


def threshold_scores(rows: DataFrame, score: str, label: str, threshold: float) -> DataFrame:
    """Precision and recall of calling rows whose score is over a threshold 1, and the counts behind them."""
    called, true = F.col(score) > threshold, F.col(label) == 1
    out = rows.where(known(score) & F.col(label).isNotNull()).agg(F.count_if(called & true).alias("n_hit"), F.count_if(called & ~true).alias("n_false"), F.count_if(~called & true).alias("n_missed"))
    return out.withColumns({"precision": F.try_divide(F.col("n_hit"), F.col("n_hit") + F.col("n_false")), "recall": F.try_divide(F.col("n_hit"), F.col("n_hit") + F.col("n_missed"))})


def binned_share(rows: DataFrame, by: str, edges: Sequence[float], flag: Column) -> DataFrame:
    """n and the share of flagged rows per bin of a value."""
    place = F.lit(0)
    for edge in edges:
        place = place + (F.col(by) >= edge).cast("int")
    return rows.where(known(by)).groupBy(place.alias("bin")).agg(F.count("*").alias("n"), F.avg(flag.cast("double")).alias("flagged_share"))


def density_grid(rows: DataFrame, x: str, y: str, box: tuple[float, float, float, float], points: int = 24, bandwidth: tuple[float, float] | None = None) -> DataFrame:
    """(i, j, x, y, density) of a two-dimensional Gaussian kernel density on points * points places of a box.

    Values are counted in the grid's own cells first, and the kernel is summed along one axis, then along the other: at
    most 2 * points**3 terms, whatever the number of values. The bandwidth, if not given, is n**(-1/6) standard deviations on either axis; the densities' mean over the box is 1 / area.
    """
    x0, y0, x1, y1 = box
    dx, dy = (x1 - x0) / points, (y1 - y0) / points
    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    inside = rows.where(known(x) & known(y) & (px >= x0) & (px < x1) & (py >= y0) & (py < y1))
    cells = inside.groupBy(F.floor((px - x0) / dx).cast("int").alias("ci"), F.floor((py - y0) / dy).cast("int").alias("cj")).agg(F.count("*").alias("w"))
    spread = inside.agg(F.count("*").alias("n"), F.stddev_pop(px).alias("sx"), F.stddev_pop(py).alias("sy"))
    scale = F.pow(F.col("n").cast("double"), F.lit(-1 / 6))
    widths = spread.select((F.lit(bandwidth[0]) if bandwidth else F.col("sx") * scale).alias("hx"), (F.lit(bandwidth[1]) if bandwidth else F.col("sy") * scale).alias("hy"))
    places = F.sequence(F.lit(0), F.lit(points - 1))
    zx, zy = (F.col("i") - F.col("ci")) * dx / F.col("hx"), (F.col("j") - F.col("cj")) * dy / F.col("hy")
    along = cells.join(F.broadcast(widths), F.lit(True)).withColumn("j", F.explode(places))  # the widths are one row
    along = along.groupBy("ci", "j", "hx").agg(F.sum(F.col("w") * F.exp(zy * zy * -0.5)).alias("w"))
    raw = along.withColumn("i", F.explode(places)).groupBy("i", "j").agg(F.sum(F.col("w") * F.exp(zx * zx * -0.5)).alias("raw"))
    total = raw.agg(F.sum("raw").alias("_total"))
    out = raw.join(F.broadcast(total), F.lit(True))  # one row
    return out.select("i", "j", (F.lit(x0) + (F.col("i") + 0.5) * dx).alias("x"), (F.lit(y0) + (F.col("j") + 0.5) * dy).alias("y"), F.try_divide("raw", F.col("_total") * (dx * dy)).alias("density"))


def floating_shares(rows: DataFrame, distance: str, value: str, by: Sequence[str]) -> DataFrame:
    """Per source: the share of points beyond the grounding line (a negative distance), and the value's median and spread."""
    good = rows.where(known(value))
    return good.groupBy(*by).agg(F.count("*").alias("n"), F.avg((F.col(distance) < 0).cast("double")).alias("floating_share"), F.percentile(F.col(value).cast("double"), F.lit(0.5)).alias("median"), F.stddev_samp(value).alias("std"))


def group_extents(rows: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    return rows.where(known(value)).groupBy(*by).agg(F.min(value).alias("lowest"), F.max(value).alias("highest"))
