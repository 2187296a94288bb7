"""Operators along a track's time axis: decimation, nearest and interpolated picks, runs, distances.

Windows are partitioned by track (frame or segment), so tracks spread over the cluster; one track's traces are few
thousand and stay together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def decimate(traces: DataFrame, by: Sequence[str], time: str, interval: int | None) -> DataFrame:
    """Keep a track's first trace, then each one at least ``interval`` after the last kept one.

    ``time`` is a whole number (microseconds). Of equal times only the first can stay; further columns of it are those
    of the smallest row. Falsy intervals keep every row. The fold carries only times, so wide rows are not gathered.
    """
    if not interval:
        return traces
    times = traces.groupBy(*by).agg(F.array_sort(F.collect_set(time)).alias("_times"))
    start = F.struct(F.lit(None).cast("bigint").alias("last"), F.array().cast("array<bigint>").alias("kept"))
    step = lambda state, t: F.when(state["last"].isNull() | (t - state["last"] >= interval), F.struct(t.cast("bigint").alias("last"), F.array_append(state["kept"], t.cast("bigint")).alias("kept"))).otherwise(state)
    kept = times.select(*by, F.explode(F.aggregate("_times", start, step)["kept"]).alias(time))
    rest = [c for c in traces.columns if c not in (*by, time)]
    chosen = traces.join(kept, [*by, time])
    if not rest:
        return chosen.distinct().select(*traces.columns)
    ranked = chosen.withColumn("_n", F.row_number().over(Window.partitionBy(*by, time).orderBy(*_sortable(chosen, rest))))
    return ranked.where("_n = 1").select(*traces.columns)


def _sortable(frame: DataFrame, names: list[str]) -> list[str]:
    found = [c for c, kind in frame.dtypes if c in names and not kind.startswith("map")]
    return found or names[:1]


def _backwards(by: Sequence[str], time: str):
    """From the end of a track to the current row: a running frame, where one to the end would start again at each row."""
    return Window.partitionBy(*by).orderBy(F.desc(time), "_trace").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def nearest(traces: DataFrame, picks: DataFrame, by: Sequence[str], time: str, values: Sequence[str], tolerance: int | dict[str, int], prefix: str = "near_") -> DataFrame:
    """Each trace with the values of its track's nearest pick, if within ``tolerance`` (inclusive). Several tolerances,
    by prefix, share one search.

    The nearest label counts, even where its value is missing; at equal distance the later one. Both sides meet in one
    sorted pass per track (union and window), never as pairs. ``picks`` hold each time once per track.
    """
    label = F.struct(F.col(time).alias("t"), *values)
    left = traces.withColumn("_label", F.lit(None).cast(_type_of(picks.select(label.alias("x"))))).withColumn("_trace", F.lit(True))
    right = picks.select(*by, time, label.alias("_label"), F.lit(False).alias("_trace"))
    order = Window.partitionBy(*by).orderBy(time, "_trace")
    before = F.last("_label", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.last("_label", ignorenulls=True).over(_backwards(by, time))
    both = left.unionByName(right, allowMissingColumns=True).withColumn("_before", before).withColumn("_after", after)
    gap_before, gap_after = F.col(time) - F.col("_before.t"), F.col("_after.t") - F.col(time)
    chosen = F.when(F.col("_after").isNull() | (gap_before < gap_after), F.col("_before")).otherwise(F.col("_after"))
    near = both.where("_trace").withColumn("_chosen", chosen)
    within = lambda most: F.abs(F.col(time) - F.col("_chosen.t")) <= most
    asked = tolerance if isinstance(tolerance, dict) else {prefix: tolerance}
    return near.select(*traces.columns, *[F.when(within(most), F.col(f"_chosen.{v}")).alias(f"{name}{v}") for name, most in asked.items() for v in values])


def _type_of(frame: DataFrame):
    return frame.schema[0].dataType


def interpolate(traces: DataFrame, picks: DataFrame, by: Sequence[str], time: str, value: str, name: str = "interpolated") -> DataFrame:
    """Linear interpolation between a track's known picks at each trace's time; NULL before the first and after the last."""
    known = picks.where(F.col(value).isNotNull() & ~F.isnan(value))
    point = F.struct(F.col(time).alias("t"), F.col(value).cast("double").alias("v"))
    left = traces.withColumn("_point", F.lit(None).cast("struct<t:bigint,v:double>")).withColumn("_trace", F.lit(True))
    right = known.select(*by, time, point.cast("struct<t:bigint,v:double>").alias("_point"), F.lit(False).alias("_trace"))
    before = F.last("_point", ignorenulls=True).over(Window.partitionBy(*by).orderBy(time, "_trace").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.last("_point", ignorenulls=True).over(_backwards(by, time))
    both = left.unionByName(right, allowMissingColumns=True).withColumn("_a", before).withColumn("_b", after).where("_trace")
    share = (F.col(time) - F.col("_a.t")) / (F.col("_b.t") - F.col("_a.t"))
    line = F.when(F.col("_a.t") == F.col("_b.t"), F.col("_a.v")).when(F.col("_a").isNotNull() & F.col("_b").isNotNull(), F.col("_a.v") + (F.col("_b.v") - F.col("_a.v")) * share)
    return both.select(*traces.columns, line.alias(name))


def picked_span(picks: DataFrame, by: Sequence[str], time: str, value: str) -> DataFrame:
    """Per track: first and last known pick, and the share of labels with a known value."""
    known = F.col(value).isNotNull()
    return picks.groupBy(*by).agg(F.min(F.when(known, F.col(time))).alias("first_pick"), F.max(F.when(known, F.col(time))).alias("last_pick"), F.avg(known.cast("double")).alias("pick_fraction"))


def bearing(x: str, y: str, by: Sequence[str], order: Sequence[str], gate: float | None = None) -> Column:
    """Degrees clockwise from the y axis between a trace's neighbours, itself standing in at the ends; 0 if alone.

    Neighbours further than ``gate`` away belong to another flight line: the trace itself stands in for them.
    """
    w = Window.partitionBy(*by).orderBy(*order)
    if gate is not None:
        step = lambda side: F.sqrt(F.pow(side(x).over(w) - F.col(x), F.lit(2.0)) + F.pow(side(y).over(w) - F.col(y), F.lit(2.0))) <= gate
        near = lambda side, c: F.coalesce(F.when(step(side), side(c).over(w)), F.col(c))
        alone = ~(F.coalesce(step(F.lead), F.lit(False)) | F.coalesce(step(F.lag), F.lit(False)))
        return F.when(~alone, F.degrees(F.atan2(near(F.lead, x) - near(F.lag, x), near(F.lead, y) - near(F.lag, y))))
    dx = F.coalesce(F.lead(x).over(w), F.col(x)) - F.coalesce(F.lag(x).over(w), F.col(x))
    dy = F.coalesce(F.lead(y).over(w), F.col(y)) - F.coalesce(F.lag(y).over(w), F.col(y))
    return F.degrees(F.atan2(dx, dy))


def with_along_track(traces: DataFrame, x: str, y: str, by: Sequence[str], order: Sequence[str], name: str = "along_track_km") -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*order)
    dx, dy = F.col(x) - F.lag(x).over(w), F.col(y) - F.lag(y).over(w)
    stepped = traces.withColumn("_step", F.coalesce(F.sqrt(dx * dx + dy * dy), F.lit(0.0)))
    total = F.sum("_step").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return stepped.withColumn(name, total / 1000.0).drop("_step")


def fail_runs(traces: DataFrame, passed: str, position: str, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Runs of traces that fail: their edges lie midway to the neighbouring traces, or at the track's ends."""
    w = Window.partitionBy(*by).orderBy(*order)
    ok = F.coalesce(F.col(passed), F.lit(False))
    marked = traces.select(*by, *order, F.col(position).alias("_at"), ok.alias("_ok"), F.lag(F.col(position)).over(w).alias("_prior"), F.lead(F.col(position)).over(w).alias("_next"), F.lag(ok).over(w).alias("_was"))
    change = F.when(F.col("_was").isNull() | (F.col("_was") != F.col("_ok")), 1).otherwise(0)
    runs = marked.withColumn("_run", F.sum(change).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).where(~F.col("_ok"))
    low = F.min((F.coalesce("_prior", "_at") + F.col("_at")) / 2)
    high = F.max((F.coalesce("_next", "_at") + F.col("_at")) / 2)
    return runs.groupBy(*by, "_run").agg(F.count("*").alias("n_traces"), low.alias("run_start"), high.alias("run_end")).drop("_run")
