"""Statistics of windows of a trace's samples.

``axis`` holds the samples' two-way travel times in ascending order; windows include both edges. Bounds are compared
with the stored axis itself, then become a slice, so no sample is decided by rounding. Samples that are NULL or NaN are
missing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from firnline.functions.physics import to_db


def samples_between(data: Column, axis: Column, low: Column, high: Column) -> Column:
    """Samples with low <= time <= high; empty if there are none, NULL if a bound is."""
    before = F.size(F.filter(axis, lambda t: t < low))
    until = F.size(F.filter(axis, lambda t: t <= high))
    return F.when(low.isNotNull() & high.isNotNull(), F.slice(data, before + 1, F.greatest(F.lit(0), until - before)))


def finite(values: Column) -> Column:
    return F.filter(values, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))


def known(values: Column) -> Column:
    """All but missing samples; infinities stay."""
    return F.filter(values, lambda v: v.isNotNull() & ~F.isnan(v))


def median(values: Column) -> Column:
    """Median of an array without missing values; NULL if empty."""
    ordered, n = F.sort_array(values), F.size(values)
    upper = F.try_element_at(ordered, F.floor(n / 2).cast("int") + 1)
    lower = F.try_element_at(ordered, F.greatest(F.lit(1), F.floor((n + 1) / 2).cast("int")))
    return F.when(n > 0, (lower + upper) / 2)


def population_std(values: Column) -> Column:
    n = F.size(values)
    mean = F.aggregate(values, F.lit(0.0), lambda a, v: a + v) / F.when(n > 0, n)
    spread = F.aggregate(values, F.lit(0.0), lambda a, v: a + (v - mean) * (v - mean))
    return F.when(n > 0, F.sqrt(spread / n))


def window_max_db(data: Column, axis: Column, pick: Column, margin: float) -> Column:
    """Level of the largest sample within ``margin`` of a pick."""
    return to_db(F.array_max(known(samples_between(data, axis, pick - margin, pick + margin))))


def window_peak(data: Column, axis: Column, pick: Column, margin: float) -> Column:
    """struct(twtt, power_dB) of the largest sample around a pick, the earliest one of equals."""
    paired = samples_between(F.arrays_zip(data.alias("p"), axis.alias("t")), axis, pick - margin, pick + margin)
    good = F.filter(paired, lambda s: s["p"].isNotNull() & ~F.isnan(s["p"]))
    best = F.array_max(F.transform(good, lambda s: F.struct(s["p"].alias("p"), (-s["t"]).alias("t"))))
    return F.when(best.isNotNull(), F.struct((-best["t"]).alias("twtt"), to_db(best["p"]).alias("power_dB")))


def window_median_db(data: Column, axis: Column, low: Column, high: Column) -> Column:
    """Level of the median of the finite samples; only a window with high > low has one."""
    return F.when(high > low, to_db(median(finite(samples_between(data, axis, low, high)))))


def window_metrics(data: Column, axis: Column, low: Column, high: Column) -> Column:
    """struct(median_dB, peak_dB, std_dB): the median over finite samples, the others over positive ones, in dB."""
    inside = finite(samples_between(data, axis, low, high))
    levels = F.transform(F.filter(inside, lambda v: v > 0), lambda v: F.lit(10.0) * F.log10(v))
    return F.when(high > low, F.struct(to_db(median(inside)).alias("median_dB"), F.array_max(levels).alias("peak_dB"), population_std(levels).alias("std_dB")))


def tail_median_db(data: Column, axis: Column, start: float, end: float) -> Column:
    """Level of the median of the record's tail: from ``start`` to ``end`` seconds before its last sample."""
    last = F.element_at(axis, -1)
    return to_db(median(known(samples_between(data, axis, last - start, last - end))))


def interpolated(axis: Column, values: Column, at: Column) -> Column:
    """Values at each place of ``at``, linear between the ascending axis's neighbours; NULL outside the axis."""
    n = F.size(axis)

    def one(place: Column) -> Column:
        i = F.least(F.size(F.filter(axis, lambda a: a <= place)), n - 1)  # the last place belongs to the last step
        x0, x1, y0, y1 = F.try_element_at(axis, i), F.try_element_at(axis, i + 1), F.try_element_at(values, i), F.try_element_at(values, i + 1)
        within = (place >= F.element_at(axis, 1)) & (place <= F.element_at(axis, -1))
        return F.when(within & (n > 1), y0 + (y1 - y0) * (place - x0) / (x1 - x0)).when(within, F.element_at(values, 1))

    return F.when(n > 0, F.transform(at, one))


def transposed(matrix: Column) -> Column:
    """Rows of an array of arrays as columns, for frames stored with the other orientation."""
    width = F.size(F.element_at(matrix, 1))
    return F.transform(F.sequence(F.lit(1), width), lambda j: F.transform(matrix, lambda row: F.element_at(row, j)))
