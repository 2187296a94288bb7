"""Spatial matching of point sets in the plane.

Points meet through square cells as wide as the search distance: a point's partners lie in its own or the eight
neighbouring cells, so the join is an equi-join on cells and never compares all pairs. Matches at the distance or
beyond are discarded anyway, which makes the result exact. Nearest points are looked for in cells as small as the points
are dense first, and in larger ones only for points that have none so near.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firnline.functions.physics import distance
from firnline.operators.quality import finite


def _cell(x: str, size: float) -> Column:
    return F.floor(F.col(x) / size)


def candidates(left: DataFrame, right: DataFrame, threshold: float, left_xy: tuple[str, str], right_xy: tuple[str, str], also: tuple[str, str] | None = None) -> DataFrame:
    """Pairs closer than ``threshold``, with distance_m, whose columns ``also`` agree. Column names of the two sides must differ."""
    around = F.array(*[F.struct((_cell(right_xy[0], threshold) + i).alias("cx"), (_cell(right_xy[1], threshold) + j).alias("cy")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    spread = right.withColumn("_c", F.explode(around)).withColumns({"_rx": F.col("_c.cx"), "_ry": F.col("_c.cy")}).drop("_c")
    placed = left.withColumns({"_lx": _cell(left_xy[0], threshold), "_ly": _cell(left_xy[1], threshold)})
    # nine times the points: no broadcast, however small the table they come from
    met = placed.join(spread.hint("merge"), (F.col("_lx") == F.col("_rx")) & (F.col("_ly") == F.col("_ry")) & (F.col(also[0]) == F.col(also[1]) if also else F.lit(True)))
    d = distance(F.col(left_xy[0]), F.col(left_xy[1]), F.col(right_xy[0]), F.col(right_xy[1]))
    return met.withColumn("distance_m", d).where(F.col("distance_m") < threshold).drop("_lx", "_ly", "_rx", "_ry")


def _first(pairs: DataFrame, by: Sequence[str], order: Sequence) -> DataFrame:
    n = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return pairs.withColumn("_n", n).where("_n = 1").drop("_n")


def _sides(targets: DataFrame, side: float, k: int, xy: tuple[str, str], by: Sequence[str]) -> list[float]:
    """Sides of cells from small to ``side``, each twice the last; a point's smallest cell holds from 4 k to 16 k points
    on average, if ``side`` is as long as that."""
    cells = targets.groupBy(*by, _cell(xy[0], side).alias("_cx"), _cell(xy[1], side).alias("_cy")).agg(F.count("*").cast("double").alias("_n"))
    crowd = cells.agg((F.sum(F.col("_n") * F.col("_n")) / F.sum("_n")).alias("crowd")).first()["crowd"] or 1.0  # one row
    return [side / 2**n for n in range(math.floor(math.log(max(crowd / (4 * k), 1.0), 4)), -1, -1)]


def _distinct_places(targets: DataFrame, k: int, target_id: str, xy: tuple[str, str], by: Sequence[str]) -> DataFrame:
    """Of points at one place, the ``k`` with the smallest ids: only they can be among the nearest."""
    same = Window.partitionBy(*by, *xy).orderBy(target_id)
    return targets.where(finite(*xy)).withColumn("_same", F.row_number().over(same)).where(F.col("_same") <= k).drop("_same")


def _without(rows: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    same = F.lit(True)
    for c in keys:
        same = same & F.col(c).eqNullSafe(F.col(f"_done_{c}"))
    return rows.join(done.select(*[F.col(c).alias(f"_done_{c}") for c in keys]).hint("merge"), same, "left_anti")


def nearest_within(left: DataFrame, right: DataFrame, threshold: float, left_id: str, right_id: str, left_xy: tuple[str, str], right_xy: tuple[str, str], also: tuple[str, str] | None = None) -> DataFrame:
    """Each left point's nearest right point, if closer than ``threshold``, whose columns ``also`` agree; equals go to
    the smaller id."""
    keys = [also[0], left_id] if also else [left_id]
    by = [also[1]] if also else []
    targets = _distinct_places(right, 1, right_id, right_xy, by)
    rest, found = left.where(finite(*left_xy)), None
    for side in _sides(targets, threshold, 1, right_xy, by):
        near = candidates(rest, targets, side, left_xy, right_xy, also)
        if side < threshold:
            near = near.where(F.col("distance_m") <= side * (1 - 1e-9))
        near = _first(near, keys, ["distance_m", right_id])
        found = near if found is None else found.union(near)
        rest = _without(rest, near, keys)
    return found


def one_to_one(left: DataFrame, right: DataFrame, threshold: float, left_id: str, right_id: str, left_xy: tuple[str, str], right_xy: tuple[str, str]) -> DataFrame:
    """Nearest partner of each left point, then for each right point only the closest left one; others stay unmatched."""
    return _first(nearest_within(left, right, threshold, left_id, right_id, left_xy, right_xy), [right_id], ["distance_m", left_id])


def closest_per_group(pairs: DataFrame, by: Sequence[str], tie: Sequence[str]) -> DataFrame:
    """The closest pair of each group."""
    return _first(pairs, by, ["distance_m", *tie])


def _spread(points: DataFrame, xy: tuple[str, str], side: float, by: Sequence[str]) -> DataFrame:
    """Points that have coordinates, with the level-0 cell (_i, _j) and the groups as _g0, _g1, ..."""
    x, y = (F.col(c).cast("double") for c in xy)
    groups = {f"_g{n}": F.col(c) for n, c in enumerate(by)}
    return points.where(x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y)).withColumns(groups | {"_i": F.floor(x / side), "_j": F.floor(y / side)})


def nearest_k(left: DataFrame, right: DataFrame, k: int, left_id: str, right_id: str, left_xy: tuple[str, str], right_xy: tuple[str, str], by: tuple[Sequence[str], Sequence[str]] = ((), ())) -> DataFrame:
    """Each left point with its ``k`` nearest right points (all, if fewer), however far: both sides' columns,
    distance_m and rank from 1. Equal distances go to the smaller id. Only points whose columns ``by`` agree (the left
    names, the right names) meet. Column names of the two sides must differ; points without coordinates take no part.

    Without ``by``, points look at the nine cells around them first, as one array that each cell holds once: neither cells nor
    candidates are multiplied by the left points. Those whose k nearest may lie further away, or whose cells are crowded, are searched level by level.
    """
    across = _extents(right, right_xy)
    left = left.where(finite(*left_xy))
    n, wide = across["n"], [across[f"high{i}"] - across[f"low{i}"] for i in (0, 1)]
    if by[0] or not n or not min(wide):
        return _nearest_by_levels(left, right, k, left_id, right_id, left_xy, right_xy, by)
    targets, found, rest = _distinct_places(right, k, right_id, right_xy, ()), None, left
    side = math.sqrt(wide[0] * wide[1] * k / n)
    for side in [*_sides(targets, side, k, right_xy, ()), 2 * side]:
        met = _nearest_in_blocks(rest, targets, k, side, right_id, left_xy, right_xy)
        near = met.where("rank is not null")
        found = near if found is None else found.union(near)
        rest = met.where("rank is null").select(*left.columns).localCheckpoint()  # usually few; read several times
        if rest.isEmpty():
            return found
    return found.union(_nearest_by_levels(rest, right, k, left_id, right_id, left_xy, right_xy).select(*found.columns))


def _extents(points: DataFrame, xy: tuple[str, str]) -> dict:
    """One row: low0, high0, low1, high1 and n; zeros if there are none."""
    out = points.where(finite(*xy)).agg(*[f(F.col(c).cast("double")).alias(f"{n}{i}") for i, c in enumerate(xy) for n, f in (("low", F.min), ("high", F.max))], F.count("*").alias("n")).first().asDict()
    return out if out["n"] else dict.fromkeys(out, 0.0) | {"n": 0}


#: Right points of a cell beyond which its surroundings are searched level by level.
CROWD = 100


def _nearest_in_blocks(left: DataFrame, targets: DataFrame, k: int, side: float, right_id: str, left_xy: tuple[str, str], right_xy: tuple[str, str]) -> DataFrame:
    """Each left point with its ``k`` nearest targets where nine cells surely hold them, else once with nulls."""
    cell = lambda c: F.floor(F.col(c).cast("double") / side)
    own = F.row_number().over(Window.partitionBy("_u", "_v").orderBy(right_id))
    cells = targets.withColumns({"_u": cell(right_xy[0]), "_v": cell(right_xy[1])}).withColumn("_own", own).where(F.col("_own") <= CROWD + 1)
    cells = cells.groupBy("_u", "_v").agg(F.collect_list(F.struct(*targets.columns)).alias("_c"))
    steps = F.explode(F.array(*[F.struct(F.lit(i).alias("di"), F.lit(j).alias("dj")) for i in (-1, 0, 1) for j in (-1, 0, 1)])).alias("_d")
    blocks = cells.select("_u", "_v", "_c", steps).select((F.col("_u") + F.col("_d.di")).alias("_ci"), (F.col("_v") + F.col("_d.dj")).alias("_cj"), "_c")
    blocks = blocks.groupBy("_ci", "_cj").agg(F.flatten(F.collect_list("_c")).alias("_c"), F.max(F.size("_c")).alias("_crowd")).where(F.col("_crowd") <= CROWD).drop("_crowd")
    met = left.withColumns({"_i": cell(left_xy[0]), "_j": cell(left_xy[1])}).join(blocks.hint("merge"), (F.col("_i") == F.col("_ci")) & (F.col("_j") == F.col("_cj")), "left")
    x, y = (F.col(c).cast("double") for c in left_xy)
    away = lambda c: F.struct(distance(x, y, *[c[n].cast("double") for n in right_xy]).alias("distance_m"), c[right_id].alias("id"), c.alias("right"))
    met = met.withColumn("_best", F.slice(F.sort_array(F.transform("_c", away)), 1, k))
    # beyond the block's nearest edge lie points that it doesn't hold
    edge = F.least(*[e for v, c in ((x, "_i"), (y, "_j")) for e in (v - (F.col(c) - 1) * side, (F.col(c) + 2) * side - v)]) * (1 - 1e-9) - (F.abs(x) + F.abs(y)) * 1e-12
    sure = (F.size("_best") == k) & (F.element_at("_best", -1)["distance_m"] < edge)
    met = met.select(*left.columns, F.posexplode_outer(F.when(sure, F.col("_best"))).alias("_rank", "_b"))
    return met.select(*left.columns, *[F.col("_b.right")[c].alias(c) for c in targets.columns], F.col("_b.distance_m").alias("distance_m"), (F.col("_rank") + 1).alias("rank"))


def _nearest_by_levels(left: DataFrame, right: DataFrame, k: int, left_id: str, right_id: str, left_xy: tuple[str, str], right_xy: tuple[str, str], by: tuple[Sequence[str], Sequence[str]] = ((), ())) -> DataFrame:
    """The same, level by level.

    Right points are counted in square cells, and cells in ever larger ones. Around each left cell, the smallest level is
    taken at which nine cells hold ``k`` points: the k nearest lie within three cells of that level. From there the
    search goes down two levels at a time: among the cells left, those that surely hold ``k`` points bound the
    distance, and cells that lie beyond it go. So a cell keeps few cells, whether its surroundings are empty or dense,
    and only points of cells that are left meet.
    """
    groups = [f"_g{n}" for n in range(len(by[0]))]
    a, b = _extents(left, left_xy), _extents(right, right_xy)
    wide = lambda *rows: max((max(r[f"high{i}"] for r in rows) - min(r[f"low{i}"] for r in rows)) for i in (0, 1))
    if not a["n"] or not b["n"]:
        a = b = dict.fromkeys(a, 0.0) | {"n": 0}
    across = [b[f"high{i}"] - b[f"low{i}"] for i in (0, 1)]
    side = max(math.sqrt(across[0] * across[1] * k / max(1, b["n"])), max(across) * k / max(1, b["n"]) / 64) / 2 or 1.0
    top = max(0, math.ceil(math.log2(max(wide(a, b) / side, 1.0)))) + 1

    places, targets = _spread(left, left_xy, side, by[0]), _spread(right, right_xy, side, by[1])
    # of points at one place, only the k with the smallest ids can be among the nearest
    same = Window.partitionBy(*groups, *right_xy).orderBy(right_id)
    targets = targets.withColumn("_same", F.row_number().over(same)).where(F.col("_same") <= k).drop("_same")
    # counts and cells are as many as the points: no broadcast, however small Spark takes them to be
    levels = F.explode(F.sequence(F.lit(0), F.lit(top))).alias("_l")
    counts = targets.groupBy(*groups, "_i", "_j").agg(F.count("*").alias("_n")).select(*groups, "_i", "_j", "_n", levels)
    counts = counts.groupBy(*groups, "_l", F.expr("shiftright(_i, _l)").alias("_u"), F.expr("shiftright(_j, _l)").alias("_v")).agg(F.sum("_n").alias("_n"))

    def around(reach: int) -> Column:
        steps = [F.struct(F.lit(i).alias("di"), F.lit(j).alias("dj")) for i in range(-reach, reach + 1) for j in range(-reach, reach + 1)]
        return F.explode(F.array(*steps)).alias("_d")

    own = ["_ci", "_cj"]
    cells = places.select(*groups, F.col("_i").alias("_ci"), F.col("_j").alias("_cj")).distinct()
    blocks = cells.select(*groups, *own, levels).select(*groups, *own, "_l", around(1))
    blocks = blocks.select(*groups, *own, "_l", F.expr("shiftright(_ci, _l) + _d.di").alias("_u"), F.expr("shiftright(_cj, _l) + _d.dj").alias("_v"))
    held = blocks.join(counts.hint("merge"), [*groups, "_l", "_u", "_v"]).groupBy(*groups, *own, "_l").agg(F.sum("_n").alias("_n"))
    first = held.groupBy(*groups, *own).agg(F.coalesce(F.min(F.when(F.col("_n") >= k, F.col("_l"))), F.lit(top)).alias("_l"))
    found = first.select(*groups, *own, "_l", around(3)).select(*groups, *own, "_l", F.expr("shiftright(_ci, _l) + _d.di").alias("_u"), F.expr("shiftright(_cj, _l) + _d.dj").alias("_v"))

    down = F.least("_l", F.lit(2))
    inner = F.expr("transform(sequence(0, cast(pow(4, _s) as int) - 1), c -> struct(_u * cast(pow(2, _s) as bigint) + c % cast(pow(2, _s) as int) as u, _v * cast(pow(2, _s) as bigint) + c div cast(pow(2, _s) as int) as v))")
    size = F.pow(F.lit(2.0), F.col("_l"))
    least, most = [], []
    for mine, theirs in (("_ci", "_u"), ("_cj", "_v")):
        low, high = F.col(theirs) * size, (F.col(theirs) + 1) * size
        least.append(F.greatest(F.lit(0.0), low - F.col(mine) - 1, F.col(mine) - high))
        most.append(F.greatest(high - F.col(mine), F.col(mine) + 1 - low))
    nearest, farthest = (F.sqrt(p[0] * p[0] + p[1] * p[1]) for p in (least, most))
    running = Window.partitionBy(*groups, *own).orderBy("_most").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for _ in range(-(-top // 2)):
        found = found.withColumn("_s", down).select(*groups, *own, (F.col("_l") - F.col("_s")).cast("int").alias("_l"), F.explode(inner).alias("_c"))
        found = found.select(*groups, *own, "_l", F.col("_c.u").alias("_u"), F.col("_c.v").alias("_v")).join(counts.hint("merge"), [*groups, "_l", "_u", "_v"])
        found = found.withColumns({"_least": nearest, "_most": farthest})
        found = found.withColumn("_until", F.sum("_n").over(running))
        bound = F.min(F.when(F.col("_until") >= k, F.col("_most"))).over(Window.partitionBy(*groups, *own))
        found = found.withColumn("_bound", bound).where(F.col("_bound").isNull() | (F.col("_least") <= F.col("_bound") * (1 + 1e-9))).select(*groups, *own, "_l", "_u", "_v")

    named = lambda df, names: df.select(*[F.col(c).alias(names.get(c, c)) for c in df.columns])
    meeting = found.select(*[F.col(g).alias(f"{g}m") for g in groups], *own, "_u", "_v")
    met = named(places, {"_i": "_ci", "_j": "_cj"}).join(named(meeting, {f"{g}m": g for g in groups}).hint("merge"), [*groups, *own]).drop(*own)
    met = met.join(named(targets, {"_i": "_u", "_j": "_v"}).hint("merge"), [*groups, "_u", "_v"]).drop(*groups, "_u", "_v")
    met = met.withColumn("distance_m", distance(*[F.col(c).cast("double") for c in (*left_xy, *right_xy)]))
    order = Window.partitionBy(left_id).orderBy("distance_m", right_id)
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


#: Groups of at most this many points meet all traces of their group; larger ones look for them by cells.
FEW = 64


def nearest_in_group(points: DataFrame, traces: DataFrame, group: str, point_id: str, trace_id: str, point_xy: tuple[str, str], trace_xy: tuple[str, str]) -> DataFrame:
    """Each point's nearest trace of its own frame, however far."""
    other = traces.withColumnRenamed(group, "_group")
    columns = [*points.columns, *[c for c in traces.columns if c != group], "distance_m"]
    sizes = points.groupBy(F.col(group).alias("_large")).agg(F.count("*").alias("_n")).where((F.col("_n") > FEW) & F.col("_large").isNotNull()).select("_large")
    few, large = points, None
    if sizes.limit(1).count():
        large = points.join(sizes.hint("merge"), F.col(group) == F.col("_large"), "left_semi")
        few = points.join(sizes.hint("merge"), F.col(group) == F.col("_large"), "left_anti")
    placed = lambda rows, xy: rows.where(" and ".join(f"`{c}` is not null and not isnan(`{c}`)" for c in xy))
    # traces stream past the few points of their group
    met = placed(other, trace_xy).join(placed(few, point_xy).hint("merge"), F.col("_group") == F.col(group))
    met = met.withColumn("distance_m", distance(*[F.col(c).cast("double") for c in (*point_xy, *trace_xy)]))
    near = _first(met, [point_id], ["distance_m", trace_id]).select(*columns)
    if large is None:
        return near
    return near.union(nearest_k(large, other, 1, point_id, trace_id, point_xy, trace_xy, ([group], ["_group"])).select(*columns))


def nearest_to(points: DataFrame, x: float, y: float, xy: tuple[str, str], tie: str, reach: float | None = None) -> DataFrame:
    """The one point nearest to a place, if within reach."""
    d = distance(F.col(xy[0]), F.col(xy[1]), F.lit(float(x)), F.lit(float(y)))
    near = points.withColumn("distance_m", d)
    return (near if reach is None else near.where(F.col("distance_m") <= reach)).orderBy("distance_m", tie).limit(1)


def matched_flags(points: DataFrame, pairs: DataFrame, key: str) -> DataFrame:
    """Points with ``matched``: whether they are in a pair."""
    used = pairs.select(F.col(key).alias("_used")).distinct()
    return points.join(used.hint("merge"), F.col(key) == F.col("_used"), "left").withColumn("matched", F.col("_used").isNotNull()).drop("_used")
