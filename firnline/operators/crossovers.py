"""Crossovers: places where two frames' lines meet, and the differences of their traces there.

Frames meet through the cells along their traces' steps (consecutive traces joined by a line): of steps of two frames that
come within the threshold, one lies in a cell that the other reaches too. Steps that meet are grouped into places, runs of
adjacent steps of both frames; each place gives its nearest pair of traces. A cell passes on one row for all steps of two
pieces of track that meet without a gap, and a place's rows are joined by the extents of such runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from firnline.functions.physics import acute_angle, distance, midpoint
from firnline.operators import spatial
from firnline.operators.meeting import runs_that_meet
from firnline.operators.parts import parts_of
from firnline.operators.time_axis import bearing

MIN_ANGLE = 20.0
#: A frame's place along its track is cut here when steps that meet are further apart than this many traces.
GAP = 5
#: Width of a cell in thresholds, and how far a step's points reach: twice the reach is less than a cell.
WIDTH, REACH = 16.0, 1.6
#: Traces in a cell beyond which its frames are dealt into parts, each of which meets each.
HOT = 100_000


def find_crossovers(traces: DataFrame, threshold: float, variables: Sequence[str], frame: str = "frame_id", order: str = "slow_time", xy: tuple[str, str] = ("x", "y"), min_angle: float = MIN_ANGLE) -> DataFrame:
    """frame_a, frame_b, distance_m, angle_deg, x_proj, y_proj and {variable}_a, _b, _diff of each place.

    ``traces`` have passed their checks and have plane coordinates. Frames of fewer than two traces take no part;
    frame_a is the smaller name. A place counts if its nearest traces are within the threshold and their tracks cross
    at ``min_angle`` degrees or more.
    """
    x, y = xy
    side = WIDTH * threshold
    w = Window.partitionBy(frame).orderBy(order)
    known = traces.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    ahead = {f"_n{n}": F.lead(v).over(w) for n, v in enumerate(variables, 1)}
    track = known.withColumns({"_i": F.row_number().over(w), "_nx": F.lead(F.col(x).cast("double")).over(w), "_ny": F.lead(F.col(y).cast("double")).over(w), "_c0": bearing(x, y, [frame], [order])} | ahead).withColumn("_n0", F.lead("_c0").over(w))
    track = track.select(F.col(frame).alias("_frame"), "_i", F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"), "_nx", "_ny", "_c0", "_n0", *[F.col(v).alias(f"_c{n}") for n, v in enumerate(variables, 1)], *ahead)
    length = distance(F.col("_x"), F.col("_y"), F.col("_nx"), F.col("_ny"))
    steps = track.where(F.col("_nx").isNotNull() & F.col("_frame").isNotNull() & (length < float("inf")))
    # Points along a long step, half a threshold apart at most, stand for it: where two steps come within the threshold, two
    # of their points lie within 1.5 of it. One side takes the cells of its points, the other those that the squares
    # around its points touch; cells are wider than squares, so these are the corners'. A shorter step's box is such a square.
    pieces = F.greatest(F.lit(1), F.ceil(length / (threshold / 2)).cast("int"))

    def corners(low_x: Column, high_x: Column, low_y: Column, high_y: Column) -> Column:
        return F.array(*[spatial.cell_of(i, j, side) for i in (low_x, high_x) for j in (low_y, high_y)])

    def cells(reach: float) -> Column:
        def near(k: Column) -> Column:
            px, py = (F.col(low) + (F.col(high) - F.col(low)) * k / pieces for low, high in (("_x", "_nx"), ("_y", "_ny")))
            return corners(px - reach, px + reach, py - reach, py + reach)

        box = corners(F.least("_x", "_nx") - reach, F.greatest("_x", "_nx") + reach, F.least("_y", "_ny") - reach, F.greatest("_y", "_ny") + reach)
        walked = F.flatten(F.transform(F.sequence(F.lit(0), pieces), near))
        return F.array_distinct(F.when(length + 2 * reach < side, box).otherwise(walked))

    placed = steps.withColumns({"_own": cells(0.0), "_cell": F.explode(cells(REACH * threshold))})
    # a cell of very many traces deals its frames into parts; a's part and b's part meet in a task of their own
    hot = known.groupBy(spatial.cell_of(F.col(x), F.col(y), side).alias("_hot")).agg(F.ceil(F.count("*") / HOT).cast("int").alias("_parts")).where("_parts > 1")
    placed = placed.join(F.broadcast(hot), F.col("_cell") == F.col("_hot"), "left")  # at most a row per HOT traces
    role = F.when(F.array_contains("_own", F.col("_cell")), 1).otherwise(0)
    mine, parts = F.pmod(F.xxhash64("_frame"), F.col("_parts")), F.col("_parts")
    row = lambda part, r: F.struct(part.cast("long").alias("_part"), r.cast("int").alias("_role"))
    both = F.flatten(F.transform(F.sequence(F.lit(0), parts - 1), lambda k: F.array(row(mine * parts + k, role), row(k * parts + mine, F.lit(2)))))
    placed = placed.withColumn("_r", F.explode(F.when(parts.isNull(), F.array(row(F.lit(0), role + 2))).otherwise(both)))
    placed = placed.withColumns({"_part": F.col("_r._part"), "_role": F.col("_r._role")}).where("_role > 0").drop("_r", "_own", "_hot", "_parts")
    n = max(int(traces.sparkSession.conf.get("spark.sql.shuffle.partitions")), parts_of(traces))
    placed = placed.repartition(n, "_cell", "_part").sortWithinPartitions("_cell", "_part", "_frame", "_i")

    carried = [("x", "_x", "_nx"), ("y", "_y", "_ny"), *[(f"c{k}", f"_c{k}", f"_n{k}") for k in range(len(variables) + 1)]]
    kinds = {f.name: f.dataType for f in placed.schema}
    schema = StructType([StructField(f"frame_{s}", kinds["_frame"]) for s in "ab"] + [StructField(f"i{s}{e}", IntegerType()) for s in "ab" for e in ("_low", "_high", "")] + [StructField("distance_m", DoubleType())] + [StructField(f"{name}_{s}", kinds[here]) for s in "ab" for name, here, _ in carried])
    met = placed.mapInArrow(runs_that_meet(threshold, GAP, to_arrow_schema(schema), carried), schema)
    values = [F.col(f"c{k}_{s}") for k in range(1, len(variables) + 1) for s in "ab"]
    nearest = F.struct("distance_m", "ia", "ib", acute_angle(F.col("c0_a"), F.col("c0_b")).alias("angle_deg"), midpoint(F.col("x_a"), F.col("x_b")).alias("x_proj"), midpoint(F.col("y_a"), F.col("y_b")).alias("y_proj"), *values)
    met = met.select("frame_a", "frame_b", "ia_low", "ia_high", "ib_low", "ib_high", nearest.alias("nearest"))
    met = met.repartition(2 * n, "frame_a", "frame_b")  # all that follows keeps to this deal

    def places(s: str, by: Sequence[str], then: str) -> Column:
        """A new place where a track jumps by more than GAP steps."""
        ordered = Window.partitionBy(*by).orderBy(f"i{s}_low", then)
        until = F.max(f"i{s}_high").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
        return F.sum(F.when(F.col(f"i{s}_low") - until > GAP, 1).otherwise(0)).over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))

    pair = ["frame_a", "frame_b"]
    met = met.withColumn("_pa", places("a", pair, "ib_low"))
    met = met.withColumn("_pb", places("b", [*pair, "_pa"], "ia_low"))
    best = met.groupBy(*pair, "_pa", "_pb").agg(F.min("nearest").alias("_best")).select(*pair, "_best.*").where((F.col("distance_m") <= threshold) & (F.col("angle_deg") >= min_angle))
    triples = [e for k, v in enumerate(variables, 1) for e in (F.col(f"c{k}_a").alias(f"{v}_a"), F.col(f"c{k}_b").alias(f"{v}_b"), (F.col(f"c{k}_a") - F.col(f"c{k}_b")).alias(f"{v}_diff"))]
    return best.select(*pair, "distance_m", "angle_deg", "x_proj", "y_proj", *triples)


def with_collections(crossings: DataFrame, frames: DataFrame, frame: str = "frame_id", collection: str = "collection") -> DataFrame:
    """Adds collection_a and collection_b from the frame dimension."""
    for s in "ab":
        names = frames.select(F.col(frame).alias(f"_f{s}"), F.col(collection).alias(f"collection_{s}"))
        crossings = crossings.join(names, F.col(f"frame_{s}") == F.col(f"_f{s}"), "left").drop(f"_f{s}")
    return crossings


def across_seasons(crossings: DataFrame, target: str) -> DataFrame:
    """Crossovers with exactly one side in the target collection."""
    a, b = F.coalesce(F.col("collection_a") == target, F.lit(False)), F.coalesce(F.col("collection_b") == target, F.lit(False))
    return crossings.where(a != b)
