"""Points and track lines against a table of polygons, joined on grid cells.

A shape is a row (shape_id, parts): parts of rings of points, as in a multi-polygon. A point lies in a shape if it lies
in one of its parts, that is, if an odd number of the part's edges passes to its right (so a ring inside another is a
hole). Rings are closed without repeating their first point.

Shapes are laid out on square cells. The cells that an edge runs through are walked column by column, as many as the
edge is long; each of these border cells keeps the edges in it, and whether the edges elsewhere put the middle of its
right side inside. From there the few edges of the cell tell about each of its points. All other cells lie wholly inside
or outside; those inside are the stretches between border cells of a row. Points and the steps of lines meet shapes in
an equi-join on cells: inner cells need no test, border cells test the few edges they hold. So no shape is a literal of
the plan, no side is compared with all of the other, and the shapes' cells are broadcast only where Spark finds them
small.

The side of the cells is the caller's at most: a part of ``n`` edges and about ``k`` cells across has about ``k`` border
cells with ``n / k`` edges each, and ``k ** 2`` inner cells at most. Where border cells hold many edges, the side is
halved until the edges of a cell grow with the root of the edges only: rows of cells grow by as much as tests get fewer.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from firnline.operators.parts import ROWS

#: Cells are widened by this share of their side when they are walked, so that rounding leaves none out.
SLACK = 1e-6
PARTS = "array<array<array<struct<x:double,y:double>>>>"
#: What a cell's number grows by from one column to the next; from one row to the next it is 1.
COLUMN = 1 << 32
#: Edges that a border cell may hold, times the root of what it holds at the caller's side.
MOST = 1


def cell_of(x: Column, y: Column, side: float) -> Column:
    """A cell's number."""
    return _number(F.floor(x / side), F.floor(y / side))


def _number(i: Column, j: Column) -> Column:
    return i * F.lit(COLUMN) + j


def _span(low: Column, high: Column, side: float) -> Column:
    return F.sequence(F.floor(low / side - SLACK), F.floor(high / side + SLACK))


def cells_along(x0: Column, y0: Column, x1: Column, y1: Column, side: float) -> Column:
    """Numbers of all cells that a line runs through: in each column, those between the heights at its two ends."""
    left, right, low, high = F.least(x0, x1), F.greatest(x0, x1), F.least(y0, y1), F.greatest(y0, y1)
    slope = F.coalesce(F.try_divide(y1 - y0, x1 - x0), F.lit(0.0))

    def column(i: Column) -> Column:
        ends = [F.greatest(left, F.least(right, (i + k) * side)) for k in (-SLACK, 1 + SLACK)]
        heights = [F.greatest(low, F.least(high, y0 + (e - x0) * slope)) for e in ends]
        rows = F.when(x0 == x1, _span(low, high, side)).otherwise(_span(F.least(*heights), F.greatest(*heights), side))
        return F.transform(rows, lambda j: _number(i, j))

    return F.flatten(F.transform(_span(left, right, side), column))


def merged(shapes: DataFrame, by: str) -> DataFrame:
    """Shapes of one group as one shape, e.g. a region and its shelves: a point in any of them is in it."""
    return shapes.groupBy(F.col(by).alias("shape_id")).agg(F.flatten(F.collect_list("parts")).alias("parts"))


def edges(shapes: DataFrame) -> DataFrame:
    """(shape_id, part, x0, y0, x1, y1)"""
    rings = shapes.select("shape_id", F.posexplode("parts").alias("part", "rings")).select("shape_id", "part", F.explode("rings").alias("r")).where(F.size("r") > 0)
    turned = F.concat(F.expr("slice(r, 2, size(r) - 1)"), F.expr("slice(r, 1, 1)"))
    pairs = rings.select("shape_id", "part", F.explode(F.arrays_zip(F.col("r").alias("a"), turned.alias("b"))).alias("e"))
    return pairs.select("shape_id", "part", F.col("e.a.x").alias("x0"), F.col("e.a.y").alias("y0"), F.col("e.b.x").alias("x1"), F.col("e.b.y").alias("y1")).where("x0 + y0 + x1 + y1 is not null")


def _cells_of_rows(sides: DataFrame, side: float) -> DataFrame:
    """(shape_id, part, row, i, x0, y0, x1, y1, cell): a row per edge and cell that it runs through."""
    cells = F.explode(cells_along(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"), side)).alias("cell")
    column = F.shiftright(F.col("cell") + (COLUMN >> 1), 32)
    placed = sides.select("*", cells).withColumn("i", column)
    return placed.withColumn("row", F.col("cell") - F.col("i") * F.lit(COLUMN))


def _finer(sides: DataFrame, side: float) -> tuple[float, int]:
    """The side halved until a border cell, weighted by its edges, holds about MOST times the root of what it held; and
    parts for the rows of edges and cells, which grow by as much at most."""
    held = _cells_of_rows(sides, side).groupBy("shape_id", "part", "cell").agg(F.count("*").cast("double").alias("n"))
    row = held.agg(F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("n")) / F.sum("n")).alias("crowd")).first()  # one row
    crowd = row["crowd"] or 1.0
    finer = 2 ** max(0, math.floor(math.log2(math.sqrt(crowd) / MOST)))
    return side / finer, max(1, math.ceil((row["n"] or 0.0) * finer / ROWS))


def shape_cells(shapes: DataFrame, side: float) -> DataFrame:
    """(shape_id, cell, inner, borders): cells of a shape, wholly inside or with, for each part whose border runs through
    the cell, the edges in the cell and whether an odd number of the part's other edges passes to the right of the
    middle of the cell's right side.

    Where shapes have many corners, cells are finer than ``side``, by a power of two that the column ``cell`` tells
    (``side_of``).
    """
    sides = edges(shapes)
    side, parts = _finer(sides, side)
    x0, y0, x1, y1 = (F.col(c) for c in ("x0", "y0", "x1", "y1"))
    middle = (F.col("row") + 0.5) * side
    # an edge's crossing of its row's middle lies in one of its cells: the last one whose left side is less
    at = F.when((y0 <= middle) != (y1 <= middle), _crossing(F.struct("x0", "y0", "x1", "y1"), middle))
    left, right = F.col("i") * side, (F.col("i") + 1) * side
    held = _cells_of_rows(sides.repartition(parts), side).withColumn("_at", at).repartition(parts, "shape_id", "part", "row")
    border = held.groupBy("shape_id", "part", "row", "i", "cell").agg(
        F.collect_list(F.struct("x0", "y0", "x1", "y1")).alias("edges"),
        F.count_if((F.col("_at") > left) & (F.col("_at") <= right)).alias("_here"),
        F.count_if(F.col("_at") > right).alias("_right"),
    )
    ahead = Window.partitionBy("shape_id", "part", "row").orderBy(F.desc("i"))
    border = border.withColumns({"_beyond": F.sum("_here").over(ahead) - F.col("_here"), "_next": F.lag("i").over(ahead)})
    odd = ((F.col("_beyond") - F.col("_right")) % 2 != 0).alias("odd")
    border = border.withColumn("border", F.struct(odd, "edges"))
    # between two border cells of a row, all cells lie on the same side of the part
    gap = F.when((F.col("_beyond") % 2 == 1) & (F.col("_next") > F.col("i") + 1), F.sequence(F.col("i") + 1, F.col("_next") - 1)).otherwise(F.array().cast("array<bigint>"))
    none = F.lit(None).cast(border.schema["border"].dataType)
    filled = F.transform(gap, lambda i: F.struct(_number(i, F.col("row")).alias("cell"), none.alias("border")))
    placed = border.select("shape_id", F.explode(F.concat(F.array(F.struct("cell", "border")), filled)).alias("c")).select("shape_id", "c.*")
    # by cell alone, as points meet them
    if parts > 1:
        placed = placed.repartition(max(parts, int(shapes.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "cell")
    placed = placed.groupBy("shape_id", "cell")
    out = placed.agg(F.max(F.col("border").isNull()).alias("inner"), F.collect_list("border").alias("borders"))
    return out.withColumn("cell", F.col("cell").alias("cell", metadata={"side": side, "parts": parts}))


def side_of(cells: DataFrame, side: float) -> float:
    """The side that ``shape_cells`` laid its cells out with."""
    return cells.schema["cell"].metadata.get("side", side)


def _dealt(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """Rows dealt by ``_cell`` as the cells are, where these take more than one part."""
    parts = cells.schema["cell"].metadata.get("parts", 1)
    return rows if parts == 1 else rows.repartition(max(parts, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "_cell")


def _crossing(e: Column, y: Column) -> Column:
    """Where an edge that isn't level has height ``y``."""
    return (e["x1"] - e["x0"]) * (y - e["y0"]) / (e["y1"] - e["y0"]) + e["x0"]


def _holds(x: Column, y: Column, side: float) -> Column:
    """Whether an odd number of one part's edges passes to the right of a point, told from the edges of its cell.

    From the middle of the cell's right side to the point, only the cell's own edges change the number: those that pass
    to the right of the point do; and of an edge that leaves to the right, its end is passed on the way as well.
    """
    right, middle = (F.floor(x / side) + 1) * side, (F.floor(y / side) + 0.5) * side
    passed = lambda ex, ey: ((ex > right) & ((ey <= y) != (ey <= middle))).cast("int")

    def flips(e: Column) -> Column:
        beside = F.when((e["y0"] <= y) != (e["y1"] <= y), (x < _crossing(e, y)).cast("int")).otherwise(0)
        return beside + passed(e["x0"], e["y0"]) + passed(e["x1"], e["y1"])

    return F.exists("borders", lambda b: F.aggregate(b["edges"], b["odd"].cast("int"), lambda n, e: n + flips(e)) % 2 == 1)


def points_in_shapes(points: DataFrame, cells: DataFrame, side: float, xy: tuple[str, str] = ("x", "y")) -> DataFrame:
    """Each point with each shape it lies in: the points' columns and shape_id. ``cells`` are those of ``shape_cells``
    with the same side. Points without coordinates lie in none; a point outside all shapes gives no row."""
    x, y = (F.col(c) for c in xy)
    side = side_of(cells, side)
    placed = points.where(x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y)).withColumn("_cell", cell_of(x, y, side))
    met = _dealt(placed, cells).join(cells.withColumnRenamed("cell", "_of"), F.col("_cell") == F.col("_of"))
    return met.where(F.col("inner") | _holds(x, y, side)).select(*points.columns, "shape_id")


def steps_of(traces: DataFrame, line: str, order: str, xy: tuple[str, str] = ("x", "y")) -> DataFrame:
    """(line, x0, y0, x1, y1): lines between consecutive traces; a line of one trace is a step of no length."""
    x, y = (F.col(c) for c in xy)
    w = Window.partitionBy(line).orderBy(order)
    known = traces.where(x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y))
    ends = known.select(line, x.alias("x0"), y.alias("y0"), F.lead(x).over(w).alias("x1"), F.lead(y).over(w).alias("y1"), F.lag(x).over(w).isNull().alias("_first"))
    return ends.where("x1 is not null or _first").select(line, "x0", "y0", F.coalesce("x1", "x0").alias("x1"), F.coalesce("y1", "y0").alias("y1"))


def _meets(e: Column) -> Column:
    """Whether a step and an edge have a point in common, touching ends included: their boxes overlap, and neither lies
    on one side of the other."""
    x0, y0, x1, y1 = (F.col(c) for c in ("x0", "y0", "x1", "y1"))
    apart = (F.greatest(x0, x1) < F.least(e["x0"], e["x1"])) | (F.greatest(e["x0"], e["x1"]) < F.least(x0, x1)) | (F.greatest(y0, y1) < F.least(e["y0"], e["y1"])) | (F.greatest(e["y0"], e["y1"]) < F.least(y0, y1))
    turn = lambda ax, ay, bx, by, px, py: F.signum((bx - ax) * (py - ay) - (by - ay) * (px - ax))
    step = turn(x0, y0, x1, y1, e["x0"], e["y0"]) * turn(x0, y0, x1, y1, e["x1"], e["y1"])
    edge = turn(e["x0"], e["y0"], e["x1"], e["y1"], x0, y0) * turn(e["x0"], e["y0"], e["x1"], e["y1"], x1, y1)
    return ~apart & (step <= 0) & (edge <= 0)


def lines_meeting_shapes(steps: DataFrame, cells: DataFrame, side: float, line: str) -> DataFrame:
    """(line, shape_id, n_steps): the shapes that each line has a point in common with, and how many of its steps do.

    A step that begins inside a shape is told in the cell it begins in; one that only passes through meets an edge, in
    the cell where it does, or an inner cell."""
    x0, y0 = F.col("x0"), F.col("y0")
    side = side_of(cells, side)
    walked = steps.withColumn("_step", F.struct("x0", "y0", "x1", "y1")).withColumn("_cell", F.explode(F.array_distinct(cells_along(x0, y0, F.col("x1"), F.col("y1"), side))))
    met = _dealt(walked, cells).join(cells.withColumnRenamed("cell", "_of"), F.col("_cell") == F.col("_of"))
    begins = (F.col("_cell") == cell_of(x0, y0, side)) & _holds(x0, y0, side)
    found = met.where(F.col("inner") | F.exists("borders", lambda b: F.exists(b["edges"], _meets)) | begins)
    return found.select(line, "shape_id", "_step").distinct().groupBy(line, "shape_id").agg(F.count("*").alias("n_steps"))


def lines_meeting(traces: DataFrame, shapes: DataFrame, side: float, line: str = "frame_id", order: str = "slow_time", xy: tuple[str, str] = ("x", "y")) -> DataFrame:
    """(line, shape_id, n_steps) from traces and shapes."""
    return lines_meeting_shapes(steps_of(traces, line, order, xy), shape_cells(shapes, side), side, line)


# Shapes made simpler and wider


def shape_area(parts: Column) -> Column:
    """Area of all parts, each as its largest ring less the others (holes)."""
    cross = lambda p, q: p["x"] * q["y"] - q["x"] * p["y"]

    def ring_area(ring: Column) -> Column:
        turned = F.concat(F.slice(ring, F.lit(2), F.greatest(F.lit(0), F.size(ring) - 1)), F.slice(ring, 1, 1))
        return F.abs(F.aggregate(F.zip_with(ring, turned, cross), F.lit(0.0), lambda a, b: a + b)) / 2

    def part_area(part: Column) -> Column:
        areas = F.transform(F.filter(part, lambda r: F.size(r) > 0), ring_area)
        return F.coalesce(2 * F.array_max(areas) - F.aggregate(areas, F.lit(0.0), lambda a, b: a + b), F.lit(0.0))

    return F.aggregate(F.transform(parts, part_area), F.lit(0.0), lambda a, b: a + b)


def simplified(shapes: DataFrame, tolerance: Column | float) -> DataFrame:
    """(shape_id, parts) with fewer corners (Douglas and Peucker): every corner that is left out lies within
    ``tolerance`` of the line that replaces it. Rings keep three corners at least; a tolerance of 0 or null keeps all.

    A shape is one row; its rings are worked on in Arrow batches, a ring at a time.
    """
    from firnline.functions.rings import simplify_batches

    given = tolerance if isinstance(tolerance, Column) else F.lit(float(tolerance))
    kind = shapes.schema["shape_id"].dataType.simpleString()
    slim = shapes.select("shape_id", F.col("parts").cast(PARTS).alias("parts"), F.coalesce(given.cast("double"), F.lit(0.0)).alias("_tolerance"))
    return slim.mapInArrow(simplify_batches, f"shape_id {kind}, parts {PARTS}")


def buffered(shapes: DataFrame, reach: Column | float, arc: int = 8) -> DataFrame:
    """(shape_id, parts) widened by ``reach``: each edge adds a part, the points around it. Round ends are drawn with
    ``arc`` chords a half-turn, outside of the circle, so a shape reaches ``reach`` everywhere and at most
    reach / cos(pi / (2 arc)). A reach of 0 or null changes nothing."""
    given = F.coalesce((reach if isinstance(reach, Column) else F.lit(float(reach))).cast("double"), F.lit(0.0))
    wide = given / math.cos(math.pi / (2 * arc))

    def around(p: Column, q: Column) -> Column:
        turn = F.atan2(q["y"] - p["y"], q["x"] - p["x"])
        corner = lambda c, k: F.struct((c["x"] + wide * F.cos(turn + k * (math.pi / arc) - math.pi / 2)).alias("x"), (c["y"] + wide * F.sin(turn + k * (math.pi / arc) - math.pi / 2)).alias("y"))
        ends = [(q, k) for k in range(arc + 1)] + [(p, k + arc) for k in range(arc + 1)]
        return F.array(F.array(*[corner(c, F.lit(float(k))) for c, k in ends]))

    def of_ring(ring: Column) -> Column:
        turned = F.concat(F.slice(ring, F.lit(2), F.greatest(F.lit(0), F.size(ring) - 1)), F.slice(ring, 1, 1))
        return F.zip_with(ring, turned, around)

    rings = F.filter(F.flatten(F.col("parts")), lambda r: F.size(r) > 0)
    more = F.flatten(F.transform(rings, of_ring)).cast(PARTS)
    return shapes.select("shape_id", F.when(given > 0, F.concat(F.col("parts").cast(PARTS), more)).otherwise(F.col("parts").cast(PARTS)).alias("parts"))


def covering(shapes: DataFrame) -> DataFrame:
    """Shapes with fewer corners that hold the whole of the given ones: simplified, then widened by the same tolerance,
    which follows from the shape's area (in square metres)."""
    from firnline.functions.physics import simplify_tolerance

    tolerance = simplify_tolerance(shape_area(F.col("parts")) / 1e6)
    kept = shapes.select("shape_id", "parts", tolerance.alias("_t"))
    slim = simplified(kept, F.col("_t")).join(kept.select(F.col("shape_id").alias("_s"), "_t"), F.col("shape_id") == F.col("_s"))
    return buffered(slim, F.col("_t"))
