"""Queries of the spatial joins: suppliers' tracks against two-part polygons, one shape per nation."""

from __future__ import annotations

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from firnline.operators import matching, spatial
from firnline.queries import PLANE, _SPACING, _SQUARE, _other, _plane, _r, _table, _tracks, query

SIDE = 2_500.0

#: A part's corners turn around its middle, one per customer, each as far out as the customer's key has it.
_SHAPES = f"""v AS (SELECT c_nationkey AS n, c_custkey % 2 AS part, c_custkey AS k, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY c_nationkey, c_custkey % 2) AS m FROM customer WINDOW w AS (PARTITION BY c_nationkey, c_custkey % 2 ORDER BY c_custkey)),
c AS (SELECT n, part, i, round((n * 73939 + part * 50021) % {_SQUARE} + (4000 + k * 7919 % 9000) * cos(2 * pi() * i / m), 3) AS x, round((n * 39119 + part * 91193) % {_SQUARE} + (4000 + k * 7919 % 9000) * sin(2 * pi() * i / m), 3) AS y FROM v),
e AS (SELECT n, part, x AS x0, y AS y0, coalesce(lead(x) OVER w, first_value(x) OVER w) AS x1, coalesce(lead(y) OVER w, first_value(y) OVER w) AS y1 FROM c WINDOW w AS (PARTITION BY n, part ORDER BY i))"""
_LINES = f"""t AS (SELECT l_suppkey AS f, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_quantity) AS i FROM lineitem),
p AS (SELECT *, f * 48271 % {_SQUARE} + i * {_SPACING}::DOUBLE * cos(radians(f * 37 % 360)) AS x, f * 69621 % {_SQUARE} + i * {_SPACING}::DOUBLE * sin(radians(f * 37 % 360)) AS y FROM t)"""
_HELD = """h AS (SELECT f, i, n FROM (SELECT f, i, n, part FROM p JOIN e ON (y0 <= y) <> (y1 <= y) AND x < (x1 - x0) * (y - y0) / (y1 - y0) + x0 GROUP BY f, i, n, part HAVING count(*) % 2 = 1) GROUP BY f, i, n)"""


def _shapes(spark, sf_dir):
    n, k = F.col("c_nationkey"), F.col("c_custkey")
    by = Window.partitionBy("c_nationkey", k % 2)
    turn = (F.row_number().over(by.orderBy(k)) - 1) * (2 * math.pi) / F.count("*").over(by)
    out = F.lit(4000) + k * 7919 % 9000
    part = k % 2
    x = F.round((n * 73939 + part * 50021) % _SQUARE + out * F.cos(turn), 3)
    y = F.round((n * 39119 + part * 91193) % _SQUARE + out * F.sin(turn), 3)
    corners = _table(spark, sf_dir, "customer").select(n.cast("long").alias("shape_id"), part.alias("part"), F.struct(turn.alias("turn"), x.alias("x"), y.alias("y")).alias("c"))
    rings = corners.groupBy("shape_id", "part").agg(F.transform(F.array_sort(F.collect_list("c")), lambda c: F.struct(c["x"].alias("x"), c["y"].alias("y"))).alias("ring"))
    return rings.groupBy("shape_id").agg(F.collect_list(F.array("ring")).alias("parts"))


@query(f"WITH {_SHAPES}, {_LINES}, {_HELD} SELECT f AS frame_id, i AS slow_time, n::BIGINT AS shape_id FROM h")
def points_in_regions(spark, sf_dir):
    """All traces against all polygons, as rows."""
    cells = spatial.shape_cells(_shapes(spark, sf_dir), SIDE)
    return spatial.points_in_shapes(_tracks(spark, sf_dir).select("frame_id", "slow_time", "x", "y"), cells, SIDE).select("frame_id", F.col("slow_time").cast("long").alias("slow_time"), "shape_id")


@query(f"""WITH {_SHAPES}, {_LINES}, {_HELD}, s AS (SELECT f, i, x AS sx, y AS sy, lead(x) OVER w AS tx, lead(y) OVER w AS ty FROM p WINDOW w AS (PARTITION BY f ORDER BY i)),
q AS (SELECT DISTINCT f, i, n FROM s JOIN e ON greatest(sx, tx) >= least(x0, x1) AND greatest(x0, x1) >= least(sx, tx) AND greatest(sy, ty) >= least(y0, y1) AND greatest(y0, y1) >= least(sy, ty)
AND sign((tx - sx) * (y0 - sy) - (ty - sy) * (x0 - sx)) * sign((tx - sx) * (y1 - sy) - (ty - sy) * (x1 - sx)) <= 0 AND sign((x1 - x0) * (sy - y0) - (y1 - y0) * (sx - x0)) * sign((x1 - x0) * (ty - y0) - (y1 - y0) * (tx - x0)) <= 0 WHERE tx IS NOT NULL)
SELECT f AS frame_id, n::BIGINT AS shape_id, count(*)::BIGINT AS n_steps FROM (SELECT f, i, n FROM q UNION SELECT f, i, n FROM h JOIN s USING (f, i) WHERE tx IS NOT NULL) GROUP BY f, n""")
def lines_in_regions(spark, sf_dir):
    """Frames as lines: the polygons that each one meets."""
    return spatial.lines_meeting(_tracks(spark, sf_dir), _shapes(spark, sf_dir), SIDE).select("frame_id", "shape_id", "n_steps")


@query(f"""WITH {PLANE}, o AS (SELECT p_partkey, (p_partkey * 6151 % 20011)::DOUBLE AS px, (p_partkey * 50053 % 20021)::DOUBLE AS py FROM part), d AS (SELECT o_orderkey, p_partkey, sqrt((x - px) * (x - px) + (y - py) * (y - py)) AS d FROM g, o)
SELECT o_orderkey, p_partkey, round(d, 6) AS distance_m, rank FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY d, p_partkey)::INT AS rank FROM d) WHERE rank <= 3""")
def nearest_three(spark, sf_dir):
    """Each point's three nearest partners, however far."""
    out = matching.nearest_k(_plane(spark, sf_dir).select("o_orderkey", "x", "y"), _other(spark, sf_dir), 3, "o_orderkey", "p_partkey", ("x", "y"), ("px", "py"))
    return out.select("o_orderkey", "p_partkey", _r("distance_m").alias("distance_m"), "rank")
