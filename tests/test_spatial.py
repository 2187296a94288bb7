"""Spatial joins against plain geometry."""

import math
import random

import pytest
from pyspark.sql import functions as F

from firnline.operators import spatial
from firnline.plans import run


def odd(part, x, y):
    n = 0
    for ring in part:
        for (ax, ay), (bx, by) in zip(ring, [*ring[1:], ring[0]]):
            if (ay <= y) != (by <= y) and ax + (y - ay) * (bx - ax) / (by - ay) > x:
                n += 1
    return n % 2 == 1


def meets(p, q, a, b):
    def turn(o, u, v):
        d = (u[0] - o[0]) * (v[1] - o[1]) - (u[1] - o[1]) * (v[0] - o[0])
        return (d > 0) - (d < 0)

    if any(max(p[k], q[k]) < min(a[k], b[k]) or max(a[k], b[k]) < min(p[k], q[k]) for k in (0, 1)):
        return False
    return turn(p, q, a) * turn(p, q, b) <= 0 and turn(a, b, p) * turn(a, b, q) <= 0


def star(rng, cx, cy, n, low, high):
    return [(cx + (r := rng.uniform(low, high)) * math.cos(2 * math.pi * k / n), cy + r * math.sin(2 * math.pi * k / n)) for k in range(n)]


def shapes_of(rng):
    square = [(0.0, 0.0), (30.0, 0.0), (30.0, 30.0), (0.0, 30.0)]
    out = {1: [[square, [(10.0, 10.0), (20.0, 10.0), (20.0, 20.0), (10.0, 20.0)]]], 2: [[[(5.0, 5.0), (6.0, 5.0), (5.5, 6.0)]]], 3: [[square], [[(-40.0, -7.0), (-20.0, -7.0), (-30.0, 12.5)]]]}
    for k in range(4, 12):
        out[k] = [[star(rng, rng.uniform(-60, 60), rng.uniform(-60, 60), rng.randrange(3, 40), 2, 30)] for _ in range(rng.randrange(1, 3))]
    return out


def table(spark, shapes):
    rows = [(k, [[[{"x": x, "y": y} for x, y in ring] for ring in part] for part in parts]) for k, parts in shapes.items()]
    return spark.createDataFrame([*rows, (98, []), (99, [[[]]])], f"shape_id long, parts {spatial.PARTS}")


@pytest.mark.parametrize("side", [4.0, 23.0, 1000.0])
def test_points(spark, side):
    rng = random.Random(3)
    shapes = shapes_of(rng)
    points = [(n, rng.uniform(-90, 90), rng.uniform(-90, 90)) for n in range(700)] + [(1000 + n, float(rng.randrange(-5, 35)), float(rng.randrange(-5, 35))) for n in range(300)]
    frame = spark.createDataFrame([*points, (5000, None, 1.0), (5001, float("nan"), 1.0)], "p long, x double, y double")
    got = {(r.p, r.shape_id) for r in spatial.points_in_shapes(frame, spatial.shape_cells(table(spark, shapes), side), side).collect()}
    assert got == {(p, k) for p, x, y in points for k, parts in shapes.items() if any(odd(part, x, y) for part in parts)}


@pytest.mark.parametrize("side", [5.0, 40.0])
def test_lines(spark, side):
    rng = random.Random(4)
    shapes = shapes_of(rng)
    lines = {n: [(rng.uniform(-90, 90), rng.uniform(-90, 90)) for _ in range(rng.randrange(1, 5))] for n in range(60)}
    lines |= {100: [(15.0, 15.0), (16.0, 14.0)], 101: [(-5.0, 0.0), (0.0, 0.0)], 102: [(2.0, 2.0)], 103: [(-9.0, 31.0), (40.0, 31.0)], 104: [(15.0, -5.0), (15.0, 50.0)]}
    rows = [(n, k, x, y) for n, line in lines.items() for k, (x, y) in enumerate(line)]
    traces = spark.createDataFrame(rows, "frame_id long, slow_time long, x double, y double")
    want = {}
    for n, line in lines.items():
        for p, q in zip(line, line[1:] or line):
            for k, parts in shapes.items():
                edges = [(a, b) for part in parts for ring in part for a, b in zip(ring, [*ring[1:], ring[0]])]
                if any(meets(p, q, a, b) for a, b in edges) or any(odd(part, *p) for part in parts):
                    want[n, k] = want.get((n, k), 0) + 1
    got = {(r.frame_id, r.shape_id): r.n_steps for r in spatial.lines_meeting(traces, table(spark, shapes), side).collect()}
    assert got == want


def test_a_group_of_shapes_is_one(spark):
    shapes = {1: [[[(0.0, 0.0), (9.0, 0.0), (9.0, 9.0), (0.0, 9.0)]]], 2: [[[(5.0, 5.0), (20.0, 5.0), (20.0, 9.0), (5.0, 9.0)]]]}
    one = spatial.merged(table(spark, shapes).withColumn("region", F.lit("r")), "region")
    points = spark.createDataFrame([(1, 1.0, 1.0), (2, 6.0, 6.0), (3, 15.0, 6.0), (4, 15.0, 2.0)], "p long, x double, y double")
    out = spatial.points_in_shapes(points, spatial.shape_cells(one, 3.0), 3.0)
    assert sorted((r.p, r.shape_id) for r in out.collect()) == [(1, "r"), (2, "r"), (3, "r")]


def test_frames_are_chosen_by_their_line_not_their_box(spark):
    frames = spark.createDataFrame([("A", "s", "c", 0.0, 0.0, 100.0, 100.0), ("B", "s", "c", 0.0, 0.0, 100.0, 100.0)], "frame_id string, segment_id string, collection string, x_min double, y_min double, x_max double, y_max double")
    tracks = spark.createDataFrame([("A", 0, 0.0, 0.0), ("A", 1, 100.0, 100.0), ("B", 0, 0.0, 100.0), ("B", 1, 0.0, 0.0), ("B", 2, 100.0, 0.0), ("other", 0, 50.0, 50.0)], "frame_id string, slow_time long, x double, y double")
    shapes = table(spark, {1: [[[(40.0, 40.0), (60.0, 40.0), (60.0, 60.0), (40.0, 60.0)]]]})
    assert [r.frame_id for r in run.select_frames(frames, {}, tracks=tracks, shapes=shapes, side=10.0).collect()] == ["A"]


def gap(p, a, b):
    line = (b[0] - a[0], b[1] - a[1])
    length = line[0] ** 2 + line[1] ** 2
    t = max(0.0, min(1.0, ((p[0] - a[0]) * line[0] + (p[1] - a[1]) * line[1]) / length)) if length else 0.0
    return math.hypot(p[0] - a[0] - t * line[0], p[1] - a[1] - t * line[1])


def to_boundary(parts, p):
    return min(gap(p, a, b) for part in parts for ring in part for a, b in zip(ring, [*ring[1:], ring[0]]))


def read_shapes(frame):
    return {r.shape_id: [[[(c.x, c.y) for c in ring] for ring in part] for part in r.parts] for r in frame.collect()}


def test_simplified_shapes_stay_within_the_tolerance(spark):
    rng = random.Random(6)
    shapes = {1: [[star(rng, 0, 0, 200, 40, 50)], [star(rng, 300, 0, 80, 10, 90)]], 2: [[[(0.0, 0.0), (50.0, 0.0), (50.0, 0.01), (0.0, 0.01)]]], 3: [[[(0.0, 0.0), (9.0, 0.0), (0.0, 9.0)]]]}
    out = read_shapes(spatial.simplified(table(spark, shapes), 4.0))
    assert set(out) == {1, 2, 3, 98, 99} and out[3] == shapes[3] and len(out[2][0][0]) == 3 and out[98] == []
    for part, slim in zip(shapes[1], out[1]):
        ring, few = part[0], slim[0]
        assert len(few) < len(ring) and [c for c in ring if c in set(few)] == few
        assert max(to_boundary([[few]], p) for p in ring) <= 4.0 + 1e-9
    assert read_shapes(spatial.simplified(table(spark, shapes), F.when(F.col("shape_id") == 1, 0.0)))[1] == shapes[1]


def test_widened_shapes_hold_all_that_is_near(spark):
    rng = random.Random(8)
    shapes = {1: [[star(rng, 0, 0, 12, 10, 40)]], 2: [[[(60.0, 0.0), (90.0, 0.0), (90.0, 30.0), (60.0, 30.0)], [(65.0, 5.0), (85.0, 5.0), (85.0, 25.0), (65.0, 25.0)]]]}
    points = [(n, rng.uniform(-60, 110), rng.uniform(-60, 60)) for n in range(600)]
    frame = spark.createDataFrame(points, "p long, x double, y double")
    wide = spatial.buffered(table(spark, shapes), 5.0)
    held = {(r.p, r.shape_id) for r in spatial.points_in_shapes(frame, spatial.shape_cells(wide, 10.0), 10.0).collect()}
    for p, x, y in points:
        for k, parts in shapes.items():
            inside, away = any(odd(part, x, y) for part in parts), to_boundary(parts, (x, y))
            if inside or away <= 5.0:
                assert (p, k) in held
            elif away > 5.0 / math.cos(math.pi / 16):
                assert (p, k) not in held


def test_covering_shapes_hold_the_given_ones(spark):
    rng = random.Random(9)
    shapes = {1: [[star(rng, 0, 0, 300, 60_000, 61_000)]], 2: [[star(rng, 0, 0, 20, 100, 200)]]}
    assert abs(table(spark, {5: [[[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)], [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 2.0)]]]}).where("shape_id = 5").select(spatial.shape_area(F.col("parts"))).first()[0] - 15.0) < 1e-9
    out = spatial.covering(table(spark, shapes).where("shape_id < 90"))
    assert {r.shape_id: r.n for r in out.select("shape_id", F.size("parts").alias("n")).collect()}[2] == 1  # small shapes stay as they are
    points = [(n, r * math.cos(a), r * math.sin(a)) for n in range(400) for a in [rng.uniform(0, 7)] for r in [rng.uniform(59_000, 62_000)]]
    frame = spark.createDataFrame(points, "p long, x double, y double")
    held = {r.p for r in spatial.points_in_shapes(frame, spatial.shape_cells(out.where("shape_id = 1"), 5_000.0), 5_000.0).collect()}
    own = {p for p, x, y in points if odd(shapes[1][0], x, y)}
    assert own <= held and len(held) < len(points)


def test_cells_of_many_corners_are_finer(spark):
    """A star of 3,000 spikes: a cell holds few of its edges, and the points in it are told as by all edges."""
    rng = random.Random(12)
    shapes = {1: [[star(rng, 0, 0, 3000, 5, 90)], [star(rng, 30, 10, 500, 5, 90)]], 2: [[[(0.0, 0.0), (50.0, 0.0), (50.0, 50.0), (0.0, 50.0)]]]}
    cells = spatial.shape_cells(table(spark, shapes), 40.0)
    side = spatial.side_of(cells, 40.0)
    assert side < 40.0 and cells.select(F.max(F.aggregate("borders", F.lit(0), lambda n, b: n + F.size(b["edges"])))).first()[0] < 1500
    points = [(n, rng.uniform(-100, 130), rng.uniform(-100, 110)) for n in range(200)] + [(1000 + n, side * rng.randrange(-9, 9), side * (rng.randrange(-9, 9) + 0.5)) for n in range(40)]
    frame = spark.createDataFrame(points, "p long, x double, y double")
    got = {(r.p, r.shape_id) for r in spatial.points_in_shapes(frame, cells, 40.0).collect()}
    assert got == {(p, k) for p, x, y in points for k, parts in shapes.items() if any(odd(part, x, y) for part in parts)}
