"""Nearest neighbours without a reach, against all pairs."""

import math
import random

import pytest

from firnline.operators import matching


def plain(left, right, k):
    out = set()
    for i, g, x, y in left:
        near = sorted((math.sqrt((x - u) ** 2 + (y - v) ** 2), j) for j, h, u, v in right if h == g and None not in (u, v)) if None not in (x, y) else []
        out |= {(i, j, rank) for rank, (_, j) in enumerate(near[:k], 1)}
    return out


def found(spark, left, right, k):
    a = spark.createDataFrame(left, "i long, g string, x double, y double")
    b = spark.createDataFrame(right, "j long, h string, u double, v double")
    out = matching.nearest_k(a, b, k, "i", "j", ("x", "y"), ("u", "v"), (["g"], ["h"]))
    rows = [(r.i, r.j, r["rank"]) for r in out.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("k", [1, 4])
def test_clusters_and_far_points(spark, k):
    """A dense cluster, points far away from it, many at one place, few in a group, none in another."""
    rng = random.Random(k)
    right = [(n, "a", rng.gauss(0, 1), rng.gauss(0, 1)) for n in range(400)] + [(400 + n, "a", rng.uniform(-1000, 1000), rng.uniform(-1000, 1000)) for n in range(40)]
    right += [(500 + n, "a", 3.0, -7.0) for n in range(30)] + [(600 + n, "b", float(n), 0.0) for n in range(3)] + [(700, "c", 5.0, 5.0), (701, "c", None, 5.0)]
    left = [(n, rng.choice("abcd"), rng.uniform(-1500, 1500), rng.uniform(-1500, 1500)) for n in range(80)] + [(100 + n, "a", rng.gauss(0, 2), rng.gauss(0, 2)) for n in range(40)]
    left += [(200, "a", 3.0, -7.0), (201, "a", None, 1.0), (202, "c", 1e6, -1e6), (203, "b", 1.0, 0.0)]
    assert found(spark, left, right, k) == plain(left, right, k)


@pytest.mark.parametrize("right", [[], [(1, "a", 2.0, 2.0)], [(n, "a", 1.0, 1.0) for n in range(5)], [(n, "a", float(n), 0.0) for n in range(50)]])
def test_few_places(spark, right):
    left = [(1, "a", 0.5, 0.0), (2, "a", 40.2, 3.0), (3, "b", 0.0, 0.0)]
    assert found(spark, left, right, 2) == plain(left, right, 2)


def test_dense_points_within_a_reach(spark):
    """Many points to a cell of the reach, many at one place, groups: fine cells first; never a broadcast of cells."""
    rng = random.Random(7)
    right = [(n, rng.choice("ab"), float(rng.randint(0, 300)), float(rng.randint(0, 300))) for n in range(3000)]
    right += [(5000 - n, "a", 900.0, 900.0) for n in range(50)] + [(6000, "a", math.nan, 1.0), (6001, "b", None, 1.0)]
    left = [(n, rng.choice("abc"), float(rng.randint(-90, 390)), float(rng.randint(-90, 390))) for n in range(300)] + [(400, "a", 890.0, 900.0), (401, "a", math.nan, 5.0), (402, "b", None, 5.0)]
    a, b = spark.createDataFrame(left, "i long, g string, x double, y double"), spark.createDataFrame(right, "j long, h string, u double, v double")
    out = matching.nearest_within(a, b, 100.0, "i", "j", ("x", "y"), ("u", "v"), ("g", "h"))
    want = {}
    for i, g, x, y in left:
        near = [(math.sqrt((x - u) ** 2 + (y - v) ** 2), j) for j, h, u, v in right if h == g and None not in (x, u)]
        near = [p for p in near if p[0] < 100.0]
        if near:
            want[i] = min(near)[1]
    assert len(matching._sides(b, 100.0, 1, ("u", "v"), ["h"])) > 2
    assert {r.i: r.j for r in out.collect()} == want
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_sounder_picks_meet_few_places(spark):
    """Traces at one place are one place to picks, and the smallest id stands for them."""
    from pyspark.sql import functions as F

    from firnline.plans import sounder

    n = F.col("id")
    grams = spark.range(400).select(F.lit("b1").alias("flight"), n.alias("trace_id"), (n % 4 * 10.0).alias("x"), F.lit(0.0).alias("y"), F.array(F.lit(0.0), F.lit(1.0)).alias("twtt"), F.array(n * 1.0).alias("low_gain"), F.array(n * 1.0).alias("high_gain"))
    picks = spark.range(40).select(F.lit("b1").alias("flight"), n.alias("point_id"), (n % 5 * 10.0).alias("x"), F.lit(0.0).alias("y"), F.lit(500.0).alias("radar_height"), F.lit(900.0).alias("ice_thickness"))
    out = sounder.matched_picks(picks, grams)
    assert {(r.point_id, r.trace_id) for r in out.collect()} == {(i, min(i % 5, 3)) for i in range(40)}
    assert "_same" in out._jdf.queryExecution().optimizedPlan().toString()


def test_nearest_of_the_own_frame(spark):
    """Frames of few points meet their traces at once, without a broadcast; one of many points by cells."""
    rng = random.Random(11)
    place = lambda: (float(rng.randint(0, 50)), float(rng.randint(0, 50)))
    points = [(n, "a" if n < 70 else rng.choice("bcd"), *place()) for n in range(90)] + [(200, "b", None, 1.0), (201, None, 1.0, 1.0)]
    traces = [(n, rng.choice("abc"), *place()) for n in range(200)] + [(300, "c", math.nan, 1.0), (301, None, 1.0, 1.0)]
    a, b = spark.createDataFrame(points, "i long, f string, x double, y double"), spark.createDataFrame(traces, "j long, f string, u double, v double")
    known = [(n, f, x, y) for n, f, x, y in traces if f and not math.isnan(x)]
    want = {(i, j) for i, j, _ in plain([p for p in points if p[1]], known, 1)}
    assert {(r.i, r.j) for r in matching.nearest_in_group(a, b, "f", "i", "j", ("x", "y"), ("u", "v")).collect()} == want
    small = matching.nearest_in_group(a.where("f <> 'a'"), b, "f", "i", "j", ("x", "y"), ("u", "v"))
    assert "Broadcast" not in small._jdf.queryExecution().executedPlan().toString()


def test_k_nearest_broadcast_no_cells(spark):
    left = spark.createDataFrame([(n, float(n), 0.0) for n in range(50)], "i long, x double, y double")
    right = spark.createDataFrame([(n, float(n * n), 1.0) for n in range(50)], "j long, u double, v double")
    out = matching.nearest_k(left, right, 3, "i", "j", ("x", "y"), ("u", "v"))
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("crowd", [100, 2])
def test_nearest_in_blocks_of_cells(spark, monkeypatch, crowd):
    """Ties on a grid, a cluster, a gap, places far away, crowded cells; candidates are never dealt by left point."""
    monkeypatch.setattr(matching, "CROWD", crowd)
    rng = random.Random(3)
    right = [(n, "a", float(rng.randint(0, 60)), float(rng.randint(0, 60))) for n in range(500)] + [(1000 + n, "a", 5.0, 5.0) for n in range(9)]
    right += [(2000 + n, "a", 30 + rng.gauss(0, 0.2), 30 + rng.gauss(0, 0.2)) for n in range(300)] + [(3000, "a", 300.0, 300.0), (3001, "a", None, 1.0), (3002, "a", 1.0, math.nan)]
    left = [(n, "a", float(rng.randint(-9, 70)), float(rng.randint(-9, 70))) for n in range(300)] + [(400 + n, "a", 30 + rng.gauss(0, 0.3), 30 + rng.gauss(0, 0.3)) for n in range(60)]
    left += [(500, "a", 200.0, 250.0), (501, "a", -4000.0, 9.0), (502, "a", None, 1.0), (503, "a", math.nan, 1.0), (504, "a", 5.0, 5.0)]
    a, b = spark.createDataFrame(left, "i long, g string, x double, y double"), spark.createDataFrame(right, "j long, h string, u double, v double")
    out = matching.nearest_k(a, b, 3, "i", "j", ("x", "y"), ("u", "v"))
    assert out.columns == ["i", "g", "x", "y", "j", "h", "u", "v", "distance_m", "rank"]
    bad = lambda p: None in p or math.isnan(p[2]) or math.isnan(p[3])
    want = plain([p for p in left if not bad(p)], [p for p in right if not bad(p)], 3)
    rows = [(r.i, r.j, r["rank"]) for r in out.collect()]
    assert len(rows) == len(want) and set(rows) == want


def test_candidates_stay_with_their_cell(spark):
    """Where nine cells hold the nearest, no candidate is moved or ordered by left point."""
    left = spark.range(400).selectExpr("id as i", "cast(id % 20 + 5 as double) as x", "cast(id div 20 + 5 as double) as y")
    right = spark.range(900).selectExpr("id as j", "cast(id % 30 as double) as u", "cast(id div 30 as double) as v")
    out = matching.nearest_k(left, right, 3, "i", "j", ("x", "y"), ("u", "v"))
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "hashpartitioning(i#" not in plan and out.count() == 1200
