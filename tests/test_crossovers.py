"""Crossovers of bent tracks against all pairs of steps, and how much of them leaves a cell."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest

from firnline.operators import crossovers as cross
from firnline.operators import meeting

T = 100.0


def point_to_step(p, a, b):
    dx, dy = b[0] - a[0], b[1] - a[1]
    along = ((p[0] - a[0]) * dx + (p[1] - a[1]) * dy) / (dx * dx + dy * dy) if dx or dy else 0.0
    along = min(1.0, max(0.0, along))
    return math.hypot(p[0] - a[0] - along * dx, p[1] - a[1] - along * dy)


def apart(a, b, c, d):
    side = lambda p, q, r: (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    if side(c, d, a) * side(c, d, b) < 0 and side(a, b, c) * side(a, b, d) < 0:
        return 0.0
    return min(point_to_step(a, c, d), point_to_step(b, c, d), point_to_step(c, a, b), point_to_step(d, a, b))


def places(met):
    """Steps that meet, parted where one track jumps, then the other."""
    for n in (0, 1):
        parted = []
        for group in met:
            group = sorted(group, key=lambda m: m[n])
            cuts = [0, *[k for k in range(1, len(group)) if group[k][n] - group[k - 1][n] > cross.GAP], len(group)]
            parted += [group[a:b] for a, b in zip(cuts, cuts[1:])]
        met = parted
    return met


def plain(tracks):
    out = set()
    for fa, a in tracks.items():
        for fb, b in tracks.items():
            met = [(i, j) for i in range(len(a) - 1) for j in range(len(b) - 1) if fa < fb and apart(a[i], a[i + 1], b[j], b[j + 1]) <= T]
            for place in places([met]) if met else []:
                d, i, j = min((math.hypot(a[i + k][0] - b[j + m][0], a[i + k][1] - b[j + m][1]), i + k, j + m) for i, j in place for k in (0, 1) for m in (0, 1))
                if d <= T:
                    out.add((fa, fb, round(d, 6), i, j))
    return out


def bent(rng, steps, least, most):
    x, y, turn = rng.uniform(-900, 900), rng.uniform(-900, 900), rng.uniform(0, 7)
    points = [(x, y)]
    for _ in range(steps):
        turn += rng.gauss(0, 0.5)
        s = rng.uniform(least, most)
        points.append((points[-1][0] + s * math.cos(turn), points[-1][1] + s * math.sin(turn)))
    return points


@pytest.mark.parametrize("hot", [100_000, 20])
def test_bent_tracks(spark, monkeypatch, hot):
    """Loops, standing still, steps longer than cells, cells of many traces; places with gaps that other pieces close."""
    monkeypatch.setattr(cross, "HOT", hot)
    rng = random.Random(5)
    tracks = {f"f{n}": bent(rng, 90, *((20, 120) if n < 7 else (0.01, 5) if n < 9 else (100, 4000))) for n in range(12)}
    tracks["g"] = [(i * 90.0 - 3000.0, (i % 3) * 35.0) for i in range(70)]
    tracks["h"] = [(i * 90.0 - 3000.0, 150.0 + 40.0 * math.sin(i / 3)) for i in range(70)]
    rows = [(f, i, x, y, i) for f, points in tracks.items() for i, (x, y) in enumerate(points)] + [("g", 900, None, 1.0, 0), ("one", 1, 0.0, 0.0, 0)]
    traces = spark.createDataFrame(rows, "frame_id string, slow_time long, x double, y double, v long")
    found = [(r.frame_a, r.frame_b, round(r.distance_m, 6), r.v_a, r.v_b) for r in cross.find_crossovers(traces, T, ["v"], min_angle=0.0).collect()]
    want = plain(tracks)
    assert len(want) > 40 and sorted(found) == sorted(want)


def steps(frame, points, cell=1):
    n = len(points) - 1
    x, y = np.array(points, float).T
    columns = {"_cell": np.full(n, cell), "_part": np.zeros(n, np.int64), "_role": np.full(n, 3, np.int32), "_frame": [frame] * n, "_i": np.arange(1, n + 1, dtype=np.int32)}
    return pa.table(columns | {"_x": x[:-1], "_y": y[:-1], "_nx": x[1:], "_ny": y[1:]})


def test_a_crossing_leaves_its_cell_as_one_row():
    """A cell passes on a row per crossing, not per pair of steps; steps that leave a gap stay apart until all are known."""
    across, up = [(10.0 * i, 0.0) for i in range(-60, 61)], [(3.0, 10.0 * i) for i in range(-60, 61)]
    far = [(10.0 * i, 50.0 if abs(i) > 40 else 500.0) for i in range(-60, 61)]
    ints = [f"i{s}{e}" for s in "ab" for e in ("_low", "_high", "")]
    schema = pa.schema([("frame_a", pa.string()), ("frame_b", pa.string()), *[(c, pa.int32()) for c in ints], ("distance_m", pa.float64()), ("x_a", pa.float64())])
    run = meeting.runs_that_meet(T, cross.GAP, schema, [("x", "_x", "_nx")])
    out = pa.Table.from_batches(run(iter(pa.concat_tables([steps("a", across), steps("b", up)]).combine_chunks().to_batches())), schema).to_pylist()
    assert [(r["ia"], r["ib"], r["distance_m"], r["x_a"], r["ia_low"], r["ia_high"]) for r in out] == [(61, 61, 3.0, 0.0, 51, 71)]
    out = pa.Table.from_batches(run(iter(pa.concat_tables([steps("a", across), steps("c", far)]).combine_chunks().to_batches())), schema)
    assert out.num_rows > 2 and all(r["ia_low"] == r["ia_high"] for r in out.to_pylist())
