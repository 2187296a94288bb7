"""Every registered core query against its DuckDB counterpart on the smallest tables."""

import glob
import math
import os

import pytest

from firnline import more_queries, queries, spatial_queries  # noqa: F401  the others add to its tables

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.sql(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    return round(float(value), 6) + 0.0 if isinstance(value, (int, float)) or hasattr(value, "as_tuple") else str(value)


def table(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), sorted((tuple(plain(r[i]) for i in order) for r in rows), key=lambda r: [str(type(x)) + (f"{x:020.6f}" if isinstance(x, float) else str(x)) for x in r])


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, duck, name):
    frame = queries.QUERIES[name](spark, FOLDER)
    relation = duck.sql(queries.ORACLES[name])
    assert table(frame.columns, [tuple(r) for r in frame.collect()]) == table(relation.columns, relation.fetchall())


def test_every_query_has_a_counterpart():
    assert set(queries.QUERIES) == set(queries.ORACLES)


def test_crossovers_of_all_lines(spark):
    """All pairs of all steps of all tracks, by numpy; tracks are straight, so steps that meet are one place."""
    import numpy as np
    import pandas as pd

    lines = pd.read_parquet(f"{FOLDER}/lineitem.parquet").sort_values(["l_orderkey", "l_linenumber", "l_quantity"])
    tracks = {}
    for s, rows in lines.groupby("l_suppkey"):
        turn, along = math.radians(s * 37 % 360), 100.0 * np.arange(1, len(rows) + 1)
        points = np.stack([s * 48271 % 200_003 + along * math.cos(turn), s * 69621 % 200_003 + along * math.sin(turn)], 1)
        tracks[s] = points, rows["l_quantity"].to_numpy(float), turn

    expected = set()
    for a in tracks:
        for b in tracks:
            angle = math.degrees(tracks[a][2] - tracks[b][2]) % 180
            if a < b and min(angle, 180 - angle) >= 20:
                p, q = tracks[a][0], tracks[b][0]
                distance = np.hypot(*(p[:, None] - q[None]).transpose(2, 0, 1))
                i, j = np.unravel_index(distance.argmin(), distance.shape)
                if distance[i, j] <= 100:
                    expected.add((a, b, round(float(distance[i, j]), 3), float(tracks[a][1][i]), float(tracks[b][1][j])))
    found = queries.QUERIES["crossovers"](spark, FOLDER).collect()
    assert expected and {(r["frame_a"], r["frame_b"], round(r["distance_m"], 3), float(r["v_a"]), float(r["v_b"])) for r in found} == expected
    assert len(found) == len(expected)
