"""Rings of polygons as arrays of corners."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa


def _distances(points: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """From points to a line between two others."""
    line = b - a
    length = float(line @ line)
    along = np.clip((points - a) @ line / length, 0.0, 1.0) if length else np.zeros(len(points))
    return np.hypot(*(points - a - along[:, None] * line).T)


def kept_corners(ring: np.ndarray, tolerance: float) -> np.ndarray:
    """Places of the corners that a ring keeps: the first one, the one farthest from it, and on either way between them
    those that lie further than the tolerance from the line drawn so far."""
    n = len(ring)
    if n <= 3 or not tolerance > 0:
        return np.arange(n)
    closed = np.concatenate([ring, ring[:1]])
    far = int(np.hypot(*(ring - ring[0]).T).argmax())
    keep = np.zeros(n + 1, bool)
    keep[[0, far, n]] = True
    spans = [(0, far), (far, n)]
    while spans:
        low, high = spans.pop()
        if high - low < 2:
            continue
        away = _distances(closed[low + 1 : high], closed[low], closed[high])
        at = int(away.argmax())
        if away[at] > tolerance:
            middle = low + 1 + at
            keep[middle] = True
            spans += [(low, middle), (middle, high)]
    keep = keep[:n]
    if keep.sum() < 3:  # a ring as narrow as the tolerance: its corner farthest from the line between the two
        rest = np.flatnonzero(~keep)
        keep[rest[_distances(ring[rest], ring[0], ring[far]).argmax()]] = True
    return np.flatnonzero(keep)


def simplify_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns shape_id, parts and tolerance into shape_id and parts."""
    for batch in batches:
        parts, tolerances = batch.column(1), batch.column(2).to_numpy()
        rings_of = parts.flatten()  # of parts: lists of rings
        rings = rings_of.flatten()
        corners = rings.flatten()
        xy = np.stack([corners.field("x").to_numpy(zero_copy_only=False), corners.field("y").to_numpy(zero_copy_only=False)], 1) if len(corners) else np.zeros((0, 2))
        sizes = lambda a: a.value_lengths().fill_null(0).to_numpy()
        n_parts, n_rings, n_corners = sizes(parts), sizes(rings_of), sizes(rings)
        tolerance = np.repeat(np.repeat(tolerances, n_parts), n_rings)
        chosen, counts, low = [], [], 0
        for size, most in zip(n_corners.tolist(), tolerance.tolist()):
            found = kept_corners(xy[low : low + size], most) + low
            chosen.append(found)
            counts.append(len(found))
            low += size
        at = np.concatenate(chosen) if chosen else np.zeros(0, int)
        ends = lambda n: pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
        points = pa.StructArray.from_arrays([pa.array(xy[at, 0]), pa.array(xy[at, 1])], names=["x", "y"])
        out = pa.ListArray.from_arrays(ends(np.array(counts, np.int64)), points)
        for n in (n_rings, n_parts):
            out = pa.ListArray.from_arrays(ends(n), out)
        yield pa.RecordBatch.from_arrays([batch.column(0), out], names=["shape_id", "parts"])
