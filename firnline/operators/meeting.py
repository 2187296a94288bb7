"""Steps of two frames that meet, within cells: the part of ``crossovers`` that runs inside tasks, on arrays.

A cell's rows are steps; a frame's consecutive ones are a piece, as straight as its traces' deviation (``bend``) from the line
between its ends. Pieces whose lines come near enough are looked at step by step; nothing is left out that comes within the
threshold. Memory is that of a cell and of a fixed number of pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Rows and pairs that are looked at together.
ROWS, PAIRS = 50_000, 500_000
_MOST = np.iinfo(np.int64).max


def _ragged(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of ragged rows: each entry's row, and its place in the row."""
    row = np.repeat(np.arange(len(counts)), counts)
    return row, np.arange(len(row)) - (np.cumsum(counts) - counts)[row]


def _starts(new: np.ndarray, n: int) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], new])) if n else np.zeros(0, np.int64)


def _to_segment(x, y, xa, ya, xb, yb) -> np.ndarray:
    dx, dy = xb - xa, yb - ya
    square = dx * dx + dy * dy
    along = np.clip(((x - xa) * dx + (y - ya) * dy) / np.where(square > 0, square, 1.0), 0.0, 1.0)
    ex, ey = x - (xa + along * dx), y - (ya + along * dy)
    return np.sqrt(ex * ex + ey * ey)


def steps_apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distance between steps (x0, y0, x1, y1): 0 if they cross, else the least of the end points' distances to the other step."""
    side = lambda s, x, y: (s[2] - s[0]) * (y - s[1]) - (s[3] - s[1]) * (x - s[0])
    crosses = (side(b, a[0], a[1]) * side(b, a[2], a[3]) < 0) & (side(a, b[0], b[1]) * side(a, b[2], b[3]) < 0)
    ends = [_to_segment(*p, *s) for p, s in ((a[:2], b), (a[2:], b), (b[:2], a), (b[2:], a))]
    return np.where(crosses, 0.0, np.minimum.reduce(ends))


class _Cells:
    """Whole cells' steps, sorted by cell, frame and place along the track."""

    def __init__(self, rows: pa.RecordBatch, threshold: float, gap: int):
        column = lambda c: rows.column(rows.schema.get_field_index(c)).to_numpy(zero_copy_only=False)
        self.rows, self.threshold, self.gap = rows, threshold, gap
        cell, part, self.role = column("_cell"), column("_part"), column("_role")
        self.at = column("_i").astype(np.int64)
        self.step = np.stack([column(c) for c in ("_x", "_y", "_nx", "_ny")])
        frame = pc.rank(rows.column(rows.schema.get_field_index("_frame")), tiebreaker="dense").to_numpy().astype(np.int64)
        other = np.concatenate([[True], (cell[1:] != cell[:-1]) | (part[1:] != part[:-1])])
        turn = np.concatenate([[True], other[1:] | (frame[1:] != frame[:-1])])
        self.first = np.flatnonzero(turn | np.concatenate([[True], self.at[1:] != self.at[:-1] + 1]))
        self.size = np.diff(np.append(self.first, len(self.at)))
        piece = np.repeat(np.arange(len(self.first)), self.size)
        self.line = np.concatenate([self.step[:2, self.first], self.step[2:, self.first + self.size - 1]])
        # wider by what rounding may take
        self.bend = np.maximum.reduceat(_to_segment(*self.step[:2], *self.line[:, piece]), self.first) + 1e-9 * (threshold + np.abs(self.line).max(0))
        dx, dy = self.line[2:] - self.line[:2]
        length = np.maximum(np.hypot(dx, dy), 1e-300)
        self.normal = np.stack([dy / length, -dx / length])
        self.middle, self.half = (self.step[:2] + self.step[2:]) / 2, np.hypot(*(self.step[2:] - self.step[:2])) / 2
        # a piece meets those of the later frames of its cell
        edges = lambda new: np.append(np.flatnonzero(new[self.first])[1:], len(self.first))
        spread = lambda new: np.repeat(edges(new), np.diff(np.append(0, edges(new))))
        self.later, self.until = spread(turn), spread(other)

    def _near(self, line: np.ndarray, piece: np.ndarray, reach: np.ndarray) -> np.ndarray:
        """False only for lines all of whose points are further than ``reach`` from the piece's line."""
        ax, ay, nx, ny = self.line[0, piece], self.line[1, piece], self.normal[0, piece], self.normal[1, piece]
        d, e = (line[0] - ax) * nx + (line[1] - ay) * ny, (line[2] - ax) * nx + (line[3] - ay) * ny
        return (np.minimum(d, e) <= reach) & (np.maximum(d, e) >= -reach)

    def _steps(self, mine: np.ndarray, theirs: np.ndarray, role: int) -> tuple[np.ndarray, np.ndarray]:
        """(pair, step): the steps of pieces ``mine`` that may meet pieces ``theirs``."""
        pair, k = _ragged(self.size[mine])
        row = self.first[mine][pair] + k
        keep = self._near(self.step[:, row], theirs[pair], (self.threshold + self.bend[theirs])[pair]) & (self.role[row] & role > 0)
        return pair[keep], row[keep]

    def runs(self, schema: pa.Schema, carried: list[tuple[str, str, str]]) -> Iterator[pa.RecordBatch]:
        leads = np.flatnonzero((np.bitwise_or.reduceat(self.role, self.first) & 1 > 0) & (self.until > self.later))
        counts = (self.until - self.later)[leads]
        work = np.cumsum(counts)
        low = 0
        while low < len(leads):
            high = max(low + 1, int(np.searchsorted(work, (work[low - 1] if low else 0) + PAIRS, "right")))
            own, k = _ragged(counts[low:high])
            p = leads[low:high][own]
            q = self.later[p] + k
            low = high
            for _ in (0, 1):
                keep = self._near(self.line[:, q], p, self.threshold + self.bend[p] + self.bend[q])
                p, q = q[keep], p[keep]
            (pair_a, row_a), (pair_b, row_b) = self._steps(p, q, 1), self._steps(q, p, 2)
            each = np.bincount(pair_b, minlength=len(p))
            before, each = (np.cumsum(each) - each)[pair_a], each[pair_a]
            steps = np.cumsum(each)
            a = 0
            while a < len(pair_a):  # pairs of pieces stay whole
                b = max(a + 1, int(np.searchsorted(steps, (steps[a - 1] if a else 0) + 4 * PAIRS, "right")))
                b = int(np.searchsorted(pair_a, pair_a[b - 1], "right"))
                own, k = _ragged(each[a:b])
                yield from self._met(p, q, pair_a[a:b][own], row_a[a:b][own], row_b[before[a:b][own] + k], schema, carried)
                a = b

    def _met(self, p, q, pair, r, s, schema: pa.Schema, carried) -> Iterator[pa.RecordBatch]:
        """The runs of steps r and s that meet, of pieces p and q of their pair."""
        threshold, at = self.threshold, self.at
        reach = self.half[r] + self.half[s] + threshold
        dx, dy = self.middle[:, r] - self.middle[:, s]
        close = dx * dx + dy * dy <= 1.000001 * reach * reach
        pair, r, s = pair[close], r[close], s[close]
        u, v = self.step[:, r], self.step[:, s]
        between = lambda i, j: np.sqrt((u[2 * i] - v[2 * j]) ** 2 + (u[2 * i + 1] - v[2 * j + 1]) ** 2)
        ends = np.stack([between(i, j) for i in (0, 1) for j in (0, 1)])
        least = ends.min(0)
        meets = least <= threshold
        unsure = np.flatnonzero(~meets)
        meets[unsure] = steps_apart(u[:, unsure], v[:, unsure]) <= threshold
        pair, r, s, least, ends = pair[meets], r[meets], s[meets], least[meets], ends[:, meets]
        if not len(pair):
            return
        start = _starts(pair[1:] != pair[:-1], len(pair))
        run = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(pair))))
        i, j = at[r], at[s]
        # steps with gaps among them may be parted by the frames' other steps, or not: they stay apart until all are known
        gaps = np.zeros(len(start), bool)
        for n in (i, j):
            extent = np.maximum.reduceat(n, start) - np.minimum.reduceat(n, start)
            wide = np.flatnonzero(extent[run] > self.gap)
            known = np.unique(np.stack([run[wide], n[wide]]), axis=1)[0] if len(wide) else wide
            gaps |= (extent > self.gap) & (np.bincount(known, minlength=len(start)) <= extent)
        if gaps.any():
            start = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]) | gaps[run])
            run = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(pair))))
        best = np.minimum.reduceat(least, start)
        key = np.full(len(r), _MOST)
        for n, e in enumerate(ends):
            key = np.minimum(key, np.where(e == best[run], ((i + n // 2) << 32) | (j + n % 2), _MOST))
        key = np.minimum.reduceat(key, start)
        columns = {"distance_m": best, "ia": key >> 32, "ib": key & 0xFFFFFFFF}
        for side, n, piece in (("a", i, p[pair[start]]), ("b", j, q[pair[start]])):
            first = self.first[piece]
            columns |= {f"i{side}_low": np.minimum.reduceat(n, start), f"i{side}_high": np.maximum.reduceat(n, start)}
            row = first + columns[f"i{side}"] - at[first]
            last = row == first + self.size[piece]  # where the piece's last step ends
            row = pa.array(row - last)
            taken = lambda c, rows: self.rows.column(self.rows.schema.get_field_index(c)).take(rows)
            columns[f"frame_{side}"] = taken("_frame", pa.array(first))
            for name, here, ahead in carried:
                columns[f"{name}_{side}"] = pc.if_else(pa.array(last), taken(ahead, row), taken(here, row))
        yield pa.RecordBatch.from_arrays([c.cast(f.type) if isinstance(c := columns[f.name], pa.Array) else pa.array(c).cast(f.type) for f in schema], schema=schema)


def runs_that_meet(threshold: float, gap: int, schema: pa.Schema, carried: list[tuple[str, str, str]]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow over steps (_cell, _part, _role, _frame, _i, _x, _y, _nx, _ny and what is ``carried``: name, column
    of the step's first trace, of its last one), sorted by cell, part, frame and _i. One row per run of steps of two frames
    that meet in a cell, with the nearest pair of their traces; steps of role 1 are a frame's a side, of role 2 its b side."""

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < ROWS:
                continue
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            cell, part = (table.column(table.schema.get_field_index(c)).to_numpy() for c in ("_cell", "_part"))
            whole = int(np.flatnonzero((cell != cell[-1]) | (part != part[-1]))[-1]) + 1 if cell[0] != cell[-1] or part[0] != part[-1] else 0
            if whole:
                yield from _Cells(table.slice(0, whole), threshold, gap).runs(schema, carried)
            held = [table.slice(whole)]
        if sum(b.num_rows for b in held):
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            yield from _Cells(table, threshold, gap).runs(schema, carried)

    return run
