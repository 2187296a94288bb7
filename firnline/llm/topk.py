"""Exact top-k inner products by threshold reading of sorted lists (operator 6).

No-random-access aggregation: each component of the vectors of a block is a list sorted by value. For a query, the lists
are read from their favourable end, in growing depth (FIRST of a list, then twice as far each time), and what is read
counts towards its vector's score, for many queries at once as a product of matrices. An entry not read yet lies between its list's last read value and its far
end, so every vector has a lower and an upper bound. Reading stops when at most FEW of the vectors have an upper bound
that reaches the k-th best lower bound; the others cannot qualify, and only these few get final scores. The k-th best
score of the blocks before holds for the next, and a block whose component extremes can't reach it is not read at all.

Vectors are packed into blocks of narrow integers, a slab holds SLAB blocks, and each query block meets each slab in one
task, which reads the slab's blocks in turn and gives at most k rows a query; nothing that grows with the table is
broadcast. The table is copied once for each query block, that is once for QUERY_BLOCK * every rows.

Defined cases: vectors that are null, empty, hold null or non-finite components, or components so large that
a score could leave 64 bits, take no part; vectors are compared
with those of the same length; a query never meets rows with its own id; ties go to the smaller id; an empty table
gives an empty table; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from firnline.llm.common import Scratch, arrow_schema, default_partitions, map_rows

BLOCK, SLAB, QUERY_BLOCK = 4096, 16, 65_536
QUERY_ROWS = 128
#: The share of a list that is read first, and the share of vectors still open at which reading stops.
FIRST, FEW = 1 / 64, 0.05


class Lists:
    """A block's vectors and each component's values in order."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.sorted = np.sort(vectors, axis=0)
        self.low, self.high = self.sorted[0], self.sorted[-1]


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def read_lists(query_ids: np.ndarray, queries: np.ndarray, block: Lists, k: int, floor: np.ndarray) -> tuple[list[tuple[int, int, int]], float]:
    """(query's number, vec_id, score) of what each query's k best of a block can be, at ``floor`` or above; the share
    of list entries that was read. All are whole numbers, and bounds are exact."""
    n, dims = block.vectors.shape
    reach = int(np.abs(queries).max(initial=0)) * max(abs(int(block.low.min())), abs(int(block.high.max()))) * dims
    kind = np.float32 if reach < 1 << 24 else np.float64 if reach < 1 << 53 else np.int64
    q = queries.astype(kind)
    up, down = np.maximum(q, 0), np.minimum(q, 0)  # read from the top where positive, from the bottom where negative
    own = query_ids[:, None] == block.ids[None, :]
    low, high, values = block.low.astype(kind), block.high.astype(kind), block.vectors.astype(kind)
    reachable = up @ high + down @ low >= floor
    if not reachable.any():
        return [], 0.0
    depth = max(1, int(np.ceil(FIRST * n)))
    while True:  # an entry beyond the depth counts as its list's last read value at most, and as its far end at least
        top, bottom = block.sorted[n - depth].astype(kind), block.sorted[depth - 1].astype(kind)
        upper = up @ np.maximum(values, top).T + down @ np.minimum(values, bottom).T
        lower = up @ np.where(values >= top, values, low).T + down @ np.where(values <= bottom, values, high).T
        lower[own] = -reach - 1
        kth = np.maximum(floor, np.partition(lower, n - k, axis=1)[:, -k]) if n > k else floor
        open_ = ~own & (upper >= kth[:, None]) & reachable[:, None]
        if depth == n or open_.mean() <= FEW:
            break
        depth = min(n, 2 * depth)
    found = []
    for r, row in enumerate(open_):
        left = np.flatnonzero(row)
        final = block.vectors[left].astype(np.int64) @ queries[r].astype(np.int64)
        found += [(r, int(block.ids[left[b]]), int(final[b])) for b in _best(block.ids[left], final, k)]
    return found, depth / n


def slab_top(query_ids: np.ndarray, queries: np.ndarray, blocks: Iterable[tuple[np.ndarray, np.ndarray]], k: int) -> tuple[list[tuple[int, int, int]], list[float]]:
    """(query_id, vec_id, score) of each query's k best over the blocks, and the share read of each block's lists."""
    best: list[list[tuple[int, int]]] = [[] for _ in query_ids]
    floor = np.full(len(query_ids), np.iinfo(np.int64).min, np.int64)
    shares = []
    for ids, vectors in blocks:
        lists = Lists(ids, vectors)
        for at in range(0, len(queries), QUERY_ROWS):
            part = slice(at, at + QUERY_ROWS)
            found, share = read_lists(query_ids[part], queries[part], lists, k, floor[part])
            shares.append(share)
            for r, vec_id, score in found:
                best[at + r].append((-score, vec_id))
            for r in {f[0] for f in found}:
                best[at + r] = sorted(best[at + r])[:k]
                if len(best[at + r]) == k:
                    floor[at + r] = -best[at + r][-1][0]
    return [(int(i), vec_id, -minus) for i, own in zip(query_ids, best) for minus, vec_id in own], shares


def _narrow(values: np.ndarray) -> np.ndarray:
    """The same whole numbers in the fewest bytes."""
    most = int(np.abs(values).max(initial=0))
    return values.astype("<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8")


def _packed(rows: DataFrame) -> DataFrame:
    """(dim, block, width, ids binary, vals binary) of blocks of rows (id, dim, block, value binary)."""
    schema = pa.schema([("dim", pa.int32()), ("block", pa.int32()), ("width", pa.int32()), ("ids", pa.binary()), ("vals", pa.binary())])

    def pack(table: pa.Table) -> pa.Table:
        order = np.argsort(np.asarray(table.column("id")), kind="stable")
        ids = np.asarray(table.column("id"))[order].astype("<i8")
        values = _narrow(np.frombuffer(b"".join(table.column("value").take(pa.array(order)).to_pylist()), "<i8"))
        return pa.table([[table.column("dim")[0].as_py()], [table.column("block")[0].as_py()], [values.itemsize], [ids.tobytes()], [values.tobytes()]], schema=schema)

    return rows.groupBy("dim", "block").applyInArrow(pack, "dim int, block int, width int, ids binary, vals binary")


def top_k(table: DataFrame, k: int = 5, every: int = 50, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k best partners of each row whose id is divisible by ``every``."""
    scratch = Scratch(table.sparkSession, "topk")

    def whole(columns):
        ids, out, dims = [], [], []
        for i, vector in zip(columns["id"].to_pylist(), columns["vector"].to_pylist()):
            if i is None or not vector or any(v is None for v in vector):
                continue
            values = np.floor(scale * np.asarray(vector, np.float64))
            if np.isfinite(values).all() and np.abs(values).max() ** 2 * len(vector) < 2.0**62:
                ids.append(i)
                dims.append(len(vector))
                out.append(values.astype("<i8").tobytes())
        return {"id": ids, "dim": dims, "value": out}

    rows = scratch.save(map_rows(table.select(table[id_col].cast("long").alias("id"), table[vector_col].alias("vector")), whole, "id long, dim int, value binary"), "values")
    total, asked = rows.agg(F.count("*"), F.count_if(F.col("id") % every == 0)).first()
    blocks, query_blocks = max(1, -(-total // BLOCK)), max(1, -(-asked // QUERY_BLOCK))
    slabs = max(1, -(-blocks // SLAB), min(blocks, 2 * default_partitions(table.sparkSession)))
    spread = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    data = scratch.save(_packed(rows.withColumn("block", spread(blocks))), "blocks")
    queries = scratch.save(_packed(rows.where(F.col("id") % every == 0).withColumn("block", spread(query_blocks))), "queries")
    left = data.withColumns({"slab": F.col("block") % slabs, "q": F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))}).withColumn("asks", F.lit(False))
    right = queries.withColumns({"q": F.col("block"), "slab": F.explode(F.sequence(F.lit(0), F.lit(slabs - 1)))}).withColumn("asks", F.lit(True))
    met = left.select("dim", "slab", "q", "asks", "width", "ids", "vals").union(right.select("dim", "slab", "q", "asks", "width", "ids", "vals"))
    schema = StructType.fromDDL("query_id long, vec_id long, score long")
    arrow = arrow_schema(schema)

    def best(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dim, asks, held = key[0].as_py(), [], []
        for batch in batches:
            for ask, width, ids, values in zip(*(batch.column(c).to_pylist() for c in ("asks", "width", "ids", "vals"))):
                (asks if ask else held).append((np.frombuffer(ids, "<i8"), np.frombuffer(values, f"<i{width}").reshape(-1, dim)))
        found = [x for ids, values in asks for x in slab_top(ids, values.astype(np.int64), held, k)[0]]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*found) if found else ((), (), ()))], schema=arrow)

    # applyInArrow sees by these annotations that a group comes batch by batch
    best.__annotations__ = {"key": tuple[pa.Scalar, ...], "batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    local = met.groupBy("dim", "slab", "q").applyInArrow(best, schema)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return local.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
