"""Near-duplicate documents by HyperMinHash (operator 2).

A document's set is its distinct shingles of ``k`` words. Its sketch has REGISTERS buckets; each keeps, for the least
hash that fell into it, the number of leading zeros and MANTISSA further bits. Empty buckets borrow from others (optimal
densification), so short texts band as well as long ones. Bands of registers propose partners: documents that agree on
a band belong to one candidate cluster. Inside clusters, every pair is first compared by the
collision-corrected estimate, and what that does not rule out is confirmed on the full sets of 56-bit shingle hashes.

Equal sets are one class from the start, so copies never meet one another. Clusters beyond BLOCK classes are dealt as
pairs of blocks; a task gives only links that join parts not yet joined, so output follows documents, not pairs.
A pair at the threshold escapes all bands with probability MISS at most (4e-5 with the 32 bands of 8 rows that a
threshold of 0.85 gets); above it, less.

Defined cases: A-Z are lower-cased, words are runs of anything but ASCII blanks; a text with fewer words than ``k`` is
one shingle, the whole sequence; null, empty or blank texts have the empty set and link with nothing; repeated rows
with one id count once; rows without an id link with nothing and are kept; an empty table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firnline.llm.common import Scratch, map_rows, release_shuffles
from firnline.llm.components import connected_components
from firnline.llm.wordhash import mix, span_hash, to_bytes, window_sums, words

REGISTERS, MANTISSA = 256, 10
#: Bands get as many rows as leave a pair at the threshold this chance to share none.
MISS = 1e-4
#: Documents in a block; a task holds two blocks of sets.
BLOCK = 256
#: Estimates within so many standard deviations of the threshold are verified.
DEVIATIONS = 6.0
_HASH_BITS = 56
_VALUE_BITS = 48
_EMPTY = np.uint16(0xFFFF)


def shingle_sets(texts: list[str | None], k: int) -> list[np.ndarray]:
    """Sorted distinct 56-bit shingle hashes of each text (at most 256 texts)."""
    hashes, _, _, owner = words([to_bytes(t) for t in texts], lower=True)
    counts = np.bincount(owner, minlength=len(texts)) if len(owner) else np.zeros(len(texts), int)
    first = np.concatenate([[0], np.cumsum(counts)])
    sums = window_sums(hashes)
    n = len(hashes)
    start = np.arange(max(0, n - k + 1))
    start = start[owner[start] == owner[start + k - 1]] if len(start) else start.astype(int)
    shingle, doc = span_hash(sums, start, start + k), owner[start] if len(start) else np.zeros(0, int)
    short = np.flatnonzero((counts > 0) & (counts < k))
    shingle = np.concatenate([shingle, span_hash(sums, first[short], first[short + 1])])
    doc = np.concatenate([doc, short])
    shift = np.uint64(64 - _HASH_BITS)
    keys = np.unique((doc.astype(np.uint64) << np.uint64(_HASH_BITS)) | (shingle >> shift))
    bounds = np.searchsorted(keys >> np.uint64(_HASH_BITS), np.arange(len(texts) + 1))
    keys &= np.uint64((1 << _HASH_BITS) - 1)
    return [keys[a:b] for a, b in zip(bounds, bounds[1:])]


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """HyperMinHash registers, one row per set; empty sets have empty registers."""
    out = np.full((len(sets), REGISTERS), _EMPTY, np.uint16)
    sizes = np.array([len(s) for s in sets])
    if not sizes.sum():
        return out
    value = mix(np.concatenate(sets))
    doc = np.repeat(np.arange(len(sets), dtype=np.uint64), sizes)
    cell = doc * np.uint64(REGISTERS) + (value & np.uint64(REGISTERS - 1))
    rest = value >> np.uint64(64 - _VALUE_BITS)
    for base in range(0, len(sets), 256):  # 16 bits for the cell beside the value
        here = slice(sizes[:base].sum(), sizes[: base + 256].sum())
        keys = np.sort(((cell[here] - np.uint64(base * REGISTERS)) << np.uint64(_VALUE_BITS)) | rest[here])
        cells = keys >> np.uint64(_VALUE_BITS)
        lead = np.concatenate([[True], cells[1:] != cells[:-1]]) if len(keys) else np.zeros(0, bool)
        least = (keys[lead] & np.uint64((1 << _VALUE_BITS) - 1)).astype(np.float64)
        fraction, exponent = np.frexp(np.maximum(least, 1.0))
        mantissa = ((fraction - 0.5) * 2 * (1 << MANTISSA)).astype(np.int64)
        out.reshape(-1)[base * REGISTERS + cells[lead].astype(np.int64)] = ((_VALUE_BITS - exponent) << MANTISSA | mantissa).astype(np.uint16)
    return _densified(out)


def _densified(table: np.ndarray) -> np.ndarray:
    filled = table != _EMPTY
    out = table.copy()
    todo_doc, todo_cell = np.nonzero(~filled & filled.any(1)[:, None])
    attempt = np.uint64(1)
    while len(todo_doc):
        with np.errstate(over="ignore"):
            step = attempt * np.uint64(0x5851F42D4C957F2D)
        source = (mix(todo_cell.astype(np.uint64) * np.uint64(1_000_003) + step) % np.uint64(REGISTERS)).astype(np.int64)
        found = filled[todo_doc, source]
        out[todo_doc[found], todo_cell[found]] = table[todo_doc[found], source[found]]
        todo_doc, todo_cell = todo_doc[~found], todo_cell[~found]
        attempt += np.uint64(1)
    return out


def rows_per_band(threshold: float) -> int:
    """The most rows with which a pair at the threshold is missed with probability MISS at most."""
    return max(r for r in range(1, 33) if r == 1 or (1 - threshold**r) ** (REGISTERS // r) <= MISS)


def bands(table: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per set and band."""
    count = REGISTERS // rows
    parts = table[:, : count * rows].astype(np.uint64).reshape(len(table), count, rows)
    key = np.zeros((len(table), count), np.uint64)
    with np.errstate(over="ignore"):
        for r in range(rows):
            key = mix(key * np.uint64(0x100000001B3) + parts[:, :, r] + np.arange(1, count + 1, dtype=np.uint64) * np.uint64(7919))
    return key.view(np.int64)


def estimate(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Collision-corrected Jaccard estimates between all rows of two register tables."""
    agree = np.stack([(right == row).mean(1, dtype=np.float32) for row in left])
    chance = 1 / (1 << MANTISSA) / 3  # two unrelated registers share exponent (about 1/3) and mantissa
    return (agree - chance) / (1 - chance)


def margin(smaller: np.ndarray, threshold: float) -> np.ndarray:
    """How far under the threshold an estimate may lie: DEVIATIONS of a mean over as many independent registers as the
    smaller set fills, half of them at most, since empty registers borrow."""
    filled = np.minimum(REGISTERS, smaller) / 2
    return DEVIATIONS * np.sqrt(threshold * (1 - threshold) / np.maximum(filled, 1))


def _clear(size_a, size_b, inter, numerator: int, denominator: int):
    return denominator * inter >= numerator * (size_a + size_b - inter)


def block_links(ids: np.ndarray, sets: list[np.ndarray], part: np.ndarray | None, numerator: int, denominator: int) -> list[tuple[int, int]]:
    """Spanning links among the sets: between the two parts only, if ``part`` marks the second one."""
    sizes = np.array([len(s) for s in sets], np.int64)
    n = len(sets)
    small, large = np.minimum.outer(sizes, sizes), np.maximum.outer(sizes, sizes)
    open_ = np.triu(denominator * small >= numerator * large, 1)
    if part is not None:
        open_ &= part[:, None] != part[None, :]
    if open_.any():  # every candidate pair is estimated, and only what the estimate can't rule out is verified
        table = registers(sets)
        open_ &= estimate(table, table) >= numerator / denominator - margin(small, numerator / denominator)
    a, b = np.nonzero(open_)
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    inter = _intersections(sets, sizes) if len(a) > 2 * n + 64 else None
    if inter is not None:
        keep = _clear(sizes[a], sizes[b], inter[a, b], numerator, denominator)
        a, b = a[keep], b[keep]
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = find(x), find(y)
        if p != q and (inter is not None or _clear(sizes[x], sizes[y], len(np.intersect1d(sets[x], sets[y], assume_unique=True)), numerator, denominator)):
            root[max(p, q)] = min(p, q)
    return [(int(ids[x]), int(ids[find(x)])) for x in range(n) if find(x) != x]


def _intersections(sets: list[np.ndarray], sizes: np.ndarray, width: int = 8192) -> np.ndarray:
    """Exact sizes of all intersections, by matrix products over blocks of columns."""
    row = np.repeat(np.arange(len(sets)), sizes)
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    number = np.cumsum(shared) - 1
    keep = shared[column]
    row, column = row[keep], number[column[keep]]
    out = np.zeros((len(sets), len(sets)), np.float64)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for low in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(column, [low, low + width])
        block = np.zeros((len(sets), width), np.float32)
        block[row[a:b], column[a:b] - low] = 1
        out += block @ block.T
    return out.astype(np.int64)


def near_duplicates(docs: DataFrame, k: int = 5, numerator: int = 4, denominator: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept): linked where denominator * intersection >= numerator * union."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "neardup")
    rows = rows_per_band(numerator / denominator)
    slim = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))

    def sketch(columns):
        sets = shingle_sets(columns["text"].to_pylist(), k)
        keys = bands(registers(sets), rows)
        with np.errstate(over="ignore"):
            sums = [np.int64(mix(s).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0 for s in sets]
            xors = [np.int64(np.bitwise_xor.reduce(mix(s + np.uint64(1) << np.uint64(7))).view(np.int64)) if len(s) else 0 for s in sets]
        return {"id": columns["id"], "n": [len(s) for s in sets], "s1": sums, "s2": xors, "bands": [row.tolist() if len(s) else [] for row, s in zip(keys, sets)]}

    sketched = scratch.save(map_rows(slim, sketch, "id long, n long, s1 long, s2 long, bands array<long>"), "sketches")
    same = ["n", "s1", "s2"]
    classes = scratch.save(sketched.where("n > 0 and id is not null").groupBy(*same).agg(F.min("id").alias("rep"), F.first("bands").alias("bands")), "classes")

    banded = classes.select("rep", F.explode("bands").alias("key"))
    buckets = scratch.save(banded.groupBy("key").agg(F.min("rep").alias("lead"), F.count("*").alias("size")).where("size > 1").select(F.col("key").alias("bucket"), "lead"), "buckets")
    met = banded.join(buckets, F.col("key") == F.col("bucket")).where("rep <> lead").select(F.col("rep").alias("a"), F.col("lead").alias("b")).distinct()
    clusters = connected_components(met, scratch, "clusters")
    del banded, met
    release_shuffles(spark)

    sizes = clusters.groupBy("component").agg(F.count("*").alias("size"))
    blocks = F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")
    placed = scratch.save(
        clusters.join(scratch.save(sizes, "sizes"), "component").select("node", "component", blocks.alias("blocks"), F.pmod(F.xxhash64("node"), blocks).cast("int").alias("block")), "placed"
    )

    def shingle(columns):
        sets = shingle_sets(columns["text"].to_pylist(), k)
        return {c: columns[c] for c in ("node", "component", "blocks", "block")} | {"shingles": [s.tobytes() for s in sets]}

    texts = placed.join(slim, placed.node == slim.id).select("node", "component", "blocks", "block", "text")
    held = map_rows(texts, shingle, "node long, component long, blocks int, block int, shingles binary")
    # each block meets itself and every other one; a cluster of one block is a single task
    others = F.expr("transform(sequence(0, blocks - 1), x -> struct(least(x, block) as bi, greatest(x, block) as bj))")
    dealt = held.withColumn("pair", F.explode(others)).select("component", "pair.bi", "pair.bj", "block", "node", "shingles")

    def link(table):
        import pyarrow as pa

        block = np.asarray(table.column("block"))
        second = block == table.column("bj")[0].as_py()
        crossing = table.column("bi")[0].as_py() != table.column("bj")[0].as_py()
        ids = np.asarray(table.column("node"))
        order = np.argsort(ids, kind="stable")
        ids, first = np.unique(ids[order], return_index=True)  # a repeated id counts once
        sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").take(pa.array(order[first])).to_pylist()]
        links = block_links(ids, sets, second[order[first]] if crossing else None, numerator, denominator)
        a, b = zip(*links) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    links = scratch.save(dealt.groupBy("component", "bi", "bj").applyInArrow(link, "a long, b long"), "links")
    scratch.free("placed", "clusters-labels")
    release_shuffles(spark)
    joined = connected_components(links, scratch, "links-cc")
    of_class = scratch.save(classes.select(*same, "rep").join(joined, F.col("rep") == F.col("node"), "left").select(*[F.col(c).alias(f"_{c}") for c in same], F.coalesce("component", "rep").alias("component")), "of-class")
    out = sketched.join(of_class, (F.col("n") == F.col("_n")) & (F.col("s1") == F.col("_s1")) & (F.col("s2") == F.col("_s2")), "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
