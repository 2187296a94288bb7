"""Passages that repeat: the engine under the two substring operators.

Every window of L units is to be compared with every other one. Sorting all suffixes would move many times the corpus,
so only sampled ones leave their documents: in each window, the gram of ``k`` units with the least hash. Which gram
that is depends on the window's content alone, so equal windows have equal samples. The search then descends level by
level, and only what is still undecided goes down:

1. prefix: samples with the same gram form a group; a group of one holds no repeat;
2. region: the units that all windows of one sample cover. Equal regions make all those windows equal at once;
3. window: what is left, windows of single regions, one representative for each repeated region.

Levels 1 and 2 are aggregations with map-side partial results, so a passage found in a third of all documents is one
row per task; regions are told by 128 bits. Level 3 is each operator's own. The one here deals packed windows by their
own name, a 64-bit fingerprint, so no group of documents meets in one task, and the number of shares follows the number
of windows; ``substring_dedup`` grows suffix trees over the words themselves.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firnline.llm.common import Scratch, arrow_schema, default_partitions, map_rows, release_shuffles
from firnline.llm.wordhash import mix, span_hash, window_sums

#: Windows of one share of level 3, and units handled at a time while sampling.
SHARE_WINDOWS = 1_500_000
SLICE_UNITS = 4_000_000
SPILL_BYTES = 64 << 20
_SECOND = np.uint64(0xA24BAED4963EE407)
#: What stays of a window that repeats.
NOTHING, DOCUMENT, OCCURRENCE = "nothing", "document", "occurrence"


@dataclass(frozen=True)
class Units:
    """How texts become units: ``cut(texts)`` gives unit codes (uint64) and each text's first unit (one more entry)."""

    cut: Callable[[list[str | None]], tuple[np.ndarray, np.ndarray]]
    length: int  # L
    gram: int  # k


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values."""
    n = len(values)
    if n < width:
        return values[:0]
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    table = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(table, axis=1).reshape(-1)
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def sample(codes: np.ndarray, first: np.ndarray, units: Units) -> dict[str, np.ndarray]:
    """Samples of all texts: doc (text's number), low and high (first and last window it stands for), gram, region."""
    length, k = units.length, units.gram
    n = len(codes)
    empty = {"doc": np.zeros(0, np.int64), "low": np.zeros(0, np.int64), "high": np.zeros(0, np.int64), "gram": np.zeros(0, np.int64), "region": np.zeros(0, np.int64), "region2": np.zeros(0, np.int64)}
    if n < length:
        return empty
    sums = window_sums(codes)
    at = np.arange(n - k + 1)
    grams = span_hash(sums, at, at + k)
    least = sliding_least((grams & ~np.uint64(0xFFFFFFFF)) | at.view(np.uint64), length - k + 1)
    sizes = np.diff(first)
    held = np.flatnonzero(sizes >= length)  # texts that hold a window
    if not len(held):
        return empty
    head, until = first[held], first[held + 1] - length + 1
    chosen = (least & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    new = np.empty(len(chosen), bool)
    np.not_equal(chosen[1:], chosen[:-1], out=new[1:])
    new[head] = True
    for start, stop in zip(np.append(0, until), np.append(head, len(chosen))):  # windows across two texts
        new[start:stop] = False
    low = np.flatnonzero(new)
    doc = np.searchsorted(head, low, "right") - 1
    high = np.minimum(np.append(low[1:], len(chosen)), until[doc]) - 1
    pick, doc = chosen[low].astype(np.int64), held[doc]
    region = mix(span_hash(sums, low, high + length) + (pick - low).astype(np.uint64))
    region2 = span_hash(window_sums(mix(codes ^ _SECOND)), low, high + length)
    return {"doc": doc, "low": low - first[doc], "high": high - first[doc], "gram": grams[pick].view(np.int64), "region": region.view(np.int64), "region2": region2.view(np.int64)}


def _bounded(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, t in enumerate(texts):
        here = len(t or "") * 2
        if i > start and size + here > SLICE_UNITS:
            yield start, i
            start, size = i, 0
        size += here
    yield start, len(texts)


class RunQueue:
    """A disk-backed priority queue of sorted runs of (name, reference) tuples, popped in ascending blocks of names.

    Runs beyond ``limit`` bytes go to files of the worker's temporary folder and come back as memory maps.
    """

    def __init__(self, limit: int = SPILL_BYTES, block: int = 1 << 18):
        self.limit, self.block, self.held = limit, block, 0
        self.runs: list[list] = []  # names, references, next position
        self.files: list[str] = []

    def push(self, names: np.ndarray, refs: np.ndarray) -> None:
        order = np.argsort(names)  # equal names in any order
        names, refs = names[order], refs[order]
        if self.held + names.nbytes + refs.nbytes > self.limit:
            names, refs = self._spill(names), self._spill(refs)
        else:
            self.held += names.nbytes + refs.nbytes
        if len(names):
            self.runs.append([names, refs, 0])

    def _spill(self, values: np.ndarray) -> np.ndarray:
        handle, path = tempfile.mkstemp(prefix="runs-")
        os.close(handle)
        self.files.append(path)
        values.tofile(path)
        return np.memmap(path, values.dtype, "r") if len(values) else values

    def blocks(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All tuples in ascending order of name; a name never straddles two blocks."""
        try:
            live = self.runs
            while live:
                share = max(1, self.block // len(live))
                pivot = min(r[0][min(len(r[0]), r[2] + share) - 1] for r in live)
                names, refs = [], []
                for run in live:
                    end = int(np.searchsorted(run[0], pivot, "right"))
                    names.append(np.asarray(run[0][run[2] : end]))
                    refs.append(np.asarray(run[1][run[2] : end]))
                    run[2] = end
                live = [r for r in live if r[2] < len(r[0])]
                names, refs = np.concatenate(names), np.concatenate(refs)
                order = np.argsort(names, kind="stable")
                yield names[order], refs[order]
        finally:
            for path in self.files:
                os.unlink(path)


_REF = np.dtype([("doc", "<i8"), ("part", "<i8"), ("start", "<i4")])
#: A window that repeats, and the first of its units that does.
_HIT = np.dtype([("doc", "<i8"), ("part", "<i8"), ("start", "<i4"), ("begin", "<i4")])
_SEGMENT = np.dtype([("doc", "<i8"), ("part", "<i8"), ("start", "<i4"), ("count", "<i4")])
#: Regions of one gram beyond which its windows are dealt by name as well.
HOT_REGIONS = 2000
_RANGES = "id long, part long, low int, high int"


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` (id, text) with ``part``, which tells rows of one id with different texts apart."""
    return docs.withColumn("part", F.xxhash64("text"))


def with_marks(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """``docs``, keyed, with the ranges that ``find_repeats`` found in each."""
    marks = marks.select(F.col("id").alias("_id"), F.col("part").alias("_part"), "low", "high")
    return docs.join(marks, (F.col("id") == F.col("_id")) & (F.col("part") == F.col("_part")), "left").drop("_id", "_part")


def find_repeats(docs: DataFrame, units: Units, stays: str, scratch: Scratch, judge: Callable | None = None) -> DataFrame:
    """(id, part, low array, high array): units from each low to its high + length - 1 repeat, per text with any.

    ``docs`` is ``keyed``. What ``stays`` says which windows repeat: NOTHING, those that start anywhere else too;
    DOCUMENT, those that a document with a smaller id has too; OCCURRENCE, those that start earlier too, by (id, part, start).
    A later occurrence that overlaps the first one counts from the first one's end on, so the first stays whole. ``judge`` replaces level 3.
    """
    spark = docs.sparkSession
    settled, asking, total = _undecided(docs, units, stays, scratch)
    release_shuffles(spark)
    shares = max(2 * default_partitions(spark), -(-total // SHARE_WINDOWS))
    judged = (judge or _judged)(docs, asking, units, stays, shares, scratch)
    release_shuffles(spark)
    marks = settled.union(judged).groupBy("id", "part").agg(F.collect_list("low").alias("low"), F.collect_list("high").alias("high"))
    out = scratch.save(marks, "marks")
    scratch.free("found", "open", "asking", "judged")
    return out


def _undecided(docs: DataFrame, units: Units, stays: str, scratch: Scratch) -> tuple[DataFrame, DataFrame, int]:
    """Levels 1 and 2: ranges that repeat for certain, and per document the ranges whose windows must be compared."""

    def samples(columns):
        ids, part = (np.asarray(columns[c].to_numpy(zero_copy_only=False), np.int64) for c in ("id", "part"))
        texts = columns["text"].to_pylist()
        parts = []
        for a, b in _bounded(texts):
            found = sample(*units.cut(texts[a:b]), units)
            found["part"], found["doc"] = part[a:b][found["doc"]], ids[a:b][found["doc"]]
            parts.append(found)
        out = {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}
        return {"id": out["doc"], "part": out["part"], "low": out["low"].astype(np.int32), "high": out["high"].astype(np.int32), "gram": out["gram"], "region": out["region"], "region2": out["region2"]}

    sampled = scratch.save(map_rows(docs, samples, f"{_RANGES}, gram long, region long, region2 long"), "samples")
    same = (F.min("region") == F.max("region")) & (F.min("region2") == F.max("region2"))
    repeated = F.min("id") < F.max("id") if stays == DOCUMENT else F.count("*") > 1
    single = F.struct("id", "part", "low")
    least = [F.min(single).alias("least")] if stays != NOTHING else []  # a minimum of structs is found by sorting
    groups = scratch.save(sampled.groupBy("gram").agg(*least, same.alias("uniform"), repeated.alias("repeated")).where("repeated").select(F.col("gram").alias("_gram"), *(["least"] if least else []), "uniform"), "groups")
    found = scratch.save(sampled.join(groups, F.col("gram") == F.col("_gram")).drop("_gram"), "found")
    scratch.free("samples", "groups")

    regions = scratch.save(found.where("not uniform").groupBy("gram", "region", "region2").agg(F.count("*").alias("copies"), F.min(single).alias("first")).select(F.col("gram").alias("_gram"), F.col("region").alias("_region"), F.col("region2").alias("_region2"), "copies", "first"), "regions")
    hot = scratch.save(regions.groupBy(F.col("_gram").alias("_hot")).agg(F.ceil(F.count("*") / HOT_REGIONS).cast("int").alias("salts")).where("salts > 1"), "hot")
    open_ = found.where("not uniform").join(regions, (F.col("gram") == F.col("_gram")) & (F.col("region") == F.col("_region")) & (F.col("region2") == F.col("_region2")))
    ahead = lambda first: F.when((F.col("id") == F.col(f"{first}.id")) & (F.col("part") == F.col(f"{first}.part")), F.greatest("low", F.col(f"{first}.low") + units.length)).otherwise(F.col("low"))
    begin = F.col("low")
    if stays == DOCUMENT:
        settled, asked = F.col("id") > F.col("first.id"), F.col("id") == F.col("first.id")
        uniform = found.where("uniform and id > least.id")
    elif stays == OCCURRENCE:
        settled, asked, begin = single > F.col("first"), single == F.col("first"), ahead("first")
        uniform = found.where(F.col("uniform") & (single > F.col("least"))).withColumn("low", ahead("least"))
    else:
        settled, asked = F.col("copies") > 1, single == F.col("first")
        uniform = found.where("uniform")
    open_ = scratch.save(open_.select("id", "part", "low", "high", "gram", begin.alias("begin"), settled.alias("settled"), asked.alias("asked")), "open")
    ranges = uniform.select("id", "part", "low", "high").union(open_.where("settled").select("id", "part", F.col("begin").alias("low"), "high"))
    salted = open_.where("asked").join(hot, F.col("gram") == F.col("_hot"), "left")
    asking = salted.groupBy("id", "part").agg(F.collect_list(F.struct("low", "high", "gram", F.coalesce("salts", F.lit(1)).alias("salts"))).alias("spans")).select(F.col("id").alias("_id"), F.col("part").alias("_part"), "spans")
    asking = scratch.save(asking, "asking")
    scratch.free("regions", "hot")
    total = open_.where("asked").agg(F.sum(F.expr("high - low + 1"))).first()[0] or 0
    return ranges, asking, total


def _judged(docs: DataFrame, asking: DataFrame, units: Units, stays: str, shares: int, scratch: Scratch) -> DataFrame:
    """Level 3: ranges of windows that repeat among those asked for."""
    texts = docs.join(asking, (F.col("id") == F.col("_id")) & (F.col("part") == F.col("_part"))).select("id", "part", "text", "spans")

    def windows(columns):
        ids, part = (np.asarray(columns[c].to_numpy(zero_copy_only=False), np.int64) for c in ("id", "part"))
        spans = columns["spans"].to_pylist()
        texts = columns["text"].to_pylist()
        names, segments = [np.zeros(0, np.uint64)], [np.zeros(0, _SEGMENT)]
        share_of = [np.zeros(0, np.int64)]
        for a, b in _bounded(texts):
            codes, first = units.cut(texts[a:b])
            flat = [s for i in range(a, b) for s in spans[i]]
            low, high, salts = (np.array([s[c] for s in flat], np.int64) for c in ("low", "high", "salts"))
            gram = np.array([s["gram"] for s in flat], np.int64).view(np.uint64)
            owner = np.repeat(np.arange(a, b), [len(s) for s in spans[a:b]])
            count = high - low + 1
            region = np.repeat(np.arange(len(count)), count)
            start = np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
            at = start + first[owner[region] - a]
            name = span_hash(window_sums(codes), at, at + units.length)
            salt = (name >> np.uint64(20)) % salts[region].astype(np.uint64)
            share = (mix(gram[region] + salt * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(shares)).astype(np.int64)
            order = np.argsort(share, kind="stable")
            name, share, region, start = name[order], share[order], region[order], start[order]
            new = np.flatnonzero(np.concatenate([[True], (share[1:] != share[:-1]) | (region[1:] != region[:-1]) | (start[1:] != start[:-1] + 1)])) if len(name) else np.zeros(0, np.int64)
            segment = np.zeros(len(new), _SEGMENT)
            segment["doc"], segment["part"], segment["start"] = ids[owner[region[new]]], part[owner[region[new]]], start[new]
            segment["count"] = np.diff(np.append(new, len(name)))
            names.append(name)
            segments.append(segment)
            share_of.append(share[new])
        names, segments, share_of = np.concatenate(names), np.concatenate(segments), np.concatenate(share_of)
        until = np.cumsum(segments["count"])
        begin = until - segments["count"]
        edges = np.flatnonzero(np.concatenate([[True], share_of[1:] != share_of[:-1]])) if len(share_of) else np.zeros(0, np.int64)
        stops = np.append(edges[1:], len(share_of)) if len(edges) else edges
        return {
            "share": share_of[edges].astype(np.int32),
            "names": [names[begin[i] : until[j - 1]].tobytes() for i, j in zip(edges, stops)],
            "segments": [segments[i:j].tobytes() for i, j in zip(edges, stops)],
        }

    dealt = map_rows(texts, windows, "share int, names binary, segments binary")
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(_RANGES)
    out = arrow_schema(schema)

    def judge(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a window is told by its place in the row of all of the share's windows; only those that repeat are looked up
        queue, known, total = RunQueue(), [np.zeros(0, _SEGMENT)], 0
        for batch in batches:
            for names, segments in zip(batch.column("names"), batch.column("segments")):
                names = np.frombuffer(names.as_buffer(), np.uint64)
                known.append(np.frombuffer(segments.as_py(), _SEGMENT))
                queue.push(names, np.arange(total, total + len(names)))
                total += len(names)
        known = np.concatenate(known)
        ahead = np.cumsum(known["count"].astype(np.int64)) - known["count"]

        def looked_up(places: np.ndarray) -> np.ndarray:
            own = np.searchsorted(ahead, places, "right") - 1
            out = np.zeros(len(places), _HIT)
            for field in ("doc", "part"):
                out[field] = known[field][own]
            out["start"] = out["begin"] = known["start"][own] + (places - ahead[own])
            return out

        hits = [np.zeros(0, _HIT)]
        for names, refs in queue.blocks():
            again = np.zeros(len(names) + 1, bool)
            again[1:-1] = names[1:] == names[:-1]
            again = again[1:] | again[:-1]
            names, hit = names[again], looked_up(refs[again])
            if stays != NOTHING and len(hit):
                run = np.cumsum(np.concatenate([[True], names[1:] != names[:-1]])) - 1
                hit = hit[np.lexsort((hit["start"], hit["part"], hit["doc"], run))]
                heads = np.flatnonzero(np.diff(run, prepend=-1))
                first = hit[heads][run]
                if stays == DOCUMENT:
                    hit = hit[hit["doc"] > first["doc"]]
                else:
                    own = (hit["doc"] == first["doc"]) & (hit["part"] == first["part"])
                    hit["begin"] = np.where(own, np.maximum(hit["start"], first["start"] + units.length), hit["start"])
                    hit = np.delete(hit, heads)
            hits.append(hit)
        hits = np.concatenate(hits)
        hits = hits[np.lexsort((hits["start"], hits["part"], hits["doc"]))]
        doc, part, start = hits["doc"], hits["part"], hits["start"]
        new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (part[1:] != part[:-1]) | (start[1:] > start[:-1] + 1)])) if len(hits) else np.zeros(0, np.int64)
        last = np.append(new[1:], len(hits)) - 1 if len(hits) else new
        # adjacent windows' units are one run, from the first that any of them begins with
        low = np.minimum.reduceat(hits["begin"], new) if len(hits) else start
        yield pa.RecordBatch.from_arrays([pa.array(doc[new], pa.int64()), pa.array(part[new], pa.int64()), pa.array(low, pa.int32()), pa.array(start[last], pa.int32())], schema=out)

    # applyInArrow sees by these annotations that a group comes batch by batch
    judge.__annotations__ = {"key": tuple[pa.Scalar, ...], "batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    return scratch.save(dealt.groupBy("share").applyInArrow(judge, schema), "judged")


def covered(n: int, low: list[int], high: list[int], length: int) -> np.ndarray:
    """Boolean per unit: between one of the ranges' low and its high + length - 1."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, np.asarray(low, np.int64), 1)
    np.add.at(change, np.asarray(high, np.int64) + length, -1)
    return np.cumsum(change[:-1]) > 0
