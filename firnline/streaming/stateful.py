"""Keyed state over streams: traces meet picks of another stream, and frames close when no more of them comes.

Both keep what they need per key in Spark's state store and nothing else, so no micro-batch reads what landed before.
Event-time timers say when a key's rows are due; rows behind the watermark are left out by Spark before they come here.
Queries need the RocksDB state store (``use_state_store``), whose state lives on disk and in the checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

from firnline.functions.values import duration_micros
from firnline.plans.extract import extract_metrics
from firnline.schema import RAW_TRACES
from firnline.sources.snapshots import SnapshotStore

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_state_store(spark: SparkSession) -> None:
    """The state store that keyed processors need, for queries that start from now on."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def _millis(micros: int) -> int:
    """Up to the next whole millisecond."""
    return -(-micros // 1000)


class NearestPick(StatefulProcessor):
    """One track's traces and picks, which come in any order within the watermark's delay.

    A trace waits until the watermark has passed it by the tolerance: then no pick that could be its nearest is still to
    come. Picks go once they are further back than any trace that waits or may still come could look.
    """

    def __init__(self, trace: Sequence[str], values: Sequence[str], types: StructType, tolerance: int, out: Sequence[str]):
        self.trace, self.values, self.types, self.tolerance, self.out = list(trace), list(values), types, tolerance, list(out)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", StructType([f for f in self.types if f.name in ("_time", *self.trace)]))
        self.picks = handle.getMapState("picks", StructType([self.types["_time"]]), StructType([f for f in self.types if f.name in self.values]))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        due = set()
        for row in rows:
            if row["_is_trace"]:
                self.waiting.appendValue(tuple(row[c] for c in self.waiting_names()))
                due.add(_millis(row["_time"] + self.tolerance) + 1)
            else:
                self.picks.updateValue((row["_time"],), tuple(row[f.name] for f in self.types if f.name in self.values))
        for at in due:
            self.handle.registerTimer(at)
        return iter(())

    def waiting_names(self) -> list[str]:
        return [f.name for f in self.types if f.name in ("_time", *self.trace)]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = timerValues.getCurrentWatermarkInMs()
        names = self.waiting_names()
        times = sorted(k[0] for k in self.picks.keys())
        left, found = [], []
        for row in self.waiting.get():
            t = row[names.index("_time")]
            if _millis(t + self.tolerance) + 1 > passed:
                left.append(tuple(row))
                continue
            nearest = min((abs(p - t), -p) for p in times) if times else None  # the later one at equal distance
            near = self.picks.getValue((-nearest[1],)) if nearest and nearest[0] <= self.tolerance else [None] * len(self.values)
            by_name = dict(zip([f.name for f in self.types if f.name in self.values], near))
            given = dict(zip(names, row))
            found.append(Row(**dict(zip(self.out, [*key, *[given[c] for c in self.trace], *[by_name[v] for v in self.values]]))))
        if left:
            self.waiting.put(left)
        else:
            self.waiting.clear()
        for p in times:
            if _millis(p + 2 * self.tolerance) + 1 < passed:
                self.picks.removeKey((p,))
        return iter(found)


def nearest_in_stream(traces: DataFrame, picks: DataFrame, by: str, time: str, values: Sequence[str], tolerance: int, late: str = "1 hour", prefix: str = "near_") -> DataFrame:
    """``time_axis.nearest`` of two streams: each trace of ``traces`` with the values of its track's nearest pick, if
    within ``tolerance`` microseconds (inclusive; the later one at equal distance; a label without a value counts).

    ``time`` is whole microseconds. Rows may be ``late`` behind the newest of their own stream, and one stream may be
    any time ahead of the other: the watermark is that of the slower one. A trace comes out once it has passed. State
    is kept per track for that time and twice the tolerance, however long the streams run.
    """
    own = [c for c in traces.columns if c != by]
    event = F.timestamp_micros(F.col(time)).alias("_at")
    left = traces.select(by, event, F.lit(True).alias("_is_trace"), F.col(time).alias("_time"), *[F.col(c).alias(f"_t_{c}") for c in own]).withWatermark("_at", late)
    right = picks.select(by, event, F.lit(False).alias("_is_trace"), F.col(time).alias("_time"), *[F.col(v).alias(f"_v_{v}") for v in values]).withWatermark("_at", late)
    both = left.unionByName(right, allowMissingColumns=True)
    out = StructType([traces.schema[by], *[traces.schema[c] for c in own]])
    for v in values:
        out = out.add(f"{prefix}{v}", picks.schema[v].dataType)
    processor = NearestPick([f"_t_{c}" for c in own], [f"_v_{v}" for v in values], both.schema, tolerance, out.names)
    return both.groupBy(by).transformWithState(processor, out, "append", "EventTime").select(*traces.columns, *[f"{prefix}{v}" for v in values])


class ClosingFrames(StatefulProcessor):
    """One frame's traces, until no more of them comes.

    A frame closes once the stream has gone ``quiet`` microseconds past its last trace, although the watermark is
    ``late`` behind: its traces then come out together, as version 1. A trace that comes later, but before the
    watermark, opens it again, and it closes again as the next version, whole. Traces that are there already are
    dropped, so files that are read twice change nothing. State goes when the watermark has passed the last trace by
    ``quiet``.
    """

    def __init__(self, payload: StructType, quiet: int, late: int):
        self.payload, self.quiet, self.late = payload, quiet, late

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.traces = handle.getMapState("traces", "_time long", self.payload)
        self.meta = handle.getValueState("meta", "last long, version int, open boolean, closes long, goes long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        last, version, open_, closes, goes = self.meta.get() if self.meta.exists() else (None, 0, False, None, None)
        fresh = False
        for row in rows:
            at = (row["_time"],)
            if not self.traces.containsKey(at):
                self.traces.updateValue(at, tuple(row[f.name] for f in self.payload))
                last, fresh = row["_time"] if last is None else max(last, row["_time"]), True
        if fresh:
            for old in (closes, goes):
                if old is not None:
                    self.handle.deleteTimer(old)
            closes = max(timerValues.getCurrentWatermarkInMs() + 1, _millis(last + self.quiet - self.late))
            goes = max(closes + 1, _millis(last + self.quiet) + 1)
            self.handle.registerTimer(closes)
            self.handle.registerTimer(goes)
            self.meta.update((last, version, True, closes, goes))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.meta.exists():
            return
        last, version, open_, closes, goes = self.meta.get()
        at = expiredTimerInfo.getExpiryTimeInMs()
        if open_:
            names = self.payload.names
            for (time,), values in sorted(self.traces.iterator(), key=lambda item: item[0][0]):
                yield Row(frame_id=key[0], _time=time, **dict(zip(names, values)), version=version + 1)
            self.meta.update((last, version + 1, False, closes, goes))
        if at >= goes:
            self.traces.clear()
            self.meta.clear()


def closed_frames(raw: DataFrame, quiet: int, late: int) -> DataFrame:
    """Raw traces of frames that closed, with ``version``; times in microseconds. A frame's traces come out together."""
    rest = [f for f in raw.schema if f.name not in ("frame_id", "slow_time")]
    slim = raw.select("frame_id", F.unix_micros("slow_time").alias("_time"), "slow_time", *[f.name for f in rest]).withWatermark("slow_time", f"{late // 1000} milliseconds")
    payload = StructType(rest)
    out = StructType([raw.schema["frame_id"]]).add("_time", "long")
    for f in rest:
        out = out.add(f)
    closed = slim.groupBy("frame_id").transformWithState(ClosingFrames(payload, quiet, late), out.add("version", "integer"), "append", "EventTime")
    return closed.select(*[F.timestamp_micros("_time").alias("slow_time") if c == "slow_time" else F.col(c) for c in raw.columns], "version")


def store_closed(store: SnapshotStore, rows: DataFrame, picks: DataFrame, config: dict[str, Any] | None, batch: int, name: str) -> str | None:
    """Extract the frames of one micro-batch into the store, once: a batch that is replayed finds its own commit.

    First versions are appended without a look at what the store has; later ones replace the frame's rows.
    """
    mark = f"[stream {name}] batch "
    done = next((s for s in store.log(10**6) if s.message.startswith(mark)), None)
    if done and int(done.message[len(mark) :].split()[0]) >= batch:
        return None
    rows = rows.persist()  # several jobs read them, and state is no place to read twice
    try:
        session = store.session()
        again = rows.where("version > 1").select("frame_id").distinct()
        if rows.isEmpty():
            return None
        if not again.isEmpty():
            session.remove(again)
        session.append(extract_metrics(rows.drop("version"), picks, config))
        session.update_frames()
        return session.commit(f"{mark}{batch}")
    finally:
        rows.unpersist()


def ingest_frames(raw: DataFrame, picks: DataFrame, store: SnapshotStore, checkpoint: str, config: dict[str, Any] | None = None, quiet: str = "10min", late: str = "30min", name: str = "frames", once: bool = True) -> StreamingQuery:
    """Start the stream ``raw`` of traces, from Parquet files or the ``frames`` source: each frame is extracted when it
    closes. What landed before is not read again; a frame that goes on after a pause of more than ``quiet`` and ``late``
    counts as another part."""
    use_state_store(store.spark)
    closed = closed_frames(raw.select(*RAW_TRACES.names), duration_micros(quiet), duration_micros(late))
    writer = closed.writeStream.option("checkpointLocation", checkpoint).outputMode("append").foreachBatch(lambda rows, n: store_closed(store, rows, picks, config, n, name))
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="30 seconds")).start()
