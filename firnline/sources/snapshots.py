"""The versioned trace table: immutable Parquet files, snapshots that list them, and a branch that names the tip.

``root/data/<id>`` holds what one append wrote, ``root/snapshots/<id>.json`` a snapshot (parent, time, message, data
folders, frame attributes), ``root/refs/<branch>`` the tip. A commit moves the branch only if the tip is still the
snapshot it started from, so two writers never lose each other's work; readers see whole snapshots. All paths go
through Hadoop's file systems. Manifests name folders, one per append, so they stay small.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firnline.operators import frames as frame_ops
from firnline.schema import ATTEMPTS, FRAME_DIM, TRACES, conform

#: Rows per file.
FILE_ROWS = 1_000_000


class Conflict(RuntimeError):
    """Another writer moved the branch."""


class NothingWritten(RuntimeError):
    """A reprocessing run gave no frames; the old tip stays."""


@dataclass
class Snapshot:
    id: str
    parent: str | None
    written_at: str
    message: str
    data: list[str] = field(default_factory=list)
    attributes: str | None = None  # folder of the frame attributes
    processed: list[str] = field(default_factory=list)  # folders of processed frame ids


def _folder():
    """The data folder that a row was read from."""
    return F.regexp_extract(F.input_file_name(), r"(data/[0-9a-f]+)/[^/]*$", 1)


class _Files:
    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark.sparkContext._jvm, root.rstrip("/")
        self.fs = self.path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def read(self, name: str) -> str | None:
        if not self.fs.exists(self.path(name)):
            return None
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """Fails if the file exists."""
        self.fs.mkdirs(self.path(name).getParent())
        stream = self.fs.create(self.path(name), False)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()

    def list(self, name: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(name))) if self.fs.exists(self.path(name)) else []

    def rename(self, old: str, new: str) -> bool:
        return self.fs.rename(self.path(old), self.path(new))

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


class SnapshotStore:
    """Open or create with ``SnapshotStore(spark, root)``; changes gather in a ``Session`` and take effect on commit."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, root.rstrip("/"), _Files(spark, root)

    def tip(self, branch: str = "main") -> str | None:
        """Each move of a branch is a numbered file, created exclusively; the last one names the tip."""
        moves = self.files.list(f"refs/{branch}")
        return self.files.read(f"refs/{branch}/{moves[-1]}") if moves else None

    def snapshot(self, version: str) -> Snapshot:
        text = self.files.read(f"snapshots/{version}.json")
        if text is None:
            raise KeyError(f"no snapshot {version}")
        return Snapshot(**json.loads(text))

    def read(self, version: str = "main", columns: list[str] | None = None) -> DataFrame:
        """A snapshot's rows, by branch or id; an empty store has none. Columns that the table lacks are NULL."""
        id_ = self.tip(version) or (version if version != "main" else None)
        folders = self.snapshot(id_).data if id_ else []
        rows = self.spark.read.schema(TRACES).parquet(*[f"{self.root}/{f}" for f in folders]) if folders else self.spark.createDataFrame([], TRACES)
        return rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast("double").alias(c) for c in columns]) if columns else rows

    def frame_dim(self, version: str = "main") -> DataFrame:
        id_ = self.tip(version) or (version if version != "main" else None)
        folder = self.snapshot(id_).attributes if id_ else None
        return self.spark.read.schema(FRAME_DIM).parquet(f"{self.root}/{folder}") if folder else self.spark.createDataFrame([], FRAME_DIM)

    def processed(self, version: str = "main") -> DataFrame:
        """Distinct ids of frames that were processed."""
        return self.read(version, ["frame_id"]).distinct()

    def log(self, most: int | None = 100, branch: str = "main", checkpoints: bool = True) -> list[Snapshot]:
        """Newest first, at most ``most`` back (None: all), ending at the first that can't be read."""
        out, id_ = [], self.tip(branch)
        while id_ is not None and (most is None or len(out) < most):
            try:
                out.append(self.snapshot(id_))
            except (KeyError, ValueError):
                break
            id_ = out[-1].parent
        return [s for s in out if checkpoints or not s.message.startswith("[checkpoint]")]

    def history(self, most: int = 100) -> DataFrame:
        """(sequence, id, parent, written_at, message), oldest first."""
        rows = [(n, s.id, s.parent, s.written_at, s.message) for n, s in enumerate(reversed(self.log(most)))]
        return self.spark.createDataFrame(rows, "sequence int, id string, parent string, written_at string, message string")

    def frame_history(self) -> DataFrame:
        """(sequence, written_at, frame_id): the frames of each data folder with the first snapshot of all that lists it.

        One scan of all folders, whatever the number of snapshots; the manifests say which came when."""
        first: dict[str, tuple[str, int, str]] = {}
        for n, s in enumerate(reversed(self.log(None))):
            for f in s.data:
                first.setdefault(f, (f, n, s.written_at))
        if not first:
            return self.spark.createDataFrame([], "sequence int, written_at string, frame_id string")
        when = self.spark.createDataFrame(list(first.values()), "folder string, sequence int, written_at string")
        rows = self.spark.read.schema(TRACES).parquet(*[f"{self.root}/{f}" for f in first])
        return rows.select("frame_id", _folder().alias("folder")).distinct().join(when, "folder").select("sequence", "written_at", "frame_id")

    def changes(self, old: str | None, new: str = "main") -> DataFrame:
        """Rows that one snapshot has and another lacks: ``change`` (insert or delete) and the table's columns.

        Only folders that one of the two lists and the other doesn't are read; rows that were merely written anew,
        because others of their folder went, cancel out. Equal rows count as often as they occur."""
        lists = [set(self.snapshot(self.tip(v) or v).data) if v else set() for v in (old, new)]
        sides = []
        for mine, other, sign in ((lists[1], lists[0], 1), (lists[0], lists[1], -1)):
            folders = sorted(mine - other)
            rows = self.spark.read.schema(TRACES).parquet(*[f"{self.root}/{f}" for f in folders]) if folders else self.spark.createDataFrame([], TRACES)
            sides.append(rows.withColumn("_n", F.lit(sign)))
        net = sides[0].union(sides[1]).groupBy(*TRACES.names).agg(F.sum("_n").alias("_n")).where("_n <> 0")
        times = F.explode(F.array_repeat(F.when(F.col("_n") > 0, "insert").otherwise("delete"), F.abs("_n").cast("int"))).alias("change")
        return net.select(times, *TRACES.names)

    def attempts(self) -> DataFrame:
        """Every try of a frame, with its outcome; kept beside the snapshots, since most of them leave no rows."""
        return self.spark.read.schema(ATTEMPTS).parquet(f"{self.root}/attempts") if self.files.list("attempts") else self.spark.createDataFrame([], ATTEMPTS)

    def record_attempts(self, tries: DataFrame) -> None:
        tries.select(*ATTEMPTS.names).coalesce(1).write.mode("append").parquet(f"{self.root}/attempts")

    def session(self, branch: str = "main") -> Session:
        return Session(self, branch)

    def reset(self, version: str, branch: str = "main") -> None:
        """Point the branch at an older snapshot."""
        self.snapshot(version)
        self._move(branch, self.tip(branch), version)

    def _move(self, branch: str, expected: str | None, to: str) -> None:
        moves = self.files.list(f"refs/{branch}")
        if (self.files.read(f"refs/{branch}/{moves[-1]}") if moves else None) != expected:
            raise Conflict(f"{branch} is no longer at {expected}")
        try:
            self.files.create(f"refs/{branch}/{len(moves):010d}", to)
        except Exception as error:  # the number was taken meanwhile
            raise Conflict(f"{branch} was moved by another writer") from error


class Session:
    """Changes to one snapshot, not seen by readers before ``commit``."""

    def __init__(self, store: SnapshotStore, branch: str):
        self.store, self.branch, self.base = store, branch, store.tip(branch)
        at = store.snapshot(self.base) if self.base else None
        self.data: list[str] = list(at.data) if at else []
        self.attributes: str | None = at.attributes if at else None
        self.dirty = False
        self.origin: dict[str, str | None] = {f: f for f in self.data}  # the base's folder that each one stands for
        self.removed: list[DataFrame] = []
        self.cleared = False
        self.given: list[DataFrame | None] = []  # what the frame table was rebuilt with

    def rows(self) -> DataFrame:
        spark = self.store.spark
        return spark.read.schema(TRACES).parquet(*[f"{self.store.root}/{f}" for f in self.data]) if self.data else spark.createDataFrame([], TRACES)

    def append(self, rows: DataFrame) -> None:
        """Add rows; columns that the table doesn't have are an error, missing ones NULL."""
        self.data.append(self._write(conform(rows)))
        self.origin[self.data[-1]] = None
        self.dirty = True

    def _write(self, rows: DataFrame) -> str:
        folder = f"data/{uuid.uuid4().hex}"
        rows.repartitionByRange(F.col("collection"), F.col("frame_id"), F.col("slow_time")).write.option("maxRecordsPerFile", FILE_ROWS).parquet(f"{self.store.root}/{folder}")
        return folder

    def remove(self, frames: DataFrame) -> int:
        """Drop all rows of the given frames; only folders that hold some are rewritten. Returns the number of rows."""
        spark, root = self.store.spark, self.store.root
        if not self.data:
            return 0
        held = frame_ops.also_in(self.rows().select("frame_id", _folder().alias("_folder")), frames).groupBy("_folder").count()
        counts = {r["_folder"]: r["count"] for r in held.collect()}  # a row per data folder that holds some
        for n, name in enumerate(self.data):
            if name in counts:
                rows = spark.read.schema(TRACES).parquet(f"{root}/{name}")
                self.data[n] = self._write(frame_ops.not_in(rows, frames).select(*TRACES.names))
                self.origin[self.data[n]] = self.origin[name]
        self.removed.append(frames.select("frame_id").distinct())
        removed = sum(counts.values())
        self.dirty = self.dirty or removed > 0
        return removed

    def clear(self) -> None:
        self.data, self.attributes, self.dirty, self.cleared = [], None, True, True

    def update_frames(self, attributes: DataFrame | None = None) -> None:
        """Rebuild the frame dimension: dense indexes, and each attribute from ``attributes``, else as it was."""
        spark = self.store.spark
        rows = self.rows()
        old = spark.read.schema(FRAME_DIM).parquet(f"{self.store.root}/{self.attributes}") if self.attributes else spark.createDataFrame([], FRAME_DIM)
        names = ["collection", "frame_bed_pick_fraction", "segment_bed_pick_fraction"]
        new = attributes if attributes is not None else spark.createDataFrame([], "frame_id string, collection string, frame_bed_pick_fraction double, segment_bed_pick_fraction double")
        for c in names:
            if c not in new.columns:
                new = new.withColumn(c, F.lit(None).cast(FRAME_DIM[c].dataType))
        merged = frame_ops.merge_attributes(rows, old, new, {"collection": "", "frame_bed_pick_fraction": None, "segment_bed_pick_fraction": None})
        index = frame_ops.frame_index(rows.select("frame_id", "collection"))
        folder = f"frames/{uuid.uuid4().hex}"
        out = index.join(merged, "frame_id").select(*[F.col(f.name).cast(f.dataType) for f in FRAME_DIM])
        out.write.parquet(f"{self.store.root}/{folder}")
        self.attributes, self.dirty = folder, True
        self.given.append(attributes)

    def _rebase(self) -> None:
        """Put this session's changes on the branch's new tip, unless the other writers touched the same frames.

        Theirs are the frames in folders that the tip has and the base hasn't; ours, those appended and removed. A folder
        that both wrote anew, or a session that cleared the table, can't be put on another tip."""
        store, spark = self.store, self.store.spark
        tip = store.tip(self.branch)
        at, before = store.snapshot(tip), store.snapshot(self.base).data if self.base else []
        replaced = {self.origin[f]: f for f in self.data if self.origin[f] and self.origin[f] != f}
        if self.cleared or set(replaced) - set(at.data) or set(before) - {self.origin[f] for f in self.data}:
            raise Conflict(f"{self.branch} was moved by a writer of the same rows")
        own = [f for f in self.data if self.origin[f] is None]
        read = lambda folders: spark.read.schema(TRACES).parquet(*[f"{store.root}/{f}" for f in folders]).select("frame_id").distinct()
        theirs = [f for f in at.data if f not in before]
        ours = [*([read(own)] if own else []), *self.removed]
        if theirs and any(not frame_ops.also_in(read(theirs), frames).isEmpty() for frames in ours):
            raise Conflict(f"{self.branch} was moved by a writer of the same frames")
        self.base, self.data = tip, [replaced.get(f, f) for f in at.data] + own
        self.origin = {replaced.get(f, f): f for f in at.data} | {f: None for f in own}
        self.attributes, given, self.given = at.attributes, self.given, []
        for attributes in given[-1:]:
            self.update_frames(attributes)

    def commit(self, message: str, retries: int = 8) -> str:
        """Write a snapshot and move the branch to it. If another writer moved the branch meanwhile, the changes are put
        on its new tip, unless both touched the same frames."""
        for left in range(retries, -1, -1):
            try:
                return self._commit(message)
            except Conflict:
                if not left or self.store.tip(self.branch) == self.base:
                    raise
                self._rebase()
        raise AssertionError

    def _commit(self, message: str) -> str:
        id_ = uuid.uuid4().hex
        body: dict[str, Any] = {"id": id_, "parent": self.base, "written_at": datetime.now(timezone.utc).isoformat(), "message": message, "data": self.data, "attributes": self.attributes}
        self.store.files.create(f"snapshots/{id_}.json", json.dumps(body))
        self.store._move(self.branch, self.base, id_)
        self.base, self.dirty = id_, False
        return id_


def compact(store: SnapshotStore, files: int, dry_run: bool = False) -> str | None:
    """Rewrite the tip's rows into about ``files`` files; nothing to do if one folder with at most so many holds them. A
    dry run says what would be done."""
    session = store.session()
    count = len(session.rows().inputFiles())
    if len(session.data) <= 1 and count <= files:
        return None
    if dry_run:
        return f"{count} files in {len(session.data)} folders would become about {files} in one"
    folder = f"data/{uuid.uuid4().hex}"
    session.rows().repartitionByRange(files, "collection", "frame_id", "slow_time").write.parquet(f"{store.root}/{folder}")
    session.data, session.origin = [folder], {folder: None}
    return session.commit(f"[maintenance] compacted {count} files")


def number_frames(store: SnapshotStore, force: bool = False) -> str | None:
    """Give an older store its frame table; nothing to do if it has one, unless forced."""
    session = store.session()
    if session.attributes and not force:
        return None
    session.update_frames()
    return session.commit("[maintenance] frames numbered")


def backfill(store: SnapshotStore, frames: DataFrame, dry_run: bool = False) -> str | None:
    """Fill the frames' collections from the catalogue; no commit if nothing changes. A dry run says how many would."""
    session, old = store.session(), store.frame_dim()
    session.update_frames(frames.select("frame_id", "collection").dropDuplicates(["frame_id"]))
    new = store.spark.read.schema(FRAME_DIM).parquet(f"{store.root}/{session.attributes}")
    changed = new.exceptAll(old).count()
    if not changed and old.exceptAll(new).isEmpty():
        return None
    if dry_run:
        return f"{changed} frames would change"
    return session.commit("[maintenance] collections filled in")
