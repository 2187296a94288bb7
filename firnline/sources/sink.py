"""The trace table as a sink of Spark's writers, in batches and streams, committed in two phases.

``spark.dataSource.register(StoreSink)``, then ``rows.write.format("firnline").mode("append").option("path", root)`` or
``rows.writeStream``. Tasks write Parquet files into a staging folder and report their names; once all tasks are done,
the driver moves the reported files into a data folder of their own, writes a snapshot that lists it and moves the
branch, by one file created exclusively. Files of failed, repeated or late attempts are reported by nobody and stay
behind in the staging folder, where no reader looks. A failed job removes what it reported.

A stream's commit carries the query's name and the micro-batch's number; a batch that is replayed finds its own commit
and adds nothing. Columns are matched by name: unknown ones are an error, missing ones NULL.

Options: ``path``; ``branch`` (main); ``message``; ``name`` of a stream (stream). ``mode("overwrite")`` starts from no
rows. The frame table is not touched: ``snapshots.number_frames`` brings it up to date. Where the file system can't
create a file exclusively (object stores), two writers at the same moment must be kept apart by their callers.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage

from firnline.schema import TRACES
from firnline.sources.snapshots import Conflict


@dataclass
class Written(WriterCommitMessage):
    """What one task attempt wrote."""

    files: list[str] = field(default_factory=list)
    rows: int = 0


class _Branch:
    """A store's files as a Python worker sees them: the same layout as in ``snapshots``."""

    def __init__(self, root: str, branch: str):
        self.root, self.branch = root.rstrip("/"), branch

    def system(self):
        from pyarrow import fs

        if "://" not in self.root and not self.root.startswith("file:"):
            return fs.LocalFileSystem(), self.root
        return fs.FileSystem.from_uri(self.root)

    def names(self, folder: str) -> list[str]:
        from pyarrow import fs

        system, root = self.system()
        return sorted(i.base_name for i in system.get_file_info(fs.FileSelector(f"{root}/{folder}", allow_not_found=True)) if not i.base_name.endswith(".crc"))

    def read(self, name: str) -> str:
        system, root = self.system()
        with system.open_input_stream(f"{root}/{name}") as f:
            return f.read().decode()

    def create(self, name: str, text: str) -> None:
        from pyarrow import fs

        system, root = self.system()
        path = f"{root}/{name}"
        system.create_dir(os.path.dirname(path), recursive=True)
        if isinstance(system, fs.LocalFileSystem):
            with open(path, "x", encoding="utf-8") as f:
                f.write(text)
            return
        if system.get_file_info(path).type != fs.FileType.NotFound:
            raise FileExistsError(path)
        with system.open_output_stream(path) as f:
            f.write(text.encode())

    def tip(self) -> tuple[int, str | None]:
        """How often the branch was moved, and where it is."""
        moves = self.names(f"refs/{self.branch}")
        return len(moves), self.read(f"refs/{self.branch}/{moves[-1]}") if moves else None

    def snapshot(self, version: str) -> dict:
        return json.loads(self.read(f"snapshots/{version}.json"))

    def move(self, number: int, to: str) -> None:
        try:
            self.create(f"refs/{self.branch}/{number:010d}", to)
        except FileExistsError as error:
            raise Conflict(f"{self.branch} was moved by another writer") from error


class _Task:
    """What runs in tasks: rows into staged files."""

    def __init__(self, options, schema):
        self.options = dict(options)
        self.root, self.staging = self.options["path"].rstrip("/"), f"staging/{uuid.uuid4().hex}"
        unknown = set(schema.names) - set(TRACES.names)
        if unknown:
            raise ValueError(f"columns that the table doesn't have: {sorted(unknown)}")
        self.at = _Branch(self.root, self.options.get("branch", "main"))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        wanted = pa.schema([pa.field(f.name, pa.timestamp("us", tz="UTC") if pa.types.is_timestamp(f.type) else f.type) for f in to_arrow_schema(TRACES)])
        system, root = self.at.system()
        done, writer, sink = Written(), None, None
        for batch in iterator:
            if not batch.num_rows:
                continue
            if writer is None:
                name = f"{self.staging}/{uuid.uuid4().hex}.parquet"
                system.create_dir(f"{root}/{self.staging}", recursive=True)
                sink = system.open_output_stream(f"{root}/{name}")
                writer = pq.ParquetWriter(sink, wanted)
                done.files.append(name)
            columns = [batch.column(f.name).cast(f.type) if f.name in batch.schema.names else pa.nulls(batch.num_rows, f.type) for f in wanted]
            writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=wanted))
            done.rows += batch.num_rows
        if writer is not None:
            writer.close()
            sink.close()
        return done

    def drop(self, messages) -> None:
        system, root = self.at.system()
        for m in messages:
            for name in m.files if m else ():
                try:
                    system.delete_file(f"{root}/{name}")
                except FileNotFoundError:
                    pass

    def publish(self, messages, message: str, overwrite: bool, known: tuple[int, str | None]) -> str:
        """Move the reported files where readers look, and the branch to a snapshot with them."""
        number, base = known
        before = self.at.snapshot(base) if base else {"data": [], "attributes": None}
        system, root = self.at.system()
        folder = f"data/{uuid.uuid4().hex}"
        files = [f for m in messages if m for f in m.files]
        if files:
            system.create_dir(f"{root}/{folder}", recursive=True)
        for n, name in enumerate(files):
            system.move(f"{root}/{name}", f"{root}/{folder}/part-{n:05d}.parquet")
        data = ([] if overwrite else before["data"]) + ([folder] if files else [])
        id_ = uuid.uuid4().hex
        body = {"id": id_, "parent": base, "written_at": datetime.now(timezone.utc).isoformat(), "message": message, "data": data, "attributes": None if overwrite else before["attributes"]}
        self.at.create(f"snapshots/{id_}.json", json.dumps(body))
        self.at.move(number, id_)
        return id_


class _Writer(_Task, DataSourceArrowWriter):
    def __init__(self, options, schema, overwrite: bool):
        super().__init__(options, schema)
        self.overwrite, self.known = overwrite, self.at.tip()

    def commit(self, messages) -> None:
        rows = sum(m.rows for m in messages if m)
        try:
            self.publish(messages, self.options.get("message", f"[write] {rows} traces"), self.overwrite, self.known)
        except Conflict:
            self.drop(messages)
            raise

    def abort(self, messages) -> None:
        self.drop(messages)


class _StreamWriter(_Task, DataSourceStreamArrowWriter):
    def commit(self, messages, batchId: int) -> None:
        mark = f"[stream {self.options.get('name', 'stream')}] batch "
        known = self.at.tip()
        version = known[1]
        while version:
            snapshot = self.at.snapshot(version)
            if snapshot["message"].startswith(mark):
                if int(snapshot["message"][len(mark) :].split()[0]) >= batchId:
                    self.drop(messages)  # a replay
                    return
                break
            version = snapshot["parent"]
        if any(m and m.files for m in messages):
            self.publish(messages, f"{mark}{batchId}", False, known)

    def abort(self, messages, batchId: int) -> None:
        self.drop(messages)


class StoreSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "firnline"

    def schema(self):
        return TRACES

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options, schema, overwrite)

    def streamWriter(self, schema, overwrite: bool) -> DataSourceStreamArrowWriter:
        return _StreamWriter(self.options, schema)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(StoreSink)
