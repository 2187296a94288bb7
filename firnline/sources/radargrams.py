"""Radargrams as a Spark data source: one partition per frame file, pruned by the catalogue, read in batches or streams.

``spark.dataSource.register(FrameSource)``, then ``spark.read.format("frames").option("path", folder).load()`` or
``spark.readStream``. A frame is an ``.npz`` file named after its id, in a folder named after its collection, with data
(either orientation, real or complex), twtt, slow_time (microseconds), latitude, longitude, elevation and optionally
heading. Paths are those of any file system that Arrow knows by its URI (local, hdfs, s3, gs).

Options: ``path``; ``frames``, ids to read, separated by commas; ``retries`` of a file that can't be read (2), after
``wait`` seconds (1); ``timeout`` in seconds of a request, for object stores; ``report``: with ``true``, files that
can't be read don't fail the job, and a column ``error`` comes last. Such a file gives one row with its names and what
went wrong, and one without traces a row that says so. In a stream, ``settle`` (1) is how many seconds a file must lie
unchanged before it is read: files are taken in the order of their times.
"""

from __future__ import annotations

import io
import posixpath
import re
import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

from firnline.schema import RAW_TRACES

#: Traces handed to Spark at a time.
BATCH_TRACES = 512
#: The source's rows with ``report``.
REPORTED = StructType([*RAW_TRACES, StructField("error", StringType())])


class _Frame(InputPartition):
    def __init__(self, path: str, collection: str):
        super().__init__(path)
        self.collection = collection


class FrameSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "frames"

    def schema(self):
        return REPORTED if _flag(self.options, "report") else RAW_TRACES

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Stream(self.options)


def _flag(options, name: str) -> bool:
    return str(options.get(name, "false")).lower() == "true"


class _Files:
    """Listing and reading with the source's options."""

    def __init__(self, options):
        self.options = dict(options)
        self.retries, self.wait = int(self.options.get("retries", 2)), float(self.options.get("wait", 1))

    def system(self):
        """(file system, the path in it)"""
        from pyarrow import fs

        path = self.options["path"].rstrip("/")
        if "://" not in path and not path.startswith("file:"):
            return fs.LocalFileSystem(), path
        if path.startswith("s3://") and "timeout" in self.options:
            seconds = float(self.options["timeout"])
            return fs.S3FileSystem(request_timeout=seconds, connect_timeout=seconds), path[len("s3://") :]
        return fs.FileSystem.from_uri(path)

    def found(self) -> list[tuple[str, str, int]]:
        """(path, collection, time in nanoseconds) of the frames asked for, in order of collection and name."""
        from pyarrow import fs

        system, root = self.system()
        wanted = set(filter(None, self.options.get("frames", "").split(",")))
        out = []
        for info in self.tried(lambda: system.get_file_info(fs.FileSelector(root, recursive=True))):
            name, folder = posixpath.basename(info.path), posixpath.dirname(info.path)
            if info.type == fs.FileType.File and name.endswith(".npz") and posixpath.dirname(folder) == root.rstrip("/") and (not wanted or name[:-4] in wanted):
                out.append((info.path, posixpath.basename(folder), info.mtime_ns or 0))
        return sorted(out, key=lambda f: (f[1], f[0]))

    def content(self, path: str) -> io.BytesIO:
        system, _ = self.system()

        def read():
            with system.open_input_stream(path) as f:
                return io.BytesIO(f.read())

        return self.tried(read)

    def tried(self, action):
        for left in range(self.retries, -1, -1):
            try:
                return action()
            except FileNotFoundError:
                raise
            except OSError:
                if not left:
                    raise
                time.sleep(self.wait)

    def read(self, partition: _Frame) -> Iterator[pa.RecordBatch]:
        report = _flag(self.options, "report")
        frame_id = posixpath.basename(partition.value)[:-4]
        found = re.match(r"[^_]+_(\d+_\d+)", frame_id)
        names = frame_id, found[1] if found else frame_id, partition.collection
        try:
            parts = self._traces(partition.value)
        except Exception as error:  # whatever a damaged file raises
            if not report:
                raise
            yield _failure(names, f"{type(error).__name__}: {error}")
            return
        empty = True
        for times, fields, heading, power, twtt in parts:
            empty = False
            batch = _batch(names, times, fields, heading, power, twtt)
            yield batch.append_column("error", pa.nulls(len(times), pa.string())) if report else batch
        if empty and report:
            yield _failure(names, "no traces")

    def _traces(self, path: str) -> list[tuple]:
        """The frame's traces in order of time, a part at a time; everything is read and checked first."""
        with np.load(self.content(path)) as f:
            data, twtt, times = f["data"], f["twtt"].astype(float), f["slow_time"]
            if data.shape == (len(twtt), len(times)) and data.shape[0] != data.shape[1]:
                data = data.T
            if data.shape != (len(times), len(twtt)):
                raise ValueError(f"{data.shape} samples for {len(times)} traces of {len(twtt)}")
            power = np.abs(data).astype(float)
            heading = f["heading"] if "heading" in f else np.full(len(times), np.nan)
            fields = [f[k].astype(float) for k in ("latitude", "longitude", "elevation")]
        if any(len(v) != len(times) for v in (*fields, heading)):
            raise ValueError("fields of different lengths")
        order = np.argsort(times, kind="stable")
        return [(times[rows], [v[rows] for v in fields], heading[rows], power[rows], twtt) for rows in np.split(order, range(BATCH_TRACES, len(order), BATCH_TRACES)) if len(rows)]


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.files = _Files(options)

    def partitions(self):
        return [_Frame(path, collection) for path, collection, _ in self.files.found()]

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        return self.files.read(partition)


class _Stream(DataSourceStreamReader):
    """Offsets are file times: a micro-batch takes the files between two of them."""

    def __init__(self, options):
        self.files = _Files(options)
        self.settle = int(float(self.files.options.get("settle", 1)) * 1e9)

    def initialOffset(self) -> dict:
        return {"until": -1}

    def latestOffset(self) -> dict:
        calm = time.time_ns() - self.settle  # a file of the same time can't come any more
        return {"until": max((t for _, _, t in self.files.found() if t <= calm), default=-1)}

    def partitions(self, start: dict, end: dict):
        return [_Frame(path, collection) for path, collection, t in self.files.found() if start["until"] < t <= end["until"]]

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        return self.files.read(partition)

    def commit(self, end: dict) -> None:
        pass


def _batch(names, times, fields, heading, power, twtt) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    n, width = power.shape
    schema = to_arrow_schema(RAW_TRACES)
    lists = lambda flat: pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(flat))
    columns = [*(pa.array([x] * n) for x in names), pa.array(times.astype(np.int64)), *(pa.array(v) for v in fields), pa.array(heading, from_pandas=True), lists(power.ravel()), lists(np.tile(twtt, n))]
    return pa.RecordBatch.from_arrays([c.cast(pa.timestamp("us")).cast(f.type) if pa.types.is_timestamp(f.type) else c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)


def _failure(names, error: str) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(REPORTED)
    values = [*names, *[None] * (len(schema) - 4), error]
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(FrameSource)
