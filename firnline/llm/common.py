"""Shared plumbing: scratch tables in the cluster's shared folder, Arrow mapping, text words."""

from __future__ import annotations

import atexit
import gc
import re
import shutil
import tempfile
import time
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of the contracts: runs of anything but ASCII blanks. bytes.split() cuts at the same six bytes.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
BLANKS = b" \t\n\r\x0b\x0c"

#: Rows handed to Python code at a time, so that memory follows rows and not Arrow batches.
SLICE_ROWS = 256


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Tables written to the folder all executors share, each cutting the lineage before it.

    The folder is the session's ``spark.checkpoint.dir``. Where that is unset, a temporary one serves a session on a
    single machine, and a cluster's is an error: its executors would write where nobody else can read.
    ``free`` removes a table that no later plan reads; what is left goes when the Python driver ends.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
        if not base and not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not base:  # one machine, as in tests
            base = tempfile.mkdtemp(prefix="firnline-")
            atexit.register(shutil.rmtree, base, True)
            base = f"file://{base}"
        self.root = f"{base.rstrip('/')}/firnline-{label}-{uuid.uuid4().hex[:12]}"
        atexit.register(self._remove, self.root)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def free(self, *names: str) -> None:
        for name in names:
            self._remove(f"{self.root}/{name}")

    def _remove(self, path: str) -> None:
        try:
            jvm = self.spark.sparkContext._jvm
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the session may be gone already; the folder is temporary
            pass


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner drop shuffle files of plans that nothing refers to any more.

    It learns of them from the JVM's collector, in turns: a plan, its exchanges, their files.
    """
    for _ in range(4):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.4)


def map_rows(df: DataFrame, function: Callable[[dict[str, list]], dict[str, list]], schema: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """mapInArrow over slices of at most ``slice_rows`` rows; ``function`` takes and returns columns as lists or arrays."""
    from pyspark.sql.types import StructType

    spark_schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = arrow_schema(spark_schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, slice_rows):
                part = batch.slice(start, slice_rows)
                out = function({n: part.column(i) for i, n in enumerate(part.schema.names)})
                yield to_batch(out, arrow)

    return df.mapInArrow(run, spark_schema)


def arrow_schema(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def to_batch(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c := columns[f.name], pa.Array) else pa.array(c, type=f.type) for f in schema], schema=schema)


def words_of(text: Column) -> Column:
    """Array of the text's words; a null or blank text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def default_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
