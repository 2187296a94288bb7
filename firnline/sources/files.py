"""Readers and writers of single files: point sets, regions, radargrams, reports."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from firnline.operators.quality import finite
from firnline.schema import table

SURVEY = table("row long, snr double, x double, y double")
NETCDF = table("path string, variable string, dimensions array<string>, shape array<long>, data array<double>")


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema)


def read_survey(spark: SparkSession, path: str) -> DataFrame:
    """A survey's points (row number, signal-to-noise, x, y): finite ones, with the sign turned to a required SNR."""
    rows = read_csv(spark, path, SURVEY).where(finite("snr", "x", "y"))
    return rows.withColumn("rssnr", -F.col("snr")).drop("snr")


def write_csv(rows: DataFrame, path: str, parts: bool = False) -> None:
    """One file with a header, for reports; or one per task, for tables that grow with the traces."""
    (rows if parts else rows.coalesce(1)).write.mode("overwrite").csv(path, header=True)


def read_netcdf(spark: SparkSession, paths: str) -> DataFrame:
    """One row per variable of classic NetCDF files (versions 1 and 2); one task per file."""
    files = spark.read.format("binaryFile").load(paths).select("path", "content")

    def parse(batches) -> Iterator:
        import pyarrow as pa

        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(NETCDF)
        for batch in batches:
            rows = [(p, *v) for p, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for v in netcdf_variables(raw)]
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return files.mapInArrow(parse, NETCDF)


def read_segments(spark: SparkSession, folder: str, flight: str) -> DataFrame:
    """(variable, shape, data) of a flight's files ``{flight}_*.nc``, joined along the track in the order of their names."""
    parts = read_netcdf(spark, f"{folder}/{flight}_*.nc")
    ordered = F.array_sort(F.collect_list(F.struct("path", "shape", "data")))
    joined = parts.groupBy("variable").agg(ordered.alias("_p"), F.first("dimensions").alias("dimensions"))
    along = F.aggregate("_p.shape", F.lit(0).cast("long"), lambda n, s: n + F.coalesce(F.try_element_at(s, F.lit(1)), F.lit(1)))
    rest = F.when(F.size(F.element_at("_p", 1)["shape"]) > 1, F.slice(F.element_at("_p", 1)["shape"], 2, 9)).otherwise(F.array().cast("array<bigint>"))
    return joined.select("variable", "dimensions", F.concat(F.array(along), rest).alias("shape"), F.flatten("_p.data").alias("data"))


#: Types of the classic format by number (fixed values).
_TYPES = {1: ">i1", 2: "S1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8"}


def netcdf_variables(raw: bytes) -> list[tuple[str, list[str], list[int], list[float]]]:
    """(name, dimensions, shape, values) of each numeric variable."""
    if raw[:3] != b"CDF" or raw[3] not in (1, 2):
        raise ValueError("not a classic NetCDF file")
    wide, at = raw[3] == 2, 4

    def number(size: int = 4) -> int:
        nonlocal at
        at += size
        return int.from_bytes(raw[at - size : at], "big")

    def name() -> str:
        nonlocal at
        n = number()
        at += -(-n // 4) * 4
        return raw[at - -(-n // 4) * 4 :][:n].decode("utf-8")

    def attributes() -> None:
        nonlocal at
        number()
        for _ in range(number()):
            name()
            kind = np.dtype(_TYPES[number()])
            at += -(-number() * kind.itemsize // 4) * 4

    records = number()
    number()
    dims = [(name(), number()) for _ in range(number())]
    attributes()
    number()
    found = []
    for _ in range(number()):
        label = name()
        ids = [number() for _ in range(number())]
        attributes()
        kind, size, begin = np.dtype(_TYPES[number()]), number(), number(8 if wide else 4)
        found.append((label, ids, kind, size, begin))
    stride = sum(size for _, ids, _, size, _ in found if ids and dims[ids[0]][1] == 0)
    out = []
    for label, ids, kind, size, begin in found:
        if kind.kind == "S":
            continue
        shape = [dims[i][1] or records for i in ids]
        if ids and dims[ids[0]][1] == 0:
            per = int(np.prod(shape[1:], dtype=int))
            values = np.concatenate([np.frombuffer(raw, kind, per, begin + r * stride) for r in range(records)]) if records else np.zeros(0)
        else:
            values = np.frombuffer(raw, kind, int(np.prod(shape, dtype=int)), begin)
        out.append((label, [dims[i][0] for i in ids], shape, values.astype(float).tolist()))
    return out
