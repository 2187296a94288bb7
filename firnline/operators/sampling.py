"""Subsets of rows that stay the same from run to run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def stride(rows: DataFrame, most: int, order: list[str]) -> DataFrame:
    """All rows if at most ``most``; else rows floor(j n / most) of the given order, j from 0 on.

    Positions come from per-partition counts, so no window gathers the table.
    """
    n = rows.count()
    if n <= most:
        return rows
    placed = with_position(rows, order)
    # row i is taken if some j has floor(j n / most) = i; the least j with j n / most >= i is the only candidate
    return placed.where(F.expr(f"((_row * {most} + {n} - 1) div {n}) * {n} div {most} = _row and (_row * {most} + {n} - 1) div {n} < {most}")).drop("_row")


def with_position(rows: DataFrame, order: list[str], name: str = "_row") -> DataFrame:
    """Global 0-based positions: a range-partitioned sort, then a window inside each partition on top of the counts before."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # kept on two disks: the range bounds are sampled, so a second evaluation could cut elsewhere
    ranged = rows.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()).persist(StorageLevel.DISK_ONLY_2)
    sizes = {r["_part"]: r["count"] for r in ranged.groupBy("_part").count().collect()}  # one row per partition
    before, total = {}, 0
    for part in sorted(sizes):
        before[part] = total
        total += sizes[part]
    start = F.create_map(*[F.lit(x) for item in before.items() for x in item]) if before else F.create_map()
    inner = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return ranged.withColumn(name, (inner + F.try_element_at(start, F.col("_part"))).cast("long")).drop("_part")


def by_hash(rows: DataFrame, most: int, key: str, seed: int = 42) -> DataFrame:
    """At most ``most`` rows, those with the smallest seeded hash of the key."""
    return rows.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(most)


def every_kth(rows: DataFrame, by: list[str], order: list[str], step: int, most: int | None = None) -> DataFrame:
    """Each group's rows 0, step, 2 step and so on, ``most`` of them at most."""
    n = F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1
    kept = rows.withColumn("_n", n).where(F.col("_n") % step == 0)
    return (kept if most is None else kept.where(F.col("_n") < step * most)).drop("_n")


def mid_segment(frames: DataFrame, endings: Sequence[str], frame: str = "frame_id") -> DataFrame:
    """Frames in the middle of a segment, by the ends of their names; all of them if there are none."""
    middle = frames.where(F.col(frame).rlike("(" + "|".join(endings) + ")$"))
    return middle if middle.limit(1).count() else frames
