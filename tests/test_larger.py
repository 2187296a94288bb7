"""What only larger tables showed."""

from pyspark.sql import functions as F

from firnline import queries
from firnline.operators import parts
from firnline.plans import analyses


def test_a_profile_that_never_rises_has_no_reach(spark):
    """A flat profile stays under its plateau plus 0.2 everywhere, as many rows' medians do."""
    axis = [0.25 * i for i in range(20)]
    traces = spark.createDataFrame([("flat", [1.0] * 20, axis), ("rises", [1.0] * 16 + [9.0, 1.0, 0.5, 0.1], axis)], "g string, data array<double>, twtt array<double>")
    out = {r.g: r for r in analyses.tail_sensitivity(traces, ["g"], [0.25 * i for i in range(1, 18)], (1.5, 4.0), {"end": (0.0, 0.5)}, 0.2).collect()}
    assert out["flat"].rolloff_until is None and out["flat"].plateau_dB == 0.0
    assert out["rises"].rolloff_until == 0.75


def test_shared_rows_are_compared_in_parts(spark, monkeypatch):
    """The join's parts follow the number of rows, not their compressed size; missing values differ from known ones."""
    monkeypatch.setattr(parts, "ROWS", 100)
    n = F.col("id")
    a = spark.range(2000).select(n.alias("k"), F.when(n % 11 > 0, n * 1.0).alias("v"))
    b = spark.range(1000, 3000).select(n.alias("k"), F.when(n % 13 > 0, F.when(n % 10 > 0, n * 1.0).otherwise(n * 1.5)).alias("v"))
    out = analyses.differing_rows(a, b, ["k"], "v", 1e-6)
    assert {r.k for r in out.collect()} == {k for k in range(1000, 2000) if (k % 11 > 0) != (k % 13 > 0) or k % 11 and k % 10 == 0}
    assert out.rdd.getNumPartitions() == 20


def test_pairs_are_told_apart_in_parts(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(parts, "ROWS", 100)
    n = F.col("id")
    spark.range(1000).select((n % 250).alias("l_orderkey"), (n * 7 % 40).alias("l_suppkey")).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.range(40).select(n.alias("s_suppkey"), (n % 5).alias("s_nationkey")).write.parquet(f"{tmp_path}/supplier.parquet")
    out = queries.across_seasons(spark, str(tmp_path))
    side = lambda s: s % 5 % 2 == 0
    lines = [{n * 7 % 40 for n in range(1000) if n % 250 == o} for o in range(250)]
    assert {(r.frame_a, r.frame_b) for r in out.collect()} == {(a, b) for o in lines for a in o for b in o if a < b and side(a) != side(b)}
    assert out.rdd.getNumPartitions() == 20
