"""Small rows of the survey that had neither a query nor a test of their own."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from firnline import __main__ as main
from firnline import config, schema
from firnline.functions import physics, values
from firnline.operators import quality
from firnline.plans import run
from firnline.sources.snapshots import NothingWritten, SnapshotStore
from test_traces import SETTINGS, frame, picks


def test_levels_and_numbers(spark):
    rows = spark.createDataFrame([(0.0,), (30.0,), (-12.5,), (None,)], "v double")
    out = rows.select("v", physics.from_db(F.col("v")).alias("p"), physics.to_db(physics.from_db(F.col("v"))).alias("back"), values.short_number(F.col("v"), 1e3).alias("s")).collect()
    assert [r["p"] for r in out[:3]] == pytest.approx([1.0, 1000.0, 10**-1.25]) and out[3]["p"] is None
    assert [r["back"] for r in out[:3]] == pytest.approx([0.0, 30.0, -12.5])
    assert [r["s"] for r in out[:3]] == ["0.000", "3.000e+04", "-1.250e+04"]  # four significant digits


def test_masks_follow_the_variable(spark):
    assert all(quality.mask_of(v) == "qc_pass" for v in ("bed_power_dB", "required_surface_snr_dB")) and quality.mask_of("surface_power_dB") == "qc_surface_pass"
    traces = spark.createDataFrame([(True, True, False)], "qc_surface_pass boolean, bed_pick_attempted boolean, bed_pick_available boolean")
    assert quality.has_censoring(traces) and not quality.has_censoring(traces.drop("bed_pick_attempted"))


def test_one_collection_of_a_configuration():
    given = config.resolve({"query": {"collections": ["a", "b"], "max_items": 3}})
    one = config.for_collection(given, "b")
    assert one["query"] == {"collections": ["b"], "max_items": 3} and given["query"]["collections"] == ["a", "b"]


def test_arrays_are_native(spark, tmp_path):
    """Samples and codes keep their types in files."""
    spark.createDataFrame([("a", [1.5, None, 2.0], [3])], schema.table("k string, v array<double>, n array<long>")).write.parquet(f"{tmp_path}/t")
    back = spark.read.parquet(f"{tmp_path}/t")
    assert back.dtypes == [("k", "string"), ("v", "array<double>"), ("n", "array<bigint>")] and back.first()["v"] == [1.5, None, 2.0]


def test_a_reprocessing_run_without_rows_keeps_the_tip(spark, tmp_path):
    store = SnapshotStore(spark, f"{tmp_path}/store")
    frames = spark.createDataFrame([("Data_20120101_01_001", "20120101_01", "2012_A")], "frame_id string, segment_id string, collection string")
    raw, layers = spark.createDataFrame(frame(), schema.RAW_TRACES), spark.createDataFrame(picks(), schema.PICKS)
    run.run(store, frames, raw, layers, SETTINGS)
    tip = store.tip()
    with pytest.raises(NothingWritten):
        run.run(store, frames, raw, layers.limit(0), SETTINGS, reprocess=True)
    assert store.tip() == tip and store.read().count() == 10
    assert {r["outcome"] for r in store.attempts().collect()} == {"rows", "none"}


def test_process_takes_the_named_collections(spark, tmp_path):
    names = [("Data_20120101_01_001", "20120101_01", "2012_A"), ("Data_20120101_02_001", "20120101_02", "2012_B"), ("Data_20120101_02_002", "20120101_02", "2012_B")]
    spark.createDataFrame(sum((frame(*n) for n in names), []), schema.RAW_TRACES).write.parquet(f"{tmp_path}/raw")
    spark.createDataFrame(picks() + picks("20120101_02"), schema.PICKS).write.parquet(f"{tmp_path}/picks")
    spark.createDataFrame([(*n, 0.0, 0.0, 1.0, 1.0) for n in names], "frame_id string, segment_id string, collection string, x_min double, y_min double, x_max double, y_max double").write.parquet(f"{tmp_path}/frames")
    (tmp_path / "config.json").write_text(json.dumps(SETTINGS))
    call = ["--store", f"{tmp_path}/store", "--frames", f"{tmp_path}/frames", "--raw", f"{tmp_path}/raw", "--picks", f"{tmp_path}/picks", "--config", f"{tmp_path}/config.json"]
    main.main(["process", "2012_B", *call, "--max-items", "1", "-m", "part"])
    store = SnapshotStore(spark, f"{tmp_path}/store")
    assert [r["frame_id"] for r in store.processed().collect()] == ["Data_20120101_02_001"] and store.log()[0].message.startswith("[run] part")
    main.main(["process", "2012_B", *call])
    assert sorted(r["frame_id"] for r in store.processed().collect()) == ["Data_20120101_02_001", "Data_20120101_02_002"]


def test_table_function_of_sounder_picks(spark):
    """Statuses and a value, in SQL, against numpy."""
    from firnline.plans import sounder

    axis = np.linspace(0, 4e-5, 401)
    low, high = np.linspace(1, 2, 401), np.linspace(8000, 9000, 401)
    grams = spark.createDataFrame([("H1", 5, 0.0, 0.0, axis.tolist(), low.tolist(), high.tolist())], "flight string, trace_id long, x double, y double, twtt array<double>, low_gain array<double>, high_gain array<double>")
    rows = [("H1", 1, 10.0, 0.0, 600.0, 1000.0), ("H1", 2, 9e4, 0.0, 600.0, 1000.0), ("H1", 3, 10.0, 0.0, None, 1000.0), ("H2", 4, 10.0, 0.0, 600.0, 1000.0), ("H1", 5, 10.0, 0.0, 600.0, 9000.0)]
    results = spark.createDataFrame(rows, "flight string, point_id long, x double, y double, radar_height double, ice_thickness double")
    sounder.register(spark)
    sounder.matched_picks(results, grams).createOrReplaceTempView("picks_of_a_test")
    out = {r.point_id: r for r in spark.sql("SELECT * FROM sounder_values(TABLE(SELECT * FROM picks_of_a_test))").collect()}
    assert {k: r.status for k, r in out.items()} == {1: "ok", 2: "too far", 3: "no value", 4: "no radargram", 5: "outside record"}
    surface = 600 * 2 / physics.LIGHT
    bed = surface + 1000 * 2 * 1.78 / physics.LIGHT
    margin = 50 / (physics.LIGHT / 1.78)
    top = 10 * np.log10(low[(axis >= surface - margin) & (axis <= surface + margin)].max())
    deep = 10 * np.log10(high[(axis >= bed - margin) & (axis <= bed + margin)].max()) - 39
    assert out[1].trace_id == 5 and out[1].rssnr == pytest.approx(top - deep + 20 * np.log10(surface / (surface + (bed - surface) / 1.78**2)))
    assert out[2].rssnr is None


def test_ranks_of_one_group_are_dealt_over_parts(spark):
    """Values of one group meet its bounds in parts, and percentiles stay exact, in bins too."""
    from pyspark.sql import functions as F

    from firnline.operators import distributions as dist

    rows = spark.range(50_001).select(F.lit("v").alias("g"), (F.col("id") * 7919 % 50_001).cast("double").alias("x"))
    out = dist.interpolated_ranks(rows, "x", {"median": 0.5, "p90": 0.9}, ["g"])
    assert [tuple(r) for r in out.collect()] == [("v", 50_001, 25_000.0, 45_000.0)]
    assert "_part" in out._jdf.queryExecution().optimizedPlan().toString()
    bins = dist.binned(rows, "x", [10_000.0, 30_000.0], "x")
    assert "percentile(" not in bins._jdf.queryExecution().optimizedPlan().toString()
    assert {r["bin"]: (r["n"], r["median"]) for r in bins.collect()} == {0: (10_000, 4999.5), 1: (20_000, 19_999.5), 2: (20_001, 40_000.0)}
