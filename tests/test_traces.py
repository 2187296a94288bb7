"""Extraction, the store, runs, ingestion, geometry and sources on synthetic frames."""

import datetime as dt
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from firnline import config, schema
from firnline.functions import geo, physics, values
from firnline.operators import crossovers as cross
from firnline.operators import matching, sampling, time_axis
from firnline.plans import analyses, run
from firnline.plans.extract import extract_metrics
from firnline.sources import files, radargrams
from firnline.sources.snapshots import Conflict, SnapshotStore, compact
from firnline.streaming import ingest

START = dt.datetime(2012, 1, 1, tzinfo=dt.timezone.utc)
TWTT = np.linspace(0.5e-6, 22e-6, 110)
TOP, BOTTOM = 23, 64
SETTINGS = {"processing": {"decimate_interval": None, "noise": {"post_bed": {"start_offset_us": 1.0, "end_offset_us": 0.5}}}, "qc": {"min_traces_after_qc": 1}}


def frame(frame_id="Data_20120101_01_001", segment="20120101_01", collection="2012_A", n=10, seed=17):
    rng = np.random.default_rng(seed)
    data = 10 ** rng.uniform(-3.5, -2.2, (n, len(TWTT)))  # noise under two echoes
    data[:, TOP], data[:, BOTTOM] = 10 ** 1.4, 10 ** 0.9
    return [(frame_id, segment, collection, START + dt.timedelta(seconds=10 * i), -75 + 0.01 * i, 160 + 0.01 * i, 2000.0, None, data[i].tolist(), TWTT.tolist()) for i in range(n)]


def picks(segment="20120101_01", missing=(), n=10, surface="standard:surface", bottom="standard:bottom"):
    times = [START + dt.timedelta(seconds=10 * i) for i in range(n)]
    top = [(segment, surface, t, float(TWTT[TOP]), 2.0) for t in times]
    return top + [(segment, bottom, t, float("nan") if i in missing else float(TWTT[BOTTOM]), 2.0) for i, t in enumerate(times)]


@pytest.fixture
def tables(spark):
    def make(rows=None, layer=None):
        return spark.createDataFrame(rows or frame(), schema.RAW_TRACES), spark.createDataFrame(layer or picks(), schema.PICKS)

    return make


def extract(tables, layer=None, settings=SETTINGS, rows=None):
    return sorted(extract_metrics(*tables(rows, layer), settings).collect(), key=lambda r: (r["frame_id"], r["slow_time"]))


def test_metrics(tables):
    out = extract(tables)
    assert len(out) == 10 and out[0].__fields__ == schema.TRACES.names
    for r, raw in zip(out, frame()):
        assert r["surface_power_dB"] == pytest.approx(14.0) and r["bed_power_dB"] == pytest.approx(9.0)
        assert r["surface_twtt"] == TWTT[TOP] and r["bed_twtt"] == TWTT[BOTTOM]
        v = physics.LIGHT / math.sqrt(3.17)
        h = v / 2 * (TWTT[BOTTOM] - TWTT[TOP])
        rs = physics.LIGHT / 2 * TWTT[TOP]
        assert r["required_surface_snr_dB"] == pytest.approx(5 + 10 * math.log10(rs**2 / (rs + h / math.sqrt(3.17)) ** 2), rel=1e-9)
        assert r["bed_elevation"] == pytest.approx(2000 - rs - h)
        data = np.array(raw[8])
        low, high = TWTT[0] + 1e-6, TWTT[TOP] - 1e-6
        assert r["pre_surface_noise_dB"] == pytest.approx(10 * math.log10(np.median(data[(TWTT >= low) & (TWTT <= high)])))
        inside = data[(TWTT >= TWTT[BOTTOM] + 1e-6) & (TWTT <= TWTT[-1] - 0.5e-6)]
        assert r["post_bed_noise_dB"] == r["post_bed_noise_interp_dB"] == pytest.approx(10 * math.log10(np.median(inside)))
        assert r["post_bed_std_interp_dB"] == pytest.approx(np.std(10 * np.log10(inside)))
        tail = data[(TWTT >= TWTT[-1] - 12e-6) & (TWTT <= TWTT[-1] - 7e-6)]
        assert r["record_tail_noise_dB"] == pytest.approx(10 * math.log10(np.median(tail)))
        assert r["bed_pick_available"] and r["bed_pick_attempted"] and r["bed_pick_quality"] == 2 and r["qc_pass"]


def test_missing_picks(tables):
    out = extract(tables, picks(missing=(0, 1, 2, 5, 8, 9)))
    assert [r["bed_pick_available"] for r in out] == [i in (3, 4, 6, 7) for i in range(10)]
    assert [r["bed_pick_attempted"] for r in out] == [3 <= i <= 7 for i in range(10)]
    assert [r["bed_power_dB"] is None for r in out] == [i not in (3, 4, 6, 7) for i in range(10)]
    assert [r["post_bed_noise_interp_dB"] is None for r in out] == [not 3 <= i <= 7 for i in range(10)]
    assert all(r["surface_power_dB"] is not None for r in out)
    assert [r["bed_pick_quality"] for r in out] == [2 if i in (3, 4, 6, 7) else -1 for i in range(10)]
    assert extract(tables, picks(missing=range(10))) == []


def test_layer_names_and_absent_layers(tables):
    assert len(extract(tables, picks(surface=":surface", bottom=":bottom"))) == 10
    assert extract(tables, picks(bottom="other")) == [] and extract(tables, picks(surface="other")) == []


def test_checks_mask_and_gate(tables):
    deep = {**SETTINGS, "qc": {"min_ice_thickness_m": 100, "min_agl_m": 50, "min_traces_after_qc": 5}}
    out = extract(tables, picks(missing=range(8)), deep)
    assert sum(r["qc_pass"] for r in out) == 2 and sum(r["qc_surface_pass"] for r in out) == 10
    assert [r["bed_power_dB"] is not None for r in out] == [r["qc_pass"] for r in out] and all(r["surface_power_dB"] for r in out)
    assert extract(tables, None, {**SETTINGS, "qc": {"min_agl_m": 1e6, "min_traces_after_qc": 5}}) == []


def test_decimation(tables, spark):
    out = extract(tables, settings={**SETTINGS, "processing": {**SETTINGS["processing"], "decimate_interval": "25s"}})
    assert [r["slow_time"].second + 60 * r["slow_time"].minute for r in out] == [0, 30, 60, 90]
    rows = spark.createDataFrame([("a", t) for t in (0, 0, 4, 5, 9, 10, 15)], "k string, t long")
    assert sorted(r["t"] for r in time_axis.decimate(rows, ["k"], "t", 5).collect()) == [0, 5, 10, 15]


def test_nearest_takes_the_later_of_equals(spark):
    traces = spark.createDataFrame([("s", 10), ("s", 0), ("s", 30)], "k string, t long")
    labels = spark.createDataFrame([("s", 5, 1.0), ("s", 15, 2.0), ("s", 36, None)], "k string, t long, v double")
    got = {r["t"]: r["near_v"] for r in time_axis.nearest(traces, labels, ["k"], "t", ["v"], 5).collect()}
    assert got == {10: 2.0, 0: 1.0, 30: None}


def store_with(spark, path):
    store = SnapshotStore(spark, f"file://{path}/store")
    frames = [("Data_20120101_01_001", "20120101_01", "2012_A"), ("Data_20120101_01_002", "20120101_01", "2012_A"), ("Data_20140101_02_001", "20140101_02", "2014_B")]
    raw = sum((frame(f, s, c, seed=i) for i, (f, s, c) in enumerate(frames)), [])
    layers = picks() + picks("20140101_02")
    listed = spark.createDataFrame([(*f, 0.0, 0.0, 1.0, 1.0, None) for f in frames], schema.FRAMES)
    return store, listed, spark.createDataFrame(raw, schema.RAW_TRACES), spark.createDataFrame(layers, schema.PICKS)


def test_runs_are_incremental(spark, tmp_path):
    store, frames, raw, layers = store_with(spark, tmp_path)
    settings = {**SETTINGS, "processing": {**SETTINGS["processing"], "checkpoint_every": 2}}
    first = run.run(store, frames.where("collection = '2012_A'"), raw, layers, settings, message="first")
    assert store.read().count() == 20 and store.tip() == first
    assert run.run(store, frames.where("collection = '2012_A'"), raw, layers, settings) is None
    run.run(store, frames, raw, layers, settings)
    assert store.read().count() == 30 and store.read(first).count() == 20
    assert [s.message.split("]")[0] + "]" for s in store.log(checkpoints=False)][-1] == "[run]"
    index = {r["frame_id"]: r for r in store.frame_dim().collect()}
    assert sorted(r["frame_index"] for r in index.values()) == [0, 1, 2] and index["Data_20140101_02_001"]["collection"] == "2014_B"
    assert index["Data_20120101_01_001"]["frame_bed_pick_fraction"] == 1.0
    before = sorted(map(str, store.read().collect()))
    run.run(store, frames, raw, layers, {**settings, "query": {"collections": ["2012_A"]}}, reprocess=True)
    assert sorted(map(str, store.read().collect())) == before
    assert compact(store, 1) and store.read().count() == 30 and compact(store, 1, dry_run=True) is None
    session = store.session()
    assert session.remove(frames.where("collection = '2014_B'")) == 10
    other = store.session()
    session.commit("removed")
    other.clear()
    with pytest.raises(Conflict):
        other.commit("late")
    assert store.read().count() == 20 and store.frame_history().select("frame_id").distinct().count() == 3
    with pytest.raises(ValueError):
        store.session().append(raw.limit(1))


def test_streaming_adds_each_frame_once(spark, tmp_path):
    store, _, raw, layers = store_with(spark, tmp_path)
    raw.repartition(2, "frame_id").write.parquet(f"{tmp_path}/in")
    for _ in range(2):
        ingest.ingest(spark, f"{tmp_path}/in", layers, store, f"{tmp_path}/checkpoint", SETTINGS).awaitTermination()
    assert store.read().count() == 30
    assert ingest.ingest_batch(store, raw, layers, SETTINGS, 9) is None


def test_streaming_joins_split_frames(spark, tmp_path):
    """A frame whose traces come in three micro-batches has the rows of one that comes whole."""
    raw = spark.createDataFrame(frame(n=12) + frame("Data_20120101_01_002", n=3, seed=1), schema.RAW_TRACES)
    layers = spark.createDataFrame(picks(n=12), schema.PICKS)
    settings = SETTINGS | {"processing": SETTINGS["processing"] | {"decimate_interval": "25s"}, "qc": {"min_traces_after_qc": 3}}
    whole = extract_metrics(raw, layers, settings)
    store = SnapshotStore(spark, f"{tmp_path}/split")
    seconds = (F.col("slow_time").cast("long") / 10).cast("long")
    for part in range(3):
        raw.where(seconds % 3 == part).coalesce(1).write.mode("append").parquet(f"{tmp_path}/parts")
    ingest.ingest(spark, f"{tmp_path}/parts", layers, store, f"{tmp_path}/mark", settings, files_per_batch=1).awaitTermination()
    assert ingest.landed(store).count() == 15 and len(store.log()) >= 2
    kept = ["frame_id", "slow_time", "surface_power_dB", "bed_power_dB"]
    assert sorted(map(tuple, store.read().select(*kept).collect())) == sorted(map(tuple, whole.select(*kept).collect()))


def test_crossovers_find_the_crossing(spark):
    rows = [("a", i, float(i * 100), 0.0, 1.0) for i in range(-20, 21)] + [("b", i, 30.0, float(i * 100), 3.0) for i in range(-20, 21)] + [("c", i, float(i * 100), 50.0, 9.0) for i in range(-20, 21)] + [("d", 0, 0.0, 0.0, 0.0)]
    traces = spark.createDataFrame(rows, "frame_id string, slow_time long, x double, y double, v double")
    out = {(r["frame_a"], r["frame_b"]): r for r in cross.find_crossovers(traces, 120.0, ["v"]).collect()}
    assert set(out) == {("a", "b"), ("b", "c")}  # parallel lines cross at no angle
    assert out["a", "b"]["distance_m"] == 30.0 and out["a", "b"]["angle_deg"] == pytest.approx(90) and out["a", "b"]["v_diff"] == -2.0


def test_projection(spark):
    row = spark.range(1).select(*[c.alias(n) for n, c in zip("xy", geo.project(F.lit(-75.0), F.lit(50.0), geo.Polar("test", True, 71.0, 0.0)))]).first()
    lat, lon = spark.range(1).select(*geo.unproject(F.lit(row["x"]), F.lit(row["y"]), geo.ANTARCTIC)).first()
    assert (lat, lon) == (pytest.approx(-75.0, abs=1e-9), pytest.approx(50.0, abs=1e-9))
    lat, lon = spark.range(1).select(*geo.unproject(*geo.project(F.lit(71.5), F.lit(-120.0), geo.ARCTIC), geo.ARCTIC)).first()
    assert (lat, lon) == (pytest.approx(71.5, abs=1e-9), pytest.approx(-120.0, abs=1e-9))
    assert geo.projection_of(-70) is geo.ANTARCTIC and geo.projection_of(70) is geo.ARCTIC


def test_matching_ties_and_reach(spark):
    left = spark.createDataFrame([(1, 0.0, 0.0), (2, 3.0, 0.0), (3, 99.0, 99.0)], "i int, x double, y double")
    right = spark.createDataFrame([(7, 1.0, 0.0), (8, -1.0, 0.0), (9, 13.0, 0.0)], "j int, u double, v double")
    near = {r["i"]: r["j"] for r in matching.nearest_within(left, right, 10.0, "i", "j", ("x", "y"), ("u", "v")).collect()}
    assert near == {1: 7, 2: 7}
    assert {(r["i"], r["j"]) for r in matching.one_to_one(left, right, 10.0, "i", "j", ("x", "y"), ("u", "v")).collect()} == {(1, 7)}


def test_samples_are_stable(spark):
    rows = spark.range(1000).select(F.col("id"))
    assert [r["id"] for r in sampling.stride(rows, 7, ["id"]).orderBy("id").collect()] == [j * 1000 // 7 for j in range(7)]
    assert sampling.by_hash(rows, 10, "id").collect() == sampling.by_hash(rows.repartition(5), 10, "id").collect()


def test_configuration(tmp_path):
    resolved = config.resolve({"processing": {"noise": {"post_bed": {"start_offset_us": 2, "odd": 1}}}, "own": {"kept": 1}})
    assert resolved["processing"]["noise"]["post_bed"] == {"start_offset_us": 2.0, "end_offset_us": 5.0} and resolved["own"] == {"kept": 1}
    assert resolved["processing"]["decimate_interval"] == "10s" and config.check_limits(resolved) == {}
    with pytest.raises(FileNotFoundError):
        config.load(tmp_path / "none.json")
    (tmp_path / "c.json").write_text('{"qc": {"min_agl_m": 50}}')
    assert config.check_limits(config.load(tmp_path / "c.json")) == {"minimum_agl": 50}
    assert values.duration_micros("10s") == 10_000_000 and values.duration_micros("1.5min") == 90_000_000


def test_classic_netcdf(spark, tmp_path):
    name = lambda s: len(s).to_bytes(4, "big") + s.encode() + b"\0" * (-len(s) % 4)
    n = lambda i: i.to_bytes(4, "big")
    head = b"CDF\x01" + n(0) + n(10) + n(1) + name("time") + n(3) + n(0) + n(0) + n(11) + n(1) + name("snr") + n(1) + n(0) + n(0) + n(0) + n(6) + n(24)
    head += n(len(head) + 4)
    (tmp_path / "a.nc").write_bytes(head + np.array([1.5, -2.0, 4.0], ">f8").tobytes())
    row = files.read_netcdf(spark, f"{tmp_path}/*.nc").first()
    assert (row["variable"], row["dimensions"], row["shape"], row["data"]) == ("snr", ["time"], [3], [1.5, -2.0, 4.0])


def test_frame_files(spark, tmp_path):
    folder = tmp_path / "2012_A"
    folder.mkdir()
    data = np.random.default_rng(0).uniform(size=(len(TWTT), 4))
    times = np.array([3, 1, 2, 0]) * 10_000_000
    np.savez(folder / "Data_20120101_01_001.npz", data=data, twtt=TWTT, slow_time=times, latitude=np.zeros(4), longitude=np.ones(4), elevation=np.full(4, 9.0))
    radargrams.register(spark)
    rows = spark.read.format("frames").option("path", str(tmp_path)).load().orderBy("slow_time").collect()
    assert len(rows) == 4 and rows[0]["segment_id"] == "20120101_01" and rows[0]["data"] == pytest.approx(data[:, 3].tolist())


def test_sql_functions(spark):
    from firnline import sql

    sql.register(spark)
    row = spark.sql("SELECT to_db(100D) a, to_db(0D) b, acute_angle(10D, 350D) c, antarctic_x(-75D, 50D) x, required_surface_snr(10D, -30D, 2e-6D, 22e-6D, 3.17D) r").first()
    x, _ = spark.range(1).select(*geo.project(F.lit(-75.0), F.lit(50.0), geo.ANTARCTIC)).first()
    r = spark.range(1).select(physics.required_surface_snr_db(F.lit(10.0), F.lit(-30.0), F.lit(2e-6), F.lit(22e-6))).first()[0]
    assert (row["a"], row["b"], row["c"]) == (20.0, None, 20.0) and row["x"] == pytest.approx(x) and row["r"] == pytest.approx(r)


def test_region_distribution_has_unit_area(spark):
    rng = np.random.default_rng(0)
    rows = [(float(x), float(y), float(v), c, True, True) for x, y, v, c in zip(rng.uniform(0, 10, 200), rng.uniform(0, 10, 200), rng.normal(0, 1, 200), ["s1", "s2"] * 100)]
    table = spark.createDataFrame(rows, "x double, y double, surface_power_dB double, collection string, qc_surface_pass boolean, qc_pass boolean")
    out = analyses.region_distribution(table, [(0, 0), (8, 0), (8, 8), (0, 8)], "surface_power_dB", points=64).toPandas()
    whole = out[out.season == "All"].sort_values("x")
    assert np.trapezoid(whole.density, whole.x) == pytest.approx(1.0)


def test_crossovers_deal_pairs_of_frames_once(spark):
    """Steps that meet are moved once; crossings are found wherever cells' edges lie, negative places included."""
    rows = []
    for k in range(12):  # a pair of lines each, its crossing beside an edge of the cells (600 wide) or on it
        x0 = 600.0 * (k - 6) + (k % 3 - 1) * 1e-6
        rows += [(f"{k:02d}a", float(i), x0 - 55.0 + 10 * i, 30_000.0 * k, 1.0) for i in range(12)]
        rows += [(f"{k:02d}b", float(i), x0, 30_000.0 * k - 55.0 + 10 * i, 2.0) for i in range(12)]
    traces = spark.createDataFrame(rows, "frame_id string, slow_time double, x double, y double, v double")
    found = cross.find_crossovers(traces, 100.0, ["v"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert sum("frame_a#" in keys and "frame_b#" in keys for keys in re.findall(r"hashpartitioning\(([^)]*)\)", plan)) == 1
    assert sorted((r["frame_a"], r["frame_b"]) for r in found.collect()) == [(f"{k:02d}a", f"{k:02d}b") for k in range(12)]
