"""The command line and single-file sources on a small store."""

import csv
import glob

import numpy as np
import pytest

from firnline import __main__ as main
from firnline import config, schema
from firnline.sources import files
from firnline.sources.snapshots import SnapshotStore
from test_traces import SETTINGS, frame, picks


@pytest.fixture(scope="module")
def filled(spark, tmp_path_factory):
    """A store of two crossing-free frames, made by the run command, and the folders of its inputs."""
    import json

    folder = tmp_path_factory.mktemp("commands")
    names = [("Data_20120101_01_001", "20120101_01", "2012_A"), ("Data_20120101_02_001", "20120101_02", "2012_B")]
    spark.createDataFrame(sum((frame(*n) for n in names), []), schema.RAW_TRACES).write.parquet(f"{folder}/raw")
    spark.createDataFrame(picks() + picks("20120101_02"), schema.PICKS).write.parquet(f"{folder}/picks")
    spark.createDataFrame([(*n, 0.0, 0.0, 1.0, 1.0) for n in names], "frame_id string, segment_id string, collection string, x_min double, y_min double, x_max double, y_max double").write.parquet(f"{folder}/frames")
    (folder / "config.yaml").write_text(json.dumps(SETTINGS))  # JSON is YAML
    main.main(["run", "--store", f"{folder}/store", "--frames", f"{folder}/frames", "--raw", f"{folder}/raw", "--picks", f"{folder}/picks", "--config", f"{folder}/config.yaml", "-m", "first"])
    return folder


def read(path):
    return [r for part in glob.glob(f"{path}/*.csv") for r in csv.DictReader(open(part))]


def test_run_and_reports(spark, filled, capsys):
    store = SnapshotStore(spark, f"{filled}/store")
    assert store.read().count() == 20 and store.log()[0].message.startswith("[run] first")
    call = lambda *a: main.main([a[0], "--store", f"{filled}/store", *a[1:]])
    call("log")
    call("list", "--frames", f"{filled}/frames")
    call("limits", "bed_power_dB")
    shown = capsys.readouterr().out
    assert "[run] first" in shown and "2012_A" in shown
    call("frame", "Data_20120101_01_001", "--out", f"{filled}/frame")
    assert len(read(f"{filled}/frame")) == 10
    with pytest.raises(LookupError):
        call("frame", "nothing", "--out", f"{filled}/none")
    call("margin-sweep", "--raw", f"{filled}/raw", "--margins", "10,100", "--out", f"{filled}/margins")
    assert {float(r["margin_m"]): float(r["median"]) for r in read(f"{filled}/margins")} == {10.0: pytest.approx(9.0), 100.0: pytest.approx(9.0)}
    call("noise", "--out", f"{filled}/noise")
    assert {r["collection"] for r in read(f"{filled}/noise")} == {"2012_A", "2012_B"}
    call("noise", "--out", f"{filled}/samples", "--raw", f"{filled}/raw", "--frames", "Data_20120101_01_001")
    found = read(f"{filled}/samples/samples")
    assert {(r["frame_id"], r["window"]) for r in found} == {("Data_20120101_01_001", "pre")} and all(int(r["n"]) == int(r["n_unique"]) and float(r["p1"]) < float(r["p99"]) for r in found)
    call("scatter", "--out", f"{filled}/scatter", "--x", "latitude", "--y", "longitude", "--points", "4")
    assert len(read(f"{filled}/scatter/density")) == 16
    call("crossovers", "--out", f"{filled}/cross", "--threshold", "50")
    call("season-crossovers", "--out", f"{filled}/season", "--collection", "2012_A", "--threshold", "50")
    call("number-frames", "--force")
    call("compact", "--files", "1")
    call("backfill", "--frames", f"{filled}/frames", "--dry-run")
    assert store.read().count() == 20 and store.frame_dim().count() == 2


def test_survey_comparison(spark, filled):
    from firnline.functions import geo
    from firnline.plans import analyses

    store = SnapshotStore(spark, f"{filled}/store")
    own = analyses.projected(store.read(), geo.ANTARCTIC).select("x", "y").collect()
    with open(filled / "survey.csv", "w") as f:
        f.write("row,snr,x,y\n" + "".join(f"{i},{-3.5},{r['x'] + 5},{r['y']}\n" for i, r in enumerate(own)) + "99,,1,1\n")
    assert files.read_survey(spark, f"{filled}/survey.csv").count() == len(own)
    main.main(["compare", "--store", f"{filled}/store", "--survey", f"{filled}/survey.csv", "--out", f"{filled}/compared"])
    assert int(read(f"{filled}/compared/summary")[0]["n"]) == 20
    main.main(["compare", "--store", f"{filled}/store", "--survey", f"{filled}/survey.csv", "--out", f"{filled}/matched", "--one-to-one"])
    pairs = read(f"{filled}/matched/pairs")
    assert len(pairs) == int(read(f"{filled}/matched/summary")[0]["n"]) <= 20 and all(float(p["distance_m"]) < 50 for p in pairs)
    assert {r["frame_id"] for r in read(f"{filled}/matched/frames")} == {p["frame_id"] for p in pairs}
    assert {(r["side"], int(r["n"]), int(r["n_matched"])) for r in read(f"{filled}/matched/coverage")} == {("own", 20, len(pairs)), ("other", 20, len(pairs))}


def test_sounder_against_the_store(spark, filled):
    """Picks beside a radargram and beside the store's traces: status, values, pairs and their summary."""
    from firnline.functions import geo
    from firnline.plans import analyses

    store = SnapshotStore(spark, f"{filled}/store")
    own = analyses.projected(store.read().where("frame_id = 'Data_20120101_01_001'"), geo.ANTARCTIC).select("x", "y").collect()
    axis = np.linspace(0, 4e-5, 400).tolist()
    rng = np.random.default_rng(5)
    tracks = [("DRP01", n, r["x"], r["y"], axis, rng.uniform(1, 2, 400).tolist(), rng.uniform(1, 2, 400).tolist()) for n, r in enumerate(own)]
    spark.createDataFrame(tracks, "flight string, trace_id long, x double, y double, twtt array<double>, low_gain array<double>, high_gain array<double>").write.parquet(f"{filled}/tracks")
    points = [("DRP01", n, r["x"] + 3, r["y"], 700.0, 1500.0) for n, r in enumerate(own)] + [("DRP01", 90, own[0]["x"] + 9e5, 0.0, 700.0, 1500.0), ("DRP01", 91, own[0]["x"], own[0]["y"], None, 1500.0), ("DRP02", 1, own[0]["x"], own[0]["y"], 700.0, 1500.0)]
    spark.createDataFrame(points, "flight string, point_id long, x double, y double, radar_height double, ice_thickness double").write.parquet(f"{filled}/points")
    main.main(["sounder", "--store", f"{filled}/store", "--picks", f"{filled}/points", "--radargrams", f"{filled}/tracks", "--out", f"{filled}/sounder", "--threshold", "40"])
    status = {r["status"]: r["count"] for r in spark.read.parquet(f"{filled}/sounder/status").groupBy("status").count().collect()}
    assert status == {"ok": 10, "too far": 1, "no value": 1, "no radargram": 1}
    values, pairs = read(f"{filled}/sounder/values"), read(f"{filled}/sounder/pairs")
    assert len(values) == 10 and 0 < len(pairs) <= 10
    for p in pairs:
        assert float(p["rssnr_diff"]) == pytest.approx(float(p["rssnr_own"]) - float(p["rssnr_sounder"])) and float(p["thickness_sounder"]) == 1500.0
    summary = {(r["variable"], r["group"]): int(r["n"]) for r in read(f"{filled}/sounder/summary")}
    assert summary["rssnr", "all"] == summary["thickness", "all"] == len(pairs)


def test_segments_of_a_flight(spark, tmp_path):
    """Two classic NetCDF files of one flight joined along the track, and another flight's left out."""
    def netcdf(values):
        name = lambda s: len(s).to_bytes(4, "big") + s.encode() + b"\0" * (-len(s) % 4)
        data = np.asarray(values, ">f8").tobytes()
        head = b"CDF\x01" + (0).to_bytes(4, "big") + (10).to_bytes(4, "big") + (1).to_bytes(4, "big") + name("t") + len(values).to_bytes(4, "big") + bytes(8)
        one = name("gain") + (1).to_bytes(4, "big") + (0).to_bytes(4, "big") + bytes(8) + (6).to_bytes(4, "big") + len(data).to_bytes(4, "big")
        head += (11).to_bytes(4, "big") + (1).to_bytes(4, "big") + one
        return head + (len(head) + 4).to_bytes(4, "big") + data

    for part, values in (("b01_2", [3.0, 4.0]), ("b01_1", [1.0, 2.0, 2.5]), ("b02_1", [9.0])):
        (tmp_path / f"{part}.nc").write_bytes(netcdf(values))
    row = files.read_segments(spark, str(tmp_path), "b01").first()
    assert (row["variable"], row["shape"], row["data"]) == ("gain", [5], [1.0, 2.0, 2.5, 3.0, 4.0])


def test_store_root():
    assert config.store_root({"store": {"backend": "s3", "bucket": "b", "prefix": "/p/q/"}}) == "s3a://b/p/q"
    assert config.store_root({"store": {"backend": "local", "path": "/x"}}) == "/x"
