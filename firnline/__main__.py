"""Command line: ``python -m firnline COMMAND ...``; tables are Parquet folders, the store is a snapshot store."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="firnline")
    commands = parser.add_subparsers(dest="command", required=True)

    def add(name: str, *extra: tuple):
        sub = commands.add_parser(name)
        sub.add_argument("--store", required=True)
        for flags, options in extra:
            sub.add_argument(*flags, **options)
        return sub

    tables = [(("--frames",), {"required": True}), (("--raw",), {"required": True}), (("--picks",), {"required": True})]
    work = [(("--config",), {}), (("--reprocess",), {"action": "store_true"}), (("-m", "--message"), {}), (("--max-items",), {"type": int})]
    add("run", *tables, *work)
    add("process", (("collections",), {"nargs": "+"}), *tables, *work)
    add("list", (("--frames",), {"required": True}))
    add("log", (("--checkpoints",), {"action": "store_true"}))
    add("crossovers", (("--out",), {"required": True}), (("--threshold",), {"type": float, "default": 1000.0}), (("--north",), {"action": "store_true"}))
    add("season-crossovers", (("--out",), {"required": True}), (("--collection",), {"required": True}), (("--threshold",), {"type": float, "default": 1000.0}), (("--north",), {"action": "store_true"}))
    add("compact", (("--files",), {"type": int, "default": 16}), (("--dry-run",), {"action": "store_true"}))
    add("backfill", (("--frames",), {"required": True}), (("--dry-run",), {"action": "store_true"}))
    add("limits", (("variable",), {}))
    add("number-frames", (("--force",), {"action": "store_true"}))
    add("frame", (("frame_id",), {}), (("--out",), {"required": True}))
    add("margin-sweep", (("--raw",), {"required": True}), (("--margins",), {"default": "10,50,100,250"}), (("--out",), {"required": True}))
    add("scatter", (("--out",), {"required": True}), (("--x",), {"default": "ice_thickness"}), (("--y",), {"default": "required_surface_snr_dB"}), (("--points",), {"type": int, "default": 32}))
    add("noise", (("--out",), {"required": True}), (("--raw",), {}), (("--frames",), {"help": "ids of frames whose samples are looked at, separated by commas"}))
    add("compare", (("--survey",), {"required": True}), (("--out",), {"required": True}), (("--threshold",), {"type": float, "default": 50.0}), (("--one-to-one",), {"action": "store_true"}), (("--north",), {"action": "store_true"}))
    add("sounder", (("--picks",), {"required": True}), (("--radargrams",), {"required": True}), (("--out",), {"required": True}), (("--reach",), {"type": float, "default": 500.0}), (("--threshold",), {"type": float, "default": 1000.0}), (("--north",), {"action": "store_true"}))
    args = parser.parse_args(argv)

    from firnline import config as configuration
    from firnline.functions import geo
    from firnline.operators import distributions, frames, quality
    from firnline.plans import analyses, run
    from firnline.schema import variable
    from firnline.sources import files, snapshots

    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    store = snapshots.SnapshotStore(spark, args.store)
    if args.command in ("run", "process"):
        config = configuration.load(args.config) if args.config else configuration.resolve({})
        if args.command == "process":
            config["query"]["collections"] = args.collections
        if args.max_items:
            config["query"]["max_items"] = args.max_items
        print(run.run(store, spark.read.parquet(args.frames), spark.read.parquet(args.raw), spark.read.parquet(args.picks), config, args.reprocess, args.message))
    elif args.command == "list":
        seen = frames.first_seen(store.frame_history())
        frames.collection_status(spark.read.parquet(args.frames), store.processed(), seen).orderBy("collection").show(1000, False)
    elif args.command == "log":
        for s in store.log(checkpoints=args.checkpoints):
            print(s.written_at, s.id, s.message.splitlines()[0])
    elif args.command in ("crossovers", "season-crossovers"):
        to = geo.ARCTIC if args.north else geo.ANTARCTIC
        traces = store.read().withColumn("ice_thickness", F.col("surface_elevation") - F.col("bed_elevation"))
        names = ["surface_elevation", "bed_elevation", "ice_thickness", "required_surface_snr_dB"]
        if args.command == "crossovers":
            found, summary = analyses.crossover_report(traces, args.threshold, names, to)
        else:
            found, summary = analyses.season_crossover_report(traces, store.frame_dim(), args.threshold, names, args.collection, to)
        files.write_csv(found, f"{args.out}/crossovers", parts=True)
        files.write_csv(summary, f"{args.out}/summary")
        summary.show(100, False)
    elif args.command == "compact":
        print(snapshots.compact(store, args.files, args.dry_run))
    elif args.command == "backfill":
        print(snapshots.backfill(store, spark.read.parquet(args.frames), args.dry_run))
    elif args.command == "number-frames":
        print(snapshots.number_frames(store, args.force))
    elif args.command == "frame":
        files.write_csv(frames.rows_of_frame(store.read(), args.frame_id), args.out, parts=True)
    elif args.command == "margin-sweep":
        raw = spark.read.parquet(args.raw).join(store.read().select("frame_id", "slow_time", F.col("bed_twtt").alias("pick")), ["frame_id", "slow_time"])
        swept = analyses.margin_sweep(raw.select("frame_id", "slow_time", "data", "twtt", "pick"), [float(m) for m in args.margins.split(",")])
        files.write_csv(distributions.spread_statistics(swept, "peak_dB", ["margin_m"]), args.out)
    elif args.command == "scatter":
        rows = store.read().where("qc_pass").withColumn("ice_thickness", F.col("surface_elevation") - F.col("bed_elevation"))
        ends = rows.agg(*[f(c) for c in (args.x, args.y) for f in (F.min, F.max)]).first()
        if ends[0] is None or ends[2] is None:
            raise SystemExit("no passing traces")
        box = ends[0], ends[2], ends[1] + 1e-6 * abs(ends[1]) + 1e-9, ends[3] + 1e-6 * abs(ends[3]) + 1e-9
        files.write_csv(distributions.density_grid(rows, args.x, args.y, box, args.points), f"{args.out}/density")
        files.write_csv(distributions.correlations(rows, args.x, args.y), f"{args.out}/correlation")
    elif args.command == "noise":
        names = ["pre_surface_noise_dB", "post_bed_noise_dB", "record_tail_noise_dB"]
        files.write_csv(distributions.missing_rates(store.read(), names, ["collection"]), args.out)
        if args.raw:
            picked = store.read().select("frame_id", "slow_time", F.col("surface_twtt").alias("surface"), F.col("bed_twtt").alias("bed"))
            raw = spark.read.parquet(args.raw)
            raw = raw.where(F.col("frame_id").isin(args.frames.split(","))) if args.frames else raw
            windows = [tuple(configuration.NOISE[w][k] * 1e-6 for k in ("start_offset_us", "end_offset_us")) for w in ("pre_surface", "post_bed")]
            found = analyses.noise_populations(raw.join(picked, ["frame_id", "slow_time"]), ["frame_id"], *windows)
            files.write_csv(found, f"{args.out}/samples")
    elif args.command == "compare":
        own = analyses.projected(quality.passing(store.read()), geo.ARCTIC if args.north else geo.ANTARCTIC).withColumn("_own", F.monotonically_increasing_id())
        survey = files.read_survey(spark, args.survey)
        pairs = analyses.dataset_comparison(own, survey, args.threshold, "_own", "row", "required_surface_snr_dB", "rssnr", args.one_to_one)
        files.write_csv(pairs.select("frame_id", "x", "y", "distance_m", F.col("_value").alias("rssnr_survey"), "required_surface_snr_dB", "diff"), f"{args.out}/pairs", parts=True)
        for name, rows in analyses.comparison_tables(own, survey, pairs, "_own", "row", "required_surface_snr_dB").items():
            files.write_csv(rows, f"{args.out}/{name}")
    elif args.command == "sounder":
        picks, radargrams = spark.read.parquet(args.picks), spark.read.parquet(args.radargrams)
        done = analyses.sounder_status(picks, radargrams, args.reach)
        done.write.mode("overwrite").parquet(f"{args.out}/status")
        done.groupBy("status").count().orderBy("status").show()
        values = analyses.sounder_rssnr(picks, radargrams, args.reach).join(picks.select("flight", "point_id", "x", "y"), ["flight", "point_id"])
        own = quality.passing(store.read()).withColumn("thickness", F.col("surface_elevation") - F.col("bed_elevation"))
        pairs, summary = analyses.sounder_comparison(values, analyses.projected(own, geo.ARCTIC if args.north else geo.ANTARCTIC), args.threshold)
        files.write_csv(values, f"{args.out}/values", parts=True)
        files.write_csv(pairs, f"{args.out}/pairs", parts=True)
        files.write_csv(summary, f"{args.out}/summary")
    elif args.command == "limits":
        store.read().agg(*distributions.percentile_limits(variable(args.variable))).show()


if __name__ == "__main__":
    main()
