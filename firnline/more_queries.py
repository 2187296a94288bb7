"""Further registered queries: values, frames, sounder matching, reports and the store, with their counterparts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from firnline import sql
from firnline.functions import arrays, geo, physics, values
from firnline.operators import distributions as dist
from firnline.operators import frames as frame_ops
from firnline.operators import matching, quality, sampling, time_axis
from firnline.plans import analyses, run, sounder
from firnline.queries import EVENTS, PLANE, POINTS, RADAR, RING, _INSIDE, _differences, _picks, _plane, _points, _r, _radar, _table, _traces, query
from firnline.sources.snapshots import SnapshotStore


# ---- values ---------------------------------------------------------------------------------------------------------

_FLIGHT = "(CASE s_suppkey % 3 WHEN 0 THEN 'b' WHEN 1 THEN 'DRP' ELSE 'HX' END || s_suppkey)"


def _flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("s_suppkey")
    return _table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal", F.concat(F.when(s % 3 == 0, "b").when(s % 3 == 1, "DRP").otherwise("HX"), s.cast("string")).alias("flight"))


@query(f"""SELECT s_suppkey, CASE WHEN f LIKE 'b%' THEN 'PASIN' WHEN f LIKE 'DRP%' THEN 'UTIG_D' ELSE f END AS folder, CASE WHEN f LIKE 'b%' THEN 'PASIN' END AS present FROM (SELECT s_suppkey, {_FLIGHT} AS f FROM supplier)""")
def radargram_folders(spark, sf_dir):
    """Folders by the beginning of a flight's name; none where the folder isn't there."""
    f = F.col("flight")
    return _flights(spark, sf_dir).select("s_suppkey", values.radargram_folder(f).alias("folder"), values.radargram_folder(f, ["PASIN"]).alias("present"))


@query("""SELECT o_orderkey, 'Data_' || strftime(o_orderdate, '%Y%m%d') || '_' || lpad((o_orderkey % 100)::VARCHAR, 2, '0') || '_001' AS frame_id, strftime(o_orderdate, '%Y%m%d') || '_' || lpad((o_orderkey % 100)::VARCHAR, 2, '0') AS segment FROM orders""")
def segments_of_frames(spark, sf_dir):
    o = _table(spark, sf_dir, "orders")
    name = F.concat(F.lit("Data_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_"), F.lpad((F.col("o_orderkey") % 100).cast("string"), 2, "0"), F.lit("_001"))
    return o.select("o_orderkey", name.alias("frame_id")).withColumn("segment", values.segment_of(F.col("frame_id")))


@query("""SELECT event_id, strftime(make_timestamp(epoch_us(ts)), '%Y-%m-%d %H:%M') AS shown, round((epoch_us(ts) - 1262304000000000) / 60000000.0::DOUBLE, 6) AS minutes, epoch_us(ts) // 1000000 * 1000000 AS whole_seconds FROM events""")
def stored_times(spark, sf_dir):
    """Times as counts of units since an epoch, there and back."""
    epoch = 1_262_304_000_000_000
    e = _table(spark, sf_dir, "events")
    seconds = F.floor(values.encoded_time(F.col("ts"), "s"))
    return e.select("event_id", values.shown_date(F.col("ts")).alias("shown"), _r(values.encoded_time(F.col("ts"), "min", epoch)).alias("minutes"), values.micros(values.decoded_time(seconds, "s")).alias("whole_seconds"))


@query("""SELECT s_suppkey, CASE s_nationkey WHEN 0 THEN 'north' WHEN 1 THEN 'south' ELSE 'unknown' END AS place, (SELECT count(DISTINCT n.n_regionkey) FROM nation n WHERE n.n_regionkey < m.n_regionkey)::INT % 3 AS colour FROM supplier s JOIN nation m ON s_nationkey = m.n_nationkey""")
def looked_up_names(spark, sf_dir):
    """A dictionary with a fallback, and a stable colour per region."""
    known = F.create_map(F.lit("0"), F.lit("north"), F.lit("1"), F.lit("south"))
    nation = _table(spark, sf_dir, "nation")
    colours = nation.select("n_regionkey").distinct().withColumn("colour", values.colour_index("n_regionkey", 3))
    own = _table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).join(colours, "n_regionkey")
    return own.select("s_suppkey", values.looked_up(known, F.col("s_nationkey").cast("string")).alias("place"), "colour")


@query(f"""WITH {RADAR} SELECT vec_id, k::INT AS k, round(sqrt(p[2 * k + 1] * p[2 * k + 1] + p[2 * k + 2] * p[2 * k + 2]), 6) AS magnitude, CASE WHEN p[2 * k + 1] > 0 AND p[2 * k + 2] > 0 THEN round(10 * log10(p[2 * k + 1]) - 10 * log10(p[2 * k + 2]), 6) END AS snr, round((2000 - 149896229.0::DOUBLE * 1e-6 * (1 + 0.25 * si)) - (1800 - bi), 5) AS thickness, CASE WHEN vec_id * 97 >= 100000 THEN 1000.0::DOUBLE WHEN vec_id * 97 >= 10000 THEN 100.0 ELSE 0.0 END AS tolerance FROM r, range(32) t(k)""")
def trace_physics(spark, sf_dir):
    """Magnitudes of complex samples, signal over noise, thickness from elevations, tolerance by area."""
    rows = _radar(spark, sf_dir)
    surface = physics.surface_elevation(F.lit(2000.0), F.col("surface") * 1e-6)
    bed = F.lit(1800.0) - F.round((F.col("bed") - 1.0) / 0.25)
    pairs = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda k: F.struct(F.get("data", 2 * k).alias("re"), F.get("data", 2 * k + 1).alias("im")))
    rows = rows.select("vec_id", physics.thickness_between(surface, bed).alias("thickness"), physics.simplify_tolerance(F.col("vec_id") * 97).alias("tolerance"), F.posexplode(pairs).alias("k", "s"))
    re, im = F.col("s.re"), F.col("s.im")
    return rows.select("vec_id", "k", _r(physics.magnitude(re, im)).alias("magnitude"), _r(physics.bed_snr_db(physics.to_db(re), physics.to_db(im))).alias("snr"), _r("thickness", 5).alias("thickness"), "tolerance")


@query(f"""WITH {RADAR}, x AS (SELECT vec_id, p, unnest(generate_series(0, 9)) AS k FROM r), y AS (SELECT vec_id, k, 0.9::DOUBLE + k * 1.9::DOUBLE AS g, p FROM x), z AS (SELECT vec_id, k, g, p, least(63, floor((g - 1) / 0.25)::INT + 1) AS i FROM y)
SELECT vec_id, k::INT AS k, CASE WHEN g >= 1 AND g <= 16.75 THEN round(p[i] + (p[i + 1] - p[i]) * (g - (1 + 0.25 * (i - 1))) / 0.25, 6) END AS v FROM z""")
def interpolated_samples(spark, sf_dir):
    """Samples on another axis, linear between neighbours, none outside."""
    at = F.transform(F.sequence(F.lit(0), F.lit(9)), lambda k: F.lit(0.9) + k * F.lit(1.9))
    rows = _radar(spark, sf_dir).select("vec_id", F.posexplode(arrays.interpolated(F.col("twtt"), F.col("data"), at)).alias("k", "v"))
    return rows.select("vec_id", "k", _r("v").alias("v"))


@query(f"""WITH {RADAR} SELECT vec_id, k::INT AS k, p[1 + k % 8 * 8 + k // 8] AS v FROM r, range(64) t(k)""")
def transposed_frame(spark, sf_dir):
    """A frame stored with the other orientation: its samples as a square, rows as columns."""
    square = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.slice(F.col("data"), i * 8 + 1, 8))
    rows = _radar(spark, sf_dir).withColumn("m", square)
    return rows.select("vec_id", F.posexplode(F.flatten(arrays.transposed(F.col("m")))).alias("k", "v"))


@query(f"""WITH {RADAR}, w AS (SELECT vec_id, p, min(1 + 0.25 * si) OVER f - 3 AS lo, coalesce(max(1 + 0.25 * bi) OVER f, max(1 + 0.25 * si) OVER f) + 3 AS hi FROM r WINDOW f AS (PARTITION BY label, vec_id // 100))
SELECT vec_id, least(64, greatest(0, floor((hi - 1) / 0.25) + 1)) - greatest(0, ceil((lo - 1) / 0.25)) AS n_shown, round(p[(greatest(0, ceil((lo - 1) / 0.25)) + 1)::INT], 6) AS first_shown FROM w""")
def display_clip(spark, sf_dir):
    """Samples around a frame's picks, for drawing."""
    rows = _radar(spark, sf_dir).withColumn("frame", F.floor(F.col("vec_id") / 100))
    out = analyses.display_clip(rows, ["label", "frame"])
    return out.select("vec_id", F.size("data").cast("double").alias("n_shown"), _r(F.col("data")[0]).alias("first_shown"))


@query(f"""WITH {RADAR} SELECT vec_id, CASE WHEN bi IS NOT NULL THEN round(10 * log10(list_max(p[bi - 1 : bi + 3])), 6) END AS peak_dB, CASE WHEN si - 2 > 2 THEN round(10 * log10(list_aggregate(p[3 : si - 1], 'median')), 6) END AS median_dB, CASE WHEN si - 2 > 2 THEN (si - 3)::DOUBLE ELSE 0.0 END AS n_samples FROM r""")
def sql_window_functions(spark, sf_dir):
    """Windows of a trace as SQL functions."""
    sql.register(spark)
    _radar(spark, sf_dir).createOrReplaceTempView("firnline_traces")
    return spark.sql("SELECT vec_id, round(window_max_db(data, twtt, bed, 0.6D), 6) AS peak_dB, round(window_median_db(data, twtt, 1.5D, surface - 0.5D), 6) AS median_dB, window_count(data, twtt, 1.5D, surface - 0.5D) AS n_samples FROM firnline_traces")


# ---- flags, filters, frames -----------------------------------------------------------------------------------------


@query("""SELECT o_orderkey, o_orderkey % 3 <> 0 AS new_flag, o_orderkey % 5 <> 0 AS old_flag, CASE WHEN o_orderkey % 3 <> 0 AND o_orderkey % 2 = 0 AND o_orderkey % 7 <> 0 THEN 0 ELSE 1 END AS draw_order FROM orders""")
def surface_flags(spark, sf_dir):
    """The surface flag, in older tables the only one; censored traces are drawn first."""
    k = F.col("o_orderkey")
    rows = _table(spark, sf_dir, "orders").select("o_orderkey", (k % 3 != 0).alias("qc_surface_pass"), (k % 5 != 0).alias("qc_pass"), (k % 2 == 0).alias("tried"), (k % 7 == 0).alias("found"))
    old = quality.surface_flag(rows.drop("qc_surface_pass"))
    hidden = quality.censored(F.col("qc_surface_pass"), F.col("tried"), F.col("found"))
    return rows.select("o_orderkey", quality.surface_flag(rows).alias("new_flag"), old.alias("old_flag"), values.draw_order(hidden).alias("draw_order"))


@query(f"WITH {POINTS} SELECT o_orderkey FROM g WHERE latitude BETWEEN -73 AND -71 AND longitude BETWEEN -30 AND 60")
def points_in_view(spark, sf_dir):
    return _points(spark, sf_dir).where(geo.in_view(F.col("latitude"), F.col("longitude"), -73.0, -30.0, -71.0, 60.0)).select("o_orderkey")


@query(f"WITH {PLANE} SELECT o_custkey, CASE WHEN avg(x - 10000) < 0 THEN 'south' ELSE 'north' END AS hemisphere, round(avg(x) - 50000, 4) AS x_min, round(avg(y) + 50000, 4) AS y_max FROM g GROUP BY o_custkey")
def boxes_around(spark, sf_dir):
    """A track's hemisphere, and a square around it."""
    box = geo.box_around(F.col("x"), F.col("y"))
    out = _plane(spark, sf_dir).groupBy("o_custkey").agg(geo.hemisphere(F.col("x") - 10000).alias("hemisphere"), *box)
    return out.select("o_custkey", "hemisphere", _r("x_min", 4).alias("x_min"), _r("y_max", 4).alias("y_max"))


@query("SELECT user_id, event_id, value FROM events WHERE user_id = (SELECT min(user_id) FROM events WHERE event_type = 'view') AND event_type = 'view'")
def rows_of_frame(spark, sf_dir):
    traces = _traces(spark, sf_dir)
    return frame_ops.rows_of_frame(traces, traces.agg(F.min("user_id")).first()[0], "user_id", "t").select("user_id", "event_id", "value")


@query("SELECT o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey IN (2, 5)")
def traces_of_collections(spark, sf_dir):
    frames = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("collection"))
    return frame_ops.of_collections(_table(spark, sf_dir, "orders"), frames, [2, 5], "o_custkey").select("o_orderkey")


@query("SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def listed_names(spark, sf_dir):
    return frame_ops.listed(_table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority")


@query("""SELECT o_custkey, c_nationkey, c_custkey IS NOT NULL AS found FROM (SELECT DISTINCT o_custkey FROM orders) LEFT JOIN (SELECT * FROM customer WHERE c_nationkey <> 3) ON o_custkey = c_custkey""")
def catalogued_frames(spark, sf_dir):
    """Stored frames in the catalogue, and those it lacks."""
    catalogue = _table(spark, sf_dir, "customer").where("c_nationkey <> 3").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    found, lost = frame_ops.catalogued(_table(spark, sf_dir, "orders"), catalogue, "o_custkey")
    return found.select("o_custkey", "c_nationkey", F.lit(True).alias("found")).unionByName(lost.select("o_custkey", F.lit(None).cast("int").alias("c_nationkey"), F.lit(False).alias("found")))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 100 IN (3, 33)")
def mid_segment_frames(spark, sf_dir):
    """Frames whose names end as those amid a segment do."""
    o = _table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("f_0"), F.col("o_orderkey").cast("string")).alias("frame_id"))
    return sampling.mid_segment(o, ["03", "33"]).select("o_orderkey")


@query("SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('ASIA', 'EUROPE') AND n_regionkey = 2")
def found_regions(spark, sf_dir):
    rows = _table(spark, sf_dir, "nation").join(_table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return frame_ops.find_regions(rows, r_name=["ASIA", "EUROPE"], n_regionkey="2", n_name=None).select("n_nationkey")


@query(f"""WITH {PLANE}, p AS (SELECT * FROM g WHERE o_orderkey % 7 <> 0) SELECT o_orderkey, x, y FROM g WHERE o_custkey IN (SELECT o_custkey FROM p)""")
def tracks_with_picks(spark, sf_dir):
    """Traces of tracks with a pick."""
    rows = _plane(spark, sf_dir)
    picks = rows.select("o_custkey", F.when(F.col("o_orderkey") % 7 != 0, F.col("x")).alias("pick"))
    return frame_ops.with_any_pick(rows, picks, ["o_custkey"], "pick").select("o_orderkey", "x", "y")


_BOXES = f"""WITH {PLANE}, b AS (SELECT o_custkey, min(x) AS x0, min(y) AS y0, min(x) + 900 AS x1, min(y) + 700 AS y1 FROM g GROUP BY o_custkey)"""


@query(f"""{_BOXES} SELECT o_custkey FROM b WHERE x1 >= 4000 AND x0 <= 9000 AND y1 >= 3000 AND y0 <= 12000 AND NOT (x1 >= 6000 AND x0 <= 7000 AND y1 >= 5000 AND y0 <= 6000) AND o_custkey % 4 = 1""")
def frames_in_shape(spark, sf_dir):
    """Frames of one collection whose box meets a polygon but not another."""
    rows = _plane(spark, sf_dir).groupBy("o_custkey").agg(F.min("x").alias("x_min"), F.min("y").alias("y_min"))
    frames = rows.select(F.col("o_custkey"), F.col("o_custkey").alias("frame_id"), (F.col("o_custkey") % 4).cast("string").alias("collection"), "x_min", "y_min", (F.col("x_min") + 900).alias("x_max"), (F.col("y_min") + 700).alias("y_max"))
    square = lambda x0, y0, x1, y1: [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]
    return run.select_frames(frames, {"collections": ["1"]}, shape=square(4000, 3000, 9000, 12000), without=square(6000, 5000, 7000, 6000)).select("o_custkey")


@query(f"""{_INSIDE} SELECT o_orderkey, inside OR (x BETWEEN 15000 AND 16000 AND y BETWEEN 1000 AND 2000) AS inside FROM c JOIN g USING (o_orderkey)""")
def point_in_shapes(spark, sf_dir):
    """Inside any of several rings."""
    square = [(14999.5, 999.5), (16000.5, 999.5), (16000.5, 2000.5), (14999.5, 2000.5)]
    return _plane(spark, sf_dir).select("o_orderkey", geo.in_polygon(F.col("x"), F.col("y"), [RING, square]).alias("inside"))


@query(f"""WITH {EVENTS} SELECT v.user_id, event_id, (SELECT pick FROM p WHERE p.user_id = v.user_id AND abs(p.t - v.t) <= 5000000 ORDER BY abs(p.t - v.t), p.t DESC LIMIT 1) AS pick FROM v""")
def realigned_picks(spark, sf_dir):
    """Values at the nearest time within five seconds."""
    out = time_axis.nearest(_traces(spark, sf_dir), _picks(spark, sf_dir), ["user_id"], "t", ["pick"], values.duration_micros("5s"))
    return out.select("user_id", "event_id", F.col("near_pick").alias("pick"))


# ---- matching and reports -------------------------------------------------------------------------------------------


@query(f"WITH {PLANE} SELECT o_orderkey, round(sqrt((x - 10000) * (x - 10000) + (y - 10000) * (y - 10000)), 6) AS distance_m FROM g ORDER BY 2, 1 LIMIT 1")
def nearest_to(spark, sf_dir):
    """The trace under the pointer."""
    return matching.nearest_to(_plane(spark, sf_dir), 10000.0, 10000.0, ("x", "y"), "o_orderkey", 5000.0).select("o_orderkey", _r("distance_m").alias("distance_m"))


_OTHER = "h AS (SELECT p_partkey, (p_partkey * 7907 % 20011)::DOUBLE AS px, (p_partkey * 104723 % 20021)::DOUBLE AS py, p_retailprice AS pv FROM part)"


@query(f"""WITH {PLANE}, {_OTHER}, m AS (SELECT o_orderkey, o_totalprice, p_partkey, pv, sqrt((x - px) * (x - px) + (y - py) * (y - py)) AS d FROM g, h WHERE abs(x - px) < 120 AND abs(y - py) < 120),
a AS (SELECT * FROM m WHERE d < 120 QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY d, p_partkey) = 1), b AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY d, o_orderkey) = 1)
SELECT o_orderkey, p_partkey, round(d, 6) AS distance_m, round(o_totalprice - pv, 4) AS diff FROM b""")
def dataset_comparison(spark, sf_dir):
    """Two data sets' points matched one to one, with differences."""
    other = _table(spark, sf_dir, "part").select("p_partkey", (F.col("p_partkey") * 7907 % 20011).cast("double").alias("x"), (F.col("p_partkey") * 104723 % 20021).cast("double").alias("y"), "p_retailprice")
    out = analyses.dataset_comparison(_plane(spark, sf_dir), other, 120.0, "o_orderkey", "p_partkey", "o_totalprice", "p_retailprice")
    return out.select("o_orderkey", F.col("_other").alias("p_partkey"), _r("distance_m").alias("distance_m"), _r("diff", 4).alias("diff"))


def _sounder(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Picks at every place but some, one flight without radargrams, one too thick for its record."""
    v = F.col("vec_id")
    flight = F.concat(F.when(F.col("label") % 2 == 0, "b").otherwise("H"), F.col("label").cast("string"))
    rows = _table(spark, sf_dir, "embeddings").select("vec_id", "label", flight.alias("flight"), F.transform("embedding", lambda e: F.abs(e.cast("double"))).alias("low_gain"))
    at = (v * 137 % 10007).cast("double")
    grams = rows.where("label <> 7").select("flight", F.col("vec_id").alias("trace_id"), at.alias("x"), F.lit(0.0).alias("y"), F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: i * F.lit(4e-7)).alias("twtt"), "low_gain", F.transform("low_gain", lambda e: e * 8000.0).alias("high_gain"))
    height = F.when(v % 11 == 3, None).otherwise(500.0 + v % 50)
    picks = rows.select("flight", F.col("vec_id").alias("point_id"), (at + (v % 13) * 60.0).alias("x"), F.lit(0.0).alias("y"), height.alias("radar_height"), F.when(v % 17 == 5, 9000.0).otherwise(800.0 + v % 70).alias("ice_thickness"))
    return picks, grams


_SOUNDER = """e AS (SELECT vec_id AS k, CASE WHEN label % 2 = 0 THEN 'b' ELSE 'H' END || label AS flight, label, list_transform(embedding, lambda v: abs(v::DOUBLE)) AS p, (vec_id * 137 % 10007)::DOUBLE AS x, CASE WHEN vec_id % 11 <> 3 THEN 500.0::DOUBLE + vec_id % 50 END AS h, CASE WHEN vec_id % 17 = 5 THEN 9000.0::DOUBLE ELSE 800.0 + vec_id % 70 END AS z FROM embeddings),
n AS (SELECT a.k, a.flight, a.h, a.z, b.k AS t, b.p, abs(a.x + (a.k % 13) * 60.0::DOUBLE - b.x) AS d FROM e a JOIN e b ON a.flight = b.flight AND b.label <> 7 WHERE abs(a.x + (a.k % 13) * 60.0::DOUBLE - b.x) < 500 AND a.h IS NOT NULL QUALIFY row_number() OVER (PARTITION BY a.k ORDER BY d, b.k) = 1),
s AS (SELECT *, h * (2 / 299792458.0::DOUBLE) AS ts, h * (2 / 299792458.0::DOUBLE) + z * (2 * 1.78::DOUBLE / 299792458.0::DOUBLE) AS tb, 50 / (299792458.0::DOUBLE / sqrt(1.78::DOUBLE * 1.78::DOUBLE)) AS m FROM n),
o AS (SELECT k, flight, t, list_filter(list_transform(generate_series(0, 63), lambda i: CASE WHEN i * 4e-7::DOUBLE >= ts - m AND i * 4e-7::DOUBLE <= ts + m THEN p[i + 1] END), lambda v: v IS NOT NULL) AS ws, list_filter(list_transform(generate_series(0, 63), lambda i: CASE WHEN i * 4e-7::DOUBLE >= tb - m AND i * 4e-7::DOUBLE <= tb + m THEN p[i + 1] END), lambda v: v IS NOT NULL) AS wb, ts, tb FROM s WHERE tb <= 63 * 4e-7::DOUBLE),
q AS (SELECT k, flight, t, 10 * log10(list_max(ws)) AS ps, CASE WHEN flight LIKE 'b%' THEN 10 * log10(list_max(wb)) ELSE 10 * log10(list_max(wb) * 8000.0) - 39 END AS pb, ts, tb FROM o)"""


@query(f"""WITH {_SOUNDER} SELECT k AS point_id, t AS trace_id, round(ps, 4) AS surface_power_dB, round(pb, 4) AS bed_power_dB, round(ps - pb + 20 * log10(ts / (ts + (tb - ts) / (1.78::DOUBLE * 1.78::DOUBLE))), 4) AS rssnr FROM q""")
def sounder_rssnr(spark, sf_dir):
    """Required surface SNR at sounder picks, from the nearest trace of their flight."""
    out = analyses.sounder_rssnr(*_sounder(spark, sf_dir))
    return out.select("point_id", "trace_id", _r("surface_power_dB", 4).alias("surface_power_dB"), _r("bed_power_dB", 4).alias("bed_power_dB"), _r("rssnr", 4).alias("rssnr"))


@query(f"""WITH {_SOUNDER}, w AS (SELECT a.k, EXISTS (SELECT 1 FROM e b WHERE b.flight = a.flight AND b.label <> 7 AND abs(a.x + (a.k % 13) * 60.0::DOUBLE - b.x) < 500) AS near, a.label, a.h FROM e a)
SELECT w.k AS point_id, CASE WHEN q.k IS NOT NULL THEN 'ok' WHEN h IS NULL THEN 'no value' WHEN label = 7 THEN 'no radargram' WHEN NOT near THEN 'too far' ELSE 'outside record' END AS status FROM w LEFT JOIN q ON q.k = w.k""")
def sounder_status(spark, sf_dir):
    """What became of each sounder pick."""
    return analyses.sounder_status(*_sounder(spark, sf_dir)).select("point_id", "status")


@query(f"""WITH {_SOUNDER}, w AS (SELECT a.k, EXISTS (SELECT 1 FROM e b WHERE b.flight = a.flight AND b.label <> 7 AND abs(a.x + (a.k % 13) * 60.0::DOUBLE - b.x) < 500) AS near, a.label, a.h FROM e a)
SELECT w.k AS point_id, CASE WHEN q.k IS NOT NULL THEN 'ok' WHEN h IS NULL THEN 'no value' WHEN label = 7 THEN 'no radargram' WHEN NOT near THEN 'too far' ELSE 'outside record' END AS status, round(ps - pb + 20 * log10(q.ts / (q.ts + (q.tb - q.ts) / (1.78::DOUBLE * 1.78::DOUBLE))), 4) AS rssnr FROM w LEFT JOIN q ON q.k = w.k""")
def sounder_table_function(spark, sf_dir):
    """Values and status of all sounder picks, by a table function in SQL."""
    sounder.register(spark)
    sounder.matched_picks(*_sounder(spark, sf_dir)).createOrReplaceTempView("firnline_matched_picks")
    return spark.sql("SELECT point_id, status, round(rssnr, 4) AS rssnr FROM sounder_values(TABLE(SELECT * FROM firnline_matched_picks))")


@query(f"""WITH {PLANE}, s AS (SELECT *, lead(x) OVER w AS nx, lead(y) OVER w AS ny, lag(x) OVER w AS lx, lag(y) OVER w AS ly FROM g WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)),
t AS (SELECT *, coalesce(sqrt((nx - x) * (nx - x) + (ny - y) * (ny - y)) <= 9000, false) AS n, coalesce(sqrt((lx - x) * (lx - x) + (ly - y) * (ly - y)) <= 9000, false) AS l FROM s)
SELECT o_orderkey, CASE WHEN n OR l THEN round(degrees(atan2(CASE WHEN n THEN nx ELSE x END - CASE WHEN l THEN lx ELSE x END, CASE WHEN n THEN ny ELSE y END - CASE WHEN l THEN ly ELSE y END)), 6) END AS bearing FROM t""")
def gated_bearing(spark, sf_dir):
    """Bearings along a track, neighbours beyond the gate left out."""
    return _plane(spark, sf_dir).select("o_orderkey", _r(time_axis.bearing("x", "y", ["o_custkey"], ["o_orderkey"], gate=9000.0)).alias("bearing"))


_D = "SELECT l_quantity::DOUBLE AS q, (l_extendedprice / 1000)::DOUBLE AS p, (l_quantity - l_extendedprice / 1000)::DOUBLE AS d, l_returnflag AS instrument FROM lineitem"


@query(f"SELECT count(*) FILTER (q > 30 AND d > 8) AS n_hit, count(*) FILTER (q > 30 AND d <= 8) AS n_false, count(*) FILTER (q <= 30 AND d > 8) AS n_missed, round(count(*) FILTER (q > 30 AND d > 8) / count(*) FILTER (q > 30), 8) AS precision, round(count(*) FILTER (q > 30 AND d > 8) / count(*) FILTER (d > 8), 8) AS recall FROM ({_D})")
def threshold_scores(spark, sf_dir):
    rows = _differences(spark, sf_dir).withColumn("label", dist.label_above("v_diff", 8.0))
    out = dist.threshold_scores(rows, "v_a", "label", 30.0)
    return out.select("n_hit", "n_false", "n_missed", _r("precision", 8).alias("precision"), _r("recall", 8).alias("recall"))


@query(f"SELECT ((q >= 10)::INT + (q >= 25)::INT + (q >= 40)::INT) AS bin, count(*) AS n, round(avg((d > 8)::INT), 8) AS flagged_share FROM ({_D}) GROUP BY 1")
def share_by_bin(spark, sf_dir):
    """The share of large differences by signal-to-noise bins."""
    out = dist.binned_share(_differences(spark, sf_dir), "v_a", [10.0, 25.0, 40.0], F.col("v_diff") > 8)
    return out.select("bin", "n", _r("flagged_share", 8).alias("flagged_share"))


@query(f"SELECT instrument, count(*) AS n, round(avg((d < 0)::INT), 8) AS floating_share, round(median(q), 6) AS median, round(stddev_samp(q), 6) AS std FROM ({_D}) GROUP BY instrument")
def floating_shares(spark, sf_dir):
    rows = _differences(spark, sf_dir).withColumn("v_a", F.col("v_a").cast("double"))
    out = dist.floating_shares(rows, "v_diff", "v_a", ["instrument"])
    return out.select("instrument", "n", _r("floating_share", 8).alias("floating_share"), _r("median").alias("median"), _r("std").alias("std"))


@query(f"SELECT instrument, min(d) AS lowest, max(d) AS highest FROM ({_D}) WHERE d >= 2 GROUP BY instrument")
def extents_beyond(spark, sf_dir):
    """Extents per group of the points beyond a distance from the grounding line."""
    rows = analyses.beyond_grounding(_differences(spark, sf_dir), 2000.0, "v_diff").withColumn("v_diff", F.col("v_diff").cast("double"))
    return dist.group_extents(rows, "v_diff", ["instrument"])


@query(f"""WITH c AS (SELECT floor(q / 2.5)::INT AS ci, floor(p / 5)::INT AS cj, count(*) AS w FROM ({_D}) WHERE q >= 0 AND q < 60 AND p >= 0 AND p < 120 GROUP BY ALL), g AS (SELECT i, j FROM range(24) a(i), range(24) b(j)),
r AS (SELECT i, j, sum(w * exp(-0.5 * (((i - ci) * 2.5 / 4.0) * ((i - ci) * 2.5 / 4.0) + ((j - cj) * 5.0 / 9.0) * ((j - cj) * 5.0 / 9.0)))) AS raw FROM g, c GROUP BY i, j)
SELECT i::INT AS i, j::INT AS j, round(raw / (sum(raw) OVER () * 12.5), 9) AS density FROM r""")
def density_grid(spark, sf_dir):
    """Two-dimensional kernel density on a grid."""
    out = dist.density_grid(_differences(spark, sf_dir), "v_a", "v_b", (0.0, 0.0, 60.0, 120.0), 24, (4.0, 9.0))
    return out.select("i", "j", _r("density", 9).alias("density"))


@query(f"SELECT instrument, round(quantile_cont(d, 0.02) FILTER (q > 20), 6) AS low, round(quantile_cont(d, 0.98) FILTER (q > 20), 6) AS high FROM ({_D}) GROUP BY instrument")
def limits_of_included(spark, sf_dir):
    """Colour limits of the rows that a predicate includes."""
    out = _differences(spark, sf_dir).groupBy("instrument").agg(*dist.percentile_limits("v_diff", include=F.col("v_a") > 20))
    return out.select("instrument", _r("low").alias("low"), _r("high").alias("high"))


@query(f"""WITH {RADAR}, s AS (SELECT label, unnest(range(64)) AS i, p FROM r), m AS (SELECT label, round(0.25 * (63 - i), 9) AS t, 10 * log10(median(p[i + 1]) FILTER (p[i + 1] > 0)) AS v FROM s GROUP BY ALL), k AS (SELECT label, 0.1::DOUBLE * g AS u, g FROM (SELECT DISTINCT label FROM m), range(1, 150) z(g)),
b AS (SELECT k.label, u, v AS v0, t AS t0, lead_v AS v1 FROM k JOIN (SELECT *, lead(v) OVER (PARTITION BY label ORDER BY t) AS lead_v FROM m) m ON m.label = k.label AND k.u >= t AND k.u < t + 0.25), l AS (SELECT label, u, v0 + (v1 - v0) * (u - t0) / 0.25 AS v FROM b),
f AS (SELECT label, median(v) FILTER (u >= 2 AND u <= 9) AS base, median(v) FILTER (u >= 0.5 AND u <= 1.5) AS w FROM l GROUP BY label)
SELECT f.label, round(base, 6) AS plateau_dB, round(min(u) FILTER (v - base >= 0.2), 6) AS rolloff_until, round(any_value(w) - base, 6) AS bias_end FROM f JOIN l ON l.label = f.label GROUP BY f.label, base""")
def tail_sensitivity(spark, sf_dir):
    """Median profile on a finer grid, its plateau, the roll-off's reach and a window's bias."""
    out = analyses.tail_sensitivity(_radar(spark, sf_dir), ["label"], [0.1 * g for g in range(1, 150)], (2.0, 9.0), {"end": (0.5, 1.5)}, 0.2)
    return out.select("label", _r("plateau_dB").alias("plateau_dB"), _r("rolloff_until").alias("rolloff_until"), _r("bias_end").alias("bias_end"))


@query(f"""WITH {RADAR}, s AS (SELECT label, 1 + 0.25::DOUBLE * i AS t, 1 + 0.25::DOUBLE * si AS a, 1 + 0.25::DOUBLE * bi AS b, p[i + 1] AS v FROM r, range(64) u(i) WHERE bi IS NOT NULL), w AS (SELECT label, CASE WHEN t >= 1.25 AND t <= a - 0.5 THEN 'pre' WHEN t >= b + 0.75 AND t <= 16.75 - 1 THEN 'post' END AS z, v FROM s),
d AS (SELECT *, 10 * log10(greatest(v, 1e-40)) AS d FROM w WHERE z IS NOT NULL)
SELECT label, z AS "window", count(*) AS n, count(DISTINCT v) AS n_unique, count(*) FILTER (v = 0) AS n_zero, round(min(v), 6) AS "min", round(median(v), 6) AS median, round(max(v), 6) AS "max", round(quantile_cont(d, 0.01), 6) AS p1, round(quantile_cont(d, 0.99), 6) AS p99, round(quantile_cont(d, 0.99) - quantile_cont(d, 0.01), 6) AS spread, round(stddev_pop(d), 6) AS std FROM d GROUP BY label, z""")
def noise_populations(spark, sf_dir):
    """Samples of the windows before the surface and behind the bed."""
    out = analyses.noise_populations(_radar(spark, sf_dir), ["label"], (0.25, 0.5), (0.75, 1.0))
    return out.select("label", "window", "n", "n_unique", "n_zero", *[_r(c).alias(c) for c in ("min", "median", "max", "p1", "p99", "spread", "std")])


# ---- the store ------------------------------------------------------------------------------------------------------


def _scratch_root(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/store-{uuid.uuid4().hex[:12]}"


def _store_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders")
    return o.select(F.concat(F.lit("f"), F.col("o_custkey").cast("string")).alias("frame_id"), (F.col("o_custkey") % 3).cast("string").alias("collection"), F.timestamp_seconds(F.col("o_orderkey")).alias("slow_time"), F.col("o_totalprice").cast("double").alias("surface_power_dB"))


@query("""WITH o AS (SELECT *, o_custkey % 3 AS c FROM orders) SELECT sequence::INT AS sequence, count(*) AS n_rows, count(DISTINCT o_custkey) AS n_frames FROM o, range(4) t(sequence) WHERE c <= sequence AND (sequence < 3 OR o_custkey % 2 = 0) GROUP BY sequence""")
def store_versions(spark, sf_dir):
    """Appends of all collections and a removal of frames: rows and frames of each snapshot."""
    store, rows = SnapshotStore(spark, _scratch_root(spark)), _store_rows(spark, sf_dir)
    for part in ("0", "1", "2"):
        session = store.session()
        session.append(rows.where(F.col("collection") == part))
        session.update_frames()
        session.commit(f"part {part}")
    session = store.session()
    session.remove(rows.where(F.substring("frame_id", 2, 20).cast("long") % 2 == 1).select("frame_id").distinct())
    session.update_frames()
    session.commit("odd frames removed")
    out = None
    for n, s in enumerate(reversed(store.log())):
        one = store.read(s.id).agg(F.count("*").alias("n_rows"), F.count_distinct("frame_id").alias("n_frames")).withColumn("sequence", F.lit(n))
        out = one if out is None else out.unionByName(one)
    return out.select("sequence", "n_rows", "n_frames")


@query("""SELECT 'f' || o_custkey AS frame_id, (row_number() OVER (ORDER BY (o_custkey % 3)::VARCHAR, 'f' || o_custkey) - 1)::INT AS frame_index, (o_custkey % 3)::VARCHAR AS collection, NULL::DOUBLE AS missing FROM (SELECT DISTINCT o_custkey FROM orders)""")
def store_frames(spark, sf_dir):
    """The frame table that a commit writes, filled in from a catalogue, and a column that the table lacks."""
    from firnline.sources.snapshots import backfill, number_frames

    store, rows = SnapshotStore(spark, _scratch_root(spark)), _store_rows(spark, sf_dir)
    session = store.session()
    session.append(rows)
    session.commit("all")
    number_frames(store)
    backfill(store, rows.select("frame_id", "collection").distinct())
    absent = store.read(columns=["frame_id", "missing"]).groupBy("frame_id").agg(F.max("missing").alias("missing"))
    return store.frame_dim().select("frame_id", "frame_index", "collection").join(absent, "frame_id")


#: Commits without new rows between those with some, so that a history is longer than any log shows.
_IDLE = 110


def _long_history(spark: SparkSession, sf_dir: str) -> tuple[SnapshotStore, list[str]]:
    store, rows, ids = SnapshotStore(spark, _scratch_root(spark)), _store_rows(spark, sf_dir), []
    for part in ("0", "1", "2"):
        session = store.session()
        session.append(rows.where(F.col("collection") == part))
        ids.append(session.commit(part))
        for n in range(_IDLE if part == "0" else 0):
            store.session().commit(f"note {n}")
    return store, ids


@query(f"SELECT 'f' || o_custkey AS frame_id, min(CASE WHEN o_custkey % 3 = 0 THEN 0 ELSE {_IDLE} + o_custkey % 3 END)::INT AS first_sequence FROM orders GROUP BY 1")
def store_first_seen(spark, sf_dir):
    """The snapshot in which each frame was first, over a long history."""
    return frame_ops.first_seen(_long_history(spark, sf_dir)[0].frame_history()).select("frame_id", "first_sequence")


@query("""SELECT CASE WHEN o_custkey % 3 = 0 THEN 'delete' ELSE 'insert' END AS change, 'f' || o_custkey AS frame_id, count(*) AS n, round(sum(o_totalprice), 2) AS power FROM orders WHERE (o_custkey % 3 = 0) = (o_custkey % 2 = 1) GROUP BY ALL""")
def store_changes(spark, sf_dir):
    """What came and went between the first snapshot and the last: rows that were only written anew are neither."""
    store, ids = _long_history(spark, sf_dir)
    session = store.session()
    session.remove(_store_rows(spark, sf_dir).where(F.substring("frame_id", 2, 20).cast("long") % 2 == 1).select("frame_id").distinct())
    session.commit("odd frames removed")
    out = store.changes(ids[0]).groupBy("change", "frame_id").agg(F.count("*").alias("n"), F.sum("surface_power_dB").alias("power"))
    return out.select("change", "frame_id", "n", _r("power", 2).alias("power"))
