"""The registered queries: every operator on the driver's tables, each with its DuckDB counterpart.

Carriers: an ``embeddings`` row is a trace (samples are absolute values at 1 + 0.25 i microseconds, label its season);
``events`` of a user are a frame's traces (view) and picks (purchase, missing where event_id % 7 = 0); ``orders`` are
points along customers' tracks; ``lineitem`` gives differences per supplier.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from firnline.functions import arrays, geo, physics, values
from firnline.operators import crossovers as cross
from firnline.operators import distributions as dist
from firnline.operators import frames as frame_ops
from firnline.operators import matching, quality, sampling, time_axis
from firnline.operators.parts import parts_of
from firnline.plans import analyses

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
DAY = 86_400_000_000


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _r(c: Column | str, digits: int = 6) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


# ---- carriers -------------------------------------------------------------------------------------------------------


def _radar(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    data = F.transform("embedding", lambda v: F.abs(v.cast("double")))
    axis = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.lit(1.0) + i * 0.25)
    surface = F.lit(1.0) + (F.lit(5) + F.col("vec_id") % 8) * 0.25
    bed = F.when(F.col("vec_id") % 9 != 0, F.lit(1.0) + (F.lit(35) + F.col("vec_id") % 16) * 0.25)
    return rows.select("vec_id", "label", data.alias("data"), axis.alias("twtt"), surface.alias("surface"), bed.alias("bed"))


RADAR = """r AS (SELECT vec_id, label, list_transform(embedding, lambda v: abs(v::DOUBLE)) AS p, 5 + vec_id % 8 AS si, CASE WHEN vec_id % 9 <> 0 THEN 35 + vec_id % 16 END AS bi FROM embeddings)"""


def _traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "events").where("event_type = 'view'")
    return rows.select("user_id", "event_id", values.micros(F.col("ts")).alias("t"), "value")


def _picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "events").where("event_type = 'purchase'")
    known = F.when(F.col("event_id") % 7 != 0, F.col("value"))
    return rows.groupBy("user_id", values.micros(F.col("ts")).alias("t")).agg(F.max(known).alias("pick"))


EVENTS = """v AS (SELECT user_id, event_id, epoch_us(ts) AS t, value FROM events WHERE event_type = 'view'),
p AS (SELECT user_id, epoch_us(ts) AS t, max(CASE WHEN event_id % 7 <> 0 THEN value END) AS pick FROM events WHERE event_type = 'purchase' GROUP BY ALL)"""


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "orders")
    lat = -70.0 - (F.col("o_orderkey") * 7919 % 10000) / 2000.0
    lon = (F.col("o_orderkey") * 104729 % 36000) / 100.0 - 180.0
    return rows.select("o_orderkey", "o_custkey", "o_totalprice", F.year("o_orderdate").alias("season"), lat.alias("latitude"), lon.alias("longitude"))


POINTS = """g AS (SELECT o_orderkey, o_custkey, o_totalprice, year(o_orderdate)::INT AS season, -70.0::DOUBLE - (o_orderkey * 7919 % 10000) / 2000.0::DOUBLE AS latitude, (o_orderkey * 104729 % 36000) / 100.0::DOUBLE - 180.0::DOUBLE AS longitude FROM orders)"""


def _plane(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points on an integer grid of metres: exact in either engine."""
    rows = _table(spark, sf_dir, "orders")
    x = (F.col("o_orderkey") * 7919 % 20011).cast("double")
    y = (F.col("o_orderkey") * 104729 % 20021).cast("double")
    return rows.select("o_orderkey", "o_custkey", "o_totalprice", F.year("o_orderdate").alias("season"), x.alias("x"), y.alias("y"))


PLANE = """g AS (SELECT o_orderkey, o_custkey, o_totalprice, year(o_orderdate)::INT AS season, (o_orderkey * 7919 % 20011)::DOUBLE AS x, (o_orderkey * 104729 % 20021)::DOUBLE AS y FROM orders)"""


# ---- windows of a trace ---------------------------------------------------------------------------------------------


@query(f"""WITH {RADAR}, w AS (SELECT vec_id, p[greatest(1, si - 1) : si + 3] AS s, p[bi - 1 : bi + 3] AS b, si, bi FROM r)
SELECT vec_id, round(1 + 0.25 * (si - 3 + list_position(s, list_max(s))), 6) AS surface_twtt, round(10 * log10(list_max(s)), 6) AS surface_dB,
CASE WHEN bi IS NOT NULL THEN round(1 + 0.25 * (bi - 3 + list_position(b, list_max(b))), 6) END AS bed_twtt, CASE WHEN bi IS NOT NULL THEN round(10 * log10(list_max(b)), 6) END AS bed_dB FROM w""")
def peak_in_window(spark, sf_dir):
    """Peak level and time around a pick; none without one."""
    d, t = F.col("data"), F.col("twtt")
    rows = _radar(spark, sf_dir).withColumns({"s": arrays.window_peak(d, t, F.col("surface"), 0.6), "b": arrays.window_peak(d, t, F.col("bed"), 0.6)})
    return rows.select("vec_id", _r("s.twtt").alias("surface_twtt"), _r("s.power_dB").alias("surface_dB"), _r("b.twtt").alias("bed_twtt"), _r("b.power_dB").alias("bed_dB"))


@query(f"""WITH {RADAR} SELECT vec_id, CASE WHEN bi IS NOT NULL THEN round(10 * log10(list_max(p[bi - 1 : bi + 3])), 6) END AS peak_dB FROM r""")
def max_in_window(spark, sf_dir):
    rows = _radar(spark, sf_dir)
    return rows.select("vec_id", _r(arrays.window_max_db(F.col("data"), F.col("twtt"), F.col("bed"), 0.6)).alias("peak_dB"))


@query(f"""WITH {RADAR}, w AS (SELECT vec_id, CASE WHEN si - 2 > 2 THEN p[3 : si - 1] END AS a, CASE WHEN bi IS NOT NULL AND bi + 4 < 61 THEN p[bi + 5 : 62] END AS b, p[41 : 57] AS c FROM r)
SELECT vec_id, round(10 * log10(list_aggregate(a, 'median')), 6) AS pre_surface_noise_dB, round(10 * log10(list_aggregate(b, 'median')), 6) AS post_bed_noise_dB, round(10 * log10(list_aggregate(c, 'median')), 6) AS record_tail_noise_dB FROM w""")
def window_medians(spark, sf_dir):
    """Noise windows before the surface, below the bed, and in the record's tail."""
    d, t = F.col("data"), F.col("twtt")
    first, last = F.element_at(t, 1), F.element_at(t, -1)
    rows = _radar(spark, sf_dir)
    return rows.select(
        "vec_id",
        _r(arrays.window_median_db(d, t, first + 0.5, F.col("surface") - 0.5)).alias("pre_surface_noise_dB"),
        _r(arrays.window_median_db(d, t, F.col("bed") + 1.0, last - 0.5)).alias("post_bed_noise_dB"),
        _r(arrays.tail_median_db(d, t, 5.75, 1.75)).alias("record_tail_noise_dB"),
    )


@query(f"""WITH {RADAR}, w AS (SELECT vec_id, p[bi + 5 : 62] AS b, list_transform(list_filter(p[bi + 5 : 62], lambda v: v > 0), lambda v: 10 * log10(v)) AS l FROM r WHERE bi IS NOT NULL AND bi + 4 < 61)
SELECT r.vec_id, round(10 * log10(list_aggregate(b, 'median')), 6) AS median_dB, round(list_max(l), 6) AS peak_dB, round(list_aggregate(l, 'stddev_pop'), 6) AS std_dB FROM r LEFT JOIN w USING (vec_id)""")
def window_statistics(spark, sf_dir):
    """Median, peak and spread of one window."""
    rows = _radar(spark, sf_dir).withColumn("m", arrays.window_metrics(F.col("data"), F.col("twtt"), F.col("bed") + 1.0, F.element_at("twtt", -1) - 0.5))
    return rows.select("vec_id", _r("m.median_dB").alias("median_dB"), _r("m.peak_dB").alias("peak_dB"), _r("m.std_dB").alias("std_dB"))


_RSSNR = f"""WITH {RADAR}, w AS (SELECT vec_id, label, 10 * log10(list_max(p[si - 1 : si + 3])) AS ps, 10 * log10(list_max(p[bi - 1 : bi + 3])) AS pb, (1 + 0.25 * si) * 1e-6 AS ts, (1 + 0.25 * bi) * 1e-6 AS tb FROM r WHERE bi IS NOT NULL),
e AS (SELECT *, 299792458.0::DOUBLE / 2 * ts AS rs, 299792458.0::DOUBLE / sqrt(3.17) / 2 * (tb - ts) AS h FROM w),
f AS (SELECT *, ps - pb + 20 * log10(rs / (rs + h / sqrt(3.17))) AS rssnr FROM e)"""


def _rssnr(spark, sf_dir):
    d, t = F.col("data"), F.col("twtt")
    rows = _radar(spark, sf_dir).where("bed is not null")
    rows = rows.withColumns({"ps": arrays.window_max_db(d, t, F.col("surface"), 0.6), "pb": arrays.window_max_db(d, t, F.col("bed"), 0.6), "ts": F.col("surface") * 1e-6, "tb": F.col("bed") * 1e-6})
    return rows.withColumn("rssnr", physics.required_surface_snr_db(F.col("ps"), F.col("pb"), F.col("ts"), F.col("tb")))


@query(_RSSNR + "SELECT vec_id, round(rssnr, 6) AS rssnr_dB, round(h, 4) AS thickness_m, round(2000 - rs, 4) AS surface_m, round(2000 - rs - h, 4) AS bed_m FROM f")
def radar_metrics(spark, sf_dir):
    """RSSNR, thickness and elevations of each trace."""
    rows = _rssnr(spark, sf_dir)
    top = physics.surface_elevation(F.lit(2000.0), F.col("ts"))
    return rows.select("vec_id", _r("rssnr").alias("rssnr_dB"), _r(physics.ice_thickness(F.col("ts"), F.col("tb")), 4).alias("thickness_m"), _r(top, 4).alias("surface_m"), _r(physics.bed_elevation(top, F.col("ts"), F.col("tb")), 4).alias("bed_m"))


@query(_RSSNR + """, m AS (SELECT label, median(rssnr) AS med FROM f GROUP BY label), q AS (SELECT label, rssnr - med AS d FROM f JOIN m USING (label))
SELECT label, count(*) AS n, round(avg(d), 6) AS mean_diff, round(stddev_pop(d), 6) AS std_diff, round(sqrt(avg(d * d)), 6) AS rms_diff, round(median(abs(d)), 6) AS median_abs_diff FROM q GROUP BY label""")
def rssnr_by_season(spark, sf_dir):
    """Flagship: window peaks to RSSNR to a difference summary per season."""
    rows = _rssnr(spark, sf_dir)
    middle = rows.groupBy("label").agg(F.expr("percentile(rssnr, 0.5D)").alias("med"))
    pairs = rows.join(middle, "label").select("label", F.col("rssnr").alias("rssnr_a"), F.col("med").alias("rssnr_b"), (F.col("rssnr") - F.col("med")).alias("rssnr_diff"))
    out = dist.difference_summary(pairs, ["rssnr"], ["label"])
    return out.select("label", "n", *[_r(c).alias(c) for c in ("mean_diff", "std_diff", "rms_diff", "median_abs_diff")])


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rssnr_by_season(spark, sf_dir)


@query(f"""WITH {RADAR}, m(margin_m, k) AS (VALUES (10.0, 0), (50.0, 1), (100.0, 2), (250.0, 5)), w AS (SELECT vec_id, margin_m, p[greatest(1, si + 1 - k) : si + 1 + k] AS s, greatest(1, si + 1 - k) AS a FROM r, m)
SELECT vec_id, margin_m::DOUBLE AS margin_m, round(1e-6 * (1 + 0.25 * (a - 2 + list_position(s, list_max(s)))), 9) AS peak_twtt, round(10 * log10(list_max(s)), 6) AS peak_dB FROM w""")
def margin_sweep(spark, sf_dir):
    """The peak for several search margins at once."""
    rows = _radar(spark, sf_dir).select("vec_id", "data", F.transform("twtt", lambda t: t * 1e-6).alias("twtt"), (F.col("surface") * 1e-6).alias("pick"))
    out = analyses.margin_sweep(rows, [10.0, 50.0, 100.0, 250.0])
    return out.select("vec_id", "margin_m", _r("peak_twtt", 9).alias("peak_twtt"), _r("peak_dB").alias("peak_dB"))


@query(f"""WITH {RADAR}, s AS (SELECT label, unnest(generate_series(0, 63)) AS i, unnest(p) AS v FROM r), b AS (SELECT label, 63 - i AS k, 10 * log10(median(v)) AS level FROM s WHERE v > 0 GROUP BY ALL),
q AS (SELECT label, median(level) AS base FROM b WHERE k BETWEEN 20 AND 40 GROUP BY label)
SELECT label, round(k * 0.25, 6) AS before_end, round(level - base, 6) AS relative_dB, bool_and(level - base < -0.2) OVER (PARTITION BY label ORDER BY k) AS in_rolloff FROM b JOIN q USING (label)""")
def rolloff_profile(spark, sf_dir):
    """Median level towards the record's end, against a plateau."""
    out = analyses.rolloff_profile(_radar(spark, sf_dir), ["label"], 0.25, (5.0, 10.0), -0.2)
    return out.select("label", _r("before_end").alias("before_end"), _r("relative_dB").alias("relative_dB"), "in_rolloff")


@query("""SELECT n_nationkey, round(2 * (500 + n_nationkey * 10) / 299792458.0::DOUBLE * 1e6, 6) AS surface_us, round((2 * (500 + n_nationkey * 10) / 299792458.0::DOUBLE + 2 * 1.78 * (1000 + n_nationkey) / 299792458.0::DOUBLE) * 1e6, 6) AS bed_us,
round(CASE WHEN n_nationkey % 2 = 0 THEN 20.0 + n_nationkey - 39 ELSE 10.0 - n_nationkey END, 6) AS bed_dB, round(least((n_nationkey * 37.5) % 180, 180 - (n_nationkey * 37.5) % 180), 6) AS angle_deg FROM nation""")
def sounder_geometry(spark, sf_dir):
    """Travel times, gain levelling and crossing angles."""
    n = F.col("n_nationkey").cast("double")
    s, b = physics.sounder_times(n * 10 + 500, n + 1000)
    kind = F.when(F.col("n_nationkey") % 2 == 0, "HiCARS").otherwise("PASIN")
    _, bed = physics.levelled_gain(kind, F.lit(10.0) - n, n + 20.0)
    return _table(spark, sf_dir, "nation").select("n_nationkey", _r(physics.microseconds(s)).alias("surface_us"), _r(physics.microseconds(b)).alias("bed_us"), _r(bed).alias("bed_dB"), _r(physics.acute_angle(n * 37.5, F.lit(0.0))).alias("angle_deg"))


# ---- time axis ------------------------------------------------------------------------------------------------------


@query(f"""WITH RECURSIVE {EVENTS}, k AS (SELECT user_id, min(t) AS t FROM v GROUP BY user_id UNION ALL SELECT * FROM (SELECT user_id, (SELECT min(v.t) FROM v WHERE v.user_id = k.user_id AND v.t >= k.t + {10 * DAY}) AS t FROM k) WHERE t IS NOT NULL) SELECT user_id, t FROM k""")
def decimate_greedy(spark, sf_dir):
    """Traces at least ten days after the last kept one."""
    return time_axis.decimate(_traces(spark, sf_dir).select("user_id", "t"), ["user_id"], "t", 10 * DAY)


@query(f"""WITH {EVENTS}, j AS (SELECT v.event_id, p.pick, abs(p.t - v.t) AS d, row_number() OVER (PARTITION BY v.event_id ORDER BY abs(p.t - v.t), p.t DESC) AS n FROM v JOIN p USING (user_id))
SELECT v.event_id, v.user_id, v.t, CASE WHEN j.d <= {2 * DAY} THEN round(j.pick, 6) END AS near_pick, coalesce(j.d <= {2 * DAY} AND j.pick IS NOT NULL, false) AS available FROM v LEFT JOIN j ON v.event_id = j.event_id AND j.n = 1""")
def nearest_pick(spark, sf_dir):
    """As-of join: the nearest pick within two days, the later one at equal distance."""
    out = time_axis.nearest(_traces(spark, sf_dir), _picks(spark, sf_dir), ["user_id"], "t", ["pick"], 2 * DAY)
    return out.select("event_id", "user_id", "t", _r("near_pick").alias("near_pick"), F.col("near_pick").isNotNull().alias("available"))


@query(f"""WITH {EVENTS}, k AS (SELECT * FROM p WHERE pick IS NOT NULL), a AS (SELECT v.event_id, max(k.t) AS t FROM v JOIN k ON v.user_id = k.user_id AND k.t <= v.t GROUP BY ALL), b AS (SELECT v.event_id, min(k.t) AS t FROM v JOIN k ON v.user_id = k.user_id AND k.t >= v.t GROUP BY ALL)
SELECT v.event_id, round(CASE WHEN a.t = b.t THEN ka.pick ELSE ka.pick + (kb.pick - ka.pick) * ((v.t - a.t)::DOUBLE / (b.t - a.t)) END, 6) AS interpolated FROM v LEFT JOIN a USING (event_id) LEFT JOIN b USING (event_id)
LEFT JOIN k ka ON ka.user_id = v.user_id AND ka.t = a.t LEFT JOIN k kb ON kb.user_id = v.user_id AND kb.t = b.t""")
def interpolated_pick(spark, sf_dir):
    """Linear interpolation between known picks."""
    out = time_axis.interpolate(_traces(spark, sf_dir), _picks(spark, sf_dir), ["user_id"], "t", "pick")
    return out.select("event_id", _r("interpolated").alias("interpolated"))


@query(f"""WITH {EVENTS} SELECT user_id, min(t) FILTER (pick IS NOT NULL) AS first_pick, max(t) FILTER (pick IS NOT NULL) AS last_pick, round(avg((pick IS NOT NULL)::INT), 6) AS pick_fraction FROM p GROUP BY user_id""")
def picked_span(spark, sf_dir):
    out = time_axis.picked_span(_picks(spark, sf_dir), ["user_id"], "t", "pick")
    return out.select("user_id", "first_pick", "last_pick", _r("pick_fraction").alias("pick_fraction"))


@query(f"""WITH {EVENTS}, s AS (SELECT user_id, min(t) FILTER (pick IS NOT NULL) AS a, max(t) FILTER (pick IS NOT NULL) AS b FROM p GROUP BY user_id), j AS (SELECT v.event_id, p.pick, abs(p.t - v.t) AS d, row_number() OVER (PARTITION BY v.event_id ORDER BY abs(p.t - v.t), p.t DESC) AS n FROM v JOIN p USING (user_id)),
f AS (SELECT v.*, coalesce(j.d <= {2 * DAY} AND j.pick IS NOT NULL, false) AS available, s.a, s.b, v.value >= 50 AS surface FROM v LEFT JOIN j ON v.event_id = j.event_id AND j.n = 1 LEFT JOIN s USING (user_id))
SELECT event_id, coalesce(t BETWEEN a AND b, false) OR available AS attempted, surface AND (coalesce(t BETWEEN a AND b, false) OR available) AND NOT available AS censored FROM f""")
def censored_traces(spark, sf_dir):
    """Traces inside the picked span, on good surfaces, without a pick."""
    picks = _picks(spark, sf_dir)
    rows = time_axis.nearest(_traces(spark, sf_dir), picks, ["user_id"], "t", ["pick"], 2 * DAY).join(time_axis.picked_span(picks, ["user_id"], "t", "pick"), "user_id", "left")
    available = F.col("near_pick").isNotNull()
    attempted = F.coalesce(F.col("t").between(F.col("first_pick"), F.col("last_pick")), F.lit(False)) | available
    return rows.select("event_id", attempted.alias("attempted"), quality.censored(F.col("value") >= 50, attempted, available).alias("censored"))


@query("""WITH o AS (SELECT event_id, user_id, value, value >= 60 AS ok, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events), m AS (SELECT *, i - row_number() OVER (PARTITION BY user_id, ok ORDER BY i) AS island, lag(i) OVER (PARTITION BY user_id ORDER BY i) AS a, lead(i) OVER (PARTITION BY user_id ORDER BY i) AS b FROM o)
SELECT user_id, count(*) AS n_traces, min((coalesce(a, i) + i) / 2.0)::DOUBLE AS run_start, max((coalesce(b, i) + i) / 2.0)::DOUBLE AS run_end FROM m WHERE NOT ok GROUP BY user_id, island""")
def qc_fail_runs(spark, sf_dir):
    """Runs of failing traces, with edges midway to their neighbours."""
    from pyspark.sql import Window

    rows = _table(spark, sf_dir, "events").withColumn("i", F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))).withColumn("ok", F.col("value") >= 60)
    return time_axis.fail_runs(rows, "ok", "i", ["user_id"], ["i"])


@query(f"""WITH {PLANE}, s AS (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py, lead(x) OVER w AS nx, lead(y) OVER w AS ny FROM g WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey))
SELECT o_orderkey, round(sum(coalesce(sqrt((x - px) * (x - px) + (y - py) * (y - py)), 0)) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) / 1000, 5) AS along_track_km, round(degrees(atan2(coalesce(nx, x) - coalesce(px, x), coalesce(ny, y) - coalesce(py, y))), 6) AS bearing_deg FROM s""")
def along_track(spark, sf_dir):
    """Distance flown and bearing of each trace."""
    rows = time_axis.with_along_track(_plane(spark, sf_dir), "x", "y", ["o_custkey"], ["o_orderkey"])
    rows = rows.withColumn("b", time_axis.bearing("x", "y", ["o_custkey"], ["o_orderkey"]))
    return rows.select("o_orderkey", _r("along_track_km", 5).alias("along_track_km"), _r("b").alias("bearing_deg"))


# ---- quality --------------------------------------------------------------------------------------------------------


@query("""WITH q AS (SELECT event_id, user_id, value, coalesce(value * 1e-6 * 299792458.0::DOUBLE / 2 >= 5000, false) AS agl, coalesce((value + 10 - value) * 1e-6 * 299792458.0::DOUBLE / sqrt(3.17) / 2 * (event_id % 3) >= 800, false) AS thick FROM events),
f AS (SELECT *, sum(agl::INT) OVER (PARTITION BY user_id) AS n FROM q)
SELECT event_id, agl AS qc_surface_pass, agl AND thick AS qc_pass, CASE WHEN agl THEN value END AS surface_value, CASE WHEN agl AND thick THEN value END AS bed_value FROM f WHERE n >= 40""")
def qc_masks(spark, sf_dir):
    """Split masks, and frames with too few passing traces left out."""
    rows = _table(spark, sf_dir, "events").select("event_id", "user_id", "value", (F.col("value") * 1e-6).alias("surface_pick"), (F.col("value") * 1e-6 + 10e-6 * (F.col("event_id") % 3)).alias("bed_pick"))
    checks = quality.enabled({"minimum_agl": 5000.0, "ice_thickness_threshold": 800.0, "heading_change": None})
    rows = quality.enough_traces(rows.withColumns(quality.flags(checks)), ["user_id"], 40)
    rows = quality.mask(rows.withColumns({"surface_value": F.col("value"), "bed_value": F.col("value")}), ["surface_value"], ["bed_value"])
    return rows.select("event_id", "qc_surface_pass", "qc_pass", "surface_value", "bed_value")


@query("""WITH e AS (SELECT event_type, CASE WHEN event_id % 5 <> 0 THEN value END AS a, CASE WHEN event_id % 11 <> 0 THEN value * 2 END AS b FROM events), l AS (SELECT event_type, 'a' AS variable, a AS x FROM e UNION ALL SELECT event_type, 'b', b FROM e)
SELECT event_type, variable, count(*) AS n, round(avg((x IS NULL)::INT), 6) AS missing_rate, min(x) AS min, round(median(x), 6) AS median, max(x) AS max FROM l GROUP BY ALL""")
def missing_rates(spark, sf_dir):
    rows = _table(spark, sf_dir, "events").select("event_type", F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("a"), F.when(F.col("event_id") % 11 != 0, F.col("value") * 2).alias("b"))
    return dist.missing_rates(rows, ["a", "b"], ["event_type"]).withColumns({"missing_rate": _r("missing_rate"), "median": _r("median")})


@query("""SELECT count(*) AS total, count(CASE WHEN event_id % 5 <> 0 THEN value END) AS valid, count(*) FILTER (value >= 50 AND event_id % 2 = 0 AND event_id % 3 <> 0) AS censored FROM events""")
def status_counts(spark, sf_dir):
    rows = _table(spark, sf_dir, "events").select(F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("m"), (F.col("value") >= 50).alias("qc_surface_pass"), (F.col("event_id") % 2 == 0).alias("bed_pick_attempted"), (F.col("event_id") % 3 == 0).alias("bed_pick_available"))
    return analyses.status_counts(rows, "m")


# ---- frames ---------------------------------------------------------------------------------------------------------


@query("SELECT c_custkey AS frame_id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)")
def new_frames(spark, sf_dir):
    """Catalogue frames that are not processed."""
    listed = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("frame_id"))
    return frame_ops.not_in(listed, _table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("frame_id")))


@query("SELECT DISTINCT o_custkey AS frame_id FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def orphan_frames(spark, sf_dir):
    """Processed frames that the catalogue no longer lists."""
    done = _table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("frame_id")).distinct()
    return frame_ops.not_in(done, _table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("frame_id")))


@query("SELECT o_custkey AS frame_id, count(*) AS n FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) GROUP BY o_custkey")
def remove_frames(spark, sf_dir):
    """Rows left after frames are removed."""
    rows = _table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("frame_id"))
    return frame_ops.not_in(rows, _table(spark, sf_dir, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("frame_id"))).groupBy("frame_id").agg(F.count("*").alias("n"))


@query("SELECT user_id AS frame_id, (row_number() OVER (ORDER BY first_type, user_id) - 1)::INT AS frame_index FROM (SELECT user_id, min(event_type) AS first_type FROM events GROUP BY user_id)")
def frame_index(spark, sf_dir):
    rows = _table(spark, sf_dir, "events").select(F.col("user_id").alias("frame_id"), F.col("event_type").alias("collection"))
    return frame_ops.frame_index(rows)


@query("""WITH c AS (SELECT DISTINCT user_id AS f FROM events), o AS (SELECT c_custkey AS f, c_mktsegment AS s FROM customer WHERE c_custkey % 2 = 0), n AS (SELECT c_custkey AS f, 'new' AS s FROM customer WHERE c_custkey % 3 = 0)
SELECT c.f AS frame_id, coalesce(n.s, o.s, '') AS collection FROM c LEFT JOIN o USING (f) LEFT JOIN n USING (f)""")
def merge_attributes(spark, sf_dir):
    """Attributes of frames: new ones over old ones over a default."""
    current = _table(spark, sf_dir, "events").select(F.col("user_id").alias("frame_id"))
    known = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("frame_id"), F.col("c_mktsegment").alias("collection"))
    return frame_ops.merge_attributes(current, known.where("frame_id % 2 = 0"), known.where("frame_id % 3 = 0").withColumn("collection", F.lit("new")), {"collection": ""})


@query("SELECT o_custkey AS frame_id, min(year(o_orderdate) * 12 + month(o_orderdate))::INT AS first_sequence, strftime(min(date_trunc('month', o_orderdate)), '%Y-%m-%d') AS first_written_at FROM orders GROUP BY o_custkey")
def first_seen(spark, sf_dir):
    """The snapshot in which each frame appeared."""
    rows = _table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("frame_id"), (F.year("o_orderdate") * 12 + F.month("o_orderdate")).alias("sequence"), F.date_format(F.date_trunc("month", "o_orderdate"), "yyyy-MM-dd").alias("written_at"))
    return frame_ops.first_seen(rows)


@query("""WITH d AS (SELECT o_custkey, min(o_orderdate) AS w FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey)
SELECT c_mktsegment AS collection, count(*) AS n_frames, count(d.o_custkey) AS n_processed, max(d.w) AS last_processed FROM customer LEFT JOIN d ON c_custkey = d.o_custkey GROUP BY c_mktsegment""")
def collection_status(spark, sf_dir):
    frames = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("frame_id"), F.col("c_mktsegment").alias("collection"))
    done = _table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("frame_id"), "o_orderdate")
    seen = done.groupBy("frame_id").agg(F.min("o_orderdate").alias("first_written_at"))
    return frame_ops.collection_status(frames, done, seen)


@query("""WITH p AS (SELECT l_suppkey AS s, l_returnflag AS k, l_orderkey AS o FROM lineitem), r AS (SELECT *, CASE k WHEN 'N' THEN 0 WHEN 'R' THEN 1 END AS n FROM p)
SELECT s AS segment_id, k AS layer_key, count(*) AS n_picks FROM (SELECT *, min(n) OVER (PARTITION BY s) AS b FROM r WHERE n IS NOT NULL) WHERE n = b GROUP BY ALL""")
def layer_fallback(spark, sf_dir):
    """The preferred layer of each segment, else the next."""
    rows = _table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("segment_id"), F.col("l_returnflag").alias("layer_key"))
    return frame_ops.layer_by_priority(rows, ["segment_id"], ["N", "R"]).groupBy("segment_id", "layer_key").agg(F.count("*").alias("n_picks"))


@query("""WITH g AS (SELECT n_name AS name, CASE WHEN n_nationkey % 3 = 0 THEN 'GR' ELSE 'FL' END AS type, CASE WHEN n_nationkey % 3 = 0 THEN (SELECT string_agg(m.n_name, '/ ' ORDER BY m.n_name) FROM nation m WHERE m.n_regionkey = n.n_regionkey AND m.n_nationkey > n.n_nationkey) END AS a, n_regionkey AS r FROM nation n),
c AS (SELECT * FROM g WHERE r = 1 AND type = 'GR'), s AS (SELECT DISTINCT trim(unnest(string_split(a, '/'))) AS x FROM c)
SELECT name, type FROM c UNION SELECT name, type FROM g WHERE type = 'FL' AND name IN (SELECT x FROM s)""")
def region_shelves(spark, sf_dir):
    """Chosen regions and the shelves they name."""
    n = _table(spark, sf_dir, "nation")
    later = n.select(F.col("n_regionkey").alias("r2"), F.col("n_nationkey").alias("k2"), F.col("n_name").alias("m"))
    named = n.join(later, (F.col("n_regionkey") == F.col("r2")) & (F.col("k2") > F.col("n_nationkey")), "left").groupBy("n_nationkey", "n_name", "n_regionkey").agg(F.array_join(F.array_sort(F.collect_list("m")), "/ ").alias("list"))
    ground = F.col("n_nationkey") % 3 == 0
    regions = named.select(F.col("n_name").alias("name"), F.when(ground, "GR").otherwise("FL").alias("type"), F.when(ground, F.col("list")).alias("asso_shelf"), F.col("n_regionkey").alias("r"))
    return frame_ops.with_shelves(regions, (F.col("r") == 1) & (F.col("type") == "GR")).select("name", "type")


# ---- geometry and matching ------------------------------------------------------------------------------------------


_E = geo.ECCENTRICITY
_PROJECT = f"""WITH {POINTS}, a AS (SELECT *, radians(-latitude) AS phi, {_E!r}::DOUBLE AS e FROM g), b AS (SELECT *, tan(pi() / 4 - phi / 2) / pow((1 - e * sin(phi)) / (1 + e * sin(phi)), e / 2) * {geo.ANTARCTIC.factor!r}::DOUBLE AS rho FROM a), j AS (SELECT *, rho * sin(radians(longitude)) AS x, rho * cos(radians(longitude)) AS y FROM b)"""


@query(_PROJECT + "SELECT o_orderkey, round(x, 3) AS x, round(y, 3) AS y FROM j")
def polar_projection(spark, sf_dir):
    rows = analyses.projected(_points(spark, sf_dir), geo.ANTARCTIC)
    return rows.select("o_orderkey", _r("x", 3).alias("x"), _r("y", 3).alias("y"))


@query(f"WITH {POINTS} SELECT o_orderkey, round(latitude, 7) AS latitude, round(longitude, 7) AS longitude FROM g WHERE abs(longitude) < 179.9")
def polar_round_trip(spark, sf_dir):
    """Projected and back: the oracle is the input."""
    rows = analyses.projected(_points(spark, sf_dir).where("abs(longitude) < 179.9"), geo.ANTARCTIC)
    lat, lon = geo.unproject(F.col("x"), F.col("y"), geo.ANTARCTIC)
    return rows.select("o_orderkey", _r(lat, 7).alias("latitude"), _r(lon, 7).alias("longitude"))


RING = [(2000.0, 1500.0), (17500.0, 3300.0), (12000.0, 9000.0), (18800.0, 18100.0), (6100.0, 15500.0), (7777.0, 8000.0)]
_EDGES = ", ".join(f"({a[0]!r}, {a[1]!r}, {b[0]!r}, {b[1]!r})" for a, b in zip(RING, [*RING[1:], RING[0]]))
_INSIDE = f"""WITH {PLANE}, e(xa, ya, xb, yb) AS (VALUES {_EDGES}), c AS (SELECT o_orderkey, count(*) FILTER ((ya > y) <> (yb > y) AND x < (xb - xa) * (y - ya) / (yb - ya) + xa) % 2 = 1 AS inside FROM g, e GROUP BY o_orderkey)"""


@query(_INSIDE + " SELECT o_orderkey FROM c WHERE inside")
def point_in_polygon(spark, sf_dir):
    return _plane(spark, sf_dir).where(geo.in_polygon(F.col("x"), F.col("y"), RING)).select("o_orderkey")


_OTHER = "o AS (SELECT p_partkey, (p_partkey * 6151 % 20011)::DOUBLE AS px, (p_partkey * 50053 % 20021)::DOUBLE AS py, p_retailprice FROM part)"
_NEAR = f"""WITH {PLANE}, {_OTHER}, c AS (SELECT o_orderkey, o_custkey, p_partkey, sqrt((x - px) * (x - px) + (y - py) * (y - py)) AS d FROM g, o WHERE abs(x - px) < 150 AND abs(y - py) < 150), n AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY d, p_partkey) AS k FROM c WHERE d < 150), m AS (SELECT * FROM n WHERE k = 1)"""


def _other(spark, sf_dir):
    return _table(spark, sf_dir, "part").select("p_partkey", (F.col("p_partkey") * 6151 % 20011).cast("double").alias("px"), (F.col("p_partkey") * 50053 % 20021).cast("double").alias("py"))


@query(_NEAR + "SELECT o_orderkey, p_partkey, round(d, 6) AS distance_m FROM m")
def nearest_within(spark, sf_dir):
    """Each point's nearest partner closer than 150 m."""
    out = matching.nearest_within(_plane(spark, sf_dir), _other(spark, sf_dir), 150.0, "o_orderkey", "p_partkey", ("x", "y"), ("px", "py"))
    return out.select("o_orderkey", "p_partkey", _r("distance_m").alias("distance_m"))


@query(_NEAR + "SELECT o_orderkey, p_partkey, round(d, 6) AS distance_m FROM (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY d, o_orderkey) AS i FROM m) WHERE i = 1")
def one_to_one_match(spark, sf_dir):
    out = matching.one_to_one(_plane(spark, sf_dir), _other(spark, sf_dir), 150.0, "o_orderkey", "p_partkey", ("x", "y"), ("px", "py"))
    return out.select("o_orderkey", "p_partkey", _r("distance_m").alias("distance_m"))


@query(_NEAR + "SELECT o_custkey, o_orderkey, p_partkey, round(d, 6) AS distance_m FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY d, o_orderkey) AS i FROM m) WHERE i = 1")
def closest_per_group(spark, sf_dir):
    """The closest match of each track."""
    near = matching.nearest_within(_plane(spark, sf_dir), _other(spark, sf_dir), 150.0, "o_orderkey", "p_partkey", ("x", "y"), ("px", "py"))
    return matching.closest_per_group(near, ["o_custkey"], ["o_orderkey"]).select("o_custkey", "o_orderkey", "p_partkey", _r("distance_m").alias("distance_m"))


@query(_NEAR + "SELECT g.o_orderkey, m.o_orderkey IS NOT NULL AS matched FROM g LEFT JOIN m USING (o_orderkey)")
def matched_flags(spark, sf_dir):
    near = matching.nearest_within(_plane(spark, sf_dir), _other(spark, sf_dir), 150.0, "o_orderkey", "p_partkey", ("x", "y"), ("px", "py"))
    return matching.matched_flags(_plane(spark, sf_dir), near, "o_orderkey").select("o_orderkey", "matched")


@query(f"""WITH {PLANE}, q AS (SELECT c_custkey, (c_custkey * 31 % 20011)::DOUBLE AS qx, (c_custkey * 17 % 20021)::DOUBLE AS qy FROM customer), c AS (SELECT c_custkey, o_orderkey, sqrt((x - qx) * (x - qx) + (y - qy) * (y - qy)) AS d FROM q JOIN g ON c_custkey = o_custkey)
SELECT c_custkey, o_orderkey, round(d, 6) AS distance_m FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY d, o_orderkey) AS n FROM c) WHERE n = 1""")
def nearest_in_track(spark, sf_dir):
    """A point's nearest trace of its own frame."""
    points = _table(spark, sf_dir, "customer").select("c_custkey", F.col("c_custkey").alias("frame"), (F.col("c_custkey") * 31 % 20011).cast("double").alias("qx"), (F.col("c_custkey") * 17 % 20021).cast("double").alias("qy"))
    traces = _plane(spark, sf_dir).select(F.col("o_custkey").alias("frame"), "o_orderkey", "x", "y")
    out = matching.nearest_in_group(points, traces, "frame", "c_custkey", "o_orderkey", ("qx", "qy"), ("x", "y"))
    return out.select("c_custkey", "o_orderkey", _r("distance_m").alias("distance_m"))


_SEGMENTS = ", ".join(f"({a[0]!r}, {a[1]!r}, {b[0]!r}, {b[1]!r})" for a, b in zip(RING, [*RING[1:], RING[0]]))


@query(f"""{_INSIDE}, s AS (SELECT o_orderkey, x, y, xa, ya, xb - xa AS dx, yb - ya AS dy, least(1, greatest(0, ((x - xa) * (xb - xa) + (y - ya) * (yb - ya)) / ((xb - xa) * (xb - xa) + (yb - ya) * (yb - ya)))) AS u FROM g, e),
d AS (SELECT o_orderkey, min(sqrt((x - (xa + u * dx)) * (x - (xa + u * dx)) + (y - (ya + u * dy)) * (y - (ya + u * dy)))) AS d FROM s GROUP BY o_orderkey)
SELECT o_orderkey, round(CASE WHEN d <= 2000 THEN CASE WHEN inside THEN d ELSE -d END END, 5) AS signed_distance_m FROM c JOIN d USING (o_orderkey)""")
def signed_distance(spark, sf_dir):
    """Distance to a boundary, positive inside."""
    points = _plane(spark, sf_dir).select(F.col("o_orderkey").alias("point_id"), "x", "y").withColumn("inside", geo.in_polygon(F.col("x"), F.col("y"), RING))
    boundary = spark.createDataFrame([(*a, *b) for a, b in zip(RING, [*RING[1:], RING[0]])], "x0 double, y0 double, x1 double, y1 double")
    out = analyses.grounding_distance(points, boundary, "inside", 2000.0)
    return out.select(F.col("point_id").alias("o_orderkey"), _r("signed_distance_m", 5).alias("signed_distance_m"))


#: Side of the square that tracks begin in, and the distance of a track's traces.
_SQUARE, _SPACING = 200_003, 100.0


def _tracks(spark, sf_dir):
    """Every line is a trace; a supplier's are a straight track, begun somewhere in the square."""
    s, o, n = F.col("l_suppkey"), F.col("l_orderkey"), F.col("l_linenumber")
    place = F.row_number().over(Window.partitionBy(s).orderBy(o, n, "l_quantity"))  # an order may have a line twice
    along = place * _SPACING
    x = s * 48271 % _SQUARE + along * F.cos(F.radians(s * 37 % 360))
    y = s * 69621 % _SQUARE + along * F.sin(F.radians(s * 37 % 360))
    return _table(spark, sf_dir, "lineitem").select(s.alias("frame_id"), place.alias("slow_time"), x.alias("x"), y.alias("y"), F.col("l_quantity").alias("v"))


@query(f"""WITH t AS (SELECT l_suppkey AS f, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_quantity) AS i, l_quantity AS v FROM lineitem),
p AS (SELECT *, f * 48271 % {_SQUARE} + i * {_SPACING}::DOUBLE * cos(radians(f * 37 % 360)) AS x, f * 69621 % {_SQUARE} + i * {_SPACING}::DOUBLE * sin(radians(f * 37 % 360)) AS y FROM t), c AS (SELECT *, floor(x / 100)::BIGINT AS cx, floor(y / 100)::BIGINT AS cy FROM p),
n AS (SELECT f, i, v, x, y, cx + dx AS cx, cy + dy AS cy FROM c, range(-1, 2) a(dx), range(-1, 2) b(dy)), m AS (SELECT a.f AS fa, b.f AS fb, a.i AS ia, b.i AS ib, a.x AS xa, b.x AS xb, a.y AS ya, b.y AS yb, a.v AS va, b.v AS vb, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d, abs(a.f * 37 % 360 - b.f * 37 % 360) % 180 AS g FROM c a JOIN n b USING (cx, cy) WHERE a.f < b.f)
SELECT fa AS frame_a, fb AS frame_b, round(d, 6) AS distance_m, round(least(g, 180 - g)::DOUBLE, 4) AS angle_deg, round((xa + xb) / 2, 3) AS x_proj, round((ya + yb) / 2, 3) AS y_proj, va AS v_a, vb AS v_b, va - vb AS v_diff FROM m WHERE d <= 100 AND least(g, 180 - g) >= 20.5 QUALIFY row_number() OVER (PARTITION BY fa, fb ORDER BY d, ia, ib) = 1""")
def crossovers(spark, sf_dir):
    """Places where tracks meet, with differences. Directions are whole degrees, so the least angle lies between two."""
    out = cross.find_crossovers(_tracks(spark, sf_dir), 100.0, ["v"], min_angle=20.5)
    return out.select("frame_a", "frame_b", _r("distance_m").alias("distance_m"), _r("angle_deg", 4).alias("angle_deg"), _r("x_proj", 3).alias("x_proj"), _r("y_proj", 3).alias("y_proj"), "v_a", "v_b", "v_diff")


@query("""WITH s AS (SELECT s_suppkey AS f, CASE WHEN s_nationkey % 2 = 0 THEN 'even' ELSE 'odd' END AS c FROM supplier), p AS (SELECT DISTINCT a.l_suppkey AS fa, b.l_suppkey AS fb FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_suppkey < b.l_suppkey)
SELECT fa AS frame_a, fb AS frame_b, x.c AS collection_a, y.c AS collection_b FROM p JOIN s x ON fa = x.f JOIN s y ON fb = y.f WHERE (x.c = 'even') <> (y.c = 'even')""")
def across_seasons(spark, sf_dir):
    """Pairs of frames with exactly one side in a season."""
    li = _table(spark, sf_dir, "lineitem")
    n = parts_of(li)
    a, b = (li.select("l_orderkey", F.col("l_suppkey").alias(c)).repartition(n, "l_orderkey") for c in ("frame_a", "frame_b"))
    # pairs are dealt before they are told apart: nearly all of them differ, so there is little to do ahead of it
    pairs = a.join(b.hint("merge"), "l_orderkey").where("frame_a < frame_b").select("frame_a", "frame_b").repartition(2 * n, "frame_a", "frame_b").distinct()
    frames = _table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("frame_id"), F.when(F.col("s_nationkey") % 2 == 0, "even").otherwise("odd").alias("collection"))
    return cross.across_seasons(cross.with_collections(pairs, frames), "even")


# ---- distributions --------------------------------------------------------------------------------------------------


_DIFF = "SELECT l_shipdate, l_returnflag AS instrument, l_quantity AS a, l_extendedprice / 1000 AS b, l_quantity - l_extendedprice / 1000 AS d FROM lineitem"


def _differences(spark, sf_dir):
    q, p = F.col("l_quantity"), F.col("l_extendedprice") / 1000
    return _table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("instrument"), q.alias("v_a"), p.alias("v_b"), (q - p).alias("v_diff"), "l_suppkey", "l_orderkey", "l_linenumber")


_STATS = "count(*) AS n, round(avg(d), 4) AS mean_diff, round(stddev_pop(d), 4) AS std_diff, round(sqrt(avg(d * d)), 4) AS rms_diff, round(median(abs(d)), 4) AS median_abs_diff"


@query(f"SELECT 'v' AS variable, {_STATS} FROM ({_DIFF})")
def difference_summary(spark, sf_dir):
    out = dist.difference_summary(_differences(spark, sf_dir), ["v"])
    return out.select("variable", "n", *[_r(c, 4).alias(c) for c in ("mean_diff", "std_diff", "rms_diff", "median_abs_diff")])


@query(f"SELECT instrument AS \"group\", {_STATS} FROM ({_DIFF}) GROUP BY instrument UNION ALL SELECT 'all', {_STATS} FROM ({_DIFF})")
def summary_with_total(spark, sf_dir):
    """The summary per instrument, and over all."""
    out = dist.summary_with_total(_differences(spark, sf_dir), "instrument", "v_diff")
    return out.select("group", "n", *[_r(c, 4).alias(c) for c in ("mean_diff", "std_diff", "rms_diff", "median_abs_diff")])


@query(f"SELECT (d > 8)::INT AS label, count(*) AS n, round(avg(d), 4) AS mean, round(sqrt(avg(d * d)), 4) AS rms FROM ({_DIFF}) GROUP BY 1")
def split_at_threshold(spark, sf_dir):
    rows = _differences(spark, sf_dir).withColumn("label", dist.label_above("v_diff"))
    return rows.groupBy("label").agg(F.count("*").alias("n"), _r(F.avg("v_diff"), 4).alias("mean"), _r(physics.rms(F.col("v_diff")), 4).alias("rms"))


@query("""SELECT event_type, count(*) AS n, round(avg(value), 4) AS mean, round(stddev_pop(value), 4) AS std_pop, round(stddev_samp(value), 4) AS std_samp, round(quantile_cont(value, 0.05), 6) AS p5, round(median(value), 6) AS median, round(quantile_cont(value, 0.95), 6) AS p95, min(value) AS min, max(value) AS max FROM events GROUP BY event_type""")
def spread_statistics(spark, sf_dir):
    out = dist.spread_statistics(_table(spark, sf_dir, "events"), "value", ["event_type"]).drop("rms")
    return out.withColumns({c: _r(c, 4) for c in ("mean", "std_pop", "std_samp")} | {c: _r(c) for c in ("p5", "median", "p95")})


@query("SELECT event_type, count(*) AS n, count(DISTINCT value) AS n_unique, count(*) FILTER (value = 0) AS n_zero, min(value) AS min, max(value) AS max, round(quantile_cont(value, 0.01), 6) AS p1, round(median(value), 6) AS median, round(quantile_cont(value, 0.99), 6) AS p99 FROM events GROUP BY event_type")
def population_diagnostics(spark, sf_dir):
    out = dist.population_diagnostics(_table(spark, sf_dir, "events"), "value", ["event_type"])
    return out.select("event_type", "n", "n_unique", "n_zero", "min", "max", *[_r(c).alias(c) for c in ("p1", "median", "p99")])


@query("SELECT round(quantile_cont(value, 0.02), 6) AS low, round(quantile_cont(value, 0.98), 6) AS high FROM events")
def percentile_limits(spark, sf_dir):
    return _table(spark, sf_dir, "events").agg(*dist.percentile_limits("value")).select(_r("low").alias("low"), _r("high").alias("high"))


@query("WITH o AS (SELECT event_type, list_sort(list(value)) AS v FROM events GROUP BY event_type) SELECT event_type, v[floor(len(v) * 0.02)::INT + 1] AS low, v[floor(len(v) * 0.98)::INT + 1] AS high FROM o")
def floor_limits(spark, sf_dir):
    """Limits at ranks, without interpolation."""
    return dist.floor_limits(_table(spark, sf_dir, "events"), "value", ["event_type"])


@query("WITH b AS (SELECT event_type, least(floor(value / 5), 19)::INT AS bin FROM events WHERE value BETWEEN 0 AND 100) SELECT t.event_type, i::INT AS bin, count(b.bin) AS count, i * 5.0::DOUBLE AS bin_low, (i + 1) * 5.0::DOUBLE AS bin_high FROM (SELECT DISTINCT event_type FROM events) t CROSS JOIN generate_series(0, 19) s(i) LEFT JOIN b ON b.event_type = t.event_type AND b.bin = i GROUP BY ALL")
def histogram_fixed(spark, sf_dir):
    return dist.histogram(_table(spark, sf_dir, "events"), "value", 0.0, 100.0, 20, ["event_type"])


@query("""WITH s AS (SELECT count(*) AS n, min(value) AS a, max(value) AS b, quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iqr FROM events), k AS (SELECT a, b, ceil((b - a) / least((b - a) / (log2(n) + 1), 2 * iqr / pow(n, 1 / 3.0)))::INT AS m FROM s),
h AS (SELECT least(floor((value - a) / ((b - a) / m)), m - 1)::INT AS bin FROM events, k) SELECT i::INT AS bin, count(h.bin) AS count FROM k CROSS JOIN generate_series(0, 1000) s(i) LEFT JOIN h ON h.bin = i WHERE i < m GROUP BY i""")
def histogram_auto(spark, sf_dir):
    """Bins by the larger of Sturges' and Freedman and Diaconis' counts."""
    return dist.auto_histogram(_table(spark, sf_dir, "events"), "value").select("bin", "count")


_KDE = """WITH e AS (SELECT event_type AS season, value AS v FROM events), o AS (SELECT list_sort(list(v)) AS l, count(*) AS total FROM e), k AS (SELECT l[floor(len(l) * 0.02)::INT + 1] AS a, l[floor(len(l) * 0.98)::INT + 1] AS b, total FROM o),
r AS (SELECT * FROM e UNION ALL SELECT 'All', v FROM e), s AS (SELECT season, count(*) AS n, 1.06 * stddev_samp(v) * pow(count(*), -0.2) AS bw FROM r GROUP BY season), g AS (SELECT i, a + i * (b - a) / 31 AS x FROM k, generate_series(0, 31) t(i)),
d AS (SELECT season, i, x, sum(exp(-0.5 * pow((x - v) / bw, 2))) / (any_value(n) * any_value(bw) * sqrt(2 * pi())) AS raw, any_value(n) AS n FROM r JOIN s USING (season) CROSS JOIN g GROUP BY season, i, x),
t AS (SELECT *, (raw + lag(raw) OVER w) / 2 * (x - lag(x) OVER w) AS strip FROM d WINDOW w AS (PARTITION BY season ORDER BY i)), z AS (SELECT season, sum(strip) AS area FROM t GROUP BY season)
SELECT season, round(x, 6) AS x, round(raw / area * CASE WHEN season = 'All' THEN 1 ELSE n / total::DOUBLE END, 8) AS density FROM t JOIN z USING (season), k"""


@query(_KDE)
def density_by_season(spark, sf_dir):
    """Kernel densities on a grid, per season and pooled."""
    out = dist.density(_table(spark, sf_dir, "events"), "value", "event_type", 32)
    return out.select("season", _r("x").alias("x"), _r("density", 8).alias("density"))


@query("""WITH f AS (SELECT l_returnflag AS flag, l_quantity AS x, l_extendedprice AS y FROM lineitem), k AS (SELECT *, rank() OVER (PARTITION BY flag ORDER BY x) + (count(*) OVER (PARTITION BY flag, x) - 1) / 2.0 AS rx, rank() OVER (PARTITION BY flag ORDER BY y) + (count(*) OVER (PARTITION BY flag, y) - 1) / 2.0 AS ry FROM f)
SELECT flag, count(*) AS n, round(corr(x, y), 6) AS pearson, round(corr(rx, ry), 6) AS spearman FROM k GROUP BY flag""")
def correlations(spark, sf_dir):
    rows = _table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("flag"), F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"))
    return dist.correlations(rows, "x", "y", ["flag"]).withColumns({"pearson": _r("pearson"), "spearman": _r("spearman")})


@query("SELECT o_custkey, count(*) AS count FROM orders GROUP BY o_custkey ORDER BY count DESC, o_custkey LIMIT 20")
def top_counts(spark, sf_dir):
    """The twenty most matched frames."""
    return dist.top_counts(_table(spark, sf_dir, "orders"), "o_custkey", 20)


@query("""WITH k AS (SELECT l_quantity AS s, (l_returnflag = 'R')::INT AS y FROM lineitem), r AS (SELECT *, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS r FROM k)
SELECT count(*) FILTER (y = 1) AS n_positive, count(*) FILTER (y = 0) AS n_negative, round((sum(r) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2.0) / (count(*) FILTER (y = 1) * count(*) FILTER (y = 0)), 6) AS auc FROM r""")
def separation(spark, sf_dir):
    rows = _table(spark, sf_dir, "lineitem").select(F.col("l_quantity").alias("s"), (F.col("l_returnflag") == "R").cast("int").alias("y"))
    return dist.separation(rows, "s", "y").withColumn("auc", _r("auc"))


@query("SELECT ((l_quantity >= 6)::INT + (l_quantity >= 15)::INT) AS bin, count(*) AS n, round(median(l_extendedprice), 4) AS median FROM lineitem GROUP BY 1")
def binned_medians(spark, sf_dir):
    return dist.binned(_table(spark, sf_dir, "lineitem"), "l_quantity", [6.0, 15.0], "l_extendedprice").withColumn("median", _r("median", 4))


@query(f"WITH {PLANE} SELECT floor(x / 5000)::BIGINT AS cell_x, floor(y / 5000)::BIGINT AS cell_y, count(*) AS n, round(avg((o_totalprice > 150000)::INT), 6) AS flagged, avg((o_totalprice > 150000)::INT) > 0.8 OR avg((o_totalprice > 150000)::INT) < 0.2 AS one_mode FROM g GROUP BY 1, 2")
def cell_modes(spark, sf_dir):
    """Grid cells held by one mode."""
    return dist.cell_modes(_plane(spark, sf_dir), "x", "y", F.col("o_totalprice") > 150000, 5000.0, 0.8).withColumn("flagged", _r("flagged"))


@query(f"""{_INSIDE} SELECT season, count(*) AS n, round(median(o_totalprice), 4) AS median FROM g JOIN c USING (o_orderkey) WHERE inside AND o_totalprice > 50000 GROUP BY season""")
def region_by_season(spark, sf_dir):
    """Values inside a polygon that pass a mask, by season."""
    rows = _plane(spark, sf_dir).where(geo.in_polygon(F.col("x"), F.col("y"), RING)).where("o_totalprice > 50000")
    return rows.groupBy("season").agg(F.count("*").alias("n"), _r(F.expr("percentile(o_totalprice, 0.5D)"), 4).alias("median"))


@query(f"WITH {POINTS} SELECT round(min(longitude) - (max(longitude) - min(longitude)) * 0.05, 6) AS min_longitude, round(max(longitude) + (max(longitude) - min(longitude)) * 0.05, 6) AS max_longitude, round(min(latitude) - (max(latitude) - min(latitude)) * 0.05, 6) AS min_latitude, round(max(latitude) + (max(latitude) - min(latitude)) * 0.05, 6) AS max_latitude FROM g")
def extent(spark, sf_dir):
    return analyses.extent(_points(spark, sf_dir)).select(*[_r(c).alias(c) for c in ("min_longitude", "max_longitude", "min_latitude", "max_latitude")])


# ---- samples and values ---------------------------------------------------------------------------------------------


@query("WITH o AS (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS i, count(*) OVER () AS n FROM events) SELECT event_id FROM o WHERE n <= 700 OR i IN (SELECT floor(j * (SELECT count(*) FROM events) / 700.0)::BIGINT FROM generate_series(0, 699) s(j))")
def stride_sample(spark, sf_dir):
    """700 rows at even strides (a sampling operator)."""
    return sampling.stride(_table(spark, sf_dir, "events").select("event_id"), 700, ["event_id"])


@query("SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS n FROM events) WHERE n % 5 = 0 AND n < 15")
def every_kth(spark, sf_dir):
    """Each frame's rows 0, 5 and 10 (a sampling operator)."""
    return sampling.every_kth(_table(spark, sf_dir, "events"), ["user_id"], ["event_id"], 5, 3).select("user_id", "event_id")


@query("SELECT c_custkey, CASE WHEN regexp_extract(c_name, '(\\d{4})', 1) = '' THEN 0 ELSE regexp_extract(c_name, '(\\d{4})', 1)::INT END AS year, CASE WHEN c_name LIKE 'b%' THEN 'PASIN' ELSE 'HiCARS' END AS instrument FROM customer")
def names_to_values(spark, sf_dir):
    """Years and instruments from names."""
    return _table(spark, sf_dir, "customer").select("c_custkey", values.year_of(F.col("c_name")).alias("year"), values.instrument_of(F.col("c_name")).alias("instrument"))


@query("SELECT n_nationkey, round(least(1, greatest(0, (n_nationkey - 2.0) / 18.0)), 6) AS fraction, round(CASE WHEN n_nationkey > 0 THEN least(1, greatest(0, ln(n_nationkey) / ln(20))) END, 6) AS log_fraction FROM nation")
def colour_fractions(spark, sf_dir):
    n = F.col("n_nationkey").cast("double")
    return _table(spark, sf_dir, "nation").select("n_nationkey", _r(physics.colour_fraction(n, 2.0, 20.0)).alias("fraction"), _r(physics.log_fraction(n, 1.0, 20.0)).alias("log_fraction"))


# ---- reports --------------------------------------------------------------------------------------------------------


@query("""WITH f AS (SELECT c_custkey, c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS n FROM customer), s AS (SELECT o_custkey, avg((o_orderkey % 3 <> 0)::INT) AS b FROM orders GROUP BY o_custkey)
SELECT c_mktsegment AS collection, count(*) AS n_probed, count(b) AS n_eligible, round(avg(b), 6) AS bed_share FROM f LEFT JOIN s ON c_custkey = o_custkey WHERE n <= 20 GROUP BY c_mktsegment""")
def eligibility(spark, sf_dir):
    """The first frames of each collection: how many gave rows, and with what share of beds."""
    frames = _table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("frame_id"), F.col("c_mktsegment").alias("collection"))
    rows = _table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("frame_id"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice")).alias("bed_power_dB"))
    return analyses.eligibility(frames, rows, 20).withColumn("bed_share", _r("bed_share"))


@query("""WITH e AS (SELECT event_id, value AS q, value + event_id % 100 AS p FROM events), l AS (SELECT 'q' AS variable, q AS a, CASE WHEN event_id % 7 <> 0 THEN q * 1.5 END AS b FROM e UNION ALL SELECT 'p', p, p - q FROM e)
SELECT variable, count(*) AS n, round(median(a), 4) AS median_a, round(median(b), 4) AS median_b, round(stddev_pop(a), 4) AS std_a, round(stddev_pop(b), 4) AS std_b, round(median(a) - median(b), 4) AS median_difference FROM l WHERE b IS NOT NULL GROUP BY variable""")
def product_comparison(spark, sf_dir):
    """Two products of the same traces; the second lacks some values of one variable."""
    a = _table(spark, sf_dir, "events").select("event_id", F.col("value").alias("q"), (F.col("value") + F.col("event_id") % 100).alias("p"))
    b = a.select("event_id", F.when(F.col("event_id") % 7 != 0, F.col("q") * 1.5).alias("q"), (F.col("p") - F.col("q")).alias("p"))
    out = analyses.product_comparison(a, b, ["event_id"], ["q", "p"])
    return out.select("variable", "n", *[_r(c, 4).alias(c) for c in ("median_a", "median_b", "std_a", "std_b", "median_difference")])


@query("SELECT o_orderkey, o_totalprice AS a, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice * 1.01 WHEN o_orderkey % 5 > 0 THEN o_totalprice END AS b FROM orders WHERE o_orderkey % 7 = 0 OR o_orderkey % 5 = 0")
def differing_rows(spark, sf_dir):
    """Shared rows of two tables whose values are not the same."""
    a = _table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("v"))
    b = a.select("o_orderkey", F.when(F.col("o_orderkey") % 7 == 0, F.col("v") * 1.01).when(F.col("o_orderkey") % 5 > 0, F.col("v")).alias("v"))
    return analyses.differing_rows(a, b, ["o_orderkey"], "v", 1e-6)


@query("""WITH c AS (SELECT l_suppkey, count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS n_flagged FROM lineitem GROUP BY l_suppkey)
SELECT l_suppkey, n, n_flagged, round(n_flagged / n::DOUBLE, 6) AS rate, percent_rank() OVER (ORDER BY n_flagged DESC, l_suppkey) < 0.1 AS in_top FROM c""")
def offset_share(spark, sf_dir):
    """The rate of flagged traces per frame, and the tenth of frames that holds most of them."""
    return dist.top_share(_table(spark, sf_dir, "lineitem"), "l_suppkey", F.col("l_returnflag") == "R", 0.1).withColumn("rate", _r("rate"))


@query("WITH b AS (SELECT least(floor(value / 10), 9)::INT AS bin FROM events WHERE value BETWEEN 0 AND 100) SELECT i::INT AS bin, round(count(bin) / (SELECT count(*) FROM b)::DOUBLE / 10, 8) AS density FROM generate_series(0, 9) s(i) LEFT JOIN b ON bin = i GROUP BY i")
def histogram_density(spark, sf_dir):
    """A marginal with unit area."""
    return dist.histogram(_table(spark, sf_dir, "events"), "value", 0.0, 100.0, 10, density=True).select("bin", _r("density", 8).alias("density"))


@query(f"""WITH {RADAR}, w AS (SELECT vec_id, p[si - 1 : si + 3] AS a, p[bi - 1 : bi + 3] AS b, bi FROM r), x AS (SELECT vec_id, CASE WHEN vec_id % 2 = 0 THEN 'PASIN' ELSE 'HiCARS' END AS instrument, 10 * log10(list_max(a)) AS s, 10 * log10(list_max(b)) AS d FROM w WHERE bi IS NOT NULL)
SELECT instrument, count(*) AS n, round(median(s - d), 6) AS median, round(stddev_samp(s - d), 6) AS std, round(min(s - d), 6) AS low, round(max(s - d), 6) AS high FROM x GROUP BY instrument""")
def instrument_spread(spark, sf_dir):
    """Median, sample deviation and range of power ratios per instrument."""
    d, t = F.col("data"), F.col("twtt")
    rows = _radar(spark, sf_dir).where("bed is not null").withColumn("flight", F.when(F.col("vec_id") % 2 == 0, "b01").otherwise("DRP01"))
    rows = rows.withColumn("v", arrays.window_max_db(d, t, F.col("surface"), 0.6) - arrays.window_max_db(d, t, F.col("bed"), 0.6))
    out = dist.spread_statistics(rows.withColumn("instrument", values.instrument_of(F.col("flight"))), "v", ["instrument"])
    return out.select("instrument", "n", _r("median").alias("median"), _r("std_samp").alias("std"), _r("min").alias("low"), _r("max").alias("high"))


@query("SELECT user_id, count(*) AS n_traces, time_bucket(INTERVAL '1 hour', ts)::TIMESTAMP AS hour FROM events GROUP BY ALL")
def traces_per_hour(spark, sf_dir):
    """Traces per frame and tumbling window: the streaming aggregation, run as a batch."""
    from firnline.streaming.ingest import windowed_counts

    rows = _table(spark, sf_dir, "events").select(F.col("user_id").alias("frame_id"), F.col("ts").cast("timestamp").alias("slow_time"))
    return windowed_counts(rows, width="1 hour").select(F.col("frame_id").alias("user_id"), "n_traces", F.col("window.start").cast("timestamp_ntz").alias("hour"))
