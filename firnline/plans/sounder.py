"""Sounder picks as a table function of SQL: rows in, values and what became of each pick out.

``register(spark)``, then for instance

    SELECT flight, status, count(*) FROM sounder_values(TABLE(SELECT * FROM matched)) GROUP BY ALL

where ``matched`` is what ``matched_picks`` gives: each pick with its flight's nearest trace, found by Spark's join. The
function takes Arrow batches and keeps nothing between them, so no flight is gathered anywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firnline.functions.physics import HIGH_GAIN_DB, LIGHT, SOUNDER_ICE_INDEX
from firnline.functions.values import instrument_of
from firnline.operators import matching, quality

RETURNS = "flight string, point_id long, status string, trace_id long, surface_power_dB double, bed_power_dB double, rssnr double"


def matched_picks(results: DataFrame, radargrams: DataFrame, reach: float = 500.0) -> DataFrame:
    """(flight, point_id, radar_height, ice_thickness, two_channel, known, trace_id, twtt, low_gain, high_gain): every
    pick, with the nearest trace of its flight within ``reach`` if it has values; ``known`` if the flight has any.
    Picks meet places only; samples join the pairs that are left."""
    good = results.where(quality.finite("radar_height", "ice_thickness") & (F.col("radar_height") > 0) & (F.col("ice_thickness") > 0))
    places = radargrams.select(F.col("flight").alias("_flight"), "trace_id", F.col("x").alias("_tx"), F.col("y").alias("_ty"))
    met = matching.nearest_within(good.select("flight", "point_id", "x", "y"), places, reach, "point_id", "trace_id", ("x", "y"), ("_tx", "_ty"), ("flight", "_flight"))
    nearest = met.select("flight", "point_id", "trace_id")
    pairs = nearest.join(radargrams.select("flight", "trace_id", "twtt", "low_gain", "high_gain"), ["flight", "trace_id"])
    known = radargrams.select("flight").distinct().withColumn("known", F.lit(True))
    rows = results.select("flight", "point_id", F.col("radar_height").cast("double").alias("radar_height"), F.col("ice_thickness").cast("double").alias("ice_thickness"), (instrument_of(F.col("flight")) == "HiCARS").alias("two_channel"))
    out = rows.join(known, "flight", "left").join(pairs, ["flight", "point_id"], "left")
    return out.select("flight", "point_id", "radar_height", "ice_thickness", "two_channel", F.coalesce("known", F.lit(False)).alias("known"), "trace_id", "twtt", "low_gain", "high_gain")


class SounderValues:
    """Status and values of matched picks."""

    MARGIN_M = 50.0

    def eval(self, batch):
        import numpy as np
        import pyarrow as pa

        permittivity = SOUNDER_ICE_INDEX**2
        margin = self.MARGIN_M / (LIGHT / permittivity**0.5)
        column = {n: batch.column(n) for n in batch.schema.names}
        number = lambda n: column[n].cast(pa.float64()).to_numpy(zero_copy_only=False)
        height, thick = number("radar_height"), number("ice_thickness")
        known, two = (column[n].fill_null(False).to_numpy(zero_copy_only=False) for n in ("known", "two_channel"))
        valued = np.isfinite(height) & np.isfinite(thick) & (np.nan_to_num(height) > 0) & (np.nan_to_num(thick) > 0)
        surface = height * (2 / LIGHT)
        bed = surface + thick * (2 * SOUNDER_ICE_INDEX / LIGHT)
        status, levels = [], np.full((3, batch.num_rows), np.nan)

        def level(samples, times, at):
            here = samples[(times >= at - margin) & (times <= at + margin)]
            here = here[~np.isnan(here)]
            return 10 * np.log10(here.max()) if len(here) and here.max() > 0 else np.nan

        for i in range(batch.num_rows):
            if not valued[i]:
                status.append("no value")
            elif not known[i]:
                status.append("no radargram")
            elif not column["trace_id"][i].is_valid:
                status.append("too far")
            else:
                times = np.asarray(column["twtt"][i].values, float)
                if not len(times) or surface[i] < times[0] or bed[i] > times[-1] or bed[i] <= surface[i]:
                    status.append("outside record")
                    continue
                status.append("ok")
                low = np.asarray(column["low_gain"][i].values, float)
                top = level(low, times, surface[i])
                deep = level(np.asarray(column["high_gain"][i].values, float), times, bed[i]) - HIGH_GAIN_DB if two[i] else level(low, times, bed[i])
                loss = surface[i] / (surface[i] + (bed[i] - surface[i]) / permittivity)
                levels[:, i] = top, deep, top - deep + 20 * np.log10(loss)
        yield pa.table([column["flight"], column["point_id"].cast(pa.int64()), pa.array(status, pa.string()), column["trace_id"].cast(pa.int64()), *[pa.array(v, from_pandas=True) for v in levels]], names=["flight", "point_id", "status", "trace_id", "surface_power_dB", "bed_power_dB", "rssnr"])


def register(spark: SparkSession, name: str = "sounder_values") -> None:
    """Make the table function known to SQL."""
    spark.udtf.register(name, F.arrow_udtf(SounderValues, returnType=RETURNS))
