"""Schemas of the tables, and the registry of variables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, ByteType, DataType, DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampType

_TYPES: dict[str, DataType] = {
    "string": StringType(), "double": DoubleType(), "boolean": BooleanType(), "tinyint": ByteType(), "int": IntegerType(), "long": LongType(), "timestamp": TimestampType(),
    "array<double>": ArrayType(DoubleType()), "array<string>": ArrayType(StringType()), "array<long>": ArrayType(LongType()),
}


def table(text: str) -> StructType:
    """A schema from "name type, ..."; unlike Spark's own parser it needs no session."""
    return StructType([StructField(name, _TYPES[kind]) for name, kind in (column.split() for column in text.split(","))])


RAW_TRACES = table("frame_id string, segment_id string, collection string, slow_time timestamp, latitude double, longitude double, elevation double, heading double, data array<double>, twtt array<double>")
PICKS = table("segment_id string, layer_key string, slow_time timestamp, twtt double, quality double")
FRAMES = table("frame_id string, segment_id string, collection string, x_min double, y_min double, x_max double, y_max double, href string")
#: The trace table: the contract between extraction and every analysis.
TRACES = table(
    "frame_id string, slow_time timestamp, latitude double, longitude double, elevation double, surface_twtt double, surface_power_dB double, surface_elevation double,"
    "pre_surface_noise_dB double, record_tail_noise_dB double, post_bed_noise_interp_dB double, post_bed_peak_interp_dB double, post_bed_std_interp_dB double, bed_twtt double,"
    "bed_power_dB double, bed_elevation double, required_surface_snr_dB double, post_bed_noise_dB double, record_end_twtt double, qc_pass boolean, qc_surface_pass boolean,"
    "qc_heading_pass boolean, qc_agl_pass boolean, bed_pick_available boolean, bed_pick_attempted boolean, bed_pick_quality tinyint, collection string"
)
FRAME_DIM = table("frame_id string, frame_index int, collection string, frame_bed_pick_fraction double, segment_bed_pick_fraction double")

#: What became of each try of a frame: rows, none (nothing passed) or failed (it couldn't be read).
ATTEMPTS = table("frame_id string, attempted_at timestamp, outcome string, error string")

#: Variable: label, unit, display scale (fixed values). ``rssnr`` is an alias.
VARIABLES = {
    "required_surface_snr_dB": ("Required surface SNR", "dB", 1.0),
    "surface_power_dB": ("Surface power", "dB", 1.0),
    "bed_power_dB": ("Bed power", "dB", 1.0),
    "surface_twtt": ("Surface travel time", "us", 1e6),
    "bed_twtt": ("Bed travel time", "us", 1e6),
    "surface_elevation": ("Surface elevation", "m", 1.0),
    "bed_elevation": ("Bed elevation", "m", 1.0),
    "pre_surface_noise_dB": ("Noise before the surface", "dB", 1.0),
    "post_bed_noise_dB": ("Noise below the bed", "dB", 1.0),
    "post_bed_noise_interp_dB": ("Noise below the bed, interpolated", "dB", 1.0),
    "record_tail_noise_dB": ("Noise in the record's tail", "dB", 1.0),
}
ALIASES = {"rssnr": "required_surface_snr_dB"}


def variable(name: str) -> str:
    name = ALIASES.get(name, name)
    if name not in VARIABLES:
        raise KeyError(name)
    return name


def conform(rows: DataFrame, schema: StructType = TRACES) -> DataFrame:
    """The schema's columns in order: missing ones are NULL, unknown ones an error, NaN is missing."""
    unknown = set(rows.columns) - set(schema.names)
    if unknown:
        raise ValueError(f"columns that the table doesn't have: {sorted(unknown)}")

    def one(field):
        if field.name not in rows.columns:
            return F.lit(None).cast(field.dataType).alias(field.name)
        c = F.col(field.name).cast(field.dataType)
        return (F.when(~F.isnan(c), c) if field.dataType.simpleString() == "double" else c).alias(field.name)

    return rows.select(*[one(f) for f in schema])
