"""Scalar rules: capacities, temporal gaps, bands, labels, identifiers, deterministic randomness."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Capacity (kW) by minimum line voltage (V), highest first.
CAPACITY_BY_VOLTAGE = (
    (500000.0, 500000.0),
    (345000.0, 300000.0),
    (230000.0, 200000.0),
    (115000.0, 100000.0),
    (69000.0, 100000.0),
    (46000.0, 30000.0),
)
SMALLEST_CAPACITY_KW = 20000.0

# Upper edges (metres) of the service-distance bands.
SERVICE_BANDS = ((5000.0, "0-5 km"), (10000.0, "5-10 km"), (15000.0, "10-15 km"), (20000.0, "15-20 km"))


def voltage_to_capacity(voltage: Column, missing_capacity_kw: float = 200000.0) -> Column:
    """Capacity of the highest listed voltage; one unreadable part voids the whole value."""
    parts = F.filter(F.split(voltage, ";"), lambda p: F.trim(p) != "")
    volts = F.transform(parts, lambda p: F.trim(p).try_cast("double"))
    usable = F.when(F.exists(volts, lambda v: v.isNull()), F.lit(None)).otherwise(F.array_max(volts))
    band = F.lit(SMALLEST_CAPACITY_KW)
    for edge, kw in reversed(CAPACITY_BY_VOLTAGE):
        band = F.when(usable >= edge, F.lit(kw)).otherwise(band)
    return F.when(usable.isNull(), F.lit(float(missing_capacity_kw))).otherwise(band)


def temporal_gap_years(acquired: Column, edited: Column) -> Column:
    """Absolute gap in years of 365.25 days; a negative fraction of a day floors to a whole day."""
    micros = F.unix_micros(acquired.cast("timestamp")) - F.unix_micros(edited.cast("timestamp"))
    return F.abs(F.floor(micros / F.lit(86400e6))) / F.lit(365.25)


def confidence_band(confidence: Column, high: float = 0.8, medium: float = 0.6) -> Column:
    return F.when(confidence > high, "high").when(confidence > medium, "medium").otherwise("low")


def service_distance_band(dist_m: Column) -> Column:
    band = None
    for edge, name in SERVICE_BANDS:
        band = F.when(dist_m < edge, name) if band is None else band.when(dist_m < edge, name)
    return F.when(dist_m.isNull(), F.lit(None)).otherwise(band.otherwise("20+ km"))


def location_name(road: Column, neighbourhood: Column, city: Column, display_name: Column) -> Column:
    named = F.concat_ws(", ", *[F.nullif(c, F.lit("")) for c in (road, neighbourhood, city)])
    return F.when(named != "", named).otherwise(F.substring(F.coalesce(display_name, F.lit("")), 1, 80))


def suitability_label(restrictions: Column) -> Column:
    return F.when(F.size(F.coalesce(restrictions, F.array().cast("array<string>"))) > 0,
                  "restricted").otherwise("suitable")


def suitability_reason(names: Column) -> Column:
    near = F.concat(F.lit("Near: "), F.array_join(F.slice(names, 1, 2), ", "))
    return F.when(F.size(F.coalesce(names, F.array().cast("array<string>"))) > 0, near).otherwise(
        "No restricted areas detected within 500m")


def padded(code: Column, length: int) -> Column:
    """Leading zeros up to ``length``; longer codes stay whole."""
    text = code.cast("string")
    return F.when(F.char_length(text) < length, F.lpad(text, length, "0")).otherwise(text)


def geoid_state(geoid: Column) -> Column:
    return F.substring(padded(geoid, 5), 1, 2)


def geoid_county(geoid: Column) -> Column:
    return F.substring(padded(geoid, 5), 3, 3)


def positive_patch_id(geoid: Column, kind: Column, osm_id: Column, i: Column) -> Column:
    return F.format_string("pos_%s_%s_%d_%04d", geoid, kind, osm_id.cast("bigint"), i.cast("bigint"))


def random_patch_id(i: Column) -> Column:
    return F.format_string("rand_%04d", i.cast("bigint"))


def detection_id(i: Column) -> Column:
    return F.format_string("det_%05d", i.cast("bigint"))


def ground_patch_id(lon: Column, lat: Column) -> Column:
    return F.format_string("patch_%07d_%07d", F.bround(lat * 10000, 0).cast("bigint"),
                           F.bround(F.abs(lon) * 10000, 0).cast("bigint"))


def parse_type_budgets(text: Column) -> Column:
    """``'a=10,b=20'`` → ``MAP<STRING,INT>``; quotes and spaces around entries are ignored."""
    clean = F.regexp_replace(text, "[\"'\\s]", "")
    return F.transform_values(F.str_to_map(clean, F.lit(","), F.lit("=")), lambda _, v: v.cast("int"))


def sha256_fingerprint(content: Column) -> Column:
    return F.sha2(content, 256)


def is_constant(*bands: Column) -> Column:
    """One and the same value in all bands."""
    low, high = [F.array_min(b) for b in bands], [F.array_max(b) for b in bands]
    return (low[0] == high[0]) if len(bands) == 1 else F.least(*low) == F.greatest(*high)


def hash_order(*keys: Column, seed: int) -> Column:
    """Reproducible shuffle key: the same for any partitioning of the same rows."""
    return F.xxhash64(*keys, F.lit(seed))


def hash_uniform(*keys: Column, seed: int) -> Column:
    """Uniform double in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*keys, F.lit(seed)), 11) * F.lit(2.0**-53)


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))
