"""Schemas of the trip fact table, the zone lookup and the enriched view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)

# The trip table's column names and order (data dictionary of
# the source data set), with the types this package stores them as.
TRIP_FIELDS: list[tuple[str, T.DataType]] = [
    ("business", T.StringType()),
    ("pickup_location", T.IntegerType()),
    ("dropoff_location", T.IntegerType()),
    ("trip_length", T.DoubleType()),
    ("request_to_pickup", T.DoubleType()),
    ("total_ride_time", T.DoubleType()),
    ("on_scene_to_pickup", T.DoubleType()),
    ("on_scene_to_dropoff", T.DoubleType()),
    ("time_of_day", T.StringType()),
    ("date", T.LongType()),
    ("passenger_fare", MONEY),
    ("driver_total_pay", MONEY),
    ("rideshare_profit", MONEY),
    ("hourly_rate", T.DoubleType()),
    ("dollars_per_mile", T.DoubleType()),
]
TRIP_COLUMNS = [n for n, _ in TRIP_FIELDS]
TRIP_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in TRIP_FIELDS])

# Zone lookup columns.
ZONE_FIELDS: list[tuple[str, T.DataType]] = [
    ("LocationID", T.IntegerType()),
    ("Borough", T.StringType()),
    ("Zone", T.StringType()),
    ("service_zone", T.StringType()),
]
ZONE_COLUMNS = [n for n, _ in ZONE_FIELDS]
ZONE_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in ZONE_FIELDS])
ZONE_ATTRS = ["Borough", "Zone", "service_zone"]

# Role prefixes of the role-playing zone dimension and the trip key per role.
ROLE_KEYS = {"Pickup": "pickup_location", "Dropoff": "dropoff_location"}

# The enriched table is the 15 trip columns followed by
# Pickup_Borough, Pickup_Zone, Pickup_service_zone, Dropoff_Borough,
# Dropoff_Zone, Dropoff_service_zone.
ENRICHED_COLUMNS = TRIP_COLUMNS + [f"{role}_{a}" for role in ("Pickup", "Dropoff")
                                   for a in ZONE_ATTRS]

# Vertex table of the zone graph.
VERTEX_COLUMNS = ["id", "Borough", "Zone", "service_zone"]


ENRICHED_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType() if n == "date" else t) for n, t in TRIP_FIELDS]
    + [T.StructField(c, T.StringType()) for c in ENRICHED_COLUMNS[len(TRIP_FIELDS):]])


def assert_schema(df: DataFrame, expected: T.StructType) -> None:
    """Schema contract check: names and types in exact order (not nullability)."""
    got = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    want = [(f.name, f.dataType.simpleString()) for f in expected.fields]
    if got != want:
        raise AssertionError(f"schema mismatch:\n  expected {want}\n  got      {got}")


def schema_report(df: DataFrame) -> list[tuple[str, str, bool]]:
    """(name, type, nullable) of every column."""
    return [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
