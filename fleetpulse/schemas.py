"""Schemas of events, envelopes and reference tables."""

from __future__ import annotations

from pyspark.sql.types import (BinaryType, FloatType, IntegerType, LongType,
                               StringType, StructField, StructType,
                               TimestampType)

# The vehicle event contract (v1), field names and types as
# the upstream feed sends them.
EVENT_V1 = StructType([
    StructField("generated", StringType()),
    StructField("routeShortName", StringType()),
    StructField("tripId", IntegerType()),
    StructField("routeId", IntegerType()),
    StructField("headsign", StringType()),
    StructField("vehicleCode", StringType()),
    StructField("vehicleService", StringType()),
    StructField("vehicleId", IntegerType()),
    StructField("speed", IntegerType()),
    StructField("direction", IntegerType()),
    StructField("delay", IntegerType()),
    StructField("scheduledTripStartTime", StringType()),
    StructField("lat", FloatType()),
    StructField("lon", FloatType()),
    StructField("gpsQuality", IntegerType()),
    StructField("lastUpdate", StringType()),
])

# v2 adds one nullable field at the end.
EVENT_V2 = StructType(EVENT_V1.fields + [StructField("occupancy", StringType())])

# Columns of a Kafka source row that bronze keeps.  A landing folder of
# envelope records uses the same shape so file and Kafka ingest share code.
ENVELOPE = StructType([
    StructField("value", BinaryType()),
    StructField("partition", IntegerType()),
    StructField("offset", LongType()),
    StructField("timestamp", TimestampType()),
])

# Same, with the payload as text (what file-based landings hold).
ENVELOPE_TEXT = StructType([
    StructField("value", StringType()),
    StructField("partition", IntegerType()),
    StructField("offset", LongType()),
    StructField("timestamp", TimestampType()),
])

# Vehicle roster columns kept for enrichment (the source
# spells ``carrirer``; silver renames it to ``carrier``).
VEHICLE_ENRICH_COLUMNS = (
    "vehicleCode", "transportationType", "vehicleCharacteristics", "brand",
    "model", "productionYear", "length", "seats", "standingPlaces",
    "floorHeight", "driveType", "carrirer", "airConditioning",
    "wheelchairsRamp", "ticketMachine", "usb",
)

# Route file columns kept for enrichment.
ROUTE_ENRICH_COLUMNS = ("route_id", "route_type", "route_color", "route_text_color")

# Explicit reference-file schemas: identifiers and colours stay text so
# ``001122`` keeps its zeros; route_id is int because events carry int ids.
GTFS_SCHEMAS = {
    "routes.txt": "route_id INT, agency_id STRING, route_short_name STRING, "
                  "route_type INT, route_color STRING, route_text_color STRING",
    "stops.txt": "stop_id STRING, stop_code STRING, stop_name STRING, "
                 "stop_lat DOUBLE, stop_lon DOUBLE",
    "trips.txt": "route_id INT, service_id STRING, trip_id STRING, "
                 "trip_headsign STRING, direction_id INT",
    "stop_times.txt": "trip_id STRING, arrival_time STRING, departure_time STRING, "
                      "stop_id STRING, stop_sequence INT",
    "calendar_dates.txt": "service_id STRING, date STRING, exception_type INT",
    "agency.txt": "agency_id STRING, agency_name STRING, agency_url STRING, "
                  "agency_timezone STRING",
}

# The vehicle roster: sizes and counts are numbers, equipment is yes or no.
ROSTER_SCHEMA = ("vehicleCode STRING, transportationType STRING, vehicleCharacteristics STRING, brand STRING, "
                 "model STRING, productionYear BIGINT, length DOUBLE, seats BIGINT, standingPlaces BIGINT, "
                 "floorHeight STRING, driveType STRING, carrirer STRING, airConditioning BOOLEAN, "
                 "wheelchairsRamp BOOLEAN, ticketMachine BOOLEAN, usb BOOLEAN")
