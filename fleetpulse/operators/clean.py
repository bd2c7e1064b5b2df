"""Bronze -> cleaned silver readings (before enrichment)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.functions import scalar as S
from fleetpulse.operators.dedup import dedup_first

# Delivery order of a reading: the first landed copy survives.
DELIVERY_ORDER = ("enqueued_ts", "partition", "offset")


def typed_timestamps(bronze: DataFrame) -> DataFrame:
    """Event-time text columns -> UTC ``timestamp_ntz`` (bad text -> NULL)."""
    return bronze.withColumns({
        "generated": S.utc_time("generated"),
        "lastUpdate": S.utc_time("lastUpdate"),
        "scheduledTripStartTime": S.utc_time("scheduledTripStartTime"),
    })


def dedup_readings(df: DataFrame) -> DataFrame:
    """One row per (vehicleId, generated), first delivered copy wins."""
    return dedup_first(df, ["vehicleId", "generated"],
                       [F.col(c).asc_nulls_last() for c in DELIVERY_ORDER])


def derive(df: DataFrame, tz: str = "Europe/Warsaw") -> DataFrame:
    """The nine derived silver columns, in their published order."""
    return df.withColumns({
        "delay_min": S.delay_min("delay"),
        "has_trip": S.has_trip("tripId"),
        "delay_bucket": S.delay_bucket("delay"),
        "is_delayed": S.is_delayed("delay"),
        "is_stopped": S.is_stopped("speed"),
        "is_moving": S.is_moving("speed"),
        "gps_ok": S.gps_ok("gpsQuality"),
        "event_time_local": S.local_time("event_time", tz),
        "scheduled_start_local": S.local_time("scheduledTripStartTime", tz),
    })


def bbox_filter(df: DataFrame) -> DataFrame:
    return df.filter(S.in_box("lat", "lon"))


def silver_clean(bronze: DataFrame, tz: str = "Europe/Warsaw") -> DataFrame:
    """typed times -> dedup -> derived columns -> service-area filter.

    The box filter stays after the dedup: lat/lon are not dedup keys, so
    filtering first could let a dropped copy's twin survive.
    """
    return bbox_filter(derive(dedup_readings(typed_timestamps(bronze)), tz))
