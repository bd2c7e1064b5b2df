"""Column expressions used by the silver and serving layers.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; none needs a Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "c", "utc_time", "utc_instant", "utc_of_instant", "local_time", "delay_min", "delay_tenths",
    "delay_bucket", "is_delayed", "is_stopped", "is_moving", "has_trip",
    "gps_ok", "in_box", "normalise_type", "marker_color", "marker_popup",
    "snapshot_name", "BOX", "TYPE_NAMES",
]

# The service-area bounding box (inclusive), and the thresholds
# in seconds that split early / on time / delayed.
BOX = {"lat": (54.2, 54.6), "lon": (18.3, 19.0)}
EARLY_BELOW_S = -60
DELAYED_ABOVE_S = 120
# Roster vehicle-type names and their English forms.
TYPE_NAMES = {"Autobus": "Bus", "Tramwaj": "Tram"}


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# UTC wall-clock ``timestamp_ntz`` values and instants (``timestamp``) share
# one scale: microseconds since 1970-01-01 00:00 UTC.  Moving between them
# through that count never consults the session time zone, so it is exact
# in every zone, DST gaps and overlaps included.  It is also cheaper than
# ``convert_timezone``, which resolves its zone names on every row, while
# ``from_utc_timestamp`` resolves a literal zone once.
def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def utc_of_instant(ts) -> Column:
    """Instant (``timestamp``) -> UTC wall-clock ``timestamp_ntz``."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(c(ts)), _epoch())


def utc_instant(utc_ntz) -> Column:
    """UTC wall-clock ``timestamp_ntz`` -> zoned instant (``timestamp``)."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch(), c(utc_ntz)))


def utc_time(text) -> Column:
    """ISO-8601 text -> UTC wall-clock ``timestamp_ntz``; bad text -> NULL.

    ``try_to_timestamp`` yields the instant (honouring a ``Z`` or offset in
    the text); one bad event therefore never fails a stream.
    """
    return utc_of_instant(F.try_to_timestamp(c(text)))


def local_time(utc_ntz, tz: str = "Europe/Warsaw") -> Column:
    """UTC wall time -> local wall time (DST aware), NTZ in and out."""
    return utc_of_instant(F.from_utc_timestamp(utc_instant(utc_ntz), tz))


def delay_min(delay="delay") -> Column:
    """Delay in minutes, one decimal, half away from zero."""
    return F.round(c(delay) / F.lit(60.0), 1)


def delay_tenths(delay_min_col="delay_min") -> Column:
    """Exact integer tenths of a minute behind a one-decimal ``delay_min``."""
    return F.round(c(delay_min_col) * 10).cast("long")


def delay_bucket(delay="delay") -> Column:
    """early / on_time / delayed.  A NULL delay falls through to delayed."""
    d = c(delay)
    return (F.when(d < EARLY_BELOW_S, "early")
            .when(d <= DELAYED_ABOVE_S, "on_time")
            .otherwise("delayed"))


def is_delayed(delay="delay") -> Column:
    return c(delay) > DELAYED_ABOVE_S


def is_stopped(speed="speed") -> Column:
    return c(speed) == 0


def is_moving(speed="speed") -> Column:
    return c(speed) > 0


def has_trip(trip="tripId") -> Column:
    return c(trip).isNotNull()


def gps_ok(quality="gpsQuality") -> Column:
    return c(quality) > 0


def in_box(lat="lat", lon="lon") -> Column:
    """Inclusive box test; NULL and (0, 0) positions fall outside."""
    (la0, la1), (lo0, lo1) = BOX["lat"], BOX["lon"]
    return c(lat).between(la0, la1) & c(lon).between(lo0, lo1)


def normalise_type(col="transportationType") -> Column:
    x = c(col)
    out = x
    for src, dst in reversed(list(TYPE_NAMES.items())):
        out = F.when(x == src, dst).otherwise(out)
    return out


def marker_color(delay="delay") -> Column:
    """Map marker colour; a NULL delay counts as on time here."""
    return F.when(c(delay) > DELAYED_ABOVE_S, "red").otherwise("green")


def marker_popup(route="routeShortName", delay="delay") -> Column:
    """``<route> | Delay: <delay> s``; NULLs print as the text ``None``."""
    return F.concat(F.coalesce(c(route), F.lit("None")), F.lit(" | Delay: "),
                    F.coalesce(c(delay).cast("string"), F.lit("None")), F.lit(" s"))


def snapshot_name(ts) -> Column:
    """File name of a landed snapshot: ``gps_YYYYmmdd_HHMMSS.json``."""
    return F.concat(F.lit("gps_"), F.date_format(c(ts), "yyyyMMdd_HHmmss"), F.lit(".json"))
