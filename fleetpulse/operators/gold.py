"""Silver -> gold serving tables.

Distinct-vehicle measures are computed in two aggregation steps: first per
(group keys, vehicle), then per group.  Both steps combine map-side, so a
hot route or vehicle collapses to one row per task before any shuffle, and
the plan avoids the row-multiplying Expand that several ``countDistinct``
calls would add.  Rounded means use the exact integer helpers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetpulse.functions.aggregates import (round_mean_int_2dp,
                                             round_mean_tenths_2dp,
                                             round_pct_1dp)
from fleetpulse.functions.scalar import delay_tenths


def _measures(trip_only_delay: bool) -> list[Column]:
    """Sums, counts and maxima of readings."""
    t = delay_tenths("delay_min")
    if trip_only_delay:
        t = F.when(F.col("has_trip"), t)
    moving_speed = F.when(F.col("is_moving"), F.col("speed"))
    return [
        F.count(F.lit(1)).alias("_rows"),
        F.sum(t).alias("_s_delay"),
        F.count(t).alias("_n_delay"),
        F.max(t).alias("_max_delay"),
        F.sum(moving_speed).alias("_s_speed"),
        F.count(moving_speed).alias("_n_speed"),
        F.sum(F.col("is_delayed").cast("int")).alias("_t_delayed"),
        F.count(F.col("is_delayed")).alias("_n_delayed"),
    ]


def _per_vehicle(df: DataFrame, keys: list[str], trip_only_delay: bool) -> DataFrame:
    """Partial measures per (keys, vehicleId)."""
    return df.groupBy(*keys, "vehicleId").agg(
        *_measures(trip_only_delay),
        F.max(F.when(F.col("is_delayed"), 1)).alias("_any_delayed"),
        F.max(F.when(F.col("is_stopped"), 1)).alias("_any_stopped"),
    )


def _vehicles_where(flag: str):
    return F.count(F.when(F.col(flag) == 1, F.col("vehicleId")))


# How each per-vehicle partial combines with another one for the same
# (group keys, vehicle): every partial is a sum or a maximum, so partials
# of disjoint batches of readings merge exactly.
PARTIAL_MERGE = {"_rows": F.sum, "_s_delay": F.sum, "_n_delay": F.sum,
                 "_max_delay": F.max, "_s_speed": F.sum, "_n_speed": F.sum,
                 "_t_delayed": F.sum, "_n_delayed": F.sum,
                 "_any_delayed": F.max, "_any_stopped": F.max}

# Gold table -> (group keys, silver filter, delay over trips only).
PARTIAL_SPECS = {
    "period_summary": ([], None, True),
    "route_summary": (["routeId", "routeShortName", "transportationType"],
                      "routeId IS NOT NULL", True),
    "destination_summary": (["routeShortName", "headsign", "transportationType"],
                            "has_trip AND headsign IS NOT NULL", False),
    # rows only (no delay or speed measures)
    "delay_distribution": (["delay_bucket", "transportationType"], "has_trip", None),
}


def vehicle_partials(silver: DataFrame, table: str) -> DataFrame:
    """Per-(group, vehicle) partials of one gold table over ``silver``."""
    keys, cond, trip_only = PARTIAL_SPECS[table]
    src = silver if cond is None else silver.filter(cond)
    if trip_only is None:
        return src.groupBy(*keys, "vehicleId").agg(F.count(F.lit(1)).alias("_rows"))
    return _per_vehicle(src, keys, trip_only_delay=trip_only)


def merge_partials(parts: DataFrame, table: str) -> DataFrame:
    """Partials of several disjoint batches of readings -> one per (group, vehicle).

    Its size follows the fleet and the groups, not the number of readings.
    """
    keys = PARTIAL_SPECS[table][0]
    return parts.groupBy(*keys, "vehicleId").agg(
        *[fn(c).alias(c) for c, fn in PARTIAL_MERGE.items() if c in parts.columns])


def gold_from_partials(pv: DataFrame, table: str) -> DataFrame:
    return {"period_summary": period_from_partials,
            "route_summary": route_from_partials,
            "destination_summary": destination_from_partials,
            "delay_distribution": delay_from_partials}[table](pv)


def period_summary(silver: DataFrame) -> DataFrame:
    """Whole-period KPIs; one row even on empty input."""
    return period_from_partials(vehicle_partials(silver, "period_summary"))


def period_from_partials(pv: DataFrame) -> DataFrame:
    return pv.agg(
        F.count("vehicleId").alias("total_vehicles"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total_readings"),
        round_mean_tenths_2dp(F.sum("_s_delay"), F.sum("_n_delay")).alias("avg_delay_min"),
        (F.max("_max_delay") / F.lit(10.0)).alias("max_delay_min"),
        round_pct_1dp(F.sum("_t_delayed"), F.sum("_n_delayed")).alias("delayed_reading_pct"),
        round_mean_int_2dp(F.sum("_s_speed"), F.sum("_n_speed")).alias("avg_speed"),
    )


def route_summary(silver: DataFrame) -> DataFrame:
    return route_from_partials(vehicle_partials(silver, "route_summary"))


def route_from_partials(pv: DataFrame) -> DataFrame:
    keys = PARTIAL_SPECS["route_summary"][0]
    return pv.groupBy(*keys).agg(
        F.count("vehicleId").alias("active_vehicles"),
        round_mean_tenths_2dp(F.sum("_s_delay"), F.sum("_n_delay")).alias("avg_delay_min"),
        (F.max("_max_delay") / F.lit(10.0)).alias("max_delay_min"),
        round_mean_int_2dp(F.sum("_s_speed"), F.sum("_n_speed")).alias("avg_speed"),
        _vehicles_where("_any_delayed").alias("delayed_vehicles"),
        _vehicles_where("_any_stopped").alias("stopped_vehicles"),
    )


def delay_distribution(silver: DataFrame) -> DataFrame:
    return delay_from_partials(vehicle_partials(silver, "delay_distribution"))


def delay_from_partials(pv: DataFrame) -> DataFrame:
    keys = PARTIAL_SPECS["delay_distribution"][0]
    return pv.groupBy(*keys).agg(
        F.sum("_rows").alias("records_count"),
        F.count("vehicleId").alias("vehicles_count"),
    )


def destination_summary(silver: DataFrame) -> DataFrame:
    return destination_from_partials(vehicle_partials(silver, "destination_summary"))


def destination_from_partials(pv: DataFrame) -> DataFrame:
    keys = PARTIAL_SPECS["destination_summary"][0]
    return pv.groupBy(*keys).agg(
        F.count("vehicleId").alias("active_vehicles"),
        round_mean_tenths_2dp(F.sum("_s_delay"), F.sum("_n_delay")).alias("avg_delay_min"),
        round_mean_int_2dp(F.sum("_s_speed"), F.sum("_n_speed")).alias("avg_speed"),
        _vehicles_where("_any_delayed").alias("delayed_vehicles"),
    )


class Exact:
    """Summaries by partials per (group, vehicle): distinct vehicles are exact."""

    by_vehicle = True
    partials, merge, result = staticmethod(vehicle_partials), staticmethod(merge_partials), staticmethod(gold_from_partials)


# Sketches of distinct vehicles: with 2^SKETCH_BITS buckets the standard error
# is about 1.04 / sqrt(2^SKETCH_BITS), 1.6 percent.
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)

# Vehicle sketches of the approximate partials: name -> which readings count.
SKETCHES = {"_vehicles": None, "_delayed": "is_delayed", "_stopped": "is_stopped"}


def _numbers(df: DataFrame) -> list[str]:
    """The partial sums and maxima, which need no vehicles."""
    return [c for c in PARTIAL_MERGE if c in df.columns and not c.startswith("_any")]


def sketch_partials(silver: DataFrame, table: str) -> DataFrame:
    """Partials per group: the sums and maxima, and a sketch of the vehicles."""
    keys, cond, trip_only = PARTIAL_SPECS[table]
    src = silver if cond is None else silver.filter(cond)
    flags = {n: f for n, f in SKETCHES.items() if f is None or trip_only is not None}
    sums = [F.count(F.lit(1)).alias("_rows")] if trip_only is None else _measures(trip_only)
    return src.groupBy(*keys).agg(*sums, *[
        F.hll_sketch_agg(F.col("vehicleId") if f is None else F.when(F.col(f), F.col("vehicleId")),
                         SKETCH_BITS).alias(n) for n, f in flags.items()])


def merge_sketches(parts: DataFrame, table: str) -> DataFrame:
    """Partials of several disjoint batches of readings -> one per group."""
    return parts.groupBy(*PARTIAL_SPECS[table][0]).agg(
        *[PARTIAL_MERGE[c](c).alias(c) for c in _numbers(parts)],
        *[F.hll_union_agg(n).alias(n) for n in SKETCHES if n in parts.columns])


def gold_from_sketches(parts: DataFrame, table: str) -> DataFrame:
    """A summary whose vehicle counts are estimates; all else is exact."""
    def vehicles(name):
        return F.coalesce(F.hll_sketch_estimate(name), F.lit(0).cast("long"))

    delay = ("avg_delay_min", lambda: round_mean_tenths_2dp(F.col("_s_delay"), F.col("_n_delay")))
    most = ("max_delay_min", lambda: F.col("_max_delay") / F.lit(10.0))
    speed = ("avg_speed", lambda: round_mean_int_2dp(F.col("_s_speed"), F.col("_n_speed")))
    of = {
        "period_summary": [
            ("total_vehicles", lambda: vehicles("_vehicles")), ("total_readings", lambda: F.col("_rows")), delay, most,
            ("delayed_reading_pct", lambda: round_pct_1dp(F.col("_t_delayed"), F.col("_n_delayed"))), speed],
        "route_summary": [
            ("active_vehicles", lambda: vehicles("_vehicles")), delay, most, speed,
            ("delayed_vehicles", lambda: vehicles("_delayed")), ("stopped_vehicles", lambda: vehicles("_stopped"))],
        "destination_summary": [
            ("active_vehicles", lambda: vehicles("_vehicles")), delay, speed,
            ("delayed_vehicles", lambda: vehicles("_delayed"))],
        "delay_distribution": [
            ("records_count", lambda: F.col("_rows")), ("vehicles_count", lambda: vehicles("_vehicles"))],
    }[table]
    return parts.select(*PARTIAL_SPECS[table][0], *[make().alias(n) for n, make in of])


class Approximate:
    """Summaries by one partial per group, with mergeable vehicle sketches in
    place of a row per vehicle: for fleets too large for those."""

    by_vehicle = False
    partials, merge, result = staticmethod(sketch_partials), staticmethod(merge_sketches), staticmethod(gold_from_sketches)


# Columns of the current-fleet serving table, in order.
FLEET_COLUMNS = ("vehicleId", "vehicleCode", "routeShortName", "headsign",
                 "lat", "lon", "delay", "delay_min", "delay_bucket", "speed",
                 "is_moving", "transportationType", "model",
                 "event_time", "event_time_local")


def fleet_current(silver: DataFrame) -> DataFrame:
    """Latest reading per vehicle (NULL event times sort last).

    ``row_number() = 1`` plans a partial WindowGroupLimit before the shuffle,
    so only each task's newest row per vehicle crosses the network.
    """
    order = [F.col("event_time").desc_nulls_last()]
    order += [F.col(c).desc_nulls_last() for c in ("enqueued_ts", "partition", "offset")
              if c in silver.columns]
    w = Window.partitionBy("vehicleId").orderBy(*order)
    return (silver.withColumn("_rn", F.row_number().over(w))
                  .filter(F.col("_rn") == 1).drop("_rn")
                  .select(*FLEET_COLUMNS))


def live_kpi_measures() -> dict:
    """KPI measures over a table with one row per vehicle (fleet_current).

    On such input a conditional count of ``vehicleId`` equals the distinct
    count, without a distinct-aggregation shuffle.
    """
    t = delay_tenths("delay_min")
    vid = F.col("vehicleId")
    return {
        "snapshot_time": F.max("event_time"),
        "active_vehicles": F.count(vid),
        "stopped_vehicles": F.count(F.when(F.col("is_moving") == F.lit(False), vid)),
        "delayed_vehicles": F.count(F.when(F.col("delay") > 120, vid)),
        "avg_delay_min": round_mean_tenths_2dp(F.sum(t), F.count(t)),
        "max_delay_min": F.max(t) / F.lit(10.0),
    }


def live_kpi(fleet: DataFrame) -> DataFrame:
    return fleet.agg(*[c.alias(n) for n, c in live_kpi_measures().items()])
