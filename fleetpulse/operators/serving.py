"""Dashboard, map and top-k queries over the gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.functions.scalar import marker_color, marker_popup

# Columns shown by the dashboard's map and vehicle widgets.
MAP_POINT_COLUMNS = ("delay_bucket", "lat", "lon", "routeShortName",
                     "transportationType", "delay_min", "speed")
VEHICLE_TABLE_COLUMNS = ("routeShortName", "headsign", "transportationType",
                         "model", "delay_min", "speed")


def dash_map_points(fleet: DataFrame) -> DataFrame:
    return fleet.select(*MAP_POINT_COLUMNS)


def dash_vehicle_table(fleet: DataFrame) -> DataFrame:
    """Vehicles, most delayed first (NULL delays last)."""
    return (fleet.select("vehicleId", *VEHICLE_TABLE_COLUMNS)
                 .orderBy(F.col("delay_min").desc_nulls_last(), F.col("vehicleId").asc_nulls_last()))


def dash_counters(fleet: DataFrame, kpi: DataFrame) -> DataFrame:
    """All counter widgets: newest time and rows of the current fleet, rows and
    sums of the KPI table.  Each side is one row; both are merged into one."""
    sides = fleet.agg(
        F.max("event_time_local").alias("last_update_local"),
        F.count(F.lit(1)).alias("fleet_rows"),
    ).unionByName(kpi.agg(
        F.count(F.lit(1)).alias("kpi_rows"),
        *[F.sum(n).alias(n) for n in ("active_vehicles", "stopped_vehicles",
                                      "delayed_vehicles", "avg_delay_min")],
    ), allowMissingColumns=True)
    return sides.agg(*[F.max(c).alias(c) for c in sides.columns])


def top_delayed_routes(routes: DataFrame, k: int = 10) -> DataFrame:
    return (routes.orderBy(F.col("avg_delay_min").desc_nulls_last(),
                           F.col("routeId").asc_nulls_last(),
                           F.col("routeShortName").asc_nulls_last(),
                           F.col("transportationType").asc_nulls_last())
                  .limit(k))


def top_destinations(dest: DataFrame, k: int = 10) -> DataFrame:
    return (dest.orderBy(F.col("active_vehicles").desc_nulls_last(),
                         F.col("routeShortName").asc_nulls_last(),
                         F.col("headsign").asc_nulls_last(),
                         F.col("transportationType").asc_nulls_last())
                .limit(k))


def recent_rows(bronze: DataFrame, k: int = 20) -> DataFrame:
    """Newest ingested rows; delivery position breaks ties in a batch."""
    return (bronze.orderBy(F.col("ingestion_ts").desc_nulls_last(),
                           F.col("enqueued_ts").desc_nulls_last(),
                           F.col("partition").desc_nulls_last(),
                           F.col("offset").desc_nulls_last())
                  .limit(k))


def latest_snapshot(readings: DataFrame, col: str = "lastUpdate") -> DataFrame:
    """Rows of the newest snapshot (max ``col``).

    The newest value comes from a global aggregate (one row, combined
    map-side) joined back by broadcast - its size is one row by
    construction - so no single task ever sees the whole table.
    """
    newest = readings.agg(F.max(col).alias("_newest"))
    return readings.join(F.broadcast(newest), F.col(col) == F.col("_newest"), "inner").drop("_newest")


def map_markers(snapshot: DataFrame) -> DataFrame:
    return snapshot.select(
        "lat", "lon",
        marker_color("delay").alias("color"),
        marker_popup("routeShortName", "delay").alias("popup"),
    )


def map_legend(readings: DataFrame, col: str = "lastUpdate") -> DataFrame:
    """Legend of the newest snapshot (max ``col``), in one pass: counts by
    snapshot, combined map-side, then those of the newest.  Zeros without one."""
    by_snapshot = readings.groupBy(col).agg(F.count(F.lit(1)).alias("total"),
                                            F.count_if(F.col("delay") > 120).alias("delayed"))
    newest = by_snapshot.agg(F.max_by(F.struct("total", "delayed"), col).alias("n"))
    total, delayed = (F.coalesce(f"n.{c}", F.lit(0).cast("long")) for c in ("total", "delayed"))
    return newest.select(total.alias("total"), delayed.alias("delayed"), (total - delayed).alias("on_time"))
