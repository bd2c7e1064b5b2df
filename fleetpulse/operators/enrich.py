"""Dimension preparation and enrichment joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.functions.scalar import normalise_type
from fleetpulse.operators.dedup import dedup_first
from fleetpulse.schemas import ROUTE_ENRICH_COLUMNS, VEHICLE_ENRICH_COLUMNS

DEFAULT_BROADCAST_MAX_ROWS = 500_000


def _newest_first(df: DataFrame, key: str) -> list:
    order = [F.col(c).desc_nulls_last() for c in ("ingestion_timestamp",) if c in df.columns]
    # remaining columns make the survivor total-ordered (deterministic)
    order += [F.col(c).asc_nulls_last() for c in df.columns if c != key]
    return order


def dim_routes(routes: DataFrame) -> DataFrame:
    """Route enrichment columns, one row per ``gtfs_route_id``."""
    src = routes.select(*[c for c in ROUTE_ENRICH_COLUMNS]
                        + [c for c in ("ingestion_timestamp",) if c in routes.columns])
    src = src.withColumnRenamed("route_id", "gtfs_route_id")
    # own_exchange: a shuffle join against the dimension can split hot keys
    out = dedup_first(src, ["gtfs_route_id"], _newest_first(src, "gtfs_route_id"),
                      own_exchange=True)
    return out.select("gtfs_route_id", "route_type", "route_color", "route_text_color")


def dim_vehicles(vehicles: DataFrame) -> DataFrame:
    """Vehicle enrichment columns (``carrirer`` -> ``carrier``), one row per
    ``vehicleCode``."""
    keep = [c for c in VEHICLE_ENRICH_COLUMNS]
    src = vehicles.select(*keep, *[c for c in ("ingestion_timestamp",) if c in vehicles.columns])
    src = src.withColumnRenamed("carrirer", "carrier")
    out = dedup_first(src, ["vehicleCode"], _newest_first(src, "vehicleCode"),
                      own_exchange=True)
    return out.select(*[("carrier" if c == "carrirer" else c) for c in keep])


# Broadcast bounds: rows, and bytes as measured by the JSON text of each row
# (field names included, so it over-states the in-memory row size).
DEFAULT_BROADCAST_MAX_BYTES = 256 * 1024 * 1024

# (plan hash, input files, bounds) -> proven small?  A proof is reused only
# for the same plan over the same files; appended files force a new check.
_PROOFS: dict[tuple, bool] = {}


def is_bounded(df: DataFrame, max_rows: int,
               max_bytes: int = DEFAULT_BROADCAST_MAX_BYTES) -> bool:
    """True when ``df`` provably holds at most ``max_rows`` rows and about
    ``max_bytes`` bytes.

    A plain aggregate: each task sends one row (count, summed row size), so
    no rows are gathered in one place to learn that a table is too big.
    """
    try:
        key = (df.semanticHash(), tuple(sorted(df.inputFiles())), max_rows, max_bytes)
    except Exception:  # noqa: BLE001 - e.g. local relations without files
        key = None
    if key is not None and key in _PROOFS:
        return _PROOFS[key]
    probe = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.octet_length(F.to_json(F.struct(*df.columns)))).alias("b")).first()
    ok = probe["n"] <= max_rows and (probe["b"] or 0) <= max_bytes
    if key is not None:
        _PROOFS[key] = ok
    return ok


def left_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
              shuffled: bool) -> DataFrame:
    """Left equi-join on one key; ``right_key`` is kept when named apart.

    For a shuffle join, rows with a NULL ``left_key`` - which can never
    match - bypass the join and get NULL right-hand columns.  Otherwise all
    of them would hash to one reducer (one "key" may hold a third of the
    readings).  A hot non-NULL key is split by AQE's skew-join handling,
    which works because the dimensions reach the join through their own
    shuffle (``dedup_first(.., own_exchange=True)``).
    """
    same = left_key == right_key
    if same:
        def join(l):
            return l.join(right, on=left_key, how="left")
    else:
        def join(l):
            return l.join(right, l[left_key] == right[right_key], "left")
    if not shuffled:
        return join(left)
    matched = join(left.filter(F.col(left_key).isNotNull()))
    missing = left.filter(F.col(left_key).isNull())
    for f in right.schema.fields:
        if not (same and f.name == right_key):
            missing = missing.withColumn(f.name, F.lit(None).cast(f.dataType))
    return matched.unionByName(missing.select(*matched.columns))


def enrich_routes(silver: DataFrame, routes_dim: DataFrame, shuffled: bool = False) -> DataFrame:
    return left_join(silver, routes_dim, "routeId", "gtfs_route_id", shuffled).drop("gtfs_route_id")


def enrich_vehicles(df: DataFrame, vehicles_dim: DataFrame, shuffled: bool = False) -> DataFrame:
    return left_join(df, vehicles_dim, "vehicleCode", "vehicleCode", shuffled)


def prepared_dim(dim: DataFrame, source: DataFrame, max_rows: int) -> tuple[DataFrame, bool]:
    """(dimension, shuffled?): broadcast when proven small, else shuffle.

    The proof runs on the un-deduplicated source, whose size bounds the
    dimension's; AQE may still turn the shuffle join into a broadcast from
    measured sizes.
    """
    if is_bounded(source, max_rows):
        return F.broadcast(dim), False
    return dim, True


def enrich(silver: DataFrame, routes: DataFrame, vehicles: DataFrame,
           max_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """Both left joins (row preserving: dims are unique on their keys) and
    the vehicle-type normalisation."""
    r, r_shuf = prepared_dim(dim_routes(routes), routes, max_rows)
    v, v_shuf = prepared_dim(dim_vehicles(vehicles), vehicles, max_rows)
    out = enrich_vehicles(enrich_routes(silver, r, r_shuf), v, v_shuf)
    return out.withColumn("transportationType", normalise_type("transportationType"))
