"""Job parameters (catalog, schema, source, checkpoints, offsets)."""

from __future__ import annotations

from dataclasses import dataclass, field

from fleetpulse.operators.enrich import DEFAULT_BROADCAST_MAX_ROWS
from fleetpulse.schemas import GTFS_SCHEMAS, ROSTER_SCHEMA


@dataclass(frozen=True)
class PipelineConfig:
    """Everything a pipeline run needs, passed explicitly.

    ``source`` is ``"kafka"`` in production and ``"files"`` for a landing
    folder of Kafka-shaped envelope records (tests, replays).
    """

    database: str = "fleet"
    bronze_table: str = "gps_data"
    silver_table: str = "gps_positions_silver"
    routes_table: str = "bronze_gtfs_routes"
    vehicles_table: str = "bronze_vehicles"
    source: str = "files"
    source_tag: str = "stream"
    landing_path: str | None = None
    bronze_path: str | None = None       # None: the catalog table bronze_table
    checkpoint_path: str | None = None
    # Kafka endpoint; credentials come from the caller, never from code.
    kafka_bootstrap: str | None = None
    kafka_topic: str | None = None
    kafka_group_id: str | None = None
    kafka_security_protocol: str | None = None
    kafka_sasl_mechanism: str | None = None
    kafka_jaas_config: str | None = None
    starting_offsets: str = "earliest"
    fail_on_data_loss: bool = False
    max_offsets_per_trigger: int | None = None
    # read at least this many Spark tasks per batch: a hot topic partition
    # is split into several offset ranges instead of one task
    kafka_min_partitions: int | None = None
    trigger_interval: str | None = None   # None = availableNow drain
    local_tz: str = "Europe/Warsaw"
    broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS

    def table(self, name: str) -> str:
        return f"{self.database}.{name}" if self.database else name


@dataclass(frozen=True)
class ReferenceSpec:
    """One reference file and its target table and natural key."""

    file_name: str
    table: str
    keys: tuple[str, ...]
    fmt: str = "csv"
    schema: str | None = None          # DDL of known columns; None = infer
    parts: int | None = None           # lay a new target out by this many parts of its key
    options: dict[str, str] = field(default_factory=dict)


# The public transit feed files loaded by the reference job,
# their target tables and merge keys.
GTFS_SPECS = (
    ReferenceSpec("routes.txt", "bronze_gtfs_routes", ("route_id",), schema=GTFS_SCHEMAS["routes.txt"]),
    ReferenceSpec("stops.txt", "bronze_gtfs_stops", ("stop_id",), schema=GTFS_SCHEMAS["stops.txt"]),
    ReferenceSpec("trips.txt", "bronze_gtfs_trips", ("trip_id",), schema=GTFS_SCHEMAS["trips.txt"]),
    ReferenceSpec("stop_times.txt", "bronze_gtfs_stop_times", ("trip_id", "stop_sequence"),
                  schema=GTFS_SCHEMAS["stop_times.txt"]),
    ReferenceSpec("calendar_dates.txt", "bronze_gtfs_calendar_dates", ("service_id", "date"), schema=GTFS_SCHEMAS["calendar_dates.txt"]),
    ReferenceSpec("agency.txt", "bronze_gtfs_agency", ("agency_id",), schema=GTFS_SCHEMAS["agency.txt"]),
)
VEHICLES_SPEC = ReferenceSpec("vehicles.json", "bronze_vehicles", ("vehicleCode",), fmt="json",
                              schema=ROSTER_SCHEMA, options={"multiLine": "false"})
