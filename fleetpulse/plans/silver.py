"""Bronze + reference tables -> enriched silver."""

from __future__ import annotations

from pyspark.sql import DataFrame

from fleetpulse.operators.clean import silver_clean
from fleetpulse.operators.enrich import DEFAULT_BROADCAST_MAX_ROWS, enrich


def build_silver(bronze: DataFrame, routes: DataFrame, vehicles: DataFrame,
                 tz: str = "Europe/Warsaw",
                 broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS) -> DataFrame:
    """The 50-column silver table: cleaned readings + route + vehicle columns."""
    return enrich(silver_clean(bronze, tz), routes, vehicles, broadcast_max_rows)
