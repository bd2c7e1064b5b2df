"""Physical-plan shape: the properties that matter at scale."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from tests.conftest import SF001

PURE_KEYS = ["typed_timestamps", "local_time", "delay_buckets", "status_flags",
             "bbox_filter", "dedup_readings", "silver_clean", "dim_routes", "dim_vehicles", "enrich_routes",
             "enrich_vehicles", "type_normalise", "silver_enriched", "period_summary",
             "route_summary", "delay_distribution", "destination_summary", "fleet_current",
             "live_kpi", "dash_map_points", "dash_vehicle_table", "dash_counters",
             "top_delayed_routes", "top_destinations", "recent_rows", "map_markers",
             "map_legend", "bronze_parse", "publish_payload", "snapshot_name", "roster_preview"]


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("key", PURE_KEYS)
def test_no_python_in_plan(spark, key):
    p = plan(E.queries()[key](spark, SF001))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                 "MapInPandas", "PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in p, f"{key} has {node}"


def test_fleet_current_limits_before_shuffle(spark):
    p = plan(E.queries()["fleet_current"](spark, SF001))
    assert "WindowGroupLimit" in p and "Partial" in p and "Final" in p


def test_reading_dedup_limits_before_shuffle(spark):
    p = plan(E.queries()["dedup_readings"](spark, SF001))
    assert "WindowGroupLimit" in p and "Partial" in p and "Final" in p


def test_enrichment_is_broadcast(spark):
    p = plan(E.queries()["silver_enriched"](spark, SF001))
    assert "BroadcastHashJoin LeftOuter" in p
    assert "SortMergeJoin" not in p


def test_route_summary_avoids_expand(spark):
    p = plan(E.queries()["route_summary"](spark, SF001))
    assert "Expand" not in p
    assert p.count("HashAggregate") >= 4      # partial + final, twice


def test_preview_is_a_bounded_top_n(spark):
    p = plan(E.queries()["roster_preview"](spark, SF001))
    assert "TakeOrderedAndProject" in p and "Exchange" not in p


def test_scan_is_pruned(spark):
    p = plan(E.queries()["snapshot_name"](spark, SF001))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in p


def test_shuffled_enrichment_splits_a_hot_key(spark):
    """One vehicle holds a third of the readings and the vehicle dimension
    is joined by shuffle: AQE must be able to split the hot partition.
    That needs the dimension to reach the join through its own shuffle,
    not through the partitioning of its dedup window."""
    from pyspark.sql import functions as F
    from fleetpulse.operators import clean, enrich
    from fleetpulse.sources import adapters as A
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
                "spark.sql.adaptive.coalescePartitions.enabled": "false",
                "spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    prev = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        feed = A.feed(spark, SF001).repartition(4)       # several map tasks
        hot = feed.withColumn("vehicleCode", F.when(F.col("offset") % 3 == 0,
                                                    F.lit("Customer#000000015"))
                                             .otherwise(F.col("vehicleCode")))
        cleaned = clean.silver_clean(hot)
        out = enrich.enrich_vehicles(cleaned, enrich.dim_vehicles(A.vehicles_bronze(spark, SF001)),
                                     shuffled=True)
        assert len(out.collect()) == cleaned.count()
        assert "SortMergeJoin(skew=true)" in plan(out)   # final adaptive plan
    finally:
        for k, v in prev.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_gold_reads_of_silver_are_pushed_down_and_pruned(spark):
    from fleetpulse.operators import gold
    from fleetpulse.plans.medallion import Store
    from fleetpulse.plans.silver import build_silver
    from fleetpulse.session import scratch_path
    from fleetpulse.sources import adapters as A
    store = Store(root=scratch_path(spark, "pushdown"))
    store.write(build_silver(A.feed(spark, SF001), A.routes_bronze(spark, SF001),
                             A.vehicles_bronze(spark, SF001)), "silver")
    silver = store.read(spark, "silver")
    assert len(silver.columns) == 50
    route = plan(gold.route_summary(silver))
    assert "PushedFilters: [IsNotNull(routeId)]" in route
    dest = plan(gold.destination_summary(silver))
    assert "EqualTo(has_trip,true)" in dest and "IsNotNull(headsign)" in dest
    for p in (route, dest, plan(gold.delay_distribution(silver))):
        schema = next(l for l in p.splitlines() if l.startswith("ReadSchema"))
        fields = schema.split("struct<", 1)[1].count(":")
        assert fields <= 10                     # a handful of the 50 columns
