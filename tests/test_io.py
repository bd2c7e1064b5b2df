"""Reference loads, merges, catalog handling, payloads."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetpulse.config import ReferenceSpec
from fleetpulse.schemas import GTFS_SCHEMAS
from fleetpulse.session import local_path, scratch_path
from fleetpulse.sources import reference as R
from fleetpulse.sources.events import to_payload
from fleetpulse.plans.medallion import GOLD_TABLES, Store, run_medallion
from fleetpulse.sources import adapters as A
from tests.conftest import SF001, SF01


def _write_text(spark, name, text):
    path = local_path(scratch_path(spark, name))
    import os
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part.txt"), "w") as f:
        f.write(text)
    return path


def test_csv_inference_vs_explicit_schema(spark):          # SRC3, hard part 7
    path = _write_text(spark, "routes-csv",
                       "route_id,agency_id,route_short_name,route_type,route_color,route_text_color\n"
                       "6,1,6,0,001122,FFFFFF\n")
    inferred = R.read_reference(spark, path, ReferenceSpec("routes.txt", "t", ("route_id",)))
    assert inferred.first()["route_color"] == 1122           # zeros lost by inference
    fixed = R.read_reference(spark, path, ReferenceSpec("routes.txt", "t", ("route_id",),
                                                        schema=GTFS_SCHEMAS["routes.txt"]))
    row = fixed.first()
    assert row["route_color"] == "001122" and row["route_id"] == 6


def test_gtfs_after_midnight_time_kept(spark):
    path = _write_text(spark, "stop-times",
                       "trip_id,arrival_time,departure_time,stop_id,stop_sequence\nT1,25:10:00,25:11:00,S1,3\n")
    df = R.read_reference(spark, path, ReferenceSpec("stop_times.txt", "t", ("trip_id", "stop_sequence"),
                                                     schema=GTFS_SCHEMAS["stop_times.txt"]))
    assert df.first()["arrival_time"] == "25:10:00"


def test_json_roster_inferred(spark):                        # SRC4
    path = _write_text(spark, "roster", "\n".join(json.dumps(
        {"vehicleCode": f"V{i}", "transportationType": "Autobus", "seats": i}) for i in range(3)))
    df = R.read_reference(spark, path, ReferenceSpec("vehicles.json", "t", ("vehicleCode",),
                                                     fmt="json", options={"multiLine": "false"}))
    assert df.count() == 3 and dict(df.dtypes)["seats"] == "bigint"


def test_catalog_create_then_merge(spark):                   # SRC6, SNK3, SNK4, SNK8, SNK9
    spark.sql("CREATE DATABASE IF NOT EXISTS fleet_t")
    spark.sql("DROP TABLE IF EXISTS fleet_t.routes")
    a = spark.createDataFrame([(1, "a"), (None, "n")], "route_id int, v string")
    b = spark.createDataFrame([(1, "changed"), (2, "b"), (None, "n2")], "route_id int, v string")
    assert R.insert_only_merge(spark, a, "fleet_t.routes", ["route_id"]) == "created"
    assert spark.catalog.tableExists("fleet_t.routes")
    assert R.insert_only_merge(spark, b, "fleet_t.routes", ["route_id"]) == "merged"
    got = sorted((r[0] if r[0] is not None else -1, r[1])
                 for r in spark.table("fleet_t.routes").collect())
    # key 1 keeps its first value; NULL keys never match and are inserted again
    assert got == [(-1, "n"), (-1, "n2"), (1, "a"), (2, "b")]
    spark.sql("DROP TABLE IF EXISTS fleet_t.routes")
    assert not spark.catalog.tableExists("fleet_t.routes")


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 20), st.text("ab", max_size=2)), max_size=15))
def test_merge_twice_is_noop(spark, data):                   # property, V16
    src = spark.createDataFrame(data, "k int, v string")
    target = R.PATH_PREFIX + scratch_path(spark, "prop-merge")
    R.insert_only_merge(spark, src, target, ["k"])
    first = sorted(R.read_target(spark, target).collect())
    R.insert_only_merge(spark, src, target, ["k"])
    assert sorted(R.read_target(spark, target).collect()) == first


def test_load_report_counts(spark):                          # SNK10
    df = R.load_report(spark, {"a": spark.range(3), "b": spark.range(0)})
    assert sorted(tuple(r) for r in df.collect()) == [("a", 3), ("b", 0)]


def test_payload_keeps_nulls(spark):                          # SNK7, FN2
    df = spark.createDataFrame([(1, None)], "tripId int, headsign string")
    assert to_payload(df).first()["value"] == '{"tripId":1,"headsign":null}'


def test_medallion_chain_to_tables(spark):                    # JOB3-5, SNK5
    spark.sql("CREATE DATABASE IF NOT EXISTS fleet_gold")
    counts = run_medallion(spark, A.feed(spark, SF001), A.routes_bronze(spark, SF001),
                           A.vehicles_bronze(spark, SF001), Store(database="fleet_gold"))
    assert set(GOLD_TABLES) <= set(counts)
    assert counts["gold_live_kpi"] == 1 and counts["gold_period_summary"] == 1
    assert counts["gold_fleet_current"] == spark.table("fleet_gold.gps_positions_silver") \
        .select("vehicleId").distinct().count()
    assert len(spark.table("fleet_gold.gps_positions_silver").columns) == 50
    # a rerun overwrites (schema included) instead of appending
    again = run_medallion(spark, A.feed(spark, SF001), A.routes_bronze(spark, SF001),
                          A.vehicles_bronze(spark, SF001), Store(database="fleet_gold"))
    assert again == counts


def test_preview_sql_with_order(spark):                        # PRJ10, LIM1, SNK11
    spark.sql("CREATE DATABASE IF NOT EXISTS fleet_v")
    A.vehicles_bronze(spark, SF001).write.mode("overwrite").saveAsTable("fleet_v.bronze_vehicles")
    prev = spark.sql("""SELECT vehicleCode, transportationType, brand, model, productionYear,
                               seats, standingPlaces, floorHeight, source_file
                        FROM fleet_v.bronze_vehicles ORDER BY vehicleCode LIMIT 20""")
    rows = prev.collect()
    assert len(rows) == 20 and [r[0] for r in rows] == sorted(r[0] for r in rows)
    assert spark.table("fleet_v.bronze_vehicles").filter(F.col("vehicleCode").isNull()).count() == 0


def test_run_chain_from_landing(spark):                        # JOB5, SRC10
    from fleetpulse.config import PipelineConfig
    from fleetpulse.plans.medallion import dashboard_dataset, run_chain
    from fleetpulse.schemas import EVENT_V1
    from fleetpulse.streaming.ingest import land
    root = scratch_path(spark, "chain")
    cfg = PipelineConfig(source="files", landing_path=f"{root}/landing",
                         bronze_path=f"{root}/bronze", checkpoint_path=f"{root}/ckpt")
    store = Store(root=f"{root}/tables")
    store.write(A.routes_bronze(spark, SF001), cfg.routes_table)
    store.write(A.vehicles_bronze(spark, SF001), cfg.vehicles_table)
    land(A.feed(spark, SF001), cfg.landing_path, EVENT_V1.fieldNames())
    counts = run_chain(spark, cfg, store)
    batch = run_medallion(spark, A.feed(spark, SF001), A.routes_bronze(spark, SF001),
                          A.vehicles_bronze(spark, SF001), Store(root=f"{root}/batch"))
    assert counts == batch
    assert dashboard_dataset(spark, store, "gold_live_kpi").count() == 1


def test_kafka_options_from_config():                        # SRC1, SRC1b, JOB6
    from fleetpulse.config import PipelineConfig
    from fleetpulse.sources.kafka import kafka_options
    base = dict(source="kafka", kafka_bootstrap="broker:9093", kafka_topic="vehicle-positions")
    opts = kafka_options(PipelineConfig(**base, kafka_security_protocol="SASL_SSL",
                                        kafka_sasl_mechanism="PLAIN"))
    assert opts == {"kafka.bootstrap.servers": "broker:9093", "subscribe": "vehicle-positions",
                    "startingOffsets": "earliest", "failOnDataLoss": "false",
                    "kafka.security.protocol": "SASL_SSL", "kafka.sasl.mechanism": "PLAIN"}
    late = kafka_options(PipelineConfig(**base, starting_offsets="latest", kafka_group_id="g1",
                                        kafka_min_partitions=4096))
    assert late["startingOffsets"] == "latest" and late["kafka.group.id"] == "g1"
    assert late["minPartitions"] == "4096"
    with pytest.raises(ValueError):
        kafka_options(PipelineConfig(source="kafka"))


def test_incremental_gold_equals_batch(spark):                  # JOB4 at scale
    from fleetpulse.operators import gold
    from fleetpulse.plans.medallion import refresh_gold
    from fleetpulse.plans.silver import build_silver
    silver = build_silver(A.feed(spark, SF001), A.routes_bronze(spark, SF001),
                          A.vehicles_bronze(spark, SF001))
    store = Store(root=scratch_path(spark, "incremental-test"))
    day = F.dayofmonth("event_time")
    # three disjoint runs, the second and the last one repeated
    for n, lo, hi in ((0, 1, 10), (1, 11, 20), (1, 11, 20), (2, 21, 31), (2, 21, 31)):
        refresh_gold(spark, silver.filter(day.between(lo, hi)), store, n)
    for table in gold.PARTIAL_SPECS:
        want = getattr(gold, table)(silver)
        got = store.read(spark, f"gold_{table}").select(*want.columns)
        rows = lambda df: sorted(map(tuple, df.collect()), key=repr)  # noqa: E731 - NULLs sort too
        assert rows(got) == rows(want), table
    with pytest.raises(ValueError):
        refresh_gold(spark, silver, store, 1)


@pytest.mark.parametrize("catalog", [False, True])
def test_killed_refresh_leaves_the_old_tables(spark, monkeypatch, catalog):      # JOB4
    """A refresh that fails after the partials but before the summary, or
    before the record, changes nothing that is read, and can be run again."""
    from fleetpulse.operators import gold
    from fleetpulse.plans.medallion import refresh_gold
    from fleetpulse.plans.silver import build_silver
    silver = build_silver(A.feed(spark, SF001), A.routes_bronze(spark, SF001),
                          A.vehicles_bronze(spark, SF001)).persist()
    if catalog:
        spark.sql("DROP DATABASE IF EXISTS fleet_killed CASCADE")
        spark.sql(f"CREATE DATABASE fleet_killed LOCATION '{scratch_path(spark, 'killed')}'")
        store = Store(database="fleet_killed")
    else:
        store = Store(root=scratch_path(spark, "killed"))
    read = lambda: (spark.table("fleet_killed.gold_route_summary") if catalog
                    else store.read(spark, "gold_route_summary"))
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    parts = [silver.filter(f"offset % 3 = {n}") for n in range(3)]
    upto = lambda n: gold.route_summary(silver.filter(f"offset % 3 <= {n}"))
    save = Store._save
    for n in range(3):
        for at in (1, 2):                                   # before the summary, before the record
            writes = []

            def failing(self, df, name):
                writes.append(name)
                if len(writes) > at:
                    raise RuntimeError("lost")
                save(self, df, name)

            monkeypatch.setattr(Store, "_save", failing)
            monkeypatch.setattr(Store, "switch", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
            with pytest.raises(RuntimeError):
                refresh_gold(spark, parts[n], store, n, ("route_summary",))
            monkeypatch.undo()
            if n:
                assert rows(read()) == rows(upto(n - 1))
        refresh_gold(spark, parts[n], store, n, ("route_summary",))
        assert rows(read()) == rows(upto(n))
    silver.unpersist()


def test_approximate_summaries(spark):                          # AF1, AF2
    """Sketched vehicle counts stay near the exact ones over several batches,
    and everything else is exact."""
    from fleetpulse.operators import gold
    from fleetpulse.plans.medallion import refresh_gold
    from fleetpulse.plans.silver import build_silver
    silver = build_silver(A.feed(spark, SF01), A.routes_bronze(spark, SF01), A.vehicles_bronze(spark, SF01)).persist()
    store = Store(root=scratch_path(spark, "sketches"))
    for n in (0, 1, 1, 2):
        refresh_gold(spark, silver.filter(f"offset % 3 = {n}"), store, n, approximate=True)
    for table, (keys, _, _) in gold.PARTIAL_SPECS.items():
        exact = getattr(gold, table)(silver)
        got = store.read(spark, f"gold_{table}")
        assert got.columns == exact.columns
        key = lambda r: repr(tuple(r[k] for k in keys))
        both = list(zip(sorted(exact.collect(), key=key), sorted(got.collect(), key=key)))
        assert len(both) == exact.count() == got.count()
        for a, b in both:
            for c in exact.columns:
                if c.endswith("vehicles") or c == "vehicles_count":
                    assert abs(a[c] - b[c]) <= 3 * gold.SKETCH_ERROR * a[c] + 0.5, (table, c)
                else:
                    assert a[c] == b[c], (table, c)
        # one partial per group, whatever the fleet
        assert store.read(spark, f"{table}_partials").count() == exact.count()
    silver.unpersist()


def test_unreadable_target_is_not_missing(spark, tmp_path):
    """A merge raises on a damaged target and leaves its files alone."""
    from fleetpulse.sources import reference as R
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string").coalesce(1)
    assert R.insert_only_merge(spark, rows, f"{R.PATH_PREFIX}{path}", ["k"]) == "created"
    part = next((tmp_path / "t").glob("part-*"))
    part.write_bytes(part.read_bytes()[:20])
    with pytest.raises(Exception):
        R.insert_only_merge(spark, rows.limit(1), f"{R.PATH_PREFIX}{path}", ["k"])
    assert [p.stat().st_size for p in (tmp_path / "t").glob("part-*")] == [20]


def test_csv_goes_by_header(spark, tmp_path):
    """Extra and reordered columns: names decide, unknown ones stay text."""
    from fleetpulse.config import GTFS_SPECS
    from fleetpulse.sources.reference import read_reference
    file = tmp_path / "routes.txt"
    file.write_text("route_color,route_desc,route_id,route_type,route_url\n001122,x,7,3,007\n")
    row = read_reference(spark, str(file), GTFS_SPECS[0]).first()
    assert (row.route_id, row.route_type, row.route_color, row.route_desc, row.route_url) == (7, 3, "001122", "x", "007")
    assert row.agency_id is None and row.route_text_color is None


def test_small_negative_mean_is_plain_zero(spark):
    from fleetpulse.functions.aggregates import round_mean_tenths_2dp
    x = spark.sql("SELECT -1L s, 1000L n UNION ALL SELECT -15L, 10L").select(
        round_mean_tenths_2dp(F.col("s"), F.col("n")).alias("m")).collect()
    assert [str(r.m) for r in x] == ["0.0", "-0.15"]


def test_merge_reads_only_touched_parts(spark):                 # SNK4, JON3
    """A target laid out by key: the scan of a merge is cut to the parts of the
    load's keys; NULL and composite keys behave as without parts."""
    target = R.PATH_PREFIX + scratch_path(spark, "parts")
    keys = ["a", "b"]
    first = spark.range(500).selectExpr("CAST(id AS INT) a", "CAST(id % 7 AS STRING) b", "'old' v")
    nulls = spark.createDataFrame([(None, "x", "n"), (3, None, "n")], "a int, b string, v string")
    assert R.insert_only_merge(spark, first.union(nulls), target, keys, parts=8) == "created"
    # the same keys as another type
    load = spark.createDataFrame([(3, "3", "new"), (900, "x", "new"), (None, "x", "n2")], "a long, b string, v string")
    held, cut = R.touched_parts(R._read(spark, target), load, keys)
    parts = {r[0] for r in cut.select("_key_part_8").distinct().collect()}
    assert len(parts) < 8 and {r[0] for r in held.select("_key_part_8").distinct().collect()} == parts
    text = held._jdf.queryExecution().executedPlan().toString()
    assert any("PartitionFilters" in x and "_key_part_8" in x for x in text.splitlines())
    assert R.insert_only_merge(spark, load, target, keys) == "merged"
    out = R.read_target(spark, target)
    assert out.columns == ["a", "b", "v"] and out.count() == 504
    assert {tuple(r) for r in out.filter("v <> 'old'").collect()} == {(None, "x", "n"), (3, None, "n"), (900, "x", "new"), (None, "x", "n2")}
    # the same rows as a target without parts
    plain = R.PATH_PREFIX + scratch_path(spark, "no-parts")
    R.insert_only_merge(spark, first.union(nulls), plain, keys)
    R.insert_only_merge(spark, load, plain, keys)
    assert sorted(map(repr, R.read_target(spark, plain).collect())) == sorted(map(repr, out.collect()))


def test_merge_gathers_no_table_in_the_driver(spark):           # F1
    """The target's keys are not broadcast, however small their files are."""
    target = scratch_path(spark, "repeated")
    held = spark.range(100_000).selectExpr("CAST(id % 3 AS STRING) a", "CAST(id % 2 AS INT) b")
    held.union(spark.createDataFrame([(None, 1)], held.schema)).write.parquet(target)
    load = spark.createDataFrame([("0", 0), ("7", 0), (None, 1)], held.schema)
    fresh = R.new_rows(load, spark.read.parquet(target), ["a", "b"])
    assert "Broadcast" not in fresh._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(repr, fresh.collect())) == ["Row(a='7', b=0)", "Row(a=None, b=1)"]


def test_merge_keeps_the_types_of_the_target(spark):
    """Every file of a target has its column types, whatever a load's types are."""
    target = R.PATH_PREFIX + scratch_path(spark, "types")
    R.insert_only_merge(spark, spark.createDataFrame([(1, "a")], "k int, v string"), target, ["k"])
    R.insert_only_merge(spark, spark.createDataFrame([(1, "b"), (2, "c")], "k long, v string"), target, ["k"])
    for f in spark.read.parquet(target[len(R.PATH_PREFIX):]).inputFiles():
        assert spark.read.parquet(f).schema.simpleString() == "struct<k:int,v:string>"
    assert {tuple(r) for r in R.read_target(spark, target).collect()} == {(1, "a"), (2, "c")}


def test_snapshot_lines_and_newest(spark):                      # SNK6, SRC7
    """One vehicle on each line with its lastUpdate; the newest snapshot is
    the one that arrived last, whatever the times of its files."""
    import os
    from fleetpulse.schemas import EVENT_V1
    from fleetpulse.sources import events as EV
    path = scratch_path(spark, "snaps")
    assert EV.newest_snapshot(spark, path) is None
    feed = A.feed(spark, SF001)
    hours = [r[0] for r in feed.select("lastUpdate").distinct().orderBy("lastUpdate").limit(3).collect()]
    # the middle one arrives last
    for n in (0, 2, 1):
        EV.land_snapshots(feed.filter(F.col("lastUpdate") == hours[n]), path)
    files = f"{local_path(path)}/files"
    for folder in os.listdir(files):
        if folder.startswith("snapshot="):
            for name in os.listdir(f"{files}/{folder}"):
                os.utime(f"{files}/{folder}/{name}", (1, 1))
                if name.endswith(".json"):
                    for line in open(f"{files}/{folder}/{name}"):
                        one = json.loads(line)
                        assert set(one) == set(EVENT_V1.fieldNames()) and one["lastUpdate"] in hours
    newest = EV.newest_snapshot(spark, path)
    want = feed.filter(F.col("lastUpdate") == hours[1]).select(*EVENT_V1.fieldNames())
    assert sorted(map(repr, newest.select(*want.columns).collect())) == sorted(map(repr, want.collect()))
    assert all("snapshot=gps_" in f for f in newest.inputFiles())


def test_map_legend_in_one_pass(spark):                         # AGG11
    from fleetpulse.operators import serving
    feed = A.feed(spark, SF001)
    plan = serving.map_legend(feed)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert tuple(serving.map_legend(feed.limit(0)).first()) == (0, 0, 0)


def test_pages_are_bounded_for_every_partition(spark):
    """Offsets count within a broker partition, so pages are cut in each."""
    from fleetpulse.sources import events as EV
    rows = spark.range(1000).selectExpr("CAST(id AS INT) vehicleId", "'2024-01-01T00:00:00Z' lastUpdate",
                                        "CAST(id % 4 AS INT) `partition`", "id DIV 4 `offset`")
    pages = EV.nest_snapshots(rows, 50).selectExpr("size(vehicles) n").collect()
    assert max(r.n for r in pages) == 50 and sum(r.n for r in pages) == 1000
