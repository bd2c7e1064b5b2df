"""Structured Streaming: restart, schema evolution, incremental twins."""

import time
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from fleetpulse.config import PipelineConfig
from fleetpulse.schemas import EVENT_V1, EVENT_V2
from fleetpulse.session import scratch_path
from fleetpulse.sources import adapters as A
from fleetpulse.sources.events import parse_events
from fleetpulse.streaming import incremental as INC
from fleetpulse.streaming.ingest import bronze_rows, drain, land, read_bronze, start_ingest
from tests.conftest import SF001


def cfg(spark, name, **kw):
    root = scratch_path(spark, name)
    return PipelineConfig(source="files", landing_path=f"{root}/landing",
                          bronze_path=f"{root}/bronze", checkpoint_path=f"{root}/ckpt", **kw)


def test_restart_adds_nothing_then_new_files(spark):           # STR2, STR4
    c = cfg(spark, "restart")
    feed = A.feed(spark, SF001)
    early = feed.filter(F.col("enqueued_ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
    late = feed.filter(F.col("enqueued_ts") >= F.lit("2024-01-16").cast("timestamp_ntz"))
    land(early, c.landing_path, EVENT_V1.fieldNames())
    drain(start_ingest(spark, c))
    n1 = read_bronze(spark, c.bronze_path).count()
    drain(start_ingest(spark, c))
    assert read_bronze(spark, c.bronze_path).count() == n1 == early.count()
    land(late, c.landing_path, EVENT_V1.fieldNames())
    drain(start_ingest(spark, c))
    assert read_bronze(spark, c.bronze_path).count() == feed.count()


def test_schema_evolution_same_checkpoint(spark):              # SNK2, STR6
    c = cfg(spark, "evolve")
    v1 = A.feed(spark, SF001, version=1).limit(50)
    v2 = A.feed(spark, SF001, version=2).filter(F.col("offset") >= 50)
    land(v1, c.landing_path, EVENT_V1.fieldNames())
    drain(start_ingest(spark, c, EVENT_V1))
    assert "occupancy" not in read_bronze(spark, c.bronze_path).columns
    land(v2, c.landing_path, EVENT_V2.fieldNames())
    drain(start_ingest(spark, c, EVENT_V2))
    out = read_bronze(spark, c.bronze_path)
    assert "occupancy" in out.columns
    assert out.filter(F.col("occupancy").isNull()).count() == 50
    assert out.filter(F.col("occupancy").isNotNull()).count() == v2.count()
    # the same rows with the contract's schema given, no footer merge
    typed = read_bronze(spark, c.bronze_path, EVENT_V2)
    assert typed.schema == out.select(*typed.columns).schema
    assert sorted(map(tuple, typed.collect())) == sorted(map(tuple, out.select(*typed.columns).collect()))


def test_processing_time_trigger_runs_and_stops(spark):         # STR3, STR5
    c = cfg(spark, "continuous", trigger_interval="1 second")
    land(A.feed(spark, SF001).limit(20), c.landing_path, EVENT_V1.fieldNames())
    q = start_ingest(spark, c)
    try:
        deadline = time.time() + 60
        while time.time() < deadline and (q.lastProgress is None
                                          or q.lastProgress["numInputRows"] == 0):
            time.sleep(0.5)
        q.processAllAvailable()
    finally:
        q.stop()
    assert read_bronze(spark, c.bronze_path).count() == 20


def test_stream_latest_equals_batch(spark):                     # STV1-3; the oracle tests run the other twins
    import __spark_entry__ as E
    qs = E.queries()
    s, b = qs["stream_fleet_current"](spark, SF001), qs["fleet_current"](spark, SF001)
    assert sorted(s.collect()) == sorted(b.select(*s.columns).collect())


ROW = dict(generated="2024-01-05T10:00:00Z", routeShortName="1", tripId=1, routeId=1, headsign="x", vehicleCode="V1",
           vehicleService="s", vehicleId=1, speed=5, direction=0, delay=10, scheduledTripStartTime=None,
           lat=54.3, lon=18.6, gpsQuality=1, lastUpdate="2024-01-05T10:00:00Z")


def envelope(spark, rows):
    """Landing records of (changes to ROW, offset, delivery second)."""
    import json
    from fleetpulse.schemas import ENVELOPE_TEXT
    return spark.createDataFrame(
        [(json.dumps({**ROW, **change}), 0, offset, datetime.fromtimestamp(1704448800 + second, timezone.utc))
         for change, offset, second in rows], ENVELOPE_TEXT)


OUT = {"lat": 0.0, "lon": 0.0}
LATER = {"generated": "2024-01-05T10:01:00Z"}
# Landings that differ from the order of delivery, and what becomes current.
ORDERS = [
    # all outside at first, then a normal reading
    [[(OUT, 1, 0)], [(LATER, 2, 60)]],
    # the first delivered copy lies outside and lands first: it wins
    [[(OUT, 1, 0)], [({}, 2, 5)], [(LATER, 3, 60)]],
    # the first delivered copy lies outside and lands last: it replaces the other
    [[({}, 2, 5), (LATER, 3, 60)], [(OUT, 1, 0)]],
    # an earlier delivered copy inside replaces the latest position of its vehicle
    [[({"delay": 99, **LATER}, 5, 90), ({}, 1, 0)], [({"delay": 7, **LATER}, 2, 60)]],
    # the replacement lies outside: the vehicle falls back to its earlier reading
    [[({}, 1, 0)], [(LATER, 5, 90)], [({**OUT, **LATER}, 2, 60)]],
    # three copies, each earlier than the one before, over two vehicles and a clock of 1970
    [[({"delay": 3}, 9, 30), ({"vehicleId": 2}, 10, 31)], [({"delay": 2}, 8, 20)], [({"delay": 1}, 7, 10)],
     [({"generated": "1970-01-01T00:00:00Z", "vehicleId": 2}, 11, 40)]],
    # readings without a time or a vehicle
    [[({"generated": "bad"}, 2, 5), ({"vehicleId": None}, 3, 6)], [({"generated": "worse"}, 1, 0)],
     [({"vehicleId": None, "delay": 5}, 4, 1)]],
]


def all_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def apart(orders):
    """Several orders of landings as one, each with vehicles of its own."""
    out = [[] for _ in range(max(map(len, orders)))]
    for n, landings in enumerate(orders):
        for part, rows in zip(out, landings):
            for change, offset, second in rows:
                vehicle = change.get("vehicleId", 1)
                own = {} if vehicle is None else {"vehicleId": 100 * n + vehicle}
                part.append(({**change, **own}, 100 * n + offset, second))
    return out


@pytest.mark.parametrize("landings", [ORDERS[0], apart(ORDERS[1:])])
def test_silver_batches_equal_rebuild(spark, landings):
    """Silver and latest positions after all batches equal a rebuild."""
    from fleetpulse.operators import gold
    from fleetpulse.plans.silver import build_silver
    store = INC.SilverStore(scratch_path(spark, "orders"))
    routes, vehicles = A.routes_bronze(spark, SF001), A.vehicles_bronze(spark, SF001)
    for n, part in enumerate(landings):
        INC.take_batch(bronze_of(spark, part), n, store, lambda s: (routes, vehicles))
    whole = build_silver(bronze_of(spark, *landings), routes, vehicles).drop("ingestion_ts")
    got = INC.read_silver(spark, store).drop("ingestion_ts", "event_date")
    assert got.columns == whole.columns and all_rows(got) == all_rows(whole)
    assert all_rows(INC.read_latest(spark, store)) == all_rows(gold.fleet_current(whole))


def test_chain_follows_replaced_rows(spark):                    # JOB3, JOB4
    """Gold tables of a chain whose last landing replaces earlier winners."""
    from fleetpulse.operators import gold
    from fleetpulse.plans.medallion import Store, chain_silver, run_chain
    from fleetpulse.plans.silver import build_silver
    c = cfg(spark, "orders")
    store = Store(root=scratch_path(spark, "orders-tables"))
    routes, vehicles = A.routes_bronze(spark, SF001), A.vehicles_bronze(spark, SF001)
    store.write(routes, c.routes_table)
    store.write(vehicles, c.vehicles_table)
    for part in ([({}, 1, 0), ({"vehicleId": 2, "delay": 500}, 6, 9)],
                 [(LATER, 5, 90)], [({**OUT, **LATER}, 2, 60), ({"vehicleId": 2}, 3, 8)]):
        envelope(spark, part).coalesce(1).write.mode("append").parquet(c.landing_path)
        run_chain(spark, c, store)
    whole = build_silver(read_bronze(spark, c.bronze_path, EVENT_V1), routes, vehicles)
    assert sorted(r.offset for r in chain_silver(spark, c, store).collect()) == [1, 3]
    fleet = gold.fleet_current(whole)
    assert all_rows(store.read(spark, "gold_fleet_current")) == all_rows(fleet)
    assert all_rows(store.read(spark, "gold_live_kpi")) == all_rows(gold.live_kpi(fleet))
    for table in gold.PARTIAL_SPECS:
        assert all_rows(store.read(spark, f"gold_{table}")) == all_rows(getattr(gold, table)(whole)), table


def bronze_of(spark, *parts):
    return parse_events(envelope(spark, [r for p in parts for r in p]), EVENT_V1, "stream")


def test_repeated_silver_batch_changes_nothing(spark):
    """A batch run again after a failure starts from the record before it."""
    store = INC.SilverStore(scratch_path(spark, "replay"))
    dims = lambda s: (A.routes_bronze(s, SF001), A.vehicles_bronze(s, SF001))
    batches = [[({}, 4, 9), (LATER, 3, 60)], [({"delay": 1}, 2, 5)], [({"delay": 2}, 1, 1), ({"vehicleId": 8}, 9, 70)]]
    state = lambda: (sorted(map(repr, INC.read_silver(spark, store).collect())),
                     sorted(map(repr, INC.read_latest(spark, store).collect())), store.journal.last(spark))
    parts = [bronze_of(spark, b).drop("ingestion_ts").withColumn("ingestion_ts", F.lit(None).cast("timestamp"))
             for b in batches]
    for n, part in enumerate(parts):
        INC.take_batch(part, n, store, dims)
        once = state()
        INC.take_batch(part, n, store, dims)
        assert state() == once


def test_failed_batch_leaves_the_old_state(spark):
    """A batch that fails before its record is not seen, and can be run again."""
    store = INC.SilverStore(scratch_path(spark, "fails"))
    dims = lambda s: (A.routes_bronze(s, SF001), A.vehicles_bronze(s, SF001))
    INC.take_batch(bronze_of(spark, [({}, 2, 5)]), 0, store, dims)

    def fail(batch):
        raise RuntimeError("lost")

    for _ in range(2):
        with pytest.raises(RuntimeError):
            INC.take_batch(bronze_of(spark, [({**OUT}, 1, 0), (LATER, 3, 9)]), 1, store, dims, after=fail)
        assert [r.offset for r in INC.read_silver(spark, store).collect()] == [2]
        assert [str(r.event_time) for r in INC.read_latest(spark, store).collect()] == ["2024-01-05 10:00:00"]
    INC.take_batch(bronze_of(spark, [({**OUT}, 1, 0), (LATER, 3, 9)]), 1, store, dims)
    assert [r.offset for r in INC.read_silver(spark, store).collect()] == [3]
    assert [str(r.event_time) for r in INC.read_latest(spark, store).collect()] == ["2024-01-05 10:01:00"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_silver_reads_only_the_days_of_a_batch(spark):
    """The ledger is read by the days that occur, not from the first to the
    last: one clock of 1970 doesn't make a batch read everything."""
    store = INC.SilverStore(scratch_path(spark, "prune"))
    days = ["2024-01-05", "2024-01-06", "2024-01-07", "1970-01-01"]
    INC.take_batch(bronze_of(spark, [({"generated": f"{d}T10:00:00Z"}, n, n) for n, d in enumerate(days)]), 0, store, None)
    fresh = bronze_of(spark, [({"generated": f"{d}T10:00:00Z"}, 9, 9) for d in (days[1], days[3])])
    schema = INC.typed_timestamps(fresh).schema
    wanted = [datetime(2024, 1, 6).date(), datetime(1970, 1, 1).date()]
    known = INC.read_ledger(spark, store, schema, wanted, 1)
    assert known.count() == 2
    filters = [x for x in plan(known).splitlines() if "PartitionFilters" in x][0]
    assert "event_date" in filters and "batch_id" in filters


def test_latest_follows_batch_and_fleet(spark):
    """Without replaced rows, keeping up the latest positions reads no silver."""
    store = INC.SilverStore(scratch_path(spark, "latest"))
    dims = lambda s: (A.routes_bronze(s, SF001), A.vehicles_bronze(s, SF001))
    INC.take_batch(bronze_of(spark, [({}, 1, 0)]), 0, store, dims)
    seen = []
    INC.take_batch(bronze_of(spark, [(LATER, 2, 60)]), 1, store, dims, after=seen.append)
    held = spark.read.parquet(store.latest_of(0))
    made = INC.update_latest(held, seen[0].rows, seen[0].replaced, seen[0].silver)
    assert seen[0].replaced is None
    files = made.inputFiles()
    assert all("/latest/" in f or "/rows/batch_id=1/" in f for f in files) and len(files) == 2


def test_second_chain_run_reads_only_new_bronze(spark):          # JOB3
    from fleetpulse.plans import medallion as M
    c = cfg(spark, "chain-runs")
    store = M.Store(root=scratch_path(spark, "chain-runs-tables"))
    store.write(A.routes_bronze(spark, SF001), c.routes_table)
    store.write(A.vehicles_bronze(spark, SF001), c.vehicles_table)
    taken, start = [], M.start_silver

    def watched(*args, **kw):
        query = start(*args, **kw)
        query.awaitTermination()
        taken.append(sum(p["numInputRows"] for p in query.recentProgress))
        return query

    feed = A.feed(spark, SF001)
    split = F.lit("2024-01-16").cast("timestamp_ntz")
    early, late = feed.filter(F.col("enqueued_ts") < split), feed.filter(F.col("enqueued_ts") >= split)
    M.start_silver = watched
    try:
        for part in (early, late):
            land(part, c.landing_path, EVENT_V1.fieldNames())
            counts = M.run_chain(spark, c, store)
        again = M.run_chain(spark, c, store)             # nothing new landed
    finally:
        M.start_silver = start
    assert taken == [early.count(), late.count(), 0] and again == counts
    assert counts == M.run_medallion(spark, feed, store.read(spark, c.routes_table), store.read(spark, c.vehicles_table),
                                     M.Store(root=scratch_path(spark, "chain-runs-batch")))
    assert counts == M.run_chain(spark, c, store, rebuild=True)


def test_chain_by_table_names(spark):                            # SNK1, JOB6
    """Bronze, dimensions and results as catalog tables and views, by name."""
    from fleetpulse.operators import gold
    from fleetpulse.plans import medallion as M
    db = "fleet_names"
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_path(spark, 'names')}'")
    root = scratch_path(spark, "names-landing")
    c = PipelineConfig(database=db, landing_path=f"{root}/landing", checkpoint_path=f"{root}/ckpt")
    store = M.Store(database=db)
    store.write(A.routes_bronze(spark, SF001), c.routes_table)
    store.write(A.vehicles_bronze(spark, SF001), c.vehicles_table)
    feed = A.feed(spark, SF001)
    for part in (feed.filter("offset % 2 = 0"), feed.filter("offset % 2 = 1")):
        land(part, c.landing_path, EVENT_V1.fieldNames())
        M.run_chain(spark, c, store)
    assert spark.table(f"{db}.gps_data").count() == feed.count()
    whole = M.chain_silver(spark, c, store)
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert rows(spark.table(f"{db}.gold_route_summary")) == rows(gold.route_summary(whole))
    assert rows(M.dashboard_dataset(spark, store, "gold_fleet_current")) == rows(gold.fleet_current(whole))
    # a rebuild makes plain tables of the views again
    M.run_chain(spark, c, store, rebuild=True)
    assert rows(spark.table(f"{db}.gold_route_summary")) == rows(gold.route_summary(whole))
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_bronze_table_gets_new_columns(spark):                   # SNK1, SNK2
    db = "fleet_evolves"
    spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_path(spark, 'evolves')}'")
    root = scratch_path(spark, "evolves-landing")
    c = PipelineConfig(database=db, landing_path=f"{root}/landing", checkpoint_path=f"{root}/ckpt")
    v1, v2 = A.feed(spark, SF001, version=1).limit(30), A.feed(spark, SF001, version=2).filter("offset >= 900")
    land(v1, c.landing_path, EVENT_V1.fieldNames())
    drain(start_ingest(spark, c, EVENT_V1))
    assert "occupancy" not in spark.table(c.table(c.bronze_table)).columns
    land(v2, c.landing_path, EVENT_V2.fieldNames())
    drain(start_ingest(spark, c, EVENT_V2))
    drain(start_ingest(spark, c, EVENT_V2))                 # restart: nothing new
    out = bronze_rows(spark, c)
    assert out.filter("occupancy is null").count() == 30
    assert out.filter("occupancy is not null").count() == v2.count()
    spark.sql(f"DROP DATABASE {db} CASCADE")


def test_compaction_changes_nothing(spark):                     # SNK1
    """Compacting and purging between batches, a failed compaction and a batch
    run again: always the rows of a rebuild, in few files for closed days."""
    from datetime import date
    plain, packed = (INC.SilverStore(scratch_path(spark, n)) for n in ("plain", "packed"))
    dims = lambda s: (A.routes_bronze(s, SF001), A.vehicles_bronze(s, SF001))
    feed = A.feed_dup(spark, SF001).drop("copy").withColumns({
        "generated": F.date_format("event_time", A.ISO_MICROS), "ingestion_ts": F.lit(None).cast("timestamp")})
    # in no order, so that winners are replaced after their day was compacted
    batches = [feed.filter(F.pmod(F.xxhash64("offset", "enqueued_ts"), F.lit(3)) == n) for n in range(3)]
    rows = lambda st: sorted(map(repr, INC.read_silver(spark, st).collect()))
    now = lambda st: sorted(map(repr, INC.read_latest(spark, st).collect()))
    for n, part in enumerate(batches):
        INC.take_batch(part, n, plain, dims)
        INC.take_batch(part, n, packed, dims)
        if n == 1:                                          # a compaction that fails before its record
            put = type(packed.compactions).put
            try:
                type(packed.compactions).put = lambda *a: (_ for _ in ()).throw(RuntimeError("lost"))
                with pytest.raises(RuntimeError):
                    INC.compact(spark, packed, date(2024, 1, 18))
            finally:
                type(packed.compactions).put = put
            assert rows(packed) == rows(plain)
        days = INC.compact(spark, packed, date(2024, 1, 12 + 6 * n))
        assert bool(days) == (n > 0) and bool(INC.purge(spark, packed)) == (n > 0)
        if n == 2:
            assert INC.compact(spark, packed, date(2024, 1, 2)) == [] and INC.purge(spark, packed) == 0
            assert rows(packed) == rows(plain)
            INC.take_batch(part, n, packed, dims)           # the last batch, again
        assert rows(packed) == rows(plain) and now(packed) == now(plain)
        assert packed.journal.last(spark) == plain.journal.last(spark)
    held = INC.read_silver(spark, packed).filter("event_date < '2024-01-20'").inputFiles()
    old = [f for f in held if "/rows/" in f and "event_date=2024-01-0" in f]
    assert all("batch_id=2" in f for f in old) and any("/base_rows/" in f for f in held)


def test_batches_are_dealt_by_files(spark, monkeypatch):        # F4 to F9
    """A task that writes a batch has the readings of one file of one day,
    however many there are and however uneven the days."""
    monkeypatch.setattr(INC, "FILE_ROWS", 1000)
    rows = spark.range(20_000).selectExpr(
        "id AS vehicleId", "id AS generated",
        "CASE WHEN id < 9000 THEN DATE '2024-01-01' WHEN id >= 19000 THEN NULL"
        " ELSE DATE_ADD(DATE '2024-01-02', CAST(id % 20 AS INT)) END AS event_date")
    days = [tuple(r) for r in rows.groupBy("event_date").count().collect()]
    dealt = INC.by_day(rows, days)
    assert dealt.columns == rows.columns and dealt.rdd.getNumPartitions() == 9 + 1 + 20
    tasks = dealt.groupBy(F.spark_partition_id().alias("task")).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(F.coalesce(F.col("event_date").cast("string"), F.lit("-"))).alias("days")).collect()
    assert sum(r.n for r in tasks) == 20_000
    assert all(r.days == 1 and r.n < 1200 for r in tasks)
