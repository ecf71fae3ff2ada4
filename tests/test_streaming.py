"""Streams on file sources: dedup, late data, flows, corrections, failures."""

import json
import os
import re
import time
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fareline import schemas as S
from fareline.operators.quality import TableTests, SuiteFailed, require_passing, run_tests
from fareline.plans.enrich import rides_enriched
from fareline.plans.staging import live_rides, staged
from fareline.session import SHUFFLE_CLEANUP
from fareline.sources.kafka import bronze_rides
from fareline.sources.tables import create_namespaces
from fareline.streaming import flows
from fareline.streaming.metrics import LATE_ROWS, FlowMetrics, flow_metrics, flow_totals
from fareline.workload.rides import references

from test_silver_gold import EVENT


class Topic:
    """A topic as a folder of Kafka-shaped records; each send adds one file."""

    def __init__(self, spark, path):
        self.spark, self.path, self.offset = spark, str(path), 0

    def send(self, *events):
        """Events are (ride id or raw payload, 'HH:MM')."""
        data = []
        for ride, time in events:
            payload = ride if ride is None or ride.startswith("{") else json.dumps({**EVENT, "ride_id": ride})
            at = datetime.fromisoformat(f"2026-03-07T{time}:00")
            data.append((b"k", payload and payload.encode(), "rides", 0, self.offset, at))
            self.offset += 1
        self.spark.createDataFrame(data, S.KAFKA_RECORD_DDL).coalesce(1).write.mode("append").parquet(self.path)

    def stream(self, **options):
        return self.spark.readStream.schema(S.KAFKA_RECORD_DDL).options(**options).parquet(self.path)


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path / "topic")


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "lake")


def to_bronze(topic, root, **options):
    flows.start_bronze_rides(topic.stream(**options), root).awaitTermination()


def to_staging(spark, root, **options):
    query = flows.start_live_staging(spark, root, **options)
    query.awaitTermination()
    return query


def staged_ids(spark, root):
    return sorted(r.ride_id for r in flows.staging_table(root).read(spark).collect())


def test_repeats_within_the_horizon_are_dropped_across_batches(spark, topic, root):
    topic.send(("a", "10:00"), ("a", "10:01"), ("b", "10:02"))
    to_bronze(topic, root)
    to_staging(spark, root)
    topic.send(("b", "10:05"), ("c", "10:06"))
    to_bronze(topic, root)
    to_staging(spark, root)
    assert flows.bronze_rides_table(root).read(spark).count() == 5
    assert staged_ids(spark, root) == ["a", "b", "c"]


def test_late_rows_and_repeats_after_the_horizon(spark, topic, root):
    """Rows behind the watermark are dropped; a key whose state expired passes again."""
    for events in [[("a", "10:00")], [("b", "10:30")], [("late", "10:05"), ("b", "10:31")], [("c", "11:30")], [("b", "11:31")]]:
        topic.send(*events)
        to_bronze(topic, root)
        to_staging(spark, root)
    assert staged_ids(spark, root) == ["a", "b", "b", "c"]


def test_rides_without_id_or_booking_time_are_dropped_and_counted(spark, topic, root):
    no_time = json.dumps({**EVENT, "ride_id": "x", "booking_timestamp": "soon"})
    topic.send(("a", "10:00"), ("{bad", "10:00"), ("{}", "10:01"), (no_time, "10:02"))
    to_bronze(topic, root)
    query = to_staging(spark, root)
    assert staged_ids(spark, root) == ["a"]
    counts = [p["observedMetrics"][flows.LIVE] for p in query.recentProgress if flows.LIVE in p["observedMetrics"]]
    assert sum(c["rows"] for c in counts) == 2 and sum(c["valid_booking_time"] for c in counts) == 1
    name = f"{flows.LIVE}_arrived"
    arrived = [p["observedMetrics"][name] for p in query.recentProgress if name in p["observedMetrics"]]
    assert sum(c["rows"] for c in arrived) == 4 and sum(c["valid_ride_id"] for c in arrived) == 2


def test_thinning_before_the_dedup_changes_no_result(spark, topic, root):
    topic.send(*[("a", "10:00")] * 40, ("b", "10:01"), ("{bad", "10:01"))
    to_bronze(topic, root)
    to_staging(spark, root, combine=True)
    topic.send(("a", "10:02"), ("c", "10:03"), ("c", "10:03"))
    to_bronze(topic, root)
    to_staging(spark, root, combine=True)
    assert staged_ids(spark, root) == ["a", "b", "c"]


def test_missing_payload_stops_the_bronze_query(spark, topic, root):
    topic.send(("a", "10:00"), (None, "10:01"))
    with pytest.raises(Exception, match="value_not_null"):
        to_bronze(topic, root)


def test_rate_limit_splits_the_input_into_batches(spark, topic, root):
    for i in range(3):
        topic.send((f"r{i}", "10:00"))
    query = flows.start_bronze_rides(topic.stream(maxFilesPerTrigger=1), root)
    query.awaitTermination()
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [1, 1, 1]
    assert flows.bronze_rides_table(root).read(spark).count() == 3


def test_stream_equals_batch(spark, topic, root):
    topic.send(*[(f"r{i % 30}", f"10:{i // 10:02d}") for i in range(90)])
    to_bronze(topic, root)
    to_staging(spark, root)
    streamed = flows.staging_table(root).read(spark).drop("_ingested_at")
    batch = staged(live_rides(bronze_rides(spark.read.parquet(topic.path)))).drop("_ingested_at")
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))


def test_two_flows_keep_separate_checkpoints(spark, topic, root, tmp_path):
    folder = tmp_path / "bulk"
    folder.mkdir()
    (folder / "1.json").write_text(json.dumps([{**EVENT, "ride_id": "b1"}, {**EVENT, "ride_id": "b1"}]))
    bulk = flows.FileTable(f"{root}/bronze/bulk_rides", str(folder))
    bulk.start(spark).awaitTermination()
    flows.start_bulk_staging(bulk, spark, root).awaitTermination()
    assert staged_ids(spark, root) == ["b1", "b1"]  # bulk rides are not de-duplicated
    topic.send(("a", "10:00"))
    to_bronze(topic, root)
    to_staging(spark, root)
    flows.start_bulk_staging(bulk, spark, root).awaitTermination()
    assert staged_ids(spark, root) == ["a", "b1", "b1"]
    sources = {r._source_system for r in flows.staging_table(root).read(spark).collect()}
    assert sources == {"eventhub", "bulk_file"}
    with pytest.raises(ValueError, match="not a flow"):
        flows.staging_table(root).data("other")


def test_corrected_references_apply_from_the_next_batch(spark, topic, root):
    versions, reports = [], []

    def refs():
        """A city name that is corrected before every batch."""
        versions.append(f"version {len(versions)}")
        tables = references(spark)
        tables["ref_cities"] = tables["ref_cities"].withColumn("city", F.lit(versions[-1]))
        return tables

    for ride in ("a", "b"):
        topic.send((ride, "10:00"))
        to_bronze(topic, root)
        to_staging(spark, root)
    flows.start_enrich(
        spark, root, flows.LIVE, refs, max_files=1, report=lambda n, counts: reports.append(counts)
    ).awaitTermination()
    rides = flows.enriched_table(spark, root).read(spark)
    found = {r.ride_id: r.pickup_city for r in rides.collect()}
    assert set(found) == {"a", "b"} and found["a"] != found["b"] and set(found.values()) <= set(versions)
    assert sum(c["rows"] for c in reports) == 2 and all(c["positive_distance"] == 0 for c in reports)
    staging = flows.staging_table(root).read(spark)
    assert rides.columns == rides_enriched(staging, references(spark)).columns


def test_fact_grows_by_increments(spark, topic, root):
    """Later batches add rides; running the load again changes nothing."""

    def arrive(*events):
        topic.send(*events)
        to_bronze(topic, root)
        to_staging(spark, root)
        flows.start_enrich(spark, root, flows.LIVE, lambda: references(spark)).awaitTermination()

    def load():
        flows.load_fact(spark, root, lambda: references(spark), target)
        return sorted((r.ride_id, r.total_fare, r.pickup_city_key) for r in target.read(spark).collect())

    target = flows.fact_table(root)
    arrive(("a", "10:00"), ("b", "10:01"))
    assert load() == [("a", 33.55, 1), ("b", 33.55, 1)]
    assert load() == [("a", 33.55, 1), ("b", 33.55, 1)]
    arrive(("c", "10:02"), ("a", "10:03"))
    corrected = json.dumps({**EVENT, "ride_id": "b", "total_fare": 40.0})
    arrive((corrected, "11:00"), ("d", "11:00"))
    arrive((corrected, "12:00"))  # past the horizon: passes the dedup as a newer version
    assert load() == [("a", 33.55, 1), ("b", 40.0, 1), ("c", 33.55, 1), ("d", 33.55, 1)]


def test_old_files_are_not_skipped(spark, topic, root):
    """A file dated ten days back that arrives second is read like any other."""
    topic.send(("a", "10:00"))
    to_bronze(topic, root)
    to_staging(spark, root)
    topic.send(("b", "10:01"))
    to_bronze(topic, root)
    bronze = Path(root, "bronze", "rides_raw", "data", "flow=main")
    newest = max(bronze.rglob("*.parquet"), key=lambda f: f.stat().st_mtime)
    os.utime(newest, (newest.stat().st_mtime - 864_000,) * 2)
    to_staging(spark, root)
    assert staged_ids(spark, root) == ["a", "b"]


def test_increments_follow_stamps_not_file_times(spark, topic, root):
    target = flows.fact_table(root)
    for ride, day in (("a", "2030-01-01"), ("b", "2030-01-02")):
        topic.send((ride, "10:00"))
        to_bronze(topic, root)
        to_staging(spark, root)
        stamp = F.lit(day).cast("timestamp")
        flows.start_enrich(
            spark, root, flows.LIVE, lambda: references(spark), processed_at=stamp
        ).awaitTermination()
        flows.load_fact(spark, root, lambda: references(spark), target)
    assert sorted(r.ride_id for r in target.read(spark).collect()) == ["a", "b"]
    assert flows.load_fact(spark, root, lambda: references(spark), target) == 0


def test_gold_is_stored_and_gated(spark, topic, root):
    topic.send(("a", "10:00"), ("b", "10:01"))
    to_bronze(topic, root)
    to_staging(spark, root)
    flows.start_enrich(spark, root, flows.LIVE, lambda: references(spark)).awaitTermination()
    assert flows.build_gold(spark, root, lambda: references(spark)) == 2
    gold = flows.gold_tables(spark, root)
    assert gold["fct_rides"].count() == 2 and gold["dim_city"].count() == 11 and "dim_date" in gold
    suite = {"fct_rides": TableTests(unique=["ride_id"], relationships={"pickup_city_key": ("dim_city", "city_key")})}
    assert require_passing(run_tests(gold, suite)).count() == 2
    twice = {**gold, "fct_rides": gold["fct_rides"].unionByName(gold["fct_rides"].limit(1))}
    with pytest.raises(SuiteFailed, match="unique.*ride_id"):
        require_passing(run_tests(twice, suite))


def wait_until(true, seconds=60):
    """Wait for a running query to get somewhere."""
    end = time.monotonic() + seconds
    while not true():
        assert time.monotonic() < end, "the query did not get there in time"
        time.sleep(0.2)


def test_a_running_stream_gains_columns(spark, root, tmp_path):
    folder = tmp_path / "trips"
    folder.mkdir()
    trips = flows.FileTable(f"{root}/bronze/trips", str(folder))
    query = trips.start(spark, trigger={"processingTime": "200 milliseconds"})
    try:
        for n, line in enumerate(['{"id":0}', '{"id":1}', '{"id":2,"promo":"P2"}', '{"id":3,"promo":"P3","miles":1.5}']):
            (folder / f"{n}.json").write_text(line + "\n")
            wait_until(lambda: any(p["numInputRows"] and p["batchId"] == n for p in query.recentProgress))
    finally:
        query.stop()
    found = {(r.id, r.promo, r.miles, r._rescued_data) for r in trips.read(spark).collect()}
    assert found == {(0, None, None, None), (1, None, None, None), (2, "P2", None, None), (3, "P3", 1.5, None)}
    assert len({p["runId"] for p in query.recentProgress}) == 1


def test_a_batch_reads_its_files_once(spark, root, tmp_path):
    """The look at the fields and the parsing share one scan: a file that goes in between is not missed."""
    folder = tmp_path / "trips"
    folder.mkdir()
    (folder / "1.json").write_text('{"id":1}\n')
    trips = flows.FileTable(f"{root}/bronze/trips", str(folder))
    grown = flows.FileTable._grown

    def then_lose(self, lines):
        schema = grown(self, lines)
        (folder / "1.json").write_text('{"id":99}\n')
        return schema

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(flows.FileTable, "_grown", then_lose)
        trips.start(spark).awaitTermination()
    assert [r.id for r in trips.read(spark).collect()] == [1]


def test_a_batch_of_files_is_held_compressed_and_let_go(spark, root, tmp_path):
    """Held as Spark caches it, it would take the room of its text in memory or on the executors' disks."""
    folder = tmp_path / "trips"
    folder.mkdir()
    text = "".join(json.dumps({"id": n, "vehicle_model": "Corolla", "vehicle_color": "Black"}) + "\n" for n in range(5000))
    (folder / "1.json").write_text(text)
    trips = flows.FileTable(f"{root}/bronze/trips", str(folder))
    grown, seen = flows.FileTable._grown, []

    def look(self, lines):
        held = sum(p.stat().st_size for p in Path(root, "bronze", "trips", "held").rglob("*.parquet"))
        seen.append((len(spark.sparkContext._jsc.getPersistentRDDs()), held))
        return grown(self, lines)

    cached = len(spark.sparkContext._jsc.getPersistentRDDs())
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(flows.FileTable, "_grown", look)
        trips.start(spark).awaitTermination()
    ((held_in_cache, held),) = seen
    assert held_in_cache == cached and 0 < held < len(text) / 2
    assert not list(Path(root, "bronze", "trips", "held").iterdir())
    assert trips.read(spark).count() == 5000


def test_shuffle_files_of_a_flow_go_with_its_batches(spark, topic, root):
    def shuffles():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return set(re.findall(r"/shuffle_(\d+)_", files.mkString(" ")))

    usual = spark.conf.get(SHUFFLE_CLEANUP, None)
    before = shuffles()
    topic.send(("a", "10:00"), ("a", "10:01"), ("b", "10:02"))
    to_bronze(topic, root)
    to_staging(spark, root)
    assert staged_ids(spark, root) == ["a", "b"]
    wait_until(lambda: not shuffles() - before, seconds=20)
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == usual


def test_one_flow_is_reset_and_replayed(spark, topic, root, tmp_path):
    folder = tmp_path / "bulk"
    folder.mkdir()
    bulk = flows.FileTable(f"{root}/bronze/bulk_rides", str(folder))

    def run_bulk():
        bulk.start(spark, max_files=1).awaitTermination()
        flows.start_bulk_staging(bulk, spark, root, max_files=1).awaitTermination()
        flows.start_enrich(spark, root, flows.BULK, lambda: references(spark), max_files=1).awaitTermination()

    def ids(table):
        return sorted(r.ride_id for r in table.read(spark).collect())

    def files(flow):
        return sorted(p.name for p in Path(flows.enriched_table(spark, root).data(flow)).rglob("*.parquet"))

    for n in range(4):
        (folder / f"{n}.json").write_text(json.dumps({**EVENT, "ride_id": f"b{n}"}))
        run_bulk()
    topic.send(("a", "10:00"))
    to_bronze(topic, root)
    to_staging(spark, root)
    flows.start_enrich(spark, root, flows.LIVE, lambda: references(spark)).awaitTermination()
    tables = [flows.staging_table(root), flows.enriched_table(spark, root)]
    everything, live_files, bulk_files = ["a", "b0", "b1", "b2", "b3"], files(flows.LIVE), files(flows.BULK)
    assert [ids(table) for table in tables] == [everything, everything]

    flows.reset_flow(spark, root, flows.BULK)
    assert [ids(table) for table in tables] == [["a"], ["a"]]
    flows.reset_flow(spark, root, flows.BULK)  # as after one that was cut short
    run_bulk()
    assert [ids(table) for table in tables] == [everything, everything]
    assert files(flows.LIVE) == live_files and not set(files(flows.BULK)) & set(bulk_files)
    run_bulk()
    assert [ids(table) for table in tables] == [everything, everything]

    bulk.reset(spark)
    flows.reset_flow(spark, root, flows.BULK)
    run_bulk()
    assert [ids(table) for table in tables] == [everything, everything]


def test_a_running_flow_is_not_reset(spark, topic, root):
    topic.send(("a", "10:00"))
    query = flows.start_bronze_rides(topic.stream(), root, trigger={"processingTime": "1 second"})
    try:
        with pytest.raises(ValueError, match="stop flow main"):
            flows.bronze_rides_table(root).reset(spark)
    finally:
        query.stop()


def test_a_batch_that_was_written_is_passed_over_and_one_cut_short_replaced(spark, topic, root):
    """The last batch's commit is lost, as if the driver had died before it; then its files' mark too."""
    topic.send(("a", "10:00"))
    to_bronze(topic, root)
    table = flows.bronze_rides_table(root)
    first = sorted(Path(table.data()).rglob("*.parquet"))
    for lose_mark in (False, True):
        (commit,) = Path(table.checkpoint(), "commits").glob("[0-9]*")
        commit.unlink()
        (commit.parent / f".{commit.name}.crc").unlink(missing_ok=True)
        if lose_mark:
            next(Path(table.data()).rglob("_SUCCESS")).unlink()
        to_bronze(topic, root)
        assert table.read(spark).count() == 1
        assert (sorted(Path(table.data()).rglob("*.parquet")) == first) != lose_mark


def test_metrics_of_flows_are_kept(spark, topic, root):
    """Late rows, dropped rows and constraint counts over several runs of a flow."""
    batches = [[("a", "10:00"), ("{bad", "10:00")], [("b", "10:30")], [("late", "10:05"), ("later", "10:06"), ("c", "10:31")]]
    for events in batches:
        topic.send(*events)
        to_bronze(topic, root)
        with FlowMetrics(spark, root):
            to_staging(spark, root)
    totals = {(r.measured, r.metric): r.total for r in flow_totals(spark, root).collect()}
    assert {r.query for r in flow_totals(spark, root).collect()} == {f"silver/staging_rides#{flows.LIVE}"}
    assert totals["state", LATE_ROWS] == 2
    assert totals[f"{flows.LIVE}_arrived", "rows"] == 6 and totals[f"{flows.LIVE}_arrived", "valid_ride_id"] == 1
    assert totals[flows.LIVE, "rows"] == 3 and totals[flows.LIVE, "plausible_surge"] == 0
    assert staged_ids(spark, root) == ["a", "b", "c"]
    # A report that comes twice counts once, and other flows' queries are not recorded.
    before = flow_metrics(spark, root).count()
    flow_metrics(spark, root).write.mode("append").parquet(f"{root}/flow_metrics")
    assert flow_metrics(spark, root).count() == before
    with FlowMetrics(spark, f"{root}/elsewhere"):
        to_staging(spark, root)
    assert flow_metrics(spark, f"{root}/elsewhere").isEmpty()


def test_bronze_to_enriched_by_table_names(spark, topic, root):
    """Tables of both flows in the catalog, registered before they have rows, read as batch and stream."""
    names = {"bronze.rides_raw": flows.bronze_rides_table(root), "silver.staging_rides": flows.staging_table(root),
             "silver.rides_enriched": flows.enriched_table(spark, root)}
    create_namespaces(spark)
    try:
        for name, table in names.items():
            table.register(spark, name)
            assert spark.read.table(name).isEmpty()
        for ride in ("a", "b"):
            topic.send((ride, "10:00"))
            to_bronze(topic, root)
            to_staging(spark, root)
            flows.start_enrich(spark, root, flows.LIVE, lambda: references(spark)).awaitTermination()
        for name in names:
            spark.catalog.refreshTable(name)
        assert spark.read.table("bronze.rides_raw").count() == 2
        assert spark.read.table("silver.rides_enriched").columns == flows.enriched_table(spark, root).read(spark).columns
        copy = spark.readStream.table("silver.staging_rides").select("ride_id").writeStream.format("memory").queryName("copied")
        copy.trigger(availableNow=True).start().awaitTermination()
        assert sorted(r.ride_id for r in spark.read.table("copied").collect()) == ["a", "b"]
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
