"""What the optimizer makes of the plans."""

import re

import pytest
from pyspark.sql import functions as F

from kerbside.operators.latest import best_report, latest_per_key
from kerbside.operators.timeline import change_intervals
from kerbside.operators.upsert import in_values, read_mart
from kerbside.plans import silver
from kerbside.sources.bronze import append_pages, read_bronze
from workload import frames, pages
from workload.queries import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


STORED = (
    "csv_dump_import", "hourly_files", "status_incremental", "refresh_late_pages", "publish_round_trip", "bronze_page_gaps", "hour_files_back",
    "seed_files", "bronze_views", "status_state_runs", "trips_delta_runs", "page_hash_index", "page_hash_last_runs",
)  # they write tables on the way; other tests cover their plans


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in STORED])
def test_no_cross_joins_and_no_python(spark, sf_dir, name):
    # The page hash is the one function that runs on Arrow batches.
    text = re.sub(r"ArrowEvalPython \[digests\(", "", plan(QUERIES[name](spark, sf_dir)))
    for operator in ("CartesianProduct", "NestedLoopJoin", "Python", "InPandas"):
        assert operator not in text


def test_one_row_per_key_is_picked_before_the_shuffle(spark, sf_dir):
    text = plan(latest_per_key(frames.trip_copies(spark, sf_dir), ["trip_id"], "start_ts"))
    before, after = text.index("row_number(), 1, Final"), text.index("row_number(), 1, Partial")
    assert before < text.index("Exchange hashpartitioning") < after


def test_timeline_reads_its_shuffle_twice_instead_of_the_source(spark, sf_dir):
    text = final_plan(change_intervals(best_report(frames.reports(spark, sf_dir))))
    assert "ReusedExchange" in text and text.count("FileScan") == 1


@pytest.mark.parametrize("name", ["status_intervals", "change_points_only", "validity_ends"])
def test_registered_timelines_scan_once_and_share_their_shuffle(spark, sf_dir, name):
    text = final_plan(QUERIES[name](spark, sf_dir))
    assert "ReusedExchange" in text and text.count("FileScan") == 1


def test_publication_reads_named_partitions_only(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id", "id % 50 AS part")
    rows.write.partitionBy("part").parquet(str(tmp_path / "mart"))
    stored = read_mart(spark, str(tmp_path / "mart"), rows.schema)
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    found = in_values(stored, "part", [3, 7])
    text = plan(found)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert re.search(r"PartitionFilters: \[part#\d+L? IN \(3,7\)", text)
    assert found.select("part").distinct().count() == 2 and len({f.rsplit("/", 2)[1] for f in found.inputFiles()}) <= 50
    assert read_mart(spark, str(tmp_path / "none")) is None


def test_scan_is_pruned_to_the_raw_table_and_its_columns(spark, sf_dir, tmp_path):
    append_pages(pages.bronze_table(spark, sf_dir, "VOI_VEHICLES", "DOTT_VEHICLES"), str(tmp_path))
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    text = plan(silver.voi_vehicles(read_bronze(spark, str(tmp_path))))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pruned = re.search(r"PartitionFilters: \[([^]]*)\]", text).group(1)
    assert re.search(r"provider#\d+ = VOI", pruned) and re.search(r"endpoint#\d+ = VEHICLES", pruned)
    assert "ReadSchema: struct<content:string>" in text


def test_page_and_element_are_parsed_once(spark, sf_dir, tmp_path):
    append_pages(pages.bronze_table(spark, sf_dir, "BOLT_TELEMETRY"), str(tmp_path))
    text = plan(silver.bolt_telemetry(read_bronze(spark, str(tmp_path))))
    assert text.count("from_json(") == 2


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(frames.seeds(spark, sf_dir).select("TRIP_ID"))
    assert "EqualTo(o_orderpriority,1-URGENT)" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderpriority:string>" in text


def test_route_join_needs_no_shuffle_beyond_its_inputs(spark, sf_dir):
    from kerbside.operators.routes import attach_routes, trip_lines

    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        trips = latest_per_key(frames.trips(spark, sf_dir), ["trip_id"], "start_ts").withColumn("route_json", F.lit(None).cast("string"))
        text = plan(attach_routes(trips, trip_lines(frames.pings(spark, sf_dir))))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    # One for the trips, two for the lines (hours, then trips).
    assert text.count("Exchange hashpartitioning") == 3


def test_routes_come_last_and_corrections_share_their_layout(spark, sf_dir):
    from kerbside.plans.trips import TRIP_ROW, assemble_trips, trip_registry, union_trips

    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        trips = union_trips(frames.trip_copies(spark, sf_dir).select(*[c for c in TRIP_ROW if c in frames.trip_copies(spark, sf_dir).columns]))
        devices = spark.range(10).selectExpr("cast(id as string) AS device_id", "'v' AS vehicle_id", "'t' AS vehicle_type")
        seeds = spark.range(10).selectExpr("'Voi' AS provider_name", "cast(id as string) AS TRIP_ID", "'v' AS VEHICLE_ID", "'t' AS VEHICLE_TYPE")
        text = plan(assemble_trips(trips, frames.pings(spark, sf_dir), trip_registry(devices, devices, devices), seeds))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    joins = re.findall(r"SortMergeJoin \[(\w+?)#", text)  # the last join comes first
    assert joins == ["trip_id", "trip_id", "provider_name"]
    between = text[text.index("SortMergeJoin [trip_id") : text.index("SortMergeJoin [provider_name")]
    assert len(re.findall(r"Exchange hashpartitioning\(trip_id", between)) == 1


def test_page_filters_decide_once(spark, tmp_path, page):
    """Bodies are read once, the history in slim columns and once; no more exchanges than the two sides need."""
    from kerbside.operators.page_dedupe import keep_if_changed, keep_if_unseen, with_hash

    for name in ("new", "stored"):
        with_hash(page(("VOI", "EVENTS", '{"events":[1]}'))).write.parquet(f"{tmp_path}/{name}")
    new, stored = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("new", "stored"))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        unseen, changed = plan(keep_if_unseen(new, stored)), plan(keep_if_changed(new, stored))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    scans = lambda text: re.findall(r"ReadSchema: (.*)", text)
    assert sorted("content" in s for s in scans(unseen)) == [False, True]
    assert unseen.count("Exchange hashpartitioning") == 3
    assert sum("content" in s for s in scans(changed)) == 1


def test_changed_pages_are_told_apart_without_merging_copies(spark, page):
    """No aggregate by page: pages are shuffled by time chunk for the comparison and once by page for the bodies."""
    from kerbside.operators.page_dedupe import keep_if_changed, with_hash

    text = plan(keep_if_changed(with_hash(page(("VOI", "EVENTS", '{"events":[1]}')))))
    assert not re.search(r"HashAggregate\(keys=\[_page#", text)


def test_a_batch_is_held_before_pages_are_compared(spark, tmp_path, page, monkeypatch):
    """The first job over the batch is one pass that holds it, so that no two stages work out its hashes side by side."""
    from kerbside.operators.page_dedupe import with_hash
    from kerbside.sources import page_state

    held = []
    compare = page_state.keep_if_changed

    def watched(offered, *args):
        held.append(spark._jsc.getPersistentRDDs().size())
        return compare(offered, *args)

    monkeypatch.setattr(page_state, "keep_if_changed", watched)
    before = spark._jsc.getPersistentRDDs().size()
    new = with_hash(page(("VOI", "EVENTS", '{"events":[1]}'))).withColumn("load_ts", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    assert page_state.land(new, str(tmp_path / "bronze"), str(tmp_path / "state"), 0, "changed", ("load_ts", "filename"), ("filename",))
    assert held == [before + 1]
