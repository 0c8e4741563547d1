import json

import pytest
from conftest import rows
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from kerbside.catalogue import endpoint_catalogue, with_endpoints
from kerbside.operators.gaps import expected_grid, landing_gaps, page_gaps, page_runs, unbroken_pages
from kerbside.operators.page_dedupe import drop_empty, keep_if_changed, keep_if_unseen, last_hashes, with_hash
from kerbside.sources.bronze import append_pages, read_bronze, scan
from kerbside.sources.files import import_dump, read_seed, read_table
from kerbside.sources import page_state
from kerbside.sources.landing import hour_pages, merged_items, parse_names, read_pages, write_hours
from kerbside.streaming.landing_stream import take_up


def arrivals(spark, *data):
    """Pages ``(endpoint, content, hour)`` of one provider, named by position."""
    raw = spark.createDataFrame(
        [("VOI", e, c, f"f{i}", f"2024-01-{1 + h // 24:02d} {h % 24:02d}:00:00") for i, (e, c, h) in enumerate(data)],
        "provider string, endpoint string, content string, filename string, at string",
    )
    return with_hash(raw.withColumn("load_ts", F.to_timestamp("at")).drop("at"))


A, B, A2 = '{"x":1,"y":2}', '{"x":2}', '{"y": 2, "x": 1}'


def test_last_hash_keeps_a_b_a_and_any_hash_does_not(spark):
    new = arrivals(spark, ("E", A, 0), ("E", A2, 1), ("E", B, 2), ("E", A, 30), ("E", A2, 60), ("T", A, 3))
    assert rows(keep_if_changed(new), "filename") == [("f0",), ("f2",), ("f3",), ("f5",)]
    assert rows(keep_if_unseen(new), "filename") == [("f0",), ("f2",), ("f5",)]


def test_new_pages_follow_the_stored_ones(spark):
    stored = arrivals(spark, ("E", A, 0), ("E", B, 5))
    new = arrivals(spark, ("E", B, 10), ("E", A, 11), ("T", B, 12))
    assert rows(last_hashes(stored), "endpoint", "md5_hash") == [("E", new.first().md5_hash)]
    assert rows(keep_if_changed(new, stored), "filename") == [("f1",), ("f2",)]
    assert rows(keep_if_unseen(new, stored), "filename") == [("f2",)]


def test_a_missing_hash_equals_nothing(spark):
    new = arrivals(spark, ("E", A, 0), ("E", A, 1)).withColumn("md5_hash", F.lit(None).cast("string"))
    assert rows(keep_if_changed(new), "filename") == [("f0",), ("f1",)]
    assert rows(keep_if_unseen(new, new), "filename") == [("f0",), ("f1",)]


def test_one_name_may_hold_several_pages(spark):
    new = arrivals(spark, ("E", A, 0), ("E", A2, 0), ("E", B, 0)).withColumn("filename", F.lit("same"))
    for keep in (keep_if_changed, keep_if_unseen):
        assert sorted(json.loads(r.content)["x"] for r in keep(new).collect()) == [1, 2]
    again = arrivals(spark, ("E", A, 0), ("E", B, 1), ("E", A, 2)).withColumn("filename", F.lit("same"))
    assert keep_if_changed(again).count() == 3 and keep_if_unseen(again).count() == 2


def test_unknown_tables_are_kept(spark):
    new = arrivals(spark, ("E", A, 0), (None, A, 1), (None, A2, 2), (None, B, 3))
    assert rows(keep_if_unseen(new), "filename") == [("f0",), ("f1",), ("f3",)]
    assert rows(keep_if_changed(new), "filename") == [("f0",), ("f1",), ("f3",)]
    assert rows(keep_if_unseen(new, new.where("endpoint IS NULL")), "filename") == [("f0",)]


def test_empty_payloads(spark):
    bodies = {
        "keep1": '{"data":{"trips":[1]}}', "keep2": '{"data":{"other":[]}}', "keep3": "[1]", "keep4": '{"trips":[]}',
        "drop1": '{"data":{"trips":[]}}', "drop2": '{"data":{"trips":null}}', "drop3": "[ ]", "drop4": "{}", "drop5": '{"data":{"trips":{}}}',
    }
    df = spark.createDataFrame([(k, v, "trips") for k, v in bodies.items()], "name string, content string, leaf string")
    assert rows(drop_empty(df), "name") == [("keep1",), ("keep2",), ("keep3",), ("keep4",)]


def test_file_names(spark):
    names = {
        "voi_vehicles_status_2024-04-15T10_p2.json": ("voi", "vehicles_status", 2, "2024-04-15 10:00:00"),
        "poppy_trips_brussels_20240415_p1.json": ("poppy", "trips_brussels", 1, "2024-04-15 00:00:00"),
        "poppy_trips_2024-04-15_p11.json": ("poppy", "trips", 11, "2024-04-15 00:00:00"),
        "telemetry_2024-04-15T10.json": ("dott", "telemetry", 1, "2024-04-15 10:00:00"),
        "telemetry_later.json": ("dott", "telemetry", 1, "2030-01-01 00:00:00"),
        "note.json": (None, None, None, "2030-01-01 00:00:00"),
    }
    df = spark.createDataFrame([(n,) for n in names], "filename string")
    got = parse_names(df, F.lit("2030-01-01 00:00:00").cast("timestamp"))
    for r in got.withColumn("file_ts", F.col("file_ts").cast("string")).collect():
        assert (r.provider, r.slug, r.page_no, r.file_ts) == names[r.filename]


def land(folder, **files):
    folder.mkdir(exist_ok=True)
    for name, content in files.items():
        (folder / f"{name}.json").write_text(content)


def test_landed_files_become_bronze_rows(spark, tmp_path):
    land(
        tmp_path / "in",
        **{
            "telemetry_2024-04-15T10": '[{"device_id":"d1"}]',
            "poppy_trips_brussels_20240415_p1": '[{"trip_id":"t1"}]',
            "bolt_status_changes_2024-04-15T10_p1": '{\n "status_changes": [\n {} ]}',
            "unknown": "{}",
        },
    )
    got = read_pages(spark, str(tmp_path / "in"))
    assert rows(got, "provider", "endpoint", "content", "leaf") == [
        ("BOLT", "STATUS_CHANGES", '{\n "status_changes": [\n {} ]}', "status_changes"),
        ("DOTT", "TELEMETRY", '{"telemetry":[{"device_id":"d1"}]}', "telemetry"),
        ("POPPY", "TRIPS", '[{"trip_id":"t1"}]', "brussels"),
        (None, None, "{}", None),
    ]
    bronze = str(tmp_path / "bronze")
    append_pages(got.where("endpoint IS NOT NULL"), bronze, F.lit("2024-04-15 12:00:00").cast("timestamp"))
    stored = read_bronze(spark, bronze)
    assert stored.count() == 3
    assert rows(scan(stored, "DOTT", "TELEMETRY"), "filename") == [("telemetry_2024-04-15T10.json",)]
    # The same folder once more adds nothing.
    assert keep_if_unseen(got.where("endpoint IS NOT NULL"), stored, order=("landed_at", "path"), page_key=("path",)).count() == 0


def test_pages_without_hash_can_be_stored(spark, page, tmp_path):
    bronze = str(tmp_path / "bronze")
    append_pages(page(("VOI", "VEHICLES", "{}")).drop("md5_hash", "load_ts"), bronze)
    first = read_bronze(spark, bronze).first()
    assert first.md5_hash is None and first.load_ts is not None


def test_stream_takes_up_new_files_once(spark, tmp_path):
    landing, bronze, state = tmp_path / "in", str(tmp_path / "bronze"), str(tmp_path / "state")
    land(landing, **{"voi_trips_2024-04-15T10_p1": A, "voi_trips_2024-04-15T11_p1": '{\n"x":2\n}'})
    take_up(spark, str(landing), bronze, state).awaitTermination()
    land(landing, **{"voi_trips_2024-04-15T12_p1": A2, "voi_trips_2024-04-15T13_p1": '{"x":3}'})
    take_up(spark, str(landing), bronze, state).awaitTermination()
    take_up(spark, str(landing), bronze, state).awaitTermination()
    # By hash the third file is the first one again; the batch read gives the same bronze rows.
    got = rows(read_bronze(spark, bronze), "filename")
    assert got == [("voi_trips_2024-04-15T10_p1.json",), ("voi_trips_2024-04-15T11_p1.json",), ("voi_trips_2024-04-15T13_p1.json",)]
    batch = keep_if_unseen(read_pages(spark, str(landing)), order=("landed_at", "path"), page_key=("path",))
    assert rows(batch, "filename") == got


def test_files_of_unknown_name_are_kept_aside(spark, tmp_path):
    landing, bronze = tmp_path / "in", str(tmp_path / "bronze")
    land(landing, **{"nobody_knows": '{"a":1}', "poppy_trips_2024-04-15_p1": '[{"trip_id":"t"}]', "voi_trips_2024-04-15T10_p1": '{"data":{"trips":[]}}'})
    take_up(spark, str(landing), bronze, str(tmp_path / "state")).awaitTermination()
    assert rows(read_bronze(spark, bronze), "provider", "endpoint", "page_no") == [("POPPY", "TRIPS", 1)]
    assert rows(spark.read.parquet(f"{bronze}_unknown"), "filename", "content") == [("nobody_knows.json", '{"a":1}')]


def test_merged_hours_round_trip(spark, tmp_path):
    pages = spark.createDataFrame(
        [("DOTT", "TELEMETRY", '{"telemetry":[{"a":1},{"a":2}]}', 1, "2024-04-15 10:20:00"), ("DOTT", "TELEMETRY", '{"telemetry":[{"a":3}]}', 2, "2024-04-15 10:00:00"),
         ("DOTT", "TELEMETRY", '{"telemetry":[]}', 1, "2024-04-15 11:00:00")],
        "provider string, endpoint string, content string, page_no int, at string",
    ).withColumn("page_time", F.to_timestamp("at"))
    items = merged_items(pages)
    assert rows(items, "page_no", "pos", "item") == [(1, 0, '{"a":1}'), (1, 1, '{"a":2}'), (2, 0, '{"a":3}')]
    write_hours(items, str(tmp_path / "hours"))
    assert (tmp_path / "hours" / "hour=2024-04-15T10").exists()
    assert rows(spark.read.json(str(tmp_path / "hours")), "item") == [('{"a":1}',), ('{"a":2}',), ('{"a":3}',)]


def test_pages_of_an_hour_stay_small_where_places_repeat(spark):
    made = spark.range(0, 500, 1, 4).selectExpr("'DOTT' AS provider", "'TELEMETRY' AS endpoint", "timestamp'2024-04-15 10:00:00' AS hour", "1 AS page_no",
                                                "int(id % 7) AS pos", "concat('{\"a\":', id, '}') AS item")
    packed = hour_pages(made, size=5)
    counted = packed.select(F.size(F.from_json("content", "struct<telemetry:array<string>>")["telemetry"]).alias("n"), "content")
    assert counted.agg(F.max("n"), F.sum("n")).first()[:] == (5, 500)
    again = counted.select(F.explode(F.from_json("content", "struct<telemetry:array<struct<a:int>>>")["telemetry"]["a"]).alias("a"))
    assert sorted(r.a for r in again.collect()) == list(range(500))


def test_catalogue(spark):
    cat = endpoint_catalogue(spark)
    assert cat.count() == 18 and cat.where("cadence = 'daily'").count() == 3 and cat.where("in_backfill").count() == 7
    assert rows(cat.where("format_version = '1.2'"), "raw_table") == [("BOLT_STATUS_CHANGES",), ("DOTT_EVENTS",), ("DOTT_VEHICLES",)]
    inlined = with_endpoints(spark.range(1)).drop("id")
    assert rows(inlined, *cat.columns) == rows(cat)


def test_grids_and_gaps(spark):
    cat = spark.createDataFrame([("voi", "trips")], "provider string, endpoint string")
    start, end = (F.lit(t).cast("timestamp") for t in ("2024-04-15 10:00:00", "2024-04-15 12:00:00"))

    def hours(df):
        return [r.slot.hour for r in df.orderBy("slot").collect()]

    assert hours(expected_grid(cat, start, end)) == [10, 11]
    assert hours(expected_grid(cat, start, end, inclusive=True)) == [10, 11, 12]
    assert expected_grid(cat, end, start).count() == 0
    assert expected_grid(cat, start, start).count() == 0
    grid = expected_grid(cat, start, end, inclusive=True)
    landed = grid.where(F.hour("slot") == 11)
    assert hours(landing_gaps(grid, landed.unionByName(landed))) == [10, 12]


def test_page_runs(spark):
    def body(more):
        return json.dumps({"links": {"next": "u"} if more else {}})

    landed = spark.createDataFrame(
        [("r1", 1, body(True)), ("r1", 2, body(False)), ("r2", 1, body(True)), ("r2", 1, body(True)), ("r3", 1, body(False)), ("r4", 1, "[1]")],
        "run string, page_no int, content string",
    )
    assert rows(page_gaps(landed, run=("run",))) == [("r2", 2)]


def test_how_far_runs_are_unbroken(spark):
    more, end = '{"links":{"next":"u"}}', "[1]"
    landed = spark.createDataFrame(
        [("whole", 1, more), ("whole", 2, more), ("whole", 3, end), ("whole", 3, end), ("cut", 1, more), ("cut", 2, more), ("hole", 1, more), ("hole", 3, end),
         ("hole", 4, end), ("late", 2, end), ("one", 1, None), (None, 1, more), (None, 2, end), ("odd", None, end), ("odd", 0, more), ("odd", 1, end)],
        "run string, page_no int, content string",
    )
    want = [("whole", 3, 3, 3, True), ("cut", 2, 2, 2, False), ("hole", 3, 4, 1, False), ("late", 1, 2, 0, False), ("one", 1, 1, 1, True), (None, 2, 2, 2, True),
            ("odd", 1, 1, 1, True)]
    assert rows(page_runs(landed, run=("run",)), "run", "n_pages", "last_page", "unbroken", "whole") == sorted(want, key=repr)
    used = [(name, n) for name, _, _, reach, _ in want for n in range(1, reach + 1)] + [("whole", 3)]
    assert rows(unbroken_pages(landed, run=("run",)), "run", "page_no") == sorted(used, key=repr)
    assert page_runs(landed.limit(0), run=("run",)).count() == 0


def test_seed_list(spark, tmp_path):
    (tmp_path / "lost.csv").write_text('TRIP_ID,VEHICLE_ID,VEHICLE_TYPE\nt1,"a,b",bicycle\nt2,,\n')
    assert rows(read_seed(spark, str(tmp_path / "lost.csv"), "Voi")) == [("Voi", "t1", "a,b", "bicycle"), ("Voi", "t2", None, None)]


def test_dump_import_is_all_or_nothing(spark, tmp_path):
    target = str(tmp_path / "table")
    (tmp_path / "good.csv").write_text('id,note\n1,"say ""hi"", twice"\n2,plain\n')
    (tmp_path / "bad.csv").write_text("id,note\n3,x\nnot a number,y\n")
    import_dump(spark, str(tmp_path / "good.csv"), "id int, note string", target)
    with pytest.raises((PySparkException, Py4JJavaError)):
        import_dump(spark, str(tmp_path / "bad.csv"), "id int, note string", target)
    assert rows(read_table(spark, target)) == [(1, 'say "hi", twice'), (2, "plain")]
    wide = read_table(spark, target, "id int, note string, md5_hash string")
    assert rows(wide, "id", "md5_hash") == [(1, None), (2, None)]


ORDER = {"order": ("load_ts", "filename"), "page_key": ("filename",)}


def batches(spark):
    """A, B | B, A | A2, C in one raw table and A in another."""
    return [
        arrivals(spark, ("E", A, 0), ("E", B, 1)),
        arrivals(spark, ("E", B, 2), ("E", A, 3), ("T", A, 3)),
        arrivals(spark, ("E", A2, 4), ("E", '{"x":3}', 5), (None, A, 5)),
    ]


def stored_pages(spark, bronze):
    return rows(read_bronze(spark, bronze).selectExpr("endpoint", "filename", "dense_rank() OVER (ORDER BY load_ts) AS batch"), "batch", "endpoint", "filename")


WANT = {
    "seen": [(1, "E", "f0"), (1, "E", "f1"), (2, "T", "f2"), (3, "E", "f1"), (3, None, "f2")],
    "changed": [(1, "E", "f0"), (1, "E", "f1"), (2, "E", "f1"), (2, "T", "f2"), (3, "E", "f1"), (3, None, "f2")],
}


def with_file_ts(df):
    return df.withColumn("file_ts", F.col("load_ts"))


@pytest.mark.parametrize("rule", ["seen", "changed"])
def test_batches_are_decided_on_the_kept_state(spark, tmp_path, rule):
    bronze, state = str(tmp_path / "bronze"), str(tmp_path / "state")
    for number, batch in enumerate(batches(spark)):
        assert page_state.land(with_file_ts(batch), bronze, state, number, rule, **ORDER)
        assert not page_state.land(with_file_ts(batch), bronze, state, number, rule, **ORDER)
        if number == 1:
            page_state.compact(spark, state)
    assert stored_pages(spark, bronze) == sorted(WANT[rule], key=repr)
    with pytest.raises(ValueError, match="rule"):
        page_state.land(with_file_ts(batch), bronze, state, 9, "other", **ORDER)
    assert page_state.land(with_file_ts(batch).limit(0), bronze, state, 9, rule, **ORDER)
    assert len(stored_pages(spark, bronze)) == len(WANT[rule])


@pytest.mark.parametrize("rule", ["seen", "changed"])
@pytest.mark.parametrize("step", ["append_pages", "add_hashes", "_write_last", "_mark"])
def test_a_batch_that_died_is_repeated_without_loss_or_copies(spark, tmp_path, monkeypatch, rule, step):
    bronze, state = str(tmp_path / "bronze"), str(tmp_path / "state")
    first, second, third = map(with_file_ts, batches(spark))
    page_state.land(first, bronze, state, 0, rule, **ORDER)
    real = getattr(page_state, step)

    def half(pages, *args):
        if step == "append_pages":  # one page is stored, then the driver is lost
            real(pages.orderBy("filename").limit(1), *args)
        raise RuntimeError("lost")

    monkeypatch.setattr(page_state, step, half)
    with pytest.raises(RuntimeError, match="lost"):
        page_state.land(second, bronze, state, 1, rule, **ORDER)
    monkeypatch.setattr(page_state, step, real)
    assert page_state.land(second, bronze, state, 1, rule, **ORDER)
    assert page_state.land(third, bronze, state, 2, rule, **ORDER)
    assert stored_pages(spark, bronze) == sorted(WANT[rule], key=repr)


def test_a_new_state_takes_up_what_bronze_holds(spark, tmp_path):
    bronze = str(tmp_path / "bronze")
    first, second, _ = map(with_file_ts, batches(spark))
    append_pages(first, bronze)
    # The second state finds the first one's page of table T in bronze.
    for rule, found in (("seen", [("f2",)]), ("changed", [("f1",), ("f2",)])):
        page_state.land(second, bronze, str(tmp_path / rule), 0, rule, **ORDER)
        assert rows(read_bronze(spark, bronze).where("load_date > '2024-12-31'"), "filename") == found


def test_a_batch_opens_only_the_partitions_of_its_hashes(spark, tmp_path):
    state = str(tmp_path / "state")
    page_state.add_hashes(arrivals(spark, *[("E", f'{{"x":{i}}}', i) for i in range(60)]), state)
    few = arrivals(spark, ("E", '{"x":7}', 0), ("E", "new", 1))
    text = page_state.seen_hashes(few, state)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(" in text and "ReadSchema: struct<md5_hash:string>" in text and "PushedFilters: []" in text
    found = {r.md5_hash[:2] for r in page_state.seen_hashes(few, state).collect()}
    assert found <= {r.md5_hash[:2] for r in few.collect()} and len(found) >= 1


def test_stream_with_the_last_hash_rule_keeps_a_b_a_over_restarts(spark, tmp_path):
    landing, bronze, state = tmp_path / "in", str(tmp_path / "bronze"), str(tmp_path / "state")
    for hour, body in enumerate((A, B, A2, A, B)):
        land(landing, **{f"voi_trips_2024-04-15T1{hour}_p1": body})
        take_up(spark, str(landing), bronze, state, rule="changed").awaitTermination()
    assert [name[0][21:23] for name in rows(read_bronze(spark, bronze), "filename")] == ["10", "11", "12", "14"]
