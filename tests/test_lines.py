"""Lines of telemetry and the settings their stages run under."""

import re

from conftest import rows
from pyspark.sql import functions as F

from kerbside import configure
from kerbside.operators.routes import line_agg, trip_lines

PINGS = "provider_name string, trip_id string, ping_ms long, lon double, lat double"
HOUR = 3_600_000


def text(line):
    return F.concat_ws(", ", F.transform(line, lambda p: F.concat_ws(" ", p["lon"], p["lat"])))


def lines(spark, *data):
    got = trip_lines(spark.createDataFrame(list(data), PINGS).repartition(3))
    return rows(got.select("trip_id", *[F.when(F.col(c).isNotNull(), text(c)).alias(c) for c in ("dott_line", "bolt_line")]))


def test_copies_stay_or_go_by_provider(spark):
    twice = [("t", 5, 2.0, 2.0), ("t", 5, 2.0, 2.0), ("t", HOUR, 1.0, 1.0), ("t", None, 9.0, 9.0), ("t", None, 9.0, 9.0), ("t", 4, None, 1.0)]
    assert lines(spark, *[(p, *ping) for p in ("Dott", "Bolt") for ping in twice]) == [
        ("t", "2.0 2.0, 1.0 1.0, 9.0 9.0", "2.0 2.0, 2.0 2.0, 1.0 1.0, 9.0 9.0, 9.0 9.0"),
    ]


def test_trips_without_points_have_no_line(spark):
    nothing = [("Dott", "a", 1, None, 1.0), ("Bolt", "b", 1, 1.0, None), ("Voi", "v", 1, 1.0, 1.0), (None, "n", 1, 1.0, 1.0), ("Bolt", None, 1, 1.0, 1.0)]
    assert lines(spark, *nothing) == [("a", None, None), ("b", None, None), ("n", None, None), ("v", None, None)]


def test_equal_times_go_by_place(spark):
    pings = spark.createDataFrame([("Bolt", "t", 7, 3.0, 1.0), ("Bolt", "t", 7, 2.0, 5.0), ("Bolt", "t", 7, 2.0, 4.0)], PINGS)
    assert rows(line_agg(pings, ["trip_id"]).select(text("line"))) == [("2.0 4.0, 2.0 5.0, 3.0 1.0",)]


def test_a_piece_is_gathered_in_one_collection(spark):
    """Each of the four passes over the pings fills a single collection, whatever the number of lines."""
    plan = trip_lines(spark.createDataFrame([], PINGS))._jdf.queryExecution().executedPlan().toString()
    passes = re.findall(r"Aggregate\(keys=.*functions=\[(.*?)\]", plan)
    assert len(passes) == 4 and all(p.count("collect_") == 1 for p in passes)


def test_shuffles_are_read_in_small_partitions(spark):
    configure(spark)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"
