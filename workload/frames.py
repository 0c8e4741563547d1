"""Fleet frames derived from the star-schema tables, row for row the same as ``oracle.FRAMES``.

Events become vehicle reports, orders trips, line items telemetry pings, customers the vehicle registry,
urgent orders the list of corrected trips and parts the vehicle types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _provider(key: str) -> str:
    return f"CASE {key} % 4 WHEN 0 THEN 'Voi' WHEN 1 THEN 'Dott' WHEN 2 THEN 'Bolt' ELSE 'Poppy' END"


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle reports; instants are cut to the hour, so one vehicle often reports twice at once."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "'dev-' || user_id AS device_id",
        "'dev-' || user_id AS vehicle_id",
        f"{_provider('user_id')} AS provider_name",
        "'vt-' || (user_id * 20) AS vehicle_type_id",
        """CASE event_type WHEN 'view' THEN 'available' WHEN 'click' THEN 'available' WHEN 'signup' THEN 'reserved'
                WHEN 'purchase' THEN 'on_trip' ELSE 'non_operational' END AS vehicle_state""",
        """CASE event_type WHEN 'view' THEN 'telemetry' WHEN 'click' THEN 'ping' WHEN 'signup' THEN 'trip_start'
                WHEN 'purchase' THEN 'trip_end' ELSE 'maintenance_pick_up' END AS event_type""",
        "50.8D + (CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT) % 3) * 0.0003D AS lat",
        "4.3D + (event_id % 2) * 0.0003D AS lon",
        "CASE WHEN event_type IN ('signup', 'purchase') THEN 't-' || event_id END AS trip_id",
        "value / 500D AS battery_pct",
        "CAST(date_trunc('HOUR', ts) AS TIMESTAMP) AS reported_at",
        "CAST(ts AS TIMESTAMP) AS seen_at",
        "CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT) % 3 AS clock",
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips; some lack a start time or an end point, finished orders deliver a route over a via point."""
    return table(spark, sf_dir, "orders").selectExpr(
        "'t-' || o_orderkey AS trip_id",
        "'dev-' || o_custkey AS device_id",
        f"{_provider('o_orderkey')} AS provider_name",
        "CASE WHEN o_orderkey % 97 <> 0 THEN CAST(o_orderdate AS TIMESTAMP) END AS start_ts",
        "timestamp_seconds(unix_seconds(CAST(o_orderdate AS TIMESTAMP)) + o_orderkey % 3600) AS end_ts",
        "o_orderkey % 3600 AS duration",
        "o_totalprice AS distance",
        "50.8D + (o_orderkey % 100) * 0.001D AS start_lat",
        "4.3D + (o_orderkey % 50) * 0.001D AS start_lon",
        "CASE WHEN o_orderkey % 31 <> 0 THEN 50.9D END AS end_lat",
        "4.4D AS end_lon",
        "CASE WHEN o_orderstatus = 'F' THEN 50.85D END AS via_lat",
        "CASE WHEN o_orderstatus = 'F' THEN 4.35D END AS via_lon",
        "CASE WHEN o_orderkey % 3 = 0 THEN 'scooter_standing' ELSE 'car' END AS vehicle_type",
        "o_orderstatus",
        "o_orderpriority",
    )


def trip_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips with ``load_ts``; pending orders are delivered again a day later, starting an hour later."""
    first = trips(spark, sf_dir).withColumn("load_ts", F.lit("2024-02-01 00:00:00").cast("timestamp"))
    again = first.where("o_orderstatus = 'P'").withColumns(
        {"start_ts": F.expr("start_ts + INTERVAL 1 HOUR"), "load_ts": F.expr("load_ts + INTERVAL 1 DAY")}
    )
    return first.unionByName(again)


def pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry pings of the trips; a discount of zero stands for a missing position."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "'t-' || l_orderkey AS trip_id",
        f"{_provider('l_orderkey')} AS provider_name",
        "'dev-' || l_suppkey AS device_id",
        "unix_millis(CAST(l_shipdate AS TIMESTAMP)) AS ping_ms",
        "CASE WHEN l_discount > 0D THEN 50.8D + l_quantity * 0.001D END AS lat",
        "4.3D + l_discount AS lon",
        "l_returnflag",
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle registry; buildings have no type, cars are registered twice."""
    base = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey",
        "c_mktsegment",
        f"{_provider('c_custkey')} AS provider_name",
        "'dev-' || c_custkey AS device_id",
        """CASE c_mktsegment WHEN 'FURNITURE' THEN 'scooter' WHEN 'HOUSEHOLD' THEN 'bicycle'
                WHEN 'MACHINERY' THEN 'scooter_standing' WHEN 'AUTOMOBILE' THEN 'car' END AS vehicle_type""",
    )
    letters = F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.array(F.lit("v-"), F.lit("w-"))).otherwise(F.array(F.lit("v-")))
    return base.withColumn("letter", F.explode(letters)).selectExpr(
        "provider_name", "device_id", "letter || c_custkey AS vehicle_id", "vehicle_type"
    )


def seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrected vehicles of the urgent orders."""
    return table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").selectExpr(
        f"{_provider('o_orderkey')} AS provider_name",
        "'t-' || o_orderkey AS TRIP_ID",
        "'s-' || o_custkey AS VEHICLE_ID",
        "'bicycle' AS VEHICLE_TYPE",
    )


def types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle types by id, one per part; a fifth has no type and some reports name an id that is missing."""
    return table(spark, sf_dir, "part").selectExpr(
        "'vt-' || p_partkey AS vehicle_type_id",
        "CASE p_size % 5 WHEN 0 THEN 'car' WHEN 1 THEN 'van' WHEN 2 THEN 'truck' WHEN 3 THEN 'moped' END AS vehicle_type",
    )
