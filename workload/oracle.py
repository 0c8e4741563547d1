"""The same results as plain SQL on the star-schema tables, for DuckDB."""

from __future__ import annotations

# The frames of ``frames.py`` as common table expressions, with the frames each one reads.


def _provider(key: str) -> str:
    return f"CASE {key} % 4 WHEN 0 THEN 'Voi' WHEN 1 THEN 'Dott' WHEN 2 THEN 'Bolt' ELSE 'Poppy' END"


FRAMES: dict[str, tuple[tuple[str, ...], str]] = {
    "reports": ((), f"""
        SELECT event_id, 'dev-' || user_id AS device_id, 'dev-' || user_id AS vehicle_id, {_provider('user_id')} AS provider_name,
               'vt-' || (user_id * 20) AS vehicle_type_id,
               CASE event_type WHEN 'view' THEN 'available' WHEN 'click' THEN 'available' WHEN 'signup' THEN 'reserved'
                    WHEN 'purchase' THEN 'on_trip' ELSE 'non_operational' END AS vehicle_state,
               CASE event_type WHEN 'view' THEN 'telemetry' WHEN 'click' THEN 'ping' WHEN 'signup' THEN 'trip_start'
                    WHEN 'purchase' THEN 'trip_end' ELSE 'maintenance_pick_up' END AS event_type,
               50.8::DOUBLE + (CAST(regexp_extract(props, '[0-9]+') AS BIGINT) % 3)::DOUBLE * 0.0003::DOUBLE AS lat,
               4.3::DOUBLE + (event_id % 2)::DOUBLE * 0.0003::DOUBLE AS lon,
               CASE WHEN event_type IN ('signup', 'purchase') THEN 't-' || event_id END AS trip_id,
               value / 500::DOUBLE AS battery_pct, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS reported_at, ts AS seen_at,
               CAST(regexp_extract(props, '[0-9]+') AS BIGINT) % 3 AS clock
        FROM events"""),
    "trips": ((), f"""
        SELECT o_orderkey AS trip_no, 't-' || o_orderkey AS trip_id, 'dev-' || o_custkey AS device_id, {_provider('o_orderkey')} AS provider_name,
               CASE WHEN o_orderkey % 97 <> 0 THEN o_orderdate END AS start_ts,
               o_orderdate + INTERVAL 1 SECOND * (o_orderkey % 3600) AS end_ts, o_orderkey % 3600 AS duration, o_totalprice AS distance,
               50.8::DOUBLE + (o_orderkey % 100)::DOUBLE * 0.001::DOUBLE AS start_lat,
               4.3::DOUBLE + (o_orderkey % 50)::DOUBLE * 0.001::DOUBLE AS start_lon,
               CASE WHEN o_orderkey % 31 <> 0 THEN 50.9::DOUBLE END AS end_lat, 4.4::DOUBLE AS end_lon,
               CASE WHEN o_orderstatus = 'F' THEN 50.85::DOUBLE END AS via_lat,
               CASE WHEN o_orderstatus = 'F' THEN 4.35::DOUBLE END AS via_lon,
               CASE WHEN o_orderkey % 3 = 0 THEN 'scooter_standing' ELSE 'car' END AS vehicle_type, o_orderstatus, o_orderpriority
        FROM orders"""),
    "trip_copies": (("trips",), """
        SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS load_ts FROM trips
        UNION ALL
        SELECT * REPLACE (start_ts + INTERVAL 1 HOUR AS start_ts), TIMESTAMP '2024-02-02 00:00:00' AS load_ts
        FROM trips WHERE o_orderstatus = 'P'"""),
    "pings": ((), f"""
        SELECT 't-' || l_orderkey AS trip_id, {_provider('l_orderkey')} AS provider_name, 'dev-' || l_suppkey AS device_id,
               CAST(epoch_ms(l_shipdate) AS BIGINT) AS ping_ms,
               CASE WHEN l_discount > 0 THEN 50.8::DOUBLE + l_quantity * 0.001::DOUBLE END AS lat, 4.3::DOUBLE + l_discount AS lon, l_returnflag
        FROM lineitem"""),
    "registry": ((), f"""
        SELECT {_provider('c_custkey')} AS provider_name, 'dev-' || c_custkey AS device_id, letter || c_custkey AS vehicle_id,
               CASE c_mktsegment WHEN 'FURNITURE' THEN 'scooter' WHEN 'HOUSEHOLD' THEN 'bicycle'
                    WHEN 'MACHINERY' THEN 'scooter_standing' WHEN 'AUTOMOBILE' THEN 'car' END AS vehicle_type
        FROM customer JOIN (VALUES ('v-'), ('w-')) AS l(letter) ON letter = 'v-' OR c_mktsegment = 'AUTOMOBILE'"""),
    "seeds": ((), f"""
        SELECT {_provider('o_orderkey')} AS provider_name, 't-' || o_orderkey AS trip_id, 's-' || o_custkey AS vehicle_id, 'bicycle' AS vehicle_type
        FROM orders WHERE o_orderpriority = '1-URGENT'"""),
    "types": ((), """
        SELECT 'vt-' || p_partkey AS vehicle_type_id,
               CASE p_size % 5 WHEN 0 THEN 'car' WHEN 1 THEN 'van' WHEN 2 THEN 'truck' WHEN 3 THEN 'moped' END AS vehicle_type
        FROM part"""),
    # One report per vehicle and instant.
    "best": (("reports",), """
        SELECT * FROM reports
        QUALIFY row_number() OVER (PARTITION BY vehicle_id, provider_name, reported_at ORDER BY
            CASE WHEN event_type IN ('trip_start', 'trip_end') THEN 1 WHEN event_type = 'maintenance_pick_up' THEN 2 ELSE 3 END,
            event_type NULLS LAST, vehicle_state NULLS LAST, trip_id NULLS LAST, lat NULLS LAST, lon NULLS LAST) = 1"""),
    # Points of each line: step 0 start, 1 on the way, 2 end; ``ord`` and the position order the points of a step.
    "delivered": (("trips",), """
        SELECT trip_id, provider_name, 0 AS step, 0 AS ord, start_lon AS lon, start_lat AS lat FROM trips WHERE via_lat IS NOT NULL
        UNION ALL SELECT trip_id, provider_name, 1, 0, via_lon, via_lat FROM trips WHERE via_lat IS NOT NULL
        UNION ALL SELECT trip_id, provider_name, 2, 0, end_lon, end_lat FROM trips WHERE via_lat IS NOT NULL AND end_lat IS NOT NULL"""),
    "direct": (("trips",), """
        SELECT trip_id, provider_name, 0 AS step, 0 AS ord, start_lon AS lon, start_lat AS lat FROM trips WHERE end_lat IS NOT NULL
        UNION ALL SELECT trip_id, provider_name, 2, 0, end_lon, end_lat FROM trips WHERE end_lat IS NOT NULL"""),
    "delivered_or_direct": (("delivered", "direct"), """
        SELECT * FROM delivered
        UNION ALL SELECT * FROM direct WHERE trip_id NOT IN (SELECT trip_id FROM delivered)"""),
}

# What differs between the direct frames and the frames that went through pages.
FRAMES["placed"] = (("pings",), "SELECT * FROM pings WHERE lat IS NOT NULL")
FRAMES["placed_in_pages"] = (("pings",), """
    SELECT * FROM pings WHERE lat IS NOT NULL AND (provider_name = 'Bolt' OR l_returnflag <> 'R')""")


def _route_points(placed: str, delivered_poppy: str) -> str:
    """Numbered points of every route; ``delivered_poppy`` is the frame of Poppy's own routes."""
    return f"""
    SELECT trip_id, provider_name, lon, lat, row_number() OVER (PARTITION BY trip_id ORDER BY step, ord, lon, lat) - 1 AS seq
    FROM (
        SELECT *, lag(lon) OVER w AS prev_lon, lag(lat) OVER w AS prev_lat
        FROM (
            SELECT * FROM delivered_or_direct WHERE provider_name = 'Voi'
            UNION ALL SELECT * FROM {delivered_poppy} WHERE provider_name = 'Poppy'
            UNION ALL SELECT * FROM delivered_or_direct WHERE provider_name = 'Dott' AND trip_id NOT IN (SELECT trip_id FROM {placed})
            UNION ALL SELECT trip_id, provider_name, step, ord, lon, lat FROM direct
                      WHERE provider_name = 'Dott' AND trip_id IN (SELECT trip_id FROM {placed})
            UNION ALL SELECT p.trip_id, p.provider_name, 1, p.ping_ms, p.lon, p.lat FROM {placed} p JOIN trips t USING (trip_id)
                      WHERE p.provider_name = 'Dott' AND t.end_lat IS NOT NULL
            UNION ALL SELECT p.trip_id, p.provider_name, 1, p.ping_ms, p.lon, p.lat FROM {placed} p JOIN trips t USING (trip_id)
                      WHERE p.provider_name = 'Bolt'
            UNION ALL SELECT * FROM direct WHERE provider_name = 'Bolt' AND trip_id NOT IN (SELECT trip_id FROM {placed})
        )
        WINDOW w AS (PARTITION BY trip_id ORDER BY step, ord, lon, lat)
    )
    WHERE provider_name <> 'Dott' OR prev_lon IS NULL OR lon <> prev_lon OR lat <> prev_lat"""


FRAMES["routes"] = (("delivered_or_direct", "placed"), _route_points("placed", "delivered"))
FRAMES["routes_in_pages"] = (("delivered_or_direct", "placed_in_pages"), _route_points("placed_in_pages", "direct"))


def with_frames(select: str, *names: str) -> str:
    """``select`` after the common table expressions it reads, directly or not."""
    order: list[str] = []

    def visit(name: str) -> None:
        for needed in FRAMES[name][0]:
            visit(needed)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    if not order:
        return select
    return "WITH " + ",\n".join(f"{name} AS ({FRAMES[name][1]})" for name in order) + "\n" + select


SQL: dict[str, str] = {}

PREV = "PARTITION BY vehicle_id, provider_name ORDER BY reported_at NULLS LAST"
NOISE = "('telemetry', 'ping', 'location_update', 'unspecified')"


def timeline(best: str, kept: str = "TRUE") -> str:
    """Mart rows of ``best``: change points of the whole history, ``kept`` of them, with validity ends."""
    return f"""
    SELECT lower(vehicle_id) || '_' || strftime(reported_at, '%Y%m%d_%H%M%S%g') AS "UID", vehicle_id AS "VEHICLE_ID",
           vehicle_type AS "VEHICLE_TYPE", provider_name AS "PROVIDER_NAME", vehicle_state AS "VEHICLE_STATE",
           event_type AS "EVENT_TYPE", round(lat, 6) AS "LAT", round(lon, 6) AS "LON", trip_id AS "TRIP_ID",
           reported_at AS "VALID_FROM_TS", lead(reported_at) OVER (PARTITION BY vehicle_id, provider_name ORDER BY reported_at) AS "VALID_TO_TS"
    FROM (
        SELECT *, lag(vehicle_state) OVER ({PREV}) AS prev_state, lag(lat) OVER ({PREV}) AS prev_lat, lag(lon) OVER ({PREV}) AS prev_lon
        FROM {best}
    )
    WHERE (prev_state IS NULL OR vehicle_state <> prev_state OR abs(lat - prev_lat) > 0.0005::DOUBLE
           OR abs(lon - prev_lon) > 0.0005::DOUBLE OR event_type NOT IN {NOISE}) AND ({kept})"""


TYPED_BEST = "(SELECT *, 'scooter' AS vehicle_type FROM best)"

SQL["status_intervals"] = with_frames(timeline(TYPED_BEST), "best")

SQL["status_incremental"] = with_frames(f"""
, on_time AS (
    SELECT * FROM best_on_time
), stored AS ({timeline("(SELECT *, 'scooter' AS vehicle_type FROM on_time)")}
), batch AS ({timeline(TYPED_BEST, "reported_at >= (SELECT max(\"VALID_FROM_TS\") - INTERVAL 1 DAY FROM stored)")}
)
SELECT * FROM stored WHERE "UID" NOT IN (SELECT "UID" FROM batch) UNION ALL SELECT * FROM batch""".lstrip(), "best")
SQL["status_incremental"] = SQL["status_incremental"].replace("\n, on_time AS", ",\nbest_on_time AS (" + FRAMES["best"][1].replace(
    "SELECT * FROM reports", "SELECT * FROM reports WHERE reported_at < TIMESTAMP '2024-01-20 00:00:00' AND event_type <> 'maintenance_pick_up'"
) + "),\non_time AS")

# Three runs: what each knows, its slice of that, and the mart with the slice put in.
RUN = """(SELECT *, CASE WHEN event_type = 'ping' THEN 3
    WHEN reported_at < TIMESTAMP '2024-01-13 00:00:00' THEN CASE event_type WHEN 'maintenance_pick_up' THEN 2 ELSE 1 END
    WHEN reported_at < TIMESTAMP '2024-01-20 00:00:00' AND event_type <> 'maintenance_pick_up' THEN 2 ELSE 3 END AS run FROM reports)"""


def _after_run(k: int) -> str:
    best = FRAMES["best"][1].replace("SELECT * FROM reports", f"SELECT * FROM {RUN} WHERE run <= {k}")
    known = f"best_{k} AS ({best}), typed_{k} AS (SELECT *, CASE provider_name WHEN 'Poppy' THEN 'car' ELSE 'scooter' END AS vehicle_type FROM best_{k})"
    if k == 1:
        return f"{known}, mart_1 AS ({timeline('typed_1')})"
    sliced = timeline(f"typed_{k}", f'reported_at >= (SELECT max("VALID_FROM_TS") - INTERVAL 1 DAY FROM mart_{k - 1})')
    merged = f'SELECT * FROM mart_{k - 1} WHERE "UID" NOT IN (SELECT "UID" FROM slice_{k}) UNION ALL SELECT * FROM slice_{k}'
    return f"{known}, slice_{k} AS ({sliced}), mart_{k} AS ({merged})"


SQL["status_state_runs"] = with_frames(", " + ", ".join(map(_after_run, (1, 2, 3))) + "\nSELECT * FROM mart_3", "reports")

CUT = "(SELECT max(reported_at) - INTERVAL 1 DAY FROM reports WHERE reported_at < TIMESTAMP '2024-01-20 00:00:00')"
SQL["status_late_rows"] = with_frames(f"SELECT count(*) AS late_rows FROM reports WHERE reported_at < {CUT}", "reports")
SQL["incremental_rows"] = with_frames(f"SELECT event_id, vehicle_id, reported_at FROM reports WHERE reported_at >= {CUT}", "reports")

SQL["status_priority_dedup"] = with_frames("""
SELECT vehicle_id, provider_name, reported_at, vehicle_state, event_type, trip_id, round(lat, 6) AS lat, round(lon, 6) AS lon FROM best""", "best")

SQL["change_points_only"] = with_frames(f"""
SELECT vehicle_id, provider_name, reported_at, vehicle_state, event_type, round(lat, 6) AS lat, round(lon, 6) AS lon, prev_state,
       round(prev_lat, 6) AS prev_lat, round(prev_lon, 6) AS prev_lon
FROM (SELECT *, lag(vehicle_state) OVER ({PREV}) AS prev_state, lag(lat) OVER ({PREV}) AS prev_lat, lag(lon) OVER ({PREV}) AS prev_lon FROM best)
WHERE prev_state IS NULL OR vehicle_state <> prev_state OR abs(lat - prev_lat) > 0.0005::DOUBLE OR abs(lon - prev_lon) > 0.0005::DOUBLE
      OR event_type NOT IN {NOISE}""", "best")

SQL["validity_ends"] = with_frames(f"""
SELECT vehicle_id, provider_name, reported_at, lead(reported_at) OVER ({PREV}) AS valid_to FROM best""", "best")

SQL["trip_events_unpivot"] = with_frames("""
SELECT provider_name, device_id AS vehicle_id, vehicle_type, trip_id, 'reserved' AS vehicle_state, 'trip_start' AS event_type,
       round(start_lat, 6) AS lat, round(start_lon, 6) AS lon, start_ts AS reported_at FROM trips
UNION ALL
SELECT provider_name, device_id, vehicle_type, trip_id, 'available', 'trip_end', round(end_lat, 6), round(end_lon, 6), end_ts FROM trips""", "trips")

SQL["battery_scale"] = with_frames("""
SELECT event_id, round(battery_pct * 100, 6) AS battery_percent, seen_at - INTERVAL 1 HOUR AS hour_before FROM reports""", "reports")

SQL["trips_latest"] = with_frames("""
SELECT trip_id, provider_name, device_id, start_ts, load_ts FROM trip_copies
QUALIFY row_number() OVER (PARTITION BY trip_id ORDER BY start_ts DESC NULLS FIRST, load_ts, provider_name, device_id) = 1""", "trip_copies")

SQL["trips_union"] = with_frames("""
SELECT trip_id, CASE WHEN provider_name <> 'Voi' THEN device_id END AS vehicle_id,
       CASE provider_name WHEN 'Dott' THEN 'bicycle' WHEN 'Bolt' THEN 'scooter' WHEN 'Poppy' THEN vehicle_type END AS vehicle_type,
       provider_name, start_ts, end_ts, round(duration::DOUBLE, 6) AS trip_duration FROM trips""", "trips")

SQL["trips_enriched"] = with_frames("""
SELECT t.trip_id, coalesce(r.vehicle_id, t.device_id) AS vehicle_id, coalesce(r.vehicle_type, 'bicycle') AS vehicle_type, t.start_ts
FROM trips t LEFT JOIN registry r USING (device_id)""", "trips", "registry")

SQL["trips_enriched_squashed"] = with_frames("""
SELECT t.trip_id, coalesce(r.vehicle_id, t.device_id) AS vehicle_id, coalesce(r.vehicle_type, 'bicycle') AS vehicle_type, t.start_ts
FROM trips t LEFT JOIN (SELECT device_id, max(vehicle_id) AS vehicle_id, max(vehicle_type) AS vehicle_type FROM registry GROUP BY device_id) r
USING (device_id)""", "trips", "registry")

SQL["type_lookup"] = with_frames("""
SELECT event_id, device_id, coalesce(t.vehicle_type, 'car') AS vehicle_type FROM reports LEFT JOIN types t USING (vehicle_type_id)""", "reports", "types")

SQL["seed_patch"] = with_frames("""
SELECT t.trip_id, t.provider_name, coalesce(s.vehicle_id, t.device_id) AS vehicle_id,
       CASE WHEN t.provider_name = 'Voi' THEN coalesce(nullif(t.vehicle_type, 'car'), s.vehicle_type) ELSE nullif(t.vehicle_type, 'car') END AS vehicle_type
FROM trips t LEFT JOIN seeds s USING (trip_id, provider_name)""", "trips", "seeds")

SQL["id_list_filter"] = with_frames("""
SELECT trip_id, device_id, start_ts, round(distance, 6) AS distance FROM trips WHERE trip_id IN (SELECT trip_id FROM seeds)""", "trips", "seeds")

SQL["upsert_trips"] = with_frames("""
SELECT trip_id, provider_name, start_ts, load_ts FROM trip_copies WHERE load_ts > TIMESTAMP '2024-02-01 00:00:00'
UNION ALL
SELECT trip_id, provider_name, start_ts, load_ts FROM trip_copies
WHERE load_ts = TIMESTAMP '2024-02-01 00:00:00' AND o_orderstatus <> 'P'""", "trip_copies")


def numbered(rows: str, *keys: str) -> str:
    listed = ", ".join(keys)
    return f"SELECT {listed}, CAST(seq AS BIGINT) AS seq, round(lon, 6) AS lon, round(lat, 6) AS lat FROM {rows}"


def or_no_line(rows: str, extra: str = "") -> str:
    """``rows`` and one row of NULLs for each trip that has none."""
    return f"""{rows}
UNION ALL SELECT trip_id{extra}, -1, NULL, NULL FROM {{whole}} WHERE trip_id NOT IN (SELECT trip_id FROM {{points}})"""


SQL["telemetry_route"] = with_frames(
    or_no_line(numbered(
        "(SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY ping_ms, lon, lat) - 1 AS seq FROM placed)", "trip_id"
    )).format(whole="(SELECT DISTINCT trip_id FROM pings)", points="placed"), "placed")

SQL["trip_route"] = with_frames(
    or_no_line(numbered("routes", "trip_id", "provider_name"), ", provider_name").format(whole="trips", points="routes"), "routes")

SQL["route_geojson"] = with_frames(
    or_no_line(numbered("(SELECT *, 'LineString' AS kind FROM routes)", "trip_id", "kind"), ", NULL").format(whole="trips", points="routes"), "routes")


# Silver views


def registry_of(provider: str, kind: str = "vehicle_type") -> str:
    return with_frames(f"SELECT DISTINCT device_id, vehicle_id, {kind} AS vehicle_type FROM registry WHERE provider_name = '{provider}'", "registry")


SQL["silver_voi_vehicles"] = registry_of("Voi")
SQL["silver_dott_vehicles"] = registry_of("Dott")
SQL["silver_bolt_vehicles"] = registry_of("Bolt", "coalesce(vehicle_type, 'scooter')")
SQL["silver_poppy_vehicles"] = with_frames("SELECT DISTINCT vehicle_type_id, vehicle_type FROM types", "types")

TRIP_NUMBERS = """start_ts, end_ts, round(duration::DOUBLE, 6) AS trip_duration, round(distance, 6) AS trip_distance_meters,
       round(start_lat, 6) AS start_lat, round(start_lon, 6) AS start_lon, round(end_lat, 6) AS end_lat, round(end_lon, 6) AS end_lon"""
N_POINTS = """CAST(CASE WHEN via_lat IS NOT NULL THEN 2 + (end_lat IS NOT NULL)::INT WHEN end_lat IS NOT NULL THEN 2 ELSE 0 END AS BIGINT) AS n_points"""

SQL["silver_voi_trips"] = with_frames(f"""
SELECT DISTINCT t.trip_id, r.vehicle_id AS vehicle_short_id, r.vehicle_type, t.provider_name, {TRIP_NUMBERS}, {N_POINTS}
FROM trips t LEFT JOIN (SELECT device_id, vehicle_id, vehicle_type FROM registry WHERE provider_name = 'Voi') r USING (device_id)
WHERE t.provider_name = 'Voi'""", "trips", "registry")

SQL["silver_dott_trips"] = with_frames(f"""
SELECT DISTINCT t.trip_id, coalesce(r.vehicle_id, device_id) AS vehicle_short_id, coalesce(r.vehicle_type, 'bicycle') AS vehicle_type,
       t.provider_name, {TRIP_NUMBERS}, {N_POINTS}
FROM trips t LEFT JOIN (SELECT device_id, max(vehicle_id) AS vehicle_id, max(vehicle_type) AS vehicle_type
                        FROM registry WHERE provider_name = 'Dott' GROUP BY device_id) r USING (device_id)
WHERE t.provider_name = 'Dott'""", "trips", "registry")

SQL["silver_bolt_trips"] = with_frames("""
SELECT DISTINCT t.trip_id, coalesce(r.vehicle_id, device_id) AS vehicle_short_id, coalesce(r.vehicle_type, 'scooter') AS vehicle_type,
       t.provider_name, start_ts AS started_at, end_ts AS ended_at, duration, round(distance, 6) AS distance,
       round(start_lat, 6) AS start_lat, round(start_lon, 6) AS start_lon, round(end_lat, 6) AS end_lat, round(end_lon, 6) AS end_lon
FROM trips t LEFT JOIN (SELECT device_id, vehicle_id, vehicle_type FROM registry WHERE provider_name = 'Bolt') r USING (device_id)
WHERE t.provider_name = 'Bolt'""", "trips", "registry")


def poppy(where: str) -> str:
    return with_frames(f"""
SELECT trip_id, device_id AS vehicle_short_id, vehicle_type, 'Poppy' AS provider_name, start_ts, end_ts, round(duration::DOUBLE, 6) AS trip_duration,
       round(distance, 6) AS trip_distance_meters,
       CASE WHEN end_lat IS NOT NULL THEN round(start_lat, 6) END AS start_lat, CASE WHEN end_lat IS NOT NULL THEN round(start_lon, 6) END AS start_lon,
       round(end_lat, 6) AS end_lat, CASE WHEN end_lat IS NOT NULL THEN round(end_lon, 6) END AS end_lon,
       CAST(CASE WHEN end_lat IS NOT NULL THEN 2 ELSE 0 END AS BIGINT) AS n_points, load_ts
FROM trip_copies WHERE {where}
QUALIFY row_number() OVER (PARTITION BY trip_id ORDER BY load_ts DESC) = 1""", "trip_copies")


SQL["silver_poppy_trips"] = poppy("provider_name = 'Poppy'")
SQL["poppy_latest_snapshot"] = poppy("TRUE")

REPORT = "device_id, event_type, vehicle_state, trip_id, round(lat, 6) AS lat, round(lon, 6) AS lon, reported_at"
SNAPSHOT = "event_type IN ('telemetry', 'ping')"

SQL["silver_voi_events"] = with_frames(f"""
SELECT DISTINCT {REPORT}, 'Voi' AS provider_name FROM reports WHERE provider_name = 'Voi' AND NOT {SNAPSHOT}""", "reports")
SQL["silver_dott_events"] = with_frames(f"""
SELECT DISTINCT {REPORT}, vehicle_id AS vehicle_short_id, CASE WHEN clock > 0 THEN 'moped' END AS vehicle_type,
       round(battery_pct * 100, 6) AS battery_percent, 'Dott' AS provider_name
FROM reports WHERE provider_name = 'Dott' AND NOT {SNAPSHOT}""", "reports")
SQL["silver_bolt_events"] = with_frames(f"SELECT {REPORT} FROM reports WHERE provider_name = 'Bolt' AND {SNAPSHOT}", "reports")
SQL["events_unnest"] = with_frames(f"SELECT {REPORT} FROM reports WHERE provider_name = 'Bolt'", "reports")
SQL["silver_bolt_status_changes"] = with_frames(f"""
SELECT {REPORT}, vehicle_id, CASE WHEN clock > 0 THEN 'moped' END AS vehicle_type
FROM reports WHERE provider_name = 'Bolt' AND NOT {SNAPSHOT}""", "reports")
SQL["silver_voi_vehicles_status"] = with_frames(f"""
SELECT DISTINCT device_id, event_type, vehicle_state, trip_id, round(lat, 6) AS lat, round(lon, 6) AS lon, reported_at,
       r.vehicle_id AS vehicle_short_id, r.vehicle_type
FROM (SELECT * FROM reports WHERE provider_name = 'Voi' AND {SNAPSHOT})
LEFT JOIN (SELECT device_id, vehicle_id, vehicle_type FROM registry WHERE provider_name = 'Voi') r USING (device_id)""", "reports", "registry")
SQL["silver_dott_vehicles_status"] = with_frames(f"""
SELECT DISTINCT device_id, event_type, vehicle_state, trip_id, round(lat, 6) AS lat, round(lon, 6) AS lon, reported_at,
       coalesce(r.vehicle_id, device_id) AS vehicle_short_id,
       coalesce(r.vehicle_type, CASE WHEN event_type = 'telemetry' THEN 'moped' END, 'scooter') AS vehicle_type, 'Dott' AS provider_name
FROM (SELECT * FROM reports WHERE provider_name = 'Dott' AND {SNAPSHOT})
LEFT JOIN (SELECT device_id, vehicle_id, vehicle_type FROM registry WHERE provider_name = 'Dott') r USING (device_id)""", "reports", "registry")
SQL["silver_poppy_vehicles_status"] = with_frames(f"""
SELECT DISTINCT device_id, 'unspecified' AS event_type, 'available' AS vehicle_state, CAST(NULL AS VARCHAR) AS trip_id, round(lat, 6) AS lat,
       round(lon, 6) AS lon, reported_at, device_id AS vehicle_id, coalesce(t.vehicle_type, 'car') AS vehicle_type, 'Poppy' AS provider_name
FROM reports LEFT JOIN types t USING (vehicle_type_id) WHERE provider_name = 'Poppy' AND {SNAPSHOT}""", "reports", "types")
SQL["gbfs_status"] = with_frames(f"""
SELECT device_id, vehicle_type_id, round(lat, 6) AS lat, round(lon, 6) AS lon, reported_at FROM reports
WHERE provider_name = 'Poppy' AND {SNAPSHOT}""", "reports")
SQL["silver_bolt_telemetry"] = with_frames("""
SELECT trip_id, device_id, round(lat, 6) AS lat, round(lon, 6) AS lon, make_timestamp(ping_ms * 1000) AS reported_at
FROM placed WHERE provider_name = 'Bolt'""", "placed")

IN_DOTT = "provider_name = 'Dott' AND l_returnflag <> 'R'"
SQL["silver_dott_telemetry"] = with_frames(
    or_no_line(numbered(
        f"(SELECT *, row_number() OVER (PARTITION BY trip_id ORDER BY ping_ms, lon, lat) - 1 AS seq FROM placed WHERE {IN_DOTT})", "trip_id"
    )).format(whole=f"(SELECT DISTINCT trip_id FROM pings WHERE {IN_DOTT})", points=f"(SELECT trip_id FROM placed WHERE {IN_DOTT})"), "placed")

SQL["page_quarantine"] = with_frames("SELECT provider_name, event_id FROM reports WHERE event_id % 3 = 0", "reports")
SQL["quarantine_counts"] = with_frames("""
SELECT CASE event_id % 5 WHEN 0 THEN 'page' ELSE 'item' END AS kind, 'VOI' AS provider, 'EVENTS' AS endpoint, count(*) AS found
FROM reports WHERE event_id % 5 < 3 GROUP BY ALL
UNION ALL
SELECT 'route', 'DOTT', 'TRIPS', count(*) FROM trips WHERE trip_no % 6 = 0""", "reports", "trips")

# Marts

SQL["bronze_to_gold_trips"] = with_frames("""
, record AS (
    SELECT trip_id, device_id, provider_name, start_ts, end_ts, duration, distance, vehicle_type AS own_type FROM trips WHERE provider_name <> 'Poppy'
    UNION ALL
    SELECT trip_id, device_id, provider_name, start_ts, end_ts, duration, distance, vehicle_type FROM (
        SELECT * FROM trip_copies WHERE provider_name = 'Poppy' QUALIFY row_number() OVER (PARTITION BY trip_id ORDER BY load_ts DESC) = 1)
), picked AS (
    SELECT device_id, provider_name, CASE WHEN provider_name = 'Dott' THEN max(vehicle_id) ELSE min(vehicle_id) END AS vehicle_id,
           CASE WHEN provider_name = 'Dott' THEN max(vehicle_type) ELSE first(vehicle_type ORDER BY vehicle_id) END AS vehicle_type
    FROM registry GROUP BY device_id, provider_name
), ends AS (
    SELECT trip_id, count(*) AS n, first(lat ORDER BY seq) AS start_lat, first(lon ORDER BY seq) AS start_lon,
           last(lat ORDER BY seq) AS end_lat, last(lon ORDER BY seq) AS end_lon FROM routes_in_pages GROUP BY trip_id
)
SELECT t.trip_id AS "TRIP_ID",
       coalesce(s.vehicle_id, r.vehicle_id, CASE WHEN t.provider_name <> 'Voi' THEN t.device_id END) AS "VEHICLE_ID",
       CASE t.provider_name WHEN 'Voi' THEN coalesce(r.vehicle_type, s.vehicle_type) WHEN 'Dott' THEN coalesce(r.vehicle_type, 'bicycle')
            WHEN 'Bolt' THEN replace(coalesce(r.vehicle_type, 'scooter'), 'scooter_standing', 'scooter') ELSE t.own_type END AS "VEHICLE_TYPE",
       t.provider_name AS "PROVIDER_NAME", t.start_ts AS "START_TS", t.end_ts AS "END_TS", round(t.duration::DOUBLE, 6) AS "TRIP_DURATION",
       round(t.distance, 6) AS "TRIP_DISTANCE", round(e.start_lat, 6) AS "START_LAT", round(e.start_lon, 6) AS "START_LON",
       round(e.end_lat, 6) AS "END_LAT", round(e.end_lon, 6) AS "END_LON", coalesce(e.n, 0) AS "N_POINTS",
       CASE WHEN e.n IS NOT NULL THEN 'LineString' END AS "ROUTE_TYPE"
FROM record t LEFT JOIN ends e USING (trip_id) LEFT JOIN seeds s USING (trip_id, provider_name)
LEFT JOIN picked r ON r.device_id = t.device_id AND r.provider_name = t.provider_name AND t.provider_name <> 'Poppy'""",
    "routes_in_pages", "trip_copies", "registry", "seeds").replace("\n, record", ",\nrecord")
SQL["bronze_to_gold_trips"] = SQL["bronze_to_gold_trips"].replace("\n\n,", ",\n")

# Runs on a kept state end where one run over all pages does.
SQL["trips_delta_runs"] = SQL["bronze_to_gold_trips"].replace('SELECT t.trip_id AS "TRIP_ID"', ', mart AS (SELECT t.trip_id AS "TRIP_ID"') + """)
SELECT m.* EXCLUDE (START_LAT, START_LON, END_LAT, END_LON, N_POINTS, ROUTE_TYPE),
       coalesce(p.seq, -1) AS seq, round(p.lon, 6) AS lon, round(p.lat, 6) AS lat
FROM mart m LEFT JOIN routes_in_pages p ON p.trip_id = m."TRIP_ID\""""

SQL["bronze_to_gold_status"] = with_frames(f"""
, sent AS (
    SELECT provider_name, device_id, vehicle_state, event_type, lat, lon, CASE WHEN provider_name <> 'Dott' OR NOT {SNAPSHOT} THEN trip_id END AS trip_id,
           reported_at,
           CASE provider_name WHEN 'Voi' THEN 'bicycle'
                WHEN 'Dott' THEN CASE WHEN event_type = 'telemetry' THEN 'moped' WHEN event_type = 'ping' THEN 'scooter' WHEN clock > 0 THEN 'moped' ELSE 'bicycle' END
                WHEN 'Bolt' THEN CASE WHEN NOT {SNAPSHOT} AND clock > 0 THEN 'moped' ELSE 'scooter' END END AS own_type
    FROM reports WHERE provider_name <> 'Poppy'
    UNION ALL
    SELECT provider_name, device_id, 'available', 'unspecified', lat, lon, NULL, reported_at, coalesce(t.vehicle_type, 'car')
    FROM reports LEFT JOIN types t USING (vehicle_type_id) WHERE provider_name = 'Poppy' AND {SNAPSHOT}
    UNION ALL
    SELECT 'Poppy', device_id, 'reserved', 'trip_start', CASE WHEN end_lat IS NOT NULL THEN start_lat END,
           CASE WHEN end_lat IS NOT NULL THEN start_lon END, trip_id, start_ts, vehicle_type FROM copies
    UNION ALL
    SELECT 'Poppy', device_id, 'available', 'trip_end', end_lat, CASE WHEN end_lat IS NOT NULL THEN end_lon END, trip_id, end_ts, vehicle_type FROM copies
), named AS (
    SELECT coalesce(r.vehicle_id, s.device_id) AS vehicle_id,
           CASE WHEN s.provider_name = 'Bolt' THEN replace(coalesce(r.vehicle_type, own_type), 'scooter_standing', 'scooter')
                WHEN s.provider_name = 'Poppy' THEN own_type ELSE coalesce(r.vehicle_type, own_type) END AS vehicle_type,
           s.provider_name, vehicle_state, event_type, lat, lon, trip_id, reported_at
    FROM sent s LEFT JOIN (SELECT provider_name, device_id, vehicle_id,
                                  CASE WHEN provider_name = 'Bolt' THEN coalesce(vehicle_type, 'scooter') ELSE vehicle_type END AS vehicle_type
                           FROM registry WHERE provider_name <> 'Poppy') r USING (device_id, provider_name)
), chosen AS (
    SELECT * FROM named
    QUALIFY row_number() OVER (PARTITION BY vehicle_id, provider_name, reported_at ORDER BY
        CASE WHEN event_type IN ('trip_start', 'trip_end') THEN 1 WHEN event_type = 'maintenance_pick_up' THEN 2 ELSE 3 END,
        event_type NULLS LAST, vehicle_state NULLS LAST, trip_id NULLS LAST, lat NULLS LAST, lon NULLS LAST, vehicle_type NULLS LAST) = 1
)
{timeline("chosen")}""", "reports", "types", "registry", "trip_copies")
SQL["bronze_to_gold_status"] = SQL["bronze_to_gold_status"].replace("\n, sent AS (", """,
copies AS (
    SELECT * FROM trip_copies WHERE provider_name = 'Poppy' QUALIFY row_number() OVER (PARTITION BY trip_id ORDER BY load_ts DESC) = 1
), sent AS (""")

# Landing

ARRIVAL = "'page_' || lpad(event_id::VARCHAR, 12, '0') AS filename, seen_at AS load_ts"

SQL["page_hash_last"] = with_frames(f"""
SELECT provider, filename, load_ts FROM (
    SELECT upper(provider_name) AS provider, {ARRIVAL}, event_type, lag(event_type) OVER (PARTITION BY provider_name ORDER BY seen_at, event_id) AS prev
    FROM reports)
WHERE load_ts >= TIMESTAMP '2024-01-15 00:00:00' AND prev IS DISTINCT FROM event_type""", "reports")
SQL["page_hash_last_stored"] = with_frames("""
SELECT upper(provider_name) AS provider, 'EVENTS' AS endpoint, max(seen_at) AS load_ts FROM reports GROUP BY provider_name""", "reports")
SQL["page_hash_any"] = with_frames(f"""
SELECT provider, filename, load_ts FROM (
    SELECT upper(provider_name) AS provider, {ARRIVAL}, row_number() OVER (PARTITION BY provider_name, device_id, event_type, clock ORDER BY seen_at, event_id) AS n
    FROM reports WHERE event_type <> 'maintenance_pick_up')
WHERE n = 1 AND load_ts >= TIMESTAMP '2024-01-15 00:00:00'""", "reports")

SQL["page_hash_index"] = with_frames(f"""
SELECT provider, filename, load_ts AS file_ts FROM (
    SELECT upper(provider_name) AS provider, {ARRIVAL}, row_number() OVER (PARTITION BY provider_name, device_id, event_type, clock ORDER BY seen_at, event_id) AS n
    FROM reports WHERE event_type <> 'maintenance_pick_up')
WHERE n = 1""", "reports")
SQL["page_hash_last_runs"] = with_frames(f"""
SELECT provider, filename, load_ts AS file_ts FROM (
    SELECT upper(provider_name) AS provider, {ARRIVAL}, event_type, lag(event_type) OVER (PARTITION BY provider_name ORDER BY seen_at, event_id) AS prev
    FROM reports)
WHERE prev IS DISTINCT FROM event_type""", "reports")

# Canonical JSON: keys in order, a space after each comma and colon.
SQL["page_hash_canonical"] = with_frames("""
SELECT event_id, md5(CASE event_id % 4
    WHEN 2 THEN '{"a": null, "data": {"events": [{"id": "' || i || '", "place": {"p": true, "q": ["' || i || '", ' || i || ']}}], "n": 1}}'
    WHEN 3 THEN '{"a": "null", "data": {"events": [{"id": ' || i || ', "place": {"p": "true", "q": [' || i || ', "' || i || '"]}}], "n": "1"}}'
    ELSE '{"a": null, "data": {"events": [{"id": ' || i || ', "place": {"p": true, "q": [' || i || ', "' || i || '"]}}], "n": 1}}' END) AS md5_hash
FROM (SELECT event_id, event_id // 4 AS i FROM reports)""", "reports")

SQL["landing_parse"] = with_frames("""
SELECT trip_id,
       CASE WHEN merged THEN 'telemetry_' || hour || '.json'
            ELSE lower(provider_name) || '_' || slug || '_' || time || '_p' || (duration + 1) || '.json' END AS filename,
       lower(provider_name) AS provider, CASE WHEN merged THEN 'telemetry' ELSE slug END AS slug,
       CASE WHEN merged THEN 1 ELSE duration + 1 END AS page_no,
       CASE WHEN merged OR end_lat IS NOT NULL THEN date_trunc('hour', end_ts) ELSE CAST(date_trunc('day', end_ts) AS TIMESTAMP) END AS file_ts,
       CASE WHEN merged THEN '{"telemetry":[{"trip_id":"' || trip_id || '"}]}' ELSE '[{"trip_id":"' || trip_id || '"}]' END AS content
FROM (SELECT *, provider_name = 'Dott' AS merged, CASE WHEN via_lat IS NULL THEN 'vehicles_status' ELSE 'trips' END AS slug,
             strftime(end_ts, '%Y-%m-%dT%H') AS hour,
             CASE WHEN end_lat IS NULL THEN strftime(end_ts, '%Y%m%d') ELSE strftime(end_ts, '%Y-%m-%dT%H') END AS time FROM trips)""", "trips")

SQL["page_merge"] = with_frames("""
SELECT 'DOTT' AS provider, 'TELEMETRY' AS endpoint, TIMESTAMP '2024-02-01 00:00:00' AS hour, device_id, ping_ms,
       CASE WHEN l_returnflag <> 'R' THEN trip_id END AS trip_id FROM pings WHERE provider_name = 'Dott'""", "pings")

CATALOGUE = """(VALUES
    ('voi', 'vehicles', 'VOI_VEHICLES', 'hourly', 0), ('voi', 'trips', 'VOI_TRIPS', 'hourly', 1),
    ('voi', 'vehicles/status', 'VOI_VEHICLES_STATUS', 'hourly', 0), ('voi', 'events/historical', 'VOI_EVENTS', 'hourly', 1),
    ('dott', 'vehicles', 'DOTT_VEHICLES', 'hourly', 0), ('dott', 'trips', 'DOTT_TRIPS', 'hourly', 1),
    ('dott', 'vehicles/status', 'DOTT_VEHICLES_STATUS', 'hourly', 0), ('dott', 'events', 'DOTT_EVENTS', 'hourly', 1),
    ('dott', 'telemetry', 'DOTT_TELEMETRY', 'hourly', 0), ('bolt', 'vehicles', 'BOLT_VEHICLES', 'hourly', 0),
    ('bolt', 'trips', 'BOLT_TRIPS', 'hourly', 1), ('bolt', 'events/historical', 'BOLT_EVENTS', 'hourly', 0),
    ('bolt', 'status_changes', 'BOLT_STATUS_CHANGES', 'hourly', 1), ('bolt', 'telemetry', 'BOLT_TELEMETRY', 'hourly', 0),
    ('poppy', 'free_bike_status', 'POPPY_FREE_BIKE_STATUS', 'hourly', 0), ('poppy', 'trips/brussels', 'POPPY_TRIPS', 'daily', 1),
    ('poppy', 'vehicle_types', 'POPPY_VEHICLE_TYPES', 'daily', 0), ('poppy', 'system_information', 'POPPY_SYSTEM_INFORMATION', 'daily', 0)
) AS c(provider, endpoint, raw_table, cadence, in_backfill)"""

SQL["landing_windows"] = with_frames(f"""
SELECT run_ts, provider, endpoint, raw_table, upper(provider[1]) || provider[2:] AS lane, cadence,
       CASE WHEN (provider = 'dott' AND endpoint IN ('vehicles', 'events')) OR (provider = 'bolt' AND endpoint = 'status_changes') THEN '1.2' ELSE '2.0' END AS format_version,
       kind,
       CASE kind WHEN 'days' THEN date_trunc('day', run_ts)::TIMESTAMP - INTERVAL 1 DAY WHEN 'millis' THEN run_ts - delay - INTERVAL 1 HOUR
                 ELSE CASE WHEN kind IS NOT NULL THEN date_trunc('hour', run_ts - delay) END END AS window_start,
       CASE kind WHEN 'days' THEN date_trunc('day', run_ts)::TIMESTAMP WHEN 'millis' THEN run_ts - delay
                 ELSE CASE WHEN kind IS NOT NULL THEN date_trunc('hour', run_ts - delay) END END AS window_end
FROM (SELECT *, CASE WHEN endpoint LIKE '%historical%' OR endpoint LIKE '%trips%' OR endpoint LIKE '%status_changes%' THEN INTERVAL 4 HOUR ELSE INTERVAL 1 HOUR END AS delay,
             CASE WHEN provider = 'poppy' AND endpoint LIKE '%trips%' THEN 'days'
                  WHEN endpoint LIKE '%historical%' OR endpoint = 'status_changes' THEN 'event_time'
                  WHEN endpoint LIKE '%telemetry%' THEN 'telemetry_time' WHEN endpoint LIKE '%trips%' THEN 'end_time'
                  WHEN endpoint = 'events' THEN 'millis' END AS kind
      FROM (SELECT DISTINCT reported_at + INTERVAL 90 SECOND AS run_ts FROM reports), {CATALOGUE})""", "reports")

SPAN = "(SELECT min(reported_at) AS lo, max(reported_at) AS hi FROM reports)"
SQL["hour_grid"] = with_frames(f"""
SELECT provider, endpoint, cadence, slot FROM {CATALOGUE},
     (SELECT unnest(generate_series(lo, hi - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS slot FROM {SPAN}) WHERE cadence = 'hourly'
UNION ALL
SELECT provider, endpoint, cadence, slot FROM {CATALOGUE},
     (SELECT unnest(generate_series(date_trunc('day', lo)::TIMESTAMP, date_trunc('day', hi)::TIMESTAMP, INTERVAL 1 DAY)) AS slot FROM {SPAN}) WHERE cadence = 'daily'""", "reports")

SQL["landing_gaps_hourly"] = with_frames(f"""
SELECT provider, endpoint, slot FROM {CATALOGUE},
     (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS slot FROM {SPAN}) WHERE cadence = 'hourly' AND in_backfill = 1
EXCEPT
SELECT lower(provider_name), CASE WHEN trip_id IS NOT NULL THEN 'trips' ELSE 'events/historical' END, reported_at FROM reports""", "reports")

SQL["page_gaps_by_run"] = """
SELECT DISTINCT l_orderkey AS run, (l_linenumber + 1)::BIGINT AS missing_page FROM lineitem WHERE l_linenumber < 7
EXCEPT SELECT l_orderkey, l_linenumber FROM lineitem"""

BROKEN_RUNS = """
WITH landed AS (
    SELECT l_orderkey AS run, l_linenumber::BIGINT AS page_no, l_linenumber < max(l_linenumber) OVER (PARTITION BY l_orderkey) AS more, l_returnflag FROM lineitem
), once AS (
    SELECT DISTINCT run, page_no, more FROM landed WHERE l_returnflag <> 'R'
), islands AS (
    SELECT *, page_no - row_number() OVER (PARTITION BY run ORDER BY page_no) AS island FROM once
)"""
SQL["page_runs_by_run"] = BROKEN_RUNS + """
SELECT run, count(*) AS n_pages, max(page_no) AS last_page, count(*) FILTER (island = 0) AS unbroken,
       count(*) FILTER (island = 0) > 0 AND count(*) FILTER (island <> 0) = 0 AND NOT arg_max(more, page_no) AS whole
FROM islands GROUP BY run"""
SQL["page_runs_used"] = BROKEN_RUNS + """
SELECT run, page_no FROM landed WHERE l_returnflag <> 'R' AND (run, page_no) IN (SELECT (run, page_no) FROM islands WHERE island = 0)"""

SQL["dq_unique"] = with_frames("SELECT trip_id, count(*) AS n_records FROM trip_copies GROUP BY trip_id HAVING count(*) > 1", "trip_copies")
SQL["dq_checks"] = with_frames("""
SELECT 'trip_id' AS column_name, 'unique' AS check_kind, count(*) AS failures FROM (SELECT trip_id FROM trip_copies GROUP BY trip_id HAVING count(*) > 1)
UNION ALL SELECT 'trip_id', 'not_null', count(*) FROM trip_copies WHERE trip_id IS NULL
UNION ALL SELECT 'device_id', 'not_null', count(*) FROM trip_copies WHERE device_id IS NULL
UNION ALL SELECT 'start_ts', 'not_null', count(*) FROM trip_copies WHERE start_ts IS NULL
UNION ALL SELECT 'end_lat', 'not_null', count(*) FROM trip_copies WHERE end_lat IS NULL""", "trip_copies")

SQL["csv_dump_import"] = """
SELECT o_orderkey, o_orderstatus, o_orderpriority || ', "' || o_orderstatus || '"' AS note, h AS md5_hash
FROM (SELECT *, NULL AS h FROM orders UNION ALL SELECT *, md5(o_orderpriority || ', "' || o_orderstatus || '"') FROM orders)"""

SQL["hourly_files"] = with_frames("""
SELECT strftime(reported_at, '%Y-%m-%dT%H') AS hour, upper(provider_name) AS provider, event_id % 3 + 1 AS page_no, device_id AS item, count(*) AS n_pings
FROM reports GROUP BY ALL""", "reports")

# Stored tables: landing, bronze, publication

SQL["landing_envelope"] = with_frames("""
SELECT trip_id,
       CASE form WHEN 0 THEN 'POPPY' WHEN 1 THEN 'POPPY' WHEN 3 THEN 'DOTT' WHEN 4 THEN 'BOLT' ELSE 'VOI' END AS provider,
       CASE form WHEN 0 THEN 'TRIPS' WHEN 1 THEN 'TRIPS' WHEN 2 THEN 'VEHICLES_STATUS' WHEN 3 THEN 'TELEMETRY' WHEN 4 THEN 'EVENTS' END AS endpoint,
       CASE form WHEN 0 THEN 'poppy_trips_' || strftime(end_ts, '%Y-%m-%d') || n WHEN 1 THEN 'poppy_trips_brussels_' || strftime(end_ts, '%Y%m%d') || n
            WHEN 2 THEN 'voi_vehicles_status_' || hour || n WHEN 3 THEN 'telemetry_' || hour || '.json'
            WHEN 4 THEN 'bolt_events_historical_' || hour || n ELSE 'voi_unheard_of_' || hour || n END AS filename,
       CASE WHEN form < 2 THEN CAST(date_trunc('day', end_ts) AS TIMESTAMP) ELSE date_trunc('hour', end_ts) END AS file_ts,
       CASE WHEN form = 3 THEN '{"telemetry":[{"trip_id":"' || trip_id || '"}]}' ELSE '[{"trip_id":"' || trip_id || '"}]' END AS content
FROM (SELECT *, trip_no % 6 AS form, strftime(end_ts, '%Y-%m-%dT%H') AS hour, '_p' || (duration + 1) || '.json' AS n FROM trips)""", "trips")
SQL["page_hash_same_name"] = with_frames("SELECT upper(provider_name) AS provider, reported_at AS load_ts, event_id FROM reports", "reports")
SQL["page_hash_unknown_table"] = with_frames("""
SELECT kind, upper(provider_name) AS provider, CASE WHEN event_id % 2 = 0 THEN 'EVENTS' END AS endpoint, count(*) AS n_pages
FROM reports, (VALUES ('changed'), ('unseen')) AS k(kind) GROUP BY ALL""", "reports")
SQL["route_rejects"] = with_frames("""
SELECT trip_id, CASE WHEN trip_no % 3 <> 1 THEN 2::BIGINT END AS n_points, trip_no % 3 = 1 AS rejected FROM trips WHERE end_lat IS NOT NULL""", "trips")
SQL["refresh_late_pages"] = with_frames(f"""
SELECT device_id, reported_at, event_type, count(*) AS n_reports FROM reports WHERE provider_name = 'Voi' AND NOT {SNAPSHOT} GROUP BY ALL""", "reports")
SQL["publish_round_trip"] = with_frames("""
SELECT trip_id, device_id, start_ts FROM trip_copies
QUALIFY row_number() OVER (PARTITION BY trip_id ORDER BY start_ts DESC NULLS FIRST) = 1""", "trip_copies")
SQL["bronze_views"] = with_frames("""
SELECT DISTINCT lower(provider_name) AS provider, device_id, vehicle_id FROM registry WHERE provider_name <> 'Poppy'""", "registry")
SQL["bronze_gaps"] = with_frames(f"""
SELECT provider, endpoint, slot FROM {CATALOGUE},
     (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS slot FROM {SPAN}) WHERE cadence = 'hourly'
EXCEPT
SELECT lower(provider_name), CASE WHEN provider_name = 'Dott' THEN 'events' ELSE 'events/historical' END, reported_at FROM reports""", "reports")
SQL["bronze_page_gaps"] = SQL["page_gaps_by_run"]
SQL["hour_files_back"] = with_frames("""
SELECT device_id, trip_id, ping_ms, count(*) AS n_pings FROM pings WHERE provider_name = 'Dott' AND l_returnflag <> 'R' GROUP BY ALL""", "pings")
SQL["seed_files"] = with_frames("""
SELECT provider_name, trip_id AS "TRIP_ID", vehicle_id AS "VEHICLE_ID", vehicle_type AS "VEHICLE_TYPE" FROM seeds WHERE provider_name <> 'Poppy'""", "seeds")
