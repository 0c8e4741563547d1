"""Shapes of the bronze envelope, of the page elements and of the two marts.

Element leaves are all strings: values are cast where they are used, so a bad value never hides its
neighbours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BRONZE = (
    "provider string, endpoint string, content string, filename string, "
    "file_ts timestamp, md5_hash string, load_ts timestamp, page_no int, page_time timestamp"
)
SEED = "TRIP_ID string, VEHICLE_ID string, VEHICLE_TYPE string"

_PLACE = "struct<lat:string,lng:string>"
_FEATURE = "struct<geometry:struct<coordinates:array<string>>>"

VEHICLE = "struct<device_id:string,vehicle_id:string,vehicle_type:string>"

TRIP = (
    "struct<trip_id:string,device_id:string,start_time:string,end_time:string,duration:string,distance:string,"
    f"start_location:{_PLACE},end_location:{_PLACE},route:string>"
)

EVENT = (
    "struct<device_id:string,event_types:array<string>,vehicle_state:string,trip_ids:array<string>,"
    f"location:{_PLACE},timestamp:string>"
)

STATUS_CHANGE = (
    "struct<device_id:string,vehicle_id:string,vehicle_type:string,vehicle_state:string,event_types:array<string>,"
    f"trip_id:string,event_location:{_FEATURE},battery_pct:string,event_time:string>"
)

VOI_STATUS = (
    "struct<device_id:string,last_event:struct<vehicle_state:string,event_types:array<string>,trip_ids:array<string>>,"
    f"last_telemetry:struct<location:{_PLACE},timestamp:string>>"
)

DOTT_STATUS = (
    "struct<device_id:string,vehicle_type:string,"
    f"last_event:struct<vehicle_state:string,event_types:array<string>,trip_ids:array<string>,location:{_PLACE}>,"
    f"last_vehicle_state:string,last_event_types:array<string>,last_telemetry:struct<location:{_PLACE}>,"
    "current_location:struct<geometry:struct<coordinates:array<string>>,properties:struct<timestamp:string>>,"
    "last_event_time:string>"
)

DOTT_PING = f"struct<device_id:string,timestamp:string,location:{_PLACE},trip_ids:array<string>>"
BOLT_PING = f"struct<trip_id:string,device_id:string,location:{_PLACE},timestamp:string>"

POPPY_TRIP = (
    "struct<trip_id:string,vehicle_id:string,vehicle_type:string,start_time:string,end_time:string,"
    "trip_duration:string,trip_distance:string,route:struct<features:array<struct<geometry:string>>>>"
)
POPPY_BIKE = "struct<bike_id:string,vehicle_type_id:string,lat:string,lon:string,last_reported:string>"
POPPY_TYPE = "struct<vehicle_type_id:string,form_factor:string>"

# Where each raw table keeps its items; the first path that holds an array wins.
ITEM_PATHS = {
    ("VOI", "VEHICLES"): ("vehicles",),
    ("VOI", "TRIPS"): ("trips",),
    ("VOI", "EVENTS"): ("data.events", "events"),
    ("VOI", "VEHICLES_STATUS"): ("vehicles_status",),
    ("DOTT", "VEHICLES"): ("data.vehicles",),
    ("DOTT", "TRIPS"): ("trips",),
    ("DOTT", "EVENTS"): ("data.status_changes",),
    ("DOTT", "VEHICLES_STATUS"): ("data.vehicles", "vehicles"),
    ("DOTT", "TELEMETRY"): ("telemetry",),
    ("BOLT", "VEHICLES"): ("data.vehicles", "vehicles"),
    ("BOLT", "TRIPS"): ("trips", "data.trips"),
    ("BOLT", "EVENTS"): ("data.events", "events"),
    ("BOLT", "STATUS_CHANGES"): ("data.status_changes", "status_changes"),
    ("BOLT", "TELEMETRY"): ("data.telemetry", "telemetry"),
    ("POPPY", "TRIPS"): ("",),
    ("POPPY", "FREE_BIKE_STATUS"): ("data.bikes",),
    ("POPPY", "VEHICLE_TYPES"): ("data.vehicle_types",),
}

TRIPS_MART = {
    "TRIP_ID": "string",
    "VEHICLE_ID": "string",
    "VEHICLE_TYPE": "string",
    "PROVIDER_NAME": "string",
    "START_TS": "timestamp",
    "END_TS": "timestamp",
    "TRIP_DURATION": "decimal(38,9)",
    "TRIP_DISTANCE": "double",
    "START_LAT": "double",
    "START_LON": "double",
    "END_LAT": "double",
    "END_LON": "double",
    "ROUTE": "string",
    "GEOM": "array<struct<lon:double,lat:double>>",
}

STATUS_MART = {
    "UID": "string",
    "VEHICLE_ID": "string",
    "VEHICLE_TYPE": "string",
    "PROVIDER_NAME": "string",
    "VEHICLE_STATE": "string",
    "EVENT_TYPE": "string",
    "LAT": "double",
    "LON": "double",
    "TRIP_ID": "string",
    "VALID_FROM_TS": "timestamp",
    "VALID_TO_TS": "timestamp",
}


def typed_null(kind: str = "string") -> Column:
    return F.lit(None).cast(kind)


def conform(df: DataFrame, shape: dict[str, str]) -> DataFrame:
    """Columns of ``shape``, in its order and types; a column the frame lacks is added as NULL."""
    have = {name.lower() for name in df.columns}
    return df.select(
        *[(F.col(n).cast(t) if n.lower() in have else typed_null(t)).alias(n) for n, t in shape.items()]
    )
