"""Schemas of the event log, the four record tables and the scenario tables."""

from pyspark.sql import types as T

# --- fixed values: event type strings as simulators write them --------------
DRIVER_STARTS = "TransitDriverStarts"
PERSON_ENTERS = "PersonEntersVehicle"
PERSON_LEAVES = "PersonLeavesVehicle"
ENTERS_TRAFFIC = "vehicle enters traffic"
LEAVES_TRAFFIC = "vehicle leaves traffic"
ENTERED_LINK = "entered link"
LEFT_LINK = "left link"
ARRIVES = "VehicleArrivesAtFacility"
DEPARTS = "VehicleDepartsAtFacility"
DEPARTURE = "departure"
ACTIVITY_START = "actstart"

INTERIM_ACTIVITY = "pt interaction"
DRIVER_PREFIX = "pt"
HOME = "home"
TRANSIT_MODE = "pt"
CAR_MODE = "car"
# ----------------------------------------------------------------------------

VEHICLE_EVENTS = (
    DRIVER_STARTS,
    PERSON_ENTERS,
    PERSON_LEAVES,
    ENTERS_TRAFFIC,
    LEAVES_TRAFFIC,
    ENTERED_LINK,
    LEFT_LINK,
    ARRIVES,
    DEPARTS,
)

EVENT_ATTRIBUTES = (
    "person",
    "vehicle",
    "vehicleId",
    "driverId",
    "link",
    "facility",
    "delay",
    "actType",
    "computationalRoutingMode",
)


def _struct(*fields):
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


_S, _D, _L, _B, _I = (
    T.StringType(),
    T.DoubleType(),
    T.LongType(),
    T.BooleanType(),
    T.IntegerType(),
)

EVENTS = _struct(
    ("seq", _L, False),
    ("time", _D, True),
    ("type", _S, True),
    *[(a, _D if a == "delay" else _S, True) for a in EVENT_ATTRIBUTES],
)

RECORDS = {
    "bus_pax_records": _struct(("person_id", _S, False), ("bus_id", _S, False)),
    "bus_delay_records": _struct(
        ("stop_id", _S, False), ("arrival_delay", _D, False), ("depart_delay", _D, False)
    ),
    "bus_trip_records": _struct(
        ("bus_id", _S, False),
        ("link_id", _S, False),
        ("link_length", _D, False),
        ("travel_time", _D, False),
        ("have_passenger", _B, False),
    ),
    "trip_records": _struct(
        ("person_id", _S, False),
        ("start_time", _D, False),
        ("travel_time", _D, False),
        ("main_mode", _S, False),
        ("veh_list", T.ArrayType(_S, containsNull=False), False),
    ),
}

#: Time of the event that completes a record, where operators are asked for it.
EMITTED_AT = "emitted_at"

SCENARIO = {
    "links": _struct(
        ("link_id", _S, True), ("from_node", _S, True), ("to_node", _S, True), ("length_m", _D, True)
    ),
    "nodes": _struct(("node_id", _S, True), ("x", _D, True), ("y", _D, True)),
    "route_links": _struct(
        ("line_id", _S, True),
        ("route_id", _S, True),
        ("transport_mode", _S, True),
        ("link_seq", _I, True),
        ("link_id", _S, True),
    ),
    "route_stops": _struct(
        ("line_id", _S, True),
        ("route_id", _S, True),
        ("transport_mode", _S, True),
        ("stop_seq", _I, True),
        ("stop_id", _S, True),
        ("x", _D, True),
        ("y", _D, True),
    ),
    "routes": _struct(("line_id", _S, True), ("route_id", _S, True), ("transport_mode", _S, True)),
    "transit_vehicles": _struct(("vehicle_id", _S, True), ("type_id", _S, True)),
    "activities": _struct(
        ("person_id", _S, True),
        ("selected", _B, True),
        ("act_seq", _I, True),
        ("act_type", _S, True),
        ("x", _D, True),
        ("y", _D, True),
    ),
}
