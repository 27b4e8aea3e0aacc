"""Event log, record tables and scenario derived from the star tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway import schemas as S
from headway.plans.analysis import Scenario

EPOCH = 1704067200
# Event type by k mod 20.
KINDS = (
    [S.DRIVER_STARTS]
    + [S.ENTERS_TRAFFIC] * 2
    + [S.ENTERED_LINK] * 3
    + [S.LEFT_LINK] * 3
    + [S.PERSON_ENTERS] * 3
    + [S.PERSON_LEAVES] * 2
    + [S.LEAVES_TRAFFIC]
    + [S.ARRIVES] * 2
    + [S.DEPARTS]
    + [S.DEPARTURE]
    + [S.ACTIVITY_START]
)


_SCHEMAS: dict[str, object] = {}


def raw(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A star table; its schema is read from the file once per process."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    path = f"{sf}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def tag(letter: str, number) -> Column:
    return F.concat(F.lit(letter), (F.col(number) if isinstance(number, str) else number).cast("string"))


def _nth(x, y, mod) -> Column:
    return ((F.col(x) * y) % mod).cast("double")


# --- event log ---------------------------------------------------------------


def as_event_log(events: DataFrame) -> DataFrame:
    """Row-level derivation, for tables and streams alike."""
    k = F.get_json_object("props", "$.k").cast("int")
    vn = F.floor(F.col("user_id") / 5)
    kind = F.get(F.array(*[F.lit(t) for t in KINDS]), k % 20)
    seq = F.col("event_id")
    df = events.select(
        seq.alias("seq"),
        (F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6) - F.lit(EPOCH)).alias("time"),
        kind.alias("type"),
        "user_id",
        "value",
        "event_type",
        tag("v", vn).alias("vehicle"),
    )
    is_driver = F.col("type").startswith("Person") & (F.col("value") > 60)
    seq = F.col("seq")
    return df.select(
        "seq",
        "time",
        "type",
        F.when(is_driver, F.concat(F.lit("pt_"), "vehicle")).otherwise(tag("p", "user_id")).alias("person"),
        "vehicle",
        F.col("vehicle").alias("vehicleId"),
        F.concat(F.lit("pt_"), "vehicle").alias("driverId"),
        F.when(seq % 11 != 0, F.when(seq % 13 == 0, "l_missing").otherwise(tag("l", seq % 200))).alias("link"),
        F.when(seq % 17 != 0, tag("s", seq % 50)).alias("facility"),
        F.col("value").alias("delay"),
        F.when(F.col("event_type") == "error", S.INTERIM_ACTIVITY).otherwise(F.col("event_type")).alias("actType"),
        F.when(F.col("event_type") == "purchase", "car")
        .when(F.col("event_type") != "signup", "pt")
        .alias("computationalRoutingMode"),
    )


def event_log(spark, sf) -> DataFrame:
    return as_event_log(raw(spark, sf, "events"))


def event_stream(spark, sf) -> DataFrame:
    table = raw(spark, sf, "events")
    stream = spark.readStream.schema(table.schema).option("pathGlobFilter", "events.parquet").option("maxFilesPerTrigger", 1).parquet(sf)
    return as_event_log(stream)


def flawed_log(spark, sf) -> DataFrame:
    """The log with a missing time or type now and then."""
    seq = F.col("seq")
    return event_log(spark, sf).withColumns(
        {
            "time": F.when(seq % 997 != 500, F.col("time")),
            "type": F.when(seq % 991 != 700, F.col("type")),
        }
    )


def log_vehicles(spark, sf) -> DataFrame:
    """Transit vehicles of the event log: two buses for every tram."""
    vn = F.floor(F.col("user_id") / 5).alias("vn")
    ids = raw(spark, sf, "events").select(vn).distinct()
    kind = F.when(F.col("vn") % 3 == 0, "Tram").when(F.col("vn") % 3 == 1, "minibus").otherwise("City-BUS")
    return ids.select(tag("v", "vn").alias("vehicle_id"), kind.alias("type_id"))


# --- record tables (each with the run it belongs to) --------------------------


def _lines(spark, sf) -> DataFrame:
    return raw(spark, sf, "lineitem")


def bus_pax(spark, sf) -> DataFrame:
    orders = raw(spark, sf, "orders").select("o_orderkey", "o_custkey")
    lines = _lines(spark, sf)
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        (F.col("l_orderkey") % 4).alias("run_id"),
        tag("p", "o_custkey").alias("person_id"),
        tag("v", "l_suppkey").alias("bus_id"),
    )


def bus_delay(spark, sf) -> DataFrame:
    arrival = F.when(F.col("l_linenumber") == 7, F.lit(float("nan"))).otherwise((F.col("l_quantity") - 25) * 15)
    return _lines(spark, sf).select(
        (F.col("l_orderkey") % 4).alias("run_id"),
        tag("s", "l_suppkey").alias("stop_id"),
        arrival.alias("arrival_delay"),
        (arrival + F.col("l_linenumber")).alias("depart_delay"),
    )


def bus_trip(spark, sf) -> DataFrame:
    part = raw(spark, sf, "part").select("p_partkey", "p_size")
    return _lines(spark, sf).join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        (F.col("l_orderkey") % 4).alias("run_id"),
        tag("v", "l_suppkey").alias("bus_id"),
        tag("l", "l_partkey").alias("link_id"),
        (F.col("p_size") / F.lit(1024.0)).alias("link_length"),
        (F.col("l_quantity") * 2).alias("travel_time"),
        (F.col("l_returnflag") != "N").alias("have_passenger"),
    )


def trips(spark, sf) -> DataFrame:
    used = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_suppkey", "l_partkey")))
    lists = (
        _lines(spark, sf)
        .groupBy("l_orderkey")
        .agg(F.transform(used["l_suppkey"], lambda s: F.concat(F.lit("v"), s.cast("string"))).alias("veh_list"))
    )
    orders = raw(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    mode = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "car")
        .when(F.col("o_orderpriority") == "5-LOW", "walk")
        .otherwise("pt")
    )
    return lists.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        (F.col("o_orderkey") % 4).alias("run_id"),
        F.col("o_orderkey").alias("trip_id"),
        tag("p", "o_custkey").alias("person_id"),
        F.lit(0.0).alias("start_time"),
        (F.col("o_orderkey") % 3600 + 600).cast("double").alias("travel_time"),
        mode.alias("main_mode"),
        "veh_list",
    )


def records(spark, sf) -> dict[str, DataFrame]:
    return {
        "bus_pax_records": bus_pax(spark, sf),
        "bus_delay_records": bus_delay(spark, sf),
        "bus_trip_records": bus_trip(spark, sf),
        "trip_records": trips(spark, sf),
    }


# --- scenario -----------------------------------------------------------------


def transit_vehicles(spark, sf) -> DataFrame:
    key = F.col("s_suppkey")
    kind = F.when(key % 3 == 0, "City-BUS").when(key % 3 == 1, "minibus").otherwise("Tram")
    return raw(spark, sf, "supplier").select(tag("v", "s_suppkey").alias("vehicle_id"), kind.alias("type_id"))


def links(spark, sf) -> DataFrame:
    key = F.col("p_partkey")
    return raw(spark, sf, "part").select(
        tag("l", "p_partkey").alias("link_id"),
        tag("n", "p_partkey").alias("from_node"),
        tag("n", key + 1).alias("to_node"),
        (F.col("p_size") * 250.0).alias("length_m"),
    )


def nodes(spark, sf) -> DataFrame:
    return raw(spark, sf, "part").select(
        tag("n", "p_partkey").alias("node_id"),
        _nth("p_partkey", 7919, 10007).alias("x"),
        _nth("p_partkey", 104729, 10009).alias("y"),
    )


def route_links(spark, sf) -> DataFrame:
    line, flag = F.col("l_suppkey"), F.col("l_returnflag")
    mode = (
        F.when((line % 50 == 0) & (flag == "R"), "bus").when((line % 50 == 1) & (flag == "A"), "pt").otherwise("train")
    )
    return (
        _lines(spark, sf)
        .select(
            line.cast("string").alias("line_id"),
            F.concat_ws("-", line.cast("string"), flag).alias("route_id"),
            mode.alias("transport_mode"),
            F.col("l_linenumber").alias("link_seq"),
            tag("l", "l_partkey").alias("link_id"),
        )
    )


def route_stops(spark, sf) -> DataFrame:
    """Every route of a supplier's line calls at that supplier's stop."""
    stops = raw(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("line_id"),
        F.lit(0).alias("stop_seq"),
        tag("s", "s_suppkey").alias("stop_id"),
        _nth("s_suppkey", 6151, 10007).alias("x"),
        _nth("s_suppkey", 3571, 10009).alias("y"),
    )
    routes = route_links(spark, sf).select("line_id", "route_id", "transport_mode").distinct()
    return routes.join(stops, "line_id").select(S.SCENARIO["route_stops"].names)


def activities(spark, sf) -> DataFrame:
    """Per customer: work, home, a second home; and a rejected plan that begins at home."""
    x, y = _nth("c_custkey", 7919, 10007), _nth("c_custkey", 104729, 10009)

    def act(selected, seq, kind, dx):
        return F.struct(
            F.lit(selected).alias("selected"),
            F.lit(seq).alias("act_seq"),
            F.lit(kind).alias("act_type"),
            (x + dx).alias("x"),
            y.alias("y"),
        )

    plan = F.array(
        act(True, 0, "work", 50.0), act(True, 1, "home", 0.0), act(True, 2, "home", 5000.0), act(False, 0, "home", 900.0)
    )
    return raw(spark, sf, "customer").select(
        tag("p", "c_custkey").alias("person_id"), F.inline(plan)
    )


def scenario(spark, sf) -> Scenario:
    return Scenario(
        links=links(spark, sf),
        nodes=nodes(spark, sf),
        route_links=route_links(spark, sf),
        route_stops=route_stops(spark, sf),
        transit_vehicles=transit_vehicles(spark, sf),
        activities=activities(spark, sf),
    )


def weights_by_run(spark, sf) -> DataFrame:
    """Ten weights per run: the share of orders that falls to each metric."""
    from headway.config import WEIGHT_KEYS

    names = F.array(*[F.lit(n) for n in sorted(WEIGHT_KEYS)])
    orders = raw(spark, sf, "orders").select(
        (F.col("o_orderkey") % 4).alias("run_id"), F.get(names, (F.col("o_custkey") % 10).cast("int")).alias("name")
    )
    counts = orders.groupBy("run_id", "name").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("run_id").agg(F.sum("n").alias("total"))
    return counts.join(totals, "run_id").select("run_id", "name", (F.col("n") / F.col("total")).alias("weight"))
