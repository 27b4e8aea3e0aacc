"""XML scans: event log, network, transit schedule, transit vehicles, population.

XML files (plain or ``.gz``) are read by Spark's own XML source. A file is one
task unless it can be split, so a large log should be landed once as parquet
(:func:`land_events`) and analysed from there.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway import schemas as S
from headway.functions.columns import to_double_or_nan

_TEXT_TIME = "_time"
_LOCAL = re.compile(":///")
_EVENT_XML = ", ".join(f"_{a} string" for a in ("time", "type", *S.EVENT_ATTRIBUTES))


def _read(spark: SparkSession, path, row_tag: str, schema: str) -> DataFrame:
    return (
        spark.read.format("xml")
        .option("rowTag", row_tag)
        .option("attributePrefix", "_")
        .schema(schema)
        .load(path)
    )


def _read_split(spark: SparkSession, path, tag: str, schema: str) -> DataFrame:
    """Elements ``tag`` of UTF-8 files like :func:`_read`, but a large file is read in splits.

    Files are cut behind every closing tag. What does not allow that - the tag in a
    comment that holds its end, in CDATA, a closing tag with a space, an element cut off -
    stops the scan with an error; no element is lost without a word.
    """
    start = rf"<{tag}[\s/>]"
    empty = rf"""(<{tag}(?:\s+[^\s=<>/]+\s*=\s*(?:"[^"]*"|'[^']*'))*\s*/>)"""
    text = F.regexp_replace("value", "(?s)<!--.*?-->", "")
    lines = spark.read.text(path, lineSep=f"</{tag}>").select(text.alias("value"))
    lines = lines.select(
        F.regexp_extract_all("value", F.lit(empty), 1).alias("empty"),
        F.regexp_replace("value", empty, "").alias("value"),
    )
    opened = F.size(F.split("value", start)) - 1
    broken = (opened > 1) | F.col("value").rlike(rf"<!--|-->|<!\[CDATA\[|</{tag}[\s>]")
    message = F.concat(F.lit(f"cannot be cut behind </{tag}>: "), F.substring("value", 1, 200))
    whole = F.concat(F.regexp_extract("value", f"(?s)({start}.*)$", 1), F.lit(f"</{tag}>"))
    own = F.when(broken, F.array(F.raise_error(message).cast("string"))).when(opened == 1, F.array(whole))
    rows = lines.select(F.explode(F.concat("empty", F.coalesce(own, F.array().cast("array<string>")))).alias("value"))
    options = {"attributePrefix": "_", "mode": "FAILFAST"}
    return rows.select(F.from_xml("value", schema, options).alias("e")).select("e.*")


def with_seq(scan: DataFrame) -> DataFrame:
    """Number the rows of a file scan in file order; files are ordered by path.

    ``seq`` = file rank * 2^40 + start of the split + row number in the task. A
    record takes more than one byte, so the row number never reaches the next
    split of the same file. Parts that would not fit their bits (a split of more
    than 2^33 rows, a file past 2^40 bytes, more than 2^23 files) stop the scan
    with an error instead of giving numbers out of order.
    """
    files = sorted(scan.inputFiles())
    if len(files) >= 1 << 23:
        raise ValueError(f"{len(files)} files: file ranks need more than 23 bits of seq")
    row = F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1))
    task_rows = F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1)) == F.lit(2**33 - 1)
    start = F.col("_metadata.file_block_start")
    offset = (
        F.when(task_rows, F.raise_error(F.lit("a split holds 2^33 rows or more: seq would overflow")))
        .when(start + row >= F.lit(1 << 40), F.raise_error(F.lit("a file passes 2^40 bytes: seq would overflow")))
        .otherwise(start + row)
    )
    if len(files) <= 1:
        return scan.withColumn("seq", offset)
    ranks = scan.sparkSession.createDataFrame(
        [(_LOCAL.sub(":/", name), rank << 40) for rank, name in enumerate(files)], "_file string, _base long"
    )
    file = F.regexp_replace(F.col("_metadata.file_path"), _LOCAL.pattern, ":/")
    numbered = scan.withColumns({"seq": offset, "_file": file})
    # One short row per input file: no more than the file index on the driver holds.
    base = F.coalesce("_base", F.raise_error(F.concat(F.lit("unknown input file "), F.col("_file"))))
    return (
        numbered.join(F.broadcast(ranks), "_file", "left")
        .withColumn("seq", F.col("seq") + base)
        .drop("_file", "_base")
    )


def typed_events(raw: DataFrame) -> DataFrame:
    """String attributes ``_name`` -> the typed event columns.

    A time that is no number becomes null, which marks the event as a reject.
    """
    columns: list[Column] = [F.col("seq"), F.col(_TEXT_TIME).try_cast("double").alias("time"), F.col("_type").alias("type")]
    for name in S.EVENT_ATTRIBUTES:
        value = F.col(f"_{name}")
        columns.append((to_double_or_nan(value) if name == "delay" else value).alias(name))
    return raw.select(columns)


def scan_event_log(spark: SparkSession, path, one_per_line: bool = False) -> DataFrame:
    """Events of one or many XML logs in file order; other elements are skipped.

    ``one_per_line`` promises that each event element has a line of its own, as
    simulators write it; uncompressed logs are then read in parallel splits.
    """
    if not one_per_line:
        return typed_events(with_seq(_read(spark, path, "event", _EVENT_XML)))
    lines = with_seq(spark.read.text(path))
    is_event = F.col("value").rlike(r"^\s*<event[\s/>]")
    # The promise: every event element opens and closes on one line, alone there.
    whole = F.col("value").rlike(r"^\s*<event[\s/>].*(/>|</event>)\s*$")
    several = F.size(F.split("value", r"<event[\s/>]")) > 2
    stray = ~is_event & F.col("value").rlike(r"<event[\s/>]")
    broken = (is_event & (~whole | several)) | stray
    lines = lines.withColumn(
        "value",
        F.when(broken, F.raise_error(F.concat(F.lit("not one event a line: "), F.substring("value", 1, 200))))
        .otherwise(F.col("value")),
    )
    parsed = lines.filter(is_event).select("seq", F.from_xml("value", _EVENT_XML, {"attributePrefix": "_"}).alias("e"))
    return typed_events(parsed.select("seq", "e.*"))


def land_events(spark: SparkSession, path, out: str, one_per_line: bool = False) -> DataFrame:
    """Scan once, write as parquet, and continue from the written table."""
    scan_event_log(spark, path, one_per_line).write.parquet(out)
    return spark.read.schema(S.EVENTS).parquet(out)


def scan_network(spark: SparkSession, path) -> tuple[DataFrame, DataFrame]:
    """(links, nodes) of a network file."""
    links = _read(spark, path, "link", "_id string, _from string, _to string, _length double").select(
        F.col("_id").alias("link_id"),
        F.col("_from").alias("from_node"),
        F.col("_to").alias("to_node"),
        F.col("_length").alias("length_m"),
    )
    nodes = _read(spark, path, "node", "_id string, _x double, _y double").select(
        F.col("_id").alias("node_id"), F.col("_x").alias("x"), F.col("_y").alias("y")
    )
    return links, nodes


_LINE_XML = """
    _id string,
    transitRoute array<struct<
        _id string,
        transportMode string,
        routeProfile struct<stop array<struct<_refId string>>>,
        route struct<link array<struct<_refId string>>>
    >>
"""


def scan_routes(spark: SparkSession, path) -> DataFrame:
    """Every route of a transit schedule file with its line and mode."""
    routes = _read(
        spark, path, "transitLine", "_id string, transitRoute array<struct<_id string, transportMode string>>"
    ).select(F.col("_id").alias("line_id"), F.explode("transitRoute").alias("r"))
    return routes.select(
        "line_id", F.col("r._id").alias("route_id"), F.trim("r.transportMode").alias("transport_mode")
    )


def scan_schedule(
    spark: SparkSession, path, include_terminal_links: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(route links, route stops) of a transit schedule file.

    A route's link list names its first and last link too. Whether those count as
    part of the route is a question of the routing model: by default they do not.
    """
    routes = _read(spark, path, "transitLine", _LINE_XML).select(
        F.col("_id").alias("line_id"), F.explode("transitRoute").alias("r")
    )
    base = ["line_id", F.col("r._id").alias("route_id"), F.trim("r.transportMode").alias("transport_mode")]
    links = routes.select(
        *base,
        F.size("r.route.link").alias("_n"),
        F.posexplode("r.route.link._refId").alias("link_seq", "link_id"),
    )
    if not include_terminal_links:
        links = links.filter("link_seq > 0 AND link_seq < _n - 1")
    places = _read(spark, path, "stopFacility", "_id string, _x double, _y double").select(
        F.col("_id").alias("stop_id"), F.col("_x").alias("x"), F.col("_y").alias("y")
    )
    stops = routes.select(
        *base, F.posexplode("r.routeProfile.stop._refId").alias("stop_seq", "stop_id")
    ).join(places, "stop_id")
    return links.drop("_n"), stops.select(S.SCENARIO["route_stops"].names)


def scan_transit_vehicles(spark: SparkSession, path) -> DataFrame:
    return _read(spark, path, "vehicle", "_id string, _type string").select(
        F.col("_id").alias("vehicle_id"), F.col("_type").alias("type_id")
    )


_ACTIVITIES = "array<struct<_type string, _x double, _y double>>"


def scan_population(spark: SparkSession, path, element: str = "activity") -> DataFrame:
    """Activities of all plans in plan order (``element="act"`` for older files).

    A person without a plan, or with an empty one, has one row without an activity. Files
    without compression are read in splits.
    """
    people = _read_split(
        spark, path, "person", f"_id string, plan array<struct<_selected string, {element} {_ACTIVITIES}>>"
    )
    plans = people.select(F.col("_id").alias("person_id"), F.explode_outer("plan").alias("p"))
    return plans.select(
        "person_id",
        F.coalesce(F.lower("p._selected") == "yes", F.lit(False)).alias("selected"),
        F.posexplode_outer(f"p.{element}").alias("act_seq", "a"),
    ).select(
        "person_id",
        "selected",
        "act_seq",
        F.col("a._type").alias("act_type"),
        F.col("a._x").alias("x"),
        F.col("a._y").alias("y"),
    )
