"""Streamed operators: four record tables and per-second throughput."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from headway import schemas as S
from headway.operators.boardings import boarding_log
from headway.operators.delays import delay_log
from headway.operators.traversals import bus_log
from headway.operators.trips import trip_log
from headway.streaming import processors as P

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


LATENESS = "15 minutes"
#: Files of a landed log per micro-batch: what a hot key may bring at once is bounded by them.
FILES_PER_TRIGGER = 16
#: Time of the mark behind the end of a log, in seconds.
END = 1e11
_MARK = "time double"


def landed_events(spark: SparkSession, path: str, files: int = FILES_PER_TRIGGER) -> DataFrame:
    """A landed event log as a stream, some files at a time."""
    return spark.readStream.schema(S.EVENTS).option("maxFilesPerTrigger", files).parquet(path)


def end_marks(spark: SparkSession, folder: str) -> DataFrame:
    """The stream of the mark that :func:`mark_end` leaves in ``folder``."""
    spark.createDataFrame([], _MARK).write.mode("ignore").parquet(folder)
    return spark.readStream.schema(_MARK).parquet(folder)


def mark_end(spark: SparkSession, folder: str) -> None:
    """Say that the log is complete: rows still held back come out at the next run."""
    spark.createDataFrame([(END,)], _MARK).write.mode("append").parquet(folder)


def _stateful(
    log: DataFrame, processor: P.KeyedLog, table: str, ends: DataFrame | None, lateness: str
) -> DataFrame:
    log.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    fields = [T.StructField(f.name, f.dataType, True) for f in S.RECORDS[table]]
    output = T.StructType(
        [
            *fields,
            T.StructField(S.EMITTED_AT, T.DoubleType(), True),
            T.StructField(P.LATE, T.LongType(), True),
            T.StructField(P.LATE_ROW, T.StringType(), True),
        ]
    )
    bucket = F.pmod(F.xxhash64(processor.key), F.lit(P.BUCKETS)).cast("int")
    log = log.withColumn(P.BUCKET, F.when(F.col(processor.key).isNotNull(), bucket))
    columns = log.columns
    if ends is not None:
        log = log.unionByName(ends, allowMissingColumns=True)
    at = F.when(~F.isnan("time"), F.timestamp_millis(F.floor(F.least("time", F.lit(END)) * 1000)))
    # The time column itself goes no further: the processor sets late rows apart, Spark drops none.
    timed = log.withColumn("at", at).withWatermark("at", lateness).select(*columns)
    return timed.groupBy(P.BUCKET).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=output, outputMode="Append", timeMode="EventTime"
    )


def stream_bus_boardings(
    events: DataFrame, buses: DataFrame, ends: DataFrame | None = None, lateness: str = LATENESS
) -> DataFrame:
    """Rows are worked on once events ``lateness`` later have come, or the mark in ``ends``."""
    log = boarding_log(events, buses, "time")
    return _stateful(log, P.Boardings(), "bus_pax_records", ends, lateness)


def stream_bus_stop_delays(
    events: DataFrame, buses: DataFrame, ends: DataFrame | None = None, lateness: str = LATENESS
) -> DataFrame:
    log = delay_log(events, buses, "time")
    rows = _stateful(log, P.StopDelays(), "bus_delay_records", ends, lateness)
    # The way out of pandas turns NaN (no delay given) into null.
    delays = {
        c: F.when(F.col(P.LATE).isNull(), F.coalesce(c, F.lit(float("nan"))))
        for c in ("arrival_delay", "depart_delay")
    }
    return rows.withColumns(delays)


def stream_bus_link_traversals(
    events: DataFrame, buses: DataFrame, link_km: DataFrame, ends: DataFrame | None = None, lateness: str = LATENESS
) -> DataFrame:
    log = bus_log(events, buses, link_km)
    return _stateful(log, P.LinkTraversals(), "bus_trip_records", ends, lateness)


def stream_person_trips(
    events: DataFrame, blacklist: DataFrame, ends: DataFrame | None = None, lateness: str = LATENESS
) -> DataFrame:
    log = trip_log(events, blacklist)
    return _stateful(log, P.PersonTrips(), "trip_records", ends, lateness)


def stream_iteration_filter(events: DataFrame, target: int) -> DataFrame:
    """Only events of the target iteration reach the state, so none crosses over."""
    return events.filter(F.col("iteration") == target)


def stream_throughput(events: DataFrame, channel: str = "type", lateness: str = "1 hour") -> DataFrame:
    """Events per channel and simulated second in tumbling event-time windows."""
    timed = events.withColumn("at", F.timestamp_seconds(F.col("time"))).withWatermark("at", lateness)
    counts = timed.groupBy(F.window("at", "1 second").alias("w"), F.col(channel).alias("channel")).count()
    return counts.select(
        "channel", F.unix_seconds("w.start").alias("second"), F.col("count").alias("n")
    )


def records(stored: DataFrame, emitted: bool = False) -> DataFrame:
    """The record rows of a stored stream; ``emitted`` keeps the time that completed them."""
    rows = stored.filter(F.col(P.LATE).isNull()).drop(P.LATE, P.LATE_ROW)
    return rows if emitted else rows.drop(S.EMITTED_AT)


def late_rows(stored: DataFrame) -> DataFrame:
    """Rows that came too late, whole: ``late`` is the JSON of all their columns."""
    return stored.filter(F.col(P.LATE).isNotNull()).select(P.LATE, P.LATE_ROW)


def start(stream: DataFrame, out: str, **trigger) -> StreamingQuery:
    """Append a stream to a parquet table; the checkpoint lies beside it."""
    return (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", f"{out}-checkpoint")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def run_to_end(stream: DataFrame, out: str, ends: str) -> None:
    """Work through a complete log: all that is there, then what the end mark releases."""
    start(stream, out).awaitTermination()
    mark_end(stream.sparkSession, ends)
    start(stream, out).awaitTermination()


def start_throughput(stream: DataFrame, out: str, **trigger) -> StreamingQuery:
    """Store running counts as they change; :func:`read_throughput` takes the final ones."""

    def append(batch: DataFrame, batch_id: int) -> None:
        # One folder per batch, overwritten if the batch is run again.
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (
        stream.writeStream.outputMode("update")
        .foreachBatch(append)
        .option("checkpointLocation", f"{out}-checkpoint")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_throughput(spark: SparkSession, out: str) -> DataFrame:
    stored = spark.read.schema("channel string, second long, n long").parquet(out)
    return stored.groupBy("channel", "second").agg(F.max("n").alias("n"))


def start_fan_out(
    events: DataFrame,
    buses: DataFrame,
    blacklist: DataFrame,
    link_km: DataFrame,
    out: str,
    ends: DataFrame | None = None,
    lateness: str = LATENESS,
    **trigger,
) -> dict[str, StreamingQuery]:
    """One event stream to the four record tables, each with its own query and checkpoint."""
    streams = {
        "bus_pax_records": stream_bus_boardings(events, buses, ends, lateness),
        "bus_delay_records": stream_bus_stop_delays(events, buses, ends, lateness),
        "bus_trip_records": stream_bus_link_traversals(events, buses, link_km, ends, lateness),
        "trip_records": stream_person_trips(events, blacklist, ends, lateness),
    }
    return {name: start(stream, f"{out}/{name}", **trigger) for name, stream in streams.items()}
