"""One-pass event store: the log landed once, ordered for every state machine.

One scan of the raw log gives each valid event a row under its vehicle (``v``)
and/or under its person (``p``, drivers excepted). One exchange range-partitions
these rows by (kind, key, seq) at sampled, row-balanced cuts, and one write lands
them as a table bucketed by chunk: range partition i is bucket i (its chunk label
is chosen so that Spark's bucket hash sends it there), one file a bucket, sorted by
(kind, key, seq). Windows over (key, chunk) then find their rows where they lie:
no exchange by vehicle or person. Keys that span two chunks (fewer than the
partitions) are listed once for the carries of :mod:`headway.operators.prefix`.
"""

from __future__ import annotations

import uuid
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway import schemas as S
from headway.operators.events import valid_events
from headway.operators.prefix import CHUNK

KIND, KEY = "_kind", "_key"


@dataclass(frozen=True)
class EventStore:
    table: str
    rows: DataFrame
    #: (kind, key) of keys whose rows lie in more than one chunk.
    spans: DataFrame

    def vehicles(self) -> tuple[DataFrame, DataFrame]:
        """Vehicle events with ``bus`` (the vehicle they are about), and the spanning buses."""
        return (
            self.rows.filter(F.col(KIND) == "v").withColumn("bus", F.col(KEY)).drop(KIND, KEY),
            self.spans.filter(F.col(KIND) == "v").select(F.col(KEY).alias("bus")),
        )

    def persons(self) -> tuple[DataFrame, DataFrame]:
        """Events of persons other than drivers, and the spanning persons."""
        return (
            self.rows.filter(F.col(KIND) == "p").drop(KIND, KEY),
            self.spans.filter(F.col(KIND) == "p").select(F.col(KEY).alias("person")),
        )

    def drop(self) -> None:
        self.rows.sparkSession.sql(f"DROP TABLE IF EXISTS {self.table}")


def _labels(spark: SparkSession, parts: int) -> list[int]:
    """For bucket i, a long whose bucket hash (murmur3, seed 42) modulo ``parts`` is i.

    The label of bucket i is taken from [i * W, (i + 1) * W) with W = 32 * parts, so
    labels rise with i and carries can be ordered by them; that a window holds no
    fitting value has odds of about e^-32.
    """
    width = 32 * parts
    tried = spark.range(parts * width).select(
        F.col("id").alias("c"),
        F.floor(F.col("id") / width).alias("i"),
        F.pmod(F.hash(F.col("id")), F.lit(parts)).alias("b"),
    )
    fits = tried.filter(F.col("i") == F.col("b")).groupBy("i").agg(F.min("c").alias("c"))
    found = {r["i"]: r["c"] for r in fits.collect()}
    return [found[i] for i in range(parts)]


def land_events(events: DataFrame) -> EventStore:
    """Write the valid events once, keyed by vehicle and by person (see module docstring)."""
    spark = events.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    valid = valid_events(events)
    about = F.when(F.col("type") == S.DRIVER_STARTS, F.col("vehicleId")).otherwise(F.col("vehicle"))
    is_vehicle = F.col("type").isin(*S.VEHICLE_EVENTS) & about.isNotNull()
    is_person = F.col("person").isNotNull() & ~F.col("person").startswith(S.DRIVER_PREFIX)
    keyed = F.filter(
        F.array(
            F.when(is_vehicle, F.struct(F.lit("v").alias(KIND), about.alias(KEY))),
            F.when(is_person, F.struct(F.lit("p").alias(KIND), F.col("person").alias(KEY))),
        ),
        lambda k: k.isNotNull(),
    )
    rows = valid.select("*", F.explode(keyed).alias("_k")).select("*", "_k.*").drop("_k")
    labels = F.array(*[F.lit(c) for c in _labels(spark, parts)])
    ranged = rows.repartitionByRange(parts, KIND, KEY, "seq").withColumn(
        CHUNK, F.element_at(labels, F.spark_partition_id() + 1)
    )
    table = f"headway_events_{uuid.uuid4().hex}"
    ranged.write.bucketBy(parts, CHUNK).sortBy(KIND, KEY, "seq").saveAsTable(table)
    landed = spark.table(table)
    ends = landed.groupBy(CHUNK).agg(
        F.min(F.struct(KIND, KEY)).alias("lo"), F.max(F.struct(KIND, KEY)).alias("hi")
    ).collect()
    seen = Counter(tuple(k) for r in ends for k in {tuple(r["lo"]), tuple(r["hi"])})
    spans = spark.createDataFrame(
        [k for k, c in seen.items() if c > 1], landed.select(KIND, KEY).schema
    )
    return EventStore(table, landed, spans)
