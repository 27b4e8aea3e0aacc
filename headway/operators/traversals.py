"""Bus link traversals with occupancy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway import schemas as S
from headway.functions.columns import emission
from headway.operators.events import bus_events, vehicle_events
from headway.operators.prefix import Ordered, by_key, carried
from headway.operators.skew import lookup

_TYPES = (
    S.DRIVER_STARTS,
    S.ENTERS_TRAFFIC,
    S.LEAVES_TRAFFIC,
    S.ENTERED_LINK,
    S.LEFT_LINK,
    S.PERSON_ENTERS,
    S.PERSON_LEAVES,
)


def _is(*kinds: str) -> Column:
    return F.col("type").isin(*kinds)


def _joins() -> Column:
    """The bus joins traffic; without a link the event says nothing."""
    return _is(S.ENTERS_TRAFFIC) & F.col("link").isNotNull()


def _on_link() -> Column:
    """The bus is now on a named link."""
    return _is(S.ENTERS_TRAFFIC, S.ENTERED_LINK) & F.col("link").isNotNull()


def _quits() -> Column:
    return _is(S.LEAVES_TRAFFIC)


def bus_log(events: DataFrame, buses: DataFrame, link_km: DataFrame) -> DataFrame:
    """The bus events that occupancy depends on; ``km`` is null on unknown links."""
    log = bus_events(events, buses, *_TYPES).select(
        "seq",
        "time",
        "type",
        "bus",
        "person",
        F.col("driverId").alias("starting"),
        F.when(_is(S.ENTERS_TRAFFIC, S.ENTERED_LINK), F.col("link")).alias("link"),
        *carried(events),
    )
    return lookup(log, link_km.select(F.col("link_id").alias("link"), "km"), ["link"], "left", "seq")


def bus_link_traversals(
    events: DataFrame,
    buses: DataFrame,
    link_km: DataFrame,
    heavy: DataFrame | None = None,
    emitted: bool = False,
    ranged: bool | DataFrame = False,
) -> DataFrame:
    """One row each time a bus in traffic leaves a link of known length.

    ``have_passenger`` tells whether anyone was on board when the link was entered.
    ``emitted`` adds the time of leaving; ``ranged`` orders by range partitions.
    """
    return _by_bus(events, buses, link_km, lambda log: _traversals(bus_state(log), emitted), heavy, ranged)


def occupancy_violations(events: DataFrame, buses: DataFrame, link_km: DataFrame) -> DataFrame:
    """Buses that leave traffic with a passenger balance other than zero."""
    return _by_bus(events, buses, link_km, lambda log: _violations(bus_state(log)))


def bus_active_state(events: DataFrame, buses: DataFrame) -> DataFrame:
    """For every traffic event of a bus: was it in traffic just before?"""

    def recipe(log: Ordered) -> DataFrame:
        rows = log.before(last={"active": _active()}).df
        return rows.select(
            "seq", F.col("bus").alias("bus_id"), (F.coalesce("active", F.lit(0)) == 1).alias("active")
        )

    kinds = (S.ENTERS_TRAFFIC, S.LEAVES_TRAFFIC, S.ENTERED_LINK, S.LEFT_LINK)
    log = bus_events(events, buses, *kinds).select("seq", "type", "bus", "link")
    return by_key(log, "bus", recipe, vehicle_events(events, *kinds))


def _by_bus(events: DataFrame, buses: DataFrame, link_km: DataFrame, recipe, heavy=None, ranged: bool | DataFrame = False) -> DataFrame:
    return by_key(bus_log(events, buses, link_km), "bus", recipe, vehicle_events(events, *_TYPES), heavy, ranged)


def bus_occupancy(events: DataFrame, buses: DataFrame, link_km: DataFrame) -> DataFrame:
    """Passengers on board just before every event of a bus that is in traffic."""

    def recipe(log: Ordered) -> DataFrame:
        return (
            bus_state(log)
            .filter(F.col("active") == 1)
            .select("seq", F.col("bus").alias("bus_id"), on_board().alias("on_board"))
        )

    return _by_bus(events, buses, link_km, recipe)


def _active() -> Column:
    return F.when(_joins(), 1).when(_quits(), 0)


def bus_state(log: Ordered) -> DataFrame:
    """What each event finds: active flag, current link, driver, passenger counts.

    Three rounds, since each needs the one before: activity and link; the driver,
    whom only a bus leaving an active run over a known link dismisses; passengers,
    whom only the driver's identity sets apart.
    """
    log = log.before(
        last={
            "active": _active(),
            "here": F.when(_on_link(), F.struct("link", "km", F.col("time").alias("since"))),
        }
    )
    running = F.col("active") == 1
    dismissed = _quits() & running & F.col("here.km").isNotNull()
    log = log.before(
        last={
            "driver": F.when(
                _is(S.DRIVER_STARTS) & F.col("starting").isNotNull(),
                F.struct(F.col("starting").alias("id")),
            ).when(dismissed, F.struct(F.lit(None).cast("string").alias("id")))
        }
    )
    passenger = running & F.coalesce(
        F.col("person") != F.col("driver.id"), F.col("person").isNotNull()
    )
    change = (
        F.when(passenger & _is(S.PERSON_ENTERS), 1)
        .when(passenger & _is(S.PERSON_LEAVES), -1)
        .otherwise(0)
        .cast("long")
    )
    return log.before(
        total={"riders": change},
        at_mark={"riders_at_start": ("riders", _joins()), "riders_at_link": ("riders", _on_link())},
    ).df


def on_board() -> Column:
    return F.col("riders") - F.col("riders_at_start")


def _traversals(rows: DataFrame, emitted: bool) -> DataFrame:
    exits = _is(S.LEFT_LINK, S.LEAVES_TRAFFIC) & (F.col("active") == 1)
    return rows.filter(exits & F.col("here.km").isNotNull()).select(
        F.col("bus").alias("bus_id"),
        F.col("here.link").alias("link_id"),
        F.col("here.km").alias("link_length"),
        (F.col("time") - F.col("here.since")).alias("travel_time"),
        (F.col("riders_at_link") > F.col("riders_at_start")).alias("have_passenger"),
        *emission(emitted),
    )


def _violations(rows: DataFrame) -> DataFrame:
    return rows.filter(_quits() & (F.col("active") == 1) & (on_board() != 0)).select(
        "seq", F.col("bus").alias("bus_id"), "time", on_board().alias("on_board")
    )
