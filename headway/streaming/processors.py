"""Keyed state for the streamed event-log operators.

Keys are dealt by hash over many buckets, and a bucket is what Spark groups by: a call to
the state store then serves all keys of a bucket, not one. Rows wait in their bucket's
state until the watermark has passed them, so files of a log may arrive in any order
within the lateness. Then they are worked through by key and ``seq``, in blocks of
bounded size: what earlier rows of a key left is put in front of its rows as a *carry*
row, a blank row behind takes the state after them, and array operations fill in the
state before each row. The batch operators say the same with window functions.

Rows of a key that arrive behind its last ``seq`` already worked on are too late to change
the state. They are not dropped: they come out whole, as JSON in ``late``, with ``late_seq``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from headway import schemas as S

LATE, LATE_ROW = "late_seq", "late"
#: Rows that are worked through at once.
BLOCK = 100_000
#: Column of the bucket, and the number of buckets (fixed for the life of a checkpoint).
BUCKET, BUCKETS = "_bucket", 1024
#: Milliseconds of log time after which a closed key is forgotten.
IDLE_MS = 24 * 3600 * 1000


def to_bytes(rows: pd.DataFrame) -> bytes:
    table, sink = pa.Table.from_pandas(rows, preserve_index=False), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def from_bytes(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(data).read_pandas()


class KeyedLog(StatefulProcessor):
    """Holds the rows of a bucket's keys back, orders them, keeps each key's carry, and sets late rows apart."""

    key: str
    carry_fields: dict[str, pa.DataType]
    output: list[str]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._carry = handle.getValueState("carry", "rows binary")
        self._held = handle.getListState("held", "rows binary")

    def _carries(self) -> dict[str, tuple]:
        """Key -> last seq, last due time, and carry."""
        if not self._carry.exists():
            return {}
        columns = pa.ipc.open_stream(self._carry.get()[0]).read_all().to_pydict().values()
        return {key: tuple(rest) for key, *rest in zip(*columns, strict=True)}

    def _keep(self, carries: dict[str, tuple]) -> None:
        if not carries:
            self._carry.clear()
            return
        schema = pa.schema(
            {"key": pa.string(), "last_seq": pa.int64(), "last_due": pa.int64(), **self.carry_fields}
        )
        columns = [list(carries), *(list(c) for c in zip(*carries.values(), strict=True))]
        table = pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, schema) as out:
            out.write_table(table)
        self._carry.update((sink.getvalue().to_pybytes(),))

    def _last_seq(self, rows: pd.DataFrame, carries: dict[str, tuple]) -> np.ndarray:
        return np.array([carries[k][0] if k in carries else -1 for k in rows[self.key]], dtype=np.int64)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if pd.isna(key[-1]):  # the mark at the end of a log: it only moves the watermark
            return
        carries = self._carries()
        soonest, wake = timerValues.getCurrentWatermarkInMs() + 1, []
        for part in rows:
            part = part.drop(columns=BUCKET, errors="ignore")
            late = part["seq"].to_numpy() <= self._last_seq(part, carries)
            yield from self._set_apart(part[late])
            part = part[~late]
            if len(part):
                # A time that is not a number waits as long as rows that arrive with it at least.
                ms = np.floor(part["time"].to_numpy(dtype=float, na_value=np.nan) * 1000)
                due = np.maximum(np.nan_to_num(ms, nan=soonest, posinf=soonest, neginf=soonest), soonest)
                part = part.assign(due=due.astype(np.int64))
                self._held.appendValue((to_bytes(part),))
                wake.append(int(part["due"].min()))
        if wake:
            self._handle.registerTimer(min(wake))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        carries = self._carries()
        held = [from_bytes(data) for (data,) in self._held.get()] if self._held.exists() else []
        waiting = set()
        if held:
            log = pd.concat(held, ignore_index=True)
            ripe, rest = log[log["due"] <= now], log[log["due"] > now]
            if len(rest):
                self._handle.registerTimer(int(rest["due"].min()))
                waiting = set(rest[self.key])
            if len(ripe):
                self._held.clear()
                if len(rest):
                    self._held.appendValue((to_bytes(rest),))
                late = ripe["seq"].to_numpy() <= self._last_seq(ripe, carries)
                yield from self._set_apart(ripe[late].drop(columns="due"))
                fresh = ripe[~late].sort_values([self.key, "seq"], ignore_index=True)
                for at in range(0, len(fresh), BLOCK):
                    yield from self._worked(fresh[at : at + BLOCK].reset_index(drop=True), carries)
        # Closed keys are forgotten in time, those without waiting rows.
        over = {k: c[1] + IDLE_MS for k, c in carries.items() if k not in waiting and self.closed(c[2:])}
        for k, end in over.items():
            if end <= now:
                del carries[k]
        later = [end for end in over.values() if end > now]
        if later:
            self._handle.registerTimer(max(later))
        self._keep(carries)

    def _worked(self, log: pd.DataFrame, carries: dict[str, tuple]) -> Iterator[pd.DataFrame]:
        """Records of rows ordered by key and seq; ``carries`` moves on."""
        names = log[self.key].to_numpy(dtype=object)
        firsts = np.flatnonzero(np.append([True], names[1:] != names[:-1]))
        keys, sizes = names[firsts], np.diff(np.append(firsts, len(log)))
        known = [carries[k][2:] if k in carries else self.blank() for k in keys]
        out, after = self.work(keys, sizes, log, known)
        last = log["seq"].to_numpy()[firsts + sizes - 1].tolist()
        due = np.maximum.reduceat(log["due"].to_numpy(), firsts).tolist()
        carries.update((k, (s, d, *c)) for k, s, d, c in zip(keys, last, due, after, strict=True))
        if len(out):
            yield self._shaped(out)

    def _set_apart(self, late: pd.DataFrame) -> Iterator[pd.DataFrame]:
        if len(late):
            whole = late.to_json(orient="records", lines=True).splitlines()
            yield self._shaped(pd.DataFrame({LATE: late["seq"].to_numpy(), LATE_ROW: whole}))

    def _shaped(self, out: pd.DataFrame) -> pd.DataFrame:
        # Plain objects: the output schema alone decides the types.
        return out.reindex(columns=[*self.output, S.EMITTED_AT, LATE, LATE_ROW]).astype(object)

    def blank(self) -> tuple:
        """The carry of a key without rows."""
        raise NotImplementedError

    def closed(self, carry) -> bool:
        """Does this carry say no more than :meth:`blank`?"""
        raise NotImplementedError

    def advance(self, key, log: pd.DataFrame, carry) -> tuple[pd.DataFrame, tuple]:
        """Records of the next rows of one key, and the carry behind them."""
        out, after = self.work(np.array([key], dtype=object), np.array([len(log)]), log, [tuple(carry)])
        return out, after[0]

    def work(self, keys: np.ndarray, sizes: np.ndarray, log: pd.DataFrame, carries: list) -> tuple[pd.DataFrame, list]:
        """Records of the next rows of some keys, ``sizes`` rows each, and the carries behind them."""
        raise NotImplementedError

    def close(self) -> None:
        pass


class Frames:
    """Columns with a carry row in front of each key's rows and a blank row behind; nulls are None."""

    def __init__(self, log: pd.DataFrame, sizes: np.ndarray, carries: list):
        self.log, self.carries = log, list(zip(*carries, strict=True))
        ends = np.cumsum(sizes + 2)
        self.head, self.tail = ends - sizes - 2, ends - 1
        self.of = np.repeat(np.arange(len(sizes)), sizes + 2)
        self.inside = np.ones(len(self.of), dtype=bool)
        self.inside[self.head] = self.inside[self.tail] = False

    def columns(self, *names: str) -> list[np.ndarray]:
        out = []
        for name in names:
            values = self.log[name].astype(object).to_numpy()
            column = np.full(len(self.of), None, dtype=object)
            column[self.inside] = np.where(pd.isna(values), None, values)
            out.append(column)
        return out

    def carry(self, at: int, dtype=object) -> np.ndarray:
        """One part of all carries, in the order of the keys."""
        out = np.empty(len(self.head), dtype=dtype)
        out[:] = self.carries[at]
        return out

    def latest_before(self, mask: np.ndarray) -> np.ndarray:
        """Per row, the position of the key's last earlier row that is marked, or of its carry row."""
        mask = mask.copy()
        mask[self.head] = True
        at = np.maximum.accumulate(np.where(mask, np.arange(len(mask)), 0))
        return np.concatenate(([0], at[:-1]))

    def sums_before(self, change: np.ndarray) -> np.ndarray:
        """Sums of ``change`` over the key's earlier rows."""
        sums = np.concatenate(([0], np.cumsum(change)[:-1]))
        return sums - sums[self.head][self.of]


def some(values: np.ndarray) -> np.ndarray:
    return ~pd.isna(values)


class Boardings(KeyedLog):
    key = "bus"
    carry_fields = {"driver": pa.string()}
    output = S.RECORDS["bus_pax_records"].names

    def blank(self):
        return (None,)

    def closed(self, carry):
        return carry[0] is None

    def work(self, keys, sizes, log, carries):
        f = Frames(log, sizes, carries)
        kind, person, driver, time = f.columns("type", "person", "starting", "time")
        sets = ((kind == S.DRIVER_STARTS) & some(driver)) | (kind == S.LEAVES_TRAFFIC)
        driver = np.where(kind == S.DRIVER_STARTS, driver, None)
        driver[f.head] = f.carry(0)
        in_charge = driver[f.latest_before(sets)]
        hit = (kind == S.PERSON_ENTERS) & some(person) & some(in_charge) & (person != in_charge)
        out = pd.DataFrame({"person_id": person[hit], "bus_id": keys[f.of[hit]], S.EMITTED_AT: time[hit]})
        return out, [(d,) for d in in_charge[f.tail]]


class StopDelays(KeyedLog):
    key = "bus"
    carry_fields = {"pending": pa.bool_(), "facility": pa.string(), "delay": pa.float64()}
    output = S.RECORDS["bus_delay_records"].names

    def blank(self):
        return (False, None, None)

    def closed(self, carry):
        return not carry[0]

    def work(self, keys, sizes, log, carries):
        f = Frames(log, sizes, carries)
        kind, facility, delay, time = f.columns("type", "facility", "delay", "time")
        arrived = kind == S.ARRIVES
        arrived[f.head], facility[f.head], delay[f.head] = f.carry(0, bool), f.carry(1), f.carry(2)
        pairs = np.flatnonzero((kind == S.DEPARTS) & np.concatenate(([False], arrived[:-1])))
        out = pd.DataFrame(
            {
                "stop_id": facility[pairs - 1],
                "arrival_delay": delay[pairs - 1].astype(float),
                "depart_delay": delay[pairs].astype(float),
                S.EMITTED_AT: time[pairs],
            }
        )
        end = f.tail - 1
        left = [None if d is None else float(d) for d in delay[end]]
        return out, list(zip(arrived[end].tolist(), facility[end], left, strict=True))


class LinkTraversals(KeyedLog):
    key = "bus"
    carry_fields = {
        "active": pa.bool_(), "link": pa.string(), "km": pa.float64(), "since": pa.float64(),
        "driver": pa.string(), "aboard": pa.int64(), "aboard_at_link": pa.int64(),
    }
    output = S.RECORDS["bus_trip_records"].names

    def blank(self):
        return (False, None, None, None, None, 0, 0)

    def closed(self, carry):
        return not carry[0] and carry[4] is None

    def work(self, keys, sizes, log, carries):
        f = Frames(log, sizes, carries)
        kind, link, km, time, person, starting = f.columns("type", "link", "km", "time", "person", "starting")
        since, driver = time.copy(), np.where(kind == S.DRIVER_STARTS, starting, None)
        joins = (kind == S.ENTERS_TRAFFIC) & some(link)
        on_link = joins | ((kind == S.ENTERED_LINK) & some(link))
        quits = kind == S.LEAVES_TRAFFIC
        in_traffic = joins.copy()
        in_traffic[f.head], link[f.head], km[f.head] = f.carry(0, bool), f.carry(1), f.carry(2)
        since[f.head], driver[f.head] = f.carry(3), f.carry(4)

        active = in_traffic[f.latest_before(joins | quits)]
        entry = f.latest_before(on_link)
        known = some(km[entry])
        starts = (kind == S.DRIVER_STARTS) & some(starting)
        in_charge = driver[f.latest_before(starts | (quits & active & known))]

        passenger = active & some(person) & (person != in_charge)
        change = np.where(passenger, (kind == S.PERSON_ENTERS) * 1 - (kind == S.PERSON_LEAVES) * 1, 0)
        riders = f.carry(5, np.int64)[f.of] + f.sums_before(change)
        at_start, at_link = riders.copy(), riders.copy()
        at_start[f.head], at_link[f.head] = 0, f.carry(6, np.int64)
        at_start, at_link = at_start[f.latest_before(joins)], at_link[entry]

        leaves = np.flatnonzero(((kind == S.LEFT_LINK) | quits) & active & known)
        out = pd.DataFrame(
            {
                "bus_id": keys[f.of[leaves]],
                "link_id": link[entry[leaves]],
                "link_length": km[entry[leaves]].astype(float),
                "travel_time": time[leaves].astype(float) - since[entry[leaves]].astype(float),
                "have_passenger": (at_link > at_start)[leaves],
                S.EMITTED_AT: time[leaves],
            }
        )
        end = f.tail
        e = entry[end]
        numbers = ([None if x is None else float(x) for x in column[e]] for column in (km, since))
        aboard = ((x - at_start)[end].tolist() for x in (riders, at_link))
        return out, list(zip(active[end].tolist(), link[e], *numbers, in_charge[end], *aboard, strict=True))


class PersonTrips(KeyedLog):
    key = "person"
    carry_fields = {
        "start": pa.float64(), "mode": pa.string(), "vehicles": pa.list_(pa.string()), "kept": pa.bool_(),
    }
    output = S.RECORDS["trip_records"].names

    def blank(self):
        return (None, None, [], False)

    def closed(self, carry):
        return carry[0] is None

    def work(self, keys, sizes, log, carries):
        # A person has few rows at a time: a plain loop over all of them beats arrays here.
        trips, after = [], []
        rows = zip(*(log[name].astype(object) for name in ("time", "type", "mode", "vehicle", "banned")), strict=True)
        for person, size, (start, mode, vehicles, kept) in zip(keys, sizes.tolist(), carries, strict=True):
            vehicles = list(vehicles)
            for time, kind, new_mode, vehicle, banned in islice(rows, size):
                if kind == S.DEPARTURE:
                    if start is None:
                        start, mode = time, new_mode
                elif start is None:
                    continue
                elif kind == S.PERSON_ENTERS:
                    vehicles.append(vehicle)
                    kept = kept or pd.isna(banned)
                else:
                    if kept:
                        trips.append((person, start, time - start, mode, vehicles, time))
                    start, mode, vehicles, kept = self.blank()
            mode = None if pd.isna(mode) else mode
            after.append((None if start is None else float(start), mode, vehicles, bool(kept)))
        return pd.DataFrame(trips, columns=[*self.output, S.EMITTED_AT]), after
